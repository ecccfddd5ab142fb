"""A minimal acyclic transducer from words to token ids, in a file that workers map into memory.

Words are added in byte order. What a new word no longer shares with the last
one is frozen: a state equal to a frozen one, with the same arcs, outputs and
ends, is replaced by it, so endings are shared as well as beginnings. Ids stand
on arcs as early as all words below agree on them, so that endings of words with
different ids become equal.

In the file every state is a run of arcs, sorted by byte; an arc has the state
it leads to and a slice of one pool of ids. Many words are looked up at once,
one byte of each at a step, by binary search over (state, byte).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import cache

import numpy as np

Ids = tuple[int, ...]

_MAGIC = 0x3158454C
_HEADER = 8  # 64-bit integers


class _State:
    """A state that can still change: arcs as byte -> [output, target], and the rest of a word that ends here."""

    __slots__ = ("arcs", "end")

    def __init__(self) -> None:
        self.arcs: dict[int, list] = {}
        self.end: Ids | None = None


def _shared(a: Ids, b: Ids) -> int:
    n = 0
    for x, y in zip(a, b, strict=False):
        if x != y:
            break
        n += 1
    return n


class Builder:
    """Builds the automaton; words come in ascending order, each once."""

    def __init__(self) -> None:
        self.frozen: dict[tuple, int] = {}
        self.states: list[tuple] = []
        self.path = [_State()]  # the states along the last word
        self.last = b""

    def add(self, word: bytes, ids: Ids) -> None:
        if word <= self.last and (self.last or self.path[0].end is not None):
            raise ValueError("words have to ascend")
        common = 0
        while common < min(len(word), len(self.last)) and word[common] == self.last[common]:
            common += 1
        self._freeze(common)
        # the outputs on the shared path are cut down to what the new word shares; the rest moves below
        rest = ids
        for at in range(common):
            arc = self.path[at].arcs[word[at]]
            n = _shared(arc[0], rest)
            moved = arc[0][n:]
            if moved:
                arc[0] = arc[0][:n]
                below = self.path[at + 1]
                for other in below.arcs.values():
                    other[0] = moved + other[0]
                if below.end is not None:
                    below.end = moved + below.end
            rest = rest[n:]
        for at in range(common, len(word)):
            self.path.append(_State())
            self.path[at].arcs[word[at]] = [rest, None]
            rest = ()
        self.path[len(word)].end = rest
        self.last = word

    def _freeze(self, depth: int) -> None:
        """Freeze the states of the last word that are deeper than `depth`."""
        while len(self.path) > depth + 1:
            state = self.path.pop()
            self.path[-1].arcs[self.last[len(self.path) - 1]][1] = self._number(state)

    def _number(self, state: _State) -> int:
        key = (state.end, *((b, tuple(out), to) for b, (out, to) in state.arcs.items()))
        if key not in self.frozen:
            self.frozen[key] = len(self.states)
            self.states.append(key)
        return self.frozen[key]

    def finish(self) -> bytes:
        """The file's bytes."""
        self._freeze(0)
        root = self._number(self.path[0])
        pool: list[int] = []
        places: dict[Ids, int] = {(): 0}

        def place(ids: Ids) -> int:
            if ids not in places:
                places[ids] = len(pool)
                pool.extend(ids)
            return places[ids]

        keys, targets, starts, sizes = [], [], [], []
        ends, end_starts, end_sizes = [], [], []
        for number, (end, *arcs) in enumerate(self.states):
            ends.append(end is not None)
            end_starts.append(place(end or ()))
            end_sizes.append(len(end or ()))
            for byte, out, to in arcs:  # bytes ascend, as words do
                keys.append(number << 8 | byte)
                targets.append(to)
                starts.append(place(out))
                sizes.append(len(out))
        header = np.array([_MAGIC, root, len(keys), len(self.states), len(pool), 0, 0, 0], "<i8")
        parts = [
            header,
            np.array(keys, "<i8"),
            *(np.array(x, "<i4") for x in (targets, starts, sizes, ends, end_starts, end_sizes, pool)),
        ]
        return b"".join(p.tobytes() for p in parts)


def compiled(words: Sequence[bytes], ids: Sequence[Sequence[int]]) -> bytes:
    """The file for these words, which are distinct, and their ids."""
    builder = Builder()
    for word, own in sorted(zip(words, map(tuple, ids), strict=True)):
        builder.add(word, own)
    return builder.finish()


class Lexicon:
    """Looks words up in a compiled file, which is mapped into memory and shared by all workers of a machine."""

    def __init__(self, path: str):
        header = np.fromfile(path, "<i8", _HEADER)
        if len(header) < _HEADER or header[0] != _MAGIC:
            raise ValueError(f"{path} is not a lexicon")
        _, self.root, arcs, states, pool = header[:5].tolist()
        whole = np.memmap(path, np.uint8, "r")
        at = header.nbytes

        def part(kind: str, n: int) -> np.ndarray:
            nonlocal at
            view = whole[at : at + n * np.dtype(kind).itemsize].view(kind)
            at += view.nbytes
            return view

        self.keys = part("<i8", arcs)
        self.targets, self.starts, self.sizes = (part("<i4", arcs) for _ in range(3))
        self.ends, self.end_starts, self.end_sizes = (part("<i4", states) for _ in range(3))
        self.pool = part("<i4", pool)

    def look_up(self, blob: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For the words blob[start:stop]: whether each is known, how many ids it has, and all known words' ids in order."""
        n = len(starts)
        lengths = stops - starts
        known = np.zeros(n, bool)
        state = np.full(n, self.root, np.int64)
        # slices of the pool met so far: (word, step, start, size)
        of, first, size = [], [], []
        alive = np.arange(n)
        step = 0
        while len(alive):
            done = lengths[alive] == step
            if done.any():
                here = alive[done]
                here = here[self.ends[state[here]] > 0] if len(self.ends) else here[:0]
                known[here] = True
                s = state[here]
                of.append(here)
                first.append(self.end_starts[s])
                size.append(self.end_sizes[s])
                alive = alive[~done]
            if not len(alive) or not len(self.keys):
                break
            wanted = state[alive] << 8 | blob[starts[alive] + step]
            at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
            hit = self.keys[at] == wanted
            alive, at = alive[hit], at[hit]
            state[alive] = self.targets[at]
            out = self.sizes[at]
            some = out > 0
            of.append(alive[some])
            first.append(self.starts[at[some]])
            size.append(out[some])
            step += 1
        counts = np.zeros(n, np.int64)
        if not of:
            return known, counts, self.pool[:0]
        of, first, size = np.concatenate(of), np.concatenate(first).astype(np.int64), np.concatenate(size).astype(np.int64)
        keep = known[of]
        of, first, size = of[keep], first[keep], size[keep]
        order = np.argsort(of, kind="stable")  # steps come in order, so each word's slices do
        of, first, size = of[order], first[order], size[order]
        np.add.at(counts, of, size)
        ends = np.cumsum(size)
        total = int(ends[-1]) if len(ends) else 0
        return known, counts, self.pool[np.repeat(first - ends + size, size) + np.arange(total)]


@cache
def opened(path: str) -> Lexicon:
    """One mapping per worker and file."""
    return Lexicon(path)
