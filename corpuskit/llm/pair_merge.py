"""Byte pair merging of many short byte strings at once."""

from __future__ import annotations

import base64
import heapq
import json
from collections.abc import Sequence

import numpy as np

# Strings above this length are merged one by one with a heap.
LONG = 128

_NEVER = np.int64(1) << 62


class PairMerger:
    """Merges the adjacent pair of the lowest rank, leftmost first, until none is known.

    `pairs` maps (left id, right id) to (rank, merged id); `byte_ids` are the ids
    of the 256 bytes; `whole` maps byte strings that are tokens themselves to
    their ids, if such strings are not to be merged at all.
    """

    def __init__(self, pairs: dict, byte_ids: Sequence[int], whole: dict[bytes, int] | None = None):
        self.pairs, self.whole = pairs, whole or {}
        self.byte_ids = np.array(byte_ids, np.int64)
        keys = np.array([a << 32 | b for a, b in pairs], np.int64)
        order = np.argsort(keys)
        self._keys = np.append(keys[order], np.iinfo(np.int64).max)
        self._ranks = np.append(np.array([r for r, _ in pairs.values()], np.int64)[order], _NEVER)
        self._merged = np.append(np.array([m for _, m in pairs.values()], np.int64)[order], -1)

    def _look_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = left << 32 | right
        at = np.searchsorted(self._keys, key)
        known = self._keys[at] == key
        return np.where(known, self._ranks[at], _NEVER), self._merged[at]

    def encode(self, pieces: Sequence[bytes]) -> list[bytes]:
        """The ids of each piece as little-endian 32-bit integers."""
        out: list[bytes | None] = [None] * len(pieces)
        short = []
        for i, piece in enumerate(pieces):
            if (token := self.whole.get(piece)) is not None:
                out[i] = token.to_bytes(4, "little")
            elif len(piece) > LONG:
                out[i] = np.array(self._one(piece), "<i4").tobytes()
            else:
                short.append(i)
        for i, ids in zip(short, self._many([pieces[i] for i in short]), strict=True):
            out[i] = ids
        return out

    def _many(self, pieces: list[bytes]) -> list[bytes]:
        """One merge per piece and round, all pieces side by side."""
        n = len(pieces)
        result = [b""] * n
        lengths = np.fromiter(map(len, pieces), np.int64, n)
        ids = self.byte_ids[np.frombuffer(b"".join(pieces), np.uint8)]
        of = np.repeat(np.arange(n), lengths)
        rank, merged = np.full(len(ids), _NEVER), np.zeros(len(ids), np.int64)

        def refresh(at: np.ndarray) -> None:
            """Look the pairs that begin at these positions up again."""
            inner = at[at + 1 < len(ids)]
            rank[at] = _NEVER
            inner = inner[of[inner] == of[inner + 1]]
            rank[inner], merged[inner] = self._look_up(ids[inner], ids[inner + 1])

        refresh(np.arange(len(ids)))
        while len(ids):
            first = np.flatnonzero(np.diff(of, prepend=-1))
            best = np.minimum.reduceat(rank, first)
            sizes = np.diff(first, append=len(ids))
            done = best == _NEVER
            if done.any():
                finished = np.repeat(done, sizes)
                packed = ids[finished].astype("<i4").tobytes()
                stops = np.cumsum(sizes[done]) * 4
                start = 0
                for i, stop in zip(of[first[done]].tolist(), stops.tolist(), strict=True):
                    result[i] = packed[start:stop]
                    start = stop
                keep = ~finished
                ids, of, rank, merged = ids[keep], of[keep], rank[keep], merged[keep]
                best, sizes = best[~done], sizes[~done]
                if not len(ids):
                    break
            lowest = np.flatnonzero(rank == np.repeat(best, sizes))
            at = lowest[np.diff(of[lowest], prepend=-1) != 0]
            ids[at] = merged[at]
            keep = np.ones(len(ids), bool)
            keep[at + 1] = False
            ids, of, rank, merged = ids[keep], of[keep], rank[keep], merged[keep]
            now = at - np.arange(len(at))
            refresh(np.unique(np.concatenate([now, now[now > 0] - 1])))
        return result

    def _one(self, piece: bytes) -> list[int]:
        """A heap of pairs over a linked list, n log n in the length."""
        ids = self.byte_ids[np.frombuffer(piece, np.uint8)].tolist()
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(self.pairs[p][0], i, p) for i in range(n - 1) if (p := (ids[i], ids[i + 1])) in self.pairs]
        heapq.heapify(heap)
        while heap:
            _, i, pair = heapq.heappop(heap)
            j = after[i] if ids[i] is not None else n
            if j >= n or (ids[i], ids[j]) != pair:
                continue  # one of the two has been merged meanwhile
            ids[i], ids[j] = self.pairs[pair][1], None
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b < n and (p := (ids[a], ids[b])) in self.pairs:
                    heapq.heappush(heap, (self.pairs[p][0], a, p))
        return [x for x in ids if x is not None]


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ranks of a file with a base64 token and its rank per line."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


def from_ranks(ranks: dict[bytes, int]) -> PairMerger:
    """Merging by the rank of the merged bytes, whichever two tokens they come from."""
    pairs = {
        (ranks[token[:i]], ranks[token[i:]]): (rank, rank)
        for token, rank in ranks.items()
        for i in range(1, len(token))
        if token[:i] in ranks and token[i:] in ranks
    }
    return PairMerger(pairs, [ranks[bytes([b])] for b in range(256)], ranks)


def byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level vocabularies.

    Printable bytes stand for themselves, the others for letters from U+0100 on.
    """
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    letters, extra = [], 0x100
    for b in range(256):
        letters.append(chr(b if b in printable else extra))
        extra += b not in printable
    return letters


def from_json(path: str) -> PairMerger:
    """Merging by the list of merges of a tokenizer file."""
    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    vocab, pairs = model["vocab"], {}
    for rank, merge in enumerate(model["merges"]):
        left, right = merge.split(" ") if isinstance(merge, str) else merge
        pairs[vocab[left], vocab[right]] = (rank, vocab[left + right])
    return PairMerger(pairs, [vocab[c] for c in byte_letters()])
