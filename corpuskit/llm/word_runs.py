"""Periodic runs of words, found with a suffix automaton and link-cut access.

A suffix automaton is built word by word. Its suffix links form a tree kept as a
link-cut tree, whose preferred paths are those whose nodes were last met at the
same place. A word appended at i accesses the path from its node to the root:
each part of the path that was last met at j and whose deepest node stands for m
words says that exactly m words before i equal those before j. With i - j <= m
that is a square of period i - j, and the run around it is what is left when it
is followed to the right. The whole path then counts as last met at i.

The period is the smallest one: were it a multiple of a smaller one, the same
words would have been met later than j. A root of length q that isn't a
repetition itself occurs in its square at both ends only, so every square is met.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans.tables import load
from .pretokens import chunks
from .slices import distinct
from .workers import map_arrow

Run = tuple[int, int, int]

# The bytes between words, [\x20\x09-\x0D].
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_WORD_BREAKS = r"[ \t\n\x0B\f\r]+"

_MULTIPLIER = 0x9E3779B97F4A7C15


class RunFinder:
    """Online search for squares in one sequence of integers."""

    def __init__(self, words: Sequence[int]):
        self.words = words
        # automaton: transitions, longest length and suffix link of each state
        self.go: list[dict[int, int]] = [{}]
        self.length, self.suffix = [0], [-1]
        # link-cut tree: splay trees of paths, deeper nodes to the right; `last`
        # of a splay tree's root is where all nodes of the path were last met
        self.left, self.right, self.up, self.last = [-1], [-1], [-1], [-1]

    def _new(self, length: int, last: int) -> int:
        self.length.append(length)
        self.left.append(-1)
        self.right.append(-1)
        self.up.append(-1)
        self.last.append(last)
        return len(self.length) - 1

    def _splay(self, x: int) -> None:
        """Make x the root of its path's splay tree."""
        left, right, up = self.left, self.right, self.up
        while True:
            p = up[x]
            if p < 0:
                break
            on_left = left[p] == x
            if not on_left and right[p] != x:
                break
            g = up[p]
            inner = g >= 0 and (left[g] == p or right[g] == p)
            turns = (p, x) if inner and (left[g] == p) == on_left else (x, x)
            for y in turns if inner else (x,):
                p = up[y]
                g = up[p]
                if left[p] == y:
                    c = right[y]
                    left[p] = c
                    right[y] = p
                else:
                    c = left[y]
                    right[p] = c
                    left[y] = p
                if c >= 0:
                    up[c] = p
                up[p] = y
                up[y] = g
                if g >= 0:
                    if left[g] == p:
                        left[g] = y
                    elif right[g] == p:
                        right[g] = y
                    else:
                        self.last[y] = self.last[p]
                else:
                    self.last[y] = self.last[p]

    def _append(self, i: int, state: int) -> int:
        """The state of the first i + 1 words, given that of the first i."""
        word, go, length, suffix = self.words[i], self.go, self.length, self.suffix
        new = self._new(length[state] + 1, i)
        go.append({})
        suffix.append(0)
        while state >= 0 and word not in go[state]:
            go[state][word] = new
            state = suffix[state]
        if state >= 0:
            old = go[state][word]
            if length[state] + 1 == length[old]:
                suffix[new] = old
            else:
                suffix[new] = self._split(old, length[state] + 1)
                clone = suffix[new]
                while state >= 0 and go[state].get(word) == old:
                    go[state][word] = clone
                    state = suffix[state]
        self.up[new] = suffix[new]
        return new

    def _split(self, old: int, length: int) -> int:
        """A node between `old` and the node above it, on the same path, since it was last met with it."""
        self._splay(old)
        clone = self._new(length, -1)
        self.go.append(dict(self.go[old]))
        self.suffix.append(self.suffix[old])
        self.suffix[old] = clone
        above = self.left[old]
        self.left[clone] = above
        if above >= 0:
            self.up[above] = clone
        self.left[old], self.up[clone] = clone, old
        return clone

    def squares(self) -> Iterator[tuple[int, int, int]]:
        """(i, period, equal): the `equal` words up to i are those up to i - period, no more; period <= equal."""
        left, right, up, last, length = self.left, self.right, self.up, self.last, self.length
        state = 0
        for i in range(len(self.words)):
            state = self._append(i, state)
            below, x = -1, state
            while x >= 0:
                self._splay(x)
                deeper, met = right[x], last[x]
                if 0 <= met < i and i - met <= length[x]:
                    yield i, i - met, length[x]
                if deeper >= 0:
                    last[deeper] = met
                right[x] = below
                if below >= 0:
                    up[below] = x
                below, x = x, up[x]
            last[below] = i
            self._splay(state)


def runs_of(words: Sequence[int], min_length: int = 24, min_exponent: float = 3) -> list[Run]:
    """(start, length, period) of all maximal runs, by start and period.

    A run is followed to its end once; squares met inside it later are skipped.
    """
    array = np.asarray(words)
    n, ends, runs = len(words), {}, []
    for i, period, equal in RunFinder(words).squares():
        if ends.get(period, -1) >= i:
            continue
        end, step = i + 1, 64
        while end < n:
            stop = min(n, end + step)
            other = np.flatnonzero(array[end:stop] != array[end - period : stop - period])
            if len(other):
                end += int(other[0])
                break
            end, step = stop, step * 2
        ends[period] = end - 1
        start = i - equal - period + 1
        if end - start >= max(min_length, min_exponent * period):
            runs.append((start, end - start, period))
    return sorted(runs, key=lambda r: (r[0], r[2]))


def _grams(codes: np.ndarray, g: int) -> np.ndarray:
    """A hash of every g consecutive integers, put together from hashes of 1, 2, 4, .. of them."""
    x = (codes.astype(np.uint64) + np.uint64(1)) * np.uint64(_MULTIPLIER)
    block = (x ^ (x >> np.uint64(29))) * np.uint64(_MULTIPLIER)
    width, factor = 1, _MULTIPLIER
    made, covered, power = np.zeros(len(codes) + 1, np.uint64), 0, 1
    while True:
        if g & width:
            n = len(codes) - covered - width + 1
            made = made[:n] + np.uint64(power) * block[covered : covered + n]
            covered, power = covered + width, power * factor % (1 << 64)
        if 2 * width > g:
            return made
        block = block[:-width] + np.uint64(factor) * block[width:]
        width, factor = 2 * width, factor * factor % (1 << 64)


def stretches(
    codes: np.ndarray, counts: np.ndarray, min_length: int = 24, min_exponent: float = 3
) -> Iterator[tuple[int, int, int]]:
    """(sequence, first, last): parts of the sequences outside which no run can be.

    `codes` are the sequences' words one after another, `counts` their lengths.
    In a run of length n and period q, n - q >= n (1 - 1 / exponent) words equal
    those q before. So with g = min_length (1 - 1 / exponent) each word lies in g
    words that the run repeats at a distance of at most n / exponent, and n is at
    most the length of the stretch of such words. Equal hashes of different words
    only make stretches longer.
    """
    g = max(1, math.ceil(min_length * (1 - 1 / min_exponent)))
    n = len(codes)
    if n <= g:
        return
    sequence = np.repeat(np.arange(len(counts)), counts)
    grams = _grams(codes, g)
    at = np.flatnonzero(sequence[: n - g + 1] == sequence[g - 1 :])
    keys = grams[at] + sequence[at].astype(np.uint64) * np.uint64(_MULTIPLIER)
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    gaps = np.where(same, at[order][1:] - at[order][:-1], n)
    distance = np.full(len(at), n)
    distance[order[1:]] = gaps
    distance[order[:-1]] = np.minimum(distance[order[:-1]], gaps)
    keep = distance < n
    at, distance = at[keep], distance[keep]
    while len(at):
        # places whose g words overlap or touch, in the same sequence, form a stretch
        fresh = (np.diff(at, prepend=-n - g) > g) | (np.diff(sequence[at], prepend=-1) != 0)
        number = np.cumsum(fresh) - 1
        first = at[fresh]
        last = np.append(at[np.flatnonzero(fresh)[1:] - 1], at[-1]) + g
        size = last - first
        possible = (size >= min_length)[number] & (distance * min_exponent <= size[number])
        if possible.all():
            for a, b in zip(first.tolist(), last.tolist(), strict=True):
                yield int(sequence[a]), a, b
            return
        at, distance = at[possible], distance[possible]


def _words(texts: Sequence[bytes]) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    """All texts as one byte string, the first and last byte of every word, and how many each text has."""
    blob = b"\n".join([*texts, b""])
    space = _SPACE[np.frombuffer(blob, np.uint8)]
    edges = np.flatnonzero(np.diff(space, prepend=True))
    starts, stops = edges[::2], edges[1::2]
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    return blob, starts, stops, np.diff(np.searchsorted(starts, np.cumsum(lengths + 1)), prepend=0)


def _covered(n: int, runs: Sequence[Run]) -> np.ndarray:
    """Which words lie in a run after its first period."""
    change = np.zeros(n + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return np.cumsum(change[:n]) > 0


RUNS = T.ArrayType(
    T.StructType([T.StructField(c, T.LongType(), False) for c in ("start", "length", "period")]), False
)


def periodic_runs(
    df: DataFrame, key: str = "doc_id", text: str = "text", min_length: int = 24, min_exponent: float = 3
) -> DataFrame:
    """(key, n_words, runs, collapsed): the runs of repeated words in each text, and the text without repetitions.

    A run is a longest stretch of at least `min_length` words that repeats with
    a smallest period of at most a `min_exponent`-th of its length (2 or more);
    `runs` holds (start, length, period), counted in words from 0, by start and
    period. `collapsed` has each run's first period only, words joined by one
    blank. Words are what lies between [\\x20\\x09-\\x0D].

    No shuffle: each text is searched where it is read, about half a megabyte at
    a time, a longer text alone. Only stretches that can hold a run go into the
    automaton (see `stretches`). Null and empty texts have no words and no runs;
    rows may repeat and keys may be null; other columns play no part.
    """
    if min_exponent < 2 or min_length < 2:
        raise ValueError("runs have at least two words and two periods")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, texts in chunks(batch.column(1)):
                encoded = [t.encode() for t in texts]
                blob, starts, stops, counts = _words(encoded)
                codes, _ = distinct(blob, starts, stops)
                begins = np.cumsum(counts) - counts
                found: list[list[Run]] = [[] for _ in texts]
                for i, first, last in stretches(codes, counts, min_length, min_exponent):
                    shift = first - int(begins[i])
                    own = runs_of(codes[first:last].tolist(), min_length, min_exponent)
                    found[i] += [(start + shift, length, period) for start, length, period in own]
                collapsed = []
                for t, runs, n in zip(encoded, found, counts.tolist(), strict=True):
                    words = t.split()
                    if runs:
                        words = [w for w, c in zip(words, _covered(n, runs).tolist(), strict=True) if not c]
                    collapsed.append(b" ".join(words))
                flat = [r for runs in found for r in runs]
                offsets = np.cumsum([0, *map(len, found)]).astype(np.int32)
                fields = [pa.array([r[c] for r in flat], pa.int64()) for c in range(3)]
                struct = pa.StructArray.from_arrays(fields, fields=_FIELDS)
                lists = pa.ListArray.from_arrays(pa.array(offsets), struct, type=pa.list_(_ELEMENT))
                columns = [
                    batch.column(0).slice(a, b - a),
                    pa.array(counts, pa.int64()),
                    lists,
                    pa.array(collapsed, pa.binary()).cast(pa.string()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names)

    names = [key, "n_words", "runs", "collapsed"]
    schema = T.StructType(
        [T.StructField(key, df.schema[key].dataType)]
        + [T.StructField("n_words", T.LongType()), T.StructField("runs", RUNS), T.StructField("collapsed", T.StringType())]
    )
    return map_arrow(df.select(key, text), run, schema)


_FIELDS = [pa.field(c, pa.int64(), False) for c in ("start", "length", "period")]
_ELEMENT = pa.field("element", pa.struct(_FIELDS), False)


def with_repetitions(text: Column, key: Column) -> Column:
    """The text, for one key in ten with an end that repeats its own words, as the crc32 of the key says."""
    h = F.crc32(key.cast("string").cast("binary"))
    g = F.floor(h / 10)
    words = F.filter(F.split(F.coalesce(text, F.lit("")), _WORD_BREAKS), lambda w: w != "")
    whole = F.struct(words.alias("w"), g.alias("g"))

    def planted(x: Column) -> Column:
        w, n = x["w"], F.size(x["w"]).cast("bigint")
        start = x["g"] % n
        period = F.lit(1) + F.floor((n - start) / (F.lit(3) + x["g"] % 8))
        position = lambda i: F.when(i < start, i).otherwise(start + (i - start) % period)
        places = F.transform(F.sequence(F.lit(0).cast("bigint"), n - 1), position)
        return F.array_join(F.transform(places, lambda i: F.get(w, i.cast("int"))), " ")

    made = F.element_at(F.transform(F.array(whole), lambda x: F.when(F.size(x["w"]) > 0, planted(x))), 1)
    return F.when(h % 10 == 0, F.coalesce(made, text)).otherwise(text)


def _sha(x: Column) -> Column:
    return F.sha2(x.cast("binary"), 256)


def op13_word_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's runs as a digest, the one with the most periods, and a digest of the text without repetitions."""
    docs = load(spark, sf_dir, "documents")
    texts = docs.select("doc_id", with_repetitions(F.col("text"), F.col("doc_id")).alias("text"))
    found = periodic_runs(texts)
    # runs come by start and period, so the first of the highest exponent is the best
    best = F.aggregate(
        "runs",
        F.get("runs", F.lit(0)),
        lambda x, r: F.when(r["length"] * x["period"] > x["length"] * r["period"], r).otherwise(x),
    )
    line = lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    listed = F.array_join(F.transform("runs", lambda r: F.concat(line(r), F.lit("\n"))), "")
    return found.select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        best.alias("best"),
        _sha(listed).alias("runs_sha256"),
        _sha(F.col("collapsed")).alias("collapsed_sha256"),
    ).select(
        "doc_id",
        "n_runs",
        F.col("best.start").alias("start"),
        F.col("best.length").alias("length"),
        F.col("best.period").alias("period"),
        F.floor(F.lit(1000) * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        "runs_sha256",
        "collapsed_sha256",
    )


QUERIES = {"op13_word_runs": op13_word_runs}
ORACLES: dict[str, str] = {}
