"""Token counts by a two-tier lookup: a broadcast table of frequent pre-tokens, then worker caches."""

from __future__ import annotations

import json
import uuid
from collections import Counter
from collections.abc import Iterable, Iterator, Sequence
from functools import cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans.tables import load
from .pair_merge import PairMerger, byte_letters, from_json
from .pretokens import boundaries, chunks
from .recent import Recent
from .slices import distinct, per_text
from .workers import map_arrow

# Pre-tokens in the broadcast table, and the longest of them: at most 2.5 MB.
FREQUENT = 1 << 15
FREQUENT_BYTES = 64

# Pre-tokens that a task's summary may hold; what it counts less often than about
# one in so many pre-tokens can be missing from it.
SUMMARY = 1 << 13

# Pre-tokens whose counts a worker keeps besides.
CACHED = 400_000
CACHED_LENGTH = 64


@cache
def _special(path: str) -> tuple[str, ...]:
    """The strings that the file makes one token wherever they are."""
    with open(path, encoding="utf-8") as f:
        return tuple(t["content"] for t in json.load(f)["added_tokens"])


@cache
def _merger(path: str) -> PairMerger:
    return from_json(path)


def _segments(texts: Sequence[str], special: Sequence[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The texts cut at special strings, the number of segments of each, and of special strings."""
    parts, n_parts = [], []
    for text in texts:
        own = [text]
        for s in special:
            if s in text:
                own = [x for segment in own for x in segment.split(s)]
        parts += own
        n_parts.append(len(own))
    n = np.array(n_parts, np.int64)
    return parts, n, n - 1


class Counting:
    """Token counts of texts for one worker."""

    def __init__(self, path: str, frequent: dict[str, int], cached: int = CACHED):
        self.path, self.frequent = path, frequent
        self.kept = Recent(cached, CACHED_LENGTH)

    def _merged(self, pieces: list[str]) -> list[int]:
        return [len(ids) // 4 for ids in _merger(self.path).encode([p.encode() for p in pieces])]

    def _lengths(self, pieces: Sequence[str]) -> np.ndarray:
        out = np.array([n or 0 for n in map(self.frequent.get, pieces)], np.int64)
        at = np.flatnonzero(out == 0)
        if len(at):
            out[at] = self.kept.look_up([pieces[i] for i in at.tolist()], self._merged)
        return out

    def count(self, texts: Sequence[str]) -> np.ndarray:
        parts, n_parts, n_special = _segments(texts, _special(self.path))
        blob, starts, stops, n_pieces = boundaries(parts)
        codes, pieces = distinct(blob, starts, stops)
        return per_text(per_text(self._lengths(pieces)[codes], n_pieces), n_parts) + n_special


# A worker's counter for the last broadcast table it has seen of each vocabulary.
_kept: dict[str, tuple[str, Counting]] = {}


def _counting(path: str, tag: str, table: Broadcast) -> Counting:
    if path not in _kept or _kept[path][0] != tag:
        blob, lengths, counts = table.value
        stops = np.cumsum(lengths).tolist()
        frequent, start = {}, 0
        for stop, n in zip(stops, counts.tolist(), strict=True):
            frequent[blob[start:stop].decode()] = n
            start = stop
        _kept[path] = (tag, Counting(path, frequent))
    return _kept[path][1]


def frequent_pretokens(
    df: DataFrame, text: str = "text", path: str | None = None, size: int = FREQUENT, summary: int = SUMMARY
) -> DataFrame:
    """(piece, n): at most `size` frequent pre-tokens of all texts, with lower bounds of their counts.

    Each task goes through all its texts and keeps at most `summary` counters:
    beyond them, the count of the first one left out is taken off all. Only these
    summaries are shuffled, whatever the size of the texts.
    """
    path = path or public_tokenizers.path("byte_bpe_50k.json")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[str] = Counter()
        for batch in batches:
            for _, _, texts in chunks(batch.column(0)):
                parts, _, _ = _segments(texts, _special(path))
                blob, starts, stops, _ = boundaries(parts)
                codes, pieces = distinct(blob, starts, stops)
                total.update(dict(zip(pieces, np.bincount(codes, minlength=len(pieces)).tolist(), strict=True)))
                if len(total) > 8 * summary:
                    total = _shortened(total, summary)
        total = _shortened(total, summary)
        kept = [(p, n) for p, n in total.items() if n > 1 and len(p.encode()) <= FREQUENT_BYTES]
        yield pa.RecordBatch.from_arrays(
            [pa.array([p for p, _ in kept], pa.string()), pa.array([n for _, n in kept], pa.int64())], ["piece", "n"]
        )

    found = map_arrow(df.select(text), run, T.StructType().add("piece", "string").add("n", "long"))
    return found.groupBy("piece").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "piece").limit(size)


def _shortened(total: Counter, size: int) -> Counter:
    if len(total) <= size:
        return total
    first = total.most_common(size + 1)
    off = first[-1][1]
    return Counter({p: n - off for p, n in first[:-1] if n > off})


@cache
def vocabulary_pretokens(path: str, size: int = FREQUENT) -> tuple[str, ...]:
    """At most `size` tokens of the file that are a pre-token each, of the lowest ids.

    Merges were numbered by how often their pairs occurred when the vocabulary was
    made, so these are the pre-tokens that texts like those have most often.
    """
    byte = {letter: b for b, letter in enumerate(byte_letters())}
    with open(path, encoding="utf-8") as f:
        vocab = json.load(f)["model"]["vocab"]
    found = []
    for token in sorted(vocab, key=vocab.get):
        if all(c in byte for c in token) and 0 < len(token) <= FREQUENT_BYTES:
            try:
                found.append(bytes(byte[c] for c in token).decode())
            except UnicodeDecodeError:  # a part of a character is in no pre-token by itself
                continue
    _, _, _, n_pieces = boundaries(found)
    return tuple(p for p, n in zip(found, n_pieces.tolist(), strict=True) if n == 1)[:size]


def count_tokens(df: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """(key, n_bytes, n_tokens): the length of each text in UTF-8 bytes and in tokens of the file at `path`.

    One pass without a shuffle. The token counts of the pre-tokens that the
    vocabulary itself has (`vocabulary_pretokens`) are broadcast, at most
    `FREQUENT` of at most `FREQUENT_BYTES` bytes; each pre-token is looked up
    there, then in the worker's cache, and merged if it is in neither. The counts
    don't depend on what the table holds. Special strings of the file count as one
    token wherever they are. Null counts as empty, rows may repeat, an empty table
    gives no rows, other columns play no part.
    """
    spark = df.sparkSession
    path = path or public_tokenizers.path("byte_bpe_50k.json")
    encoded = [p.encode() for p in vocabulary_pretokens(path)]
    counts = np.array([len(ids) // 4 for ids in _merger(path).encode(encoded)], np.uint8)
    lengths = np.array([len(p) for p in encoded], np.uint8)
    tag = uuid.uuid4().hex
    table = spark.sparkContext.broadcast((b"".join(encoded), lengths, counts))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _counting(path, tag, table)
        for batch in batches:
            tokens = [own.count(texts) for _, _, texts in chunks(batch.column(1))]
            n_tokens = np.concatenate(tokens) if tokens else np.zeros(0, np.int64)
            n_bytes = pc.fill_null(pc.binary_length(batch.column(1)), 0).cast(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), n_bytes, pa.array(n_tokens, pa.int64())], [key, "n_bytes", "n_tokens"]
            )

    schema = T.StructType([df.schema[key]]).add("n_bytes", "long").add("n_tokens", "long")
    return map_arrow(df.select(key, text), run, schema)


def op8_token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's length in bytes and tokens, and whether it exceeds 1024 tokens."""
    counted = count_tokens(load(spark, sf_dir, "documents"))
    return counted.withColumn("over_limit", F.col("n_tokens") > 1024)


QUERIES = {"op8_token_count": op8_token_count}
ORACLES: dict[str, str] = {}
