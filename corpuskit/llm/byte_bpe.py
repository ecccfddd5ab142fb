"""Byte-level BPE encoding and decoding."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from functools import cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans.tables import load
from .pair_merge import PairMerger, from_ranks, read_ranks
from .pretokens import boundaries, chunks
from .recent import Recent
from .slices import distinct, joined, per_text
from .workers import map_arrow

# Pre-tokens whose ids a worker keeps.
CACHED = 300_000

# Longer pre-tokens are rare and not kept.
CACHED_LENGTH = 64


class Encoder:
    """Ids of texts, with the ids of pre-tokens that occurred before kept in memory."""

    def __init__(self, merger: PairMerger, cached: int = CACHED):
        self.merger = merger
        self.kept = Recent(cached, CACHED_LENGTH)

    def _merged(self, pieces: list[str]) -> list[bytes]:
        return self.merger.encode([p.encode() for p in pieces])

    def encode(self, texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after another, and where each text's ids end."""
        blob, starts, stops, n_pieces = boundaries(texts)
        codes, pieces = distinct(blob, starts, stops)
        ids, counts = joined(codes, self.kept.look_up(pieces, self._merged))
        return ids.view("<i4"), np.cumsum(per_text(counts, n_pieces))


@cache
def encoder(path: str) -> Encoder:
    """One encoder per worker and vocabulary."""
    return Encoder(from_ranks(read_ranks(path)))


@cache
def _token_bytes(path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All tokens' bytes one after another, and each id's first byte and length."""
    ranks = read_ranks(path)
    tokens = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        tokens[rank] = token
    lengths = np.fromiter(map(len, tokens), np.int64, len(tokens))
    return np.frombuffer(b"".join(tokens), np.uint8), np.cumsum(lengths) - lengths, lengths


def _list_array(values: np.ndarray, stops: np.ndarray) -> pa.Array:
    offsets = np.concatenate([[0], stops]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


def encode(df: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """(key, ids, offsets): the token ids of each text and the byte in the text at which each token begins.

    Each text is cut into pre-tokens and each pre-token merged by the ranks of
    the file at `path`, without special tokens. Null and empty texts have no
    ids; rows may repeat; other columns play no part. Texts are worked on about
    half a megabyte at a time, a longer text alone.
    """
    path = path or public_tokenizers.path("byte_bpe_50k.tiktoken")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path)
        _, _, lengths = _token_bytes(path)
        for batch in batches:
            for a, b, texts in chunks(batch.column(1)):
                ids, stops = own.encode(texts)
                sizes = lengths[ids]
                begins = np.cumsum(sizes) - sizes
                counts = np.diff(stops, prepend=0)
                firsts = np.concatenate([begins, [0]])[np.minimum(stops - counts, len(begins))]
                offsets = (begins - np.repeat(firsts, counts)).astype(np.int32)
                columns = [batch.column(0).slice(a, b - a), _list_array(ids, stops), _list_array(offsets, stops)]
                yield pa.RecordBatch.from_arrays(columns, [key, "ids", "offsets"])

    schema = T.StructType(
        [
            T.StructField(key, df.schema[key].dataType),
            T.StructField("ids", T.ArrayType(T.IntegerType())),
            T.StructField("offsets", T.ArrayType(T.IntegerType())),
        ]
    )
    return map_arrow(df.select(key, text), run, schema)


def decode(df: DataFrame, keep: Sequence[str], path: str | None = None) -> DataFrame:
    """The columns `keep` and `bytes`, the bytes that `ids` stand for, each token put at its place in `offsets`.

    Null ids count as none and give no bytes.
    """
    path = path or public_tokenizers.path("byte_bpe_50k.tiktoken")
    keep = list(keep)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pool, first, lengths = _token_bytes(path)
        for batch in batches:
            counts = np.array([x or 0 for x in pc.list_value_length(batch.column("ids")).to_pylist()], np.int64)
            stops = np.cumsum(counts)
            a = 0
            while a < len(counts):
                base = stops[a] - counts[a]
                b = max(a + 1, int(np.searchsorted(stops, base + (1 << 18), "right")))
                part = batch.slice(a, b - a)
                ids = part.column("ids").flatten().to_numpy(zero_copy_only=False)
                sizes = lengths[ids]
                at = part.column("offsets").flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                ends = np.cumsum(sizes)
                text_stops = np.concatenate([[0], ends])[stops[a:b] - base]
                text_starts = np.concatenate([[0], text_stops[:-1]])
                place = at + np.repeat(text_starts, counts[a:b])
                total = int(ends[-1]) if len(ends) else 0
                out = np.empty(total, np.uint8)
                within = np.arange(total) - np.repeat(ends - sizes, sizes)
                out[np.repeat(place, sizes) + within] = pool[np.repeat(first[ids], sizes) + within]
                offsets = np.concatenate([[0], text_stops]).astype(np.int32)
                made = pa.BinaryArray.from_buffers(pa.binary(), b - a, [None, pa.py_buffer(offsets), pa.py_buffer(out)])
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), made], [*keep, "bytes"])
                a = b

    schema = T.StructType([df.schema[c] for c in keep] + [T.StructField("bytes", T.BinaryType())])
    return map_arrow(df.select(*dict.fromkeys([*keep, "ids", "offsets"])), run, schema)


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ids of every document and the bytes that they decode to, as digests."""
    encoded = encode(load(spark, sf_dir, "documents"))
    ids = F.array_join(F.col("ids").cast("array<string>"), " ")
    described = encoded.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(ids.cast("binary"), 256).alias("ids_sha256"),
        "ids",
        "offsets",
    )
    decoded = decode(described, ["doc_id", "n_tokens", "ids_sha256"])
    return decoded.select("doc_id", "n_tokens", "ids_sha256", F.sha2("bytes", 256).alias("decoded_sha256"))


QUERIES = {"op4_byte_bpe": op4_byte_bpe}
ORACLES: dict[str, str] = {}
