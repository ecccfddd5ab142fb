"""BPE encoding by a lexicon of frequent words, and exact merging of all others."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterable, Iterator, Sequence
from functools import cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans.tables import load
from ..sources.state import state_dir
from .lexicon import compiled, opened
from .pair_merge import PairMerger, byte_letters, from_json
from .pretokens import boundaries, chunks
from .recent import Recent
from .slices import distinct, per_text
from .token_count import frequent_pretokens
from .workers import map_arrow

# Words in the lexicon, each at most 64 bytes long: a few MB at most.
WORDS = 1 << 15

# Unseen words whose ids a worker keeps.
CACHED = 200_000
CACHED_LENGTH = 64


@cache
def _merger(path: str) -> PairMerger:
    return from_json(path)


@cache
def _added(path: str) -> tuple[tuple[str, int], ...]:
    """The strings that the file makes one token wherever they are, and their ids."""
    with open(path, encoding="utf-8") as f:
        return tuple((t["content"], t["id"]) for t in json.load(f)["added_tokens"])


@cache
def _token_bytes(path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All tokens' bytes one after another, and each id's first byte and length."""
    value = {letter: bytes([b]) for b, letter in enumerate(byte_letters())}
    with open(path, encoding="utf-8") as f:
        vocab = json.load(f)["model"]["vocab"]
    tokens = [b""] * (1 + max(*vocab.values(), *(i for _, i in _added(path)), 0))
    for token, i in vocab.items():
        tokens[i] = b"".join(value.get(c, c.encode()) for c in token)
    for content, i in _added(path):
        tokens[i] = content.encode()
    lengths = np.fromiter(map(len, tokens), np.int64, len(tokens))
    return np.frombuffer(b"".join(tokens), np.uint8), np.cumsum(lengths) - lengths, lengths


def _gathered(pool: np.ndarray, first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The slices pool[first:first + size] one after another."""
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    return pool[np.repeat(first - ends + sizes, sizes) + np.arange(total)]


class Encoder:
    """Ids of texts, from a lexicon where it has the word, else merged and kept for a while."""

    def __init__(self, path: str, lexicon: str, cached: int = CACHED):
        self.path, self.lexicon = path, opened(lexicon)
        self.kept = Recent(cached, CACHED_LENGTH)

    def _merged(self, words: list[str]) -> list[bytes]:
        return _merger(self.path).encode([w.encode() for w in words])

    def _plain(self, texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of texts without special strings, and how many each text has."""
        blob, starts, stops, n_words = boundaries(texts)
        codes, words = distinct(blob, starts, stops)
        encoded = [w.encode() for w in words]
        sizes = np.fromiter(map(len, encoded), np.int64, len(encoded))
        ends = np.cumsum(sizes)
        known, counts, ids = self.lexicon.look_up(np.frombuffer(b"".join(encoded), np.uint8), ends - sizes, ends)
        unseen = np.flatnonzero(~known)
        made = self.kept.look_up([words[i] for i in unseen.tolist()], self._merged)
        counts[unseen] = np.fromiter(map(len, made), np.int64, len(made)) // 4
        first = np.empty(len(words), np.int64)
        first[known] = np.cumsum(counts[known]) - counts[known]
        first[unseen] = len(ids) + np.cumsum(counts[unseen]) - counts[unseen]
        pool = np.concatenate([ids, np.frombuffer(b"".join(made), "<i4")])
        per_word = counts[codes]
        return _gathered(pool, first[codes], per_word), per_text(per_word, n_words)

    def encode(self, texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after another, and how many each text has."""
        added = _added(self.path)
        if not any(content in t for content, _ in added for t in texts):
            return self._plain(texts)
        # special strings are ids of their own; what is between them is encoded by itself
        parts, of, special = [], [], []
        for i, text in enumerate(texts):
            for part, token in _split(text, added):
                parts.append(part)
                of.append(i)
                special.append(token)
        ids, counts = self._plain(parts)
        ids = np.insert(ids, np.repeat(np.cumsum(counts), [t >= 0 for t in special]), [t for t in special if t >= 0])
        total = np.zeros(len(texts), np.int64)
        np.add.at(total, of, counts + (np.array(special) >= 0))
        return ids.astype("<i4"), total


def _split(text: str, added: Sequence[tuple[str, int]]) -> Iterator[tuple[str, int]]:
    """(part, id of the special string after it or -1); of special strings at one place the longest."""
    at = 0
    while True:
        found = [(p, -len(c), i) for c, i in added if c and (p := text.find(c, at)) >= 0]
        if not found:
            yield text[at:], -1
            return
        place, size, token = min(found)
        yield text[at:place], token
        at = place - size


@cache
def _encoder(path: str, lexicon: str) -> Encoder:
    """One encoder per worker, vocabulary and lexicon."""
    return Encoder(path, lexicon)


_handed_out: set[tuple[str, str]] = set()


def _hand_out(spark: SparkSession, data: bytes) -> str:
    """Write a lexicon to the shared folder and let Spark give it to every executor; its name there."""
    name = f"lexicon-{hashlib.sha256(data).hexdigest()}.bin"
    context = spark.sparkContext
    if (context.applicationId, name) not in _handed_out:
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{state_dir(spark)}/lexicons", name)
        store = path.getFileSystem(context._jsc.hadoopConfiguration())
        out = store.create(path)
        out.write(data)
        out.close()
        context.addFile(store.makeQualified(path).toString())
        _handed_out.add((context.applicationId, name))
    return name


def build_lexicon(words: Sequence[str], path: str) -> bytes:
    """A lexicon of these words with their ids by the tokenizer file at `path`."""
    encoded = sorted({w.encode() for w in words if w})
    ids = [np.frombuffer(x, "<i4").tolist() for x in _merger(path).encode(encoded)]
    return compiled(encoded, ids)


def encode(
    df: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None, words: int = WORDS
) -> DataFrame:
    """(key, n_tokens, ids): the token ids of each text as little-endian 32-bit integers.

    A first pass finds at most `words` frequent words of all texts from bounded
    summaries of the tasks; they are compiled into a lexicon (see `lexicon`), a
    file of a few MB that Spark hands to every executor and its workers map into
    memory. The second pass walks the lexicon for each word and merges by the
    tokenizer file at `path` what isn't in it; the ids don't depend on what is.
    Special strings of the file are one id wherever they are.

    Null and empty texts have no ids; rows may repeat and keys may be null; other
    columns play no part. About half a megabyte of text is worked on at a time, a
    longer text alone. An executor that is replaced gets the file again.
    """
    spark = df.sparkSession
    path = path or public_tokenizers.path("byte_bpe_50k.json")
    frequent = [r["piece"] for r in frequent_pretokens(df, text, path, words).collect()]
    name = _hand_out(spark, build_lexicon(frequent, path))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _encoder(path, SparkFiles.get(name))
        for batch in batches:
            for a, b, texts in chunks(batch.column(1)):
                ids, counts = own.encode(texts)
                offsets = np.concatenate([[0], np.cumsum(counts) * 4]).astype(np.int32)
                buffers = [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(ids))]
                made = pa.BinaryArray.from_buffers(pa.binary(), b - a, buffers)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(counts, pa.int64()), made], names)

    names = [key, "n_tokens", "ids"]
    schema = T.StructType([T.StructField(key, df.schema[key].dataType)]).add("n_tokens", "long").add("ids", "binary")
    return map_arrow(df.select(key, text), run, schema)


def decode(df: DataFrame, keep: Sequence[str], path: str | None = None) -> DataFrame:
    """The columns `keep` and `decoded`, the text that `ids` (as `encode` gives them) stand for.

    Bytes that are not UTF-8 become replacement characters. Null ids give an
    empty text.
    """
    path = path or public_tokenizers.path("byte_bpe_50k.json")
    keep = list(keep)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pool, first, lengths = _token_bytes(path)
        for batch in batches:
            column = batch.column("ids")
            a = 0
            while a < len(batch):
                b, size = a, 0
                while b < len(batch) and (b == a or size < 1 << 20):
                    size += len(column[b].as_buffer() or b"")
                    b += 1
                packed = [x or b"" for x in column.slice(a, b - a).to_pylist()]
                ids = np.frombuffer(b"".join(packed), "<i4")
                sizes = lengths[ids]
                blob = _gathered(pool, first[ids], sizes).tobytes()
                per = per_text(sizes, np.fromiter(map(len, packed), np.int64, len(packed)) // 4)
                stops = np.cumsum(per)
                texts = [blob[x:y].decode("utf-8", "replace") for x, y in zip((stops - per).tolist(), stops.tolist(), strict=True)]
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in keep), pa.array(texts, pa.string())], [*keep, "decoded"]
                )
                a = b

    schema = T.StructType([df.schema[c] for c in keep] + [T.StructField("decoded", T.StringType())])
    return map_arrow(df.select(*dict.fromkeys([*keep, "ids"])), run, schema)


def _sha(x: Column) -> Column:
    return F.sha2(x.cast("binary"), 256)


def op11_lexicon_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ids of every document and the text that they decode to, as digests."""
    encoded = encode(load(spark, sf_dir, "documents"))
    described = encoded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), "ids")
    decoded = decode(described, ["doc_id", "n_tokens", "ids_sha256"])
    return decoded.select("doc_id", "n_tokens", "ids_sha256", _sha(F.col("decoded")).alias("decoded_sha256"))


QUERIES = {"op11_lexicon_bpe": op11_lexicon_bpe}
ORACLES: dict[str, str] = {}
