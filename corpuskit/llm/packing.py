"""Cost-balanced packing of tokenised documents into sequences."""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from functools import cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from ..plans.tables import load
from .pair_merge import byte_letters
from .pretokens import chunks
from .recent import Recent
from .slices import distinct, joined, per_text
from .workers import give_back, map_arrow

# Words whose ids a worker keeps.
CACHED = 400_000
CACHED_LENGTH = 48

# Tokens that are packed together; a single longer document makes a larger group.
GROUP_TOKENS = 1 << 22

# Tokens and pieces that leave a task at once.
BATCH_TOKENS = 1 << 18
BATCH_PIECES = 4096

_PUNCTUATION = b".,;:!?|*%&$#()"

# Letters up to U+00FF, which neither normalising nor lower-casing joins with their neighbours.
_PLAIN = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+")

# The letters that stand for bytes in the vocabulary.
_LETTERS = dict(enumerate(byte_letters()))


@cache
def _byte_classes() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each byte whether it separates words, is an ASCII letter, or is punctuation."""
    blank, letter, mark = (np.zeros(256, bool) for _ in range(3))
    blank[[ord(" "), ord("\n")]] = True
    letter[[b for b in range(128) if chr(b).isalpha()]] = True
    mark[list(_PUNCTUATION)] = True
    return blank, letter, mark


def words(texts: Sequence[str]) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    """All texts as one byte string, where words begin and end in it, and how many each text has.

    Words lie between blanks and line ends, and a run of letters up to U+00FF is
    a word of its own before punctuation. The vocabulary's own pattern cuts at
    both and drops the white space, so ids of words are ids of texts. Texts that
    may have special strings are not cut inside words, and ASCII texts, which
    have no combining marks, are put in lower case, as the vocabulary is.
    """
    special = np.array(["<|" in t for t in texts])
    lowered = [t.lower() if t.isascii() and not s else t for t, s in zip(texts, special, strict=True)]
    encoded = [t.encode("utf-8", "surrogatepass") for t in lowered]
    blob = b"\n".join([*encoded, b""])
    data = np.frombuffer(blob, np.uint8)
    text_ends = np.cumsum(np.fromiter(map(len, encoded), np.int64, len(encoded)) + 1)
    blank, letter, mark = _byte_classes()
    between, letters = blank[data], letter[data]
    lead = np.flatnonzero(data == 0xC3)  # U+00C0 to U+00FF, but for the signs of multiplication and division
    lead = lead[(data[lead + 1] != 0x97) & (data[lead + 1] != 0xB7)]
    letters[lead] = letters[lead + 1] = True
    begins = ~between
    begins[1:] &= between[:-1]
    starts = np.flatnonzero(begins)
    stops = np.flatnonzero(~between[:-1] & between[1:]) + 1  # the last byte is a line end
    others = np.flatnonzero(~letters)
    first = others[np.searchsorted(others, starts)]
    cut = (first > starts) & (first < stops) & mark[data[first]]
    cut &= ~special[np.searchsorted(text_ends, starts, "right")]
    starts, stops = (np.sort(np.concatenate([x, first[cut]])) for x in (starts, stops))
    return blob, starts, stops, np.diff(np.searchsorted(starts, text_ends), prepend=0)


class WordEncoder:
    """Ids by a tokenizer file that drops white space, keeping the ids of words that occurred before."""

    def __init__(self, path: str, cached: int = CACHED):
        self.tokenizer = Tokenizer.from_file(path)
        self.kept = Recent(cached, CACHED_LENGTH)

    def _encoded(self, words: list[str]) -> list[bytes]:
        """Words of plain letters go straight to the merges; only others need normalising and cutting."""
        ids: dict[str, list[int]] = {}
        others = []
        for w in words:
            if _PLAIN.fullmatch(w):
                letters = w.lower().encode().decode("latin-1").translate(_LETTERS)
                ids[w] = [t.id for t in self.tokenizer.model.tokenize(letters)]
            else:
                others.append(w)
        encoded = self.tokenizer.encode_batch_fast(others, add_special_tokens=False)
        ids.update((w, e.ids) for w, e in zip(others, encoded, strict=True))
        return [np.array(ids[w], "<u4").tobytes() for w in words]

    def encode(self, texts: Sequence[str]) -> list[np.ndarray]:
        blob, starts, stops, n_words = words(texts)
        codes, distinct_words = distinct(blob, starts, stops)
        ids, counts = joined(codes, self.kept.look_up(distinct_words, self._encoded))
        return np.split(ids, np.cumsum(per_text(counts, n_words))[:-1])


@cache
def _encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


@dataclass(frozen=True)
class Piece:
    """Tokens start .. start + length of a document, at `offset` of a sequence."""

    document: int
    start: int
    length: int
    sequence: int
    offset: int


def capacities(tokens: int, capacity: int) -> tuple[int, list[int]]:
    """How many full sequences hold so many tokens, and powers of two for the rest: none has padding."""
    rest = tokens % capacity
    return tokens // capacity, [1 << b for b in reversed(range(rest.bit_length())) if rest >> b & 1]


def assign(lengths: Sequence[int], capacity: int, linear: float = 1.0, quadratic: float | None = None) -> list[Piece]:
    """Balanced sequences for documents of these lengths.

    A document's cost is `linear` times its tokens plus `quadratic` times their
    square, as attention within it grows; by default a full sequence of one
    document costs as much for either. Whole sequences are cut off documents
    first. Then, in descending cost, each document goes to the sequence of the
    lowest cost that has room; what doesn't fit goes on to the next one. Short
    sequences, powers of two, take what the full ones leave. All are full in the
    end, so nothing is padded.
    """
    quadratic = linear / capacity if quadratic is None else quadratic
    pieces, rests = [], []
    n_full, short = capacities(sum(lengths), capacity)
    for d, n in enumerate(lengths):
        whole = n // capacity
        pieces += [Piece(d, i * capacity, capacity, len(pieces) + i, 0) for i in range(whole)]
        if n % capacity:
            rests.append((n % capacity, d))
    n_open = n_full - len(pieces)
    rests.sort(key=lambda x: (-x[0], x[1]))
    # (cost, sequence, tokens in it): full sequences first, then the short ones in turn
    heap = [(0.0, n_full - n_open + i, 0) for i in range(n_open)]
    waiting = [(n_full + i, size) for i, size in reversed(list(enumerate(short)))]
    room = dict.fromkeys((s for _, s, _ in heap), capacity)
    for n, d in rests:
        start = lengths[d] - n
        while n:
            if not heap:
                sequence, size = waiting.pop()
                room[sequence] = size
                heap.append((0.0, sequence, 0))
            cost, sequence, used = heap[0]
            length = min(n, room[sequence] - used)
            pieces.append(Piece(d, start, length, sequence, used))
            start, n, used = start + length, n - length, used + length
            if used == room[sequence]:
                heapq.heappop(heap)
            else:
                heapq.heapreplace(heap, (cost + linear * length + quadratic * length * length, sequence, used))
    return pieces


def pack(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    path: str | None = None,
    end_id: int = 2,
    capacity: int = 4096,
    group_tokens: int = GROUP_TOKENS,
) -> DataFrame:
    """(key, start, length, ids, doc_tokens, sequence_id, offset): one row per piece of a document.

    `ids` are the piece's token ids, little-endian 32-bit integers: those of the
    text by the tokenizer file at `path`, and `end_id` after the last. Each task
    packs about `group_tokens` tokens at a time (see `assign`) without a shuffle;
    a sequence's id is unique over all tasks, and a task that is repeated gives
    the same. Null and empty texts have the end id alone; rows may repeat and
    keys may be null; other columns play no part.
    """
    path = path or public_tokenizers.path("word_bpe_49k.json")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, end = _encoder(path), np.array([end_id], "<u4")
        next_id = (TaskContext.get().partitionId()) << 40
        keys: list[pa.Array] = []
        documents: list[np.ndarray] = []
        total = 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal next_id, total
            if not documents:
                return
            lengths = [len(x) for x in documents]
            pieces = assign(lengths, capacity)
            own_keys, own_lengths = pa.concat_arrays(keys), pa.array(lengths, pa.int64())
            first = 0
            while first < len(pieces):  # only one batch's ids are there twice
                last, tokens = first, 0
                while last < len(pieces) and last - first < BATCH_PIECES and tokens < BATCH_TOKENS:
                    tokens += pieces[last].length
                    last += 1
                some = pieces[first:last]
                of = pa.array([p.document for p in some], pa.int64())
                ids = [documents[p.document][p.start : p.start + p.length].tobytes() for p in some]
                columns = [
                    own_keys.take(of),
                    pa.array([p.start for p in some], pa.int64()),
                    pa.array([p.length for p in some], pa.int64()),
                    pa.array(ids, pa.binary()),
                    own_lengths.take(of),
                    pa.array([next_id + p.sequence for p in some], pa.int64()),
                    pa.array([p.offset for p in some], pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(columns, schema.names)
                first = last
            next_id += 1 + max(p.sequence for p in pieces)
            keys.clear()
            documents.clear()
            total = 0
            give_back()

        for batch in batches:
            for a, b, texts in chunks(batch.column(1), 1 << 20):
                keys.append(batch.column(0).take(pa.array(np.arange(a, b))))  # a slice would keep the batch's texts
                new = [np.concatenate([x, end]) for x in own.encode(texts)]
                documents += new
                total += sum(map(len, new))
                if total >= group_tokens:
                    yield from flush()
        yield from flush()

    schema = T.StructType([df.schema[key]])
    for name in ("start", "length"):
        schema.add(name, T.LongType())
    schema.add("ids", T.BinaryType())
    for name in ("doc_tokens", "sequence_id", "offset"):
        schema.add(name, T.LongType())
    return map_arrow(df.select(key, text), run, schema)


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document with its place and a checksum of its ids."""
    packed = pack(load(spark, sf_dir, "documents"))
    return packed.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


QUERIES = {"op3_packing": op3_packing}
ORACLES: dict[str, str] = {}
