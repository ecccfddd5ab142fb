"""Encoding, counting and packing against the public libraries."""

import random
import re
import zlib
from collections import defaultdict
from pathlib import Path
from types import SimpleNamespace

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from tokenizers import Tokenizer

from corpuskit.llm import byte_bpe, packing, pair_merge, pretokens, slices, token_count, workers

PARTS = (
    ["a", "s", "t", "re", "ll", "d", "'", " ", "  ", "\n", "\t", "1", "٣", "é", "ß", "!", "?", "中", "　", "́"]
    + ["'s", "'ll", "'re ", "<|endoftext|>", "\x00", "\x1c", "\xa0", "😀", "A", "'S", "aaaa", "the ", " th", "İ", "Σ"]
    + ["H̱", "≠", ".", ",", "|", "***", "ﬁ", "​", "\x85"]
)


def random_texts(n, seed):
    rnd = random.Random(seed)
    return ["", "a", " ", "'", "  ", "\n"] + ["".join(rnd.choices(PARTS, k=rnd.randint(0, 40))) for _ in range(n)]


@pytest.fixture(scope="module")
def library():
    ranks = pair_merge.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_pretokens_cover_the_texts_as_the_pattern_does(library):
    texts = random_texts(500, 1)
    blob, starts, stops, counts = pretokens.boundaries(texts)
    at = 0
    for text, n in zip(texts, counts, strict=True):
        assert b"".join(blob[a:b] for a, b in zip(starts[at : at + n], stops[at : at + n], strict=True)) == text.encode()
        at += n
    assert len(pretokens.boundaries([])[1]) == 0


def test_equal_slices_have_equal_numbers():
    rnd = random.Random(7)
    for zero in ("", "\0"):
        parts = ["".join(rnd.choices("abé" + zero, k=rnd.randint(1, 20))).encode() for _ in range(3000)]
        stops = np.cumsum([len(p) for p in parts])
        starts = stops - [len(p) for p in parts]
        codes, values = slices.distinct(b"".join(parts), starts, stops)
        assert [values[c].encode() for c in codes] == parts and len(set(values)) == len(values)
    assert slices.distinct(b"", starts[:0], stops[:0])[1] == []
    ids, counts = slices.joined(np.array([1, 0, 1]), [np.array([5, 6], "<u4").tobytes(), np.array([7], "<u4").tobytes()])
    assert ids.tolist() == [7, 5, 6, 7] and counts.tolist() == [1, 2, 1]


def test_blocks_of_any_width_give_the_same_boundaries():
    points = np.frombuffer(("it's  a\n\n12 x" * 50 + "\n").encode("utf-32-le"), "<u4")
    symbols = pretokens._symbols(points, np.array([len(points) - 1]))
    expected = pretokens._begins(symbols, 1 << 12)
    for width in (1, 3, 64):
        assert (pretokens._begins(symbols, width) == expected).all()


def test_ids_are_the_library_s(library):
    texts = [*random_texts(3000, 2), "a" * 5000 + " " * 3000 + "b", "abcdefgh" * 500]
    ids, stops = byte_bpe.encoder(public_tokenizers.path("byte_bpe_50k.tiktoken")).encode(texts)
    for text, own in zip(texts, np.split(ids, stops[:-1]), strict=True):
        assert own.tolist() == library.encode_ordinary(text)


def test_a_full_cache_changes_nothing(library):
    own = byte_bpe.Encoder(pair_merge.from_ranks(library._mergeable_ranks), cached=8)
    for text in random_texts(200, 3):
        assert own.encode([text])[0].tolist() == library.encode_ordinary(text)


def test_encode_decode_round_trip(odd_documents, library):
    encoded = byte_bpe.encode(odd_documents)
    rows = byte_bpe.decode(encoded, ["doc_id", "ids"]).collect()
    texts = sorted((r.text or "").encode() for r in odd_documents.collect())
    assert sorted(bytes(r.bytes) for r in rows) == texts
    for r in rows:
        assert list(r.ids) == library.encode_ordinary(bytes(r.bytes).decode())


def test_offsets_are_the_tokens_places(documents, library):
    text = "it's an émile's 😀 text"
    row = byte_bpe.encode(documents([(1, text)])).first()
    lengths = [len(library.decode_single_token_bytes(i)) for i in row.ids]
    assert list(row.offsets) == [sum(lengths[:i]) for i in range(len(lengths))]


def test_counts_are_the_library_s(spark, odd_documents):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = [r.text or "" for r in odd_documents.collect()] + random_texts(400, 4)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.doc_id: (r.n_bytes, r.n_tokens) for r in token_count.count_tokens(df).collect()}
    for i, text in enumerate(texts):
        assert got[i] == (len(text.encode()), len(library.encode(text, add_special_tokens=False).ids))


def test_the_table_of_frequent_pretokens_is_bounded(spark):
    df = spark.createDataFrame([(i, "the cat " * 50 + f"x{i}") for i in range(40)], "doc_id bigint, text string")
    rows = token_count.frequent_pretokens(df, size=2, summary=4).collect()
    assert [r.piece for r in rows] == [" cat", " the"]


def test_tokens_are_counted_in_one_pass_without_a_shuffle(spark):
    df = spark.createDataFrame([(1, "the cat")], "doc_id bigint, text string")
    plan = token_count.count_tokens(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "Exchange" not in plan


def test_pretokens_of_the_vocabulary():
    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    pieces = token_count.vocabulary_pretokens(path)
    assert len(pieces) == len(set(pieces)) == token_count.FREQUENT and {" the", "s", " of"} <= set(pieces)
    for piece in pieces[::97]:
        assert len(library.pre_tokenizer.pre_tokenize_str(piece)) == 1
    assert token_count.vocabulary_pretokens(path, 3) == pieces[:3]


@pytest.mark.parametrize("op", [byte_bpe.encode, token_count.count_tokens, packing.pack])
def test_empty_tables_and_clashing_names(op, no_documents, clashing):
    assert op(no_documents).count() == 0
    assert op(clashing).select("doc_id").distinct().count() == clashing.select("doc_id").distinct().count()


def test_word_ids_are_the_library_s():
    path = public_tokenizers.path("word_bpe_49k.json")
    library, own = Tokenizer.from_file(path), packing.WordEncoder(path)
    texts = [*random_texts(4000, 5), "<|STARTOFTEXT|> <|startoftext|>It's", "Don'T, don't. é.'s"]
    for text, ids in zip(texts, own.encode(texts), strict=True):
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids, text


@pytest.mark.parametrize("lengths", [[], [1], [4096], [5000, 3, 3, 4096, 9000], [100] * 77, [1] * 5000])
def test_sequences_are_full_or_powers_of_two(lengths):
    pieces = packing.assign(lengths, 4096)
    sequences, documents = defaultdict(list), defaultdict(list)
    for p in pieces:
        sequences[p.sequence].append((p.offset, p.length))
        documents[p.document].append((p.start, p.length))
    for runs in (*sequences.values(), *documents.values()):
        at = 0
        for start, length in sorted(runs):
            assert start == at and length > 0
            at += length
    assert [sum(n for _, n in documents[i]) for i in range(len(lengths))] == lengths
    assert sorted(sequences) == list(range(len(sequences)))
    sizes = [sum(n for _, n in runs) for runs in sequences.values()]
    assert all(n <= 4096 and n & (n - 1) == 0 for n in sizes)


def test_costs_are_balanced():
    rnd = random.Random(6)
    lengths = [rnd.randint(20, 900) for _ in range(2000)]
    cost = defaultdict(float)
    size = defaultdict(int)
    for p in packing.assign(lengths, 4096):
        cost[p.sequence] += p.length + p.length**2 / 4096
        size[p.sequence] += p.length
    full = [cost[s] for s in cost if size[s] == 4096 and cost[s] < 8192]
    in_order = sorted(full)
    assert in_order[len(full) * 9 // 10] < 1.1 * in_order[len(full) // 10]


def test_pack_keeps_every_id(odd_documents):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    rows = packing.pack(odd_documents, group_tokens=5000).collect()
    by_text = defaultdict(list)
    for r in rows:
        assert zlib.crc32(r.ids) >= 0 and len(r.ids) == 4 * r.length
        by_text[r.doc_id, r.doc_tokens].append(r)
    for d in odd_documents.collect():
        ids = library.encode(d.text or "", add_special_tokens=False).ids + [2]
        pieces = sorted(by_text[d.doc_id, len(ids)], key=lambda r: r.start)
        if d.doc_id in (None, 7):  # several rows have this id
            assert len(pieces) >= 1
        else:
            assert b"".join(p.ids for p in pieces) == np.array(ids, "<u4").tobytes()
    places = defaultdict(list)
    for r in rows:
        places[r.sequence_id].append((r.offset, r.length))
    for runs in places.values():
        assert sorted(runs)[0][0] == 0 and sum(n for _, n in runs) <= 4096


def in_one_task(monkeypatch, documents, **options):
    """The batches that `packing.pack` makes of these documents in one task."""
    made = []
    monkeypatch.setattr(packing, "map_arrow", lambda df, run, schema: made.append(run))
    monkeypatch.setattr(packing, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 0)))
    packing.pack(documents, **options)
    return made[0]


def test_packed_ids_leave_a_task_in_small_batches(monkeypatch, documents):
    texts = pa.array([f"w{i} " * (1 + i * 37 % 6000) for i in range(600)])
    batch = pa.RecordBatch.from_arrays([pa.array(range(600), pa.int64()), texts], ["doc_id", "text"])
    out = list(in_one_task(monkeypatch, documents([]))([batch]))
    assert sum(len(b) for b in out) >= 600
    ids = [sum(b.column(2).to_pylist()) for b in out]
    assert sum(ids) > 4 * packing.BATCH_TOKENS
    assert max(ids) < packing.BATCH_TOKENS + 4096


def test_keys_that_wait_do_not_keep_their_texts(monkeypatch, documents):
    def batches():
        for i in range(40):
            columns = [pa.array(range(100 * i, 100 * i + 100), pa.int64()), pa.array([f"{i} " + "\n" * 40_000] * 100)]
            made = pa.RecordBatch.from_arrays(columns, ["doc_id", "text"])
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, made.schema) as stream:
                stream.write_batch(made)
            source = pa.BufferReader(sink.getvalue())
            del columns, made, sink
            yield pa.ipc.open_stream(source).read_next_batch()
            held.append(pa.total_allocated_bytes())

    held = []
    list(in_one_task(monkeypatch, documents([]))(batches()))
    assert max(held) - min(held) < 40e6  # all texts are 160 MB


def own_memory():
    """MB of this process, without mapped files."""
    rollup = Path("/proc/self/smaps_rollup").read_text()
    return int(re.search(r"\nPss_Anon:\s+(\d+)", rollup)[1]) / 1024


@pytest.mark.skipif(not Path("/proc/self/smaps_rollup").exists(), reason="memory can't be read here")
def test_a_worker_gives_back_what_a_task_leaves_free(monkeypatch):
    pinned = []

    def run(batches):
        yield from batches
        some = [np.ones(8_000) for _ in range(5_000)]
        pinned.append(some[-1])  # behind the others
        rose.append(own_memory())

    rose = []
    monkeypatch.setattr(workers, "ship", lambda spark: None)
    task = workers.map_arrow(SimpleNamespace(sparkSession=None, mapInArrow=lambda run, schema: run), run, None)
    before = own_memory()
    assert list(task([])) == []
    assert rose[0] - before > 250
    assert own_memory() - before < 60
