"""The transducer against a dictionary, encoding and decoding against the public library."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from corpuskit.llm import lexicon, lexicon_bpe
from tests.llm.test_encoding import random_texts

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def looked_up(data, words, tmp_path):
    path = f"{tmp_path}/{hashlib.sha256(data).hexdigest()}"
    with open(path, "wb") as f:
        f.write(data)
    sizes = np.array([len(w) for w in words], np.int64)
    ends = np.cumsum(sizes)
    known, counts, ids = lexicon.Lexicon(path).look_up(np.frombuffer(b"".join(words), np.uint8), ends - sizes, ends)
    out, at = [], 0
    for k, n in zip(known.tolist(), counts.tolist(), strict=True):
        out.append(tuple(ids[at : at + n].tolist()) if k else None)
        at += n
    assert at == len(ids)
    return out


def test_lexicon_is_a_dictionary(tmp_path):
    rnd = random.Random(1)
    for _ in range(200):
        words = {bytes(rnd.choices(b"abc\xff", k=rnd.randint(0, 6))) for _ in range(rnd.randint(0, 40))}
        known = {w: tuple(rnd.choices(range(3), k=rnd.randint(0, 3))) for w in words}
        data = lexicon.compiled(list(known), list(known.values()))
        asked = [*known, *(bytes(rnd.choices(b"abc\xff", k=rnd.randint(0, 7))) for _ in range(30))]
        assert looked_up(data, asked, tmp_path) == [known.get(w) for w in asked]


def equivalent(known, prefix):
    """What distinguishes states: the endings below, with the ids that are not yet given."""
    below = {w[len(prefix) :]: ids for w, ids in known.items() if w.startswith(prefix)}
    n = len(next(iter(below.values())))
    given = next(k for k in range(n, -1, -1) if len({ids[:k] for ids in below.values()}) == 1 and all(len(i) >= k for i in below.values()))
    return frozenset((w, ids[given:]) for w, ids in below.items())


def test_automaton_is_minimal():
    rnd = random.Random(2)
    for _ in range(100):
        words = {bytes(rnd.choices(b"ab", k=rnd.randint(1, 6))) for _ in range(20)}
        known = {w: tuple(rnd.choices(range(2), k=rnd.randint(1, 2))) for w in words}
        builder = lexicon.Builder()
        for w in sorted(known):
            builder.add(w, known[w])
        builder.finish()
        prefixes = {w[:i] for w in known for i in range(1, len(w) + 1)}
        assert len(builder.states) <= len({equivalent(known, p) for p in prefixes}) + 1


def test_words_have_to_ascend():
    builder = lexicon.Builder()
    builder.add(b"b", (1,))
    with pytest.raises(ValueError):
        builder.add(b"a", (1,))


def test_endings_are_shared():
    words = [a + b for a in (b"walk", b"talk", b"jump") for b in (b"", b"s", b"ed", b"ing")]
    builder = lexicon.Builder()
    for w in sorted(words):
        builder.add(w, (words.index(w), 7))
    builder.finish()
    assert len(builder.states) < 25  # 38 states without shared endings


def test_not_a_lexicon(tmp_path):
    (tmp_path / "x").write_bytes(b"something else, of no use at all, but long enough for a header..")
    with pytest.raises(ValueError):
        lexicon.Lexicon(f"{tmp_path}/x")


@pytest.mark.parametrize("words", [0, 3, 1000])
def test_ids_and_texts_are_the_library_s(spark, odd_documents, library, words):
    texts = [r.text for r in odd_documents.collect()] + random_texts(400, 4)
    texts += ["<|endoftext|>", "a<|endoftext|><|endoftext|> b", "<|endoftext|", "x" * 3000 + "<|endoftext|>"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    encoded = lexicon_bpe.encode(df, words=words)
    rows = {r.doc_id: r for r in lexicon_bpe.decode(encoded, ["doc_id", "n_tokens", "ids"]).collect()}
    assert len(rows) == len(texts)
    for i, text in enumerate(texts):
        ids = library.encode(text or "", add_special_tokens=False).ids
        assert np.frombuffer(rows[i].ids, "<u4").tolist() == ids and rows[i].n_tokens == len(ids)
        assert rows[i].decoded == library.decode(ids, skip_special_tokens=False)


def test_ids_that_are_no_text(spark, library):
    rnd = random.Random(5)
    rows = [(i, [rnd.randint(0, 50256) for _ in range(rnd.randint(0, 12))]) for i in range(300)]
    df = spark.createDataFrame([(i, bytearray(np.array(x, "<u4").tobytes())) for i, x in rows] + [(-1, None)], "doc_id bigint, ids binary")
    got = {r.doc_id: r.decoded for r in lexicon_bpe.decode(df, ["doc_id"]).collect()}
    assert got.pop(-1) == ""
    assert got == {i: library.decode(x, skip_special_tokens=False) for i, x in rows}


def test_registered_query_on_a_small_table(spark, odd_documents, library, tmp_path):
    odd_documents.write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted((tuple(r) for r in lexicon_bpe.op11_lexicon_bpe(spark, str(tmp_path)).collect()), key=repr)
    sha = lambda b: hashlib.sha256(b).hexdigest()
    expected = []
    for r in odd_documents.collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        expected.append((r.doc_id, len(ids), sha(np.array(ids, "<u4").tobytes()), sha((r.text or "").encode())))
    assert got == sorted(expected, key=repr)


def test_empty_tables_and_clashing_names(no_documents, clashing):
    assert lexicon_bpe.encode(no_documents).count() == 0
    assert lexicon_bpe.encode(clashing).columns == ["doc_id", "n_tokens", "ids"]
    assert lexicon_bpe.encode(clashing).count() == clashing.count()
