"""Periodic runs against their definition."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpuskit.llm import word_runs


def brute(words, min_length=24, min_exponent=3):
    """All (start, length, period), by trying every period."""
    n, out = len(words), []
    for q in range(1, n // 2 + 1):
        i = q
        while i < n:
            if words[i] != words[i - q]:
                i += 1
                continue
            j = i
            while j < n and words[j] == words[j - q]:
                j += 1
            start, length = i - q, j - i + q
            smaller = any(all(words[start + t] == words[start + t - p] for t in range(p, length)) for p in range(1, q))
            if length >= max(min_length, min_exponent * q) and not smaller:
                out.append((start, length, q))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def some_words(rnd, most=60):
    n, letters = rnd.randint(0, most), rnd.randint(1, 5)
    words = [rnd.randint(0, letters) for _ in range(n)]
    if n and rnd.random() < 0.6:
        start, period = rnd.randint(0, n - 1), rnd.randint(1, 12)
        words = [w if i < start else words[start + (i - start) % period] for i, w in enumerate(words)]
    return words


@pytest.mark.parametrize("limits", [(2, 2), (8, 2.5), (10, 3), (24, 3)])
def test_runs_are_those_of_the_definition(limits):
    rnd = random.Random(1)
    for _ in range(400):
        words = some_words(rnd)
        assert word_runs.runs_of(words, *limits) == brute(words, *limits)


@pytest.mark.parametrize("limits", [(2, 2), (8, 2.5), (24, 3)])
def test_no_run_is_outside_the_stretches(limits):
    rnd = random.Random(2)
    sequences = [some_words(rnd) for _ in range(300)]
    codes = np.array([w for s in sequences for w in s], np.int64)
    counts = np.array([len(s) for s in sequences])
    first = np.cumsum(counts) - counts
    found = [[] for _ in sequences]
    for i, a, b in word_runs.stretches(codes, counts, *limits):
        found[i] += [(s + a - first[i], n, q) for s, n, q in word_runs.runs_of(codes[a:b].tolist(), *limits)]
    assert [sorted(f, key=lambda r: (r[0], r[2])) for f in found] == [brute(s, *limits) for s in sequences]


def test_plain_text_is_not_searched():
    codes = np.arange(10_000)
    assert not list(word_runs.stretches(codes, np.array([10_000])))
    far = np.concatenate([np.arange(30), np.arange(1000, 2000), np.arange(30)])  # too far apart for a run
    assert not list(word_runs.stretches(far, np.array([len(far)])))
    assert not list(word_runs.stretches(codes[:0], np.zeros(2, np.int64)))


def test_squares_and_extension():
    assert word_runs.runs_of([1] * 30) == [(0, 30, 1)]
    assert word_runs.runs_of([9, *[1, 2, 3] * 9, 1, 8]) == [(1, 28, 3)]
    assert word_runs.runs_of([1, 2] * 11) == []
    with pytest.raises(ValueError):
        word_runs.periodic_runs(None, min_exponent=1)


def expected(doc_id, text):
    """A row of op13 by its definition."""
    words = (text or "").encode().split()
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if doc_id is not None and h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = brute(words) if len(words) < 3000 else None
    if runs is None:
        return None
    dropped = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = None
    for s, length, q in runs:
        if best is None or length * best[2] > best[1] * q:
            best = (s, length, q)
    sha = lambda b: hashlib.sha256(b).hexdigest()
    return (
        len(runs),
        *(best or (None,) * 3),
        None if best is None else 1000 * best[1] // best[2],
        sha("".join(f"{s},{length},{q}\n" for s, length, q in runs).encode()),
        sha(b" ".join(w for i, w in enumerate(words) if i not in dropped)),
    )


def rows_of(df):
    names = ["n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    return [(r.doc_id, tuple(r[c] for c in names)) for r in df.collect()]


def test_registered_query_on_a_small_table(spark, documents, tmp_path):
    rnd = random.Random(3)
    texts = [" ".join(f"w{w}" for w in some_words(rnd, 120)) for _ in range(150)]
    texts += [None, "", " \t\x0b\n", "a\x85b\xa0c\x1cd " * 40, "é 中\t" * 30, "x " * 500]
    rows = list(enumerate(texts)) + [(None, "y " * 30), (7, texts[7]), (7, texts[7])]
    documents(rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = rows_of(word_runs.op13_word_runs(spark, str(tmp_path)))
    assert sorted(got, key=repr) == sorted(((i, expected(i, t)) for i, t in rows), key=repr)
    assert sum(r[0] > 0 for _, r in got) > 20


def test_odd_rows(odd_documents, no_documents, clashing):
    runs = word_runs.periodic_runs
    assert runs(no_documents).count() == 0
    rows = runs(odd_documents).collect()
    assert len(rows) == odd_documents.count() and all(r.runs == [] for r in rows)
    assert {r.collapsed for r in rows if r.doc_id in (1, 2, 3)} == {""}
    assert {r.collapsed for r in rows if r.doc_id == 7} == {"the same text"}
    assert runs(clashing).columns == ["doc_id", "n_words", "runs", "collapsed"]
    long = odd_documents.filter("doc_id = 4").select("doc_id", F.repeat("text", 5).alias("text"))
    assert [tuple(r) for r in runs(long).first().runs] == [(1, 199_994, 39_999)]  # the last word and the first are one
    spaced = odd_documents.filter("doc_id = 4").select("doc_id", F.repeat(F.concat("text", F.lit(" ")), 5).alias("text"))
    row = runs(spaced).first()
    assert [tuple(r) for r in row.runs] == [(0, 200_000, 40_000)] and len(row.collapsed.split()) == 40_000
