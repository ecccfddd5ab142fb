from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from models import bigrams, pmi, tokens
from plans import plan_lines
from pyspark.sql import functions as F

from corpuskit import operators as op
from corpuskit import sources as src
from corpuskit.operators import cooccurrence
from corpuskit.functions import adjacent_pairs, snippet, tokenize, vocab

SMALL = ["a b a", "b c", "a b d", ""]
CHARS = "abZ'9-. \t\f\r\n\x0bäßñİK語"


def test_tokenize_golden(lines):
    rows = lines(["Hello, WORLD!! -- father's 42 x1y2", "", "a b\fc a", " \t 12 "])
    got = [r.t for r in rows.orderBy("docno").select(tokenize("line").alias("t")).collect()]
    assert got == [["hello", "world", "father's", "x1y"], [], ["a", "b", "c", "a"], []]


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(alphabet=CHARS, max_size=60), min_size=30, max_size=60))
def test_tokenize_and_vocab_like_model(lines, texts):
    rows = lines(texts).select(
        "line", tokenize("line").alias("t"), vocab("line").alias("v")
    )
    for row in rows.collect():
        # Kelvin sign and dotted I are the letters whose lower case is ASCII
        assert row.t == tokens(row.line), row.line
        assert row.v == list(dict.fromkeys(tokens(row.line))), row.line


def test_long_runs_without_letters_are_linear(lines):
    texts = ["x" + "1" * 400_000 + " y", "語" * 300_000, " - " * 200_000 + "z"]
    rows = lines(texts).orderBy("docno")
    got = rows.select(tokenize("line").alias("t"), vocab("line").alias("v")).collect()
    assert [r.t for r in got] == [["x", "y"], [], ["z"]]
    assert [r.v for r in got] == [["x", "y"], [], ["z"]]


def test_vocab_has_all_words_of_a_long_line(lines):
    words = ["w" + chr(97 + i // 676) + chr(97 + i // 26 % 26) + chr(97 + i % 26) for i in range(5000)]
    assert lines([" ".join(words + words)]).select(vocab("line").alias("v")).first().v == words


def test_counts(lines):
    rows = lines(["the then a an"])
    assert {(r.prefix, r.n) for r in op.prefix_count(rows).collect()} == {("th", 2), ("an", 1)}
    assert {(r.prefix, r.n) for r in op.prefix_count(rows, 3).collect()} == {("the", 2)}
    assert op.top_prefixes(rows, 1).first().prefix == "th"
    assert {(r.word, r.n) for r in op.word_count(lines(SMALL)).collect()} == {
        ("a", 3), ("b", 3), ("c", 1), ("d", 1)
    }
    assert op.line_total(lines(SMALL)).first().n_lines == 4
    assert {(r.word, r.df) for r in op.line_df(lines(SMALL)).collect()} == {
        ("a", 2), ("b", 3), ("c", 1), ("d", 1)
    }


def test_pmi_golden(lines):
    got = {(r.w1, r.w2): r.pmi for r in op.pmi_pairs(lines(SMALL), min_count=1).collect()}
    assert got == pytest.approx(pmi(SMALL, 1))
    assert got["a", "b"] == pytest.approx(0.12493873660829992)
    assert got["a", "d"] == pytest.approx(0.3010299956639812)
    got = op.pmi_pairs(lines(SMALL), min_count=2).collect()
    assert {(r.w1, r.w2) for r in got} == {("a", "b"), ("b", "a")}
    counts = op.pair_counts(lines(SMALL), min_count=1).collect()
    assert {(r.w1, r.w2, r.n) for r in counts} >= {("a", "b", 2), ("b", "a", 2), ("c", "b", 1)}


def many_lines():
    words = [f"{a}{b}" for a in "abcdefgh" for b in "ijklm"]
    texts = []
    for i in range(400):
        picked = [words[(i * k + k * k) % len(words)] for k in range(1, 9)]
        # one word is in every line
        texts.append(" ".join(["hot", *picked]))
    return texts


def test_pmi_with_hot_word_equals_brute_force(lines):
    texts = many_lines()
    expected = pmi(texts, 10)
    pairs = op.pmi_pairs(lines(texts)).persist()
    got = {(r.w1, r.w2): r.pmi for r in pairs.collect()}
    assert got.keys() == expected.keys() and got == pytest.approx(expected)
    assert all((b, a) in got for a, b in got)
    striped = op.pmi_stripes(lines(texts), parts=4).persist()
    assert {r.part for r in striped.collect()} == {0, 1, 2, 3}
    back = {(r.w1, r.w2): r.v for r in op.stripe_rows(striped, "v").collect()}
    assert back == pytest.approx(expected)
    ranked = sorted(expected.items(), key=lambda kv: (-round(kv[1], 9), kv[0]))
    top = op.top_pmi(pairs.withColumn("pmi", F.round("pmi", 9)), 5).collect()
    assert [(r.w1, r.w2) for r in top] == [k for k, _ in ranked[:5]]
    partners = op.top_partners(pairs, ["hot"], 3).collect()
    assert [r["rank"] for r in sorted(partners, key=lambda r: r["rank"])] == [1, 2, 3]


def test_long_lines_are_paired_in_blocks(lines):
    words = ["w" + chr(97 + i // 26) + chr(97 + i % 26) for i in range(300)]
    texts = [" ".join(words[i:]) for i in range(3)] + ["waa wab"]
    got = {(r.w1, r.w2): r.n for r in op.pair_counts(lines(texts), min_count=2).collect()}
    expected = {}
    for text in texts:
        for a in text.split():
            for b in text.split():
                if a != b:
                    expected[a, b] = expected.get((a, b), 0) + 1
    assert got == {k: n for k, n in expected.items() if n >= 2}


def test_pairs_are_counted_before_the_shuffle(lines):
    counts = op.pair_counts(lines(many_lines()))
    plan = counts._jdf.queryExecution().executedPlan().toString()
    final, partial = (plan.index(f"functions=[{f}sum(m") for f in ("", "partial_"))
    assert "Exchange hashpartitioning(x" in plan[final:partial]


@pytest.mark.parametrize("options", [{"long_line": 3}, {"long_line": 70}, {"filter_size": 1}, {}])
def test_pairs_are_the_same_by_any_way(lines, options):
    words = ["w" + chr(97 + i // 26) + chr(97 + i % 26) for i in range(200)]
    texts = [" ".join(words[i : i + 150]) for i in range(0, 60, 7)] + ["waa wab wac"] * 20 + ["", "waa", None, "rare wab"]
    expected = {}
    for text in texts:
        for a, b in combinations(sorted(set((text or "").split())), 2):
            expected[a, b] = expected.get((a, b), 0) + 1
    vocabulary = op.vocabulary(lines(texts))
    assert vocabulary.n_lines == len(texts)
    named = cooccurrence._named(*cooccurrence._unordered_counts(vocabulary, 2, **options))
    got = {tuple(sorted((r.x, r.y))): r.n for r in named.collect()}
    assert got == {k: n for k, n in expected.items() if n >= 2}


def test_equal_hashes_lead_to_another_salt(lines):
    tried = []

    def poor(word, salt):
        tried.append(salt)
        return F.xxhash64(word) if salt == 7 else F.length(word).cast("bigint")

    vocabulary = op.vocabulary(lines(["ab cd", "efg"]), first_salt=5, make=poor)
    assert tried == [5, 6, 7] and vocabulary.salt == 7
    with pytest.raises(RuntimeError):
        op.vocabulary(lines(["ab cd"]), salts=3, make=lambda word, salt: F.lit(0).cast("bigint"))


def test_the_filter_has_every_frequent_word(spark):
    hashes = spark.range(500).select(F.xxhash64("id").alias("h"))
    bits, size = op.frequent_filter(hashes)
    assert size == 128 and len(bits.first().bits) == 128
    place, bit = cooccurrence._bit(F.col("h"), size)
    others = spark.range(500, 5500).select(F.xxhash64("id").alias("h"))
    passed = lambda df: df.select("h", bits.scalar().alias("b")).filter(F.get("b", place).bitwiseAND(bit) != 0).count()
    assert passed(hashes) == 500 and passed(others) < 600
    assert op.frequent_filter(hashes.limit(0))[1] >= 1


def test_occurrences_of_words_are_never_shuffled(lines):
    counts, _ = cooccurrence._unordered_counts(op.vocabulary(lines(many_lines())), 10)
    exchanges = [x for _, x in plan_lines(counts) if "Exchange" in x]
    assert all("hashpartitioning(x" in x or "_xs" in x for x in exchanges) and exchanges


@pytest.mark.parametrize("size", [0, 7, 1 << 20])
@pytest.mark.parametrize("chunk", [1, 50, 1 << 20])
def test_pairs_are_the_same_with_any_dictionary_and_chunk(lines, size, chunk):
    texts = [*many_lines(), *many_lines()[:50], None, "", "hot", "rare ai"]
    expected = {}
    for text in texts:
        for a, b in combinations(sorted(set((text or "").split())), 2):
            expected[a, b] = expected.get((a, b), 0) + 1
    options = {"dictionary_size": size, "chunk": chunk, "long_line": 7 if chunk == 50 else 100}
    counts, frequent = cooccurrence._unordered_counts(op.vocabulary(lines(texts)), 10, **options)
    got = {tuple(sorted((r.x, r.y))): r.n for r in cooccurrence._named(counts, frequent).collect()}
    assert got == {k: n for k, n in expected.items() if n >= 10}


def test_partners_travel_as_lists_not_as_pairs(lines):
    counts, _ = cooccurrence._unordered_counts(op.vocabulary(lines(many_lines())), 10)
    exchanges = [x for _, x in plan_lines(counts) if "hashpartitioning(x#" in x]
    assert exchanges and all(", block" in x and ", y" not in x for x in exchanges)


def test_lists_of_pairs_take_a_byte_a_pair_and_come_back():
    packed, unpacked = cooccurrence._pair_lists()
    rng = np.random.default_rng(5)
    keys = np.unique(rng.integers(0, 1 << 20, 50_000))
    x, y, n = keys >> 8, (keys & 255) * 40, np.where(keys % 7 == 0, 3, 1)
    data = packed(x, y, n)
    assert len(data) < 1.5 * len(x)
    assert all((a == b).all() for a, b in zip(unpacked(data), (x, y, n)))
    x, y = np.array([-(1 << 63), -5, -5, 7]), np.array([(1 << 63) - 1, -4, 9, 1 << 62])
    assert all((a == b).all() for a, b in zip(unpacked(packed(x, y, y * 0 + 1)), (x, y, y * 0 + 1)))


def _lists(texts, whole=True, **options):
    """{(x, y): n} of all lists that a task makes of lines, and how many pairs the lists have; in one batch a line."""
    words = sorted({w for t in texts for w in t.split()})
    numbers = np.arange(len(words))
    hashes = (numbers - len(words) // 2) * (1 << 40)
    of = dict(zip(words, hashes.tolist()))
    dictionary = (hashes, numbers, True) if whole else (hashes[:3], numbers[:3], False)
    kind = pa.list_(pa.int64())
    columns = lambda t: [pa.array([[of[w] for w in t.split()]], kind), pa.array([None], kind)]
    batches = [pa.RecordBatch.from_arrays(columns(t), ["xs", "ys"]) for t in texts]
    _, unpacked = cooccurrence._pair_lists()
    counts, n = {}, 0
    for batch in cooccurrence._counted_pairs(dictionary, **options)(batches):
        for data, m in zip(batch["list"], batch["m"]):
            x, y, each = unpacked(data.as_py())
            assert each.sum() == m.as_py()
            n += len(x)
            for a, b, k in zip(x.tolist(), y.tolist(), each.tolist()):
                counts[a, b] = counts.get((a, b), 0) + k
    return counts, n


@pytest.mark.parametrize("whole", [True, False])
def test_a_run_of_lines_has_each_pair_once(whole):
    texts = ["aa bb cc dd ee", "bb cc dd", "aa ee"] * 40
    expected, n = _lists(texts, whole, chunk=1 << 20, groups=3)
    assert n == len(expected) == 10 and sum(expected.values()) == 40 * 14
    # only an x that is cut comes again, not each pair in each chunk
    counts, n = _lists(texts, whole, chunk=100, groups=3)
    assert counts == expected and n <= 30
    counts, n = _lists(texts, whole, chunk=100, groups=3, run_words=100)
    assert counts == expected and n > 30


def test_lines_are_paired_in_no_more_tasks_than_runs_and_cores(lines):
    texts = lines(many_lines()).repartition(40)
    counts, _ = cooccurrence._unordered_counts(op.vocabulary(texts), 10)
    cores = texts.sparkSession.sparkContext.defaultParallelism
    assert any(f"Coalesce {cores}" in x for _, x in plan_lines(counts))


def test_rows_of_lists_grow_in_number_with_the_pairs(lines, monkeypatch):
    vocabulary = op.vocabulary(lines(many_lines()))
    assert vocabulary.n_pairs == sum(n * (n - 1) // 2 for n in (len(set(t.split())) for t in many_lines()))
    expected = {k: n for k, n in cooccurrence._unordered_counts(vocabulary, 10)[0].select(F.struct("x", "y"), "n").collect()}
    monkeypatch.setattr(cooccurrence, "MEETING", 16)
    monkeypatch.setattr(cooccurrence, "CELL", 4)
    counts, _ = cooccurrence._unordered_counts(vocabulary, 10)
    assert {k: n for k, n in counts.select(F.struct("x", "y"), "n").collect()} == expected


def test_lines_of_two_files_are_apart(spark, tmp_path):
    (tmp_path / "a.txt").write_text("red fox\nblue sky\n")
    (tmp_path / "b.txt").write_text("new car\nold house\n")
    read = src.read_lines_with_offset(spark, str(tmp_path))
    keys = ("path", "docno")
    pairs = {(r.w1, r.w2) for r in op.pair_counts(read, 1, keys=keys).collect()}
    assert {frozenset(p) for p in pairs} == {frozenset(x.split()) for x in ("red fox", "blue sky", "new car", "old house")}
    postings = op.postings(read, keys=keys)
    assert op.boolean_query(postings, "red car AND", keys).count() == 0
    hits = op.boolean_query(postings, "red fox AND", keys)
    assert [r.line for r in op.fetch(hits, read, keys=keys).collect()] == ["red fox"]
    queries = spark.createDataFrame([(1, "red car AND"), (2, "red car OR")], "query_id int, rpn string")
    batch = op.boolean_query_batch(postings, queries, keys).collect()
    assert sorted((r.query_id, r.path.rsplit("/", 1)[1], r.docno) for r in batch) == [(2, "a.txt", 0), (2, "b.txt", 0)]
    decoded = op.decode_gaps(op.encode_gaps(postings, 1, keys), keys)
    assert sorted(map(tuple, decoded.select(*postings.columns).collect())) == sorted(map(tuple, postings.collect()))


def test_bigrams(lines):
    texts = SMALL + many_lines()
    expected = bigrams(texts)
    left = {}
    for (a, _), n in expected.items():
        left[a] = left.get(a, 0) + n
    got = {(r.w1, r.w2): r.value for r in op.bigram_relfreq(lines(texts)).collect()}
    model = {(a, b): n / left[a] for (a, b), n in expected.items()}
    assert got == pytest.approx({**model, **{(a, "*"): float(n) for a, n in left.items()}})
    striped = op.bigram_stripes(lines(texts), parts=8)
    assert striped.agg(F.max("part")).first()[0] > 0
    assert {(r.w1, r.w2): r.v for r in op.stripe_rows(striped, "v").collect()} == pytest.approx(model)


def test_bigram_golden(lines):
    got = {(r.w1, r.w2): r.value for r in op.bigram_relfreq(lines(SMALL)).collect()}
    third = pytest.approx(1 / 3)
    assert got == {
        ("a", "*"): 2.0, ("a", "b"): 1.0, ("b", "*"): 3.0,
        ("b", "a"): third, ("b", "c"): third, ("b", "d"): third,
    }


def test_adjacent_pairs_of_short_lines(spark):
    rows = spark.createDataFrame([([],), (["a"],), (["a", "b"],)], "t array<string>")
    assert [len(r.p) for r in rows.select(adjacent_pairs("t").alias("p")).collect()] == [0, 0, 1]


def test_snippet(lines):
    rows = lines(["x" * 80, "x" * 81]).orderBy("docno")
    got = [r.s for r in rows.select(snippet("line").alias("s")).collect()]
    assert got == ["x" * 80, "x" * 80 + "..."]
