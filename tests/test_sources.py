import datetime as dt
import os
import re
import time
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from corpuskit import operators as op
from corpuskit import sources as src
from corpuskit.sources import state


def write(path, data):
    path.write_bytes(data.encode() if isinstance(data, str) else data)
    return str(path)


def model_offsets(data: bytes):
    out, at = [], 0
    while at < len(data):
        end = at
        while end < len(data) and data[end] not in b"\r\n":
            end += 1
        out.append((at, data[at:end].decode()))
        at = end + (2 if data[end : end + 2] == b"\r\n" else 1)
    return out


@pytest.mark.parametrize(
    "data",
    [
        "Hello wörld\nzwei\n\nlast",
        "a\r\nb\r\n\r\nc\r\n",
        "a\rb\r\nc\r\r\nd\r",
        "only",
        "\n\n",
    ],
)
def test_offsets(spark, tmp_path, data):
    path = write(tmp_path / "t.txt", data)
    got = src.read_lines_with_offset(spark, path).orderBy("docno").collect()
    assert [(r.docno, r.line) for r in got] == model_offsets(data.encode())


def test_offsets_over_many_splits(spark, tmp_path):
    data = "".join(f"line {i} " + "ü" * (i % 50) + "\n" for i in range(5000))
    for name in ("one.txt", "two.txt"):
        write(tmp_path / name, data)
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes",)}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "10000")
    try:
        read = src.read_lines_with_offset(spark, str(tmp_path))
        rows = read.collect()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert len({r.path for r in rows}) == 2
    for path in {r.path for r in rows}:
        assert sorted((r.docno, r.line) for r in rows if r.path == path) == model_offsets(
            data.encode()
        )


def test_read_lines(spark, tmp_path):
    path = write(tmp_path / "t.txt", "x\ny\n")
    assert sorted(r.line for r in src.read_lines(spark, path).collect()) == ["x", "y"]


def test_tables(spark, tmp_path):
    write(
        tmp_path / "lineitem.tbl",
        '1|2|3|4|17|100.10|0.10|0.05|N|O|1996-03-15|1996-03-01|1996-03-20|"X|RAIL|said "hi|\n'
        "7|2|3|1|1|10.00|0.00|0.00|R|F|1996-04-15|1996-03-01|1996-03-20|X|RAIL|c|\n",
    )
    write(tmp_path / "orders.tbl", "1|5|O|9.99|1996-03-01|1-URGENT|Clerk#7|0|c|\n"
                                   "7|5|O|9.99|1996-03-01|1-URGENT|Clerk#8|0|c|\n")
    write(tmp_path / "customer.tbl", "5|Cust|addr|3|555|1.00|SEG|c|\n")
    write(tmp_path / "nation.tbl", "3|CANADA|1|c|\n")
    write(tmp_path / "part.tbl", "2|bolt|m|b|t|1|box|1.00|c|\n")
    write(tmp_path / "supplier.tbl", "3|Supp|addr|3|555|1.00|c|\n")
    t = {n: src.read_tbl(spark, str(tmp_path), n) for n in src.TBL_SCHEMAS}
    item = t["lineitem"].filter("l_orderkey = 1").first()
    assert item.l_shipdate == dt.date(1996, 3, 15) and item.l_extendedprice == Decimal("100.10")
    assert item.l_comment == 'said "hi'
    clerks = op.clerks(t["orders"], t["lineitem"], "1996-03-15").collect()
    assert [tuple(r) for r in clerks] == [("Clerk#7", 1)]
    parts = op.parts_suppliers(t["lineitem"], t["part"], t["supplier"], "1996-03", strict=True)
    assert [tuple(r) for r in parts.collect()] == [(1, "bolt", "Supp")]
    nations = op.orders_per_nation(
        t["orders"], t["lineitem"], t["customer"], t["nation"], "1996-03-15"
    )
    assert [tuple(r) for r in nations.collect()] == [(3, "CANADA", 1)]
    best = op.unshipped_value(t["customer"], t["orders"], t["lineitem"], "1996-03-14").collect()
    assert [tuple(r) for r in best] == [
        ("Cust", 1, 90.09, dt.date(1996, 3, 1), "0"),
        ("Cust", 7, 10.0, dt.date(1996, 3, 1), "0"),
    ]


def test_adjacency(spark, tmp_path):
    path = write(tmp_path / "adj.txt", "1 2 3\n2\t1\n3\n  4 9 1 1 \n\n")
    nodes, edges = src.read_adjacency(spark, path)
    assert sorted(r.node for r in nodes.collect()) == [1, 2, 3, 4]
    assert sorted(map(tuple, edges.collect())) == [(1, 2), (1, 3), (2, 1), (4, 1), (4, 1), (4, 9)]


def test_instances_and_models(spark, tmp_path):
    path = write(tmp_path / "train.txt", "d1 spam 1 2 2\nd2 ham 2 3\nd3 spam 3 \nd4 ham\n")
    rows = src.read_instances(spark, path).collect()
    assert [(r.doc_id, r.label, r.features) for r in rows] == [
        ("d1", "spam", [1, 2, 2]), ("d2", "ham", [2, 3]), ("d3", "spam", [3]), ("d4", "ham", []),
    ]
    model = spark.createDataFrame([(1, 0.5), (2, -1.25e-7)], "feature int, weight double")
    src.write_model(model, str(tmp_path / "model"))
    got = src.read_model(spark, str(tmp_path / "model"), "m").collect()
    assert sorted(map(tuple, got)) == [("m", 1, 0.5), ("m", 2, -1.25e-7)]
    for i in range(3):
        write(tmp_path / f"part-0000{i}", f"({i},0.{i + 1})\n")
    paths = [str(tmp_path / f"part-0000{i}") for i in range(3)]
    assert sorted(map(tuple, src.read_models(spark, paths).collect())) == [
        ("part-00000", 0, 0.1), ("part-00001", 1, 0.2), ("part-00002", 2, 0.3)
    ]


def test_text_sink_replaces_and_sizes(spark, tmp_path):
    path = str(tmp_path / "out")
    df = spark.createDataFrame([("a", 1), ("b", 2)], "word string, n int")
    src.write_text(df, path, 3, ["word"])
    src.write_text(df, path, 1)
    assert sorted(r.line for r in src.read_lines(spark, path).collect()) == ["a\t1", "b\t2"]
    assert len(list((tmp_path / "out").glob("part-*"))) == 1


def test_index_files_are_in_term_order(spark, tmp_path):
    docs = spark.range(300).selectExpr("id AS docno", "concat('hot x', chr(97 + id % 26)) AS line")
    found = op.postings(docs)
    path = str(tmp_path / "index")
    src.write_index(found, path, 4)
    spans = []
    for f in sorted((tmp_path / "index").glob("part-*")):
        rows = [(r.term, r.docno) for r in spark.read.parquet(str(f)).collect()]
        assert rows == sorted(rows)
        spans.append((rows[0], rows[-1]))
    spans.sort()
    assert len(spans) == 4 and all(a[1] < b[0] for a, b in zip(spans, spans[1:]))
    # the hot term is in more than one file
    assert sum(lo[0] <= "hot" <= hi[0] for lo, hi in spans) > 1
    stored = spark.read.parquet(path)
    assert stored.exceptAll(found).count() == 0 and stored.count() == found.count()


def test_keyed_table_is_replaced(spark, tmp_path):
    path = str(tmp_path / "table")
    for text in ("a b", "c"):
        docs = spark.createDataFrame([(1, text)], "docno bigint, line string")
        src.write_keyed_table(op.postings_table(op.postings(docs)), path)
    assert [(r.term, r.cells) for r in spark.read.parquet(path).collect()] == [("c", {1: 1})]


def test_state_dir_reads_the_session(spark):
    class Conf:
        def __init__(self, **values):
            self.values = values

        def get(self, key, default=None):
            return self.values.get(key.replace(".", "_"), default)

    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(spark_checkpoint_dir="hdfs://shared/state/"), Context()

    assert src.state_dir(Session()) == "hdfs://shared/state"
    Session.conf = Conf(spark_sql_warehouse_dir="hdfs://shared/warehouse")
    assert src.state_dir(Session()) == "hdfs://shared/warehouse/_state"


def test_bad_field_is_an_error_only_where_used(spark, tmp_path):
    write(tmp_path / "nation.tbl", "3|CANADA|x|c|\n")
    nation = src.read_tbl(spark, str(tmp_path), "nation")
    assert nation.select("n_name").first().n_name == "CANADA"
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        nation.collect()


def test_models_have_folders_of_their_own(spark, tmp_path):
    rows = [(m, f, f / 7) for m in ("a", "b c", "d/e", "50%+1") for f in range(30)]
    models = spark.createDataFrame(rows, "model string, feature int, weight double")
    path = str(tmp_path / "models")
    src.write_model(models.repartition(5), path, one_folder_per="model")
    got = sorted(map(tuple, src.read_models(spark, path).collect()))
    assert [(m, f) for m, f, _ in got] == sorted((m, f) for m, f, _ in rows)
    assert [w for *_, w in got] == pytest.approx([w for *_, w in sorted(rows)])
    assert "REBALANCE_PARTITIONS_BY_COL" in plan_of_write(spark, models)
    src.write_model(models.limit(0), path, one_folder_per="model")


def plan_of_write(spark, models):
    from pyspark.sql import functions as F

    return models.hint("rebalance", F.col("model"))._jdf.queryExecution().executedPlan().toString()


def test_intermediate_tables_can_be_removed(spark, tmp_path):
    from corpuskit.sources import state

    state.release(spark)
    kept = src.cut(spark.range(3), "kept", str(tmp_path / "kept"))
    cut = src.cut(spark.range(5), "cut")
    table = src.bucketed(spark.range(7), "buckets", ["id"], 2)
    assert (cut.count(), table.count()) == (5, 7)
    names = {t.name for t in spark.catalog.listTables()}
    assert src.release(spark) == 2 and src.release(spark) == 0
    assert len(names) - len({t.name for t in spark.catalog.listTables()}) == 1
    assert kept.count() == 3
    with pytest.raises(Exception):  # noqa: B017
        spark.read.parquet(cut.inputFiles()[0]).count()


def test_offsets_of_documents_without_source_or_text(spark, tmp_path):
    from corpuskit.plans import storage

    rows = [(1, "a\nb", "x"), (2, None, "x"), (3, "c", None), (5000, "d", "x"), (None, "e", "x")]
    spark.createDataFrame(rows, "doc_id bigint, text string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {(r.source, r.range, r.docno): r.line for r in storage._offsets(spark, str(tmp_path)).collect()}
    assert got == {
        ("x", 0, 0): "#1", ("x", 0, 3): "a", ("x", 0, 5): "b", ("x", 0, 7): "#2", ("x", 0, 10): "",
        ("none", 0, 0): "#3", ("none", 0, 3): "c", ("x", 1, 0): "#5000", ("x", 1, 6): "d",
        ("x", -1, 0): "#", ("x", -1, 2): "e",
    }


def test_what_is_stored_leaves_no_shuffles(spark, tmp_path):
    def shuffled():
        own = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
        return {f for top in own for _, _, names in os.walk(top.getPath()) for f in names if re.match(r"shuffle_\d+_\d+_\d+\.data", f)}

    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    own = spark.conf.get(setting, None)
    rows = spark.range(1000).repartition(7, "id")
    rows.write.parquet(str(tmp_path / "plain"))
    before = shuffled()
    state.cut(rows, "rows")
    state.bucketed(rows, "rows", ["id"], 3)
    for _ in range(50):
        if shuffled() <= before:
            break
        time.sleep(0.2)
    assert before and shuffled() <= before and spark.conf.get(setting, None) == own


def test_tables_that_are_passing_are_removed(spark):
    rows = spark.range(5)
    with state.passing(spark, keep=("kept",)):
        with state.passing(spark):
            inner = state.cut(rows, "inner")
        kept, gone, table = state.cut(rows, "kept"), state.cut(rows, "gone"), state.bucketed(rows, "table", ["id"], 2)
        assert gone.count() == table.count() == 5
    assert kept.count() == 5
    for df in (inner, gone, table):
        assert not any(os.path.exists(f.removeprefix("file://").removeprefix("file:")) for f in df.inputFiles())


def test_a_key_for_each_bucket(spark):
    keys = state.bucket_keys(spark, 13)
    rows = spark.createDataFrame([(k,) for k in keys], "key int").repartition(13, "key")
    assert [r.p for r in rows.withColumn("p", F.spark_partition_id()).orderBy("p").collect()] == list(range(13))
