"""Secret scans with a ledger of blobs: each text is scanned once per rule version."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.skew import default_pieces, piece_of
from ..plans.tables import load
from ..sources.state import cut, fresh_path
from . import bloom, places


def _either_case(word: str) -> str:
    """A pattern for the ASCII letters of `word` in either case, alike in all regex dialects."""
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)


@dataclass(frozen=True)
class Rule:
    """A kind of secret: a match counts if the group has at least so many characters."""

    kind: str
    pattern: str
    group: int
    least: int
    version: int = 1


# Kinds in the order that breaks ties, patterns and lengths.
ASSIGN = (
    "(" + "|".join(_either_case(w) for w in ("password", "passwd", "secret", "token", "api_?key")) + ")"
    r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
RULES = (
    Rule("assign", ASSIGN, 2, 6),
    Rule("access", "AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", "[0-9a-f]+", 0, 24),
)

_LEDGER = T.StructType(
    [
        T.StructField("blob", T.BinaryType()),
        T.StructField("kind", T.StringType()),
        T.StructField("version", T.IntegerType()),
        T.StructField("gaps", T.ArrayType(T.IntegerType())),
        T.StructField("lengths", T.ArrayType(T.IntegerType())),
        T.StructField("counts", T.ArrayType(T.BooleanType())),
    ]
)


def blob_id(text: str | Column) -> Column:
    """A text's content address: the SHA-256 of its UTF-8 bytes; null counts as empty."""
    text = F.col(text) if isinstance(text, str) else text
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256))


def _search(rule: Rule) -> str:
    """A pattern that matches a text exactly if the rule has a match that counts or may have one."""
    if rule.group == 0 and rule.pattern.endswith("]+"):
        # a run that is too short cannot hide one that is long enough
        fixed = rule.pattern[: rule.pattern.index("[")]
        return f"{rule.pattern[:-1]}{{{rule.least - len(fixed)},}}"
    return rule.pattern


def _matches(rule: Rule, text: Column, pending: Column) -> Column:
    """gaps, lengths and counts of the rule's matches, empty where there are none.

    Gap i is the number of characters between match i and what precedes it, so
    the arrays are linear in the number of matches. Short matches are kept, as
    they move the ones after them, but don't count.
    """
    found = pending & text.rlike(_search(rule))
    pattern = F.lit(rule.pattern)
    lengths = lambda values: F.transform(values, F.length)
    every = F.regexp_extract_all(text, pattern, F.lit(0))
    group = every if rule.group == 0 else F.regexp_extract_all(text, pattern, F.lit(rule.group))
    matched = F.struct(
        lengths(F.split(text, rule.pattern, -1)).alias("gaps"),
        lengths(every).alias("lengths"),
        F.transform(group, lambda v: F.length(v) >= rule.least).alias("counts"),
    )
    none = F.struct(*[F.array().cast(f.dataType).alias(f.name) for f in _LEDGER.fields[3:]])
    return F.when(found, matched).otherwise(none)


def _scanned(blobs: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Ledger rows for (blob, text, pending): one per blob and pending kind."""
    text = F.coalesce(F.col("text"), F.lit(""))
    entries = F.array(
        *[
            F.struct(
                F.lit(r.kind).alias("kind"),
                F.lit(r.version).alias("version"),
                _matches(r, text, F.array_contains("pending", r.kind)).alias("m"),
            )
            for r in rules
        ]
    )
    due = F.filter(entries, lambda e: F.array_contains(F.col("pending"), e["kind"]))
    return blobs.select("blob", F.explode(due).alias("e")).select("blob", "e.kind", "e.version", "e.m.*")


def read_ledger(spark: SparkSession, path: str) -> DataFrame | None:
    """The ledger's rows, or None where nothing has been written yet."""
    try:
        return spark.read.schema(_LEDGER).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def _current(ledger: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    wanted = [F.struct(F.lit(r.kind), F.lit(r.version)) for r in rules]
    return ledger.filter(F.struct("kind", "version").isin(wanted))


def _digests(table: DataFrame, text: str) -> DataFrame:
    """(blob, row): the content address and the place of each row of a stored table."""
    return table.select(blob_id(text).alias("blob"), places.place(table).alias("row"))


def update_ledger(
    versions: DataFrame,
    text: str,
    ledger_path: str,
    rules: Sequence[Rule] = RULES,
    max_words: int = bloom.MAX_WORDS,
) -> None:
    """Scan the texts of `versions` for pairs of blob and rule version not in the ledger, and add them.

    A row whose blob can be neither repeated nor known, by two filters, is
    scanned for all rules. Of the others only content addresses meet; which rules
    are left for which row goes back to the rows' places, so texts are never
    exchanged and each blob is scanned once, in one of its rows.
    """
    table = places.stored(versions, "versions")
    _update(table, text, ledger_path, rules, cut(_digests(table, text), "blobs"), max_words)


def _update(
    table: DataFrame, text: str, ledger_path: str, rules: Sequence[Rule], digests: DataFrame, max_words: int = bloom.MAX_WORDS
) -> None:
    spark = table.sparkSession
    n_words = bloom.words_for(digests.count(), max_words)
    hash_ = F.xxhash64("blob")
    repeated = bloom.build(digests.select(hash_), n_words, at_least=2)
    tested = bloom.tested(digests, hash_, repeated, n_words, "held")
    ledger, known = read_ledger(spark, ledger_path), None
    if ledger is not None:
        done = _current(ledger, rules).groupBy("blob").agg(F.collect_set("kind").alias("done"))
        known = cut(done, "known")
        known_words = bloom.words_for(known.count(), max_words)
        filled = bloom.build(known.select(F.xxhash64("blob")), known_words)
        tested = bloom.tested(tested, hash_, filled, known_words, "seen")
        tested = tested.withColumn("held", F.col("held") | F.col("seen"))

    held = tested.filter("held").withColumn("piece", piece_of(["row"], default_pieces(table)))
    parts = held.groupBy("blob", "piece").agg(F.min("row").alias("first"))
    whole = parts.select("blob", "piece", F.min("first").over(Window.partitionBy("blob")).alias("first"))
    if known is not None:
        whole = whole.join(known, "blob", "left")
    else:
        whole = whole.withColumn("done", F.array().cast("array<string>"))
    later = F.col("row") != F.col("first")
    spared = [
        (later | F.coalesce(F.array_contains("done", r.kind), F.lit(False))).alias(f"spare{i}") for i, r in enumerate(rules)
    ]
    spare = [f"spare{i}" for i in range(len(rules))]
    flagged = held.join(whole, ["blob", "piece"]).select("row.*", *spared).filter(" OR ".join(spare))

    def due(rows: DataFrame, flags: list[Column]) -> DataFrame:
        kinds = [F.when(~flag, F.lit(r.kind)) for flag, r in zip(flags, rules, strict=True)]
        pending = F.array_compact(F.array(*kinds))
        own = rows.select(blob_id(text).alias("blob"), F.col(text).alias("text"), pending.alias("pending"))
        return _scanned(own.filter(F.size("pending") > 0), rules)

    places.with_flags(table, flagged, spare, due).write.mode("append").parquet(ledger_path)


def spans_of(ledger: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """(blob, spans): the blobs with secrets, each with its spans by start, then kind as in `rules`.

    Starts and ends are code points, end exclusive. Running sums over one
    text's matches turn gaps and lengths into positions.
    """
    number = F.create_map(*[F.lit(x) for i, r in enumerate(rules) for x in (r.kind, i)])
    hits = _current(ledger, rules).filter(F.array_contains("counts", True))
    each = hits.select(
        "blob",
        "kind",
        F.posexplode(F.arrays_zip(F.slice("gaps", 1, F.size("lengths")).alias("g"), F.col("lengths").alias("l"), F.col("counts").alias("c"))).alias("i", "m"),
    )
    upto = Window.partitionBy("blob", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    # the same pair can be in the ledger twice, if two runs added it at once
    each = each.dropDuplicates(["blob", "kind", "i"]).withColumn("end", F.sum(F.col("m.g") + F.col("m.l")).over(upto))
    span = F.struct(
        (F.col("end") - F.col("m.l")).alias("start"), number[F.col("kind")].alias("order"), "end", "kind"
    )
    spans = F.sort_array(F.collect_list(span))
    return each.filter("m.c").groupBy("blob").agg(spans.alias("spans"))


def scan(
    versions: DataFrame,
    ids: Sequence[str],
    text: str,
    ledger_path: str | None = None,
    rules: Sequence[Rule] = RULES,
) -> DataFrame:
    """(ids, spans): every row of `versions` with the secrets in its text, an empty array if none.

    `versions` holds every historical version of every path, one text each; `ids`
    name its path and version, and may repeat or be null. Only texts and rule
    versions that the ledger in `ledger_path` has not seen are scanned; without a
    path there is a fresh ledger. The findings are then joined back to all rows
    by content address. Null text counts as empty, empty input gives no rows, and
    other columns play no part.
    """
    spark = versions.sparkSession
    ledger_path = ledger_path or fresh_path(spark, "ledger")
    table = places.stored(versions, "versions")
    rows = cut(table.select(*ids, blob_id(text).alias("_blob"), places.place(table).alias("_row")), "versions")
    _update(table, text, ledger_path, rules, rows.select(F.col("_blob").alias("blob"), F.col("_row").alias("row")))
    found = cut(spans_of(read_ledger(spark, ledger_path), rules), "findings")
    joined = rows.join(found.withColumnRenamed("blob", "_blob"), "_blob", "left")
    none = F.array().cast(found.schema["spans"].dataType)
    return joined.select(*ids, F.coalesce("spans", none).alias("spans"))


def redact(
    versions: DataFrame,
    text: str,
    ledger_path: str | None = None,
    rules: Sequence[Rule] = RULES,
    mark: str = "[SECRET]",
) -> DataFrame:
    """`versions` with every secret in its text replaced by `mark`; touching or overlapping spans are one.

    Rows whose text is known to have none, by a filter over the findings, stay
    where they are; the others are joined with the findings by content address.
    """
    spark = versions.sparkSession
    ledger_path = ledger_path or fresh_path(spark, "ledger")
    versions = places.stored(versions, "versions")
    update_ledger(versions, text, ledger_path, rules)
    found = cut(spans_of(read_ledger(spark, ledger_path), rules), "findings")
    blob = bloom.unused(versions, "_blob")
    clear, maybe = bloom.split(versions.withColumn(blob, blob_id(text)), found.select("blob"), blob)
    kind = "struct<at:int,out:string>"

    def step(done: Column, span: Column) -> Column:
        gap = F.substring(text, done["at"], span["start"].cast("int") + 1 - done["at"])
        out = F.when(span["start"] + 1 > done["at"], F.concat(done["out"], gap, F.lit(mark)))
        out = out.when(done["at"] == 1, F.lit(mark)).otherwise(done["out"])
        return F.struct(F.greatest(done["at"], span["end"].cast("int") + 1).alias("at"), out.alias("out")).cast(kind)

    start = F.struct(F.lit(1).alias("at"), F.lit("").alias("out")).cast(kind)
    rest = lambda done: F.concat(done["out"], F.substring(text, done["at"], F.length(text) + 1))
    spans = f"{blob}_spans"
    joined = maybe.join(found.select(F.col("blob").alias(blob), F.col("spans").alias(spans)), blob, "left")
    clean = F.when(F.col(spans).isNull(), F.col(text)).otherwise(F.aggregate(spans, start, step, rest))
    return clear.select(*versions.columns).unionByName(joined.withColumn(text, clean).select(*versions.columns))


def described(spans: str) -> Column:
    """kind:start:end of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its number of secrets of each kind and all their places.

    The ledger's method adds no spans to those of the rules, so `spans` holds what
    `base_sha256` is the digest of.
    """
    found = scan(load(spark, sf_dir, "documents"), ["doc_id"], "text")
    spans, kinds = described("spans"), F.transform("spans", lambda s: s["kind"])
    counts = [
        F.size(F.filter(kinds, lambda k: k == F.lit(kind))).cast("bigint").alias(f"n_{kind}")  # noqa: B023
        for kind in (r.kind for r in RULES)
    ]
    return found.select("doc_id", *counts, F.sha2(spans.cast("binary"), 256).alias("base_sha256"), spans.alias("spans"))


QUERIES = {"op9_secret_scan": op9_secret_scan}


def _sql_spans(i: int, rule: Rule) -> str:
    pattern = rule.pattern.replace("'", "''")
    return f"""
  SELECT doc_id, '{rule.kind}' AS kind, {i} AS ord, unnest(list_transform(range(1, len(ms) + 1), lambda j: struct_pack(
      s := list_sum(list_transform(gaps[1:j], lambda g: length(g))) + coalesce(list_sum(list_transform(ms[1:j-1], lambda m: length(m))), 0),
      l := length(ms[j]), ok := length(gs[j]) >= {rule.least}))) AS x
  FROM (SELECT doc_id, string_split_regex(t, '{pattern}') AS gaps,
               regexp_extract_all(t, '{pattern}', 0) AS ms, regexp_extract_all(t, '{pattern}', {rule.group}) AS gs
        FROM texts WHERE regexp_matches(t, '{pattern}'))"""


ORACLES = {
    "op9_secret_scan": "WITH texts AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),\nfound AS ("
    + "\n  UNION ALL".join(_sql_spans(i, r) for i, r in enumerate(RULES))
    + """),
spans AS (
  SELECT doc_id, kind, ord, CAST(x.s AS BIGINT) AS s, CAST(x.s + x.l AS BIGINT) AS e FROM found WHERE x.ok),
per_doc AS (
  SELECT doc_id, string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, ord) AS spans,
         count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
         count(*) FILTER (kind = 'hex') AS n_hex
  FROM spans GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM documents d LEFT JOIN per_doc USING (doc_id)"""
}
