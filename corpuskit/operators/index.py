"""Inverted index. The flat postings (term, keys, tf) are the stored form.

A document is named by `keys`: its number, the last of them, and before it
whatever the number is unique within, such as the path of a file. Lists are
views on the postings, one per term and path, cut into segments of so many
postings, however far apart their document numbers are. A list of at most
LONGEST postings is put together in one row and cut there. That of a more
frequent term could be as long as the collection, so its places are found in two
steps: its postings are stored in ranges of (term, keys), every range is numbered
by itself, and only each range's totals are added up over a term.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.state import cut, cut_counted, tasks_for
from .skew import default_pieces

SEGMENT_SIZE = 1 << 16

# Postings of a list that is put together in one row.
LONGEST = 1 << 16

# Hashes by which lists are counted first; a power of two.
BUCKETS = 1 << 16

# Segments whose sums are added up together when gaps are decoded.
GROUP = 1 << 10

# Characters of text for which an occurrence is expected; only the number of tasks follows from it.
PER_OCCURRENCE = 4

KEYS = ("docno",)


def postings(docs: DataFrame, line: str = "line", keys: Sequence[str] = KEYS) -> DataFrame:
    """(term, keys, tf), one row per term and document.

    Occurrences are dealt out as they are: a term comes again only within its
    document, so a task that counted what it reads would hold nearly all of it.
    The length of the texts says over how many tasks.
    """
    from .text_stats import words

    length = docs.agg(F.sum(F.length(line).cast("bigint")).alias("n")).first()["n"] or 0
    return (
        words(docs, line, *keys)
        .repartition(tasks_for(docs.sparkSession, length // PER_OCCURRENCE), "word", *keys)
        .groupBy(F.col("word").alias("term"), *keys)
        .agg(F.count(F.lit(1)).cast("int").alias("tf"))
    )


def _placed(postings: DataFrame, segment_size: int, keys: Sequence[str]) -> DataFrame:
    """(term, keys, tf, df, segment, pos, gap): every posting's place in its list."""
    *within, docno = keys
    listed = ["term", *within]
    n = default_pieces(postings)
    ranged = postings.filter(F.col("term").isNotNull()).repartitionByRange(n, *listed, docno)
    stored = cut(ranged.withColumn("_range", F.spark_partition_id()), "ranges")
    of_range = Window.partitionBy("_range", *listed)
    in_range = of_range.orderBy(docno)
    own = stored.withColumns(
        {
            "_i": F.row_number().over(in_range),
            "_before": F.lag(docno).over(in_range),
            "_n": F.count(F.lit(1)).over(of_range),
        }
    )
    ends = stored.groupBy("_range", *listed).agg(F.count(F.lit(1)).alias("_n"), F.max(docno).alias("_last"))
    # at most one row per range and list
    of_list = Window.partitionBy(*listed)
    in_list = of_list.orderBy("_range")
    earlier = in_list.rowsBetween(Window.unboundedPreceding, -1)
    facts = cut(
        ends.select(
            "_range",
            *listed,
            F.sum("_n").over(of_list).alias("df"),
            F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_skip"),
            F.lag("_last", 1, 0).over(in_list).alias("_previous"),
        ),
        "ranges",
    )
    joined = own.join(facts, ["_range", *listed])
    at = F.col("_skip") + F.col("_i") - 1
    return joined.select(
        *listed,
        docno,
        "tf",
        "df",
        F.floor(at / segment_size).alias("segment"),
        (at % segment_size).cast("int").alias("pos"),
        (F.col(docno) - F.coalesce("_before", "_previous")).alias("gap"),
    )


def _long_lists(stored: DataFrame, listed: Sequence[str], longest: int, buckets: int = BUCKETS) -> DataFrame:
    """(listed): the lists of more than `longest` postings, exactly.

    Postings are counted by a hash of their list first, which each task reduces
    to `buckets` rows; only lists in buckets that are full enough are counted by
    themselves.
    """
    hashed = stored.select(*listed, F.xxhash64(*listed).bitwiseAND(F.lit(buckets - 1)).alias("_bucket"))
    counts = hashed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("n"))
    full = cut(counts.filter(F.col("n") > longest).select("_bucket"), "full")
    sizes = hashed.join(full, "_bucket", "left_semi").groupBy(*listed).agg(F.count(F.lit(1)).alias("n"))
    return sizes.filter(F.col("n") > longest).select(*listed)


def _lists(postings: DataFrame, keys: Sequence[str], longest: int) -> tuple[DataFrame, DataFrame | None]:
    """(term, .., df, list) of all lists of at most `longest` postings, by docno, and the postings of the others.

    Only few counts are shuffled to tell them apart; there are few of the others.
    """
    *within, docno = keys
    listed = ["term", *within]
    stored, n = cut_counted(postings.filter(F.col("term").isNotNull()).select(*listed, docno, "tf"), "postings")
    long = cut(_long_lists(stored, listed, longest).select(F.struct(*listed).alias("_list")), "long")
    rest = None
    if not long.isEmpty():
        named = stored.withColumn("_list", F.struct(*listed))
        rest = named.join(long, "_list", "left_semi").drop("_list")
        stored = named.join(long, "_list", "left_anti").drop("_list")
    entries = F.sort_array(F.collect_list(F.struct(docno, "tf")))
    # dealt out as they are, a bounded number for a task; collecting what a task reads would only sort it once more
    dealt = stored.repartition(tasks_for(stored.sparkSession, n), *listed)
    return dealt.groupBy(*listed).agg(F.count(F.lit(1)).alias("df"), entries.alias("list")), rest


def _cut_lists(lists: DataFrame, segment_size: int, listed: Sequence[str]) -> DataFrame:
    """(term, .., segment, df, postings) from whole lists."""
    last = F.floor((F.col("df") - 1) / segment_size)
    each = lists.select(*listed, F.explode(F.sequence(F.lit(0).cast("bigint"), last)).alias("segment"), "df", "list")
    part = F.slice("list", (F.col("segment") * segment_size + 1).cast("int"), F.lit(segment_size))
    return each.select(*listed, "segment", "df", part.alias("postings"))


def inverted_index(
    postings: DataFrame, segment_size: int = SEGMENT_SIZE, keys: Sequence[str] = KEYS, longest: int = LONGEST
) -> DataFrame:
    """(term, .., segment, df, postings), postings an array of (docno, tf) by docno."""
    *within, docno = keys
    listed = ["term", *within]
    lists, rest = _lists(postings, keys, longest)
    index = _cut_lists(lists, segment_size, listed)
    if rest is None:
        return index
    entries = F.sort_array(F.collect_list(F.struct(docno, "tf")))
    placed = _placed(rest, segment_size, keys).groupBy(*listed, "segment")
    return index.unionByName(placed.agg(F.max("df").alias("df"), entries.alias("postings")))


def encode_gaps(
    postings: DataFrame, segment_size: int = SEGMENT_SIZE, keys: Sequence[str] = KEYS, longest: int = LONGEST
) -> DataFrame:
    """(term, .., segment, pos, gap, tf): docno differences along a term's whole list.

    The first gap of a list counts from 0 and gaps run on across segments.
    """
    *within, docno = keys
    lists, rest = _lists(postings, keys, longest)

    def entry(x: Column, i: Column) -> Column:
        before = F.when(i > 0, F.get("list", i - 1)[docno]).otherwise(F.lit(0))
        return F.struct(
            F.floor(i / segment_size).alias("segment"),
            (i % segment_size).cast("int").alias("pos"),
            (x[docno] - before).alias("gap"),
            x["tf"].alias("tf"),
        )

    gaps = lists.select("term", *within, F.explode(F.transform("list", entry)).alias("e")).select("term", *within, "e.*")
    if rest is None:
        return gaps
    return gaps.unionByName(_placed(rest, segment_size, keys).select("term", *within, "segment", "pos", "gap", "tf"))


def decode_gaps(gaps: DataFrame, keys: Sequence[str] = KEYS, group: int = GROUP) -> DataFrame:
    """(term, keys, tf) from gaps: running sums in a segment, over a group's segments and over groups."""
    *within, docno = keys
    listed = ["term", *within]

    def before(order: str, *of: str) -> Window:
        return Window.partitionBy(*listed, *of).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)

    def start(window: Window) -> Column:
        return F.coalesce(F.sum("_sum").over(window), F.lit(0))

    grouped = F.floor(F.col("segment") / group).alias("_group")
    segments = gaps.groupBy(*listed, grouped, "segment").agg(F.sum("gap").alias("_sum"))
    groups = segments.groupBy(*listed, "_group").agg(F.sum("_sum").alias("_sum"))
    first = groups.select(*listed, "_group", start(before("_group")).alias("_first"))
    inside = segments.select(*listed, "_group", "segment", start(before("segment", "_group")).alias("_inside"))
    base = cut(
        inside.join(first, [*listed, "_group"]).select(
            *listed, "segment", (F.col("_first") + F.col("_inside")).alias("_base")
        ),
        "segments",
    )
    so_far = Window.partitionBy(*listed, "segment").orderBy("pos").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    running = gaps.withColumn("_run", F.sum("gap").over(so_far))
    return running.join(base, [*listed, "segment"]).select(
        *listed, (F.col("_base") + F.col("_run")).alias(docno), "tf"
    )


def postings_table(
    postings: DataFrame, segment_size: int = SEGMENT_SIZE, keys: Sequence[str] = KEYS, longest: int = LONGEST
) -> DataFrame:
    """(term, .., segment, cells) with cells a map docno -> tf; a repeated cell is summed."""
    *within, _ = keys
    # stored first, so that a task sums a bounded number of cells, and sums only
    stored, n = cut_counted(postings, "postings")
    dealt = stored.repartition(tasks_for(stored.sparkSession, n), "term", *keys)
    cells = dealt.groupBy("term", *keys).agg(F.sum("tf").cast("int").alias("tf"))
    index = inverted_index(cells, segment_size, keys, longest)
    return index.select("term", *within, "segment", F.map_from_entries("postings").alias("cells"))
