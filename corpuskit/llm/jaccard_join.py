"""N-gram Jaccard join by partitions of the shingle universe.

Two sets of similarity `num`/`den` or more whose smaller one has at most U
members differ in at most H = U * (den - num) / num members. For each band of
sizes, a hash deals all shingles into m > H segments. At most H of them differ,
so a set with u > H segments that aren't empty shares at least u - H of these with
every set that is similar enough. Its signatures are those of the H + 1 with the
most members, which cost the fewest chance meetings; ties go by content. Of the
segments that two sets share, the first in this order is a signature of both:
a set that left it out would have left out all the shared ones, u - H at least,
but it leaves out u - H - 1.

A set with H segments or fewer takes them all, and each of them with one member
deleted. If two such sets are not found that way, each segment that both have
differs in two members and each that one has in one, so together they have at
most H segments; for that case sets with fewer than H have signatures of their
empty segments as well.

Candidates share a signature. They are checked by size, by a bound from bit
parities and at last exactly on 64-bit shingle hashes.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.tables import load
from ..sources.state import cut
from . import bloom, exact_dedup
from .components import components
from .pretokens import chunks
from .workers import map_arrow

# Sizes of a band lie within this ratio; wide bands have more segments than
# their small sets need, narrow ones put more sets into two bands.
BAND_RATIO = 1.5

# Segments beyond those that can differ, as a share of them. Most signatures then
# have two members at least, and few sets have too few segments.
SLACK = 0.6

# 64-bit words of the short parity sketch of a set, and bits per member of the long one.
SKETCH_WORDS = 8
SKETCH_BITS = 4

# Nodes of a signature that are paired in one piece with those of another.
BLOCK = 256

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all others."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def shingles(text: str, words: int) -> np.ndarray:
    """Hashes of the distinct shingles of so many words, in order.

    Words lie between ASCII white space, A-Z are lower-cased. A text with fewer
    words is one shingle, one without words has none.
    """
    split = text.encode("utf-8", "surrogatepass").lower().split()
    if not split:
        return np.zeros(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, split), np.uint64, len(split))
    size = min(words, len(hashes))
    folded = np.full(len(hashes) - size + 1, size, np.uint64)
    for i in range(size):
        folded = mix(folded + hashes[i : i + len(folded)])
    return np.unique(folded)


@dataclass(frozen=True)
class Scheme:
    """How sets of sizes low .. high / threshold are cut into segments."""

    number: int
    low: int
    high: int
    differences: int
    segments: int


def _slack(differences: int) -> int:
    """How many more segments there are than have to be equal."""
    return math.ceil(SLACK * (differences + 1)) if differences else 0


@cache
def schemes(num: int, den: int, up_to: int) -> tuple[Scheme, ...]:
    """The bands of sizes from 1 to at least `up_to`."""
    out, low = [], 1
    while low <= up_to:
        high = max(low, int(low * BAND_RATIO))
        differences = high * (den - num) // num
        out.append(Scheme(len(out), low, high, differences, differences + 1 + _slack(differences)))
        low = high + 1
    return tuple(out)


def signatures(sets: list[np.ndarray], num: int, den: int) -> tuple[np.ndarray, np.ndarray]:
    """(number of the set, signature) of every signature of the sets."""
    sizes = np.array([len(s) for s in sets], np.int64)
    table = schemes(num, den, 1 << int(max(sizes.max(initial=1), 1)).bit_length())
    highs = np.array([s.high for s in table])
    own = np.searchsorted(highs, sizes)
    found = []
    for below in range(len(table)):
        # the own band, then lower ones whose sets can be similar
        of = np.flatnonzero((sizes > 0) & (own >= below))
        of = of[sizes[of] <= highs[own[of] - below] * den // num]
        if not len(of):
            break
        found.append(_in_scheme(sets, of, own[of] - below, table))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return np.concatenate([x for x, _ in found]), np.concatenate([x for _, x in found])


def _in_scheme(
    sets: list[np.ndarray], of: np.ndarray, numbers: np.ndarray, table: tuple[Scheme, ...]
) -> tuple[np.ndarray, np.ndarray]:
    """Signatures of the sets `of`, each by the scheme of its number."""
    members = np.concatenate([sets[i] for i in of])
    sizes = np.array([len(sets[i]) for i in of])
    segments = np.array([s.segments for s in table], np.uint64)[numbers]
    differences = np.array([s.differences for s in table])[numbers]
    salts = mix(np.arange(1, len(table) + 1, dtype=np.uint64))[numbers]
    total = segments.astype(np.int64)
    base = np.cumsum(total) - total

    dealt = mix(members ^ np.repeat(salts, sizes)) >> np.uint64(32)
    local = (dealt * np.repeat(segments, sizes)) >> np.uint64(32)
    at = local.astype(np.int64) + np.repeat(base, sizes)
    weights = mix(members + np.uint64(1))
    sums = np.zeros(int(total.sum()), np.uint64)
    np.add.at(sums, at, weights)
    counts = np.bincount(at, minlength=len(sums))
    owner = np.repeat(np.arange(len(of)), total)
    place = mix(np.repeat(salts, total) + (np.arange(len(sums)) - base[owner]).astype(np.uint64))

    used = np.add.reduceat((counts > 0).astype(np.int64), base)
    short = used <= differences
    found = mix(sums ^ place)
    # by set, the segments with the most members first
    key = np.minimum(counts, 255).astype(np.uint64) << np.uint64(56) | found >> np.uint64(8)
    order = np.lexsort((~key, owner))
    rank = np.empty(len(sums), np.int64)
    rank[order] = np.arange(len(sums)) - base[owner]
    chosen = (counts > 0) & (short[owner] | (rank <= differences[owner]))
    wanted = chosen | ((counts == 0) & (used < differences)[owner])
    out_owner, out = [owner[wanted]], [found[wanted]]
    if short.any():
        which = np.flatnonzero(np.repeat(short, sizes))
        which = which[counts[at[which]] > 1]
        out_owner.append(np.repeat(np.arange(len(of)), sizes)[which])
        out.append(mix((sums[at[which]] - weights[which]) ^ place[at[which]]))
    return of[np.concatenate(out_owner)], np.concatenate(out)


def _parities(members: np.ndarray, bits: int) -> np.ndarray:
    """The number of members per bit, modulo 2, as bytes; `bits` is a power of two.

    The sketches of two sets differ in at most as many bits as the sets in
    members. A sketch with fewer bits is one with more bits folded by exclusive or.
    """
    bit = mix(members + np.uint64(2)) & np.uint64(bits - 1)
    odd = np.bincount(bit.astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8))


def _folded(sketch: np.ndarray, size: int) -> np.ndarray:
    """A sketch folded to so many bytes."""
    return np.bitwise_xor.reduce(sketch.reshape(-1, size), axis=0)


def may_be_similar(n: int, m: int, x: bytes, y: bytes, num: int, den: int) -> bool:
    """Whether two sets of these sizes and long sketches can have the similarity."""
    x, y = np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)
    size = min(len(x), len(y))
    apart = int(np.bitwise_count(_folded(x, size) ^ _folded(y, size)).sum())
    # |x ^ y| <= (|x| + |y|) * (den - num) / (den + num)
    return apart * (den + num) <= (n + m) * (den - num)


def _signature_rows(docs: DataFrame, words: int, num: int, den: int) -> DataFrame:
    """(sig, node) of (node, text): every signature of every text."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes = batch.column(0).to_numpy(zero_copy_only=False)
            for a, b, texts in chunks(batch.column(1)):
                sets = [shingles(t, words) for t in texts]
                which, found = signatures(sets, num, den)
                columns = [pa.array(found.view(np.int64)), pa.array(nodes[a:b][which])]
                yield pa.RecordBatch.from_arrays(columns, ["sig", "node"])

    return map_arrow(docs, run, "sig bigint, node bigint")


def _members(rows: DataFrame) -> DataFrame:
    """(sig, node, hub): the rows of signatures that several nodes share, but for their smallest node.

    That node is the signature's hub. Rows are dealt by signature and sorted, so
    one look at each finds them, and nothing but the last row is kept.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # signature and hub of the row before
        for batch in batches:
            sig, node = (batch.column(i).to_numpy() for i in range(2))
            if not len(sig):
                continue
            first = np.ones(len(sig), bool)
            first[1:] = sig[1:] != sig[:-1]
            hub = node[np.maximum.accumulate(np.where(first, np.arange(len(sig)), 0))]
            if last and last[0] == sig[0]:
                hub[sig == sig[0]] = last[1]
            last = (sig[-1], hub[-1])
            keep = node != hub
            yield pa.RecordBatch.from_arrays([pa.array(x[keep]) for x in (sig, node, hub)], ["sig", "node", "hub"])

    dealt = rows.repartition("sig").sortWithinPartitions("sig", "node")
    return map_arrow(dealt, run, "sig bigint, node bigint, hub bigint")


_SKETCH = [f"s{i}" for i in range(SKETCH_WORDS)]


def _sketches(docs: DataFrame, words: int) -> DataFrame:
    """(node, n, long, s0, s1, ..) of (node, text): the size of every set, its long and its short sketch."""
    shortest = 64 * SKETCH_WORDS

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, texts in chunks(batch.column(1)):
                sets = [shingles(t, words) for t in texts]
                bits = [max(shortest, 1 << (SKETCH_BITS * len(s)).bit_length()) for s in sets]
                longs = [_parities(s, n) for s, n in zip(sets, bits, strict=True)]
                shorts = np.array([_folded(x, shortest // 8).view("<i8") for x in longs])
                columns = [
                    batch.column(0).slice(a, b - a),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([x.tobytes() for x in longs], pa.binary()),
                    *(pa.array(shorts[:, i]) for i in range(SKETCH_WORDS)),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["node", "n", "long", *_SKETCH])

    return map_arrow(docs, run, "node bigint, n bigint, long binary, " + ", ".join(f"{s} bigint" for s in _SKETCH))


def _sets(docs: DataFrame, words: int) -> DataFrame:
    """(node, hashes) of (node, text): the sets themselves, hashes in order."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, texts in chunks(batch.column(1)):
                hashes = pa.array([shingles(t, words).tobytes() for t in texts], pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), hashes], ["node", "hashes"])

    return map_arrow(docs, run, "node bigint, hashes binary")


def _possible(left: str, right: str, num: int, den: int) -> Column:
    """Whether sizes and sketches of two rows of `_sketches` allow the similarity."""
    n, m = F.col(f"{left}.n"), F.col(f"{right}.n")
    least = sum(
        (F.bit_count(F.col(f"{left}.s{i}").bitwiseXOR(F.col(f"{right}.s{i}"))) for i in range(SKETCH_WORDS)), F.lit(0)
    )
    # |x ^ y| <= (|x| + |y|) * (den - num) / (den + num)
    return (F.least(n, m) * den >= F.greatest(n, m) * num) & (least * (den + num) <= (n + m) * (den - num))


def _verified(pairs: DataFrame, sketches: DataFrame, docs: DataFrame, words: int, num: int, den: int) -> DataFrame:
    """(a, b): the pairs whose similarity is large enough.

    Sizes, short sketches and then long ones sort most pairs out; only the sets
    of the others are made and brought together.
    """
    short = sketches.select("node", "n", *_SKETCH)
    a, b = short.alias("x"), short.alias("y")
    hopeful = pairs.join(a, F.col("a") == F.col("x.node")).join(b, F.col("b") == F.col("y.node"))
    hopeful = hopeful.filter(_possible("x", "y", num, den))
    hopeful = hopeful.select("a", "b", F.col("x.n").alias("n"), F.col("y.n").alias("m"))
    longs = sketches.select("node", "long")
    hopeful = hopeful.join(longs.toDF("a", "left"), "a").join(longs.toDF("b", "right"), "b")

    def sort_out(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(batch[c].to_pylist() for c in ("n", "m", "left", "right")), strict=True)
            keep = [may_be_similar(*row, num, den) for row in rows]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    hopeful = hopeful.select("a", "b", "n", "m", "left", "right")
    hopeful = cut(map_arrow(hopeful, sort_out, "a bigint, b bigint"), "hopeful")
    ends = cut(hopeful.select("a").union(hopeful.select("b")).distinct(), "ends")
    sets = cut(_sets(bloom.within(docs, ends, "node"), words), "sets")
    both = hopeful.join(sets.toDF("a", "left"), "a").join(sets.toDF("b", "right"), "b").select("a", "b", "left", "right")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                common = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(common * den >= num * (len(x) + len(y) - common))
            mask = pa.array(keep, pa.bool_())
            yield batch.select(["a", "b"]).filter(mask)

    return map_arrow(both, run, "a bigint, b bigint")


def _nodes_hash() -> list[Column]:
    """Sums that tell which nodes a group has."""
    return [F.sum(F.xxhash64("node", F.lit(i)).cast("decimal(38,0)")).alias(f"h{i}") for i in range(2)]


def links(docs: DataFrame, words: int = 4, num: int = 85, den: int = 100, block: int = BLOCK) -> DataFrame:
    """(a, b), a < b: all pairs of distinct texts (node, text) whose shingle sets are similar enough.

    Every two nodes of a signature are a candidate. A signature with many nodes
    is dealt into pieces of some `block` nodes, and every two pieces meet by
    themselves. Work and result grow with the square of a group of near copies.
    """
    shared = cut(_members(_signature_rows(docs, words, num, den)), "members")
    hubs = shared.select("sig", "hub").distinct()
    each = cut(shared.select("sig", "node").union(hubs).distinct(), "shared")
    nodes = cut(each.select("node").distinct(), "nodes")
    sketches = cut(_sketches(bloom.within(docs, nodes, "node"), words), "sketches")

    # of signatures that the same nodes share, one
    held = each.groupBy("sig").agg(F.count(F.lit(1)).alias("held"), *_nodes_hash())
    one = cut(held.groupBy("h0", "h1", "held").agg(F.min("sig").alias("sig")).select("sig", "held"), "one")
    pieces = F.ceil(F.col("held") / block).cast("int")
    dealt = each.join(one, "sig").withColumn("pieces", pieces)
    dealt = dealt.withColumn("piece", F.pmod(F.xxhash64("node"), "pieces").cast("int"))
    dealt = cut(dealt.join(sketches.drop("long"), "node"), "dealt")
    x = dealt.withColumn("p", F.col("piece")).withColumn("q", F.explode(F.sequence("piece", F.col("pieces") - 1))).alias("x")
    y = dealt.withColumn("q", F.col("piece")).withColumn("p", F.explode(F.sequence(F.lit(0), "piece"))).alias("y")
    met = (F.col("x.sig") == F.col("y.sig")) & (F.col("x.p") == F.col("y.p")) & (F.col("x.q") == F.col("y.q"))
    met &= ((F.col("x.p") < F.col("x.q")) | (F.col("x.node") < F.col("y.node"))) & _possible("x", "y", num, den)
    ends = F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")
    return _verified(x.join(y, met).select(*ends).distinct(), sketches, docs, words, num, den)


def connecting_links(docs: DataFrame, words: int = 4, num: int = 85, den: int = 100) -> tuple[DataFrame, DataFrame]:
    """Components of distinct texts (node, text) by Jaccard similarity of at least num/den of their shingle sets.

    Returns (a, b), verified links, and (node, component), the smallest node
    that each linked node reaches. The components are those of all links. The
    links are complete but for those between nodes that others already connect:
    first every node is compared with the hub of each of its signatures, then
    those that share a signature and are still in different components with each
    other.
    """
    shared = cut(_members(_signature_rows(docs, words, num, den)), "members")
    nodes = cut(shared.select("node").union(shared.select("hub")).distinct(), "nodes")
    sketches = cut(_sketches(bloom.within(docs, nodes, "node"), words), "sketches")

    tried = shared.select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct()
    first = cut(_verified(tried, sketches, docs, words, num, den), "links")
    found = cut(components(first), "components")

    # signatures with nodes besides the hub that are not all in one component yet;
    # of those that the same nodes share, one
    of = F.coalesce("component", "node").alias("component")
    each = cut(shared.select("sig", "node").join(found, "node", "left").select("sig", "node", of), "open")
    held = each.groupBy("sig").agg(F.min("component").alias("least"), F.max("component").alias("most"), *_nodes_hash())
    unsettled = held.filter("least <> most").groupBy("h0", "h1").agg(F.min("sig").alias("sig"))
    unsettled = cut(unsettled.select("sig"), "unsettled")
    short = sketches.drop("long")
    several = cut(each.join(unsettled, "sig", "left_semi").join(short, "node"), "several")
    x, y = several.alias("x"), several.alias("y")
    apart = (F.col("x.sig") == F.col("y.sig")) & (F.col("x.node") < F.col("y.node"))
    apart &= (F.col("x.component") != F.col("y.component")) & _possible("x", "y", num, den)
    rest = x.join(y, apart).select(F.col("x.node").alias("a"), F.col("y.node").alias("b")).distinct()
    rest = rest.join(tried, ["a", "b"], "left_anti")
    second = cut(_verified(rest, sketches, docs, words, num, den), "links")
    edges = first.unionByName(second)
    return edges, cut(components(edges), "components")


def _sizes(docs: DataFrame, words: int) -> DataFrame:
    """(doc_id, n_shingles) of (node, text)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = [len(shingles(t, words)) for _, _, texts in chunks(batch.column(1)) for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64())], ["doc_id", "n_shingles"])

    return map_arrow(docs, run, "doc_id bigint, n_shingles bigint")


def _distinct(df: DataFrame, key: str, text: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(doc_id, keep_id) of all rows with key and words, the same of copies, and (node, text) without copies."""
    own = df.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).alias("text")).filter("doc_id IS NOT NULL")
    own = own.filter(F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    marked = cut(exact_dedup.mark(own).select("doc_id", "keep_id"), "marked")
    copies = cut(marked.filter("doc_id <> keep_id"), "copies")
    texts = bloom.without(own, copies.select("doc_id"), "doc_id").withColumnRenamed("doc_id", "node")
    return marked, copies, texts


def classes(
    df: DataFrame, key: str = "doc_id", text: str = "text", words: int = 4, num: int = 85, den: int = 100
) -> DataFrame:
    """(doc_id, component_id) of the rows that are not alone: copies, and rows with a link.

    Rows with equal normalised text are put together first (`exact_dedup`), so
    only one row of a group of copies is compared. Keys are integers and should
    be unique; of the classes of rows that share one, the smallest is given.
    Rows without key or without words have no link.
    """
    _, copies, texts = _distinct(df, key, text)
    _, found = connecting_links(texts, words, num, den)
    of_copies = copies.join(found, copies["keep_id"] == found["node"], "left").select(
        "doc_id", F.coalesce("component", "keep_id").alias("component_id")
    )
    both = found.toDF("doc_id", "component_id").unionByName(of_copies)
    return both.groupBy("doc_id").agg(F.min("component_id").alias("component_id"))


def jaccard_classes(
    df: DataFrame, key: str = "doc_id", text: str = "text", words: int = 4, num: int = 85, den: int = 100
) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row: the smallest key reachable by links, itself included.

    Null or empty text has no shingles and no link; a row without key has
    neither component nor link; other columns of `df` play no part.
    """
    own = df.select(F.col(key).cast("bigint").alias("node"), F.col(text).alias("text"))
    found = cut(classes(df, key, text, words, num, den), "classes")
    sized = _sizes(own, words)
    return sized.join(found, "doc_id", "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")
    )


def jaccard_links(
    df: DataFrame, key: str = "doc_id", text: str = "text", words: int = 4, num: int = 85, den: int = 100
) -> DataFrame:
    """(doc_id, n_shingles, n_links, component_id) for every row: the number of rows similar enough, and its class.

    All links count, copies of the row and of linked rows too; these are added up
    by group of copies. Keys should be unique; of rows that share one, the
    largest number is given. Otherwise as in `jaccard_classes`.
    """
    own = df.select(F.col(key).cast("bigint").alias("node"), F.col(text).alias("text"))
    marked, _, texts = _distinct(df, key, text)
    found = cut(links(texts, words, num, den), "links")
    held = cut(marked.distinct().groupBy("keep_id").agg(F.count(F.lit(1)).alias("held")), "held")
    ends = found.unionByName(found.select(F.col("b").alias("a"), F.col("a").alias("b")))
    linked = ends.join(held, F.col("b") == F.col("keep_id")).groupBy("a").agg(F.sum("held").alias("linked"))
    classes = cut(components(found), "components")
    each = held.join(linked, F.col("keep_id") == F.col("a"), "left").join(classes, F.col("keep_id") == F.col("node"), "left")
    each = each.select(
        "keep_id",
        (F.col("held") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links"),
        F.coalesce("component", "keep_id").alias("component_id"),
    )
    rows = marked.join(each, "keep_id").groupBy("doc_id")
    rows = cut(rows.agg(F.max("n_links").alias("n_links"), F.min("component_id").alias("component_id")), "rows")
    return _sizes(own, words).join(rows, "doc_id", "left").select(
        "doc_id",
        "n_shingles",
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
        F.coalesce("component_id", "doc_id").alias("component_id"),
    )


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the size of its set of 4-word shingles and its class at similarity 0.85."""
    return jaccard_classes(load(spark, sf_dir, "documents"))


def op10_jaccard_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As `op10_jaccard_join`, with every document's number of links to others."""
    return jaccard_links(load(spark, sf_dir, "documents"))


QUERIES = {"op10_jaccard_join": op10_jaccard_join, "op10_jaccard_links": op10_jaccard_links}

ORACLES = {
    "op10_jaccard_join": r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS ws
  FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
    ELSE list_distinct(list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i+3], ' '))) END AS s
  FROM words),
members AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets),
pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c, any_value(a.n) AS n, any_value(b.n) AS m
  FROM members a JOIN members b ON a.x = b.x AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM pairs WHERE 100 * c >= 85 * (n + m - c)),
reach AS (
  SELECT doc_id AS node, doc_id AS other FROM sets
  UNION SELECT reach.node, links.b FROM reach JOIN links ON reach.other = links.a)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id
FROM sets JOIN (SELECT node, min(other) AS component_id FROM reach GROUP BY node) ON node = doc_id"""
}

_CLASSES = ORACLES["op10_jaccard_join"]
_COUNTED = "SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, (SELECT count(*) FROM links WHERE a = doc_id) AS n_links, component_id"
ORACLES["op10_jaccard_links"] = _CLASSES[: _CLASSES.rindex("SELECT doc_id")] + _COUNTED + _CLASSES[_CLASSES.rindex("\nFROM sets JOIN") :]
