"""Line co-occurrence and pointwise mutual information (PMI)."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from ..functions import vocab
from ..sources.state import cut

# Rows over which the partners of a word are spread, by a hash of the partner.
STRIPE_PARTS = 16

# Words of a line that are paired with as many others in one go.
BLOCK = 64

# A line with more different frequent words than this is paired by several tasks.
LONG_LINE = 4096

# The filter of frequent words: bits for each word, and 64-bit integers at most.
FILTER_BITS = 16
FILTER_WORDS = 1 << 20

# Frequent words that are numbered by their place in a dictionary, at most.
DICTIONARY = 1 << 20

# Words of lines that a task holds and counts the pairs of before it hands them on, and pairs that it makes at a time.
RUN_WORDS = 1 << 23
CHUNK = 1 << 23

# Pairs of lines, before they are counted, whose counts meet in one row, and blocks of partners of a group of words.
MEETING = 1 << 22
PARTNER_BLOCKS = 16

# Numbers below HOT have their partners, CELL numbers together, in all blocks.
HOT = 1 << 12
CELL = 1 << 12

# Size of the row groups of stored lines, so that many tasks can share a file.
ROW_GROUP = 8 << 20

# Salts that are tried until no two words have the same hash.
SALTS = 16


@dataclass(frozen=True)
class Vocabulary:
    """lines(keys, words): the different words of each line, stored. counted(word, h, df): every word, its
    hash, which no other word has, and in how many lines it is. n_lines: how many lines there are, n_words and
    n_pairs: how many words and pairs of words they have."""

    lines: DataFrame
    counted: DataFrame
    salt: int
    n_lines: int
    n_words: int
    n_pairs: int


def _hash(word: Column | str, salt: int) -> Column:
    return F.xxhash64(word, F.lit(salt))


def vocabulary(lines: DataFrame, line: str = "line", first_salt: int = 0, salts: int = SALTS, make=_hash) -> Vocabulary:
    """The words of all lines as numbers that need no dictionary.

    Lines are read once: their words are stored, and the lines are counted while
    that is written. Only (word, partial count) rows are shuffled. Numbers are
    64-bit hashes; if two words of all have the same one, the next salt is taken.
    """
    counter = Observation()
    n = F.size("words").cast("bigint")
    pairs = F.sum(F.when(n > 1, n * (n - 1) / 2)).cast("bigint")
    of_words = F.sum(F.when(n > 0, n))
    found = lines.select(vocab(line).alias("words"))
    found = found.observe(counter, F.count(F.lit(1)).alias("n"), of_words.alias("words"), pairs.alias("pairs"))
    stored = cut(found, "lines", row_group=ROW_GROUP, codec="zstd")
    each = stored.select(F.explode("words").alias("word"))
    counted = cut(each.groupBy("word").agg(F.count(F.lit(1)).alias("df")), "words")
    for salt in range(first_salt, first_salt + salts):
        hashed = counted.select("word", make("word", salt).alias("h"), "df")
        if hashed.groupBy("h").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").isEmpty():
            found = counter.get
            return Vocabulary(stored, hashed, salt, found["n"], found["words"] or 0, found["pairs"] or 0)
    raise RuntimeError("words have equal hashes with all salts")


def frequent_filter(frequent: DataFrame, size: int | None = None) -> tuple[DataFrame, int]:
    """One row (bits): a bit map in which every `h` of the rows has its bit, and the number of its 64-bit integers.

    It has about FILTER_BITS bits for each word, so it passes few others, but not
    more than FILTER_WORDS integers, however many words there are; what it passes
    beyond is only more work.
    """
    spark = frequent.sparkSession
    if size is None:
        wanted = frequent.count() * FILTER_BITS // 64
        size = min(FILTER_WORDS, 1 << max(wanted - 1, 1).bit_length())
    place, bit = _bit(F.col("h"), size)
    words = frequent.select(place.alias("i"), bit.alias("b")).groupBy("i").agg(F.bit_or("b").alias("b"))
    every = spark.range(size).select(F.col("id").cast("int").alias("i")).join(words, "i", "left")
    entry = F.struct("i", F.coalesce("b", F.lit(0)).alias("b"))
    return every.agg(F.sort_array(F.collect_list(entry))["b"].alias("bits")), size


def _bit(h: Column, size: int) -> tuple[Column, Column]:
    """The integer and the bit of a hash in a map of `size` integers, a power of two."""
    place = F.shiftrightunsigned(h, 6).bitwiseAND(F.lit(size - 1)).cast("int")
    return place, F.call_function("shiftleft", F.lit(1).cast("bigint"), h.bitwiseAND(F.lit(63)).cast("int"))


def _blocks(lists: DataFrame, block: int) -> DataFrame:
    """(xs, ys) for long lines: blocks of a line meet as rows of their own, dealt out to all tasks; no ys: with itself."""
    n = F.size("hs")
    starts = F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0)), F.lit(block))
    blocks = F.transform(starts, lambda i: F.slice("hs", i + 1, F.lit(block)))
    split = lists.select(blocks.alias("_bs"))
    left = split.select("_bs", F.posexplode("_bs").alias("_b", "xs"))
    met = left.select("xs", F.posexplode(F.slice("_bs", F.col("_b") + 1, F.size("_bs"))).alias("_c", "ys"))
    return met.repartition("xs", "ys").select("xs", F.when(F.col("_c") > 0, F.col("ys")).alias("ys"))


def _dictionary(frequent: DataFrame, size: int):
    """The hashes of at most `size` of the words, ascending, the place of each by frequency, and if these are all.

    Hashes that could be taken for a place are always among them.
    """
    first = F.col("h").between(0, size - 1).desc()
    listed = frequent.orderBy(first, F.desc("df"), "h").select("h").limit(size + 1).toArrow()["h"].to_numpy()
    kept = listed[:size]
    order = np.argsort(kept)
    return kept[order], order.astype(np.int64), len(listed) <= size


def _numbered(dictionary):
    """For mapInArrow: the column `h`, hashes, as numbers: the place in the dictionary, or the hash without one.

    A function inside a function travels to the executors by value.
    """
    hashes, places, _ = dictionary

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h = batch["h"].to_numpy()
            if len(h) and len(hashes):
                i = np.minimum(np.searchsorted(hashes, h), len(hashes) - 1)
                h = np.where(hashes[i] == h, places[i], h)
            yield pa.RecordBatch.from_arrays([pa.array(h, pa.int64()) if n == "h" else batch[n] for n in batch.schema.names], batch.schema.names)

    return run


def _pair_lists():
    """Two functions: counted pairs, ordered by (x, y), as bytes, and back.

    Kept are the different x and how many y each has, the gaps between the y of
    an x and the counts; the bytes of equal weight lie together and are
    compressed, which leaves about one byte a pair.
    """
    def begins(x):
        return np.flatnonzero(np.concatenate([[True], x[1:] != x[:-1]]))

    def packed(x, y, n) -> bytes:
        begin = begins(x)
        # differences wrap around where numbers are hashes
        gaps = np.diff(y, prepend=y[:1])
        gaps[begin] = y[begin]
        columns = [np.diff(x[begin], prepend=0), np.diff(np.append(begin, len(x))), gaps, n]
        width = 4 if all(0 <= c.min() and c.max() < 1 << 31 for c in columns) else 8
        planes = [c.astype(f"<i{width}").view(np.uint8).reshape(-1, width).T.ravel() for c in columns]
        head = np.array([width, len(begin), len(x)], "<i8").tobytes()
        return head + pa.compress(np.concatenate(planes), "zstd", asbytes=True)

    def unpacked(data: bytes):
        width, k, m = np.frombuffer(data, "<i8", 3).tolist()
        raw = np.frombuffer(pa.decompress(data[24:], 2 * width * (k + m), "zstd", asbytes=True), np.uint8)
        columns, at = [], 0
        for size in (k, k, m, m):
            planes = raw[at : at + size * width].reshape(width, size)
            columns.append(np.ascontiguousarray(planes.T).view(f"<i{width}").ravel().astype(np.int64))
            at += size * width
        steps, sizes, gaps, n = columns
        sums = np.cumsum(gaps)
        begin = np.cumsum(sizes) - sizes
        y = sums - np.repeat(sums[begin] - gaps[begin], sizes)
        return np.repeat(np.cumsum(steps), sizes), y, n

    return packed, unpacked


def _counted_pairs(dictionary, chunk: int, groups: int, run_words: int = RUN_WORDS):
    """For mapInArrow: from (xs, ys) to (x, block, list, m): how often each pair x < y of a run of lines is met.

    A row has the pairs of a run whose x is in one of `groups` groups and whose
    y is in one of PARTNER_BLOCKS blocks, as bytes (`_pair_lists`), m in all.
    Only the partners of the most frequent x are spread over blocks. A run is as
    many lines as have `run_words` words. Its pairs are made from its words in
    the order of groups and x, about `chunk` at a time, so that each comes once,
    but for an x that is cut. Pairs of xs and ys, parts of long lines, are sorted
    and counted `chunk` at a time.
    """
    hashes, places, whole = dictionary
    hot, cell, blocks = HOT, CELL, PARTNER_BLOCKS
    packed_list, _ = _pair_lists()

    def numbers(column):
        """Numbers of all words of the rows, and how many each row has; unknown words are left out."""
        n = np.diff(column.offsets.to_numpy()) if len(column) else np.zeros(0, np.int64)
        row = np.repeat(np.arange(len(column)), n)
        h = column.flatten().to_numpy()
        if len(hashes):
            i = np.minimum(np.searchsorted(hashes, h), len(hashes) - 1)
            hit = hashes[i] == h
            h = np.where(hit, places[i], h)
        else:
            hit = np.zeros(len(h), bool)
        if whole:  # places are small
            h, row = h[hit].astype(np.int32), row[hit]
        return h, np.bincount(row, minlength=len(column))

    def mixed(number):
        return ((number.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)).astype(np.int64)

    def cells(packed, names):
        """Rows of lists of the pairs x << 32 | y; with `names`, x and y are places in it."""
        packed.sort()
        first = np.flatnonzero(np.concatenate([[True], packed[1:] != packed[:-1]]))
        counts = np.diff(np.append(first, len(packed)))
        packed = packed[first]
        x, y = packed >> 32, packed & 0xFFFFFFFF
        if names is not None:
            x, y = names[x], names[y]
        spread = np.where((x >= 0) & (x < hot), y // cell, x)
        group = mixed(x) % groups * blocks + mixed(spread) % blocks
        order = np.argsort(group, kind="stable")
        group, x, y, counts = group[order], x[order], y[order], counts[order]
        ends = np.append(np.flatnonzero(group[1:] != group[:-1]) + 1, len(group))
        begin = np.append(0, ends[:-1])
        columns = [
            pa.array(group[begin] // blocks, pa.int64()),
            pa.array(group[begin] % blocks, pa.int64()),
            pa.array([packed_list(x[a:b], y[a:b], counts[a:b]) for a, b in zip(begin, ends)], pa.binary()),
            pa.array(np.add.reduceat(counts, begin)),
        ]
        return pa.RecordBatch.from_arrays(columns, ["x", "block", "list", "m"])

    def within(lines):
        """Rows of lists of the pairs in each of the lines, (numbers, how many each line has)."""
        h, n = (np.concatenate(c) for c in zip(*lines))
        lines.clear()
        names = None
        if not whole:
            names, h = np.unique(h, return_inverse=True)
        key = np.repeat(np.arange(len(n)) << 32, n)
        key |= h
        key.sort()
        h = (key & 0xFFFFFFFF).astype(np.int32)
        del key
        # the partners of a word are those after it in its line
        after = np.repeat(np.cumsum(n).astype(np.int32), n) - np.arange(1, len(h) + 1, dtype=np.int32)
        order = np.argsort((mixed(h if names is None else names[h]) % groups << 32) | h).astype(np.int32)
        order = order[after[order] > 0]
        made = np.cumsum(after[order], dtype=np.int64)
        at = 0
        while at < len(order):
            before = made[at - 1] if at else 0
            end = max(at + 1, int(np.searchsorted(made, before + chunk, "right")))
            some, each = order[at:end], after[order[at:end]]
            begin = (made[at:end] - before - each).astype(np.int32)
            partner = np.repeat(some + 1 - begin, each)
            partner += np.arange(len(partner), dtype=np.int32)
            packed = np.repeat(h[some].astype(np.int64) << 32, each)
            packed |= h[partner]
            del partner
            yield cells(packed, names)
            at = end

    def across(pairs):
        """A row of lists of the pairs, arrays (x, y) of numbers."""
        x, y = (np.concatenate(c).astype(np.int64) for c in zip(*pairs))
        pairs.clear()
        names = None
        if not whole:
            names = np.unique(np.concatenate([np.unique(x), np.unique(y)]))
            x, y = np.searchsorted(names, x), np.searchsorted(names, y)
        return cells((x << 32) | y, names)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lines, words, pairs, n_pairs = [], 0, [], 0
        for batch in batches:
            inside = batch["ys"].is_null()
            h, n = numbers(batch["xs"].filter(inside))
            if words + len(h) > run_words and words:
                yield from within(lines)
                words = 0
            if len(h):
                lines.append((h, n))
                words += len(h)
            met = batch.filter(batch["ys"].is_valid())
            if not len(met):
                continue
            (h, n), (g, m) = numbers(met["xs"]), numbers(met["ys"])
            a, b = np.cumsum(n) - n, np.cumsum(m) - m
            for r in range(len(met)):
                if n_pairs + n[r] * m[r] > chunk and n_pairs:
                    yield across(pairs)
                    n_pairs = 0
                if n[r] * m[r]:
                    x, y = np.repeat(h[a[r] : a[r] + n[r]], m[r]), np.tile(g[b[r] : b[r] + m[r]], n[r])
                    pairs.append((np.minimum(x, y), np.maximum(x, y)))
                    n_pairs += n[r] * m[r]
        if words:
            yield from within(lines)
        if n_pairs:
            yield across(pairs)

    return run


def _summed_lists(min_count: int):
    """For mapInArrow: (x, y, n), n >= min_count, from (x, block, lists), lists being those of all runs."""
    _, unpacked_list = _pair_lists()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lists in batch["lists"]:
                x, y, n = (np.concatenate(c) for c in zip(*(unpacked_list(v.as_py()) for v in lists.values)))
                names = None
                if min(x.min(), y.min()) < 0 or max(x.max(), y.max()) >= 1 << 31:
                    names = np.unique(np.concatenate([x, y]))
                    x, y = np.searchsorted(names, x), np.searchsorted(names, y)
                pairs = (x << 32) | y
                del x, y
                order = np.argsort(pairs, kind="stable")
                pairs, n = pairs[order], n[order]
                first = np.flatnonzero(np.concatenate([[True], pairs[1:] != pairs[:-1]]))
                n = np.add.reduceat(n, first)
                found = n >= min_count
                pairs, n = pairs[first[found]], n[found]
                x, y = pairs >> 32, pairs & 0xFFFFFFFF
                if names is not None:
                    x, y = names[x], names[y]
                yield pa.RecordBatch.from_arrays([pa.array(x), pa.array(y), pa.array(n)], ["x", "y", "n"])

    return run


def _unordered_counts(
    words: Vocabulary,
    min_count: int,
    filter_size: int | None = None,
    long_line: int = LONG_LINE,
    dictionary_size: int = DICTIONARY,
    chunk: int = CHUNK,
) -> tuple[DataFrame, DataFrame]:
    """(x, y, n), each unordered pair of numbers once with n >= min_count, and the frequent words (word, h, df), h a number.

    A pair occurs in no more lines than either word, so words below `min_count`
    leave before pairing, which changes no result: the filter takes out nearly all
    in the row, the join by which pairs get their names the rest. The most frequent
    words are numbered by their place in a dictionary of bounded size, the others
    by their hash. The task that reads lines makes their pairs and counts them, a
    run of RUN_WORDS words at a time; what is shuffled are compressed lists of
    partners of a group of words in a block of numbers, about a byte a pair. The
    more lines a run has, the more often a pair is met again in it and the fewer
    bytes are shuffled, so lines are read in no more tasks than the runs and the
    cluster ask for. The groups grow in number with the pairs, so the lists that
    meet in a row are bounded.
    No occurrence of a word is ever shuffled.
    """
    frequent = cut(words.counted.filter(F.col("df") >= min_count), "frequent")
    bits, size = frequent_filter(frequent, filter_size)
    bits = cut(bits, "filter").scalar()
    dictionary = _dictionary(frequent, dictionary_size)

    def known(h: Column) -> Column:
        place, bit = _bit(h, size)
        return F.get("_bits", place).bitwiseAND(bit) != 0

    hashed = words.lines.select(F.transform("words", lambda w: _hash(w, words.salt)).alias("hs"), bits.alias("_bits"))
    # the optimizer makes one projection of the two: no row carries the filter
    lists = hashed.select(F.filter("hs", known).alias("hs"))
    short = lists.filter(F.size("hs").between(2, long_line)).select(
        F.col("hs").alias("xs"), F.lit(None).cast("array<bigint>").alias("ys")
    )
    at_once = words.lines.sparkSession.sparkContext.defaultParallelism
    short = short.coalesce(at_once * (-(-words.n_words // (RUN_WORDS * at_once)) or 1))
    long = _blocks(lists.filter(F.size("hs") > long_line), BLOCK)
    groups = -(-words.n_pairs // (MEETING * PARTNER_BLOCKS)) or 1
    schema = "x bigint, block bigint, list binary, m bigint"
    cells = short.union(long).mapInArrow(_counted_pairs(dictionary, chunk, groups), schema)
    cells = cells.groupBy("x", "block").agg(F.sum("m").alias("m"), F.collect_list("list").alias("lists"))
    cells = cells.filter(F.col("m") >= min_count).drop("m")
    counts = cells.mapInArrow(_summed_lists(min_count), "x bigint, y bigint, n bigint")
    return counts, frequent.mapInArrow(_numbered(dictionary), frequent.schema)


def _named(counts: DataFrame, frequent: DataFrame, *carry: str) -> DataFrame:
    """Pairs with the columns x, y, df_x, df_y and, for each of `carry`, _x and _y, of frequent words only."""
    columns = ("h", "word", "df", *carry)
    x, y = (frequent.select(*columns).toDF(side, *(f"{c}_{side}" for c in columns[1:])) for side in ("x", "y"))
    named = counts.join(x, "x").join(y, "y").drop("x", "y")
    return named.withColumnsRenamed({"word_x": "x", "word_y": "y"})


def _mirrored(pairs: DataFrame, *carry: str, sides: Sequence[str] = ()) -> DataFrame:
    """Both orders of each unordered pair as (w1, w2, ...), a projection after the shuffle.

    Of each column of `sides`, which there is of either word, the one of w2 comes with it.
    """
    both = F.array(
        *(
            F.struct(F.col(a).alias("w1"), F.col(b).alias("w2"), *(F.col(f"{c}_{b}").alias(c) for c in sides))
            for a, b in (("x", "y"), ("y", "x"))
        )
    )
    return pairs.select(F.explode(both).alias("p"), *carry).select("p.*", *carry)


def pair_counts(
    lines: DataFrame, min_count: int = 10, line: str = "line", keys: Sequence[str] = ("docno",)
) -> DataFrame:
    """(w1, w2, n) for ordered pairs of different words sharing at least min_count lines.

    Every row is a line, whatever its `keys`; all words of a line are paired.
    """
    return _mirrored(_named(*_unordered_counts(vocabulary(lines, line), min_count)), "n")


def _scored(words: Vocabulary, named: DataFrame) -> DataFrame:
    """Pairs with pmi = log10(p(x,y) / (p(x) * p(y))) over the number of lines."""
    total = F.lit(float(words.n_lines))
    pmi = F.log10((F.col("n") / total) / ((F.col("df_x") / total) * (F.col("df_y") / total)))
    return named.withColumn("pmi", pmi)


def pmi_pairs(
    lines: DataFrame, min_count: int = 10, line: str = "line", keys: Sequence[str] = ("docno",)
) -> DataFrame:
    """(w1, w2, pmi), pmi = log10(p(x,y) / (p(x) * p(y))) over the number of lines."""
    words = vocabulary(lines, line)
    return _mirrored(_scored(words, _named(*_unordered_counts(words, min_count))), "pmi")


def stripes(pairs: DataFrame, value: str, parts: int = STRIPE_PARTS) -> DataFrame:
    """(w1, part, stripe) where stripe maps w2 to the value, in order of w2.

    The partners of every word are spread over `parts` rows by a hash of w2, so
    the layout is the same whatever the size, and no map and no task holds all
    partners of a very frequent word.
    """
    entries = F.sort_array(F.collect_list(F.struct("w2", value)))
    if "part" not in pairs.columns:
        pairs = pairs.withColumn("part", stripe_part("w2", parts))
    return pairs.groupBy("w1", "part").agg(F.map_from_entries(entries).alias("stripe"))


def stripe_part(word: Column | str, parts: int = STRIPE_PARTS) -> Column:
    """The row of a stripe that a partner is in: the first 7 hex digits of its MD5, modulo the parts."""
    return (F.conv(F.substring(F.md5(word), 1, 7), 16, 10).cast("bigint") % parts).cast("int")


def pmi_stripes(
    lines: DataFrame,
    min_count: int = 10,
    line: str = "line",
    keys: Sequence[str] = ("docno",),
    parts: int = STRIPE_PARTS,
) -> DataFrame:
    """PMI as maps of partners per word, see `stripes`. The row of a partner is worked out once per word."""
    words = vocabulary(lines, line)
    counts, frequent = _unordered_counts(words, min_count)
    placed = cut(frequent.withColumn("part", stripe_part("word", parts)), "placed")
    scored = _scored(words, _named(counts, placed, "part"))
    return stripes(_mirrored(scored, "pmi", sides=["part"]), "pmi", parts)


def stripe_rows(striped: DataFrame, value: str) -> DataFrame:
    """Back from stripes to (w1, w2, value) rows."""
    return striped.select("w1", F.explode("stripe").alias("w2", value))


def pair_totals(pairs: DataFrame) -> DataFrame:
    """One row: n_ordered pairs (w1, w2) and n_unordered, half of them."""
    return pairs.agg(
        F.count(F.lit(1)).alias("n_ordered"),
        F.count(F.when(F.col("w1") < F.col("w2"), 1)).alias("n_unordered"),
    )


def top_pmi(pmi: DataFrame, n: int) -> DataFrame:
    """The n ordered pairs with the highest PMI, ties by w1, w2."""
    return pmi.orderBy(F.desc("pmi"), "w1", "w2").limit(n)


def top_partners(pmi: DataFrame, words: list[str], n: int) -> DataFrame:
    """(w1, w2, pmi, rank): the n best partners of each given word, ties by w2.

    Spark keeps only n rows per word in each task before the shuffle.
    """
    best_first = Window.partitionBy("w1").orderBy(F.desc("pmi"), "w2")
    return (
        pmi.filter(F.col("w1").isin(list(words)))
        .withColumn("rank", F.row_number().over(best_first))
        .filter(F.col("rank") <= n)
    )
