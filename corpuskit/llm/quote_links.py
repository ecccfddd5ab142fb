"""Chat formatting by quotation linking: replies are joined to the messages that they quote."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.skew import default_pieces
from ..plans.tables import load
from ..sources.state import cut
from . import bloom
from .pretokens import chunks
from .workers import map_arrow

# Passages with fewer words tell less of what is quoted: they come last where a message's parent is chosen.
FEW = 3

_MARKS = re.compile(r"(?:[ \t]{0,3}>)+[ \t]?")
_END = re.compile(r"""[.!?…。！？]["')\]”’»]*$""")
_INNER_END = re.compile(r"(?<=[。！？])(?=\w)")
_ATTRIBUTION = re.compile(r"\s*On\b.*\bwrote:\s*$")


def levels(text: str) -> list[tuple[int, str]]:
    """Each line's number of quotation marks, and the line without them."""
    out = []
    for line in text.split("\n"):
        marks = _MARKS.match(line)
        out.append((marks[0].count(">"), line[marks.end() :]) if marks else (0, line))
    return out


def _hash(words: list[str]) -> bytes:
    return hashlib.blake2b(" ".join(words).encode("utf-8", "surrogatepass"), digest_size=16).digest()


def sentences(words: list[str]) -> list[list[str]]:
    """Words up to those that end a sentence."""
    out: list[list[str]] = [[]]
    for word in (part for w in words for part in _INNER_END.split(w)):
        out[-1].append(word)
        if _END.search(word):
            out.append([])
    return [s for s in out if s]


def parse(text: str, min_words: int = 1) -> tuple[str, list[tuple[int, int, bytes]]]:
    """A message without its quotes, and its passages as (level, words, hash).

    Passages are paragraphs of one quotation level, and their lines and sentences
    if there are several, in lower case with single blanks. Level 0 is the message's own text.
    A line "On .. wrote:" right before a quote belongs to it.
    """
    lines = levels(text)
    passages: dict[tuple[int, bytes], int] = {}
    paragraph: list[list[str]] = []

    def close(level: int) -> None:
        whole = [w for line in paragraph for w in line]
        for words in [whole, *(paragraph if len(paragraph) > 1 else []), *sentences(whole)]:
            if len(words) >= min_words:
                passages[level, _hash(words)] = len(words)
        paragraph.clear()

    own: list[str] = []
    before = 0
    for i, (level, line) in enumerate(lines):
        if level != before:
            close(before)
        before = level
        words = line.lower().split()
        if level == 0:
            if i + 1 < len(lines) and lines[i + 1][0] and _ATTRIBUTION.match(line):
                continue
            own.append(line.rstrip())
        if words:
            paragraph.append(words)
        else:
            close(level)
    close(before)
    body = re.sub(r"\n{3,}", "\n\n", "\n".join(own)).strip("\n")
    return body, [(level, n, h) for (level, h), n in passages.items()]


def _parsed(df: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """(conv, turn, role, body, passages) per message."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        passage = pa.struct([("level", pa.int32()), ("words", pa.int32()), ("hash", pa.binary())])
        for batch in batches:
            found = [parse(t) for _, _, texts in chunks(batch.column(3)) for t in texts]
            listed = [[{"level": a, "words": n, "hash": h} for a, n, h in ps] for _, ps in found]
            columns = [
                *(batch.column(i) for i in range(3)),
                pa.array([body for body, _ in found], pa.string()),
                pa.array(listed, pa.list_(passage)),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["conv", "turn", "role", "body", "passages"])

    passage = T.StructType().add("level", T.IntegerType()).add("words", T.IntegerType()).add("hash", T.BinaryType())
    schema = T.StructType()
    for name, column in (("conv", conv), ("turn", turn), ("role", role)):
        schema.add(name, df.schema[column].dataType)
    schema.add("body", T.StringType()).add("passages", T.ArrayType(passage))
    return map_arrow(df.select(conv, turn, role, text), run, schema)


def _origins(messages: DataFrame, min_words: int, anywhere: bool) -> DataFrame:
    """(conv, turn, level, words, hash, away, p_conv, p_turn): the origin of each quoted passage that has one.

    A passage's origin is the first message that has it as its own text: an
    earlier one of the same conversation, of any length, or else, from
    `min_words` words, the first of all by (conv, turn). That one comes before the
    message, or with `anywhere` it is the first of any other conversation.
    """
    each = messages.select("conv", "turn", F.explode("passages").alias("p")).select("conv", "turn", "p.*")
    quoted = cut(each.filter("level > 0"), "quoted")
    hashes = cut(quoted.select("hash").distinct(), "hashes")
    own = bloom.within(each.filter("level = 0").select("hash", "conv", "turn"), hashes, "hash")
    near = cut(own.groupBy("hash", "conv").agg(F.min("turn").alias("p_turn")), "near")
    known = near.filter("conv IS NOT NULL AND p_turn IS NOT NULL")
    far = cut(known.groupBy("hash").agg(F.min(F.struct("conv", "p_turn")).alias("o")), "far")
    here = quoted.join(near, ["hash", "conv"]).filter("p_turn < turn")
    here = here.select("hash", "conv", "turn", "level", "words", F.lit(0).alias("away"), F.col("conv").alias("p_conv"), "p_turn")
    enough = quoted.filter(F.col("words") >= min_words)
    if anywhere:
        other = known.join(far, "hash").filter("conv <> o.conv")
        other = cut(other.groupBy("hash").agg(F.min(F.struct("conv", "p_turn")).alias("o2")), "other")
        there = enough.join(far, "hash").join(other, "hash", "left").filter("conv IS NOT NULL AND turn IS NOT NULL")
        there = there.withColumn("o", F.when(F.col("o.conv") == F.col("conv"), F.col("o2")).otherwise(F.col("o")))
        there = there.filter("o IS NOT NULL")
    else:
        there = enough.join(far, "hash").filter("o.conv < conv OR (o.conv = conv AND o.p_turn < turn)")
    there = there.select(
        "hash", "conv", "turn", "level", "words", F.lit(1).alias("away"), F.col("o.conv").alias("p_conv"), F.col("o.p_turn").alias("p_turn")
    )
    one = F.min(F.struct("away", "p_conv", "p_turn")).alias("o")
    found = here.unionByName(there).groupBy("conv", "turn", "level", "words", "hash").agg(one)
    return found.select("conv", "turn", "level", "words", "hash", "o.*")


def _parents(origins: DataFrame) -> DataFrame:
    """(conv, turn, p_conv, p_turn): the message that each message replies to.

    It is the origin of its best passage: in the same conversation, of the lowest
    level, the longest. Short passages come last.
    """
    short = F.col("words") < FEW
    rank = F.struct(short.alias("few"), "away", "level", (-F.col("words")).alias("short"), "p_conv", "p_turn")
    best = origins.groupBy("conv", "turn").agg(F.min(rank).alias("b"))
    return best.select("conv", "turn", F.col("b.p_conv").alias("p_conv"), F.col("b.p_turn").alias("p_turn"))


def _without_circles(parents: DataFrame) -> DataFrame:
    """The stored parents without that of the first message, by (conv, turn), of each circle.

    Steps are doubled until no chain goes on, or until they are as many as there
    are links: the chains left then end in circles and have gone round them.
    """
    n, steps = parents.count(), 1
    least = F.struct("conv", "turn").alias("least")
    going = parents.select("conv", "turn", F.col("p_conv").alias("r_conv"), F.col("p_turn").alias("r_turn"), least)
    while True:
        onward = going.select(
            *(F.col(a).alias(b) for a, b in (("conv", "r_conv"), ("turn", "r_turn"), ("r_conv", "n_conv"), ("r_turn", "n_turn"))),
            F.col("least").alias("further"),
        )
        joined = going.join(onward, ["r_conv", "r_turn"])
        if steps >= n:
            break
        going = cut(
            joined.select(
                "conv", "turn", F.col("n_conv").alias("r_conv"), F.col("n_turn").alias("r_turn"), F.least("least", "further").alias("least")
            ),
            "going",
        )
        if going.limit(1).count() == 0:
            return parents
        steps *= 2
    firsts = joined.select("further.*").distinct()
    return cut(parents.join(firsts, ["conv", "turn"], "left_anti"), "parents")


def _roots(parents: DataFrame) -> DataFrame:
    """(conv, turn, r_conv, r_turn, depth): where each reply's chain of parents begins, by doubling steps."""
    reached = cut(parents.toDF("conv", "turn", "r_conv", "r_turn").withColumn("depth", F.lit(1)), "reached")
    while True:
        onward = reached.toDF("r_conv", "r_turn", "n_conv", "n_turn", "n_depth")
        further = reached.join(onward, ["r_conv", "r_turn"], "left")
        if further.filter("n_depth IS NOT NULL").limit(1).count() == 0:
            return reached
        reached = cut(
            further.select(
                "conv",
                "turn",
                F.coalesce("n_conv", "r_conv").alias("r_conv"),
                F.coalesce("n_turn", "r_turn").alias("r_turn"),
                (F.col("depth") + F.coalesce("n_depth", F.lit(0))).alias("depth"),
            ),
            "reached",
        )


def link_quotes(
    df: DataFrame,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    min_words: int = 1,
    anywhere: bool = False,
) -> DataFrame:
    """(conv, turn, role, body, n_quotes, parent_conv, parent_turn, thread, thread_turn, depth), one row per message.

    `body` is the text without quotes. A message that quotes another is its
    reply; `thread` and `thread_turn` are the message at which the chain of
    replies begins, and `depth` the number of replies from there. A message
    without a link begins a chain of its own at its place in its conversation, so
    rows ordered by (thread, thread_turn, depth, conv, turn) are conversations in
    reply order (see `conversations`). The parent is the origin of one passage;
    `links` has those of all. With `min_words`, passages of fewer words are linked
    within a conversation only. Another conversation's message is quoted if it comes before
    by (conv, turn), or with `anywhere` whatever its place; circles are then opened
    at their first message. Rows without conv or turn have no link, and rows that share both
    get the same one. Null and empty texts have an empty body; other columns play
    no part.
    """
    parsed = _parsed(df, conv, turn, role, text)
    messages = cut(parsed, "messages")
    parents = cut(_parents(_origins(messages, min_words, anywhere)), "parents")
    if anywhere:
        parents = _without_circles(parents)
    linked = cut(parents.join(_roots(parents), ["conv", "turn"]), "linked")
    joined = messages.join(linked, ["conv", "turn"], "left")
    n_quotes = F.size(F.filter("passages", lambda p: p["level"] > 0))
    return joined.select(
        F.col("conv").alias(conv),
        F.col("turn").alias(turn),
        F.col("role").alias(role),
        "body",
        n_quotes.alias("n_quotes"),
        F.col("p_conv").alias("parent_conv"),
        F.col("p_turn").alias("parent_turn"),
        F.when(F.col("depth").isNull(), F.col("conv")).otherwise(F.col("r_conv")).alias("thread"),
        F.when(F.col("depth").isNull(), F.col("turn")).otherwise(F.col("r_turn")).alias("thread_turn"),
        F.coalesce("depth", F.lit(0)).alias("depth"),
    )


def links(
    df: DataFrame,
    conv: str = "conv_id",
    turn: str = "turn",
    text: str = "text",
    min_words: int = 1,
    anywhere: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """All links between messages: (conv, turn, level, words, passage, origin_conv, origin_turn) and (passage, conv, turn).

    The first table has every quoted passage of every message with its origin,
    null if nobody has written it; a message that quotes several has a row for
    each. The second has all the messages whose own text has a quoted passage, of
    which the origin is one, so that links to copies of it need not be listed in
    pairs. Arguments, nulls and repeated rows are as for `link_quotes`.
    """
    messages = cut(_parsed(df.withColumn(text, F.col(text)), conv, turn, turn, text).drop("role", "body"), "messages")
    each = messages.select("conv", "turn", F.explode("passages").alias("p")).select("conv", "turn", "p.*")
    quoted = each.filter("level > 0").distinct()
    keys = ["conv", "turn", "level", "words", "hash"]
    known = _origins(messages, min_words, anywhere).select(*keys, "p_conv", "p_turn")
    linked = quoted.join(known, keys, "left").select(
        F.col("conv").alias(conv),
        F.col("turn").alias(turn),
        "level",
        "words",
        F.col("hash").alias("passage"),
        F.col("p_conv").alias("origin_conv"),
        F.col("p_turn").alias("origin_turn"),
    )
    hashes = cut(quoted.select("hash").distinct(), "hashes")
    own = bloom.within(each.filter("level = 0").select("hash", "conv", "turn"), hashes, "hash").distinct()
    return linked, own.select(F.col("hash").alias("passage"), F.col("conv").alias(conv), F.col("turn").alias(turn))


def conversations(linked: DataFrame, conv: str = "conv_id", turn: str = "turn") -> DataFrame:
    """`linked`, a result of `link_quotes`, with `position`: the message's number in its thread's conversation, from 0.

    The order is that by (thread, thread_turn, depth, conv, turn): a reply comes
    after what it answers. Keys of messages are stored in ranges of that order,
    each range is numbered by itself, and only the ranges' counts per thread
    meet, so a conversation may have any share of all messages. Rows that share
    conv and turn have one position, those without conv or turn have none.
    """
    order = ["thread", "thread_turn", "depth", conv, turn]
    each = linked.filter(F.col(conv).isNotNull() & F.col(turn).isNotNull()).select(*order).distinct()
    ranged = each.repartitionByRange(default_pieces(each), *order)
    stored = cut(ranged.withColumn("_range", F.spark_partition_id()), "ranges")
    in_range = Window.partitionBy("_range", "thread").orderBy(*order[1:])
    counts = stored.groupBy("_range", "thread").agg(F.count(F.lit(1)).alias("_n"))
    # at most one row per range and thread
    earlier = Window.partitionBy("thread").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    skips = counts.select("_range", "thread", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_skip"))
    numbered = stored.withColumn("_i", F.row_number().over(in_range)).join(skips, ["_range", "thread"])
    positions = numbered.select(conv, turn, (F.col("_skip") + F.col("_i") - 1).alias("position"))
    return linked.join(positions, [conv, turn], "left").select(*linked.columns, "position")


def op7_quote_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every message without quotes, with the message that it replies to and its place in the conversation of replies."""
    return conversations(link_quotes(load(spark, sf_dir, "conversations"), anywhere=True))


QUERIES = {"op7_quote_links": op7_quote_links}
ORACLES: dict[str, str] = {}
