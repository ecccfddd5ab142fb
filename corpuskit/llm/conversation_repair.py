"""Repair of conversation structure by iterative-deepening A*.

The messages of a conversation are edited until their roles, by first letters,
are an optional system message and pairs of user and assistant. The cheapest
edits are wanted, and of those the first in ASCII order. A depth-first search
tries edits in that order under a bound on cost plus what the remaining messages
cost at least; if nothing is found, the bound rises to the least cost beyond it.
A table keeps what states that have failed cost at least, so they are searched
again only with that much to spare. The first path that is accepted is the answer.

Long conversations are searched in blocks of messages, for every state before
and after a block, and the blocks' answers are put together: as equally dear
edits of the same messages between the same states never continue one another,
the first in order of the whole is made of the firsts of its blocks.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans.tables import load
from ..sources.state import cut
from .workers import map_arrow

# States: nothing kept yet, after a system message, after a user's, after an assistant's.
START, SYSTEM, USER, ASSISTANT = range(4)
ACCEPTED = (START, ASSISTANT)

# What edits cost. A message that is cut off costs more unless it is deleted.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5

_KEPT = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
_MADE = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
_ROLES = {USER: "user", ASSISTANT: "assistant"}
_LEGAL = {"su", "ua", "au"}

# Messages in a block.
BLOCK = 64

_SPACES = " \t\n\x0b\f\r"


class Message(NamedTuple):
    """What the search needs to know: first letter of the role, and faults."""

    initial: str
    unwanted: bool  # blank or a duplicate, has to be deleted
    truncated: bool


def search(messages: Sequence[Message], entry: int = START, exits: Sequence[int] = ACCEPTED) -> tuple[int, str]:
    """The cost and the initials of the cheapest edits that lead from `entry` to one of `exits`, first in ASCII order.

    There has to be such a path.
    """
    n = len(messages)
    least = [0] * (n + 1)
    for i in range(n - 1, -1, -1):
        m = messages[i]
        own = DELETE if m.unwanted or m.truncated else REROLE if m.initial not in ("s", "u", "a") else 0
        least[i] = least[i + 1] + own
    path: list[str] = []
    failed: dict[tuple[int, int], int] = {}

    def fails(i: int, state: int, room: int) -> int:
        """0 if edits that cost at most `room` are found, else what edits cost at least."""
        needed = failed.get((i, state), least[i])
        if needed > room:
            return needed
        if i == n and state in exits:
            return 0
        m = messages[i] if i < n else None
        tries = [("D", DELETE, i + 1, state)] if m else []
        tries.append(("I", INSERT, i, _MADE[state]))
        if m and not m.unwanted:
            extra = TRUNCATED if m.truncated else 0
            if (kept := _KEPT.get((state, m.initial))) is not None:
                tries.append(("K", extra, i + 1, kept))
            tries.append(("R", REROLE + extra, i + 1, _MADE[state]))
        needed = None
        for letter, cost, at, after in tries:
            path.append(letter)
            if room < cost:
                own = cost + failed.get((at, after), least[at])
            elif rest := fails(at, after, room - cost):
                own = cost + rest
            else:
                return 0
            path.pop()
            needed = own if needed is None else min(needed, own)
        failed[i, state] = max(needed, failed.get((i, state), 0))
        return needed

    bound = least[0]
    while beyond := fails(0, entry, bound):
        bound = beyond
    return _cost(messages, path), "".join(path)


def _cost(messages: Sequence[Message], path: Iterable[str]) -> int:
    cost, i = 0, 0
    for letter in path:
        cost += {"D": DELETE, "I": INSERT, "K": 0, "R": REROLE}[letter]
        if letter != "I":
            cost += TRUNCATED if messages[i].truncated and letter != "D" else 0
            i += 1
    return cost


def _summary(messages: Sequence[Message], begun: bool, ended: bool) -> list[dict]:
    """The answers of a block between all states that it may begin and end with.

    `begun`: the block is its conversation's first; `ended`: it is the last.
    """
    system = any(m.initial == "s" and not m.unwanted for m in messages)
    out = []
    for entry in (START,) if begun else range(4):
        if ended:
            goals = [ACCEPTED if entry == START else (ASSISTANT,)]
        else:
            # what is kept can't be undone: only deletions lead from START or SYSTEM to itself
            goals = [(USER,), (ASSISTANT,)]
            goals += [(START,)] if entry == START else []
            goals += [(SYSTEM,)] if entry == SYSTEM or (entry == START and system) else []
        for exits in goals:
            cost, audit = search(messages, entry, exits)
            out.append({"entry": entry, "exit": _states(messages, entry, audit)[-1], "cost": cost, "audit": audit})
    return out


def _states(messages: Sequence[Message], entry: int, audit: str) -> list[int]:
    """The state before each edit and after the last."""
    states, i = [entry], 0
    for letter in audit:
        state = states[-1]
        if letter == "K":
            states.append(_KEPT[state, messages[i].initial])
        else:
            states.append(state if letter == "D" else _MADE[state])
        i += letter != "I"
    return states


class _Path(NamedTuple):
    """Edits of the blocks so far, as a list from the last to the first."""

    cost: int
    audit: str
    entry: int
    before: _Path | None


def _earlier(a: _Path, b: _Path) -> bool:
    """Whether a's edits come before b's in ASCII order; both are of equally many blocks."""
    left, right = [], []
    while a is not b:
        left.append(a.audit)
        right.append(b.audit)
        a, b = a.before, b.before
    return "".join(reversed(left)) < "".join(reversed(right))


def combine(blocks: Sequence[Sequence[dict]]) -> tuple[int, list[tuple[int, str]]]:
    """The least cost of a conversation and (entry, edits) of each of its blocks, from the blocks' answers in order."""
    root = _Path(0, "", START, None)
    best = {START: root}
    for answers in blocks:
        now: dict[int, _Path] = {}
        for x in answers:
            before = best.get(x["entry"])
            if before is None:
                continue
            path, other = _Path(before.cost + x["cost"], x["audit"], x["entry"], before), now.get(x["exit"])
            if other is None or path.cost < other.cost or (path.cost == other.cost and _earlier(path, other)):
                now[x["exit"]] = path
        best = now
    last = None
    for state in ACCEPTED:
        path = best.get(state)
        if path and (last is None or path.cost < last.cost or (path.cost == last.cost and _earlier(path, last))):
            last = path
    cost, pieces = last.cost, []
    while last is not root:
        pieces.append((last.entry, last.audit))
        last = last.before
    return cost, pieces[::-1]


def _string_field(name: str) -> T.StructField:
    return T.StructField(name, T.StringType())


_ANSWERS = T.ArrayType(T.StructType().add("entry", "integer").add("exit", "integer").add("cost", "long").add("audit", "string"))
_MESSAGES = T.ArrayType(T.StructType([_string_field("role"), _string_field("text"), T.StructField("unwanted", T.BooleanType())]))
_COUNTS = ("blank", "duplicate", "truncated", "illegal")


def _illegal(a: str | None, b: str) -> int:
    return int(a is not None and a + b not in _LEGAL)


def _blocks(rows: DataFrame, conv: T.DataType, size: int) -> DataFrame:
    """One row per block of at most `size` messages of one conversation, from sorted partitions."""
    schema = T.StructType([T.StructField("conv", conv)]).add("part", "integer").add("block", "long")
    for c in _COUNTS:
        schema.add(c, "long")
    schema.add("first", "string").add("last", "string").add("answers", _ANSWERS).add("messages", _MESSAGES)
    arrow = pa.schema(
        [
            ("part", pa.int32()),
            ("block", pa.int64()),
            *((c, pa.int64()) for c in _COUNTS),
            ("first", pa.string()),
            ("last", pa.string()),
            (
                "answers",
                pa.list_(
                    pa.struct([("entry", pa.int32()), ("exit", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())])
                ),
            ),
            ("messages", pa.list_(pa.struct([("role", pa.string()), ("text", pa.string()), ("unwanted", pa.bool_())]))),
        ]
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("part", "conv", "turn", "role", "text", "later", "blank", "truncated")
        open_rows: list[tuple] = []
        previous, n_blocks, begun = None, 0, False
        kind = None

        def block(ended: bool) -> tuple:
            """The answers for the rows collected so far."""
            nonlocal previous
            messages, kept, counts, last = [], [], dict.fromkeys(_COUNTS, 0), None
            for row in open_rows:
                _, _, turn, role, text, later, blank, truncated = row
                duplicate = not blank and (later or previous == (turn, role, text))
                previous = (turn, role, text)
                cut_off = truncated and not blank and not duplicate
                counts["blank"] += blank
                counts["duplicate"] += duplicate
                counts["truncated"] += cut_off
                counts["illegal"] += _illegal(last, role[:1])
                last = role[:1]
                messages.append(Message(role[:1], blank or duplicate, cut_off))
                kept.append({"role": role, "text": text, "unwanted": blank or duplicate})
            answers = _summary(messages, begun, ended)
            values = {"part": open_rows[0][0], "block": n_blocks, **counts, "answers": answers, "messages": kept}
            return open_rows[0][1], values | {"first": messages[0].initial, "last": last}

        def packed(made: list[tuple]) -> pa.RecordBatch:
            table = pa.RecordBatch.from_pylist([v for _, v in made], arrow)
            return pa.RecordBatch.from_arrays([pa.array([c for c, _ in made], kind), *table.columns], schema.names)

        known = False  # whether the open conversation began in this partition
        for batch in batches:
            kind = batch.schema.field("conv").type
            made = []
            for row in zip(*(batch.column(c).to_pylist() for c in names), strict=True):
                if open_rows and row[1] != open_rows[0][1]:
                    begun = known and n_blocks == 0
                    made.append(block(True))
                    open_rows, n_blocks, previous, known = [], 0, None, True
                elif len(open_rows) == size:
                    begun = known and n_blocks == 0
                    made.append(block(False))
                    open_rows, n_blocks = [], n_blocks + 1
                open_rows.append(row)
            if made:
                yield packed(made)
        if open_rows:
            begun = known and n_blocks == 0
            yield packed([block(False)])

    return map_arrow(rows, run, schema)


def _solved(collected: DataFrame, conv: T.DataType) -> DataFrame:
    """(conv, cost, audit, illegal, pieces) from the answers of all blocks of each conversation."""
    schema = T.StructType([T.StructField("conv", conv)]).add("cost", "long").add("audit", "string").add("illegal", "long")
    piece = T.StructType().add("part", "integer").add("block", "long").add("entry", "integer").add("edits", "string")
    schema.add("pieces", T.ArrayType(piece))
    kind = pa.list_(pa.struct([("part", pa.int32()), ("block", pa.int64()), ("entry", pa.int32()), ("edits", pa.string())]))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            costs, audits, illegal, pieces = [], [], [], []
            for blocks in batch.column("blocks").to_pylist():
                cost, chosen = combine([b["answers"] for b in blocks])
                costs.append(cost)
                audits.append("".join(edits for _, edits in chosen))
                illegal.append(sum(_illegal(a["last"], b["first"]) for a, b in zip(blocks, blocks[1:], strict=False)))
                pairs = zip(blocks, chosen, strict=True)
                pieces.append([{"part": b["part"], "block": b["block"], "entry": e, "edits": x} for b, (e, x) in pairs])
            made = [pa.array(costs, pa.int64()), pa.array(audits, pa.string()), pa.array(illegal, pa.int64())]
            yield pa.RecordBatch.from_arrays([batch.column("conv"), *made, pa.array(pieces, kind)], schema.names)

    return map_arrow(collected, run, schema)


def _applied(chosen: DataFrame, conv: T.DataType) -> DataFrame:
    """(conv, part, block, i, edit, role, text): what is left of each block, in order."""
    schema = T.StructType([T.StructField("conv", conv)]).add("part", "integer").add("block", "long").add("i", "integer")
    for c in ("edit", "role", "text"):
        schema.add(c, "string")
    plain = pa.schema(
        [("part", pa.int32()), ("block", pa.int64()), ("i", pa.int32())] + [(c, pa.string()) for c in ("edit", "role", "text")]
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(len(batch)):
                row = batch.slice(at, 1)
                values = {c: row.column(c)[0].as_py() for c in ("part", "block", "entry", "edits", "messages")}
                own = values["messages"]
                states = _states([Message(m["role"][:1], False, False) for m in own], values["entry"], values["edits"])
                i, out = 0, []
                for letter, after in zip(values["edits"], states[1:], strict=True):
                    old = own[i] if letter != "I" else None
                    i += letter != "I"
                    if letter != "D":
                        role = old["role"] if letter == "K" else _ROLES[after]
                        text = old["text"] if old else ""
                        out.append({"i": len(out), "edit": letter, "role": role, "text": text})
                if out:
                    shared = {"part": values["part"], "block": values["block"]}
                    table = pa.RecordBatch.from_pylist([shared | x for x in out], plain)
                    key = row.column("conv").take(pa.array([0] * len(out)))
                    yield pa.RecordBatch.from_arrays([key, *table.columns], schema.names)

    return map_arrow(chosen, run, schema)


class Repair(NamedTuple):
    """`report`: a row per conversation; `messages`: the repaired messages, by (part, block, i) within each."""

    report: DataFrame
    messages: DataFrame


def repair(
    df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", block: int = BLOCK
) -> Repair:
    """Find and mend faults in the structure of conversations.

    Messages are taken by turn, nulls first, those of one turn by role and text.
    A message's first fault counts: blank (white space only), duplicate (role and
    text seen earlier in the conversation), truncated (doesn't end with . ! ?).
    Edits are Delete (cost 2, required for blank and duplicate ones), Insert (an
    empty message of user or assistant, 5), Keep (0) and Rerole (to user or
    assistant, 1); truncated messages that are not deleted cost 5 more. The roles'
    first letters become s?(ua)+ or nothing.

    report: (conv, gaps, blank, duplicate, truncated, illegal, cost, audit): turn
    numbers left out, faults, neighbours whose roles can't follow each other, the
    cost and the edits' initials in order. messages: (conv, part, block, i, edit,
    role, text).

    Null roles and texts count as one blank; null conversations are one; without
    rows there is nothing in either table; other columns play no part. Messages
    are sorted over all tasks by conversation and turn, so a conversation of any
    length is searched by several, `block` messages at a time; only the answers of
    its blocks, 16 at most, and the edits come together.
    """
    kind = df.schema[conv].dataType
    read = df.select(
        F.struct(F.col(conv).alias("conv")).alias("key"),  # equal to itself where the conversation is null
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role).cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col(text), F.lit(" ")).alias("text"),
    )
    rows = read.withColumn("sha", F.sha2(F.col("text").cast("binary"), 256))
    again = rows.groupBy("key", "role", "sha").agg(F.count("*").alias("n"), F.min(F.struct("turn")).alias("earliest"))
    again = again.filter("n > 1").drop("n")
    end = F.rtrim("text", F.lit(_SPACES))
    faulty = rows.join(again, ["key", "role", "sha"], "left").select(
        "key",
        "turn",
        "role",
        "text",
        (F.col("earliest").isNotNull() & ~F.col("turn").eqNullSafe(F.col("earliest.turn"))).alias("later"),
        (end == "").alias("blank"),
        (~F.right(end, F.lit(1)).isin(".", "!", "?")).alias("truncated"),
    )
    order = ("key", "turn", "role", "text")
    in_order = faulty.repartitionByRange(*order).sortWithinPartitions(*order)
    flags = ("turn", "role", "text", "later", "blank", "truncated")
    by_conversation = in_order.select(F.spark_partition_id().alias("part"), F.col("key.conv").alias("conv"), *flags)
    blocks = cut(_blocks(by_conversation, kind, block), "blocks").withColumn("key", F.struct("conv"))

    facts = F.sort_array(F.collect_list(F.struct("part", "block", "first", "last", "answers"))).alias("blocks")
    sums = [F.sum(c).alias(c) for c in _COUNTS]
    collected = blocks.groupBy("key").agg(facts)
    solved = cut(_solved(collected.select("key.conv", "blocks"), kind), "edits").withColumn("key", F.struct("conv"))
    counts = blocks.groupBy("key").agg(*sums)
    turns = read.select("key", "turn").distinct().groupBy("key")
    turns = turns.agg((F.max("turn") - F.min("turn") + 1 - F.count("turn")).alias("gaps"))
    across = solved.select("key", "cost", "audit", F.col("illegal").alias("across"))
    report = counts.join(across, "key").join(turns, "key").select(
        F.col("key.conv").alias(conv),
        F.coalesce(F.col("gaps"), F.lit(0)).cast("long").alias("gaps"),
        "blank",
        "duplicate",
        "truncated",
        (F.col("illegal") + F.col("across")).alias("illegal"),
        "cost",
        "audit",
    )
    pieces = solved.select("key", F.explode("pieces").alias("p")).select("key", "p.*")
    chosen = blocks.join(pieces, ["key", "part", "block"]).select("conv", "part", "block", "entry", "edits", "messages")
    return Repair(report, _applied(chosen, kind).withColumnRenamed("conv", conv))


def damaged(df: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) of `conversations`, with faults put in as the crc32 of conv_id and turn says."""
    named = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")))
    fate = F.crc32(named.cast("binary")) % 20
    blank = lambda c: F.coalesce(F.col(c), F.lit(" "))
    text = F.when(fate == 1, "").when(fate == 2, F.regexp_replace(blank("text"), "[.!?]", "")).otherwise(blank("text"))
    role = F.when(fate == 4, "user").otherwise(blank("role"))
    copies = F.when(fate == 0, 0).when(fate == 3, 2).otherwise(1)
    made = df.select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("copies"))
    one = F.explode(F.array_repeat(F.lit(1), F.col("copies")))
    return made.select("conv_id", "turn", "role", "text", one.alias("one")).drop("one")


def _sha(x: Column) -> Column:
    return F.sha2(F.coalesce(x, F.lit("")).cast("binary"), 256)


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults of every damaged conversation, the cheapest edits, and a digest of what they make of it."""
    table = load(spark, sf_dir, "conversations")
    report, messages = repair(damaged(table))
    line = F.struct("part", "block", "i", F.concat_ws(":", "role", "text").alias("line"))
    texts = messages.groupBy(F.struct("conv_id").alias("key")).agg(F.sort_array(F.collect_list(line)).alias("lines"))
    texts = texts.select("key", F.array_join("lines.line", "\n").alias("repaired"))
    every = table.select(F.struct("conv_id").alias("key")).distinct()
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return (
        every.join(report.withColumn("key", F.struct("conv_id")).drop("conv_id"), "key", "left")
        .join(texts, "key", "left")
        .select(
            F.col("key.conv_id").alias("conv_id"),
            *(F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in counts),
            F.coalesce(F.col("audit"), F.lit("")).alias("audit"),
            _sha(F.col("repaired")).alias("repaired_sha256"),
        )
    )


QUERIES = {"op12_conversation_repair": op12_conversation_repair}
ORACLES: dict[str, str] = {}
