"""Repair of conversations against a shortest-path search over whole edit strings."""

import hashlib
import heapq
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from corpuskit.llm import conversation_repair as cr

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
NEXT = {"": "su", "s": "u", "u": "a", "a": "u"}


def cheapest(messages):
    """(cost, edits) by uniform-cost search, ties by the edits themselves. A message is (initial, unwanted, truncated)."""
    heap, done = [(0, "", 0, "")], set()
    while heap:
        cost, edits, i, last = heapq.heappop(heap)
        if i == len(messages) and last in ("", "a"):
            return cost, edits
        if (i, last) in done:
            continue
        done.add((i, last))
        made = "a" if last == "u" else "u"
        heapq.heappush(heap, (cost + 5, edits + "I", i, made))
        if i < len(messages):
            initial, unwanted, truncated = messages[i]
            heapq.heappush(heap, (cost + 2, edits + "D", i + 1, last))
            if not unwanted:
                if initial and initial in NEXT[last]:
                    heapq.heappush(heap, (cost + 5 * truncated, edits + "K", i + 1, initial))
                heapq.heappush(heap, (cost + 1 + 5 * truncated, edits + "R", i + 1, made))


def some_messages(rnd, most=9):
    return [
        cr.Message(rnd.choice(["s", "u", "a", "u", "a", "t", ""]), rnd.random() < 0.15, rnd.random() < 0.2)
        for _ in range(rnd.randint(0, most))
    ]


def test_first_path_is_the_cheapest_and_first_in_order():
    rnd = random.Random(1)
    for _ in range(3000):
        messages = some_messages(rnd)
        assert cr.search(messages) == cheapest(messages)


def test_order_of_ties_by_trying_all_strings():
    rnd = random.Random(2)
    for _ in range(60):
        messages = some_messages(rnd, 4)
        cost, edits = cr.search(messages)
        for n in range(len(messages) + 3):
            for other in map("".join, itertools.product("DIKR", repeat=n)):
                if (c := walked(messages, other)) is not None:
                    assert (cost, edits) <= (c, other)


def walked(messages, edits):
    """The cost of these edits, None if they aren't allowed or leave something wrong."""
    if sum(x != "I" for x in edits) != len(messages):
        return None
    cost, i, roles = 0, 0, ""
    for x in edits:
        m = messages[i] if x != "I" else None
        i += x != "I"
        if m and m.unwanted and x != "D":
            return None
        made = "a" if roles.endswith("u") else "u"
        roles += {"D": "", "I": made, "K": m.initial or "?" if m else "", "R": made}[x]
        cost += {"D": 2, "I": 5, "K": 0, "R": 1}[x] + (5 if m and m.truncated and x != "D" else 0)
    return cost if re.fullmatch("(s?(ua)+)?", roles) else None


def test_blocks_of_any_size_give_the_same_answer():
    rnd = random.Random(3)
    for _ in range(400):
        messages = some_messages(rnd, 14)
        if not messages:
            continue
        size = rnd.randint(1, 5)
        parts = [messages[i : i + size] for i in range(0, len(messages), size)]
        answers = [cr._summary(p, i == 0, False) for i, p in enumerate(parts)]
        cost, pieces = cr.combine(answers)
        assert (cost, "".join(e for _, e in pieces)) == cheapest(messages)


def test_long_conversations_end():
    rnd = random.Random(4)
    messages = [cr.Message(rnd.choice("ua"), rnd.random() < 0.1, rnd.random() < 0.1) for _ in range(3000)]
    parts = [messages[i : i + 64] for i in range(0, 3000, 64)]
    cost, pieces = cr.combine([cr._summary(p, i == 0, i == len(parts) - 1) for i, p in enumerate(parts)])
    assert (cost, "".join(e for _, e in pieces)) == cheapest(messages)


def brute(rows):
    """op12's rows by the definition."""
    out = {}
    for conv in {r[0] for r in rows}:
        kept = []
        for _, turn, role, text in (r for r in rows if r[0] == conv):
            name = ":".join(" " if x is None else str(x) for x in (conv, turn))
            fate = zlib.crc32(name.encode()) % 20
            role, text = (" " if x is None else x for x in (role, text))
            if fate == 1:
                text = ""
            if fate == 2:
                text = re.sub("[.!?]", "", text)
            if fate == 4:
                role = "user"
            kept += [(turn, role, text)] * (0 if fate == 0 else 2 if fate == 3 else 1)
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, messages, counts = set(), [], dict.fromkeys(("blank", "duplicate", "truncated"), 0)
        for _, role, text in kept:
            end = text.rstrip(" \t\n\x0b\f\r")
            fault = None
            if not end:
                fault = "blank"
            elif (role, text) in seen:
                fault = "duplicate"
            elif end[-1] not in ".!?":
                fault = "truncated"
            seen.add((role, text))
            if fault:
                counts[fault] += 1
            messages.append((role[:1], fault in ("blank", "duplicate"), fault == "truncated"))
        initials = [m[0] for m in messages]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))
        turns = {t for t, _, _ in kept if t is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        cost, audit = cheapest(messages)
        repaired, i = [], 0
        for x in audit:
            made = "assistant" if repaired and repaired[-1][0][:1] == "u" else "user"
            if x == "K":
                repaired.append(kept[i][1:])
            elif x != "D":
                repaired.append((made, "" if x == "I" else kept[i][2]))
            i += x != "I"
        whole = "\n".join(f"{r}:{t}" for r, t in repaired)
        digest = hashlib.sha256(whole.encode()).hexdigest()
        out[conv] = (gaps, *counts.values(), illegal, cost, audit, digest)
    return out


def some_rows(rnd, conversations):
    texts = ["Yes.", "No!", "Why?", "", " \t", None, "cut off", "Yes. ", "é.", "a\nb.", "...\x0b"]
    roles = ["user", "assistant", "user", "assistant", "system", "tool", None, ""]
    rows = []
    for conv in [*range(conversations), None]:
        for turn in range(rnd.randint(1, 12)):
            real = None if rnd.random() < 0.05 else turn + (rnd.random() < 0.1)
            rows.append((conv, real, rnd.choice(roles), rnd.choice(texts)))
            if rnd.random() < 0.05:
                rows.append(rows[-1])
    rows += [(10_000, t, "ua"[t % 2], f"Message {rnd.randint(0, 150)}.") for t in range(400)]
    return rows


def test_registered_query_on_a_small_table(spark, tmp_path):
    rows = some_rows(random.Random(5), 150)
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{tmp_path}/conversations.parquet")
    got = {r.conv_id: tuple(r)[1:] for r in cr.op12_conversation_repair(spark, str(tmp_path)).collect()}
    assert got == brute(rows)


@pytest.mark.parametrize("size", [1, 3, 64])
def test_small_blocks_and_many_partitions(spark, size):
    rows = [(c, t, r, x) for c, t, r, x in some_rows(random.Random(6), 20)]
    df = spark.createDataFrame(rows, SCHEMA)
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # keeps the partitions apart
    try:
        report, messages = cr.repair(df, block=size)
        got = {(r.conv_id, r.cost, r.audit, r.illegal, r.duplicate, r.blank) for r in report.collect()}
        n = messages.groupBy("conv_id").count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    whole, _ = cr.repair(df.coalesce(1), block=10_000)
    assert got == {(r.conv_id, r.cost, r.audit, r.illegal, r.duplicate, r.blank) for r in whole.collect()}
    left = {c: len(a) - a.count("D") for c, _, a, *_ in got}
    assert {r.conv_id: r["count"] for r in n} == {c: x for c, x in left.items() if x}


def test_odd_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    report, messages = cr.repair(empty)
    assert report.count() == messages.count() == 0
    clashing = spark.createDataFrame([(1, 0, "user", "a" * 300_000 + ".")], SCHEMA).select(
        "*", *[F.lit("x").alias(c) for c in ("part", "block", "key", "sha", "later", "cost", "i", "edit", "conv", "answers")]
    )
    report, messages = cr.repair(clashing)
    assert report.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]
    assert [(r.cost, r.audit) for r in report.collect()] == [(2, "D")]
    assert messages.columns == ["conv_id", "part", "block", "i", "edit", "role", "text"]
