"""Exact search and quotation links."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpuskit.llm import quote_links, top_k

VECTORS = "vec_id bigint, embedding array<float>, score string"


def brute(rows, k, every):
    own = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            q = [int(np.floor(256 * np.float64(np.float32(x)))) for x in v]
            own[i] = min(own[i], q) if i in own else q
    out = {}
    for i in own:
        if i % every == 0:
            scores = sorted((-sum(a * b for a, b in zip(own[i], own[j], strict=False)), j) for j in own if j != i)
            for rank, (s, j) in enumerate(scores[:k], 1):
                out[i, rank] = (j, -s)
    return out


def found(df, every, **options):
    rows = top_k.top_k(df, F.col("vec_id") % every == 0, **options).collect()
    return {(r.query_id, r.rank): (r.vec_id, r.score) for r in rows}


@pytest.mark.parametrize("sizes", [{}, {"shard": 40, "queries_at_once": 7}])
def test_best_of_all(spark, sizes):
    rnd = np.random.default_rng(1)
    rows = [(int(i), [float(x) for x in rnd.normal(0, 0.2, 8)]) for i in rnd.permutation(600)]
    rows += [(1000 + i, rows[i][1]) for i in range(30)]  # ties
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], VECTORS)
    assert found(df, 20, **sizes) == brute(rows, 5, 20)


def test_odd_vectors(spark):
    rows = [
        (None, [1.0, 1.0]),
        (0, [1.0, 0.5]),
        (1, None),
        (2, [1.0, None]),
        (3, [float("nan"), 1.0]),
        (4, [float("inf"), 1.0]),
        (5, [0.5]),
        (6, []),
        (10, [-1.0, 2.0]),
        (10, [-1.0, 2.0]),
    ]
    df = spark.createDataFrame([(i, v, None) for i, v in rows], VECTORS)
    assert found(df, 10) == brute(rows, 5, 10)
    assert found(df.limit(0), 10) == {}
    assert found(df.filter("vec_id = 0"), 10) == {}


def test_pruned_blocks_change_nothing():
    rnd = np.random.default_rng(2)
    vectors = rnd.integers(-90, 90, (900, 6))
    ids = rnd.permutation(900)
    for block in (1, 16, 900):
        got = top_k.best(ids[:20], vectors[:20], ids, vectors, 3, block)
        scores = vectors[:20] @ vectors.T
        for q in range(20):
            best = sorted((-int(s), int(i)) for i, s in zip(ids, scores[q], strict=True) if i != ids[q])[:3]
            assert [(i, -s) for s, i in best] == [(i, s) for own, i, s in got if own == ids[q]]


def test_scores_beyond_64_bits_are_bounded(spark):
    df = spark.createDataFrame([(0, [3e30], ""), (1, [3e30], ""), (2, [-3e30], "")], VECTORS)
    assert found(df, 2, k=1)[0, 1] == (1, 2**63 - 1)


CHATS = [
    (1, 0, "user", "Hello there my friend.\nHow do you do today?"),
    (1, 1, "assistant", "On Monday a person wrote:\n> How do you do\n> today?\nI am well, thank you very much."),
    (1, 2, "user", "> > How do you do today?\n> I am well, thank you very much.\nGood to hear it."),
    (2, 0, "user", "> I am well, THANK  you very much.\nA new conversation on that."),
    (2, 1, "assistant", "No quotes at all."),
    (3, 0, "user", "> words that nobody has written before"),
    (3, 1, "user", None),
    (3, 2, None, ""),
    (None, 5, "user", "> How do you do today?"),
    (4, None, "user", "I am well, thank you very much."),
]


def chats(spark, rows):
    return spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").withColumn("conv", F.lit("x"))


def test_replies_are_linked_to_what_they_quote(spark):
    rows = {(r.conv_id, r.turn): r for r in quote_links.link_quotes(chats(spark, CHATS)).collect()}
    link = lambda r: (r.parent_conv, r.parent_turn, r.thread, r.thread_turn, r.depth)
    assert link(rows[1, 0]) == (None, None, 1, 0, 0)
    assert link(rows[1, 1]) == (1, 0, 1, 0, 1)
    assert link(rows[1, 2]) == (1, 1, 1, 0, 2)
    assert link(rows[2, 0]) == (1, 1, 1, 0, 2)
    assert link(rows[2, 1]) == (None, None, 2, 1, 0)
    assert link(rows[3, 0]) == (None, None, 3, 0, 0)
    assert rows[1, 1].body == "I am well, thank you very much."
    assert rows[1, 2].body == "Good to hear it." and rows[1, 2].n_quotes == 2
    assert rows[3, 1].body == "" and rows[3, 2].body == "" and rows[3, 0].body == ""
    assert link(rows[None, 5]) == (None, None, None, 5, 0)
    assert len(rows) == len(CHATS)


def test_repeated_messages_and_no_messages(spark):
    twice = quote_links.link_quotes(chats(spark, CHATS + CHATS))
    assert twice.count() == 2 * len(CHATS)
    assert {(r.conv_id, r.turn): r.depth for r in twice.collect()}[1, 2] == 2
    assert quote_links.link_quotes(chats(spark, [])).count() == 0


def test_long_chains_and_hot_passages(spark):
    rows = [(1, 0, "user", "message number zero of the chain")]
    for i in range(1, 40):
        rows.append((1, i, "user", f"> message number {i - 1 or 'zero'} of the chain\nmessage number {i} of the chain"))
    rows += [(10 + i, 0, "user", "> message number zero of the chain\nyes") for i in range(200)]
    got = {(r.conv_id, r.turn): r for r in quote_links.link_quotes(chats(spark, rows)).collect()}
    assert [got[1, i].depth for i in range(40)] == list(range(40))
    assert all((got[10 + i, 0].parent_conv, got[10 + i, 0].parent_turn) == (1, 0) for i in range(200))


def brute_links(rows):
    """The same by loops over all pairs of messages."""
    parsed = {(c, t): quote_links.parse(x or "")[1] for c, t, _, x in rows}
    out = {}
    for key, passages in parsed.items():
        best = None
        for level, words, hash_ in passages:
            if not level:
                continue
            origins = [k for k, ps in parsed.items() if k < key and any(h == hash_ and not a for a, _, h in ps)]
            near = [k for k in origins if k[0] == key[0]]
            if near or origins:
                rank = (not near, level, -words, min(near or origins))
                best = min(best or rank, rank)
        if best:
            out[key] = best[3]
    return out


def test_links_are_those_of_all_pairs(spark):
    rnd = np.random.default_rng(4)
    lines = [f"line {i} with some words" for i in range(25)]
    rows = []
    for c in range(40):
        for t in range(5):
            own = [lines[rnd.integers(25)] for _ in range(rnd.integers(0, 3))]
            quotes = [("> " * int(rnd.integers(1, 3))) + lines[rnd.integers(25)] for _ in range(rnd.integers(0, 3))]
            rows.append((c, t, "user", "\n".join([*quotes, "", *own])))
    got = quote_links.link_quotes(chats(spark, rows)).filter("parent_conv IS NOT NULL").collect()
    # the far origin of a passage is the first one of all, so it may be the message's own or a later one
    first = {}
    for c, t, _, x in rows:
        for level, _, h in quote_links.parse(x)[1]:
            if not level:
                first[h] = min(first.get(h, (c, t)), (c, t))
    expected = brute_links(rows)
    assert {(r.conv_id, r.turn): (r.parent_conv, r.parent_turn) for r in got} == expected


def test_nested_levels():
    assert quote_links.levels("> > a\n>b\n c") == [(2, "a"), (1, "b"), (0, " c")]
    assert quote_links.parse("> a b\n> c d\n\nx")[1][0][:2] == (1, 4)


def test_short_passages_sentences_and_origins_of_larger_ids(spark):
    rows = [
        (1, 0, "user", "Yes please"),
        (1, 1, "user", "> Yes please\nDone."),
        (1, 2, "user", "> The second one is longer.\nI see."),
        (5, 0, "user", "A first sentence stands here. The second one is longer. And a third!"),
        (5, 1, "user", "> Yes please\nNot of this conversation."),
        (2, 0, "user", "> this is said by seven\nthis is said by two"),
        (7, 0, "user", "> this is said by nine\nthis is said by seven"),
        (9, 0, "user", "> this is said by two\nthis is said by nine"),
        (9, 1, "user", "> this is said by nine\nand so on"),
        (9, 2, "user", "> quoted before it is said\nwell"),
        (9, 3, "user", "quoted before it is said"),
    ]
    linked = quote_links.link_quotes(chats(spark, rows), anywhere=True).filter("parent_conv IS NOT NULL")
    assert {(r.conv_id, r.turn): (r.parent_conv, r.parent_turn) for r in linked.collect()}[5, 1] == (1, 0)
    got = {(r.conv_id, r.turn): r for r in quote_links.link_quotes(chats(spark, rows), min_words=3, anywhere=True).collect()}
    parent ={k: (r.parent_conv, r.parent_turn) for k, r in got.items() if r.parent_conv is not None}
    circle = {(7, 0): (9, 0), (9, 0): (2, 0)}  # opened at its first message
    assert parent == {(1, 1): (1, 0), (1, 2): (5, 0), (9, 1): (9, 0), **circle}
    assert got[5, 1].n_quotes == 1
    assert {k: (r.thread, r.depth) for k, r in got.items() if r.thread == 2} == {
        (2, 0): (2, 0), (9, 0): (2, 1), (7, 0): (2, 2), (9, 1): (2, 2)
    }


def plain_passages(text):
    """(level, words) of paragraphs, lines and sentences, by a reading of its own."""
    paragraphs, last = [], None
    for line in (text or "").split("\n"):
        level = 0
        while line.lstrip(" ").startswith(">"):
            line, level = line.lstrip(" ")[1:], level + 1
        words = tuple(line.lower().split())
        if not words:
            last = None
        elif last == level:
            paragraphs[-1][1].append(words)
        else:
            paragraphs.append((level, [words]))
            last = level
    out = set()
    for level, lines in paragraphs:
        whole = sum(lines, ())
        out |= {(level, whole), *((level, line) for line in lines)}
        ends = [0, *(i + 1 for i, w in enumerate(whole) if w[-1] in ".!?"), len(whole)]
        out |= {(level, whole[a:b]) for a, b in zip(ends, ends[1:], strict=False) if b > a}
    return out


def plain_conversations(rows):
    """Links, parents, threads and positions by loops over all messages."""
    parsed = {(c, t): plain_passages(x) for c, t, _, x in rows}
    links, parent = {}, {}
    for key, passages in parsed.items():
        ranks = []
        for level, words in passages:
            if level:
                having = sorted(k for k, ps in parsed.items() if (0, words) in ps)
                near = [k for k in having if k[0] == key[0] and k[1] < key[1]]
                origin = next(iter(near or [k for k in having if k[0] != key[0]]), None)
                links[key, level, words] = origin
                if origin:
                    ranks.append((len(words) < 3, not near, level, -len(words), origin))
        if ranks:
            parent[key] = min(ranks)[-1]
    opened = dict(parent)
    for key in parent:
        way = [key]
        while way[-1] in parent and parent[way[-1]] not in way:
            way.append(parent[way[-1]])
        if way[-1] in parent and parent[way[-1]] == key and min(way) == key:
            del opened[key]
    place = {}
    for key in parsed:
        root, depth = key, 0
        while root in opened:
            root, depth = opened[root], depth + 1
        place[key] = (*root, depth)
    position, seen = {}, {}
    for key in sorted(parsed, key=lambda k: (*place[k], *k)):
        thread = place[key][0]
        position[key] = seen.get(thread, 0)
        seen[thread] = position[key] + 1
    return links, opened, place, position


def quoting(seed, n_conversations, lines):
    rnd = np.random.default_rng(seed)
    pick = lambda: lines[min(rnd.integers(len(lines)), rnd.integers(len(lines)))]
    rows = []
    for c in range(n_conversations):
        for t in range(4):
            text = []
            for _ in range(rnd.integers(0, 3)):
                text += ["> " * int(rnd.integers(1, 3)) + pick() for _ in range(rnd.integers(1, 3))] + [""] * int(rnd.integers(0, 2))
            text += [pick() for _ in range(rnd.integers(0, 3))]
            rows.append((c, t, "user", "\n".join(text)))
    return rows


def test_conversations_are_those_of_all_pairs(spark):
    lines = ["Yes", "No, never.", *(f"Line {i} stands here. It has words{i}!" for i in range(40))]
    rows = quoting(5, 25, lines)
    df = chats(spark, rows)
    links, parent, place, position = plain_conversations(rows)
    got = {(r.conv_id, r.turn): r for r in quote_links.conversations(quote_links.link_quotes(df, anywhere=True)).collect()}
    assert {k: (r.parent_conv, r.parent_turn) for k, r in got.items() if r.parent_conv is not None} == parent
    assert {k: (r.thread, r.thread_turn, r.depth) for k, r in got.items()} == place
    assert {k: r.position for k, r in got.items()} == position
    table, having = quote_links.links(df, anywhere=True)
    wanted = {(*key, level, quote_links._hash(list(words)), origin) for (key, level, words), origin in links.items()}
    origin_of = lambda r: None if r.origin_conv is None else (r.origin_conv, r.origin_turn)
    found_links = [(r.conv_id, r.turn, r.level, bytes(r.passage), origin_of(r)) for r in table.collect()]
    assert len(found_links) == len(wanted) and set(found_links) == wanted
    quoted = {words for _, _, words in links}
    own = {(quote_links._hash(list(w)), c, t) for c, t, _, x in rows for level, w in plain_passages(x) if not level and w in quoted}
    assert {(bytes(r.passage), r.conv_id, r.turn) for r in having.collect()} == own


def test_conversations_of_odd_messages(spark):
    df = chats(spark, [*CHATS, *CHATS, (6, 0, "user", "> yes " * 20_000 + "\n" + "no " * 20_000)])
    rows = quote_links.conversations(quote_links.link_quotes(df, anywhere=True)).collect()
    assert len(rows) == 2 * len(CHATS) + 1
    assert {r.position for r in rows if r.conv_id is None or r.turn is None} == {None}
    assert len({(r.thread, r.position) for r in rows if r.position is not None}) == len(CHATS) - 2 + 1
    table, having = quote_links.links(df, anywhere=True)
    assert table.filter("conv_id IS NULL AND origin_conv IS NOT NULL").count() == 0
    empty = chats(spark, [])
    assert quote_links.conversations(quote_links.link_quotes(empty)).count() == 0
    assert [t.count() for t in quote_links.links(empty)] == [0, 0]
