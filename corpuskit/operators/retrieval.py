"""Boolean retrieval over postings with queries in postfix form, e.g. ``a b AND c OR``."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import snippet
from ..sources.state import cut
from .index import KEYS
from .skew import PIECE

# The operators, upper case only.
AND = "AND"
OR = "OR"

# Postings of a seed in one piece.
SEED_BLOCK = 1 << 16


def term_docs(postings: DataFrame, term: str, keys: Sequence[str] = KEYS) -> DataFrame:
    """Documents with exactly this term, ascending. The term is not normalised."""
    return postings.filter(F.col("term") == term).select(*keys).orderBy(*keys)


def docs_and(left: DataFrame, right: DataFrame) -> DataFrame:
    """Documents that both sides have; the columns are the documents' keys."""
    return left.intersect(right.select(*left.columns))


def docs_or(left: DataFrame, right: DataFrame) -> DataFrame:
    """Documents that either side has."""
    return left.union(right.select(*left.columns)).distinct()


def _needed(rpn: str):
    """The query as nested (operator, left, right) tuples, from the top of the stack."""
    stack: list = []
    for token in re.split(r"\s+", rpn.strip(), flags=re.ASCII):
        if token in (AND, OR):
            if len(stack) < 2:
                raise ValueError(f"{token} needs two operands: {rpn!r}")
            right, left = stack.pop(), stack.pop()
            stack.append((token, left, right))
        elif token:
            stack.append(token)
    if not stack:
        raise ValueError("empty query")
    return stack[-1]


def _terms(tree) -> list[str]:
    if isinstance(tree, str):
        return [tree]
    return sorted({t for side in tree[1:] for t in _terms(side)})


def _condition(tree, flags: dict[str, str]) -> Column:
    if isinstance(tree, str):
        return F.col(flags[tree])
    left, right = (_condition(side, flags) for side in tree[1:])
    return left & right if tree[0] == AND else left | right


def needed_terms(rpn: str):
    """The query as nested (operator, left, right) tuples and the terms in it; ValueError without enough operands."""
    tree = _needed(rpn)
    return tree, _terms(tree)


def query_condition(tree, flags: dict[str, str]) -> Column:
    """Whether a query holds where each term is there if its column of `flags` says so."""
    return _condition(tree, flags)


def boolean_query(postings: DataFrame, rpn: str, keys: Sequence[str] = KEYS) -> DataFrame:
    """Documents (keys) matching one postfix query.

    One filter on the terms, which reaches a term-sorted index file, and one
    aggregation by document, however many operators the query has. Operands left
    under the top of the stack do not matter; too few raise ValueError. Without
    negation a match holds at least one term, so no other document is needed.
    """
    tree = _needed(rpn)
    terms = _terms(tree)
    flags = {t: f"_has{i}" for i, t in enumerate(terms)}
    seen = [F.max(F.col("term") == t).alias(flag) for t, flag in flags.items()]
    return (
        postings.filter(F.col("term").isin(terms))
        .groupBy(*keys)
        .agg(*seen)
        .filter(_condition(tree, flags))
        .select(*keys)
    )


_AND_CODE, _OR_CODE = -1, -2


def _coded(queries: DataFrame) -> DataFrame:
    """(query_id, rpn, terms, codes): codes are term positions, -1 for AND, -2 for OR."""
    tokens = F.filter(F.split("rpn", r"\s+"), lambda t: t != "")
    operators = F.array(F.lit(AND), F.lit(OR))

    def code(token: Column) -> Column:
        position = F.array_position("terms", token).cast("int") - 1
        return F.when(token == AND, _AND_CODE).when(token == OR, _OR_CODE).otherwise(position)

    return queries.select(
        "query_id", "rpn", tokens.alias("_tokens"), F.array_except(F.array_distinct(tokens), operators).alias("terms")
    ).select("query_id", "rpn", "terms", F.transform("_tokens", code).alias("codes"))


def malformed(queries: DataFrame) -> DataFrame:
    """(query_id, rpn) of the queries that are empty or lack operands."""
    state = F.aggregate(
        "codes",
        F.struct(F.lit(0).alias("n"), F.lit(False).alias("short")),
        lambda s, c: F.struct(
            F.when(c >= 0, s["n"] + 1).otherwise(s["n"] - 1).alias("n"),
            (s["short"] | ((c < 0) & (s["n"] < 2))).alias("short"),
        ),
    )
    checked = _coded(queries).withColumn("_s", state)
    return checked.filter(F.col("_s.short") | (F.col("_s.n") < 1)).select("query_id", "rpn")


def _top(codes: str, operand, combine, kind: str) -> Column:
    """The top of the stack after the codes, with `operand(c)` for a term and `combine(c, a, b)` for an operator."""

    def step(stack: Column, c: Column) -> Column:
        n = F.size(stack)
        joined = combine(c, F.get(stack, n - 2), F.get(stack, n - 1))
        applied = F.concat(F.slice(stack, F.lit(1), F.greatest(n - 2, F.lit(0))), F.array(joined))
        return F.when(c >= 0, F.concat(stack, F.array(operand(c)))).otherwise(applied)

    return F.aggregate(codes, F.array().cast(f"array<{kind}>"), step, lambda stack: F.get(stack, F.size(stack) - 1))


def boolean_query_batch(
    postings: DataFrame, queries: DataFrame, keys: Sequence[str] = KEYS, block: int = SEED_BLOCK
) -> DataFrame:
    """(query_id, keys) for a whole table of queries (query_id, rpn) at once.

    Every match of a query holds one of its seeds: of an AND the seeds of the
    side with fewer postings, of an OR those of both. Only documents with a seed
    are looked at, and they are asked for the query's other terms by (term,
    document), so a frequent term that only narrows a query down costs no more
    than its seeds. Seeds meet their postings in pieces of about `block`, as many
    as a term needs by its own count: one for most, more for a frequent one, which
    is spread over tasks. Queries that are malformed match nothing; `malformed`
    lists them.
    """
    keys = list(keys)
    kind = "struct<cost:bigint,seeds:array<int>>"
    coded = cut(_coded(queries).join(malformed(queries).select("query_id"), "query_id", "left_anti"), "queries")
    wanted = coded.select("query_id", F.posexplode("terms").alias("_i", "term"))
    found = cut(postings.join(wanted.select("term").distinct(), "term", "left_semi").select("term", *keys), "found")
    counts = cut(found.groupBy("term").agg(F.count(F.lit(1)).alias("_df")), "counts")
    hot = counts.filter(F.col("_df") > block).select("term", F.ceil(F.col("_df") / block).alias("_pieces"))
    sizes = wanted.join(counts, "term", "left")
    counted = sizes.groupBy("query_id").agg(
        F.map_from_entries(F.collect_list(F.struct("_i", F.coalesce("_df", F.lit(0))))).alias("_dfs")
    )

    def operand(c: Column) -> Column:
        return F.struct(F.col("_dfs")[c].alias("cost"), F.array(c).alias("seeds")).cast(kind)

    def combine(c: Column, a: Column, b: Column) -> Column:
        cheaper = F.when(a["cost"] <= b["cost"], a).otherwise(b)
        both = F.struct((a["cost"] + b["cost"]).alias("cost"), F.array_union(a["seeds"], b["seeds"]).alias("seeds"))
        return F.when(c == _AND_CODE, cheaper).otherwise(both.cast(kind))

    planned = coded.join(counted, "query_id").withColumn("_seeds", _top("codes", operand, combine, kind)["seeds"])
    seeds = planned.select("query_id", F.explode("_seeds").alias("_i"), "terms").select(
        "query_id", F.get("terms", F.col("_i")).alias("term")
    )
    pieces = F.coalesce("_pieces", F.lit(1).cast("bigint"))
    spread = seeds.join(hot, "term", "left").select(
        "query_id", "term", F.explode(F.sequence(F.lit(0).cast("bigint"), pieces - 1)).alias(PIECE)
    )
    placed = found.join(hot, "term", "left").withColumn(PIECE, F.pmod(F.xxhash64(*keys), pieces))
    candidates = (
        placed.join(spread, ["term", PIECE])
        .select("query_id", *keys)
        .distinct()
    )
    asked = candidates.join(wanted, "query_id").join(found, ["term", *keys])
    present = asked.groupBy("query_id", *keys).agg(F.collect_list("_i").alias("_present"))

    def holds(c: Column, a: Column, b: Column) -> Column:
        return F.when(c == _AND_CODE, a & b).otherwise(a | b)

    matched = _top("codes", lambda c: F.array_contains("_present", c), holds, "boolean")
    return present.join(coded, "query_id").filter(matched).select("query_id", *keys)


def fetch(
    hits: DataFrame, docs: DataFrame, width: int = 80, line: str = "line", keys: Sequence[str] = KEYS
) -> DataFrame:
    """(keys, snippet, line) of the hits, ascending by key; the snippet is for show, the line is whole."""
    return (
        hits.join(docs, list(keys))
        .select(*keys, snippet(line, width).alias("snippet"), F.col(line).alias("line"))
        .orderBy(*keys)
    )
