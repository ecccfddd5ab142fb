"""License scans: passages compared with templates by the Dice coefficient of their word bigrams."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans.tables import load

# Similarity from which a passage counts as a license.
THRESHOLD = 0.8

# Notices as their licenses word them.
TEMPLATES = {
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-header": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0
Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an
"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific
language governing permissions and limitations under the License.""",
    "cc-by-4.0": "Licensed under CC BY 4.0.",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "cc-by-sa-4.0": "Licensed under CC BY-SA 4.0.",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-3.0-header": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU
General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your
option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY;
without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public
License for more details.""",
    "isc": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
hereby granted, provided that the above copyright notice and this permission notice appear in all copies.""",
    "mit": "Released under the MIT License.",
    "mit-text": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
associated documentation files (the "Software"), to deal in the Software without restriction, including without
limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software,
and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above
copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.""",
}

_WORD = "[A-Za-z0-9]+"


def _bigrams(text: str) -> list[str]:
    words = [w.lower() for w in re.findall(_WORD, text)]
    return [f"{a} {b}" for a, b in zip(words, words[1:], strict=False)]


def sizes(n: int, threshold: float) -> range:
    """The numbers of bigrams for which a similarity of at least the threshold to n bigrams is possible."""
    # 2 * min(n, m) / (n + m) >= threshold; a bit wider, as exact similarities follow
    return range(math.floor(n * threshold / (2 - threshold)), math.ceil(n * (2 - threshold) / threshold) + 1)


def anchors(templates: Mapping[str, str], threshold: float) -> list[str]:
    """Words of which every passage that is similar enough to a template has at least one.

    A similarity of t needs n t / (2 - t) of the template's n bigrams in common.
    Words are taken until fewer bigrams than that are without any of them, those
    of the fewest templates first and of these the longest, as they are rarest
    elsewhere; one word that is enough by itself is preferred.
    """
    taken: set[str] = set()
    spread = Counter(w for text in templates.values() for w in {w for g in _bigrams(text) for w in g.split(" ")})
    for text in templates.values():
        pairs = [tuple(g.split(" ")) for g in _bigrams(text)]
        if not pairs:
            continue
        need = max(1, math.ceil(len(pairs) * threshold / (2 - threshold) - 1e-9))
        left = lambda words: sum(not words & set(p) for p in pairs)  # noqa: B023, E731
        words = sorted({w for p in pairs for w in p}, key=lambda w: (spread[w], -len(w), w))
        alone = [w for w in words if left({w}) < need]
        own = set(alone[:1])
        while left(own) >= need:
            own.add(words[len(own)])
        taken |= own
    return sorted(taken)


def _may_match(text: str, templates: Mapping[str, str], threshold: float) -> Column:
    """Whether a text has a word without which it can't have any of the licenses."""
    words = F.transform(F.regexp_extract_all(F.col(text), F.lit(_WORD), F.lit(0)), F.lower)
    return F.arrays_overlap(words, F.array(*map(F.lit, anchors(templates, threshold))))


def _by_size(spark: SparkSession, templates: Mapping[str, str], threshold: float) -> DataFrame:
    """(size, license, template): a template for every passage size that it can match; some 1.3 rows per bigram."""
    listed = [(name, _bigrams(text)) for name, text in templates.items()]
    rows = [(m, name, own) for name, own in listed for m in sizes(len(own), threshold) if m > 0]
    return spark.createDataFrame(rows, "size int, license string, template array<string>")


def passages(text: str) -> Column:
    """A text as a whole, its paragraphs between empty lines, and its lines: array of (part, position, passage)."""

    def each(part: str, pieces: Column) -> Column:
        return F.transform(pieces, lambda p, i: F.struct(F.lit(part).alias("part"), i.alias("position"), p.alias("passage")))

    whole = F.col(text)
    return F.concat(
        each("text", F.array(whole)), each("paragraph", F.split(whole, r"\n[ \t]*\n", -1)), each("line", F.split(whole, "\n", -1))
    )


def _dice(own: Column, template: Column) -> Column:
    """Twice the bigrams in common, each as often as in both lists, over the bigrams of both."""
    times = lambda items, g: F.size(F.filter(items, lambda x: x == g))
    common = F.aggregate(
        F.array_intersect(own, template), F.lit(0), lambda n, g: n + F.least(times(own, g), times(template, g))
    )
    return F.lit(2.0) * common / (F.size(own) + F.size(template))


def _windows(df: DataFrame, key: str, text: str, templates: Mapping[str, str], threshold: float) -> DataFrame:
    """(_key, license, size, position, dice): from each bigram that a template has, the most similar run of words.

    A run that begins or ends with a bigram that the template lacks is less
    similar than without it, so only runs from hit to hit are looked at, over the
    whole text and across its lines and paragraphs. Of n bigrams at least `least`
    have to be hit within `most` words, which few texts do by chance. A hit counts
    if fewer hits of the same bigram precede it in the run than the template has.
    """
    listed = [(name, _bigrams(text)) for name, text in templates.items()]
    listed = [(name, own, max(sizes(len(own), threshold)[0], 1), sizes(len(own), threshold)[-1]) for name, own in listed if own]
    if not listed:
        return df.sparkSession.createDataFrame([], "_key string, license string, size int, position int, dice double")
    known = F.array(
        *(
            F.struct(
                F.lit(name).alias("license"),
                F.lit(least).alias("least"),
                F.lit(most).alias("most"),
                F.array(*map(F.lit, own)).alias("template"),
            )
            for name, own, least, most in listed
        )
    )
    # explode(array(x)) computes x once, whatever reads it
    words = F.transform(F.regexp_extract_all(F.col(text), F.lit(_WORD), F.lit(0)), F.lower)
    pairs = F.zip_with(words, F.slice(words, F.lit(2), F.size(words)), lambda a, b: F.concat(a, F.lit(" "), b))
    numbered = F.transform(pairs, lambda g, i: F.struct(i.alias("at"), g.alias("g")))
    vocabulary = sorted({g for _, own, _, _ in listed for g in own})
    hits = F.filter(numbered, lambda h: h["g"].isin(vocabulary))
    rows = df.select(F.col(key).alias("_key"), F.explode(F.array(hits)).alias("hits"))
    rows = rows.filter(F.size("hits") >= min(least for _, _, least, _ in listed))
    rows = rows.select("_key", "hits", F.explode(known).alias("t")).select("_key", "hits", "t.*")
    own = F.filter("hits", lambda h: F.array_contains("template", h["g"]))
    rows = rows.select("_key", "license", "least", "most", "template", F.explode(F.array(own)).alias("hits"))
    rows = rows.filter(F.size("hits") >= F.col("least"))
    at = lambda i: F.get("hits", i)["at"]
    starts = F.filter(
        F.sequence(F.lit(0), F.size("hits") - F.col("least")),
        lambda i: at(i + F.col("least") - 1) - at(i) < F.col("most"),
    )
    rows = rows.withColumn("starts", F.explode(F.array(starts))).filter(F.size("starts") > 0)

    def earlier(h: Column, k: Column) -> Column:
        first = F.greatest(k - F.col("most"), F.lit(0))
        same = F.filter(F.slice("hits", first + 1, k - first), lambda x: x["g"] == h["g"])
        times = F.size(F.filter("template", lambda x: x == h["g"]))
        return F.struct(h["at"].alias("at"), F.coalesce(F.get(F.reverse(same), times - 1)["at"], F.lit(-1)).alias("earlier"))

    rows = rows.withColumn("hits", F.explode(F.array(F.transform("hits", earlier))))

    def longer(run: Column, h: Column, start: Column) -> Column:
        common = run["common"] + F.when(h["earlier"] < start, 1).otherwise(0)
        size = h["at"] - start + 1
        dice = F.lit(2.0) * common / (size + F.size("template"))
        better = dice > run["dice"]
        return F.struct(
            common.alias("common"),
            F.when(better, dice).otherwise(run["dice"]).alias("dice"),
            F.when(better, size).otherwise(run["size"]).alias("size"),
        )

    none = F.struct(F.lit(0).alias("common"), F.lit(0.0).alias("dice"), F.lit(0).alias("size"))
    best = F.transform(
        "starts",
        lambda i: F.struct(
            at(i).alias("position"),
            F.aggregate(F.slice("hits", i + 1, F.col("most")), none, lambda run, h: longer(run, h, at(i))).alias("run"),
        ),
    )
    rows = rows.select("_key", "license", F.explode(best).alias("b"))
    return rows.select("_key", "license", F.col("b.run.size").alias("size"), "b.position", F.col("b.run.dice").alias("dice"))


_FOUND = T.StructType().add("license", "string").add("dice", "double").add("part", "string")
_FOUND = _FOUND.add("position", "integer").add("n_bigrams", "integer")


def scan(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    templates: Mapping[str, str] = TEMPLATES,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """(key, license, dice, part, position, n_bigrams): the licenses of each text, each with its best passage.

    A text is compared as a whole, by paragraph and by line. Words are runs of
    ASCII letters and digits in lower case. Texts without any of the `anchors`
    can't have a license and are looked at no further. A passage meets only templates whose
    number of bigrams allows the threshold, by a broadcast of the templates under
    every such number; their total is fixed by `templates`. Of equally similar
    passages the first counts: the whole text, then paragraphs, then lines. Where
    none of them has a license, the most similar run of words of any extent
    counts, within a line or over several paragraphs; its part is 'window' and its
    position the number of words before it. Null
    and empty texts have no license; rows that share a key count as one; other
    columns play no part.
    """
    templates = {name: t for name, t in templates.items() if _bigrams(t)}
    if not templates:
        return df.sparkSession.createDataFrame([], T.StructType([T.StructField(key, df.schema[key].dataType), *_FOUND]))
    df = df.filter(_may_match(text, templates, threshold))
    candidates = _by_size(df.sparkSession, templates, threshold)
    words = F.regexp_count("passage", F.lit(_WORD))
    each = df.select(F.col(key).alias("_key"), F.explode(passages(text)).alias("p")).select("_key", "p.*")
    sized = each.withColumn("size", words - 1).filter("size > 0")
    met = sized.join(F.broadcast(candidates), "size")
    own = F.transform(F.regexp_extract_all("passage", F.lit(_WORD), F.lit(0)), F.lower)
    following = F.slice(own, F.lit(2), F.size(own))
    own = F.zip_with(F.slice(own, F.lit(1), F.size(own) - 1), following, lambda a, b: F.concat_ws(" ", a, b))
    scored = met.withColumn("own", own).withColumn("dice", _dice(F.col("own"), F.col("template")))
    order = F.when(F.col("part") == "text", 0).when(F.col("part") == "paragraph", 1).otherwise(2)
    scored = scored.select("_key", "license", "size", "position", "dice", "part", order.alias("o"))
    runs = _windows(df, key, text, templates, threshold).select("*", F.lit("window").alias("part"), F.lit(3).alias("o"))
    rank = F.struct((F.col("o") == 3).alias("w"), (-F.col("dice")).alias("d"), "o", "position", "part", "size")
    best = scored.unionByName(runs).filter(F.col("dice") >= threshold).groupBy("_key", "license").agg(F.min(rank).alias("b"))
    return best.select(
        F.col("_key").alias(key),
        "license",
        (-F.col("b.d")).alias("dice"),
        F.col("b.part").alias("part"),
        F.col("b.position").alias("position"),
        F.col("b.size").alias("n_bigrams"),
    )


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's licenses, each with its most similar passage."""
    return scan(load(spark, sf_dir, "documents"))


QUERIES = {"op6_license_scan": op6_license_scan}


def _sql() -> str:
    rows = ",\n  ".join(f"('{name}', {_bigrams(text)})" for name, text in TEMPLATES.items())
    return rf"""
WITH templates(license, template) AS (VALUES
  {rows}),
pieces AS (
  SELECT doc_id, 'text' AS part, 0 AS o, [text] AS ps FROM documents
  UNION ALL SELECT doc_id, 'paragraph', 1, string_split_regex(text, '\n[ \t]*\n') FROM documents
  UNION ALL SELECT doc_id, 'line', 2, string_split(text, chr(10)) FROM documents),
passages AS (SELECT doc_id, part, o, unnest(ps) AS p, generate_subscripts(ps, 1) - 1 AS position FROM pieces),
words AS (
  SELECT doc_id, part, o, position, regexp_extract_all(p, '{_WORD}') AS ws
  FROM passages),
own AS (
  SELECT doc_id, part, o, position,
         list_transform(range(1, len(ws)), lambda i: lower(ws[i]) || ' ' || lower(ws[i + 1])) AS bs
  FROM words WHERE len(ws) BETWEEN 2 AND 3 * (SELECT max(len(template)) FROM templates)),
counted AS (SELECT doc_id, part, o, position, g, count(*) AS n FROM (SELECT doc_id, part, o, position, unnest(bs) AS g FROM own) GROUP BY ALL),
of_templates AS (SELECT license, g, count(*) AS n FROM (SELECT license, unnest(template) AS g FROM templates) GROUP BY ALL),
common AS (
  SELECT doc_id, part, o, position, license, sum(least(c.n, t.n)) AS c
  FROM counted c JOIN of_templates t USING (g) GROUP BY ALL),
scored AS (
  SELECT doc_id, license, part, o, position, len(bs) AS n_bigrams, 2.0::DOUBLE * c / (len(bs) + len(template)) AS dice
  FROM common JOIN own USING (doc_id, part, o, position) JOIN templates USING (license))
SELECT doc_id, license, dice, part, CAST(position AS INTEGER) AS position, CAST(n_bigrams AS INTEGER) AS n_bigrams
FROM scored WHERE dice >= {THRESHOLD}
QUALIFY row_number() OVER (PARTITION BY doc_id, license ORDER BY dice DESC, o, position) = 1"""


ORACLES = {"op6_license_scan": _sql()}
