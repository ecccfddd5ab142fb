"""Word statistics, PMI and bigrams over the lines of all documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import operators as op
from ..functions import tokenize
from .tables import LINE, SQL_LINES, SQL_TOKENS, SQL_VOCAB, document_lines

# PMI is a logarithm: both sides are rounded to 9 places.
_PMI = f"""{SQL_VOCAB},
total AS (SELECT CAST(count(*) AS DOUBLE) AS t FROM lines),
freq AS (SELECT word, count(*) AS df FROM vocab GROUP BY word),
pairs AS (
  SELECT a.word AS w1, b.word AS w2, count(*) AS n
  FROM vocab a JOIN vocab b ON a.doc_id = b.doc_id AND a.line_no = b.line_no AND a.word <> b.word
  GROUP BY a.word, b.word HAVING count(*) >= 10),
pmi AS (
  SELECT w1, w2, round(log10((n / t) / ((x.df / t) * (y.df / t))), 9) AS pmi
  FROM pairs JOIN freq x ON x.word = w1 JOIN freq y ON y.word = w2 CROSS JOIN total)"""

_BIGRAMS = f"""{SQL_TOKENS},
bigrams AS (
  SELECT a.word AS w1, b.word AS w2, count(*) AS n
  FROM tokens a JOIN tokens b ON a.doc_id = b.doc_id AND a.line_no = b.line_no AND b.i = a.i + 1
  GROUP BY a.word, b.word),
freq AS (
  SELECT w1, w2, n / sum(n) OVER (PARTITION BY w1) AS value FROM bigrams)"""


def _pmi(spark, sf):
    return op.pmi_pairs(document_lines(spark, sf), keys=LINE).withColumn("pmi", F.round("pmi", 9))


def _pairs(spark, sf):
    return op.pair_counts(document_lines(spark, sf), keys=LINE)


def _token_rows(spark, sf):
    return document_lines(spark, sf).select(*LINE, F.posexplode(tokenize("line")).alias("pos", "word"))


def _entries(striped):
    """The maps of stripes as text, entries in order, values with nine places."""
    entry = lambda e: F.concat_ws("=", e["key"], F.round(e["value"], 9).cast("decimal(20,9)"))
    entries = F.transform(F.map_entries("stripe"), entry)
    return striped.select("w1", "part", F.array_join(entries, " ").alias("stripe"))


QUERIES = {
    "lines": document_lines,
    "tokenize": _token_rows,
    "line_vocab": lambda spark, sf: op.vocab_words(document_lines(spark, sf), keys=LINE),
    "word_count": lambda spark, sf: op.word_count(document_lines(spark, sf)),
    "prefix_count": lambda spark, sf: op.prefix_count(document_lines(spark, sf)),
    "top_prefixes": lambda spark, sf: op.top_prefixes(document_lines(spark, sf), 3),
    "one_prefix": lambda spark, sf: op.prefix_count(document_lines(spark, sf)).filter(
        F.col("prefix") == "li"
    ),
    "line_total": lambda spark, sf: op.line_total(document_lines(spark, sf)),
    "word_line_df": lambda spark, sf: op.line_df(document_lines(spark, sf)),
    "pair_counts": _pairs,
    "pair_totals": lambda spark, sf: op.pair_totals(_pairs(spark, sf)),
    "pmi_pairs": _pmi,
    "pmi_stripes": lambda spark, sf: _entries(op.pmi_stripes(document_lines(spark, sf), keys=LINE)),
    "top_pmi": lambda spark, sf: op.top_pmi(_pmi(spark, sf), 20),
    "top_pmi_partners": lambda spark, sf: op.top_partners(_pmi(spark, sf), ["the", "and"], 3),
    "bigram_counts": lambda spark, sf: op.bigram_counts(document_lines(spark, sf)),
    "bigram_relfreq": lambda spark, sf: op.bigram_relfreq(document_lines(spark, sf)),
    "bigram_stripes": lambda spark, sf: _entries(op.bigram_stripes(document_lines(spark, sf))),
}

_PREFIXES = f"""{SQL_TOKENS},
prefixes AS (
  SELECT substring(word, 1, 2) AS prefix, count(*) AS n
  FROM tokens WHERE length(word) >= 2 GROUP BY prefix)"""


def _stripes(rows: str, value: str) -> str:
    part = "CAST(CAST('0x' || substring(md5(w2), 1, 7) AS BIGINT) % 16 AS INTEGER)"
    entry = f"w2 || '=' || CAST(CAST(round({value}, 9) AS DECIMAL(20,9)) AS VARCHAR)"
    return f"""SELECT w1, {part} AS part, string_agg({entry}, ' ' ORDER BY w2) AS stripe
FROM {rows} GROUP BY w1, {part}"""


ORACLES = {
    "lines": f"WITH {SQL_LINES} SELECT doc_id, line_no, line FROM lines",
    "tokenize": f"WITH {SQL_TOKENS} SELECT doc_id, line_no, CAST(i - 1 AS INTEGER) AS pos, word FROM tokens",
    "line_vocab": f"WITH {SQL_VOCAB} SELECT doc_id, line_no, word FROM vocab",
    "word_count": f"WITH {SQL_TOKENS} SELECT word, count(*) AS n FROM tokens GROUP BY word",
    "prefix_count": f"WITH {_PREFIXES} SELECT prefix, n FROM prefixes",
    "top_prefixes": f"WITH {_PREFIXES} SELECT prefix, n FROM prefixes ORDER BY n DESC, prefix LIMIT 3",
    "one_prefix": f"WITH {_PREFIXES} SELECT prefix, n FROM prefixes WHERE prefix = 'li'",
    "line_total": f"WITH {SQL_LINES} SELECT count(*) AS n_lines FROM lines",
    "word_line_df": f"WITH {SQL_VOCAB} SELECT word, count(*) AS df FROM vocab GROUP BY word",
    "pair_counts": f"WITH {_PMI} SELECT w1, w2, n FROM pairs",
    "pair_totals": f"""WITH {_PMI}
SELECT count(*) AS n_ordered, count(*) // 2 AS n_unordered FROM pairs""",
    "pmi_pairs": f"WITH {_PMI} SELECT w1, w2, pmi FROM pmi",
    "pmi_stripes": f"WITH {_PMI} {_stripes('pmi', 'pmi')}",
    "top_pmi": f"WITH {_PMI} SELECT w1, w2, pmi FROM pmi ORDER BY pmi DESC, w1, w2 LIMIT 20",
    "top_pmi_partners": f"""WITH {_PMI},
ranked AS (
  SELECT w1, w2, pmi,
         CAST(row_number() OVER (PARTITION BY w1 ORDER BY pmi DESC, w2) AS INTEGER) AS rank
  FROM pmi WHERE w1 IN ('the', 'and'))
SELECT w1, w2, pmi, rank FROM ranked WHERE rank <= 3""",
    "bigram_counts": f"WITH {_BIGRAMS} SELECT w1, w2, n FROM bigrams",
    "bigram_relfreq": f"""WITH {_BIGRAMS}
SELECT w1, '*' AS w2, CAST(sum(n) AS DOUBLE) AS value FROM bigrams GROUP BY w1
UNION ALL SELECT w1, w2, value FROM freq""",
    "bigram_stripes": f"WITH {_BIGRAMS} {_stripes('freq', 'value')}",
}
