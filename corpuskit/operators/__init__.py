"""DataFrame operators."""

from .bigrams import bigram_counts, bigram_relfreq, bigram_stripes
from .classifier import batch_of, batch_step, classify, deal, ensemble, in_blocks, score, train_batches, train_gradient, union_sets, with_counts
from .cooccurrence import (
    Vocabulary,
    frequent_filter,
    pair_counts,
    pair_totals,
    pmi_pairs,
    pmi_stripes,
    stripe_part,
    stripe_rows,
    stripes,
    top_partners,
    top_pmi,
    vocabulary,
)
from .evaluation import mean_over_runs, one_minus_roca
from .graph import Graph, graph_stats, message_counts, missing_targets, prepare, repeated_nodes
from .index import decode_gaps, encode_gaps, inverted_index, postings, postings_table
from .pagerank import missing_mass, personalized_pagerank, ppr_init, ppr_step, top_k, unknown_sources
from .reports import (
    clerks,
    monthly_items,
    orders_per_nation,
    parts_suppliers,
    pricing_summary,
    ship_count,
    shipped_orders,
    unshipped_value,
)
from .retrieval import (
    boolean_query,
    boolean_query_batch,
    docs_and,
    docs_or,
    fetch,
    malformed,
    term_docs,
)
from .skipping import alive_segments, skipping_query
from .skew import with_key_totals
from .text_stats import line_df, line_total, prefix_count, top_prefixes, vocab_words, word_count, words

__all__ = [
    "Graph",
    "Vocabulary",
    "alive_segments",
    "batch_of",
    "batch_step",
    "bigram_counts",
    "bigram_relfreq",
    "bigram_stripes",
    "boolean_query",
    "boolean_query_batch",
    "classify",
    "clerks",
    "deal",
    "decode_gaps",
    "docs_and",
    "docs_or",
    "encode_gaps",
    "ensemble",
    "fetch",
    "frequent_filter",
    "graph_stats",
    "in_blocks",
    "inverted_index",
    "line_df",
    "line_total",
    "malformed",
    "mean_over_runs",
    "message_counts",
    "missing_mass",
    "missing_targets",
    "monthly_items",
    "one_minus_roca",
    "orders_per_nation",
    "pair_counts",
    "pair_totals",
    "parts_suppliers",
    "personalized_pagerank",
    "pmi_pairs",
    "pmi_stripes",
    "postings",
    "postings_table",
    "ppr_init",
    "ppr_step",
    "prefix_count",
    "prepare",
    "pricing_summary",
    "repeated_nodes",
    "score",
    "skipping_query",
    "ship_count",
    "shipped_orders",
    "stripe_part",
    "stripe_rows",
    "stripes",
    "term_docs",
    "top_k",
    "top_partners",
    "top_pmi",
    "top_prefixes",
    "train_batches",
    "train_gradient",
    "union_sets",
    "unknown_sources",
    "unshipped_value",
    "vocab_words",
    "vocabulary",
    "with_counts",
    "with_key_totals",
    "word_count",
    "words",
]
