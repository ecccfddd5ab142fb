"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8) and
BENCH_QUERIES (comma-separated names, default all headline queries).
"""

from __future__ import annotations

import json
import os
import re
import time

from pyspark.sql import SparkSession

from corpuskit.plans import QUERIES

HEADLINE = [
    "pmi_pairs",
    "pmi_stripes",
    "word_count",
    "prefix_count",
    "bigram_relfreq",
    "bigram_stripes",
    "postings",
    "inverted_index",
    "posting_gaps",
    "bool_query",
    "bool_query_batch",
    "graph_stats",
    "ppr_3_iterations",
    "ppr_top_k",
    "q1_ship_count",
    "q2_clerks",
    "q3_parts",
    "q4_nation",
    "q5_monthly",
    "q6_pricing",
    "q7_unshipped",
    "train_gradient_2_rounds",
    "train_batches",
    "ensemble_vote",
    "one_minus_roca",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("corpuskit-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    # start the JVM's code paths and the Python side once, outside the timings
    QUERIES["word_count"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        begin = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - begin, 3)
    sf = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "total wall time of headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(sf.group(1)) if sf else None,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
