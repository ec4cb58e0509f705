"""Times the headline queries; prints one JSON line.

BENCH_SF_DIR names the tables (default /root/testdata/sf0.1), BENCH_CPUS the cores.
Each time is the median of BENCH_RUNS (default 3) full runs of the query, all result rows
produced, in a session that has run one small job before. Reports of the stored index ask the
one that ``write_index`` times. ``*_small_broadcast`` runs with the broadcast limit at 1,000
rows: the plan of a vocabulary that is too large to broadcast.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from termloom.operators import best_terms as best  # noqa: E402
from termloom.plans.queries import QUERIES, TOP_OF_EACH, stored_index  # noqa: E402
from termloom.session import build_session, drop_tables  # noqa: E402

HEADLINE = (
    "corpus_scan",
    "tokenize",
    "term_vectors",
    "vocabulary",
    "doc_freq",
    "upsert_documents",
    "write_mode_append",
    "merge_partials",
    "field_stats_all",
    "best_terms_tfidf",
    "term_weights",
    "best_terms_all_docs",
    "char_cosine",
    "similar_terms",
    "similar_terms_batch",
    "term_doc_vectors_tfxidf",
)


def best_terms_small_broadcast(spark, sf_dir):
    index = stored_index(spark, sf_dir)
    weights = best.leading_weights(index.table, index.doc_freq(["contents"]), "tfxidf", TOP_OF_EACH, max_broadcast=1000)
    return best.best_terms_all(weights, "tfxidf", TOP_OF_EACH)


MORE = {"best_terms_all_docs_small_broadcast": best_terms_small_broadcast}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__driver__memory=os.environ.get("BENCH_MEMORY", "12g"),
        spark__sql__shuffle__partitions=int(cpus) * 3,
        spark__checkpoint__dir=os.environ.get("BENCH_SCRATCH") or tempfile.mkdtemp(prefix="bench-"),
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    # One small job, so that the first query is not charged for starting Spark.
    spark.read.parquet(f"{sf_dir}/documents.parquet").selectExpr("count(text)").collect()
    names = sys.argv[1:] or [*HEADLINE, *MORE]
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    start = time.perf_counter()
    stored_index(spark, sf_dir)
    times = {"write_index": round(time.perf_counter() - start, 3)}
    for name in names:
        each = []
        for _ in range(runs):
            start = time.perf_counter()
            (QUERIES | MORE)[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            each.append(time.perf_counter() - start)
        times[name] = round(statistics.median(each), 3)
    drop_tables(spark)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")),
            }
        )
    )


if __name__ == "__main__":
    main()
