"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line of median seconds.

Spark writes each result to the noop sink. Overlay tables and the JSON dump are written during the warm-up run.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from threadlens.session import build_session  # noqa: E402
from workload.queries import QUERIES  # noqa: E402

HEADLINE = [
    "normalize_posts", "normalize_comments", "update_load_comments", "ranked_comments", "tree_depth", "preorder",
    "thread_documents", "match_answers", "qa_pairs", "lexicon_sentiment_documents", "valence_sentiment", "entities",
    "top_keywords", "analyze", "enrich_comments", "export_comments", "column_widths", "match_answers_hot", "tree_depth_hot",
]


def seconds(fn) -> float:
    start = time.perf_counter()
    fn()
    return time.perf_counter() - start


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "12g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    runs_of = {"match_answers_hot": 1}  # half a minute each
    names = [a for a in sys.argv[1:] if not a.startswith("-")] or HEADLINE
    times = {}
    for name in names:
        def run() -> None:
            QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()

        run()  # warm-up: code generation and Python workers
        times[name] = round(statistics.median(seconds(run) for _ in range(runs_of.get(name, runs))), 3)
        print(name, times[name], file=sys.stderr, flush=True)
    result = {
        "metric": "total_seconds", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": os.path.basename(sf.rstrip("/")).removeprefix("sf"), "cpus": int(cpus),
    }
    print(json.dumps(result), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
