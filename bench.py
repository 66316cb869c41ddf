"""Times the headline queries and prints one JSON line.

Each query runs once untimed, so that JIT and code generation are not measured, and once timed; the result
goes to the no-op sink, so that every row is computed and none is collected.
"""

from __future__ import annotations

import json
import os
import time

from charloom.plans.table_queries import all_queries
from charloom.session import INPUT_PARTITIONS, build_session

HEADLINE = [
    "collapse_ws",
    "nfc",
    "is_english_ascii",
    "utf8_audit",
    "byte_tokens",
    "ngram_counts_3",
    "ngram_counts_5",
    "ngram_probs_interp",
    "marginalise_first_char",
    "detect_language",
    "flatten_conversation",
    "random_holdout",
    "trim_from_top",
    "job_web_corpus",
    "job_clean_corpus",
    "job_register_corpus",
    "job_train_eval",
    "job_predict_grade",
    "dense_success",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", cores)
    # The bench tables are files of one row group each; a large input has splits of its own.
    spark.conf.set(INPUT_PARTITIONS, cores)
    table = all_queries()
    times = {}
    for name in HEADLINE:
        for _ in range(2):
            start = time.perf_counter()
            table[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
