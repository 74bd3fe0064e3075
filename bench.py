"""Headline reports at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; prints one JSON line.

Every report is written to Spark's ``noop`` sink, so all rows and columns are produced. One
untimed report warms the JVM up; each report is then timed once, building its plan included.
``$BENCH_RUNS`` > 1 reports the median of that many runs.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from shelfmark.plans.registry import queries
from shelfmark.session import local_session

HEADLINE = (
    "line_similarity_top5",
    "line_age_similarity_top5",
    "repurchase_gap_distribution",
    "member_line_count_distribution",
    "member_frequency_distribution",
    "member_sku_count_distribution",
    "portfolio_line_age",
    "portfolio_line_novelty",
    "portfolio_line_price",
    "store_by_age",
    "store_by_line",
    "store_by_line_age",
    "store_by_line_novelty",
    "store_by_line_price",
    "store_by_line_sku",
    "store_by_novelty",
    "store_by_segment",
    "store_by_price",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    spark = local_session(cpus, name="bench")
    registered = queries()

    def run(name: str) -> float:
        start = time.perf_counter()
        registered[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    run("store_by_price")
    seconds = {name: round(statistics.median(run(name) for _ in range(runs)), 3) for name in HEADLINE}
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total wall time of the 18 reports",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")),
                "cpus": cpus,
            }
        )
    )


if __name__ == "__main__":
    main()
