"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the tables, BENCH_CPUS (default 8) the cores.
The first three entries are the pipeline's stages: deriving the raw quotes, cleaning them and
building the feature panel, each written as a table. The queries after them start from those
tables, as they do in a session. Every query computes and discards all rows. The JVM is warmed
up on the smallest tables beside the measured ones, if there are any; that time is reported
apart as warm_up_sec. The time of a fit is that of
its trees one after the other, so BENCH_TREES (default 20) are timed here and sec_per_tree tells
what one takes.
"""

from __future__ import annotations

import json
import os
import sys
import time

from quotewell.config import TreeParams
from quotewell.plans import catalogue
from quotewell.plans.catalogue import QUERIES, pipeline_for
from quotewell.session import local_session

HEADLINES = (
    "clean_pipeline", "iqr_outlier_profile", "canonicalise_labels", "label_cardinality",
    "describe_price", "coverage_verdict", "gap_monthly_rows", "gap_verdict",
    "feature_panel", "panel_integrity", "split_audit", "null_audit", "mean_shift",
    "naive_metrics", "three_way_comparison", "seasonal_delta", "price_trends", "io_roundtrip",
    "gbt_direct", "gbt_three_way",
)


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = sys.argv[1:] or HEADLINES
    trees = int(os.environ.get("BENCH_TREES", "20"))
    catalogue.TREES = TreeParams(n_trees=trees)
    started = time.perf_counter()
    spark = local_session("bench", cpus)
    smallest = os.path.join(os.path.dirname(folder.rstrip("/")), "sf0.001")
    if os.path.isdir(smallest) and os.path.realpath(smallest) != os.path.realpath(folder):
        small = pipeline_for(spark, smallest)
        for name in names:
            if not name.startswith("gbt"):
                run(QUERIES[name](small))
    warm_up = round(time.perf_counter() - started, 3)

    timings: dict[str, float] = {}

    def timed(name: str, work) -> object:
        start = time.perf_counter()
        result = work()
        timings[name] = round(time.perf_counter() - start, 3)
        return result

    pipeline = timed("stage_raw", lambda: pipeline_for(spark, folder))
    timed("stage_clean", lambda: pipeline.cleaned)
    timed("stage_features", lambda: pipeline.features)
    raw_rows = pipeline.raw.count()
    for name in names:
        timed(name, lambda: run(QUERIES[name](pipeline)))
    spark.stop()

    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "raw_rows": raw_rows,
                "clean_rows_per_sec": round(raw_rows / timings["stage_clean"]),
                "cpus": cpus,
                "trees": trees,
                "sec_per_tree": (
                    round(timings["gbt_direct"] / trees, 3) if "gbt_direct" in timings else None
                ),
                "warm_up_sec": warm_up,
            }
        )
    )


if __name__ == "__main__":
    main()
