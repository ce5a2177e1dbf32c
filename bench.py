"""Headline queries, timed; prints one JSON line.

Every query runs once on the smallest tables first, so that class loading and
code generation are not measured. ``raw_landing`` derives and stores the raw
records; model queries build from those. ``stored_tables`` builds the fact,
lots, dimension and mart that the reports read.
"""

from __future__ import annotations

import json
import os
import time

from lotlens.plans.catalog import REGISTRY, Tables
from lotlens.session import get_session

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
WARM_DIR = os.path.join(os.path.dirname(SF_DIR.rstrip("/")), "sf0.001")

MODELS = [
    "dedup_latest",
    "stg_complaints",
    "property_lots",
    "lot_dimension",
    "complaint_fact",
    "lot_season_mart",
]
REPORTS = [
    "season_region_rollup",
    "weekly_trend",
    "season_to_date",
    "rates_by_band",
    "peer_comparison",
    "hotspot_classes",
    "match_rates",
    "lots_export",
    "poisson_rate_model",
    "dq_summary",
]


def drain(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def stored_tables(spark, sf_dir):
    return Tables.of(spark, sf_dir).mart


def raw_landing(spark, sf_dir):
    return Tables.of(spark, sf_dir).landed["complaints"]


def timed(run, spark, sf_dir) -> float:
    start = time.perf_counter()
    drain(run(spark, sf_dir))
    return round(time.perf_counter() - start, 3)


def main() -> None:
    spark = get_session(
        "bench",
        f"local[{CPUS}]",
        **{
            "spark.driver.memory": "16g",
            "spark.sql.shuffle.partitions": CPUS,
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    runs = {"raw_landing": raw_landing}
    runs.update({name: REGISTRY[name] for name in MODELS})
    runs["stored_tables"] = stored_tables
    runs.update({name: REGISTRY[name] for name in REPORTS})
    if os.path.isdir(WARM_DIR) and os.path.realpath(WARM_DIR) != os.path.realpath(SF_DIR):
        for run in runs.values():
            drain(run(spark, WARM_DIR))
    seconds = {name: timed(run, spark, SF_DIR) for name, run in runs.items()}
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
