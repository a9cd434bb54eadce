"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the table folder, BENCH_CPUS the number of local cores.
"""

from __future__ import annotations

import json
import os
import pathlib
import sys
import time

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parent))

from adfacts.session import build_session  # noqa: E402
from workloads import facts  # noqa: E402
from workloads.registry import QUERIES  # noqa: E402

HEADLINE = [
    "ingest_unified",
    "ingest_summary",
    "quality_audit",
    "validate_canonical",
    "lag_features",
    "rolling_features",
    "feature_table",
    "feature_table_default",
    "feature_table_skewed",
    "feature_table_one_campaign",
    "model_matrix",
    "regression_metrics",
    "prediction_stats",
    "platform_summary",
    "top_campaigns",
    "insights_report",
]


def scale_factor(sf_dir: str) -> float | str:
    name = pathlib.Path(sf_dir).name
    try:
        return float(name.removeprefix("sf"))
    except ValueError:
        return name


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    spark = build_session(
        "adfacts-bench",
        **{
            "spark.master": f"local[{cpus}]",
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    facts.export_paths(spark, sf_dir)  # the exports are input, so writing them is not timed
    # a first short query loads classes and starts the executor threads
    QUERIES["date_range"](spark, sf_dir).collect()

    seconds = {}
    for name in HEADLINE:
        started = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline queries, total wall clock",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": scale_factor(sf_dir),
            }
        )
    )


if __name__ == "__main__":
    main()
