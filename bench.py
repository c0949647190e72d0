"""Time the reports at one scale and print a single JSON line.

`load_tables` cleans the inputs and writes the entity and graph tables once; the
reports then run on those tables, each from a cold plan.
"""

import json
import os
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from plaudit.plans.catalog import QUERIES  # noqa: E402
from plaudit.plans.workspace import open_workspace  # noqa: E402
from plaudit.session import tune  # noqa: E402

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
REPORTS = (
    "safest_cities safest_categories city_trends category_trends volume_vs_rating review_behavior "
    "tenure_behavior elite_vs_regular checkin_vs_rating checkin_gap_by_category cohort_analysis "
    "mom_consistency checkin_crosstab top_connected_users top3_by_state most_travelled_users "
    "category_fans safest_categories_graph pagerank_report community_geo market_saturation "
    "bridge_users usefulness_features usefulness_model link_prediction_metrics"
).split()


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    wanted = sys.argv[1:] or REPORTS
    times = {}

    def timed(name, action):
        start = time.perf_counter()
        action()
        times[name] = round(time.perf_counter() - start, 3)
        print(name, times[name], file=sys.stderr, flush=True)

    workspace = open_workspace(tune(spark), FOLDER)
    timed("load_tables", lambda: (workspace.businesses, workspace.users, workspace.graph))
    for name in wanted:
        timed(name, lambda: QUERIES[name](spark, FOLDER).write.format("noop").mode("overwrite").save())
    print(
        json.dumps(
            {
                "metric": "total_report_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(FOLDER.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
