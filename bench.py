"""Times every registered query from the given tables to a discarded result.

Environment: BENCH_SF_DIR (tables), BENCH_CPUS (local cores), BENCH_QUERIES (comma-separated names).
Prints one JSON line.
"""

import json
import os
import re
import time

from doorstep.plans.registry import all_queries, fitted_forest
from doorstep.sources import landing, star
from doorstep.session import build_session

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")


def run(df) -> None:
    """Execute the whole plan without sending rows to the driver."""
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = build_session(
        "doorstep-bench",
        **{
            "spark.master": f"local[{CPUS}]",
            "spark.driver.memory": "8g",
            "spark.sql.shuffle.partitions": CPUS,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = all_queries()
    chosen = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or list(queries)

    # One untimed pass starts the JVM's compilers and reads the table footers.
    run(star.deliveries(spark, SF_DIR))
    seconds = {}

    def timed(name: str, action) -> None:
        start = time.perf_counter()
        action()
        seconds[name] = round(time.perf_counter() - start, 3)

    # The tables and the model that queries share are made on first use; time that on its own.
    timed("land_deliveries", lambda: landing.deliveries_path(spark, SF_DIR))
    timed("land_events", lambda: landing.event_log_path(spark, SF_DIR))
    if any(name.startswith(("rf_", "what_if", "model_")) for name in chosen):
        timed("train_forest", lambda: fitted_forest(spark, SF_DIR))
    for name in chosen:
        timed(name, lambda: run(queries[name](spark, SF_DIR)))
    spark.stop()

    scale = re.search(r"sf([0-9.]+)", SF_DIR)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale.group(1)) if scale else None,
            }
        )
    )


if __name__ == "__main__":
    main()
