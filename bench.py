"""Times the headline queries and prints one JSON line.

Every query is run to its full result (a noop sink keeps all columns and rows).
``layers`` is raw tables -> staging -> marts from nothing; the queries after it
read those written layers, as a BI tool reads the marts, and do the rest of their
work each time. One warm-up on the same data, then the median of three runs.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from rentgrid.binding.listings import Listings  # noqa: E402
from rentgrid.binding.queries import REGISTRY  # noqa: E402

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))
HEADLINES = [
    "usable_listings_core", "category_population", "layer_reconcile", "source_profile",
    "numeric_describe", "tail_quantiles", "suspect_monthly", "top_ratio_listings",
    "price_by_month", "place_price_growth", "price_per_m2_by_month", "supply_by_month",
    "clp_vs_uf_index", "place_attractiveness", "owner_direct_concentration",
    "top_listings_to_contact", "source_comparison",
]


def complete(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def build(spark: SparkSession) -> Listings:
    layers = Listings(spark, FOLDER)
    layers.fact, layers.calendar
    return layers


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return time.perf_counter() - start


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("rentgrid-bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    layers = build(spark)
    times = {"layers": statistics.median(timed(lambda: build(spark)) for _ in range(RUNS))}
    for name in HEADLINES:
        query = REGISTRY.queries[name]
        complete(query(layers))
        times[name] = statistics.median(
            timed(lambda: complete(query(layers))) for _ in range(RUNS)
        )
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline queries, total of medians",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": {name: round(seconds, 3) for name, seconds in times.items()},
                "sf": os.path.basename(FOLDER.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
