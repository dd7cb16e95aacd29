"""Time the headline queries and print one JSON line.

``BENCH_COPIES=10`` times them over that many copies of the line items instead, a third of which go to
one supplier: about six million sales with a hot area at sf0.1.
"""

import json
import os
import time

from pyspark.sql import functions as F

from territory_analytics.plans.queries import QUERIES
from territory_analytics.plans.standin import TABLES
from territory_analytics.session import local_session
from territory_analytics.storage import scratch_path

HEADLINE = (
    "flagship_opportunities",
    "clean_certificates",
    "clean_sales",
    "keep_latest",
    "ref_price_band",
    "enriched_fact",
    "area_kpi",
    "area_profile",
    "area_type_profile",
    "price_quantiles",
    "quantiles_by_counting",
    "rank_by_counting",
    "quality_counts",
    "serve_opportunities",
    "label_distribution_topn",
    "headline_kpis",
    "exact_sample",
    "daily_run",
)


def run(spark, name: str, folder: str) -> float:
    """Seconds to build and fully execute a query, without sending its rows to the driver."""
    start = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def at_volume(spark, folder: str, copies: int) -> str:
    """A folder with the tables, the line items copied under new order keys and with a hot supplier."""
    out = scratch_path(spark, "volume")
    for name in TABLES:
        rows = spark.read.parquet(f"{folder}/{name}.parquet")
        if name == "lineitem":
            copy = F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias("copy")
            rows = rows.select("*", copy).withColumns(
                {
                    "l_orderkey": F.col("l_orderkey") + F.col("copy") * 1_000_000_000,
                    "l_suppkey": F.when(F.col("copy") % 3 == 1, 1).otherwise(F.col("l_suppkey")).cast("bigint"),
                }
            ).drop("copy").repartition(4 * copies)
        rows.write.parquet(f"{out}/{name}.parquet")
    return out


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), **{"spark.driver.memory": "20g"})
    sf = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    if copies := int(os.environ.get("BENCH_COPIES", "0")):
        folder = at_volume(spark, folder, copies)
    wanted = os.environ.get("BENCH_QUERIES", "").split() or HEADLINE
    cold, warm = {}, {}
    for name in wanted:
        cold[name] = round(run(spark, name, folder), 3)
        warm[name] = round(run(spark, name, folder), 3)
    print(
        json.dumps(
            {
                "metric": "total_warm_seconds",
                "value": round(sum(warm.values()), 3),
                "unit": "sec",
                "queries": warm,
                "cold": cold,
                "sf": sf,
                "copies": copies or 1,
                "shuffle_partitions": spark.conf.get("spark.sql.shuffle.partitions"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
