"""Time every registered query at $BENCH_SF_DIR and print one JSON line.

Besides the single warm timings it repeats the reports the baseline names 20 times and gives
p50 and p95: the hourly aggregate over the base rows and over its kept-up-to-date view, with the
rows each one reads, and a dashboard query over the stored star schema.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from pyspark.sql import DataFrame, SparkSession

from shoreline.operators import reports
from shoreline.plans import adapters, registry
from shoreline.session import settings_for
from shoreline.sources import tables

RUNS = 20


def session() -> SparkSession:
    cpus = os.environ.get("BENCH_CPUS", "8")
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("shoreline-bench")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .config(map=settings_for(shuffle_bytes=1 << 30, cores=int(cpus)))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def execute(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def seconds(work) -> float:
    start = time.perf_counter()
    work()
    return round(time.perf_counter() - start, 4)


def repeated(work) -> dict[str, float]:
    work()
    times = [seconds(work) * 1000 for _ in range(RUNS)]
    return {
        "p50_ms": round(statistics.median(times), 1),
        "p95_ms": round(sorted(times)[int(RUNS * 0.95) - 1], 1),
    }


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = session()
    spark.sparkContext.setLogLevel("ERROR")
    execute(registry.QUERIES["hourly_revenue"](spark, sf_dir))

    timings = {
        "land_sales": seconds(lambda: registry.landed_sales(spark, sf_dir)),
        "star_build": seconds(lambda: registry.stored_star(spark, sf_dir)),
        "land_changes": seconds(lambda: registry.landed_changes(spark, sf_dir)),
    }
    for name, query in registry.QUERIES.items():
        timings[name] = seconds(lambda: execute(query(spark, sf_dir)))

    namespace = registry.fresh_namespace(spark, "bench")
    given = adapters.event_orders(adapters.table(spark, sf_dir, "events"))
    tables.overwrite_table(spark, given, f"{namespace}.vendas")
    events = tables.read_table(spark, f"{namespace}.vendas")
    view = registry.revenue_view(spark, f"{namespace}.receita_por_hora", events)
    view.apply_delta(events, 0)
    stored = view.read()
    star = registry.stored_star(spark, sf_dir)
    latency = {
        "hourly_without_view": {
            **repeated(lambda: reports.hourly_revenue(events).collect()),
            "rows_read": events.count(),
        },
        "hourly_with_view": {**repeated(stored.collect), "rows_read": stored.count()},
        "business_query": repeated(
            lambda: reports.rating_by_category(
                star["fact_product_rating"], star["dim_product"]
            ).collect()
        ),
    }
    print(
        json.dumps(
            {
                "metric": "total_query_time",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "latency": latency,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
