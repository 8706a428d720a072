"""Times the load, the gold tables, the reads and an incremental merge; prints one JSON line.

The input is the raw-trip view over the tables in $BENCH_SF_DIR. As in production, raw files are landed
by month, the fact is stored once, and gold tables are computed from the stored fact. Every query's
result is consumed in full. Reads are run twice and the faster time counts, so the figures are those of a
running session; loads and writes are run once.
"""

from __future__ import annotations

import datetime as dt
import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from farelake.functions.sizing import broadcast_if_small  # noqa: E402
from farelake.operators import dims, gold, readlayer  # noqa: E402
from farelake.plans import gold as gold_plan  # noqa: E402
from farelake.plans import load  # noqa: E402
from farelake.plans.dashboard import dashboard  # noqa: E402
from farelake.session import local_session, scratch_path  # noqa: E402
from farelake.sources import bronze  # noqa: E402
from harness.fixture import raw_trips  # noqa: E402


def consume(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session("farelake-bench", cores=cpus, shuffle_partitions=8)
    bronze_root, lake = scratch_path(spark, "bench-bronze"), scratch_path(spark, "bench-lake")
    seconds: dict[str, float] = {}

    def timed(name, action) -> None:
        start = time.perf_counter()
        action()
        seconds[name] = round(time.perf_counter() - start, 3)

    def read(name, action) -> None:
        timed(name, action)
        first = seconds[name]
        timed(name, action)
        seconds[name] = min(first, seconds[name])

    consume(spark.range(1000).groupBy(F.col("id") % 7).count())  # JVM start-up is not a query

    pickup = F.col("tpep_pickup_datetime")
    raw = raw_trips(spark, sf_dir).withColumns({"year": F.year(pickup), "month": F.date_format(pickup, "MM")})
    newest = pickup >= "2001-11-01"  # arrives later, for the incremental load
    timed("bronze_land", lambda: bronze.bronze_land_months(raw.filter(~newest), bronze_root))
    timed("load_dimensions", lambda: load.load_dimensions(spark, bronze.bronze_scan(spark, bronze_root), lake))
    timed("load_fact", lambda: load.load_fact(spark, bronze_root, lake))
    read("dq_report", lambda: load.check_quality(spark, lake).collect())

    fct = load.read_fact(spark, lake)
    for name in gold_plan.TABLES:
        read(name, lambda: consume(getattr(gold, name)(fct)))
    timed("build_gold", lambda: gold_plan.build_gold(spark, lake))

    # The stored calendar starts in 2009; the trips of the fixture are older.
    tables = {name: spark.read.parquet(f"{lake}/{name}") for name in ("dim_vendor", "dim_payment_type", "dim_rate_code")}
    tables |= {"dim_date": dims.dim_date(spark, "1990-01-01", "2030-12-31"), "dim_time": spark.read.parquet(f"{lake}/dim_time")}
    read("star_trips", lambda: consume(dims.star_trips(fct, *map(broadcast_if_small, tables.values()))))
    read("kpi_summary", lambda: consume(readlayer.kpi_summary(
        spark.read.parquet(f"{lake}/gold/daily_summary"),
        readlayer.last_valid_date(spark.read.parquet(f"{lake}/gold/daily_summary")))))
    read("dashboard", lambda: [frame.collect() for frame in dashboard(spark, lake).values()])
    timed("merge_one_month", lambda: load.load_fact(spark, bronze_root, lake, mode="by_month", months=[(1998, 5)]))
    timed("refresh_gold_one_month", lambda: gold_plan.build_gold(spark, lake, months=[dt.date(1998, 5, 1)]))
    bronze.bronze_land_months(raw.filter(newest), bronze_root)
    timed("incremental_load", lambda: load.load_fact(spark, bronze_root, lake))

    print(json.dumps({
        "metric": "trip load, gold tables, reads and merge: total wall time",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
