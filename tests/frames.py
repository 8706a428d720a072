"""Small hand-made frames."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from farelake.operators.fact import fct_trips, with_month
from farelake.schemas import STG_TRIPS
from harness.fixture import raw_trips

SMALL = "/root/testdata/sf0.001"

DEFAULTS = {
    "vendor_id": 1,
    "pickup_datetime": dt.datetime(2024, 1, 10, 8, 0, 0),
    "dropoff_datetime": dt.datetime(2024, 1, 10, 8, 30, 0),
    "passenger_count": 1,
    "trip_distance_miles": 5.0,
    "pickup_location_id": 100,
    "dropoff_location_id": 200,
    "rate_code_id": 1,
    "store_and_fwd_flag": "N",
    "payment_type_id": 1,
    "fare_amount": 20.0,
    "extra_charges": 0.5,
    "mta_tax": 0.5,
    "tip_amount": 1.0,
    "tolls_amount": 0.0,
    "improvement_surcharge": 1.0,
    "total_amount": 23.0,
    "congestion_surcharge": 2.5,
    "airport_fee": None,
    "_loaded_at": dt.datetime(2024, 2, 1),
}


def staged_rows(spark, *changes):
    """One staged trip per dict of changes to an ordinary trip."""
    rows = [tuple({**DEFAULTS, **change}[name] for name in STG_TRIPS.fieldNames()) for change in changes]
    return spark.createDataFrame(rows, STG_TRIPS)


def fact_rows(spark, *changes):
    return with_month(fct_trips(staged_rows(spark, *changes)))


def raw_by_month(spark, sf_dir=SMALL):
    pickup = F.col("tpep_pickup_datetime")
    return raw_trips(spark, sf_dir).withColumns({"year": F.year(pickup), "month": F.date_format(pickup, "MM")})
