"""Column contracts of the stored tables; `conform` asserts one before a write."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


_TYPES = {
    "BIGINT": T.LongType(),
    "DOUBLE": T.DoubleType(),
    "STRING": T.StringType(),
    "BOOLEAN": T.BooleanType(),
    "DATE": T.DateType(),
    "TIMESTAMP": T.TimestampType(),
    "TIMESTAMP_NTZ": T.TimestampNTZType(),
    "RATE": T.DecimalType(18, 6),
    "PARAMS": T.MapType(T.StringType(), T.StringType()),
    "METRICS": T.MapType(T.StringType(), T.DoubleType()),
}


def _schema(columns: str) -> T.StructType:
    """A schema from `name TYPE, ...` (Spark's own DDL parser needs a running session)."""
    pairs = (column.split() for column in columns.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


STG_TRIPS = _schema(
    """
    vendor_id BIGINT, pickup_datetime TIMESTAMP_NTZ, dropoff_datetime TIMESTAMP_NTZ,
    passenger_count BIGINT, trip_distance_miles DOUBLE, pickup_location_id BIGINT,
    dropoff_location_id BIGINT, rate_code_id BIGINT, store_and_fwd_flag STRING,
    payment_type_id BIGINT, fare_amount DOUBLE, extra_charges DOUBLE, mta_tax DOUBLE,
    tip_amount DOUBLE, tolls_amount DOUBLE, improvement_surcharge DOUBLE, total_amount DOUBLE,
    congestion_surcharge DOUBLE, airport_fee DOUBLE, _loaded_at TIMESTAMP
    """
)

FCT_TRIPS = _schema(
    """
    trip_id BIGINT, vendor_id BIGINT, pickup_datetime TIMESTAMP_NTZ, dropoff_datetime TIMESTAMP_NTZ,
    pickup_date DATE, dropoff_date DATE, pickup_hour BIGINT, dropoff_hour BIGINT,
    pickup_day_of_week BIGINT, pickup_location_id BIGINT, dropoff_location_id BIGINT,
    passenger_count BIGINT, trip_distance_miles DOUBLE, trip_duration_minutes BIGINT,
    avg_speed_mph DOUBLE, rate_code_id BIGINT, store_and_fwd_flag STRING, payment_type_id BIGINT,
    fare_amount DOUBLE, extra_charges DOUBLE, mta_tax DOUBLE, tip_amount DOUBLE,
    tolls_amount DOUBLE, improvement_surcharge DOUBLE, congestion_surcharge DOUBLE,
    airport_fee DOUBLE, total_amount DOUBLE, tip_percentage DOUBLE,
    has_data_quality_issue BOOLEAN, _loaded_at TIMESTAMP
    """
)

DIM_VENDOR = _schema("vendor_id BIGINT, vendor_name STRING")
DIM_PAYMENT_TYPE = _schema("payment_type_id BIGINT, payment_type_name STRING")
DIM_RATE_CODE = _schema("rate_code_id BIGINT, rate_code_name STRING")
DIM_DATE = _schema(
    """
    date_key DATE, year BIGINT, quarter BIGINT, month BIGINT, week_of_year BIGINT,
    day_of_month BIGINT, day_of_week BIGINT, day_name STRING, month_name STRING,
    year_month STRING, year_quarter STRING, fiscal_year BIGINT, is_weekend BOOLEAN,
    is_holiday BOOLEAN
    """
)
DIM_TIME = _schema(
    """
    hour_key BIGINT, hour_of_day BIGINT, time_period STRING, is_rush_hour BOOLEAN,
    peak_category STRING, hour_display STRING, hour_range STRING
    """
)

DAILY_SUMMARY = _schema(
    """
    pickup_date DATE, year BIGINT, month BIGINT, day_of_week BIGINT, total_trips BIGINT,
    total_passengers BIGINT, unique_pickup_locations BIGINT, unique_dropoff_locations BIGINT,
    total_distance_miles DOUBLE, avg_distance_miles DOUBLE, median_distance_miles DOUBLE,
    total_duration_minutes BIGINT, avg_duration_minutes DOUBLE, median_duration_minutes BIGINT,
    total_revenue DOUBLE, total_fare_revenue DOUBLE, total_tips DOUBLE, total_tolls DOUBLE,
    avg_trip_revenue DOUBLE, avg_tip DOUBLE, avg_tip_percentage DOUBLE, credit_card_trips BIGINT,
    cash_trips BIGINT, trips_with_issues BIGINT, pct_trips_with_issues DOUBLE
    """
)
HOURLY_PATTERNS = _schema(
    """
    pickup_hour BIGINT, pickup_day_of_week BIGINT, day_name STRING, day_type STRING,
    total_trips BIGINT, avg_distance DOUBLE, avg_duration DOUBLE, avg_fare DOUBLE,
    avg_tip DOUBLE, avg_speed DOUBLE
    """
)
MONTHLY_TRENDS = _schema(
    """
    year BIGINT, month BIGINT, year_month STRING, month_start_date DATE, total_trips BIGINT,
    total_passengers BIGINT, avg_daily_trips DOUBLE, total_revenue DOUBLE, fare_revenue DOUBLE,
    tip_revenue DOUBLE, revenue_per_trip DOUBLE, avg_distance DOUBLE, avg_duration DOUBLE,
    avg_speed DOUBLE, prev_month_trips BIGINT, prev_month_revenue DOUBLE
    """
)
LOCATION_STATS = _schema(
    """
    location_id BIGINT, pickup_trips BIGINT, dropoff_trips BIGINT, total_trips BIGINT,
    total_revenue DOUBLE, avg_fare DOUBLE, popularity_rank BIGINT
    """
)
PAYMENT_ANALYSIS = _schema(
    """
    year BIGINT, month BIGINT, year_month STRING, payment_type_id BIGINT, payment_type_name STRING,
    trip_count BIGINT, total_revenue DOUBLE, avg_fare DOUBLE, avg_tip DOUBLE, avg_tip_pct DOUBLE,
    pct_of_monthly_trips DOUBLE
    """
)
TRIP_DISTANCE_DISTRIBUTION = _schema(
    """
    distance_bucket STRING, bucket_order BIGINT, trip_count BIGINT, pct_of_total DOUBLE,
    avg_duration_minutes DOUBLE, avg_fare DOUBLE, avg_tip DOUBLE, total_revenue DOUBLE
    """
)
VENDOR_COMPARISON = _schema(
    """
    year BIGINT, month BIGINT, year_month STRING, vendor_id BIGINT, vendor_name STRING,
    trip_count BIGINT, total_passengers BIGINT, total_distance DOUBLE, total_revenue DOUBLE,
    avg_distance DOUBLE, avg_duration DOUBLE, avg_fare DOUBLE, avg_tip DOUBLE,
    market_share_pct DOUBLE
    """
)
YEAR_OVER_YEAR = _schema(
    """
    year BIGINT, total_trips BIGINT, total_revenue DOUBLE, total_tips DOUBLE, avg_distance DOUBLE,
    avg_duration DOUBLE, avg_fare DOUBLE, prev_year_trips BIGINT, prev_year_revenue DOUBLE,
    trips_yoy_change_pct DOUBLE, revenue_yoy_change_pct DOUBLE
    """
)

FX_RATES = _schema("base_currency STRING, quote_currency STRING, rate RATE, run_date DATE")
ZONES = _schema("location_id BIGINT, zone STRING, borough STRING")

TRAINING = _schema(
    """
    ds DATE, y DOUBLE, year BIGINT, month BIGINT, day_of_week BIGINT, total_trips BIGINT,
    total_revenue DOUBLE, avg_trip_revenue DOUBLE, avg_distance_miles DOUBLE,
    avg_duration_minutes DOUBLE
    """
)
FORECAST_VALIDATION = _schema("ds DATE, y_true DOUBLE, y_pred DOUBLE")
FUTURE_FORECAST = _schema("date DATE, forecast DOUBLE")
ML_RUNS = _schema(
    """
    run_id STRING, run_name STRING, status STRING, start_time TIMESTAMP,
    params PARAMS, metrics METRICS
    """
)
LOAD_LOG = _schema(
    """
    year BIGINT, month BIGINT, uri STRING, file_size_mb DOUBLE, num_rows BIGINT,
    num_columns BIGINT, logged_at TIMESTAMP
    """
)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """`df` with exactly the contract's columns, in its order; a wrong name or type is an error.

    Types are compared, never cast: a silent cast would hide the mistake the contract is there to catch.
    """
    have = {field.name: field.dataType for field in df.schema.fields}
    want = {field.name: field.dataType for field in schema.fields}
    if have != want:
        wrong = sorted(
            f"{name}: expected {want[name].simpleString() if name in want else 'no such column'}, "
            f"got {have[name].simpleString() if name in have else 'nothing'}"
            for name in have.keys() | want.keys()
            if have.get(name) != want.get(name)
        )
        raise ValueError("table does not match its contract: " + "; ".join(wrong))
    return df.select(*[F.col(name) for name in schema.fieldNames()])
