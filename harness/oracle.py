"""DuckDB statements that the registered queries are compared with, over the same Parquet tables."""

from __future__ import annotations

from farelake.functions import fixed
from harness.fixture import RAW_TRIPS_SQL

MIN_TRIPS = 10

_RAW = "raw AS (" + RAW_TRIPS_SQL.replace("{lineitem}", "lineitem") + ")"

_STG = """
stg AS (
  SELECT VendorID::BIGINT vendor_id, tpep_pickup_datetime pickup_datetime,
    tpep_dropoff_datetime dropoff_datetime, passenger_count::BIGINT passenger_count,
    trip_distance trip_distance_miles, PULocationID pickup_location_id,
    DOLocationID dropoff_location_id, RatecodeID::BIGINT rate_code_id, store_and_fwd_flag,
    payment_type::BIGINT payment_type_id, fare_amount, extra extra_charges, mta_tax, tip_amount,
    tolls_amount, improvement_surcharge, total_amount, congestion_surcharge, Airport_fee airport_fee
  FROM raw
)"""

# date_sub counts complete minutes (date_diff would count minute boundaries); DuckDB's weekday is 0-based.
_TIMED = """
timed AS (
  SELECT *, date_sub('minute', pickup_datetime, dropoff_datetime) AS trip_duration_minutes,
    trip_distance_miles / nullif(date_sub('minute', pickup_datetime, dropoff_datetime) / 60.0::DOUBLE, 0)
      AS avg_speed_mph,
    tip_amount / nullif(fare_amount, 0) * 100.0::DOUBLE AS tip_percentage
  FROM stg
)"""

_FLAGGED = """
flagged AS (
  SELECT *, coalesce(trip_distance_miles <= 0, false) OR coalesce(trip_duration_minutes <= 0, false)
    OR coalesce(fare_amount < 0, false) OR coalesce(total_amount < 0, false)
    OR coalesce(passenger_count NOT BETWEEN 1 AND 9, false)
    OR coalesce(avg_speed_mph > 100, false) OR coalesce(pickup_datetime > dropoff_datetime, false)
    AS has_data_quality_issue
  FROM timed
)"""

_FCT = """
fct AS (
  SELECT *, pickup_datetime::DATE AS pickup_date, dropoff_datetime::DATE AS dropoff_date,
    hour(pickup_datetime) AS pickup_hour, hour(dropoff_datetime) AS dropoff_hour,
    dayofweek(pickup_datetime) + 1 AS pickup_day_of_week
  FROM flagged
  WHERE pickup_datetime < dropoff_datetime AND trip_distance_miles >= 0 AND fare_amount >= 0
), clean AS (SELECT * FROM fct WHERE NOT has_data_quality_issue)"""

_DAY_NAME = (
    "(['Sunday','Monday','Tuesday','Wednesday','Thursday','Friday','Saturday'])[{0}]"
)
_PAYMENT_NAME = (
    "CASE {0} "
    + " ".join(f"WHEN {code} THEN '{name}'" for code, name in fixed.PAYMENT_GOLD_LABELS.items())
    + f" ELSE '{fixed.PAYMENT_GOLD_DEFAULT}' END"
)

_DAILY = """
daily AS (
  SELECT pickup_date, year(pickup_date) AS year, month(pickup_date) AS month,
    dayofweek(pickup_date) + 1 AS day_of_week, count(*) AS total_trips,
    sum(passenger_count)::BIGINT AS total_passengers,
    count(DISTINCT pickup_location_id) AS unique_pickup_locations,
    count(DISTINCT dropoff_location_id) AS unique_dropoff_locations,
    sum(trip_distance_miles) AS total_distance_miles, avg(trip_distance_miles) AS avg_distance_miles,
    quantile_disc(trip_distance_miles, 0.5) AS median_distance_miles,
    sum(trip_duration_minutes)::BIGINT AS total_duration_minutes,
    avg(trip_duration_minutes) AS avg_duration_minutes,
    quantile_disc(trip_duration_minutes, 0.5) AS median_duration_minutes,
    sum(total_amount) AS total_revenue, sum(fare_amount) AS total_fare_revenue,
    sum(tip_amount) AS total_tips, sum(tolls_amount) AS total_tolls,
    avg(total_amount) AS avg_trip_revenue, avg(tip_amount) AS avg_tip,
    round(avg(tip_percentage), 6) AS avg_tip_percentage,
    count(*) FILTER (payment_type_id = 1) AS credit_card_trips,
    count(*) FILTER (payment_type_id = 2) AS cash_trips,
    count(*) FILTER (has_data_quality_issue) AS trips_with_issues,
    round(count(*) FILTER (has_data_quality_issue) / count(*) * 100, 2) AS pct_trips_with_issues
  FROM fct GROUP BY pickup_date
)"""



def _per(period: str) -> str:
    """The daily table with a longer period in place of the day."""
    return _DAILY.replace("FROM fct GROUP BY pickup_date", f"FROM (SELECT * REPLACE ({period} AS pickup_date) FROM fct) GROUP BY pickup_date")


_HOURLY = f"""
hourly AS (
  SELECT pickup_hour, pickup_day_of_week, {_DAY_NAME.format('pickup_day_of_week')} AS day_name,
    if(pickup_day_of_week IN (1, 7), 'Weekend', 'Weekday') AS day_type,
    count(*) AS total_trips, avg(trip_distance_miles) AS avg_distance,
    avg(trip_duration_minutes) AS avg_duration, avg(total_amount) AS avg_fare,
    avg(tip_amount) AS avg_tip, round(avg(avg_speed_mph), 6) AS avg_speed
  FROM clean GROUP BY pickup_hour, pickup_day_of_week
)"""

_MONTHLY = """
monthly AS (
  SELECT year(pickup_date) AS year, month(pickup_date) AS month,
    strftime(pickup_date, '%Y-%m') AS year_month, min(pickup_date) AS month_start_date,
    count(*) AS total_trips, sum(passenger_count)::BIGINT AS total_passengers,
    count(*) / count(DISTINCT pickup_date) AS avg_daily_trips, sum(total_amount) AS total_revenue,
    sum(fare_amount) AS fare_revenue, sum(tip_amount) AS tip_revenue,
    sum(total_amount) / count(*) AS revenue_per_trip, avg(trip_distance_miles) AS avg_distance,
    avg(trip_duration_minutes) AS avg_duration, round(avg(avg_speed_mph), 6) AS avg_speed,
    lag(count(*)) OVER (ORDER BY min(pickup_date)) AS prev_month_trips,
    lag(sum(total_amount)) OVER (ORDER BY min(pickup_date)) AS prev_month_revenue
  FROM clean GROUP BY 1, 2, 3
)"""

_ZONES_GOLD = """
locations AS (
  SELECT location_id, coalesce(sum(n) FILTER (is_pickup), 0)::BIGINT AS pickup_trips,
    coalesce(sum(n) FILTER (NOT is_pickup), 0)::BIGINT AS dropoff_trips,
    sum(n)::BIGINT AS total_trips, sum(revenue) AS total_revenue, avg(mean_fare) AS avg_fare,
    rank() OVER (ORDER BY sum(n) DESC) AS popularity_rank
  FROM (
    SELECT pickup_location_id AS location_id, true AS is_pickup, count(*) AS n,
      sum(total_amount) AS revenue, avg(total_amount) AS mean_fare FROM clean GROUP BY 1
    UNION ALL
    SELECT dropoff_location_id, false, count(*), sum(total_amount), avg(total_amount)
    FROM clean GROUP BY 1
  ) GROUP BY location_id
)"""

_PAYMENT = f"""
payment AS (
  SELECT year(pickup_date) AS year, month(pickup_date) AS month,
    strftime(pickup_date, '%Y-%m') AS year_month, payment_type_id,
    {_PAYMENT_NAME.format('payment_type_id')} AS payment_type_name, count(*) AS trip_count,
    sum(total_amount) AS total_revenue, avg(total_amount) AS avg_fare, avg(tip_amount) AS avg_tip,
    round(avg(tip_percentage), 6) AS avg_tip_pct,
    round(count(*) * 100.0::DOUBLE / sum(count(*)) OVER (PARTITION BY year(pickup_date),
      month(pickup_date)), 2) AS pct_of_monthly_trips
  FROM clean GROUP BY 1, 2, 3, 4
)"""

_BANDS = """
bands AS (
  SELECT (['0-1 miles','1-2 miles','2-5 miles','5-10 miles','10-20 miles','20+ miles'])[band]
      AS distance_bucket, band AS bucket_order, count(*) AS trip_count,
    round(count(*) * 100.0::DOUBLE / sum(count(*)) OVER (), 2) AS pct_of_total,
    avg(trip_duration_minutes) AS avg_duration_minutes, avg(total_amount) AS avg_fare,
    avg(tip_amount) AS avg_tip, sum(total_amount) AS total_revenue
  FROM (SELECT *, (CASE WHEN trip_distance_miles < 1 THEN 1 WHEN trip_distance_miles < 2 THEN 2
      WHEN trip_distance_miles < 5 THEN 3 WHEN trip_distance_miles < 10 THEN 4
      WHEN trip_distance_miles < 20 THEN 5 ELSE 6 END)::BIGINT AS band FROM clean)
  GROUP BY band
)"""

_VENDOR = """
vendor AS (
  SELECT year(pickup_date) AS year, month(pickup_date) AS month,
    strftime(pickup_date, '%Y-%m') AS year_month, vendor_id,
    CASE WHEN vendor_id = 1 THEN 'Creative Mobile Technologies' WHEN vendor_id = 2 THEN 'VeriFone'
      ELSE 'Unknown' END AS vendor_name, count(*) AS trip_count,
    sum(passenger_count)::BIGINT AS total_passengers, sum(trip_distance_miles) AS total_distance,
    sum(total_amount) AS total_revenue, avg(trip_distance_miles) AS avg_distance,
    avg(trip_duration_minutes) AS avg_duration, avg(total_amount) AS avg_fare,
    avg(tip_amount) AS avg_tip,
    round(count(*) * 100.0::DOUBLE / sum(count(*)) OVER (PARTITION BY year(pickup_date),
      month(pickup_date)), 2) AS market_share_pct
  FROM clean GROUP BY 1, 2, 3, 4
)"""

_YOY = """
yoy AS (
  SELECT *, round((total_trips - prev_year_trips) * 100.0::DOUBLE / nullif(prev_year_trips, 0), 2)
      AS trips_yoy_change_pct,
    round((total_revenue - prev_year_revenue) * 100.0::DOUBLE / nullif(prev_year_revenue, 0), 2)
      AS revenue_yoy_change_pct
  FROM (
    SELECT year(pickup_date) AS year, count(*) AS total_trips, sum(total_amount) AS total_revenue,
      sum(tip_amount) AS total_tips, avg(trip_distance_miles) AS avg_distance,
      avg(trip_duration_minutes) AS avg_duration, avg(total_amount) AS avg_fare,
      lag(count(*)) OVER (ORDER BY year(pickup_date)) AS prev_year_trips,
      lag(sum(total_amount)) OVER (ORDER BY year(pickup_date)) AS prev_year_revenue
    FROM clean GROUP BY 1
  )
)"""

_BASE = (_RAW, _STG, _TIMED, _FLAGGED, _FCT)


def _over(final: str, *more: str) -> str:
    return "WITH " + ",\n".join(part.strip() for part in (*_BASE, *more)) + "\n" + final.strip()


_FCT_OUT = """SELECT vendor_id, pickup_datetime, dropoff_datetime, pickup_date, dropoff_date,
  pickup_hour, dropoff_hour, pickup_day_of_week, pickup_location_id, dropoff_location_id,
  passenger_count, trip_distance_miles, trip_duration_minutes, avg_speed_mph, rate_code_id,
  store_and_fwd_flag, payment_type_id, fare_amount, extra_charges, mta_tax, tip_amount,
  tolls_amount, improvement_surcharge, congestion_surcharge, airport_fee, total_amount,
  tip_percentage, has_data_quality_issue FROM """

_CALENDAR_OUT = f"""
SELECT d AS date_key, year(d) AS year, quarter(d) AS quarter, month(d) AS month,
  strftime(d, '%U')::BIGINT AS week_of_year, day(d) AS day_of_month, dayofweek(d) + 1 AS day_of_week,
  {_DAY_NAME.format('dayofweek(d) + 1')} AS day_name, strftime(d, '%B') AS month_name,
  strftime(d, '%Y-%m') AS year_month, year(d) || '-Q' || quarter(d) AS year_quarter,
  year(d + INTERVAL 6 MONTH) AS fiscal_year, dayofweek(d) % 6 = 0 AS is_weekend, false AS is_holiday
FROM (SELECT unnest(range(min(pickup_date)::TIMESTAMP, max(pickup_date)::TIMESTAMP + INTERVAL 1 DAY,
  INTERVAL 1 DAY))::DATE AS d FROM fct)"""

_HOUR_OUT = """
SELECT h AS hour_key, h AS hour_of_day,
  (['Night','Morning','Afternoon','Evening'])[h // 6 + 1] AS time_period,
  h IN (7, 8, 9, 17, 18, 19) AS is_rush_hour,
  CASE WHEN h BETWEEN 6 AND 10 THEN 'Morning Peak' WHEN h BETWEEN 16 AND 20 THEN 'Evening Peak'
    WHEN h BETWEEN 11 AND 15 THEN 'Midday' ELSE 'Off-Peak' END AS peak_category,
  lpad(h::VARCHAR, 2, '0') || ':00' AS hour_display,
  lpad(h::VARCHAR, 2, '0') || ':00 - ' || lpad(h::VARCHAR, 2, '0') || ':59' AS hour_range,
  (SELECT count(*) FROM fct WHERE pickup_hour = h) AS trips
FROM (SELECT unnest(range(24)) AS h)"""


_ZONES = """
zones AS (
  SELECT location_id, min(s_name) AS zone,
    CASE WHEN location_id % 10 <> 0 THEN 'nation ' || min(s_nationkey) END AS borough
  FROM (SELECT s_suppkey * 7 % 263 + 1 AS location_id, s_name, s_nationkey FROM supplier) GROUP BY location_id
)"""

_LAST = f"""
last AS (
  SELECT max(pickup_date) AS last_valid_date FROM daily
  WHERE total_trips > {MIN_TRIPS} AND total_revenue > 0 AND avg_trip_revenue BETWEEN 5 AND 200
)"""

_UNTIL_MONTH = """total_revenue > 0 AND coalesce(
  year_month <= (SELECT strftime(last_valid_date, '%Y-%m') FROM last), true)"""

_DAILY_READ = f"""
daily_read AS (
  SELECT pickup_date, year, month, day_of_week, total_trips, total_revenue, avg_distance_miles,
    avg_duration_minutes, avg_trip_revenue, avg_tip, credit_card_trips, cash_trips
  FROM daily
  WHERE total_trips > {MIN_TRIPS} AND total_revenue > 0 AND avg_trip_revenue BETWEEN 5 AND 200
    AND coalesce(pickup_date <= (SELECT last_valid_date FROM last), true)
  ORDER BY pickup_date DESC LIMIT 365
)"""

_PAYMENT_READ = f"""
payment_read AS (
  SELECT * EXCLUDE (payment_type_id) FROM payment WHERE {_UNTIL_MONTH}
)"""

_VENDOR_READ = f"""
vendor_read AS (
  SELECT * EXCLUDE (vendor_id, total_passengers, total_distance) FROM vendor WHERE {_UNTIL_MONTH}
)"""

_YOY_READ = """
yoy_read AS (
  SELECT * EXCLUDE (prev_year_trips, prev_year_revenue) FROM yoy
  WHERE total_revenue > 0 AND coalesce(year <= (SELECT year(last_valid_date) FROM last), true)
)"""

_MONTHLY_READ = f"""
monthly_read AS (
  SELECT year_month, year, month, total_trips, total_revenue, fare_revenue, tip_revenue,
    avg_daily_trips, revenue_per_trip, revenue_per_trip AS avg_fare, avg_distance, avg_duration
  FROM monthly WHERE {_UNTIL_MONTH} ORDER BY year_month DESC LIMIT 120
)"""

_TRAIN = """
train AS (
  SELECT pickup_date AS ds, total_trips::DOUBLE AS y, year, month, day_of_week, total_trips,
    total_revenue, avg_trip_revenue, avg_distance_miles, avg_duration_minutes
  FROM daily WHERE pickup_date BETWEEN DATE '{0}' AND DATE '2001-06-30'
)"""
_TRAIN_2 = _TRAIN.format("1999-06-30")
_TRAIN_10 = _TRAIN.format("1991-06-30")

_VALIDATED = """
week AS (
  SELECT ds, y, lag(y, 7) OVER (ORDER BY ds) AS forecast, row_number() OVER (ORDER BY ds DESC) AS back
  FROM train
), validated AS (
  SELECT ds, y AS y_true, forecast AS y_pred FROM week WHERE back <= 365 AND forecast IS NOT NULL
)"""

_RUNS = """
runs AS (
  SELECT 'run-' || lpad(o_orderkey::VARCHAR, 12, '0') AS run_id,
    CASE WHEN o_orderkey % 5 <> 0 THEN model || '_' || metric
      ELSE left('run-' || lpad(o_orderkey::VARCHAR, 12, '0'), 8) END AS run_name,
    CASE o_orderstatus WHEN 'F' THEN 'FINISHED' WHEN 'O' THEN 'RUNNING' ELSE 'FAILED' END AS status,
    o_orderdate AS start_time,
    if(o_orderkey % 11 <> 0, model, 'unknown') AS model_type,
    if(o_orderkey % 11 <> 0, metric, 'unknown') AS target_metric,
    if(o_orderkey % 11 <> 0, (o_orderkey % 30 + 7)::VARCHAR, 'N/A') AS forecast_horizon,
    if(o_orderkey % 7 <> 0, mape * 4, NULL) AS mae, if(o_orderkey % 7 <> 0, mape * 8, NULL) AS rmse,
    if(o_orderkey % 7 <> 0, mape, NULL) AS mape
  FROM (SELECT *, (['additive','sarma','gbt','holtwinters'])[o_orderkey % 4 + 1] AS model,
    (['total_trips','total_revenue','avg_trip_revenue'])[o_orderkey % 3 + 1] AS metric,
    (o_orderkey * 37 % 1000)::DOUBLE / 16::DOUBLE AS mape FROM orders)
)"""
_FX = """
rates AS (
  SELECT o_orderdate::DATE AS feed_date, 'C' || lpad((o_custkey % 25)::VARCHAR, 2, '0') AS quote,
    (sum(o_orderkey % 1000) + 1)::DOUBLE / 8::DOUBLE AS rate
  FROM orders GROUP BY 1, 2
)"""
_GRADE = ("CASE WHEN mape < 10 THEN 'good' WHEN mape < 20 THEN 'fair' WHEN mape IS NOT NULL THEN 'poor' END")


def _with(final: str, *parts: str) -> str:
    return "WITH " + ",\n".join(part.strip() for part in parts) + "\n" + final.strip()


def _compact(value: str, decimals: int) -> str:
    shape = f"'{{:.{decimals}f}}'"
    return (
        f"CASE WHEN {value} >= 1e9 THEN format({shape}, {value} / 1e9) || 'B' "
        f"WHEN {value} >= 1e6 THEN format({shape}, {value} / 1e6) || 'M' "
        f"WHEN {value} >= 1e3 THEN format({shape}, {value} / 1e3) || 'K' "
        f"ELSE format({shape}, {value}::DOUBLE) END"
    )


def _code_dim(key: str, name: str, labels: dict[int, str], default: str) -> str:
    whens = " ".join(f"WHEN {key} = {code} THEN '{label}'" for code, label in labels.items())
    return _over(f"SELECT {key}, CASE {whens} ELSE '{default}' END AS {name} "
                 f"FROM stg WHERE {key} IS NOT NULL GROUP BY {key}")


def _declared_checks():
    """(table, column, test, severity, SQL counting the failures)."""
    trip_key = "pickup_datetime, dropoff_datetime, pickup_location_id, dropoff_location_id, fare_amount"
    days = ("SELECT unnest(range(min(pickup_date)::TIMESTAMP, max(pickup_date)::TIMESTAMP + INTERVAL 1 DAY, "
            "INTERVAL 1 DAY)) AS v FROM fct")
    keys = (
        ("dim_vendor", "vendor_id", "SELECT DISTINCT vendor_id AS v FROM stg WHERE vendor_id IS NOT NULL"),
        ("dim_payment_type", "payment_type_id",
         "SELECT DISTINCT payment_type_id AS v FROM stg WHERE payment_type_id IS NOT NULL"),
        ("dim_rate_code", "rate_code_id",
         "SELECT DISTINCT rate_code_id AS v FROM stg WHERE rate_code_id IS NOT NULL"),
        ("dim_date", "date_key", days),
        ("dim_time", "hour_key", "SELECT unnest(range(24)) AS v"),
    )
    for table, column, rows in keys:
        yield table, column, "not_null", "error", f"SELECT count(*) FROM ({rows}) WHERE v IS NULL"
        yield (table, column, "unique", "error",
               f"SELECT count(*) FROM (SELECT v FROM ({rows}) GROUP BY v HAVING count(*) > 1)")
    unknown = " OR ".join(f"{c} IS NULL" for c in trip_key.split(", "))
    yield "fct_trips", "trip_id", "not_null", "error", f"SELECT count(*) FROM fct WHERE {unknown}"
    yield ("fct_trips", "trip_id", "unique", "warn",
           f"SELECT count(*) FROM (SELECT 1 FROM fct GROUP BY {trip_key} HAVING count(*) > 1)")
    for column in ("pickup_datetime", "dropoff_datetime"):
        yield "fct_trips", column, "not_null", "error", f"SELECT count(*) FROM fct WHERE {column} IS NULL"


def statements() -> dict[str, str]:
    return {
        # staging, derived columns, fact
        "stg_trips": _over("SELECT * FROM stg"),
        "trip_id": _over(
            "SELECT count(*) AS trips, count(DISTINCT (pickup_datetime, dropoff_datetime, "
            "pickup_location_id, dropoff_location_id, fare_amount)) AS distinct_ids, "
            "0::BIGINT AS missing_ids FROM fct"
        ),
        "trip_dates": _over(
            "SELECT pickup_datetime, pickup_datetime::DATE AS pickup_date, dropoff_datetime::DATE AS "
            "dropoff_date, hour(pickup_datetime) AS pickup_hour, hour(dropoff_datetime) AS dropoff_hour,"
            " dayofweek(pickup_datetime) + 1 AS pickup_day_of_week FROM stg"
        ),
        "trip_duration": _over(
            "SELECT pickup_datetime, dropoff_datetime, trip_duration_minutes FROM timed"
        ),
        "avg_speed_mph": _over(
            "SELECT pickup_datetime, trip_distance_miles, avg_speed_mph FROM timed"
        ),
        "tip_percentage": _over("SELECT pickup_datetime, fare_amount, tip_percentage FROM timed"),
        "quality_flag": _over(
            "SELECT has_data_quality_issue, trip_distance_miles <= 0 AS bad_distance, count(*) AS trips, "
            "sum(total_amount) AS total_amount FROM flagged GROUP BY 1, 2"
        ),
        "valid_trips": _over(
            "SELECT * FROM stg WHERE dropoff_datetime > pickup_datetime "
            "AND NOT (trip_distance_miles < 0 OR fare_amount < 0)"
        ),
        "fct_trips": _over(_FCT_OUT + "fct"),
        # dimensions
        "dim_vendor": _code_dim(
            "vendor_id", "vendor_name", fixed.VENDOR_DIM_LABELS, fixed.VENDOR_DIM_DEFAULT
        ),
        "dim_payment_type": _code_dim(
            "payment_type_id", "payment_type_name", fixed.PAYMENT_DIM_LABELS, fixed.PAYMENT_DIM_DEFAULT
        ),
        "dim_rate_code": _code_dim(
            "rate_code_id", "rate_code_name", fixed.RATE_CODE_LABELS, fixed.RATE_CODE_DEFAULT
        ),
        "dim_date": _over(_CALENDAR_OUT),
        "dim_date_stored": _over(
            "SELECT c.*, trips FROM (" + _CALENDAR_OUT.replace("min(pickup_date)", f"DATE '{fixed.CALENDAR_START}'").replace(
                "max(pickup_date)", f"DATE '{fixed.CALENDAR_END}'").replace(" FROM fct)", ")") + ") c LEFT JOIN "
            "(SELECT strftime(pickup_date, '%m-%d') AS day, count(*) AS trips FROM fct GROUP BY 1) t ON t.day = strftime(c.date_key, '%m-%d')"
        ),
        "dim_time": _over(_HOUR_OUT),
        "day_labels": _over(
            "SELECT pickup_date, strftime(pickup_date, '%A') AS day_name, "
            "if(strftime(pickup_date, '%w') IN ('0', '6'), 'Weekend', 'Weekday') AS day_type, "
            "count(*) AS trips FROM fct GROUP BY pickup_date"
        ),
        "distance_bucket": _over(
            "SELECT trip_distance_miles, CASE WHEN trip_distance_miles >= 20 THEN '20+ miles' "
            "WHEN trip_distance_miles >= 10 THEN '10-20 miles' WHEN trip_distance_miles >= 5 THEN "
            "'5-10 miles' WHEN trip_distance_miles >= 2 THEN '2-5 miles' WHEN trip_distance_miles >= 1 "
            "THEN '1-2 miles' ELSE '0-1 miles' END AS distance_bucket, count(*) AS trips "
            "FROM stg GROUP BY 1"
        ),
        # gold
        "daily_summary": _over("SELECT * FROM daily", _DAILY),
        "monthly_summary": _over("SELECT * EXCLUDE (year, month, day_of_week, pickup_date), pickup_date AS month_start FROM daily", _per("date_trunc('month', pickup_date)::DATE")),
        "yearly_summary": _over(
            "SELECT * EXCLUDE (year, month, day_of_week, pickup_date, median_distance_miles, median_duration_minutes, "
            "avg_distance_miles, avg_duration_minutes, avg_trip_revenue, avg_tip), year(pickup_date) AS year, "
            "round(avg_distance_miles, 6) AS avg_distance_miles, round(avg_duration_minutes, 6) AS avg_duration_minutes, "
            "round(avg_trip_revenue, 6) AS avg_trip_revenue, round(avg_tip, 6) AS avg_tip FROM daily",
            _per("date_trunc('year', pickup_date)::DATE")),
        "hourly_patterns": _over("SELECT * FROM hourly", _HOURLY),
        "monthly_trends": _over("SELECT * FROM monthly", _MONTHLY),
        "location_stats": _over("SELECT * FROM locations", _ZONES_GOLD),
        "payment_analysis": _over("SELECT * FROM payment", _PAYMENT),
        "trip_distance_distribution": _over("SELECT * FROM bands", _BANDS),
        "vendor_comparison": _over("SELECT * FROM vendor", _VENDOR),
        "year_over_year": _over("SELECT * FROM yoy", _YOY),
        # bronze lake
        "bronze_land": _with("SELECT * FROM raw", _RAW),
        "bronze_land_months": _with(
            "SELECT year(tpep_pickup_datetime) AS year, month(tpep_pickup_datetime) AS month, "
            "count(*) AS trips, sum(fare_amount) AS fares FROM raw GROUP BY 1, 2",
            _RAW,
        ),
        "bronze_scan": _with(
            "SELECT year(tpep_pickup_datetime) AS year, count(*) AS trips, "
            "sum(passenger_count)::BIGINT AS passengers, sum(Airport_fee) AS airport_fees "
            "FROM raw GROUP BY 1",
            _RAW,
        ),
        "bronze_validate": _with(
            "SELECT year(tpep_pickup_datetime) AS year, month(tpep_pickup_datetime) AS month, "
            "count(*) AS num_rows, 19::BIGINT AS num_columns FROM raw GROUP BY 1, 2",
            _RAW,
        ),
        "bronze_metrics": _with(
            "SELECT year(tpep_pickup_datetime) AS year, month(tpep_pickup_datetime) AS month, "
            "count(*) AS num_rows, 19::BIGINT AS num_columns, true AS has_size FROM raw GROUP BY 1, 2",
            _RAW,
        ),
        # stored tables
        "replace_table": _over("SELECT * FROM vendor WHERE vendor_name <> 'Unknown'", _VENDOR),
        "staging_view": _over(
            "SELECT payment_type_id, count(*) AS trips, sum(tip_amount) AS tips FROM stg GROUP BY 1"
        ),
        "partition_cluster": _over(
            f"SELECT *, date_trunc('month', pickup_date)::DATE AS pickup_month FROM ({_FCT_OUT} fct)"
        ),
        "incremental_filter": _over(
            "SELECT * FROM stg WHERE pickup_datetime >= "
            "(SELECT max(pickup_datetime) FROM fct WHERE year(pickup_date) < 2000)"
        ),
        "merge_trips": _over(
            "SELECT * REPLACE (tip_amount + if(pickup_date >= DATE '1999-07-01', 1, 0) AS tip_amount) "
            f"FROM ({_FCT_OUT} fct)"
        ),
        "stream_trips": _over(_FCT_OUT + "fct"),
        "stream_then_load": _over("SELECT * FROM daily", _DAILY),
        "load_after_crash": _over(_FCT_OUT + "fct"),
        "gold_rebuild": _over("SELECT * FROM daily WHERE year <> 1998", _DAILY),
        "csv_source": _over("SELECT * FROM train", _DAILY, _TRAIN_10),
        "json_records": _over(
            "SELECT '{\"pickup_location_id\":' || pickup_location_id || ',\"vendor_id\":' "
            "|| coalesce(vendor_id::VARCHAR, 'null') || ',\"trips\":' || count(*) || '}' AS record "
            "FROM fct GROUP BY pickup_location_id, vendor_id"
        ),
        "zone_source": _with(
            "SELECT location_id, zone, coalesce(borough, 'Unknown') AS borough FROM zones", _ZONES
        ),
        # exchange rates
        "fx_extract": _with("SELECT feed_date, 'EUR' AS base, quote, rate FROM rates", _FX),
        "fx_records": _with("SELECT 'EUR' AS base, quote, rate FROM rates", _FX),
        "fx_table": _with(
            "SELECT 'EUR' AS base_currency, quote AS quote_currency, max(if(quote < 'C12', rate * 2, rate)) AS rate, "
            "date_trunc('month', feed_date)::DATE AS run_date FROM rates GROUP BY ALL",
            _FX,
        ),
        "fx_upsert": _with(
            "SELECT if(late, 'USD', 'EUR') AS base_currency, quote AS quote_currency, "
            "if(late, rate * 2, rate) AS rate, feed_date AS run_date "
            "FROM (SELECT *, feed_date >= DATE '1998-01-01' AS late FROM rates)",
            _FX,
        ),
        # star join and zones
        "star_trips": _over(
            "SELECT CASE WHEN vendor_id = 1 THEN 'Creative Mobile Technologies, LLC' WHEN vendor_id = 2 "
            "THEN 'VeriFone Inc.' WHEN vendor_id IS NOT NULL THEN 'Unknown' END AS vendor_name, "
            "coalesce((['Credit card','Cash','No charge','Dispute','Unknown','Voided trip'])"
            "[if(payment_type_id BETWEEN 1 AND 6, payment_type_id, NULL)], 'Not specified') "
            "AS payment_type_name, if(rate_code_id IS NULL, NULL, coalesce((['Standard rate','JFK',"
            "'Newark','Nassau or Westchester','Negotiated fare','Group ride'])"
            "[if(rate_code_id BETWEEN 1 AND 6, rate_code_id, NULL)], 'Unknown')) AS rate_code_name, "
            "strftime(pickup_date, '%A') AS pickup_day_name, "
            "year(pickup_date + INTERVAL 6 MONTH) AS pickup_fiscal_year, "
            "strftime(pickup_date, '%w') IN ('0', '6') AS pickup_is_weekend, "
            "(['Night','Morning','Afternoon','Evening'])[pickup_hour // 6 + 1] AS time_period, "
            "pickup_hour IN (7, 8, 9, 17, 18, 19) AS is_rush_hour, "
            "CASE WHEN pickup_hour BETWEEN 6 AND 10 THEN 'Morning Peak' WHEN pickup_hour BETWEEN 11 AND 15 "
            "THEN 'Midday' WHEN pickup_hour BETWEEN 16 AND 20 THEN 'Evening Peak' ELSE 'Off-Peak' END "
            "AS peak_category, count(*) AS trips, sum(total_amount) AS total_amount "
            "FROM fct GROUP BY ALL"
        ),
        "zone_lookup": _over(
            "SELECT f.location_id, trips, coalesce(zone, 'Zone ' || f.location_id) AS zone_name, "
            "coalesce(borough, 'Unknown') AS borough FROM (SELECT pickup_location_id AS location_id, "
            "count(*) AS trips FROM fct GROUP BY 1) f LEFT JOIN zones z ON f.location_id = z.location_id",
            _ZONES,
        ),
        # data quality
        "dq_not_null": _over(
            "SELECT name AS column_name, (SELECT count(*) FROM stg) - known AS failures FROM "
            "(UNPIVOT (SELECT count(COLUMNS(*)) FROM stg) ON COLUMNS(*) INTO NAME name VALUE known)"
        ),
        "dq_unique": _over(
            " UNION ALL ".join(
                f"SELECT '{c}' AS column_name, count(*) AS failures FROM (SELECT {c} FROM stg "
                f"WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1)"
                for c in ("pickup_datetime", "pickup_location_id", "vendor_id")
            )
        ),
        "dq_report": _over(
            "SELECT t AS table_name, c AS column_name, k AS test_name, n AS failures, s AS severity, "
            "n <> 0 AND s = 'warn' AS should_warn, n <> 0 AND s = 'error' AS should_error, n = 0 AS passed FROM ("
            + " UNION ALL ".join(
                f"SELECT '{t}' AS t, '{c}' AS c, '{k}' AS k, '{severity}' AS s, ({failures}) AS n"
                for t, c, k, severity, failures in _declared_checks()
            )
            + ")"
        ),
        # read layer
        "last_valid_date": _over("SELECT * FROM last", _DAILY, _LAST),
        "last_valid_month": _over(
            "SELECT strftime(last_valid_date, '%Y-%m') AS last_valid_month FROM last", _DAILY, _LAST
        ),
        "kpi_summary": _over(
            "SELECT coalesce(sum(total_trips), 0)::BIGINT AS total_trips, "
            "coalesce(sum(total_revenue), 0) AS total_revenue, "
            "coalesce(sum(total_distance_miles), 0) AS total_distance, "
            "round(coalesce(avg(avg_trip_revenue), 0), 6) AS avg_fare, "
            "round(coalesce(avg(avg_tip), 0), 6) AS avg_tip, min(pickup_date) AS data_start_date, "
            "max(pickup_date) AS data_end_date, count(DISTINCT pickup_date) AS total_days FROM daily, last "
            "WHERE total_trips > 0 AND total_revenue > 0 AND coalesce(pickup_date <= last_valid_date, true)",
            _DAILY, _LAST,
        ),
        "monthly_trends_view": _over("SELECT * FROM monthly_read", _DAILY, _LAST, _MONTHLY, _MONTHLY_READ),
        "daily_view": _over("SELECT * FROM daily_read", _DAILY, _LAST, _DAILY_READ),
        "hourly_view": _over("SELECT * FROM hourly", _HOURLY),
        "payment_view": _over("SELECT * FROM payment_read", _DAILY, _LAST, _PAYMENT, _PAYMENT_READ),
        "distance_view": _over("SELECT * FROM bands", _BANDS),
        "location_view": _over(
            "SELECT * FROM locations ORDER BY popularity_rank, location_id LIMIT 300", _ZONES_GOLD
        ),
        "vendor_view": _over("SELECT * FROM vendor_read", _DAILY, _LAST, _VENDOR, _VENDOR_READ),
        "yoy_view": _over("SELECT * FROM yoy_read", _DAILY, _LAST, _YOY, _YOY_READ),
        # chart frames
        "heatmap_matrix": _over(
            "SELECT day_name, list_position(['Monday','Tuesday','Wednesday','Thursday','Friday',"
            "'Saturday','Sunday'], day_name)::BIGINT AS day_order, "
            + ", ".join(
                f"sum(total_trips) FILTER (pickup_hour = {h})::BIGINT AS h{h:02d}" for h in range(24)
            )
            + " FROM hourly GROUP BY day_name",
            _HOURLY,
        ),
        "payment_latest": _over(
            "SELECT * FROM payment_read WHERE year_month = (SELECT max(year_month) FROM payment_read)",
            _DAILY, _LAST, _PAYMENT, _PAYMENT_READ,
        ),
        "vendor_series": _over(
            "SELECT vendor_name, year_month, year, month, market_share_pct FROM vendor_read",
            _DAILY, _LAST, _VENDOR, _VENDOR_READ,
        ),
        "tip_last_12": _over(
            "SELECT payment_type_name, round(avg(avg_tip), 6) AS avg_tip, "
            "round(avg(tip_pct), 6) AS avg_tip_pct, sum(trip_count)::BIGINT AS trip_count "
            "FROM (SELECT *, dense_rank() OVER (ORDER BY year_month DESC) AS back FROM tip_read) "
            "WHERE back <= 12 GROUP BY 1",
            _DAILY, _LAST, _PAYMENT.replace("round(avg(tip_percentage), 6) AS avg_tip_pct",
                                             "avg(tip_percentage) AS tip_pct"),
            f"tip_read AS (SELECT * FROM payment WHERE {_UNTIL_MONTH})",
        ),
        "top_zones": _over(
            "SELECT location_id, pickup_trips, dropoff_trips, popularity_rank FROM locations "
            "ORDER BY popularity_rank, location_id LIMIT 20",
            _ZONES_GOLD,
        ),
        "zone_activity": _over(
            "SELECT l.*, coalesce(zone, 'Zone ' || l.location_id) AS zone_name, "
            "coalesce(borough, 'Unknown') AS borough FROM locations l LEFT JOIN zones USING (location_id)",
            _ZONES_GOLD, _ZONES,
        ),
        "monthly_series": _over(
            "SELECT year_month, total_trips, avg_fare FROM monthly_read",
            _DAILY, _LAST, _MONTHLY, _MONTHLY_READ,
        ),
        "daily_series": _over(
            "SELECT pickup_date, total_trips, total_revenue FROM daily_read", _DAILY, _LAST, _DAILY_READ
        ),
        "yoy_series": _over(
            "SELECT year, total_trips, total_revenue FROM yoy_read", _DAILY, _LAST, _YOY, _YOY_READ
        ),
        "compact_number": _over(
            f"SELECT year, {_compact('total_trips', 1)} AS trips, {_compact('total_revenue', 0)} AS revenue, "
            f"{_compact('avg_fare', 2)} AS avg_fare FROM yoy",
            _YOY,
        ),
        # daily series
        "training_frame": _over("SELECT * FROM train", _DAILY, _TRAIN_2),
        "time_features": _over(
            "SELECT ds, y, year, month, day(ds) AS day, isodow - 1 AS dayofweek, dayofyear(ds) AS dayofyear, "
            "weekofyear(ds) AS weekofyear, quarter(ds) AS quarter, (isodow > 5)::BIGINT AS is_weekend, "
            "(day(ds) = 1)::BIGINT AS is_month_start, (day(ds + INTERVAL 1 DAY) = 1)::BIGINT AS is_month_end,"
            " round(sin(2 * pi() * month / 12), 6) + 0 AS month_sin, "
            "round(cos(2 * pi() * month / 12), 6) + 0 AS month_cos, "
            "round(sin(2 * pi() * (isodow - 1) / 7), 6) + 0 AS day_sin, "
            "round(cos(2 * pi() * (isodow - 1) / 7), 6) + 0 AS day_cos "
            "FROM (SELECT ds, y, year, month, isodow(ds) AS isodow FROM train)",
            _DAILY, _TRAIN_10,
        ),
        "holdout_split": _over(
            "SELECT ds, y, ds IN (SELECT ds FROM train ORDER BY ds DESC LIMIT 30) AS is_validation FROM train",
            _DAILY, _TRAIN_2,
        ),
        "future_dates": _over(
            "SELECT (m + n::INT) AS ds FROM (SELECT max(ds) AS m FROM train), range(1, 31) AS r(n)",
            _DAILY, _TRAIN_2,
        ),
        "validation_frame": _over("SELECT * FROM validated", _DAILY, _TRAIN_10, _VALIDATED),
        "forecast_metrics": _over(
            "SELECT round(avg(abs(y_true - y_pred)), 6) AS mae, "
            "round(sqrt(avg((y_true - y_pred) ** 2)), 6) AS rmse, round(avg(abs(y_true - y_pred) / "
            "greatest(abs(y_true), 2.220446049250313e-16)) * 100, 6) AS mape FROM validated",
            _DAILY, _TRAIN_10, _VALIDATED,
        ),
        "log_run": _over(
            "SELECT '0123456789abcdef' AS run_id, 'last_week_total_trips_trained_until_' || "
            "strftime(max(ds), '%Y%m%d') AS run_name, 'FINISHED' AS status, 'last_week' AS model_type, "
            "'total_trips' AS target_metric, count(*)::VARCHAR AS forecast_horizon, "
            "round(avg(abs(y_true - y_pred)), 6) AS mae, round(sqrt(avg((y_true - y_pred) ** 2)), 6) AS rmse, "
            "round(avg(abs(y_true - y_pred) / greatest(abs(y_true), 2.220446049250313e-16)) * 100, 6) AS mape "
            "FROM validated",
            _DAILY, _TRAIN_10, _VALIDATED,
        ),
        "accuracy_points": _over(
            "SELECT y_true, y_pred, (SELECT min(least(y_true, y_pred)) FROM validated) AS diagonal_min, "
            "(SELECT max(greatest(y_true, y_pred)) FROM validated) AS diagonal_max FROM validated",
            _DAILY, _TRAIN_10, _VALIDATED,
        ),
        "future_frame": _over(
            "SELECT ds AS date, forecast FROM week WHERE forecast IS NOT NULL", _DAILY, _TRAIN_10, _VALIDATED
        ),
        "future_summary": _over(
            "SELECT min(ds) AS forecast_start, max(ds) AS forecast_end, min(forecast) AS min_forecast, "
            "max(forecast) AS max_forecast, round(avg(forecast), 6) AS mean_forecast "
            "FROM week WHERE forecast IS NOT NULL",
            _DAILY, _TRAIN_10, _VALIDATED,
        ),
        "forecast_band": _over(
            "SELECT ds AS date, forecast, round(forecast * 0.85::DOUBLE, 6) AS lower, "
            "round(forecast * 1.15::DOUBLE, 6) AS upper FROM week WHERE forecast IS NOT NULL",
            _DAILY, _TRAIN_10, _VALIDATED,
        ),
        "fill_days": _over(
            "SELECT zone, (last_day - first_day + 1)::BIGINT AS days, trips::DOUBLE AS trips, "
            "last_day - first_day + 1 - busy AS empty_days FROM (SELECT pickup_location_id AS zone, "
            "min(pickup_date) AS first_day, count(*) AS trips, count(DISTINCT pickup_date) AS busy "
            "FROM fct GROUP BY 1), (SELECT max(pickup_date) AS last_day FROM fct)"
        ),
        "forecast_job": _over(
            "(SELECT 'history' AS kind, pickup_date AS date, total_trips::DOUBLE AS value, NULL::BOOLEAN AS has_forecast "
            "FROM daily_read_all ORDER BY pickup_date DESC LIMIT 90) UNION ALL "
            "(SELECT 'validation', ds, y, true FROM train ORDER BY ds DESC LIMIT 30) UNION ALL "
            "(SELECT 'forecast', m + n::INT, NULL, true FROM (SELECT max(ds) AS m FROM train), range(1, 31) AS r(n))",
            _DAILY, _TRAIN_2,
            f"daily_read_all AS (SELECT * FROM daily WHERE total_trips > {MIN_TRIPS} AND total_revenue > 0 "
            "AND avg_trip_revenue BETWEEN 5 AND 200)",
        ),
        # run table
        "recent_runs": _with("SELECT * FROM runs ORDER BY start_time DESC, run_id LIMIT 20", _RUNS),
        "best_run": _with(
            "SELECT run_id, run_name, model_type, target_metric, mae, rmse, mape FROM runs "
            "WHERE target_metric = 'total_revenue' ORDER BY mape NULLS LAST, start_time DESC, run_id LIMIT 1",
            _RUNS,
        ),
        "model_comparison": _with(
            "SELECT model_type, target_metric, mae, rmse, mape, run_id, start_time FROM runs "
            "WHERE status = 'FINISHED' ORDER BY start_time DESC, run_id LIMIT 100",
            _RUNS,
        ),
        "mape_grade": _with(f"SELECT {_GRADE} AS grade, count(*) AS runs FROM runs GROUP BY 1", _RUNS),
        "best_per_model": _with(
            "SELECT model_type, target_metric, mae, rmse, mape, run_id, start_time FROM runs "
            "QUALIFY row_number() OVER (PARTITION BY model_type, target_metric "
            "ORDER BY mape NULLS LAST, start_time DESC, run_id) = 1",
            _RUNS,
        ),
        "best_per_model_overall": _with(
            "SELECT model_type, target_metric, mae, rmse, mape, run_id, start_time FROM runs "
            "WHERE status = 'FINISHED' QUALIFY row_number() OVER (PARTITION BY model_type "
            "ORDER BY mape NULLS LAST, start_time DESC, run_id) = 1",
            _RUNS,
        ),
        "graded_runs": _with(f"SELECT *, {_GRADE} AS grade FROM runs", _RUNS),
        "runs_history": _with("SELECT model_type, start_time, mape, run_id FROM runs", _RUNS),
        "forecast_with_history": _over(
            "SELECT 'history' AS kind, pickup_date AS date, total_trips::DOUBLE AS value, "
            "NULL::DOUBLE AS predicted FROM (FROM daily_read ORDER BY pickup_date DESC LIMIT 90) "
            "UNION ALL SELECT 'validation', l_shipdate::DATE, l_quantity, l_quantity + 2 FROM best_lines "
            "UNION ALL SELECT 'forecast', l_shipdate::DATE + 30, NULL, l_quantity + 2 FROM best_lines",
            _DAILY, _LAST, _DAILY_READ, _RUNS,
            "best_lines AS (SELECT * FROM lineitem WHERE 'run-' || lpad(l_orderkey::VARCHAR, 12, '0') = "
            "(SELECT run_id FROM runs WHERE target_metric = 'total_trips' "
            "ORDER BY mape NULLS LAST, start_time DESC, run_id LIMIT 1))",
        ),
    }
