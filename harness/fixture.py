"""Raw trips for tests, the bench and the registered queries: one deterministic view over `lineitem`.

The text below runs unchanged in Spark SQL and DuckDB. Money is in quarters and distance in 64ths, so
sums are exact in doubles whatever the order of addition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

RAW_TRIPS_SQL = """
SELECT
  nullif(h % 5, 0)                                             AS VendorID,
  pu                                                           AS tpep_pickup_datetime,
  pu + dur * INTERVAL '1' SECOND                               AS tpep_dropoff_datetime,
  CASE WHEN h % 23 = 0 THEN NULL ELSE h % 11 END               AS passenger_count,
  CASE WHEN h % 29 = 0 THEN CAST(0 AS DOUBLE)
       WHEN h % 31 = 0 THEN CAST(-1 AS DOUBLE)
       ELSE q * q / 64 END                                     AS trip_distance,
  CAST(l_partkey % 263 + 1 AS BIGINT)                          AS PULocationID,
  CAST((l_suppkey * 7) % 263 + 1 AS BIGINT)                    AS DOLocationID,
  nullif(h % 8, 0)                                             AS RatecodeID,
  CASE WHEN l_linestatus = 'O' THEN 'Y' ELSE 'N' END           AS store_and_fwd_flag,
  h % 8                                                        AS payment_type,
  f                                                            AS fare_amount,
  CAST(0.5 AS DOUBLE)                                          AS extra,
  CAST(0.5 AS DOUBLE)                                          AS mta_tax,
  tip                                                          AS tip_amount,
  toll                                                         AS tolls_amount,
  CAST(1 AS DOUBLE)                                            AS improvement_surcharge,
  CAST(CASE WHEN h % 43 = 0 THEN -1 ELSE 1 END AS DOUBLE)
    * (f + CAST(4.5 AS DOUBLE) + tip + toll)                   AS total_amount,
  CAST(2.5 AS DOUBLE)                                          AS congestion_surcharge,
  CASE WHEN h % 9 = 0 THEN CAST(1.75 AS DOUBLE) END            AS Airport_fee
FROM (
  SELECT *,
    l_shipdate + ((h * 17) % 1440 * 60 + h % 60) * INTERVAL '1' SECOND AS pu,
    CASE WHEN h % 37 = 0 THEN CAST(-5 AS DOUBLE)
         WHEN h % 41 = 0 THEN CAST(0 AS DOUBLE)
         ELSE q / 2 + CAST(2.5 AS DOUBLE) END                  AS f,
    CAST(h % 20 AS DOUBLE) / 4                                 AS tip,
    CASE WHEN h % 10 = 0 THEN CAST(6.5 AS DOUBLE)
         ELSE CAST(0 AS DOUBLE) END                            AS toll
  FROM (
    SELECT l_partkey, l_suppkey, l_linestatus, l_shipdate, l_quantity AS q,
      l_orderkey * 7 + l_partkey * 13 + l_linenumber * 101     AS h,
      (l_partkey * 31 + CAST(l_quantity AS BIGINT) * 60) % 5400 - 120 AS dur
    FROM {lineitem}
  ) a
) b
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(RAW_TRIPS_SQL, lineitem=table(spark, sf_dir, "lineitem"))
