"""Column expressions that derive a trip's measures from its staged columns."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column
from pyspark.sql import functions as F

from farelake.functions import fixed

KEY_COLUMNS = (
    "pickup_datetime",
    "dropoff_datetime",
    "pickup_location_id",
    "dropoff_location_id",
    "fare_amount",
)


def trip_id() -> Column:
    """64-bit identity of a trip.

    Hashing the typed columns directly avoids building a string per row, and fields cannot run
    into one another as they can in an unseparated concatenation. `xxhash64` skips NULLs, so a trip
    with an unknown key field is guarded: it has no identity and never matches another.
    """
    known = reduce(and_, (F.col(name).isNotNull() for name in KEY_COLUMNS))
    return F.when(known, F.xxhash64(*KEY_COLUMNS))


def duration_minutes() -> Column:
    """Complete minutes between the ends, truncated toward zero (59 seconds are 0 minutes).

    The difference of two zone-less times is an interval, so the session's zone plays no part; dividing it
    is integer arithmetic, where `timestampdiff` builds date-time objects for every row.
    """
    return F.expr("(dropoff_datetime - pickup_datetime) div INTERVAL '1' MINUTE")


def speed_mph(minutes: Column | None = None) -> Column:
    minutes = duration_minutes() if minutes is None else minutes
    return F.try_divide(F.col("trip_distance_miles"), minutes / F.lit(60.0))


def tip_percentage() -> Column:
    return F.try_divide(F.col("tip_amount"), F.col("fare_amount")) * F.lit(100.0)


def quality_issue(minutes: Column | None = None, speed: Column | None = None) -> Column:
    """TRUE if any plausibility rule is broken. A rule over an unknown value is not broken.

    Two rules can never fire on rows that passed `is_valid_trip`; they matter on unfiltered rows.
    """
    minutes = duration_minutes() if minutes is None else minutes
    speed = speed_mph(minutes) if speed is None else speed
    rules = (
        F.col("trip_distance_miles") <= 0,
        minutes <= 0,
        F.col("fare_amount") < 0,
        F.col("total_amount") < 0,
        ~F.col("passenger_count").between(1, fixed.MAX_PASSENGERS),
        speed > fixed.MAX_SPEED_MPH,
        F.col("pickup_datetime") > F.col("dropoff_datetime"),
    )
    return reduce(lambda broken, rule: broken | F.coalesce(rule, F.lit(False)), rules, F.lit(False))


def is_valid_trip() -> Column:
    """Rows the fact table admits: known times in order, no negative distance or fare.

    Comparisons with NULL are NULL, which a filter drops, so unknown values are rejected as well.
    """
    return (
        F.col("pickup_datetime").isNotNull()
        & F.col("dropoff_datetime").isNotNull()
        & (F.col("pickup_datetime") < F.col("dropoff_datetime"))
        & (F.col("trip_distance_miles") >= 0)
        & (F.col("fare_amount") >= 0)
    )
