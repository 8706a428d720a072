"""Declared data-quality checks and their report."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: table -> (column, test, severity): the checks run after every load.
DECLARED_CHECKS: Mapping[str, Sequence[tuple[str, str, str]]] = {
    "dim_vendor": (("vendor_id", "unique", "error"), ("vendor_id", "not_null", "error")),
    "dim_payment_type": (("payment_type_id", "unique", "error"), ("payment_type_id", "not_null", "error")),
    "dim_rate_code": (("rate_code_id", "unique", "error"), ("rate_code_id", "not_null", "error")),
    "dim_date": (("date_key", "unique", "error"), ("date_key", "not_null", "error")),
    "dim_time": (("hour_key", "unique", "error"), ("hour_key", "not_null", "error")),
    "fct_trips": (
        ("trip_id", "unique", "warn"),
        ("trip_id", "not_null", "error"),
        ("pickup_datetime", "not_null", "error"),
        ("dropoff_datetime", "not_null", "error"),
    ),
}


def dq_not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, failures) for every column, from one pass over the table."""
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    rows = F.array(
        *[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("failures")) for c in columns]
    )
    return counted.select(F.inline(rows))


def duplicated_values(df: DataFrame, column: str) -> DataFrame:
    """Known values held by more than one row. Counts combine on the map side, so a hot value is cheap."""
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n_records"))
        .filter(F.col("n_records") > 1)
    )


def dq_unique(df: DataFrame, column: str) -> DataFrame:
    """(column_name, failures): how many known values occur more than once."""
    return duplicated_values(df, column).agg(
        F.lit(column).alias("column_name"), F.count(F.lit(1)).alias("failures")
    )


def _severity(checks: Sequence[tuple[str, str, str]], test: str) -> Column:
    chain = F
    for column, name, severity in checks:
        if name == test:
            chain = chain.when(F.col("column_name") == column, F.lit(severity))
    return chain.otherwise(F.lit("error"))


def table_report(table: str, df: DataFrame, checks: Sequence[tuple[str, str, str]]) -> list[DataFrame]:
    """The results of a table's checks, a frame for each kind of test and unique column."""
    not_null = [column for column, test, _ in checks if test == "not_null"]
    parts = [("not_null", dq_not_null(df, not_null))] if not_null else []
    parts += [("unique", dq_unique(df, column)) for column, test, _ in checks if test == "unique"]
    return [
        part.select(
            F.lit(table).alias("table_name"),
            "column_name",
            F.lit(test).alias("test_name"),
            "failures",
            _severity(checks, test).alias("severity"),
        )
        for test, part in parts
    ]


def checks_by(df: DataFrame, part: str, checks: Sequence[tuple[str, str, str]]) -> DataFrame:
    """(part, column_name, test_name, failures) of each part of a table.

    The table's results are the sums, provided that equal values of a unique column lie in one part. A value's part is
    known from any of its rows, so the count by value shuffles no more than without parts.
    """
    not_null = [column for column, test, _ in checks if test == "not_null"]
    unique = [column for column, test, _ in checks if test == "unique"]
    nulls = df.groupBy(part).agg(*(F.count_if(F.col(c).isNull()).alias(c) for c in not_null))
    found = nulls.select(part, F.inline(F.array(
        *(F.struct(F.lit(c).alias("column_name"), F.lit("not_null").alias("test_name"), F.col(c).alias("failures")) for c in not_null))))
    for column in unique:
        copies = df.filter(F.col(column).isNotNull()).groupBy(part, column).agg(F.count(F.lit(1)).alias("n"))
        found = found.unionByName(copies.filter("n > 1").groupBy(part).agg(F.count(F.lit(1)).alias("failures")).select(
            part, F.lit(column).alias("column_name"), F.lit("unique").alias("test_name"), "failures"))
    return found


def added_up(table: str, found: DataFrame, checks: Sequence[tuple[str, str, str]]) -> DataFrame:
    """The results of a table's checks from those of its parts; a check that no part has a row for has no failures."""
    known = F.array(*(
        F.struct(F.lit(c).alias("column_name"), F.lit(t).alias("test_name"), F.lit(s).alias("severity")) for c, t, s in checks))
    declared = found.sparkSession.range(1).select(F.lit(table).alias("table_name"), F.inline(known))
    sums = found.groupBy("column_name", "test_name").agg(F.sum("failures").alias("failures"))
    return declared.join(F.broadcast(sums), ["column_name", "test_name"], "left").select(  # a row per check
        "table_name", "column_name", "test_name", F.coalesce("failures", F.lit(0).cast("bigint")).alias("failures"), "severity")


def judged(parts: Sequence[DataFrame]) -> DataFrame:
    """The report: whether each check's failures warn, fail or pass."""
    failed = F.col("failures") != 0
    return reduce(DataFrame.unionByName, parts).withColumns(
        {
            "should_warn": failed & (F.col("severity") == "warn"),
            "should_error": failed & (F.col("severity") == "error"),
            "passed": ~failed,
        }
    )


def dq_report(
    tables: Mapping[str, DataFrame],
    checks: Mapping[str, Sequence[tuple[str, str, str]]] = DECLARED_CHECKS,
) -> DataFrame:
    """One row per check of the given tables: failures, and whether they warn, fail or pass."""
    return judged([part for table, df in tables.items() for part in table_report(table, df, checks.get(table, ()))])


def require_passing(report: DataFrame) -> DataFrame:
    """Raise if a check of severity `error` failed; returns the report otherwise."""
    failed = report.filter("should_error").select("table_name", "column_name", "test_name", "failures").collect()
    if failed:
        detail = "; ".join(f"{r.test_name}({r.table_name}.{r.column_name}): {r.failures}" for r in failed)
        raise ValueError(f"data-quality checks failed: {detail}")
    return report
