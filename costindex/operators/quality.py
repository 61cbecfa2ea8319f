"""Data tests as violation queries (a test passes when it returns no rows)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def not_accepted(column: str, values: Sequence[str]) -> Column:
    """True where the value is outside ``values`` (a null value is not a violation, as in SQL)."""
    return ~F.col(column).isin(list(values))


def not_positive(column: str) -> Column:
    return F.col(column) <= 0


def out_of_range(column: str, low: float, high: float) -> Column:
    return (F.col(column) < low) | (F.col(column) > high)


def any_null(columns: Sequence[str]) -> Column:
    return reduce(or_, [F.col(c).isNull() for c in columns])


def accepted_values(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    return df.where(not_accepted(column, values))


def positive(df: DataFrame, column: str) -> DataFrame:
    return df.where(not_positive(column))


def outside_range(df: DataFrame, column: str, low: float, high: float) -> DataFrame:
    return df.where(out_of_range(column, low, high))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count (partial aggregate, skew-safe)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def nulls_in(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.where(any_null(columns))


def summary(name: str, df: DataFrame, violation: Column) -> DataFrame:
    """One row: test_name, rows_checked, failures -- both counts in one pass over ``df``."""
    return df.agg(F.count(F.lit(1)).alias("rows_checked"), F.count_if(violation).alias("failures")) \
        .select(F.lit(name).alias("test_name"), "rows_checked", "failures")


def summaries(df: DataFrame, violations: Mapping[str, Column]) -> DataFrame:
    """``summary`` of several tests, one row each, in one pass over ``df``."""
    counts = df.agg(F.count(F.lit(1)).alias("rows_checked"), *[F.count_if(v).alias(f"f{k}") for k, v in enumerate(violations.values())])
    rows = F.array(*[F.struct(F.lit(name).alias("test_name"), "rows_checked", F.col(f"f{k}").alias("failures"))
                     for k, name in enumerate(violations)])
    return counts.select(F.inline(rows))


def unique_summary(name: str, df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows checked and keys that occur more than once, in one aggregation by key."""
    n = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return n.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows_checked"), F.count_if(F.col("n") > 1).alias("failures")) \
        .select(F.lit(name).alias("test_name"), "rows_checked", "failures")
