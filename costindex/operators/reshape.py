"""Reshape operators: unpivot (dropping nulls), melt of numeric columns, pivot."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from costindex.functions import number_or_null

_FLOAT_TYPES = (T.DoubleType, T.FloatType)


def unpivot_non_null(df: DataFrame, ids: Sequence[str], columns: Sequence[str],
                     name_col: str, value_col: str) -> DataFrame:
    """Wide -> long: one row per (ids, column) with a non-null value.

    SQL ``UNPIVOT`` drops null values; ``DataFrame.unpivot`` keeps them, so
    they are filtered here.  Runs as an Expand in the scan stage: no shuffle.
    """
    long = df.unpivot(list(ids), list(columns), name_col, value_col)
    return long.where(F.col(value_col).isNotNull())


def numeric_value_columns(df: DataFrame, exclude: Sequence[str]) -> list[str]:
    """Float columns not in ``exclude``; when there are none, every other column."""
    cols = [f.name for f in df.schema.fields
            if f.name not in exclude and isinstance(f.dataType, _FLOAT_TYPES)]
    if not cols:
        cols = [c for c in df.columns if c not in exclude]
    return cols


def melt_levels(df: DataFrame, id_col: str, exclude: Sequence[str], name_col: str,
                value_col: str, carry: Sequence[str] = ()) -> DataFrame:
    """Melt the numeric columns of a wide frame to (id, carry, name, value).

    Nulls, NaN and text that is no number are dropped.
    """
    ids = [id_col, *carry]
    cols = numeric_value_columns(df, list(exclude) + ids)
    src = df.select(*ids, *[number_or_null(c).alias(c) for c in cols])
    return unpivot_non_null(src, ids, cols, name_col, value_col)


def pivot_mean(df: DataFrame, row_key: str, column_key: str, value: str,
               values: Sequence[str] | None = None) -> DataFrame:
    """One row per ``row_key``, one column per ``column_key`` value holding mean(value).

    Pass ``values`` when the column set is known; otherwise Spark finds the
    distinct column keys first (bounded by the number of labels).
    """
    g = df.groupBy(row_key)
    p = g.pivot(column_key, list(values)) if values is not None else g.pivot(column_key)
    return p.agg(F.avg(value))
