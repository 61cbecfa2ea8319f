"""Slowly changing dimension, type 2: versioned rows per entity, read as of a period."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from costindex.operators.fold import deadband_fold
from costindex.operators.joins import broadcast_if_small

DIM_SCHEMA = T.StructType([
    T.StructField("geography", T.StringType(), False),
    T.StructField("geography_type", T.StringType(), False),
    T.StructField("income_mean", T.DoubleType()),
    T.StructField("income_median", T.DoubleType()),
    T.StructField("survey_year", T.IntegerType(), False),
    T.StructField("valid_from", T.DateType(), False),
    T.StructField("valid_to", T.DateType()),
    T.StructField("is_current", T.BooleanType(), False),
    T.StructField("version", T.IntegerType(), False),
])


def resolve_column(columns: Sequence[str], *parts: str) -> str | None:
    """First column whose lower-cased name contains any of ``parts`` (driver-side, schema only)."""
    for c in columns:
        if any(p in c.lower() for p in parts):
            return c
    return None


def survey_rows(raw: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """Normalise a survey table to (geography, survey_year, income_median, income_mean) and the carried columns.

    Columns are found by name: geography contains 'state', period 'year' or
    'date' (its first four characters are the year), median 'median',
    mean 'mean' (optional).
    """
    cols = [c for c in raw.columns if c not in carry]
    geo = resolve_column(cols, "state")
    period = resolve_column(cols, "year", "date")
    med = resolve_column(cols, "median")
    mean = resolve_column(cols, "mean")
    if not (geo and period and med):
        raise ValueError(f"survey table lacks state/year/median columns: {cols}")
    return raw.select(
        F.col(geo).cast("string").alias("geography"),
        F.substring(F.col(period).cast("string"), 1, 4).cast("int").alias("survey_year"),
        F.col(med).cast("double").alias("income_median"),
        (F.col(mean).cast("double") if mean else F.lit(None).cast("double")).alias("income_mean"), *carry,
    )


def empty_dim(spark) -> DataFrame:
    return spark.createDataFrame([], DIM_SCHEMA)


def scd2_apply(survey: DataFrame, dim: DataFrame, run_date: Column, tolerance: float = 1.0,
               geography_type: str = "state", keep=None,
               heal_nulls: bool = False, order_by: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Apply one survey batch to the dimension; returns (new dimension, change rows).

    Per geography, in survey-year order (rows of one year in the order of
    ``order_by``, else by value): the first row ever is inserted; a
    row older than the current version is ignored; a row whose median
    differs from the current median by more than ``tolerance`` (a null new
    median counts as 0) expires the current version and becomes current.
    A current version with a null median is never replaced, unless
    ``heal_nulls`` (then the next non-null median replaces it).
    Change rows: geography, old_value, new_value, change_type, _seq.
    ``keep(name, df)`` may store the fold's output once, so the new versions
    and the change rows are both read from it instead of folding twice.
    """
    rows = survey_rows(survey, order_by)
    cur = dim.where(F.col("is_current")).select(
        "geography", F.lit(True).alias("_ip"), F.col("income_median").alias("_iv"),
        F.col("survey_year").alias("_iy"), F.col("version").alias("_iver"))
    seeded = rows.join(broadcast_if_small(cur, verify_rows=True), "geography", "left").where(
        F.col("_iy").isNull() | (F.col("survey_year") >= F.col("_iy")))
    ev = deadband_fold(seeded, ["geography"], ["survey_year", *order_by], "income_median", tolerance,
                       carry=["income_mean", "_iver"], null_state_blocks=not heal_nulls,
                       null_value_as_zero=True, init_present="_ip", init_value="_iv")
    if keep is not None:
        ev = keep("income_fold", ev)
    ev = ev.withColumn("_base", F.coalesce(F.col("_iver"), F.lit(0)))
    last = ev.groupBy("geography").agg(F.max("_seq").alias("_last"))
    ev = ev.join(broadcast_if_small(last), "geography")
    rd = run_date.cast("date")
    new_versions = ev.select(
        "geography", F.lit(geography_type).alias("geography_type"), "income_mean",
        F.col("new_value").alias("income_median"), "survey_year",
        rd.alias("valid_from"),
        F.when(F.col("_seq") < F.col("_last"), rd).alias("valid_to"),
        (F.col("_seq") == F.col("_last")).alias("is_current"),
        (F.col("_base") + F.col("_seq")).cast("int").alias("version"))
    superseded = ev.where(F.col("change_type") == "UPDATE").select("geography").distinct() \
        .withColumn("_sup", F.lit(True))
    kept = dim.join(broadcast_if_small(superseded), "geography", "left").select(
        "geography", "geography_type", "income_mean", "income_median", "survey_year",
        "valid_from",
        F.when(F.col("is_current") & F.col("_sup").isNotNull(), rd)
         .otherwise(F.col("valid_to")).alias("valid_to"),
        (F.col("is_current") & F.col("_sup").isNull()).alias("is_current"),
        "version")
    changes = ev.select("geography", "old_value", "new_value", "change_type", "_seq")
    return kept.unionByName(new_versions), changes


def as_of(dim: DataFrame, year: int | Column) -> DataFrame:
    """Each geography's version in force for survey ``year`` (latest survey_year <= year)."""
    y = year if isinstance(year, Column) else F.lit(int(year))
    eligible = dim.where(F.col("survey_year") <= y)
    order = F.struct(F.col("survey_year"), F.col("version"))
    return eligible.groupBy("geography").agg(
        F.max_by(F.struct("income_median", "income_mean", "survey_year", "version"), order)
        .alias("_v")).select(
        "geography", F.col("_v.income_median").alias("income_median"),
        F.col("_v.income_mean").alias("income_mean"),
        F.col("_v.survey_year").alias("survey_year"))


def as_of_join(rows: DataFrame, dim: DataFrame, geography: str, year: str) -> DataFrame:
    """``rows`` with the version in force for each row's geography and year: income_median, income_mean, survey_year.

    Versions become intervals of years (a later version of the same year hides
    the earlier one), and an interval becomes one entry per year, no further
    than the years that ``rows`` have.  What is joined is then an equality on
    (geography, year) against a table of at most geographies x years, so rows
    of one geography stay spread and no window runs over them.  Rows without a
    version in force get nulls.
    """
    span = rows.agg(F.min(F.col(year).cast("int")).alias("_lo"), F.max(F.col(year).cast("int")).alias("_hi"))
    after = F.lead("survey_year").over(Window.partitionBy("geography").orderBy("survey_year", "version"))
    first = F.greatest("survey_year", "_lo")
    last = F.least(F.coalesce(F.col("_next") - 1, F.col("_hi")), F.col("_hi"))
    entries = (dim.withColumn("_next", after).crossJoin(F.broadcast(span))  # one row
               .where(first <= last)
               .select(F.col("geography").alias("_g"), F.explode(F.sequence(first, last)).alias("_y"),
                       "income_median", "income_mean", "survey_year"))
    match = (rows[geography] == entries["_g"]) & (rows[year].cast("int") == entries["_y"])
    return rows.join(broadcast_if_small(entries), match, "left").drop("_g", "_y")
