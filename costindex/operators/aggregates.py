"""Grouped statistics that stay skew-safe.

Every measure here is a partial (map-side combined) aggregate, is computed from
a pre-aggregated, de-duplicated frame, or is ranked in a sort of groups whose
counted rows fit a task, so a group that holds a large share of all rows never
has its rows gathered in one task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from costindex.operators.keys import null_safe_join
from costindex.operators.quantiles import exact_quantiles, pick_ranks, picked_quantiles
from costindex.session import stage_table

# A group of more rows is spread over tasks by its values and codes.
GROUP_ROWS = 1_000_000


def distinct_counts(df: DataFrame, keys: Sequence[str], columns: Mapping[str, str]) -> DataFrame:
    """``count(distinct col)`` per group for several columns, without Expand.

    Several distinct counts in one aggregate make Spark replicate every row
    once per distinct column.  Here each column is de-duplicated on
    (keys, col) -- a partial aggregate whose shuffle is spread by ``col`` --
    then counted per group, and the results are joined on the group key.
    """
    keys = list(keys)
    out = None
    for name, col in columns.items():
        d = (df.select(*keys, col).where(F.col(col).isNotNull()).distinct()
             .groupBy(*keys).agg(F.count(F.lit(1)).alias(name)))
        out = d if out is None else null_safe_join(out, d, keys, "full")
    return out


def group_number(keys: Sequence[str]) -> list[Column]:
    """Two 64-bit hashes that stand for a group's keys (two of 10^9 groups meet in both with a chance below 10^-20).

    Which keys are null is hashed too, as a hash of a row skips its nulls.
    """
    nulls = F.concat(*[F.col(k).isNull().cast("int").cast("string") for k in keys])
    return [F.xxhash64(*keys, nulls).alias("_g1"), F.xxhash64(F.lit("group"), nulls, *reversed(keys)).alias("_g2")]


def _sorted_measures(rows: DataFrame, number: list[str], quantiles: Mapping[str, float], codes: Mapping[str, str]) -> DataFrame:
    """Quantiles of ``_x`` and distinct counts of groups that each fit a task: one shuffle of the rows, a sort a measure."""
    whole = Window.partitionBy(*number)
    found = []
    if quantiles:
        w = whole.orderBy(F.col("_x").asc_nulls_last())
        rows = rows.withColumns({
            "_n": F.count("_x").over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)),
            "_hi_rank": F.row_number().over(w)})
        hi_rank = F.when(F.col("_x").isNotNull(), F.col("_hi_rank"))
        # as among grouped values, the two zeros are one
        rows = rows.withColumn("_x", F.when(F.col("_x") == 0, F.lit(0.0)).otherwise(F.col("_x")))
        found += [F.first("_n").alias("_n"), *pick_ranks(quantiles, "_x", hi_rank - 1, hi_rank)]
    for name, code in codes.items():
        rows = rows.withColumn(code, F.when(F.col(code).isNotNull(), F.dense_rank().over(whole.orderBy(F.col(code).asc_nulls_last()))))
        found.append(F.max(code).cast("long").alias(name))
    return rows.groupBy(*number).agg(*found).select(*number, *codes, *picked_quantiles(quantiles))


def _spread_measures(rows: DataFrame, number: list[str], quantiles: Mapping[str, float], codes: Mapping[str, str]) -> DataFrame:
    """The same of groups of any size: value counts and pairs, shuffled by value and code."""
    out = rows.select(*number).distinct()
    for name, code in codes.items():
        out = out.join(distinct_counts(rows, number, {name: code}), number, "left")
    if quantiles:
        out = out.join(exact_quantiles(rows, number, "_x", quantiles), number, "left")
    return out.select(*number, *codes, *quantiles)


def group_profile(df: DataFrame, keys: Sequence[str], value: str,
                  quantiles: Mapping[str, float] | None = None,
                  distinct: Mapping[str, str] | None = None,
                  count_name: str = "n", mean_name: str = "mean",
                  min_name: str = "min", max_name: str = "max",
                  stddev_name: str = "stddev", cut_lineage: bool = True,
                  max_group_rows: int = GROUP_ROWS) -> DataFrame:
    """count / mean / min / max / sample stddev, exact quantiles, distinct counts per group.

    The input is read ONCE, whatever the number of measures: the columns that
    are needed are stored as a narrow table (with ``cut_lineage``; the session's
    shared checkpoint folder), and no row is multiplied.  The moments are a
    map-side combined aggregate per group (accumulated in scan order like a plain
    aggregate).  For quantiles and distinct counts the rows are shuffled once, by
    group, and sorted there once a measure.  Groups of more than ``max_group_rows``
    rows are found when the plan runs and spread over many reducers instead: value
    counts per (group, value) for the quantiles, and (group, code) pairs for each
    distinct count.  Beside the moments, groups go by the two numbers of
    ``group_number``, which are cheaper to hash and to shuffle than text keys.
    """
    keys, number = list(keys), ["_g1", "_g2"]
    distinct, quantiles = dict(distinct or {}), dict(quantiles or {})
    narrow = df.select(*keys, *group_number(keys), F.col(value).cast("double").alias("_x"),
                       *[F.col(c).alias(f"_code{j}") for j, c in enumerate(distinct.values())])
    if cut_lineage:
        narrow = stage_table(narrow, "group_profile")
    x = F.col("_x")
    out = narrow.groupBy(*keys, *number).agg(
        F.count(F.lit(1)).alias(count_name), (F.sum(x) / F.count(x)).alias(mean_name),
        F.min(x).alias(min_name), F.max(x).alias(max_name), F.stddev_samp(x).alias(stddev_name))
    if distinct or quantiles:
        codes = {name: f"_code{j}" for j, name in enumerate(distinct)}
        rows = narrow.select(*number, "_x", *codes.values())
        small, wanted = rows, narrow.count() // GROUP_ROWS if cut_lineage else 0  # of a stored table: its footers
        if wanted > int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")):
            small = rows.repartition(wanted, *number)
        # fewer than one in ``max_group_rows`` of all rows
        large = F.broadcast(narrow.groupBy(*number).agg(F.count(F.lit(1)).alias("_rows"))
                            .where(F.col("_rows") > max_group_rows).select(*number))
        out = out.join(_sorted_measures(small.join(large, number, "left_anti"), number, quantiles, codes).unionByName(
            _spread_measures(rows.join(large, number, "left_semi"), number, quantiles, codes)), number, "left")
        out = out.withColumns({name: F.coalesce(F.col(name), F.lit(0).cast("long")) for name in distinct})
    return out.drop(*number)
