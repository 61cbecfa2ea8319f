"""Exact continuous quantiles that never put a whole group into one task.

``percentile`` / ``median`` keep a value->count map per group in memory and
merge it in one task, so a group holding a third of all rows lands on one
executor.  Here the work is spread:

1. value counts per (group, value) -- a map-side combined aggregate, the only
   pass over the raw rows;
2. groups with more distinct values than ``max_values_per_task`` are narrowed
   to the cells that hold a wanted rank.  A cell is a range of values: first
   half octaves, then ``CELLS`` equal steps between the least and the greatest
   value of a cell, twice.  A cell's number never falls as the value grows, so
   the cells' totals (a map-side combined aggregate) give each cell's rank
   offset, and values of the other cells are counted but not ranked;
3. each narrow group and each cell left of a wide one is ranked exactly in its
   own window partition; one aggregate per group then picks the values at ranks
   floor(pos) and ceil(pos), interpolated with a single rounding like SQL
   ``percentile_cont``.

A value meets its group's cells by an equality lookup, and a group has at most
two cells a probability left after a step, so the cost of a value does not grow
with the group.  All of this is one plan for narrow and wide groups: which groups
are wide is found when it runs.  No job runs while the plan is built.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from costindex.functions.expressions import interpolate
from costindex.operators.keys import null_safe_join

DEFAULT_MAX_VALUES_PER_TASK = 2_000_000
# Steps a cell is cut into; a group's window over its cells is this long at most (half octaves: 8,600).
CELLS = 4096


def _position(p: float, n: str = "_n") -> Column:
    return (F.col(n) - 1).cast("double") * F.lit(float(p))


def _holds(rank: Column, lo_rank: Column, hi_rank: Column) -> Column:
    return (rank >= lo_rank) & (rank < hi_rank)


def pick_ranks(probs: Mapping[str, float], value: str, lo_rank: Column, hi_rank: Column) -> list[Column]:
    """Aggregates that find the values around each position: a row holds the ranks [lo, hi) of ``_n``."""
    return [F.max(F.when(_holds(rank, lo_rank, hi_rank), F.col(value))).alias(f"_{side}_{name}")
            for name, p in probs.items()
            for side, rank in (("lo", F.floor(_position(p))), ("hi", F.ceil(_position(p))))]


def picked_quantiles(probs: Mapping[str, float]) -> list[Column]:
    """The quantiles from the columns of ``pick_ranks`` and ``_n``."""
    return [interpolate(f"_lo_{name}", f"_hi_{name}", _position(p) - F.floor(_position(p))).alias(name)
            for name, p in probs.items()]


def _half_octave(v: Column) -> Column:
    """Number of the half octave of a value, growing with it (log2 never falls as its argument grows)."""
    size = F.abs(v)
    top = F.lit(10_000)
    step = (F.when(F.isnan(v) | (size == float("inf")), top)
            .otherwise(F.floor((F.log2(size) + F.lit(1080)) * F.lit(2)).cast("int")))
    return F.when(F.isnan(v), top + 1).when(v > 0, step).when(v < 0, -step).otherwise(F.lit(0))


def _equal_step(v: Column) -> Column:
    """Number of the value's step between the least and the greatest value of its cell."""
    at = (v - F.col("_lo")) / (F.col("_hi") - F.col("_lo"))
    return F.when(F.col("_hi") > F.col("_lo"), F.least(F.floor(at * F.lit(CELLS)).cast("int"), F.lit(CELLS - 1))).otherwise(F.lit(0))


def _narrowed(values: DataFrame, keys: list[str], probs: Mapping[str, float], cell: Column) -> DataFrame:
    """The values in cells that hold a wanted rank; ``_off`` is the number of the group's rows before the cell."""
    dealt = values.withColumn("_cell", cell)
    part = keys + ["_n", "_off"]
    cells = dealt.groupBy(*part, "_cell").agg(
        F.sum("_c").alias("_held"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    before = Window.partitionBy(*part).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.withColumn("_start", F.col("_off") + F.coalesce(F.sum("_held").over(before), F.lit(0)))
    wanted = [_holds(rank, F.col("_start"), F.col("_start") + F.col("_held"))
              for p in probs.values() for rank in (F.floor(_position(p)), F.ceil(_position(p)))]
    live = cells.where(reduce(Column.__or__, wanted)).select(*keys, "_off", "_cell", "_start", "_lo", "_hi")
    found = null_safe_join(dealt.select(*keys, "_v", "_c", "_n", "_off", "_cell"), F.broadcast(live), keys + ["_off", "_cell"])
    return found.select(*keys, "_v", "_c", "_n", F.col("_start").alias("_off"), "_lo", "_hi")


def exact_quantiles(df: DataFrame, keys: Sequence[str], value: str,
                    probs: Mapping[str, float],
                    max_values_per_task: int = DEFAULT_MAX_VALUES_PER_TASK) -> DataFrame:
    """One row per group: ``keys`` + one double column per entry of ``probs``.

    Semantics of SQL ``percentile_cont(p) within group (order by value)``:
    nulls ignored, position (n-1)*p, linear interpolation between neighbours.
    """
    keys = list(keys)
    v = df.select(*keys, F.col(value).cast("double").alias("_v")).where(F.col("_v").isNotNull())
    vc = v.groupBy(*keys, "_v").agg(F.count(F.lit(1)).alias("_c"))
    return quantiles_from_counts(vc, keys, probs, max_values_per_task)


def quantiles_from_counts(vc: DataFrame, keys: Sequence[str], probs: Mapping[str, float],
                          max_values_per_task: int = DEFAULT_MAX_VALUES_PER_TASK) -> DataFrame:
    """Quantiles from value counts: ``vc`` has keys, ``_v`` (non-null, distinct per group), ``_c``."""
    keys = list(keys)
    if not probs:
        return vc.select(*keys).distinct()
    # wide groups are few, whatever the data, and so are their cells that hold a wanted rank: what is broadcast is bounded.
    # The total is read in every branch, so that all of them share one exchange of the counts.
    wide = F.broadcast(vc.groupBy(*keys).agg(F.count(F.lit(1)).alias("_d"), F.sum("_c").alias("_n"))
                       .where(F.col("_d") > max_values_per_task).select(*keys, "_n"))
    sized = null_safe_join(vc, wide, keys, "left")
    narrow = sized.where(F.col("_n").isNull()).select(*keys, "_v", "_c", "_n", F.lit(0).cast("long").alias("_off"))
    cut = null_safe_join(vc, wide, keys).withColumn("_off", F.lit(0).cast("long"))
    for cell in (_half_octave(F.col("_v")), _equal_step(F.col("_v")), _equal_step(F.col("_v"))):
        cut = _narrowed(cut, keys, probs, cell)

    # exact ranks inside each narrow group and each cell: rows [lo, hi) of the sorted values
    part = keys + ["_off"]
    w = Window.partitionBy(*part).orderBy("_v")
    ranked = narrow.unionByName(cut.drop("_lo", "_hi")).withColumns({
        "_cum": F.sum("_c").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)),
        "_own": F.sum("_c").over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))})
    ranked = ranked.withColumn("_n", F.coalesce("_n", "_own"))
    hi_rank = F.col("_off") + F.col("_cum")
    picked = ranked.groupBy(*keys).agg(F.first("_n").alias("_n"), *pick_ranks(probs, "_v", hi_rank - F.col("_c"), hi_rank))
    return picked.select(*keys, *picked_quantiles(probs))
