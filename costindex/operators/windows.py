"""Window operators: previous-row annotation, whole-table min-max scaling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from costindex.functions.expressions import round_half_away


def with_previous(df: DataFrame, partition_by: Sequence[str], order_by: str,
                  value: str, out: str) -> DataFrame:
    """``out`` = value of the previous row in ``order_by`` order within the partition.

    Moves by row, not by calendar: after a gap the row before the gap is used.
    """
    w = Window.partitionBy(*partition_by).orderBy(order_by)
    return df.withColumn(out, F.lag(value).over(w))


def pct_change(value: str, previous: str, digits: int):
    """round((v - prev) / prev * 100, digits) when prev > 0, else null."""
    p = F.col(previous)
    return F.when(p.isNotNull() & (p > 0),
                  round_half_away((F.col(value) - p) / p * F.lit(100.0), digits))


def minmax_scale(df: DataFrame, columns: dict[str, tuple[str, bool]]) -> DataFrame:
    """Scale columns to 0..1 over the whole table: (x - min) / (max - min).

    ``columns`` maps output name -> (input column, inverse).  inverse gives
    ``1 - scaled``.  A flat column (max = min) scales to null.  The min and
    max come from one global aggregate (one row, partial aggregation on every
    partition) that is cross-joined back as a broadcast -- no single-partition
    window.
    """
    aggs = []
    for src in dict.fromkeys(src for src, _ in columns.values()):
        aggs += [F.min(src).alias(f"__min_{src}"), F.max(src).alias(f"__max_{src}")]
    bounds = df.agg(*aggs)
    out = df.crossJoin(F.broadcast(bounds))
    for name, (src, inverse) in columns.items():
        lo, hi = F.col(f"__min_{src}"), F.col(f"__max_{src}")
        rng = hi - lo
        scaled = F.when(rng != 0, (F.col(src) - lo) / rng)
        out = out.withColumn(name, (F.lit(1) - scaled) if inverse else scaled)
    return out.drop(*[c for c in out.columns if c.startswith("__min_") or c.startswith("__max_")])


def with_previous_bucketed(df: DataFrame, partition_by: Sequence[str], order_by: str,
                           value: str, out: str, bucket) -> DataFrame:
    """``lag(value)`` by ``order_by`` within ``partition_by``, spread over ordered buckets.

    ``bucket`` must not decrease as ``order_by`` grows within a partition (for
    example the month of a date).  The window runs per (partition, bucket),
    so a partition key holding a large share of the rows is spread over many
    tasks; the first row of each bucket takes the last value of the previous
    non-empty bucket, found in a per-bucket table (one row per bucket) that is
    broadcast back when its checked size allows.
    """
    from costindex.operators.joins import broadcast_if_small
    from costindex.operators.keys import null_safe_join

    keys = list(partition_by)
    b = df.withColumn("_bkt", bucket)
    w = Window.partitionBy(*keys, "_bkt").orderBy(order_by)
    b = b.withColumn(out, F.lag(value).over(w)).withColumn("_rn", F.row_number().over(w))
    tails = b.groupBy(*keys, "_bkt").agg(F.max_by(value, order_by).alias("_tail"))
    tails = tails.withColumn("_prev_tail", F.lag("_tail").over(
        Window.partitionBy(*keys).orderBy("_bkt"))).drop("_tail")
    b = null_safe_join(b, broadcast_if_small(tails), keys + ["_bkt"], "left")
    return b.withColumn(out, F.when(F.col("_rn") == 1, F.col("_prev_tail"))
                        .otherwise(F.col(out))).drop("_bkt", "_rn", "_prev_tail")
