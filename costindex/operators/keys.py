"""Key helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str],
                   how: str = "inner") -> DataFrame:
    """Equi-join on ``keys`` where null keys match each other (group keys may be null).

    The right side's key columns are dropped, so the output has one copy of
    each key column, like ``join(on=keys)``.
    """
    if not keys:
        return left.crossJoin(right)  # only ever used with a one-row side
    renamed = {k: f"__r_{k}" for k in keys}
    r = right.select(*[F.col(c).alias(renamed.get(c, c)) for c in right.columns])
    cond: Column | None = None
    for k, new in renamed.items():
        c = left[k].eqNullSafe(r[new])
        cond = c if cond is None else cond & c
    out = left.join(r, cond, how)
    if how in ("full", "full_outer", "outer", "right", "right_outer"):
        for k, new in renamed.items():
            out = out.withColumn(k, F.coalesce(F.col(k), F.col(new)))
    return out.drop(*renamed.values())
