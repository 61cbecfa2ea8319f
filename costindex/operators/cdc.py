"""Change capture against the previous snapshot, history merge, change events.

``keyed_changes`` is set-based: the batch is reduced to a row per key by a
partial aggregate, which also tells how often each key occurs, and that table is
left-joined to the previous snapshot once (no per-row look-ups, no window over
the batch).  Keys that occur more than once in one batch are sequential by
nature (the second row compares with the first row's accepted value), so only
their rows are read again and go through the ordered fold.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costindex.functions import py_str_double
from costindex.operators.fold import deadband_fold
from costindex.operators.joins import broadcast_if_small
from costindex.operators.keys import null_safe_join
from costindex.session import stage_table

EVENT_COLUMNS = ["source_name", "entity_key", "field_name", "old_value", "new_value",
                 "change_type"]


def keyed_changes(batch: DataFrame, previous: DataFrame, keys: Sequence[str], value: str,
                  tolerance: float, order_by: Sequence[str] = (),
                  emit_deletes: bool = False) -> DataFrame:
    """INSERT / UPDATE events of ``batch`` against ``previous`` (both keyed by ``keys``).

    A key absent from ``previous`` is an INSERT; a key whose value moved by
    more than ``tolerance`` is an UPDATE (a null previous value followed by a
    value is an UPDATE too).  With ``emit_deletes`` a key of ``previous``
    that is missing from the batch is a DELETE (the batch is then a full
    snapshot).  Rows of a key that occurs several times are taken in the order
    of ``order_by``; without it such a batch is an error.
    Output: keys, old_value, new_value, change_type, _seq.
    """
    keys = list(keys)
    prev = previous.select(*keys, F.col(value).cast("double").alias("_iv"),
                           F.lit(True).alias("_ip"))
    b = batch.select(*keys, *[c for c in order_by if c not in keys],
                     F.col(value).cast("double").alias("_val"))
    # for a key that occurs once, the largest value is its value
    counted = stage_table(b.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.max("_val").alias("_val")), "cdc_keys")

    single = counted.where(F.col("_n") == 1).join(prev, keys, "left")
    old, new = F.col("_iv"), F.col("_val")
    ctype = (F.when(F.col("_ip").isNull(), F.lit("INSERT"))
             .when(old.isNull() & new.isNotNull(), F.lit("UPDATE"))
             .when(F.abs(old - new) > F.lit(float(tolerance)), F.lit("UPDATE")))
    out = single.select(*keys, F.when(F.col("_ip").isNotNull(), old).alias("old_value"),
                        new.alias("new_value"), ctype.alias("change_type"),
                        F.lit(1).alias("_seq")).where(F.col("change_type").isNotNull())

    again = counted.where(F.col("_n") > 1).select(*keys)
    if not again.isEmpty():
        if not order_by:
            raise ValueError(f"keys {keys} repeat in the batch, and nothing orders its rows")
        rows = null_safe_join(b, again, keys, "left_semi").join(prev, keys, "left")
        folded = deadband_fold(rows, keys, list(order_by), "_val", tolerance, init_present="_ip", init_value="_iv")
        out = out.unionByName(folded.select(*keys, "old_value", "new_value", "change_type", "_seq"))
    if emit_deletes:
        gone = prev.join(b.select(*keys), keys, "left_anti").select(
            *keys, F.col("_iv").alias("old_value"), F.lit(None).cast("double").alias("new_value"),
            F.lit("DELETE").alias("change_type"), F.lit(1).alias("_seq"))
        out = out.unionByName(gone)
    return out


def merge_history(previous: DataFrame, changes: DataFrame, keys: Sequence[str], value: str,
                  stamp_col: str, stamp: Column) -> DataFrame:
    """Upsert the accepted values of ``changes`` into the ``previous`` snapshot.

    Inserted keys (first event INSERT) are appended; updated keys take their
    last accepted value and a new stamp; every other row is kept as is.  The
    change set is joined to the history without shuffling the history when
    its checked size allows a broadcast.
    """
    keys = list(keys)
    deleted = changes.where(F.col("change_type") == "DELETE").select(*keys).distinct()
    changes = changes.where(F.col("change_type") != "DELETE")
    latest = changes.groupBy(*keys).agg(
        F.max_by("new_value", "_seq").alias("_nv"),
        F.max(F.when(F.col("change_type") == "INSERT", F.lit(1)).otherwise(F.lit(0)))
        .alias("_ins"))
    value_type = dict(previous.dtypes)[value]
    upd = latest.where(F.col("_ins") == 0).select(*keys, "_nv", F.lit(True).alias("_hit"))
    kept = previous.join(broadcast_if_small(upd, verify_rows=True), keys, "left").select(
        *keys,
        F.when(F.col("_hit"), F.col("_nv").cast(value_type)).otherwise(F.col(value)).alias(value),
        F.when(F.col("_hit"), stamp).otherwise(F.col(stamp_col)).alias(stamp_col))
    ins = latest.where(F.col("_ins") == 1).select(
        *keys, F.col("_nv").cast(value_type).alias(value), stamp.alias(stamp_col))
    kept = kept.join(broadcast_if_small(deleted, verify_rows=True), keys, "left_anti")
    return kept.unionByName(ins)


def change_events(changes: DataFrame, source_name: str, entity_key: Column,
                  field_name: str) -> DataFrame:
    """Audit rows: values written as text the way Python prints floats, null stays null."""
    return changes.select(
        F.lit(source_name).alias("source_name"),
        entity_key.alias("entity_key"),
        F.lit(field_name).alias("field_name"),
        py_str_double("old_value").alias("old_value"),
        py_str_double("new_value").alias("new_value"),
        F.col("change_type"),
    )


def date_key(c: str | Column, length: int) -> Column:
    """First ``length`` characters of the text of a date / timestamp."""
    col = F.col(c) if isinstance(c, str) else c
    return F.substring(col.cast("string"), 1, length)
