"""Join operators: size-checked broadcast, star join, keyed outer chain."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costindex.session import stage_table

# Size of a dimension's rows in memory under which it is broadcast.  Above it the
# join stays a shuffle join.
DEFAULT_BROADCAST_BYTES = 256 * 1024 * 1024
# A broadcast is built in the driver, with copies while it grows, and a query may hold several:
# one takes no more than this part of the driver's heap.
DRIVER_SHARE = 16
# A scan's estimate is its file size; rows in memory may be this many times larger
# (13 to 18 times were seen, of dictionary-coded columns).
COMPRESSION = 64
# A key is hot when it has more than one row in so many of the fact, so there are fewer hot keys than this.
HOT_SHARE = 1000


def estimated_bytes(df: DataFrame) -> int | None:
    """Catalyst's size estimate of a plan (no job is run); None if unavailable."""
    try:
        return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    except Exception:  # e.g. Spark Connect: no plan statistics on the client
        return None


def driver_bound(df: DataFrame, max_bytes: int) -> int:
    """``max_bytes``, or the driver's share when that is less."""
    try:
        heap = int(df.sparkSession.sparkContext._jvm.java.lang.Runtime.getRuntime().maxMemory())
    except Exception:  # e.g. Spark Connect: no JVM on the client
        return max_bytes
    return min(max_bytes, heap // DRIVER_SHARE)


def _fixed_row_bytes(df: DataFrame) -> int:
    """Bytes per row without the content of strings."""
    return 16 + 8 * len(df.schema.fields)


def measured_bytes(df: DataFrame, max_bytes: int) -> int | None:
    """Size of the rows in memory (fixed widths plus the strings' lengths), None when above ``max_bytes``.

    At most as many rows as fit under the limit are read, which bounds the check's own cost.
    """
    limit_rows = max_bytes // _fixed_row_bytes(df)
    strings = [F.coalesce(F.octet_length(f.name), F.lit(0)) for f in df.schema.fields
               if f.dataType.typeName() in ("string", "binary")]
    content = F.sum(sum(strings, F.lit(0)).cast("long")) if strings else F.lit(0).cast("long")
    rows, text = df.limit(limit_rows + 1).agg(F.count(F.lit(1)), content).first()
    size = rows * _fixed_row_bytes(df) + (text or 0)
    return size if rows <= limit_rows and size <= max_bytes else None


def broadcast_if_small(df: DataFrame, max_bytes: int = DEFAULT_BROADCAST_BYTES,
                       verify_rows: bool = False) -> DataFrame:
    """Hint a broadcast only behind a size check; otherwise leave a shuffle join.

    The plan estimate (no job) decides first, allowing for compression.
    Estimates of joined or aggregated plans are loose upper bounds, so with
    ``verify_rows`` a dimension that looks too big is measured (one job over
    the dimension only) and broadcast when it fits under ``max_bytes`` and the
    driver's share.  One that was measured and does not fit is kept from Spark's
    own broadcasts, which go by the compressed size.
    """
    if fits(df, max_bytes, verify_rows):
        return F.broadcast(df)
    return shuffled(df) if verify_rows else df


def shuffled(df: DataFrame) -> DataFrame:
    """The side of a join that must not be broadcast, whatever the estimate of its plan."""
    return df.hint("merge")


def shuffled_if_large(df: DataFrame, max_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """A join side left to Spark's choice when its rows would fit a broadcast, else shuffled."""
    return df if fits(df, max_bytes) else shuffled(df)


def fits(df: DataFrame, max_bytes: int, verify_rows: bool = True) -> bool:
    """Whether the size check allows a broadcast: the plan's estimate, else (``verify_rows``) the measured rows."""
    max_bytes = driver_bound(df, max_bytes)
    size = estimated_bytes(df)
    if size is not None and size <= max_bytes // COMPRESSION:
        return True
    return verify_rows and measured_bytes(df, max_bytes) is not None


def hot_keys(df: DataFrame, key: str, share: int = HOT_SHARE) -> DataFrame:
    """The keys with more than one in ``share`` of all rows (fewer than ``share`` of them), as a stored table of one column."""
    counts = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    total = df.agg((F.count(F.lit(1)) / share).alias("_bound"))  # one row
    return stage_table(counts.join(F.broadcast(total), F.col("_n") > F.col("_bound")).select(key), "hot-keys")


def split_hot_join(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str,
                   max_broadcast_bytes: int = DEFAULT_BROADCAST_BYTES, share: int = HOT_SHARE) -> DataFrame:
    """Inner join to a dimension too large to broadcast, where few keys may hold most of the fact.

    Only the dimension's rows of the hot keys are broadcast, so a hot key's fact
    rows stay in their scan partitions; all other rows meet in a shuffle join,
    where no key has more than one in ``share`` of the fact.  The fact is scanned twice (a
    third time for its key column alone).  When even the hot keys' rows exceed
    the limit, as for a dimension that repeats its keys, it is a plain shuffle
    join, whose skew AQE splits.
    """
    hot = hot_keys(fact, fact_key, share).select(F.col(fact_key).alias("_hot"))
    hot_rows = dim.join(F.broadcast(hot), dim[dim_key] == F.col("_hot"), "left_semi")
    if measured_bytes(hot_rows, driver_bound(dim, max_broadcast_bytes)) is None:
        return fact.join(shuffled(dim), fact[fact_key] == dim[dim_key], "inner")
    rare = fact.join(F.broadcast(hot), fact[fact_key] == F.col("_hot"), "left_anti")
    small = F.broadcast(hot_rows)
    return rare.join(shuffled(dim), rare[fact_key] == dim[dim_key], "inner").unionByName(
        fact.join(small, fact[fact_key] == small[dim_key], "inner"))


def star_join(fact: DataFrame, dims: Sequence[tuple[DataFrame, str, str]],
              max_broadcast_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Inner-join a fact to dimensions: each dim is (frame, fact_key, dim_key).

    The fact is never broadcast or shuffled for a small dimension: each
    dimension is broadcast when its checked size allows, otherwise only its rows
    of the fact's hot keys are, and the rest is a shuffle join on the key.
    """
    out = fact
    for dim, fact_key, dim_key in dims:
        if dim_key == fact_key:
            dim_key = f"_dim_{fact_key}"
            dim = dim.withColumnRenamed(fact_key, dim_key)
        if fits(dim, max_broadcast_bytes):
            out = out.join(F.broadcast(dim), out[fact_key] == dim[dim_key], "inner")
        else:
            out = split_hot_join(out, dim, fact_key, dim_key, max_broadcast_bytes)
        out = out.drop(dim_key)
    return out


def keyed_outer_chain(frames: Sequence[DataFrame], key: str,
                      anchors: int | None = None) -> DataFrame:
    """Chain of full outer joins on one key, keeping keys present in the anchors.

    ``coalesce(a.k, b.k, c.k) ... where that is not null`` over a chain of
    full outer joins keeps exactly the keys found in the first ``anchors``
    frames (all frames when None); every frame contributes its columns for
    those keys.  Built as the distinct union of anchor keys left-joined to
    each frame, which needs no full outer join at all.  Each frame must have
    one row per key (they are per-key aggregates).
    """
    anchors = len(frames) if anchors is None else anchors
    keys = None
    for f in frames[:anchors]:
        k = f.select(key).where(F.col(key).isNotNull())
        keys = k if keys is None else keys.union(k)
    out = keys.distinct()
    for f in frames:
        out = out.join(broadcast_if_small(f), key, "left")
    return out
