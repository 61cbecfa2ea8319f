"""Path-based tables under one shared root: snapshot versions, append logs, month partitions.

Parquet has no MERGE, and a path that is being read must never be
overwritten, so a snapshot table is a folder of versions ``v=000001``,
``v=000002`` ...; a write goes to a new version and a read takes the newest
committed one (it has Spark's ``_SUCCESS`` marker).  Append-only logs are
plain appends.  A version can be audited before it counts (``audit``): it is
written without its marker, checked as written, and marked only when the checks
pass, so a version that fails never becomes the current one.  A table can be
kept in an order over all its files (``write_ordered``): ranges of rows go to files
whose names sort like the ranges, and ``read_in_order`` and ``with_position`` give
that order back without sorting again.  The monthly raw table is one folder partitioned by
``_month_partition`` and rewritten with dynamic partition overwrite, so only
the months being loaded are replaced.  All file-system calls go through the
Hadoop FileSystem of the session, so the same code runs on HDFS or an
object store.
"""

from __future__ import annotations

import threading
from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from costindex.operators import quality
from costindex.session import shared_root

LAYERS = ("raw", "warehouse", "meta", "marts", "state", "landing")


@dataclass(frozen=True)
class Audit:
    """What a version must satisfy before it becomes the current one."""
    keys: Sequence[str] = ()                 # unique together
    not_null: Sequence[str] = ()
    violations: dict[str, Column] = field(default_factory=dict)   # name -> true where a row is wrong

    def summary(self, df: DataFrame) -> DataFrame:
        """One row per check: test_name, rows_checked, failures."""
        checks = dict(self.violations)
        if self.not_null:
            checks["not_null"] = quality.any_null(self.not_null)
        parts = [quality.summaries(df, checks)] if checks else []
        if self.keys:
            parts.append(quality.unique_summary("unique", df, self.keys))
        if not parts:
            raise ValueError("an audit needs a check")
        return reduce(DataFrame.unionByName, parts)

    def failures(self, df: DataFrame) -> dict[str, int]:
        return {r.test_name: r.failures for r in self.summary(df).where("failures > 0").collect()}


class AuditFailed(Exception):
    """A written version did not pass; the version before it stays the current one."""

    def __init__(self, target: str, failures: dict[str, int]):
        table, version = target.rsplit("/", 2)[1:]
        super().__init__(f"{table} {version} not published: " + ", ".join(f"{k} {n}" for k, n in sorted(failures.items())))
        self.target, self.failures = target, failures


class Warehouse:
    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark = spark
        self.root = (root or shared_root(spark)).rstrip("/")
        jvm = spark.sparkContext._jvm
        self._Path = jvm.org.apache.hadoop.fs.Path
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.lock = threading.RLock()

    # ---- file system ------------------------------------------------------------
    def _fs(self, path: str):
        return self._Path(path).getFileSystem(self._conf)

    def exists(self, path: str) -> bool:
        return bool(self._fs(path).exists(self._Path(path)))

    def _children(self, path: str) -> list[str]:
        if not self.exists(path):
            return []
        return [st.getPath().getName() for st in self._fs(path).listStatus(self._Path(path))]

    def children(self, path: str) -> list[str]:
        """Names in a folder, empty where there is none."""
        return sorted(self._children(path))

    def delete(self, path: str) -> None:
        self._fs(path).delete(self._Path(path), True)

    def data_files(self, path: str) -> list[str]:
        """The data files at ``path`` (a file, or a folder of files), without markers and hidden ones."""
        fs, root = self._fs(path), self._Path(path)
        if not fs.getFileStatus(root).isDirectory():
            return [path]
        out, entries = [], fs.listFiles(root, True)
        while entries.hasNext():
            p = entries.next().getPath()
            inner = p.toUri().getPath()[len(fs.makeQualified(root).toUri().getPath()):]
            if not any(part.startswith(("_", ".")) for part in inner.split("/") if part):
                out.append(p.toString())
        return sorted(out)

    def path(self, layer: str, name: str) -> str:
        return f"{self.root}/{layer}/{name}"

    # ---- snapshot tables ----------------------------------------------------------
    def versions_at(self, base: str) -> list[int]:
        out = []
        for child in self._children(base):
            if child.startswith("v=") and self.exists(f"{base}/{child}/_SUCCESS"):
                out.append(int(child[2:]))
        return sorted(out)

    def has_table(self, layer: str, name: str) -> bool:
        return self.has_table_at(self.path(layer, name))

    def has_table_at(self, base: str) -> bool:
        return bool(self.versions_at(base)) or self.exists(f"{base}/_SUCCESS")

    def read(self, layer: str, name: str) -> DataFrame:
        return self.read_at(self.path(layer, name))

    def read_at(self, base: str) -> DataFrame:
        versions = self.versions_at(base)
        if versions:
            return self.spark.read.parquet(f"{base}/v={versions[-1]:06d}")
        return self.spark.read.parquet(base)

    def write_snapshot(self, layer: str, name: str, df: DataFrame,
                       sort_within: list[str] | None = None, audit: Audit | None = None) -> DataFrame:
        """Write ``df`` as the next version and return a frame reading it back."""
        return self.write_at(self.path(layer, name), df, sort_within, audit)

    def write_at(self, base: str, df: DataFrame, sort_within: list[str] | None = None,
                 audit: Audit | None = None) -> DataFrame:
        target = self._next_version(base)
        out = df.sortWithinPartitions(*sort_within) if sort_within else df
        return self._write_version(out, target, audit)

    def write_ordered(self, layer: str, name: str, df: DataFrame, order_by: list[str], files: int | None = None,
                      audit: Audit | None = None) -> DataFrame:
        """Write the next version with its rows in order (nulls last) over all files; returns it in that order.

        The rows are range-partitioned once, into ``files`` parts or as many as
        adaptive execution finds fit.  Rows equal in ``order_by`` stay together in one part.
        """
        order = [F.col(c).asc_nulls_last() for c in order_by]
        ranged = df.repartitionByRange(files, *order) if files else df.repartitionByRange(*order)
        target = self._next_version(self.path(layer, name))
        self._write_version(ranged.sortWithinPartitions(*order), target, audit)
        return self.read_in_order(layer, name)

    def _next_version(self, base: str) -> str:
        # skip past every version folder, also one left uncommitted by a failed write
        seen = [int(c[2:]) for c in self._children(base) if c.startswith("v=") and c[2:].isdigit()]
        return f"{base}/v={max(seen, default=0) + 1:06d}"

    def _write_version(self, out: DataFrame, target: str, audit: Audit | None) -> DataFrame:
        if audit is None:
            out.write.mode("errorifexists").parquet(target)
        else:
            self._write_audited(out, target, audit)
            self.publish(target)
        return self.spark.read.parquet(target)

    def _write_audited(self, out: DataFrame, target: str, audit: Audit) -> None:
        out.write.mode("errorifexists").option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(target)
        failures = audit.failures(self.spark.read.parquet(target))
        if failures:
            raise AuditFailed(target, failures)

    def prepare(self, layer: str, name: str, df: DataFrame, audit: Audit) -> str:
        """Write and audit the next version; it counts only after ``publish``."""
        target = self._next_version(self.path(layer, name))
        self._write_audited(df, target, audit)
        return target

    def publish(self, target: str) -> None:
        """Make a prepared version the current one (its marker is one small file)."""
        self._fs(target).create(self._Path(f"{target}/_SUCCESS"), True).close()

    # ---- tables in order --------------------------------------------------------------
    def _newest(self, base: str) -> str:
        versions = self.versions_at(base)
        return f"{base}/v={versions[-1]:06d}" if versions else base

    def read_in_order(self, layer: str, name: str) -> DataFrame:
        """A table of ``write_ordered``, its partitions in the order of the files.

        A scan of many files would deal them to tasks by size; here each file is a scan of its own, one after another.
        """
        path = self._newest(self.path(layer, name))
        schema = self.spark.read.parquet(path).schema
        parts = [self.spark.read.schema(schema).parquet(f) for f in self.data_files(path)]
        return reduce(DataFrame.unionAll, parts) if parts else self.spark.createDataFrame([], schema)

    def with_position(self, layer: str, name: str, out: str = "position") -> DataFrame:
        """The newest version with each row's place in the table's order, from 1: rows in earlier files plus the place in its own."""
        if out in self.read(layer, name).columns:
            raise ValueError(f"the table has a column {out}")
        rows = self.read(layer, name).select("*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row"))
        files = rows.groupBy("_file").agg(F.count(F.lit(1)).alias("_n"))
        # one row per file: small by construction
        before = files.select("_file", (F.sum("_n").over(Window.orderBy("_file")) - F.col("_n")).alias("_before"))
        return rows.join(F.broadcast(before), "_file").withColumn(out, F.col("_before") + F.col("_row") + 1) \
            .drop("_file", "_row", "_before")

    def vacuum(self, retain: int = 2) -> None:
        """Delete all but the newest ``retain`` committed versions of every snapshot table, and what older failed writes left.

        Call between runs: a frame that still reads an old version would fail.
        """
        for layer in LAYERS:
            for name in self._children(f"{self.root}/{layer}"):
                base = self.path(layer, name)
                kept = self.versions_at(base)[-retain:]
                for child in self._children(base):
                    if child.startswith("v=") and child[2:].isdigit() and kept and int(child[2:]) < kept[-1] and int(child[2:]) not in kept:
                        old = f"{base}/{child}"
                        self._fs(old).delete(self._Path(old), True)

    # ---- append-only logs -----------------------------------------------------------
    def append(self, layer: str, name: str, df: DataFrame) -> None:
        df.write.mode("append").parquet(self.path(layer, name))

    def read_log(self, layer: str, name: str, schema) -> DataFrame:
        p = self.path(layer, name)
        if self.exists(f"{p}/_SUCCESS") or self._children(p):
            return self.spark.read.schema(schema).parquet(p)
        return self.spark.createDataFrame([], schema)

    # ---- month-partitioned raw table ---------------------------------------------------
    def replace_partitions(self, layer: str, name: str, df: DataFrame,
                           partition_col: str) -> None:
        """Replace exactly the partitions present in ``df`` (idempotent re-loads)."""
        (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(partition_col).parquet(self.path(layer, name)))

    def read_partitioned(self, layer: str, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(layer, name))

    def row_count(self, layer: str, name: str) -> int | None:
        """Row count of a table, None when it does not exist (parquet footers only)."""
        if not self.has_table(layer, name):
            return None
        return self.read(layer, name).count()


_CACHE: dict[tuple[str, str], Warehouse] = {}
_CACHE_LOCK = threading.Lock()


def warehouse_for(spark: SparkSession, key: str) -> Warehouse:
    """One warehouse per session and key (e.g. the sf_dir of a query run)."""
    k = (spark.sparkContext.applicationId, key)
    with _CACHE_LOCK:
        if k not in _CACHE:
            _CACHE[k] = Warehouse(spark)
        return _CACHE[k]
