"""Histories kept in parts: changed by copy-on-write, published together by one manifest.

A table is split into parts by its key: a period (what changes together, such as
the months of a series) and, within it, hash parts.  The rows of a part are in
one folder that is never changed.  A version is a manifest, a small table that
names the folder of every part of every table.  A merge reads and writes only the
parts that its changes fall in; a new manifest names those folders and, for all
other parts, the folders of the version before.  Histories and the change log of
a run are published by one manifest, so a reader sees all of a run or none of it,
and a crash at any point leaves folders that no manifest names (``vacuum``
deletes them).

The driver holds metadata only: a row per part.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from costindex.sources.tables import Audit, AuditFailed, Warehouse

PART = "ledger_part"
MANIFEST = T.StructType([
    T.StructField("table_name", T.StringType()),
    T.StructField("part", T.StringType()),
    T.StructField("version", T.LongType()),    # the manifest that brought the folder
    T.StructField("folder", T.StringType()),   # relative to the ledger
    T.StructField("n_rows", T.LongType()),
])


@dataclass(frozen=True)
class Layout:
    """How a table is split.  Rows of one key are always in one part.

    ``period`` is a SQL expression over key columns; ``spread`` hash parts by the columns
    ``by`` split each period further.  Choose them so that a part fits one task.
    """
    period: str | None = None
    by: Sequence[str] = ()
    spread: int = 1

    def part(self) -> Column:
        name = _folder_name(F.expr(self.period or "'all'"))
        if self.spread > 1:
            bucket = F.pmod(F.xxhash64(*self.by), F.lit(self.spread))
            name = F.concat(name, F.lit("_"), F.lpad(bucket.cast("string"), 5, "0"))
        return name


def _folder_name(text: Column) -> Column:
    """Texts that differ in characters outside a folder's name only share one."""
    safe = F.regexp_replace(F.coalesce(text.cast("string"), F.lit("null")), "[^A-Za-z0-9.-]", "_")
    return F.concat(F.lit("p"), safe)


@dataclass(frozen=True)
class Prepared:
    """Parts that are written and audited, but named by no manifest yet."""
    table: str
    base: int                  # the version they were made from
    folder: str
    rows: dict[str, int]       # of each part written
    replaced: frozenset[str]   # parts that no longer use their old folder


class Conflict(Exception):
    """Another manifest was published since the parts were prepared: prepare them again."""


class Ledger:
    def __init__(self, wh: Warehouse, base: str | None = None):
        self.wh, self.spark = wh, wh.spark
        self.base = (base or wh.path("warehouse", "ledger")).rstrip("/")
        self.manifests = f"{self.base}/manifest"

    # ---- reading -----------------------------------------------------------------------
    def version(self) -> int:
        """The newest version, 0 before the first one."""
        return max(self.wh.versions_at(self.manifests), default=0)

    def entries(self, version: int | None = None) -> DataFrame:
        """The manifest of a version (the newest one)."""
        version = self.version() if version is None else version
        if not version:
            return self.spark.createDataFrame([], MANIFEST)
        return self.spark.read.schema(MANIFEST).parquet(f"{self.manifests}/v={version:06d}")

    def has(self, table: str, version: int | None = None) -> bool:
        return not self.entries(version).where(F.col("table_name") == table).isEmpty()

    def read(self, table: str, schema: T.StructType, parts: Iterable[str] | None = None,
             version: int | None = None) -> DataFrame:
        """A table as of a version (the newest one), whole or only the named parts; empty where there are none."""
        found = self.entries(version).where(F.col("table_name") == table).collect()
        if parts is not None:
            wanted = set(parts)
            found = [e for e in found if e.part in wanted]
        paths = sorted(f"{self.base}/{e.folder}/{PART}={e.part}" for e in found)
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def parts_of(self, df: DataFrame, layout: Layout) -> list[str]:
        """The parts that the rows of ``df`` fall in."""
        return sorted(r[0] for r in df.select(layout.part()).distinct().collect())

    def only(self, df: DataFrame, layout: Layout, parts: Sequence[str]) -> DataFrame:
        """The rows of ``df`` in the named parts."""
        names = self.spark.createDataFrame([(p,) for p in parts], f"{PART} string")
        # one short text per part
        return df.withColumn(PART, layout.part()).join(F.broadcast(names), PART, "left_semi").drop(PART)

    # ---- writing -----------------------------------------------------------------------
    def _folder(self, table: str) -> str:
        return f"{table}/g={self.version() + 1:06d}-{uuid.uuid4().hex[:12]}"

    def prepare(self, table: str, parts: Sequence[str], layout: Layout, schema: T.StructType,
                rewrite: Callable[[DataFrame], DataFrame], audit: Audit | None = None) -> Prepared:
        """Write the new rows of ``parts``: ``rewrite`` gets their present rows and returns all of their new ones.

        Keys do not cross parts, so auditing what was written audits the table.
        """
        base, folder = self.version(), self._folder(table)
        after = rewrite(self.read(table, schema, parts)).select(*schema.fieldNames())
        return self._write(table, base, folder, after.withColumn(PART, layout.part()), schema, frozenset(parts), audit)

    def prepare_run(self, table: str, run: str, df: DataFrame, schema: T.StructType) -> Prepared:
        """Write a log's rows of one run, a part of its own; a run written again replaces itself."""
        base, folder, part = self.version(), self._folder(table), _folder_name(F.lit(run))
        name = self.spark.range(1).select(part).first()[0]
        return self._write(table, base, folder, df.select(*schema.fieldNames()).withColumn(PART, part), schema, frozenset([name]), None)

    def _write(self, table, base, folder, df, schema, parts, audit) -> Prepared:
        path = f"{self.base}/{folder}"
        df.repartition(PART).write.mode("errorifexists").partitionBy(PART).parquet(path)
        written = self.spark.read.schema(T.StructType([*schema.fields, T.StructField(PART, T.StringType())])).parquet(path)
        rows = {r[0]: r[1] for r in written.groupBy(PART).agg(F.count(F.lit(1))).collect()}
        if stray := set(rows) - parts:
            raise ValueError(f"{table}: rows outside the parts to rewrite: {sorted(stray)[:5]}")
        if audit is not None and rows:
            failures = audit.failures(written)
            if failures:
                raise AuditFailed(path, failures)
        return Prepared(table, base, folder, rows, parts)

    def publish(self, prepared: Sequence[Prepared]) -> int:
        """One manifest that names all prepared parts and, beside them, what the version before named.

        One job publishes at a time; parts made from an older version are refused.
        """
        current = self.version()
        if stale := [p.table for p in prepared if p.base != current]:
            raise Conflict(f"version {current} was published since {stale} were prepared")
        replaced = {(p.table, part) for p in prepared for part in p.replaced}
        kept = [tuple(e) for e in self.entries(current).collect() if (e.table_name, e.part) not in replaced]
        new = [(p.table, part, current + 1, p.folder, n) for p in prepared for part, n in p.rows.items()]
        target = f"{self.manifests}/v={current + 1:06d}"
        if self.wh.exists(target):     # a manifest of a publish that died, without its marker
            self.wh.delete(target)
        self.spark.createDataFrame(sorted(kept + new), MANIFEST).coalesce(1).write.mode("errorifexists").parquet(target)
        return current + 1

    def vacuum(self, retain: int = 2) -> list[str]:
        """Delete all but the newest ``retain`` manifests and the folders that those do not name; call between runs."""
        versions = self.wh.versions_at(self.manifests)
        kept, old = versions[-retain:], versions[:-retain]
        named = {e.folder for v in kept for e in self.entries(v).select("folder").distinct().collect()}
        gone = [f"{self.manifests}/v={v:06d}" for v in old]
        for table in self.wh.children(self.base):
            if table != "manifest":
                gone += [f"{self.base}/{table}/{g}" for g in self.wh.children(f"{self.base}/{table}") if f"{table}/{g}" not in named]
        for path in gone:
            self.wh.delete(path)
        return gone
