"""Run bookkeeping: run log, watermarks (high-water marks), change log."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from costindex.sources.tables import Warehouse

# Columns of the bookkeeping tables and the form of a run id.
RUN_LOG = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("source_name", T.StringType()),
    T.StructField("run_at", T.TimestampNTZType()),
    T.StructField("status", T.StringType()),
    T.StructField("rows_loaded", T.LongType()),
    T.StructField("new_rows", T.LongType()),
    T.StructField("error_message", T.StringType()),
    T.StructField("notes", T.StringType()),
])
WATERMARKS = T.StructType([
    T.StructField("source_name", T.StringType()),
    T.StructField("last_loaded_at", T.TimestampNTZType()),
    T.StructField("last_max_date", T.StringType()),
    T.StructField("row_count", T.LongType()),
])
CHANGE_LOG = T.StructType([
    T.StructField("detected_at", T.TimestampNTZType()),
    T.StructField("source_name", T.StringType()),
    T.StructField("entity_key", T.StringType()),
    T.StructField("field_name", T.StringType()),
    T.StructField("old_value", T.StringType()),
    T.StructField("new_value", T.StringType()),
    T.StructField("change_type", T.StringType()),
])


def run_id(source_name: str, at: datetime) -> str:
    return f"{source_name}__{at.strftime('%Y%m%dT%H%M%S%f')}"


class RunBook:
    """Bookkeeping tables of one warehouse (all tiny: one row per source or per run).

    Inside ``with book.batch():`` run-log rows and watermark updates are held
    on the driver (a few rows of metadata) and written once when the block
    ends; watermark reads inside the block see the pending values.
    """

    def __init__(self, wh: Warehouse):
        self.wh = wh
        self.spark = wh.spark
        self._depth = 0
        self._runs: list[tuple] = []
        self._marks: dict[str, tuple] = {}

    # batching --------------------------------------------------------------------
    def batch(self):
        book = self

        class _Batch:
            def __enter__(self):
                book._depth += 1
                return book

            def __exit__(self, *exc):
                book._depth -= 1
                if book._depth == 0:
                    book.flush()
                return False
        return _Batch()

    def flush(self) -> None:
        if self._runs:
            self.wh.append("meta", "pipeline_runs", self.spark.createDataFrame(self._runs, RUN_LOG))
            self._runs = []
        if self._marks:
            new = self.spark.createDataFrame(list(self._marks.values()), WATERMARKS)
            self.write_watermarks(upsert_latest(self._stored_watermarks(), new, ["source_name"]))
            self._marks = {}

    # run log ---------------------------------------------------------------------
    def log_run(self, source_name: str, at: datetime, status: str, rows_loaded: int = 0,
                new_rows: int = 0, error: str | None = None, notes: str | None = None) -> None:
        row = (run_id(source_name, at), source_name, at, status, int(rows_loaded),
               int(new_rows), error, notes)
        self._runs.append(row)
        if self._depth == 0:
            self.flush()

    def runs(self) -> DataFrame:
        """Run log; a repeated run_id keeps its last row (insert-or-replace)."""
        if self._depth == 0:
            self.flush()
        log = self.wh.read_log("meta", "pipeline_runs", RUN_LOG)
        w = Window.partitionBy("run_id").orderBy(F.col("run_at").desc())
        return log.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")

    # watermarks -------------------------------------------------------------------
    def _stored_watermarks(self) -> DataFrame:
        if self.wh.has_table("meta", "source_watermarks"):
            return self.wh.read("meta", "source_watermarks")
        return self.spark.createDataFrame([], WATERMARKS)

    def watermarks(self) -> DataFrame:
        self.flush() if self._depth == 0 else None
        stored = self._stored_watermarks()
        if not self._marks:
            return stored
        pending = self.spark.createDataFrame(list(self._marks.values()), WATERMARKS)
        return upsert_latest(stored, pending, ["source_name"])

    def watermark(self, source_name: str):
        if source_name in self._marks:
            return T.Row(**dict(zip(WATERMARKS.fieldNames(), self._marks[source_name])))
        rows = self._stored_watermarks().where(
            F.col("source_name") == source_name).limit(1).collect()
        return rows[0] if rows else None

    def upsert_watermark(self, source_name: str, at: datetime, row_count: int,
                         max_date: str | None = None) -> None:
        self._marks[source_name] = (source_name, at, max_date, int(row_count))
        if self._depth == 0:
            self.flush()

    def write_watermarks(self, df: DataFrame) -> None:
        self.wh.write_snapshot("meta", "source_watermarks", df.coalesce(1))

    # change log -------------------------------------------------------------------
    def append_changes(self, events_with_time: DataFrame) -> None:
        """Write the events of whole runs; writing a run again replaces it (one folder per ``detected_at``)."""
        write_changes(self.wh, events_with_time)

    def changes(self) -> DataFrame:
        return read_changes(self.wh)


RUN_COL = "run"


def write_changes(wh: Warehouse, events: DataFrame) -> None:
    run = F.date_format("detected_at", "yyyyMMdd'T'HHmmssSSSSSS")
    wh.replace_partitions("meta", "change_log", events.select(*CHANGE_LOG.fieldNames(), run.alias(RUN_COL)), RUN_COL)


def read_changes(wh: Warehouse) -> DataFrame:
    schema = T.StructType([*CHANGE_LOG.fields, T.StructField(RUN_COL, T.StringType())])
    return wh.read_log("meta", "change_log", schema).drop(RUN_COL)


def upsert_latest(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Keyed upsert: rows of ``new`` replace rows of ``old`` with the same key."""
    both = old.withColumn("_pri", F.lit(0)).unionByName(new.withColumn("_pri", F.lit(1)))
    w = Window.partitionBy(*keys).orderBy(F.col("_pri").desc())
    return both.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn", "_pri")
