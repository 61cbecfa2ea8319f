"""Load jobs: full refresh of static sources, incremental monthly loads.

The control flow (which source, which months) runs on the driver over
metadata only -- the source list, one watermark row per source, file
existence.  All data moves in Spark jobs: one distributed read of all
pending month files and one partition-replacing write.
"""

from __future__ import annotations

import json
import re
import sys
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import datetime
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from costindex.sources.meta import RunBook
from costindex.sources.registry import MONTHLY, STATIC, Source
from costindex.sources.tables import Warehouse

PARTITION_COL = "_month_partition"
FOOTER_THREADS = 8  # footers read at once (each is a job of one task)
# Note texts of the run log.
LOADED_TODAY = "Already loaded today"
NO_NEW_MONTHS = "No new months after {}"
LOADED_UP_TO = "Loaded up to {}"


def _text(e: Exception) -> str:
    return str(e) or type(e).__name__


def load_static(book: RunBook, source: Source, at: datetime, layer: str = "raw") -> str:
    """Replace the raw table with the source; skipped when already loaded on ``at``'s day."""
    wm = book.watermark(source.name)
    if wm is not None and wm.last_loaded_at is not None \
            and wm.last_loaded_at.date() == at.date():
        book.log_run(source.name, at, "skipped", notes=LOADED_TODAY)
        return "skipped"
    try:
        written = book.wh.write_snapshot(layer, source.name, without_nan(source.reader()))
        rows = written.count()  # answered from parquet footers
        book.upsert_watermark(source.name, at, rows)
        book.log_run(source.name, at, "success", rows_loaded=rows, new_rows=rows)
        return "success"
    except Exception as e:  # noqa: BLE001 -- a failed source is logged, the run goes on
        book.log_run(source.name, at, "failed", error=_text(e))
        print(f"[{source.name}] failed: {_text(e)}", file=sys.stderr)
        return "failed"


def month_of_file(source: Source):
    """The month a row came from, read off its file path (one scan for all months).

    The path segment of the month template that holds ``{month}`` becomes a
    pattern; a template whose month is not in a path segment falls back to
    one tagged scan per month.
    """
    probe = source.path_for_month("\x00")
    seg = next((part for part in probe.split("/") if "\x00" in part), None)
    if seg is None:
        raise ValueError("month template must put the month in the path")
    pattern = re.escape(seg).replace(re.escape("\x00"), r"(\d{4}-\d{2})")
    return F.regexp_extract(F.col("_metadata.file_path"), pattern, 1)


def pending_months(source: Source, watermark_month: str | None) -> list[str]:
    return [m for m in source.months if watermark_month is None or m > watermark_month]


def loaded_months(book: RunBook, source: Source, layer: str = "raw") -> set[str]:
    """Months present in the raw table (partition folder names: metadata only)."""
    return folder_values(book.wh, book.wh.path(layer, source.name), PARTITION_COL)


def folder_values(wh: Warehouse, base: str, column: str) -> set[str]:
    """Values of a partition column, from folder names."""
    return {c[len(column) + 1:] for c in wh._children(base) if c.startswith(f"{column}=")}


def without_nan(df: DataFrame) -> DataFrame:
    """The rule for all loaded data: NaN is no value."""
    floats = {f.name for f in df.schema.fields if f.dataType.typeName() in ("float", "double")}
    if not floats:
        return df
    return df.select(*[F.when(~F.isnan(F.col(_quoted(c))), F.col(_quoted(c))).alias(c) if c in floats else F.col(_quoted(c))
                       for c in df.columns])


def _quoted(name: str) -> str:
    return f"`{name.replace('`', '``')}`"


@dataclass(frozen=True)
class MonthPlan:
    """What the footers of a month's files say: files by their own schema, or why the month is refused."""
    files: dict[str, list[str]] = field(default_factory=dict)   # schema as JSON -> files
    refused: str | None = None


def _contract(book: RunBook, source: Source, layer: str, schemas: dict[str, T.StructType]) -> T.StructType | None:
    """The columns a month must have: the pinned ones, else those of the raw table, else of the first month that can be read."""
    if source.schema is not None:
        return source.schema
    if loaded_months(book, source, layer):
        have = book.wh.read_partitioned(layer, source.name).schema
        return T.StructType([f for f in have.fields if f.name != PARTITION_COL])
    return next((schemas[f] for f in sorted(schemas)), None)


def plan_months(book: RunBook, source: Source, layer: str, paths: dict[str, str]) -> tuple[T.StructType | None, dict[str, MonthPlan]]:
    """Read the footer of every pending file, side by side, and decide per month before any data is read.

    A month is refused when a file cannot be read, lacks a column of the
    contract (also a renamed one), or has one of a type that cannot be cast to
    the contract's; further columns are left out.
    """
    files = {m: book.wh.data_files(path) for m, path in paths.items()}

    def footer(path: str) -> T.StructType | str:
        try:
            return book.spark.read.parquet(path).schema
        except Exception as e:  # noqa: BLE001 -- the reason to refuse the file's month
            return _text(e)

    with ThreadPoolExecutor(FOOTER_THREADS) as pool:
        every = [f for own in files.values() for f in own]
        found = dict(zip(every, pool.map(footer, every)))
    contract = _contract(book, source, layer, {f: x for f, x in found.items() if isinstance(x, T.StructType)})
    plans = {}
    unfit: dict[str, str | None] = {}  # by schema: files of one writer share theirs
    for month, own in files.items():
        refused = None if own else "no data file"
        by_schema: dict[str, list[str]] = {}
        for f in own:
            if isinstance(found[f], str):
                refused = refused or found[f]
                continue
            schema = found[f].json()
            if schema not in unfit:
                unfit[schema] = _mismatch(book.spark, found[f], contract)
            refused = refused or unfit[schema]
            by_schema.setdefault(schema, []).append(f)
        plans[month] = MonthPlan(by_schema, refused)
    return contract, plans


def _mismatch(spark, have: T.StructType, contract: T.StructType) -> str | None:
    names = {f.name.lower() for f in have.fields}
    missing = [f.name for f in contract.fields if f.name.lower() not in names]
    if missing:
        return f"columns missing: {', '.join(missing)}"
    try:
        _as_contract(spark.createDataFrame([], have), contract)  # analysis only
    except AnalysisException as e:
        return _text(e)
    return None


def _as_contract(df: DataFrame, contract: T.StructType) -> DataFrame:
    """The contract's columns, cast to its types where the file's own differ."""
    have = {f.name.lower(): f for f in df.schema.fields}
    return df.select(*[F.col(_quoted(own.name)).cast(f.dataType).alias(f.name) if own.dataType != f.dataType
                       else F.col(_quoted(own.name)).alias(f.name)
                       for f in contract.fields for own in [have[f.name.lower()]]])


def _month_frame(book: RunBook, month: str, plan: MonthPlan, contract: T.StructType) -> DataFrame:
    parts = [_as_contract(book.spark.read.schema(T.StructType.fromJson(json.loads(schema))).parquet(*files), contract)
             for schema, files in plan.files.items()]
    return without_nan(reduce(DataFrame.unionByName, parts)).withColumn(PARTITION_COL, F.lit(month))


def _load_files(book: RunBook, source: Source, layer: str, paths: dict[str, str]) -> dict[str, str]:
    """Replace the months' partitions; returns the months that failed with their whole errors.

    After the footers are compared, the months whose files all have the
    contract's types are read and written in one job.  The others are cast and
    loaded one by one, and so is every month when that job fails (data that
    cannot be read or cast), so only the bad months are skipped.
    """
    contract, plans = plan_months(book, source, layer, paths)
    failed = {m: p.refused for m, p in plans.items() if p.refused}
    plain, single = {}, []
    for month in (m for m in paths if m not in failed):
        schemas = [T.StructType.fromJson(json.loads(x)) for x in plans[month].files]
        same = all(len(x) == len(contract) and {f.name: f.dataType for f in x} == {f.name: f.dataType for f in contract} for x in schemas)
        if same:
            plain[month] = [f for own in plans[month].files.values() for f in own]
        else:
            single.append(month)
    if plain:
        try:
            rows = book.spark.read.schema(contract).parquet(*[f for own in plain.values() for f in own])
            rows = rows.select("*", F.col("_metadata.file_path")).withColumn(PARTITION_COL, month_of_file(source))
            book.wh.replace_partitions(layer, source.name, without_nan(rows.drop("file_path")), PARTITION_COL)
        except Exception:  # noqa: BLE001 -- found again below, for its month
            single = [*plain, *single]
    for month in single:
        try:
            book.wh.replace_partitions(layer, source.name, _month_frame(book, month, plans[month], contract), PARTITION_COL)
        except Exception as e:  # noqa: BLE001 -- a failed month is logged, the others are loaded
            failed[month] = _text(e)
    for month, error in failed.items():
        print(f"[{source.name}] {month}: {error} -- skipping", file=sys.stderr)
    return failed


def load_monthly(book: RunBook, source: Source, at: datetime, layer: str = "raw",
                 retry_gaps: bool = False) -> str:
    """Load the window's months newer than the watermark; a missing month is skipped.

    All pending month files are read in one job (each tagged with its month)
    and written with dynamic partition overwrite, so re-loading a month
    replaces it and leaves every other month untouched.  A month that cannot
    be loaded is skipped; its whole error is in the run row.  By default a month
    is pending when it is newer than the watermark (a month that failed
    before a later one loaded is not retried); ``retry_gaps`` instead loads
    every window month that the raw table does not hold yet.
    """
    wm = book.watermark(source.name)
    done = wm.last_max_date if wm is not None else None
    if retry_gaps:
        have = loaded_months(book, source, layer)
        months = [m for m in source.months if m not in have]
    else:
        months = pending_months(source, done)
    if not months:
        book.log_run(source.name, at, "skipped", notes=NO_NEW_MONTHS.format(done))
        return "skipped"
    paths: dict[str, str] = {}
    for m in months:
        path = source.path_for_month(m)
        if not book.wh.exists(path):
            print(f"[{source.name}] {m}: missing {path} -- skipping", file=sys.stderr)
            continue
        paths[m] = path
    failed = _load_files(book, source, layer, paths) if paths else {}
    loaded = [m for m in paths if m not in failed]
    errors = "\n".join(f"{m}: {failed[m]}" for m in sorted(failed)) or None
    last = max([m for m in loaded + [done] if m]) if (loaded or done) else None
    if not last or (failed and not loaded):
        if errors:
            book.log_run(source.name, at, "failed", error=errors)
        return "failed"
    table = book.wh.read_partitioned(layer, source.name)
    total = table.count()
    new_rows = table.where(F.col(PARTITION_COL).isin(loaded)).count() if loaded else 0
    book.upsert_watermark(source.name, at, total, last)
    book.log_run(source.name, at, "success", rows_loaded=total, new_rows=new_rows, error=errors,
                 notes=LOADED_UP_TO.format(last))
    return "success"


def reload_month(book: RunBook, source: Source, month: str, batch: DataFrame,
                 layer: str = "raw") -> None:
    """Replace one month of the raw table (idempotent re-run of a month)."""
    book.wh.replace_partitions(layer, source.name, without_nan(batch).withColumn(PARTITION_COL, F.lit(month)),
                               PARTITION_COL)


def run_all(book: RunBook, sources: dict[str, Source], at: datetime,
            only: list[str] | None = None) -> dict[str, str]:
    """Load every source (or the named subset); unknown kinds are skipped."""
    out = {}
    with book.batch():  # bookkeeping rows of the whole run are written once
        for name, src in sources.items():
            if only is not None and name not in only:
                continue
            if src.kind == STATIC:
                out[name] = load_static(book, src, at)
            elif src.kind == MONTHLY:
                out[name] = load_monthly(book, src, at)
            else:
                print(f"[{name}] unknown source type {src.kind!r} -- skipping", file=sys.stderr)
    return out
