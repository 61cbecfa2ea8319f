"""State snapshots: export the stateful tables, restore them into an empty warehouse.

Only the history a later run needs to compare against is persisted (run
log, change log, CDC histories, the SCD2 dimension).  Restore matches
columns by name and only fills tables that are empty: a warehouse that
already holds live state keeps it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from costindex.sources.meta import RUN_LOG, read_changes, write_changes
from costindex.sources.tables import Warehouse

# The stateful tables.  table -> (layer, name, kind); kind "log" = append-only, "snapshot" = versioned
STATEFUL_TABLES = {
    "meta.pipeline_runs": ("meta", "pipeline_runs", "log"),
    "meta.change_log": ("meta", "change_log", "log"),
    "warehouse.fuel_price_history": ("warehouse", "fuel_price_history", "snapshot"),
    "warehouse.gdp_quarterly": ("warehouse", "gdp_quarterly", "snapshot"),
    "warehouse.dim_household_income": ("warehouse", "dim_household_income", "snapshot"),
}
_LOG_SCHEMAS = {"pipeline_runs": RUN_LOG}


def _read(wh: Warehouse, layer: str, name: str, kind: str) -> DataFrame | None:
    if name == "change_log":
        return read_changes(wh) if wh.exists(wh.path(layer, name)) else None
    if kind == "log":
        if not wh.exists(wh.path(layer, name)):
            return None
        return wh.read_log(layer, name, _LOG_SCHEMAS[name])
    return wh.read(layer, name) if wh.has_table(layer, name) else None


def export_state(wh: Warehouse, state_dir: str) -> list[tuple[str, int | None]]:
    """Write each existing stateful table as a new version of ``state_dir/<table>.parquet``; rows per table.

    The version before stays, so a write that dies half way loses nothing.
    """
    out = []
    for table, (layer, name, kind) in STATEFUL_TABLES.items():
        df = _read(wh, layer, name, kind)
        if df is None:
            out.append((table, None))
            continue
        target = f"{state_dir.rstrip('/')}/{table}.parquet"
        out.append((table, wh.write_at(target, df).count()))
    return out


def import_state(wh: Warehouse, state_dir: str) -> list[tuple[str, str, int | None]]:
    """Restore snapshots into empty tables; returns (table, action, rows after)."""
    out = []
    for table, (layer, name, kind) in STATEFUL_TABLES.items():
        src = f"{state_dir.rstrip('/')}/{table}.parquet"
        if not wh.has_table_at(src):
            out.append((table, "no_state_file", None))
            continue
        current = _read(wh, layer, name, kind)
        if current is not None and current.limit(1).count() > 0:
            out.append((table, "kept_local", current.count()))
            continue
        snap = wh.read_at(src)
        if current is not None:
            snap = snap.select(*current.columns)  # by name
        if name == "change_log":
            write_changes(wh, snap)
            restored = read_changes(wh)
        elif kind == "log":
            wh.append(layer, name, snap)
            restored = _read(wh, layer, name, kind)
        else:
            restored = wh.write_snapshot(layer, name, snap)
        out.append((table, "restored", restored.count()))
    return out
