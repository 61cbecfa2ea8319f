"""Run the pipeline over a landing folder: ``python -m costindex --landing DIR [options]``.

The landing folder holds one parquet per static source (``<name>.parquet``)
and the monthly price files under ``pricecatcher_prices/<YYYY-MM>.parquet``.
Tables are written under ``--warehouse`` (default: the session's
``spark.checkpoint.dir``); ``--state`` keeps the change-capture state
between runs.
"""

from __future__ import annotations

import argparse
from datetime import datetime, timezone

from costindex.plans.pipeline import PipelineConfig, run_pipeline
from costindex.session import apply_cluster_conf, drop_staged
from costindex.sources.fixtures import SERVICES
from costindex.sources.ledger import Ledger
from costindex.sources.registry import default_registry
from costindex.sources.tables import Warehouse


def main(argv=None, spark=None) -> None:
    ap = argparse.ArgumentParser(prog="costindex")
    ap.add_argument("--landing", required=True)
    ap.add_argument("--warehouse")
    ap.add_argument("--state")
    ap.add_argument("--ledger", help="keep histories and change log here, in parts")
    ap.add_argument("--sources", nargs="*", help="load only these sources")
    ap.add_argument("--keep-versions", type=int, default=2, help="versions kept of each table")
    ap.add_argument("--as-of", help="run date YYYY-MM-DD (default: today, UTC)")
    for stage in ("restore", "extract", "cdc", "models", "tests"):
        ap.add_argument(f"--no-{stage}", action="store_true")
    args = ap.parse_args(argv)

    own = spark is None
    if own:  # a fresh job gets the cluster settings; a passed session is kept as is
        from pyspark.sql import SparkSession
        spark = apply_cluster_conf(SparkSession.builder.appName("costindex").getOrCreate())
    at = (datetime.fromisoformat(args.as_of) if args.as_of
          else datetime.now(timezone.utc).replace(tzinfo=None))
    sources = default_registry(spark, args.landing.rstrip("/"), at.date())
    if args.sources:
        sources = {k: v for k, v in sources.items() if k in args.sources}
    wh = Warehouse(spark, args.warehouse)
    out = run_pipeline(wh, sources, at, PipelineConfig(services=SERVICES, state_dir=args.state, ledger_dir=args.ledger),
                       restore=not args.no_restore, extract=not args.no_extract,
                       cdc=not args.no_cdc, models=not args.no_models, tests=not args.no_tests)
    if "tests" in out:
        failed = [r.test_name for r in out["tests"].where("failures > 0").collect()]
        if own:  # results are written: staged tables and old versions go
            drop_staged(spark)
            wh.vacuum(args.keep_versions)
            if args.ledger:
                Ledger(wh, args.ledger).vacuum(args.keep_versions)
        print(f"data tests: {'all passed' if not failed else 'FAILED ' + ', '.join(failed)}")
        if failed:
            raise SystemExit(1)


if __name__ == "__main__":
    main()
