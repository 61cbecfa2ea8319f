from costindex.__main__ import main
from costindex.plans.loads import STATIC_FIXTURES
from costindex.sources import fixtures
from costindex.sources.registry import last_n_months
from costindex.sources.tables import Warehouse

from conftest import SF_SMALL


def test_cli_runs_the_whole_pipeline(spark, capsys):
    wh = Warehouse(spark)
    landing = wh.path("landing", "drop")
    for name, fx_name in STATIC_FIXTURES.items():
        fixtures.ALL[fx_name](spark, SF_SMALL).write.parquet(f"{landing}/{name}.parquet")
    prices = fixtures.prices(spark, SF_SMALL)
    for m in last_n_months(__import__("datetime").date(2001, 12, 15), 24)[-3:]:
        prices.where(prices._month_partition == m).drop("_month_partition") \
            .write.parquet(f"{landing}/pricecatcher_prices/{m}.parquet")
    target = Warehouse(spark)
    main(["--landing", landing, "--warehouse", target.root, "--state", target.path("state", "s"),
          "--as-of", "2001-12-15"], spark=spark)
    assert "all passed" in capsys.readouterr().out
    score = target.read("marts", "mart_pressure_score")
    assert score.count() > 0
    loaded = target.read_partitioned("raw", "pricecatcher_prices")
    assert loaded.select("_month_partition").distinct().count() == 3


def test_cli_keeps_histories_in_a_ledger(spark, capsys):
    from costindex.plans.pipeline import FUEL_HISTORY
    from costindex.sources.ledger import Ledger
    wh = Warehouse(spark)
    landing = wh.path("landing", "drop")
    for name in ("fuel_prices", "gdp_quarterly"):
        fixtures.ALL[STATIC_FIXTURES[name]](spark, SF_SMALL).write.parquet(f"{landing}/{name}.parquet")
    target, base = Warehouse(spark), wh.path("state", "ledger")
    for day in ("2001-12-15", "2001-12-16"):    # a new warehouse each time: the ledger carries the histories over
        target = Warehouse(spark)
        main(["--landing", landing, "--warehouse", target.root, "--ledger", base, "--as-of", day,
              "--sources", "fuel_prices", "gdp_quarterly", "--no-models"], spark=spark)
    ledger = Ledger(target, base)
    assert ledger.version() == 1 and ledger.read("fuel_price_history", FUEL_HISTORY).count() > 0
