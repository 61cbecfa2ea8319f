"""Source registry and the month window of the monthly fact source."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

STATIC = "static_parquet"
MONTHLY = "monthly_partitioned_parquet"


# The columns of the monthly price files.
PRICES = T.StructType([
    T.StructField("date", T.DateType()),
    T.StructField("premise_code", T.LongType()),
    T.StructField("item_code", T.LongType()),
    T.StructField("price", T.DoubleType()),
])


@dataclass(frozen=True)
class Source:
    """One input: a static table read whole, or monthly files loaded incrementally.

    ``reader`` returns the static table (normally ``spark.read.parquet(path)``);
    ``path_for_month`` gives the file of one month of a monthly source.
    """
    name: str
    kind: str
    description: str = ""
    reader: Callable[[], DataFrame] | None = None
    path_for_month: Callable[[str], str] | None = None
    months: tuple[str, ...] = field(default_factory=tuple)
    schema: T.StructType | None = None  # pinned column types; files that differ are cast


def last_n_months(as_of: date, n: int = 24) -> list[str]:
    """The ``n`` completed months before ``as_of``'s month as 'YYYY-MM', ascending."""
    this = as_of.year * 12 + as_of.month - 1
    return ["%04d-%02d" % (k // 12, k % 12 + 1) for k in range(this - n, this)]


def month_window(as_of: Column, n: int = 24) -> Column:
    """Spark form of ``last_n_months``: an array of 'YYYY-MM' texts for a date column."""
    first = F.trunc(as_of, "month")
    seq = F.sequence(F.add_months(first, -n), F.add_months(first, -1), F.expr("interval 1 month"))
    return F.transform(seq, lambda d: F.date_format(d, "yyyy-MM"))


def static_parquet(spark, name: str, path: str, description: str = "") -> Source:
    return Source(name, STATIC, description, reader=lambda: spark.read.parquet(path))


def monthly_parquet(name: str, template: str, months: list[str], description: str = "",
                    schema: T.StructType | None = None) -> Source:
    """``template`` holds ``{month}``, e.g. '/landing/prices/{month}.parquet'."""
    return Source(name, MONTHLY, description,
                  path_for_month=lambda m: template.format(month=m), months=tuple(months), schema=schema)


def default_registry(spark, landing: str, as_of: date) -> dict[str, Source]:
    """The pipeline's eleven sources as files under a landing folder."""
    s = lambda n, d: static_parquet(spark, n, f"{landing}/{n}.parquet", d)
    return {
        "pricecatcher_items": s("pricecatcher_items", "item lookup"),
        "pricecatcher_premises": s("pricecatcher_premises", "premise lookup"),
        "pricecatcher_prices": monthly_parquet(
            "pricecatcher_prices", landing + "/pricecatcher_prices/{month}.parquet",
            last_n_months(as_of, 24), "monthly price records", PRICES),
        "cpi_state": s("cpi_state", "monthly CPI by state and division"),
        "cpi_national": s("cpi_national", "monthly national CPI by division"),
        "fuel_prices": s("fuel_prices", "weekly fuel prices, wide"),
        "gdp_quarterly": s("gdp_quarterly", "quarterly GDP: series, date, value"),
        "labour_force": s("labour_force", "quarterly labour force survey"),
        "vehicle_registrations": s("vehicle_registrations", "registrations by type and fuel"),
        "transport_ridership": s("transport_ridership", "daily ridership per service, wide"),
        "household_income": s("household_income", "household income by state"),
    }
