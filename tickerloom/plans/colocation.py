"""Prices, filings and the yearly roll-up of a lake once more, in buckets.

Prices lie by symbol: the roll-up and the windows over a symbol's days need no shuffle. Filings and roll-up lie by symbol and year, the
whole key of their join, as Spark joins buckets of part of the key only after a shuffle; so neither that join nor the choice of the
latest filings needs one. It pays for lakes that are read more often than loaded: ``colocate`` writes all three tables anew
when prices or filings were landed since, as a bucket holds all years of its symbols.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tickerloom.contracts import FUNDAMENTALS, PRICES
from tickerloom.operators.enrich import with_year
from tickerloom.operators.prices import prices_yearly
from tickerloom.sources import colocated, tables
from tickerloom.sources.landing import landed

PRICES_BY_KEY, FILINGS_BY_KEY, YEARLY_BY_KEY = "prices_by_symbol", "fundamentals_by_year", "yearly_by_year"
KEYS = {PRICES_BY_KEY: ["symbol"], FILINGS_BY_KEY: ["symbol", "year"], YEARLY_BY_KEY: ["symbol", "year"]}


@dataclass(frozen=True)
class Colocated:
    prices: DataFrame
    fundamentals: DataFrame
    yearly: DataFrame


def _sources(current: dict[str, tables.Version]) -> dict[str, int]:
    """The commits that published what the tables are made of."""
    return {c.name: current[f"raw_{c.name}"].commit for c in (PRICES, FUNDAMENTALS)}


def is_current(spark: SparkSession, lake: str) -> bool:
    current = tables.current_versions(spark, lake)
    return YEARLY_BY_KEY in current and current[YEARLY_BY_KEY].notes["of"] == _sources(current)


def colocate(spark: SparkSession, lake: str, buckets: int | None = None) -> bool:
    """Write and publish the three tables in one commit; False if those published are of the present loads.

    ``buckets`` follows from the bytes of the raw prices unless given. Raises ``Overtaken``, and publishes nothing, if they were
    published by another writer meanwhile.
    """
    current = tables.current_versions(spark, lake)
    seen, of = tables.last_commit(current), _sources(current)
    if YEARLY_BY_KEY in current and buckets is None and current[YEARLY_BY_KEY].notes["of"] == of:
        return False
    if buckets is None:
        n_bytes = tables.file_stats(spark, current[f"raw_{PRICES.name}"].path).first().n_bytes or 0
        buckets = colocated.buckets_for(n_bytes)

    def write(name: str, df: DataFrame) -> tables.Version:
        version = tables.next_version(lake, name, df.schema, current, "colocate", by=KEYS[name], buckets=buckets, of=of)
        return colocated.write(df, version)

    rows = {c: landed(spark, c, lake, current[f"raw_{c.name}"]).select(*c.columns) for c in (PRICES, FUNDAMENTALS)}
    prices = write(PRICES_BY_KEY, rows[PRICES])
    filings = write(FILINGS_BY_KEY, with_year(rows[FUNDAMENTALS]))
    yearly = write(YEARLY_BY_KEY, prices_yearly(colocated.read(spark, prices)))
    tables.publish(spark, lake, [prices, filings, yearly], seen)
    return True


def read(spark: SparkSession, lake: str) -> Colocated:
    """The three tables of the last commit that holds them."""
    current = tables.current_versions(spark, lake)
    return Colocated(*[colocated.read(spark, current[n]) for n in (PRICES_BY_KEY, FILINGS_BY_KEY, YEARLY_BY_KEY)])
