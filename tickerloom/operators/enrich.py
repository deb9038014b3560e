"""Joins of the yearly prices with filings and security master data."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickerloom.contracts import ENRICHED_COLUMNS


def with_year(fundamentals: DataFrame) -> DataFrame:
    """Filings with their fiscal year, which tables that are bucketed by it have already."""
    if "year" in fundamentals.columns:
        return fundamentals
    return fundamentals.withColumn("year", F.year("period_ending"))


def latest_filings(fundamentals: DataFrame, tie_breakers: tuple[str, ...] = ()) -> DataFrame:
    """The latest filing of each (symbol, fiscal year).

    ``row_number() = 1`` makes Spark keep one row per key and map task before the
    shuffle, so a key with very many filings never meets in one task. Without
    ``tie_breakers`` the remaining columns decide between filings of the same day.
    """
    ties = tie_breakers or tuple(c for c in fundamentals.columns if c != "period_ending")
    newest_first = Window.partitionBy("symbol", "year").orderBy(
        F.col("period_ending").desc(), *[F.col(c).desc_nulls_last() for c in ties]
    )
    return (
        with_year(fundamentals)
        .withColumn("_rank", F.row_number().over(newest_first))
        .filter(F.col("_rank") == 1)
        .select(*fundamentals.columns)
    )


def join_prices_fundamentals(yearly: DataFrame, fundamentals: DataFrame) -> DataFrame:
    """Inner join on symbol and fiscal year; several filings in a year give several rows.

    ``yearly`` should be a written roll-up, as runs and queries pass it: small (a row per symbol-year), and both
    inputs of a shuffled join then come straight from a scan, which is what lets AQE split a symbol-year that holds a
    large share of the filings. Right above its aggregate the join would reuse that one's shuffle, which AQE leaves whole.
    """
    return with_year(fundamentals).join(yearly, ["symbol", "year"], "inner")


def stocks_enriched(
    yearly: DataFrame, fundamentals: DataFrame, securities: DataFrame
) -> DataFrame:
    """Yearly prices with filings and security attributes, 16 columns.

    ``securities`` joins the yearly prices, the smaller side, before the filings fan
    them out. It carries no broadcast hint: Spark broadcasts it below
    ``spark.sql.autoBroadcastJoinThreshold`` and otherwise sort-merges, where a symbol
    has one row per year.
    """
    described = yearly.join(securities, "symbol", "inner")
    return join_prices_fundamentals(described, fundamentals).select(*ENRICHED_COLUMNS)


def filings_per_year(fundamentals: DataFrame) -> DataFrame:
    return fundamentals.groupBy("symbol", F.year("period_ending").alias("year")).agg(
        F.count(F.lit(1)).alias("n_filings")
    )
