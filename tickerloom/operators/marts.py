"""The two published marts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerloom.contracts import FUNDAMENTALS_MART_COLUMNS
from tickerloom.operators.enrich import filings_per_year
from tickerloom.operators.metrics import with_price_metrics


def sector_performance(metrics: DataFrame) -> DataFrame:
    """Row-weighted averages per sector; a null sector is a group of its own."""
    return metrics.groupBy("sector").agg(
        F.avg("yearly_return").alias("avg_yearly_return"),
        F.avg("volatility").alias("avg_volatility"),
        F.avg("risk_adj_return").alias("avg_risk_adj_return"),
    )


AVERAGED = ("yearly_return", "volatility", "risk_adj_return")


def sector_years(metrics: DataFrame) -> DataFrame:
    """Sums and counts per sector and year, from which the sector mart follows.

    A few rows a year: a refresh replaces those of the years it touches.
    """
    parts = [f(c).alias(f"{n}_{c}") for c in AVERAGED for f, n in ((F.sum, "sum"), (F.count, "n"))]
    return metrics.groupBy("sector", "stock_year").agg(*parts)


def sector_performance_of_years(years: DataFrame) -> DataFrame:
    """``sector_performance`` from the sums and counts of all years."""
    return years.groupBy("sector").agg(
        *[F.try_divide(F.sum(f"sum_{c}"), F.sum(f"n_{c}")).alias(f"avg_{c}") for c in AVERAGED]
    )


def sector_performance_by_counts(
    yearly: DataFrame, fundamentals: DataFrame, securities: DataFrame
) -> DataFrame:
    """``sector_performance`` straight from the sources, without the filing fan-out.

    The averaged ratios depend on prices only, so each symbol-year enters once with its
    number of filings as weight. Filings are counted map-side before they are shuffled,
    so many filings under one key cost nothing, and no filing column but its date is read.
    """
    described = yearly.join(securities.select("symbol", "sector"), "symbol", "inner")
    counted = with_price_metrics(
        described.join(filings_per_year(fundamentals), ["symbol", "year"], "inner")
    )
    weight = F.col("n_filings")

    def weighted_avg(name: str):
        value = F.col(name)
        return F.try_divide(
            F.sum(value * weight), F.sum(F.when(value.isNotNull(), weight))
        ).alias(f"avg_{name}")

    return counted.groupBy("sector").agg(
        weighted_avg("yearly_return"),
        weighted_avg("volatility"),
        weighted_avg("risk_adj_return"),
    )


def fundamentals_vs_return(metrics: DataFrame) -> DataFrame:
    """A set: ordering belongs to the reports that read it."""
    return metrics.select(*FUNDAMENTALS_MART_COLUMNS)
