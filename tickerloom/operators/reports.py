"""Data behind each report: rankings, KPIs, chart feeds, formatted tables, top lists."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickerloom.functions.expressions import fixed, nulls_last, percent
from tickerloom.operators.skew import sort_globally

# Chart limits and length of the top list.
EPS_LIMITS = (-50, 50)
DEBT_TO_EQUITY_LIMITS = (0, 5)
TOP_N = 10
# Labels shown to the user.
LABELS = {
    "sector": "Sector",
    "avg_yearly_return": "Avg Yearly Return",
    "avg_volatility": "Avg Volatility",
    "avg_risk_adj_return": "Risk-Adj Return",
    "company_name": "Company",
    "yearly_return": "Yearly Return",
    "eps": "EPS",
    "gross_margin": "Gross Margin",
    "debt_to_equity": "Debt/Equity",
}
SHARPE_SUFFIX = " Sharpe proxy"


def _ranking() -> list[Column]:
    """Best first; a missing value ranks last and the name decides between equals."""
    return [F.col("avg_risk_adj_return").desc_nulls_last(), *nulls_last("sector")]


def sector_ranking(sectors: DataFrame) -> DataFrame:
    """Sector mart, best risk-adjusted return first, with its position.

    The window has no partition: its input is the mart, one row per sector of a fixed
    classification of about a dozen names.
    """
    position = F.row_number().over(Window.orderBy(*_ranking()))
    return sectors.select(position.alias("position"), "*").orderBy("position")


def fundamentals_listing(mart: DataFrame) -> DataFrame:
    return sort_globally(mart, *nulls_last("stock_year", "company_name"))


def kpis(sectors: DataFrame, mart: DataFrame) -> DataFrame:
    """The headline figures as one row of display strings.

    Sector rows and distinct company names are stacked and aggregated once. Between
    equal sectors the one that ranks higher wins.
    """
    ret, vol, risk = (F.col(f"avg_{c}") for c in ("yearly_return", "volatility", "risk_adj_return"))
    rank = [risk.isNull(), -risk, F.col("sector")]
    is_sector = F.col("is_sector")
    companies = mart.select("company_name").filter(F.col("company_name").isNotNull()).distinct()
    stacked = sectors.withColumn("is_sector", F.lit(True)).unionByName(
        companies, allowMissingColumns=True
    )
    first_by_rank = F.when(is_sector, F.struct(*rank))
    return stacked.agg(
        F.min_by("sector", first_by_rank).alias("best_sector"),
        F.min_by(risk, first_by_rank).alias("_best_risk"),
        F.max_by("sector", first_by_rank).alias("worst_sector"),
        F.max(ret).alias("_best_return"),
        F.min_by("sector", F.when(ret.isNotNull(), F.struct(-ret, *rank))).alias("best_return_sector"),
        F.min(vol).alias("_low_volatility"),
        F.min_by("sector", F.when(vol.isNotNull(), F.struct(vol, *rank))).alias("low_volatility_sector"),
        F.count("company_name").alias("_companies"),
    ).select(
        "best_sector",
        F.concat(fixed(F.col("_best_risk"), 2), F.lit(SHARPE_SUFFIX)).alias("best_sector_value"),
        "worst_sector",
        percent(F.col("_best_return")).alias("best_return"),
        "best_return_sector",
        fixed(F.col("_low_volatility"), 2).alias("low_volatility"),
        "low_volatility_sector",
        F.format_number("_companies", 0).alias("companies_tracked"),
    )


def sector_bar(sectors: DataFrame) -> DataFrame:
    return sectors.select("sector", "avg_risk_adj_return").orderBy(
        *nulls_last("avg_risk_adj_return", "sector")
    )


def return_vs_volatility(sectors: DataFrame) -> DataFrame:
    return sectors.select("sector", "avg_volatility", "avg_yearly_return", "avg_risk_adj_return")


def sector_table(sectors: DataFrame) -> DataFrame:
    """The sector ranking as display strings under display labels."""
    return sectors.orderBy(*_ranking()).select(
        F.col("sector").alias(LABELS["sector"]),
        percent(F.col("avg_yearly_return")).alias(LABELS["avg_yearly_return"]),
        fixed(F.col("avg_volatility"), 2).alias(LABELS["avg_volatility"]),
        fixed(F.col("avg_risk_adj_return"), 3).alias(LABELS["avg_risk_adj_return"]),
    )


def eps_vs_return(mart: DataFrame) -> DataFrame:
    return mart.filter(F.col("eps").between(*EPS_LIMITS)).select(
        "eps", "yearly_return", "gross_margin", "company_name", "stock_year"
    )


def debt_vs_return(mart: DataFrame) -> DataFrame:
    return mart.filter(F.col("debt_to_equity").between(*DEBT_TO_EQUITY_LIMITS)).select(
        "debt_to_equity", "yearly_return", "company_name", "stock_year"
    )


def years(mart: DataFrame) -> DataFrame:
    """Distinct years in order, the latest marked as default (a set of calendar years)."""
    return (
        mart.agg(F.array_sort(F.collect_set("stock_year")).alias("years"))
        .select("years", F.explode("years").alias("stock_year"))
        .select(
            "stock_year",
            (F.col("stock_year") == F.element_at("years", -1)).cast("int").alias("is_default"),
        )
    )


def _top_order() -> list[Column]:
    return [
        F.col("yearly_return").desc_nulls_last(),
        *nulls_last("company_name", "eps", "gross_margin", "debt_to_equity"),
    ]


def top_performers(mart: DataFrame, year: int | None = None, n: int = TOP_N) -> DataFrame:
    """The ``n`` best yearly returns of one year, by default the latest, for display.

    The latest year comes first in the order of the top list, so the mart is planned once.
    """
    if year is None:
        year_order, wanted = [F.col("stock_year").desc()], F.col("stock_year").isNotNull()
    else:
        year_order, wanted = [], F.col("stock_year") == F.lit(year)
    return (
        mart.filter(wanted)
        .orderBy(*year_order, *_top_order())
        .limit(n)
        .withColumn("_latest", F.max("stock_year").over(Window.partitionBy()))  # of n rows
        .filter(F.col("stock_year") == F.col("_latest"))
        .select(
            F.col("company_name").alias(LABELS["company_name"]),
            percent(F.col("yearly_return")).alias(LABELS["yearly_return"]),
            F.col("eps").alias(LABELS["eps"]),
            F.col("gross_margin").alias(LABELS["gross_margin"]),
            F.col("debt_to_equity").alias(LABELS["debt_to_equity"]),
        )
    )


def top_performers_all_years(mart: DataFrame, n: int = TOP_N) -> DataFrame:
    """The top list of every year at once; each map task forwards at most ``n`` rows a year."""
    position = F.row_number().over(Window.partitionBy("stock_year").orderBy(*_top_order()))
    return (
        mart.filter(F.col("stock_year").isNotNull())
        .withColumn("position", position)
        .filter(F.col("position") <= n)
        .select(
            "stock_year", "position", "company_name", "yearly_return",
            "eps", "gross_margin", "debt_to_equity",
        )
    )


@contextmanager
def cached(*marts: DataFrame) -> Iterator[tuple[DataFrame, ...]]:
    """Keep the marts cached while several reports read them."""
    kept = tuple(mart.persist() for mart in marts)
    try:
        yield kept
    finally:
        for mart in kept:
            mart.unpersist()


def report_pack(sectors: DataFrame, mart: DataFrame, year: int | None = None) -> dict[str, DataFrame]:
    """All reports over the two marts, by name."""
    return {
        "kpis": kpis(sectors, mart),
        "sector_ranking": sector_ranking(sectors),
        "sector_bar": sector_bar(sectors),
        "return_vs_volatility": return_vs_volatility(sectors),
        "sector_table": sector_table(sectors),
        "fundamentals": fundamentals_listing(mart),
        "eps_vs_return": eps_vs_return(mart),
        "debt_vs_return": debt_vs_return(mart),
        "years": years(mart),
        "top_performers": top_performers(mart, year),
        "top_performers_all_years": top_performers_all_years(mart),
    }
