"""Do fundamentals relate to return, and which returns come from low prices."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerloom.operators.metrics import with_price_metrics
from tickerloom.operators.ranking import percent_ranks

FACTORS = ("eps", "gross_margin", "debt_to_equity")


def factor_correlation(metrics: DataFrame, by: str | None = "sector") -> DataFrame:
    """Correlation and regression slope of yearly return on each factor, per group or overall.

    One pass over the rows; the statistics aggregate map-side.
    """
    columns = []
    for factor in FACTORS:
        columns += [
            F.corr("yearly_return", factor).alias(f"{factor}|corr"),
            F.regr_slope("yearly_return", factor).alias(f"{factor}|slope"),
            F.regr_count("yearly_return", factor).alias(f"{factor}|n"),
        ]
    keys = [by] if by else []
    wide = metrics.groupBy(*keys).agg(*columns)
    per_factor = [
        F.struct(
            F.lit(factor).alias("factor"),
            F.col(f"{factor}|n").alias("n_pairs"),
            F.col(f"{factor}|corr").alias("correlation"),
            F.col(f"{factor}|slope").alias("slope"),
        )
        for factor in FACTORS
    ]
    return wide.select(*keys, F.inline(F.array(*per_factor)))


def outlier_returns(
    yearly: DataFrame, low_price: float = 5.0, extreme_return: float = 2.0
) -> DataFrame:
    """Symbol-years whose low first close goes with an extreme return, with its percent rank.

    The rank counts all symbols of the year; only flagged rows are joined to it. ``yearly`` is
    a stored roll-up.
    """
    returns = with_price_metrics(yearly)
    ranks = percent_ranks(returns, "year", "yearly_return")
    flagged = returns.filter(
        (F.col("first_close") < low_price) & (F.col("yearly_return") >= extreme_return)
    )
    return flagged.join(ranks, ["year", "yearly_return"]).select(
        "symbol", "year", "first_close", "yearly_return", "percent_rank"
    )
