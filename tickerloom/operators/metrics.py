"""Staging and metric models: narrow projections over the enriched table."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tickerloom.contracts import METRIC_COLUMNS, STAGING_COLUMNS
from tickerloom.functions import expressions as X


def staging(enriched: DataFrame) -> DataFrame:
    return enriched.withColumnRenamed("year", "stock_year").select(*STAGING_COLUMNS)


def with_price_metrics(df: DataFrame) -> DataFrame:
    return (
        df.withColumn("yearly_return", X.yearly_return())
        .withColumn("volatility", X.volatility())
        .withColumn("risk_adj_return", X.risk_adj_return())
    )


def with_metrics(staged: DataFrame) -> DataFrame:
    """Staging columns and metrics side by side."""
    return with_price_metrics(staged).withColumn("debt_to_equity", X.debt_to_equity())


def stock_metrics(staged: DataFrame) -> DataFrame:
    return with_metrics(staged).select(*METRIC_COLUMNS)
