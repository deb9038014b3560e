"""Price operators: yearly roll-up, per-row first/last close, daily returns and risk.

Window partitions here are one symbol or one symbol-year. The price grain is one row per
(symbol, date), which every run checks within the roll-up's pass, so a partition holds at most 366
rows per calendar year however the symbols are distributed. Rows without a symbol belong to no
group: windows spread them by their values, keep them and give them no value of a group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, WindowSpec
from pyspark.sql import functions as F

NO_DATE = "9999-12-31"  # stands for a missing date where rows are ordered by date
TRADING_DAYS = 252  # fixed value: trading days per year, to annualise


def daily_range(prices: DataFrame) -> DataFrame:
    return prices.select("symbol", "date", (F.col("high") - F.col("low")).alias("daily_range"))


def prices_yearly(prices: DataFrame) -> DataFrame:
    """One row per (symbol, year): close of the first and last day, average daily range.

    ``min_by``/``max_by`` aggregate map-side, so the shuffle carries one row per
    symbol-year and map task instead of every price row, and nothing is sorted. A null
    close on the first day stays null, as the first value of the ordered year would.
    A row without a date belongs to a null year, which no filing joins.
    """
    return _yearly(prices)


def _yearly(prices: DataFrame, *more: Column) -> DataFrame:
    day = F.coalesce("date", F.lit(NO_DATE).cast("date"))  # a null order key would be skipped
    return prices.groupBy("symbol", F.year("date").alias("year")).agg(
        F.min_by("close", day).alias("first_close"),
        F.max_by("close", day).alias("last_close"),
        F.avg(F.col("high") - F.col("low")).alias("avg_daily_range"),
        *more,
    )


def prices_yearly_with_grain(prices: DataFrame) -> DataFrame:
    """``prices_yearly`` with the rows and distinct days of each symbol-year, in the same pass.

    Days are bits of six longs, which merge map-side; the days of a symbol-year are distinct
    if there are as many as rows with a date.
    """
    words = [
        F.expr(
            "bit_or(CASE WHEN (dayofyear(date) - 1) DIV 64 = "
            f"{w} THEN shiftleft(1L, int((dayofyear(date) - 1) % 64)) END)"
        )
        for w in range(6)
    ]
    days = sum((F.coalesce(F.bit_count(w), F.lit(0)) for w in words), F.lit(0))
    return _yearly(
        prices, F.count("date").alias("n_rows"), days.alias("n_days"), F.max("date").alias("last_day")
    )


def prices_yearly_sql(spark: SparkSession) -> DataFrame:
    """The same roll-up through ``spark.sql`` over a registered ``prices`` view."""
    return spark.sql(
        f"""
        SELECT symbol, year(date) AS year,
               min_by(close, coalesce(date, DATE '{NO_DATE}')) AS first_close,
               max_by(close, coalesce(date, DATE '{NO_DATE}')) AS last_close,
               avg(high - low) AS avg_daily_range
        FROM prices
        GROUP BY symbol, year(date)
        """
    )


def _spread() -> Column:
    """Null for rows of a symbol; for rows without one a number that parts them."""
    return F.when(F.col("symbol").isNull(), F.xxhash64("date", "close", F.spark_partition_id()))


def _of_symbol(value: Column) -> Column:
    return F.when(F.col("symbol").isNotNull(), value)


def _year_of_symbol(*more: str) -> WindowSpec:
    return Window.partitionBy("symbol", F.year("date"), *more).orderBy("date")


def _first_close(year: WindowSpec) -> Column:
    return F.first("close").over(year)


def _last_close(year: WindowSpec) -> Column:
    return F.last("close").over(
        year.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    )


def with_first_close(prices: DataFrame) -> DataFrame:
    """Every price row with the close of its symbol's first day of the year."""
    first = _of_symbol(_first_close(_year_of_symbol("_spread")))
    return prices.withColumn("_spread", _spread()).withColumn("first_close", first).drop("_spread")


def with_last_close(prices: DataFrame) -> DataFrame:
    """Every price row with the close of its symbol's last day of the year."""
    last = _of_symbol(_last_close(_year_of_symbol("_spread")))
    return prices.withColumn("_spread", _spread()).withColumn("last_close", last).drop("_spread")


def prices_yearly_windowed(prices: DataFrame) -> DataFrame:
    """The roll-up of all symbols in window form, kept as a cross-check of ``prices_yearly``."""
    year = _year_of_symbol()
    rows = prices.filter(F.col("symbol").isNotNull()).select(
        "*", _first_close(year).alias("first_close"), _last_close(year).alias("last_close")
    )
    return rows.groupBy("symbol", F.year("date").alias("year")).agg(
        F.max("first_close").alias("first_close"),
        F.max("last_close").alias("last_close"),
        F.avg(F.col("high") - F.col("low")).alias("avg_daily_range"),
    )


def _days_of_symbol(*more: str) -> WindowSpec:
    return Window.partitionBy("symbol", *more).orderBy(F.col("date").asc_nulls_last())


def _return(days: WindowSpec) -> Column:
    previous = F.lag("close").over(days)
    return F.try_divide(F.col("close") - previous, previous)


def _with_returns(prices: DataFrame) -> DataFrame:
    change = _of_symbol(_return(_days_of_symbol("_spread")))
    return prices.withColumn("_spread", _spread()).withColumn("daily_return", change)


def daily_returns(prices: DataFrame) -> DataFrame:
    """Close-to-close return of each trading day; NULL on a symbol's first day."""
    return _with_returns(prices).select("symbol", "date", "close", "daily_return")


def rolling_volatility(prices: DataFrame, days: int = 20) -> DataFrame:
    """Sample standard deviation of the last ``days`` daily returns, NULL until there are that many."""
    recent = _days_of_symbol("_spread").rowsBetween(1 - days, 0)
    observed = F.count("daily_return").over(recent)
    sigma = F.stddev_samp("daily_return").over(recent)
    return _with_returns(prices).select(
        "symbol", "date", "daily_return", F.when(observed == days, sigma).alias("rolling_sigma")
    )


def daily_risk(prices: DataFrame, days: int) -> DataFrame:
    """All rows of symbols with their daily return and rolling volatility, other columns unchanged.

    Several closes of a day stand in ascending order, so the result does not depend on how rows were read.
    """
    order = Window.partitionBy("symbol").orderBy("date", "close")
    recent = order.rowsBetween(1 - days, 0)
    sigma = F.when(F.count("daily_return").over(recent) == days, F.stddev_samp("daily_return").over(recent))
    return prices.withColumn("daily_return", _return(order)).withColumn("rolling_sigma", sigma)


def sharpe_yearly(prices: DataFrame) -> DataFrame:
    """Annualised mean over standard deviation of daily returns, per symbol and year.

    The aggregate reuses the window's partitioning by symbol: one shuffle in all.
    """
    return (
        prices.filter(F.col("symbol").isNotNull())
        .withColumn("daily_return", _return(_days_of_symbol()))
        .groupBy("symbol", F.year("date").alias("year"))
        .agg(
            F.count("daily_return").alias("n_returns"),
            F.avg("daily_return").alias("mean_return"),
            F.stddev_samp("daily_return").alias("sigma"),
        )
        .withColumn(
            "sharpe",
            F.try_divide(F.col("mean_return"), F.col("sigma")) * F.sqrt(F.lit(TRADING_DAYS)),
        )
    )
