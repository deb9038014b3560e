"""Data-quality checks. Each yields rows (model, column_name, test, failures).

A check passes when it counts no failing row. Checks of one model share one aggregate.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickerloom.operators.metrics import with_metrics

# The 20 not-null and the one unique test of the models.
NOT_NULL = {
    "stg_stocks_enriched": [
        "symbol", "stock_year", "first_close", "last_close",
        "avg_daily_range", "sector", "company_name",
    ],
    "int_stock_metrics": [
        "symbol", "stock_year", "company_name", "sector", "yearly_return", "volatility",
    ],
    "mart_sector_performance": [
        "sector", "avg_yearly_return", "avg_volatility", "avg_risk_adj_return",
    ],
    "mart_fundamentals_vs_return": ["company_name", "stock_year", "yearly_return"],
}
UNIQUE = {"mart_sector_performance": "sector"}

# Accepted ranges (None = open end) and smallest share of the previous count.
RANGES = {"gross_margin": (0, 100), "debt_to_equity": (0, None)}
ROW_COUNT_SHARE = 0.8


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


Check = tuple[str, str, str, Column]  # model, column, test, condition of a failing row


def _failures(df: DataFrame, checks: list[Check], by: str | None = None) -> DataFrame:
    """Failing rows of each check, overall or per value of ``by``, in one aggregate."""
    keys = [by] if by else []
    counters = [F.count_if(bad).alias(f"_{i}") for i, (_, _, _, bad) in enumerate(checks)]
    rows = [
        F.struct(
            F.lit(model).alias("model"),
            F.lit(column).alias("column_name"),
            F.lit(test).alias("test"),
            F.col(f"_{i}").alias("failures"),
        )
        for i, (model, column, test, _) in enumerate(checks)
    ]
    return df.groupBy(*keys).agg(*counters).select(*keys, F.inline(F.array(*rows)))


def _not_null_checks(model: str) -> list[Check]:
    return [(model, c, "not_null", F.col(c).isNull()) for c in NOT_NULL[model]]


def _range_checks(model: str) -> list[Check]:
    checks = []
    for column, (low, high) in RANGES.items():
        value = F.col(column)
        bad = (value < low) | F.isnan(value)
        checks.append((model, column, "range", bad if high is None else bad | (value > high)))
    return checks


def not_null(df: DataFrame, model: str) -> DataFrame:
    """Null cells of the model's tested columns."""
    return _failures(df, _not_null_checks(model))


def ranges(metrics: DataFrame, model: str = "int_stock_metrics") -> DataFrame:
    """Values outside their accepted range, and NaN; missing values pass."""
    return _failures(metrics, _range_checks(model))


def row_checks(staged: DataFrame, by: str | None = None, with_ranges: bool = False) -> DataFrame:
    """Checks of the staging and metric models in one pass: both are projections of one row."""
    rows = with_metrics(staged)
    checks = _not_null_checks("stg_stocks_enriched") + _not_null_checks("int_stock_metrics")
    return _failures(rows, checks + (_range_checks("int_stock_metrics") if with_ranges else []), by)


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their row count; null keys are ignored."""
    return (
        df.dropna(subset=keys).groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
        .filter(F.col("n_rows") > 1)
    )


def unique_key(df: DataFrame, model: str, keys: list[str]) -> DataFrame:
    """Number of key values that occur more than once."""
    return duplicate_keys(df, keys).agg(F.count(F.lit(1)).alias("failures")).select(
        F.lit(model).alias("model"),
        F.lit(",".join(keys)).alias("column_name"),
        F.lit("unique").alias("test"),
        "failures",
    )


def unique(df: DataFrame, model: str) -> DataFrame:
    return unique_key(df, model, [UNIQUE[model]])


# Tests whose failures are reported and do not stop a publication.
WARNINGS = ("range", "orphan", "fresh", "row_count")


def with_status(results: DataFrame) -> DataFrame:
    """Failed not-null and unique tests are failures; ranges, orphans, age and row counts warn."""
    failed = F.when(F.col("test").isin(*WARNINGS), "warn").otherwise("fail")
    return results.withColumn("status", F.when(F.col("failures") == 0, "pass").otherwise(failed))


def suite(
    staged: DataFrame, sectors: DataFrame, mart: DataFrame, with_ranges: bool = False
) -> DataFrame:
    """All 21 tests with their status, optionally the range checks too.

    One aggregate for the staging and metric models, one per mart, one duplicate count.
    """
    marts = {"mart_sector_performance": sectors, "mart_fundamentals_vs_return": mart}
    results = [row_checks(staged, with_ranges=with_ranges)]
    results += [not_null(df, model) for model, df in marts.items()]
    results += [unique(marts[model], model) for model in UNIQUE]
    return with_status(_union(results))


def orphans(yearly: DataFrame, fundamentals: DataFrame, securities: DataFrame) -> DataFrame:
    """Keys the inner joins drop, with their row counts.

    Rows are counted per key first, so the anti-joins see each key once on both sides.
    """
    filings = fundamentals.groupBy("symbol", F.year("period_ending").alias("year")).agg(
        F.count(F.lit(1)).alias("n_rows")
    )
    price_years = yearly.select("symbol", "year", F.lit(1).cast("bigint").alias("n_rows"))
    known = securities.select("symbol").distinct()
    listed = known.select("symbol", F.lit(None).cast("int").alias("year"), F.lit(1).cast("bigint").alias("n_rows"))

    def unmatched(left: DataFrame, right: DataFrame, keys: list[str], problem: str) -> DataFrame:
        return left.join(right, keys, "left_anti").select(
            F.lit(problem).alias("problem"), "symbol", "year", "n_rows"
        )

    keys = ["symbol", "year"]
    return _union(
        [
            unmatched(filings, price_years, keys, "filing without prices"),
            unmatched(price_years, filings, keys, "prices without filing"),
            unmatched(price_years, known, ["symbol"], "prices without security"),
            unmatched(filings, known, ["symbol"], "filing without security"),
            unmatched(listed, filings, ["symbol"], "security without filing"),
        ]
    )


def orphan_checks(found: DataFrame) -> DataFrame:
    """Orphaned rows per problem, as test results."""
    counted = found.groupBy("problem").agg(F.sum("n_rows").alias("failures"))
    return _result("sources", F.col("problem"), "orphan", F.col("failures"), counted)


def freshness_checks(found: DataFrame) -> DataFrame:
    """Sources too old, as test results."""
    late = (F.col("status") != "pass").cast("long")
    return _result("sources", F.col("source"), "fresh", F.coalesce(late, F.lit(1)), found)


def row_count_checks(found: DataFrame, run: str) -> DataFrame:
    """Tables of a run that shrank, as test results."""
    shrunk = (F.col("status") != "pass").cast("long")
    return _result(F.col("model"), "", "row_count", F.coalesce(shrunk, F.lit(0)), found.filter(F.col("run") == run))


def _result(model, column, test: str, failures: Column, rows: DataFrame) -> DataFrame:
    value = lambda x: F.lit(x) if isinstance(x, str) else x
    return rows.select(
        value(model).alias("model"),
        value(column).alias("column_name"),
        F.lit(test).alias("test"),
        failures.cast("long").alias("failures"),
    )


def grain(yearly: DataFrame) -> DataFrame:
    """Symbol-years with repeated price days, from the roll-up's own counts."""
    bad = F.count_if(F.col("symbol").isNotNull() & (F.col("n_rows") > F.col("n_days")))
    return yearly.agg(bad.alias("failures")).select(
        F.lit("raw_prices").alias("model"), F.lit("symbol,date").alias("column_name"),
        F.lit("unique").alias("test"), "failures",
    )


def freshness(sources: dict[str, tuple[DataFrame, str]], as_of: str, max_days: int) -> DataFrame:
    """Latest date of each source and whether it is at most ``max_days`` before ``as_of``."""
    latest = [
        df.agg(F.max(column).alias("latest")).select(F.lit(name).alias("source"), "latest")
        for name, (df, column) in sources.items()
    ]
    age = F.date_diff(F.lit(as_of).cast("date"), F.col("latest"))
    return _union(latest).select(
        "source",
        "latest",
        age.alias("age_days"),
        F.when(age <= max_days, "pass").otherwise("fail").alias("status"),
    )


def row_count_anomalies(run_counts: DataFrame, share: float = ROW_COUNT_SHARE) -> DataFrame:
    """Each run's row count against the previous run of the model; input is one row per run."""
    previous = F.lag("n_rows").over(Window.partitionBy("model").orderBy("run"))
    return run_counts.withColumn("previous_rows", previous).withColumn(
        "status",
        F.when(F.col("n_rows") < F.col("previous_rows") * share, "fail").otherwise("pass"),
    )


def pass_rate(history: DataFrame) -> DataFrame:
    """Share of passed tests per run and model; input has (run, model, failures)."""
    passed = F.count_if(F.col("failures") == 0)
    return history.groupBy("run", "model").agg(
        F.count(F.lit(1)).alias("n_tests"),
        passed.alias("n_passed"),
        F.try_divide(passed, F.count(F.lit(1))).alias("pass_rate"),
    )
