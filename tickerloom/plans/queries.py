"""Every operator as a named query over the benchmark tables.

Results are made comparable across engines here and nowhere else: doubles are rounded to
six digits (shifted by 1e-9, as sums in another order may sit on either side of a half)
and dates are shown as ISO text.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickerloom.contracts import CONTRACTS, FUNDAMENTALS, PRICES, SECURITIES
from tickerloom.operators import analysis, enrich, marts, metrics, prices, quality, reports
from tickerloom.plans import colocation, pipeline, risk
from tickerloom.session import work_dir
from tickerloom.sources import csv_files, landing, tables, upkeep
from tickerloom.sources.fixtures import MarketFixture
from tickerloom.streaming import bars, feed

# Parameters of the registered queries, chosen for the value range of the benchmark tables.
LOW_PRICE = 5_000.0
PRUNED_YEAR = 1998
REFRESHED_YEAR = 2000
FRESH_AS_OF = "2002-01-31"
FRESH_DAYS = 60
ROLLING_DAYS = 5

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
BUILDERS: dict[str, Callable[[Market], DataFrame]] = {}


def comparable(df: DataFrame) -> DataFrame:
    def shown(name: str, type_name: str):
        column = F.col(f"`{name}`")
        if type_name == "double":
            column = F.round(column + F.lit(1e-9), 6)
        elif type_name == "date":
            column = column.cast("string")
        return column.alias(name)

    return df.select(*[shown(name, type_name) for name, type_name in df.dtypes])


class Market(MarketFixture):
    """The fixture's relations and the models built on them."""

    @property
    def yearly(self) -> DataFrame:
        return prices.prices_yearly(self.prices)

    @property
    def stored_yearly(self) -> DataFrame:
        """The roll-up written first, as a run does before it joins."""
        return tables.stored(self.yearly, "yearly")

    @property
    def enriched(self) -> DataFrame:
        return enrich.stocks_enriched(self.stored_yearly, self.fundamentals, self.securities)

    @property
    def staged(self) -> DataFrame:
        return metrics.staging(self.enriched)

    @property
    def metrics(self) -> DataFrame:
        return metrics.stock_metrics(self.staged)

    @property
    def sectors(self) -> DataFrame:
        """The sector mart as runs publish it."""
        return marts.sector_performance_of_years(marts.sector_years(self.metrics))

    @property
    def counted_sectors(self) -> DataFrame:
        """The sector mart the short way, without the filing fan-out."""
        return marts.sector_performance_by_counts(self.yearly, self.fundamentals, self.securities)

    @property
    def mart(self) -> DataFrame:
        return marts.fundamentals_vs_return(self.metrics)

    @property
    def latest(self) -> DataFrame:
        return enrich.latest_filings(self.fundamentals, ("filing_id",))


class StoredMarket(Market):
    """The fixture's relations written first, so that work on them can be timed alone."""

    @cached_property
    def prices(self) -> DataFrame:
        return tables.stored(super().prices, "prices")

    @cached_property
    def fundamentals(self) -> DataFrame:
        return tables.stored(super().fundamentals, "fundamentals")

    @cached_property
    def securities(self) -> DataFrame:
        return tables.stored(super().securities, "securities")


def _register(name: str, build: Callable[[Market], DataFrame]) -> None:
    BUILDERS[name] = build
    QUERIES[name] = lambda spark, sf_dir: comparable(build(Market(spark, sf_dir)))


def query(build: Callable[[Market], DataFrame]) -> Callable[[Market], DataFrame]:
    _register(build.__name__, build)
    return build


# --- sources --------------------------------------------------------------------------


def _scan(m: Market, contract, df: DataFrame) -> DataFrame:
    return csv_files.read_csv(m.spark, m.write_csv(contract, df), contract)


_register("scan_prices", lambda m: _scan(m, PRICES, m.prices))
_register("scan_fundamentals", lambda m: _scan(m, FUNDAMENTALS, m.fundamentals))
_register("scan_securities", lambda m: _scan(m, SECURITIES, m.securities))


@query
def ingest_raw(m: Market) -> DataFrame:
    """Landed prices after a wrong load was replaced, files were appended, and appended again.

    Both folders' files are told apart by content only.
    """
    lake, csv = work_dir(m.spark, "lake"), m.write_csv_parts(PRICES, m.prices, F.year("date") % 2)
    first, second = (f"{csv}/part={n}" for n in (0, 1))
    landing.land(m.spark, PRICES, second, lake)
    landing.land(m.spark, PRICES, first, lake)
    for _ in range(2):
        landing.land(m.spark, PRICES, second, lake, append=True)
    return landing.landed(m.spark, PRICES, lake).drop(PRICES.year_column)


@query
def ingest_rejects(m: Market) -> DataFrame:
    cells = csv_files.read_cells(m.spark, m.malformed_price_csv(), PRICES)
    return (
        csv_files.rejected_rows(csv_files.parsed(cells, PRICES))
        .groupBy(F.array_join("bad_columns", ",").alias("bad_columns"))
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )


# --- prices ---------------------------------------------------------------------------


_register("daily_range", lambda m: prices.daily_range(m.prices))
_register("prices_yearly", lambda m: m.yearly)
_register("prices_yearly_windowed", lambda m: prices.prices_yearly_windowed(m.prices))
_register("window_first_close", lambda m: prices.with_first_close(m.prices).drop("high", "low"))
_register("window_last_close", lambda m: prices.with_last_close(m.prices).drop("high", "low"))
_register("daily_returns", lambda m: prices.daily_returns(m.prices))
_register("rolling_volatility", lambda m: prices.rolling_volatility(m.prices, ROLLING_DAYS))
_register("sharpe_yearly", lambda m: prices.sharpe_yearly(m.prices))


@query
def sql_prices_yearly(m: Market) -> DataFrame:
    tables.register_views(prices=m.prices, fundamentals=m.fundamentals, securities=m.securities)
    return prices.prices_yearly_sql(m.spark)


# --- joins, models, marts ---------------------------------------------------------------


_register(
    "join_prices_fundamentals",
    lambda m: enrich.join_prices_fundamentals(m.stored_yearly, m.fundamentals).drop("filing_id"),
)
_register("stocks_enriched", lambda m: m.enriched)
_register("stg_stocks_enriched", lambda m: m.staged)
_register("int_stock_metrics", lambda m: m.metrics)
_register("mart_sector_performance", lambda m: marts.sector_performance(m.metrics))
_register("mart_sector_by_counts", lambda m: m.counted_sectors)
_register("mart_fundamentals_vs_return", lambda m: m.mart)
_register("fundamentals_latest_per_year", lambda m: m.latest)


@query
def mart_sector_performance_dedup(m: Market) -> DataFrame:
    latest_only = enrich.stocks_enriched(m.stored_yearly, m.latest, m.securities)
    return marts.sector_performance(metrics.stock_metrics(metrics.staging(latest_only)))


@query
def flagship_sector_ranking(m: Market) -> DataFrame:
    return reports.sector_ranking(m.counted_sectors)


# --- reports ----------------------------------------------------------------------------


@query
def report_kpis(m: Market) -> DataFrame:
    """Both marts from one computation of the metrics, of which five columns are needed."""
    needed = ["sector", "company_name", "yearly_return", "volatility", "risk_adj_return"]
    built = tables.stored(m.metrics.select(*needed), "metrics")
    return reports.kpis(marts.sector_performance(built), built)


_register(
    "report_sector_ranking",
    lambda m: reports.sector_ranking(marts.sector_performance(m.metrics)),
)
_register("report_sector_table", lambda m: reports.sector_table(m.sectors))
_register("report_fundamentals", lambda m: reports.fundamentals_listing(m.mart))
_register("report_years", lambda m: reports.years(m.mart))
_register("report_top_performers", lambda m: reports.top_performers(m.mart))
_register("report_top_performers_all_years", lambda m: reports.top_performers_all_years(m.mart))
_register("feed_sector_bar", lambda m: reports.sector_bar(m.sectors))
_register("feed_return_vs_volatility", lambda m: reports.return_vs_volatility(m.sectors))
_register("feed_eps_vs_return", lambda m: reports.eps_vs_return(m.mart))
_register("feed_debt_vs_return", lambda m: reports.debt_vs_return(m.mart))


# --- quality ----------------------------------------------------------------------------


_register("dq_staging", lambda m: quality.not_null(m.staged, "stg_stocks_enriched"))
_register("dq_intermediate", lambda m: quality.not_null(m.metrics, "int_stock_metrics"))
_register("dq_mart_sector", lambda m: quality.not_null(m.sectors, "mart_sector_performance"))
_register("dq_unique_sector", lambda m: quality.unique(m.sectors, "mart_sector_performance"))
_register("dq_mart_fundamentals", lambda m: quality.not_null(m.mart, "mart_fundamentals_vs_return"))
_register("dq_ranges", lambda m: quality.ranges(m.metrics))
_register("dq_price_grain", lambda m: quality.duplicate_keys(m.price_rows, ["symbol", "date"]))
_register(
    "dq_orphans",
    lambda m: quality.orphans(m.stored_yearly, m.fundamentals, m.securities),
)


@query
def dq_suite(m: Market) -> DataFrame:
    staged = tables.stored(m.staged, "staged")
    built = metrics.stock_metrics(staged)
    return quality.suite(
        staged, marts.sector_performance(built), marts.fundamentals_vs_return(built)
    )


@query
def dq_freshness(m: Market) -> DataFrame:
    sources = {"prices": (m.price_rows, "date"), "fundamentals": (m.fundamentals, "period_ending")}
    return quality.freshness(sources, FRESH_AS_OF, FRESH_DAYS)


def _two_runs(m: Market) -> str:
    """A lake after a run over all filings and a run over the latest ones only."""
    lake, sources = work_dir(m.spark, "lake"), m.csv_sources()
    for run, filings in (("1", "all"), ("2", "latest")):
        pipeline.run(m.spark, pipeline.Config(sources, lake, filings, run=run))
    return lake


@query
def dq_rowcount_anomaly(m: Market) -> DataFrame:
    return pipeline.row_count_history(m.spark, _two_runs(m)).select(
        "run", "model", "n_rows", "previous_rows", "status"
    )


@query
def dq_pass_rate(m: Market) -> DataFrame:
    return pipeline.quality_history(m.spark, _two_runs(m))


# --- analysis ---------------------------------------------------------------------------


_register("factor_correlation", lambda m: analysis.factor_correlation(m.metrics))
_register("factor_correlation_overall", lambda m: analysis.factor_correlation(m.metrics, None))
_register(
    "factor_correlation_by_year", lambda m: analysis.factor_correlation(m.metrics, "stock_year")
)
_register(
    "outlier_returns",
    lambda m: analysis.outlier_returns(m.stored_yearly, LOW_PRICE),
)


# --- tables and pipeline ----------------------------------------------------------------


def _written_staging(m: Market, df: DataFrame | None = None) -> str:
    path = work_dir(m.spark, "stocks_enriched")
    tables.write_table(m.staged if df is None else df, path, ("stock_year",), ("symbol",))
    return path


@query
def roundtrip_enriched(m: Market) -> DataFrame:
    return m.spark.read.parquet(_written_staging(m))


@query
def pruned_year_read(m: Market) -> DataFrame:
    stored = m.spark.read.parquet(_written_staging(m))
    return stored.filter(F.col("stock_year") == PRUNED_YEAR)


@query
def incremental_refresh(m: Market) -> DataFrame:
    """The enriched table of a lake whose prices of one year arrive later, by a refresh."""
    lake, late = work_dir(m.spark, "lake"), F.year("date") == REFRESHED_YEAR
    csv = m.write_csv_parts(PRICES, m.prices, late)
    sources = {c.name: m.write_csv(c, df) for c, df in ((FUNDAMENTALS, m.fundamentals), (SECURITIES, m.securities))}
    pipeline.run(m.spark, pipeline.Config(sources | {PRICES.name: f"{csv}/part=false"}, lake))
    pipeline.refresh(m.spark, pipeline.Config({PRICES.name: f"{csv}/part=true"}, lake))
    rows = tables.read_current(m.spark, lake, pipeline.ENRICHED)
    return rows.withColumn("symbol", F.col("symbol").cast("long"))


@query
def published_risk(m: Market) -> DataFrame:
    """The published returns and volatilities of a lake whose prices of one year arrive later, by an update."""
    lake, csv = work_dir(m.spark, "lake"), m.write_csv_parts(PRICES, m.prices, F.year("date") == REFRESHED_YEAR)
    for late in ("false", "true"):
        landing.land(m.spark, PRICES, f"{csv}/part={late}", lake, append=True)
        risk.update(m.spark, lake, ROLLING_DAYS)
    rows = tables.read_current(m.spark, lake, risk.MODEL).drop(risk.YEAR)
    return rows.withColumn("symbol", F.col("symbol").cast("long"))


@query
def compact_table(m: Market) -> DataFrame:
    """The yearly prices, written as many small files and rewritten as few."""
    scattered, compacted = work_dir(m.spark, "scattered"), work_dir(m.spark, "compacted")
    m.yearly.repartition(64).write.parquet(scattered)
    tables.compact(m.spark, scattered, compacted, cluster_by=("symbol", "year"))
    return m.spark.read.parquet(compacted)


@query
def kept_lake(m: Market) -> DataFrame:
    """Prices and their risk after the loads of seven years were merged by need and all that nobody names was removed."""
    lake, csv = work_dir(m.spark, "lake"), m.write_csv_parts(PRICES, m.prices, F.pmod(F.year("date"), F.lit(7)))
    for n in range(7):
        landing.land(m.spark, PRICES, f"{csv}/part={n}", lake, append=True)
        if n in (4, 6):
            risk.update(m.spark, lake, ROLLING_DAYS)
    upkeep.compact_loads(m.spark, PRICES, lake)
    upkeep.compact_partitions(m.spark, lake, risk.MODEL, risk.YEAR, ("symbol", "date"))
    upkeep.sweep(m.spark, lake, 1, dt.timedelta(0))
    landed = landing.landed(m.spark, PRICES, lake).select("symbol", "date", "close", "high", "low")
    risks = tables.read_current(m.spark, lake, risk.MODEL).select("symbol", "date", "rolling_sigma")
    return landed.join(risks, ["symbol", "date"]).withColumn("symbol", F.col("symbol").cast("long"))


def _colocated(m: Market) -> colocation.Colocated:
    lake, sources = work_dir(m.spark, "lake"), m.csv_sources()
    for contract in (PRICES, FUNDAMENTALS):
        landing.land(m.spark, contract, sources[contract.name], lake)
    colocation.colocate(m.spark, lake)
    return colocation.read(m.spark, lake)


@query
def colocated_enriched(m: Market) -> DataFrame:
    """The enriched table from a roll-up and filings that lie together by symbol."""
    built = _colocated(m)
    securities = m.securities.withColumn("symbol", F.col("symbol").cast("string"))
    rows = enrich.stocks_enriched(built.yearly, built.fundamentals, securities)
    return rows.withColumn("symbol", F.col("symbol").cast("long"))


@query
def colocated_returns(m: Market) -> DataFrame:
    """Daily returns over prices that lie together by symbol."""
    rows = prices.daily_returns(_colocated(m).prices)
    return rows.withColumn("symbol", F.col("symbol").cast("long"))


def _run(m: Market) -> str:
    lake = work_dir(m.spark, "lake")
    pipeline.run(m.spark, pipeline.Config(m.csv_sources(), lake))
    return lake


@query
def run_pipeline(m: Market) -> DataFrame:
    """CSV sources to published marts; the result is the published sector mart."""
    return tables.read_current(m.spark, _run(m), pipeline.SECTOR_MART)


@query
def publish_marts(m: Market) -> DataFrame:
    """CSV sources to published marts; the result is the published company mart."""
    return tables.read_current(m.spark, _run(m), pipeline.FUNDAMENTALS_MART)


@query
def run_metrics(m: Market) -> DataFrame:
    """Row counts observed while the run wrote its tables."""
    return m.spark.read.parquet(f"{_run(m)}/{pipeline.METRICS_LOG}").select("model", "n_rows")


# --- streaming --------------------------------------------------------------------------


@query
def stream_daily_bars(m: Market) -> DataFrame:
    """Bars the watermark has closed once the available events are used up."""
    out, checkpoint = work_dir(m.spark, "bars"), work_dir(m.spark, "bars-checkpoint")
    # A pattern, as a stream's plain path must be a folder and the table may be one file.
    ticks = bars.tick_stream(m.spark, f"{m.sf_dir}/event[s].parquet")
    bars.write_bars(bars.daily_bars(ticks), out, checkpoint)
    return m.spark.read.parquet(out)


def _fed(m: Market) -> str:
    """A lake that got nine tenths of the events live, and the rest when most of their days were closed."""
    lake, folder, checkpoint = (work_dir(m.spark, x) for x in ("lake", "events", "feed-checkpoint"))
    events = m.spark.read.parquet(f"{m.sf_dir}/events.parquet")
    tenth = F.pmod("event_id", F.lit(10)) == 0
    for part in (~tenth, tenth):
        events.filter(part).write.mode("append").parquet(folder)
        feed.feed_into_lake(bars.tick_stream(m.spark, folder), lake, checkpoint)
    return lake


@query
def feed_bars(m: Market) -> DataFrame:
    """Bars read from the lake a live feed publishes to."""
    return feed.read_bars(m.spark, _fed(m))


@query
def feed_late_ticks(m: Market) -> DataFrame:
    """Late ticks per day, as the feed kept them apart."""
    late = feed.read_ticks(m.spark, _fed(m)).filter("late")
    return late.groupBy("bar_date").agg(F.count("*").alias("n_late"))


@query
def feed_bars_reconciled(m: Market) -> DataFrame:
    """The same bars after the days with late ticks were made anew."""
    lake = _fed(m)
    feed.reconcile(m.spark, lake)
    return feed.read_bars(m.spark, lake)


@query
def ingest_overlapping(m: Market) -> DataFrame:
    """Landed prices after one year's file, and then the whole folder, that file included, was appended."""
    lake, csv = work_dir(m.spark, "lake"), m.write_csv_parts(PRICES, m.prices, F.year("date") % 2)
    for files in ("part=0", "part=*"):
        landing.land(m.spark, PRICES, f"{csv}/{files}", lake, append=True)
    return landing.landed(m.spark, PRICES, lake).drop(PRICES.year_column)
