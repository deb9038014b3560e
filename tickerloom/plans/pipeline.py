"""The whole run: land, build, audit, publish. Marts change only after the audit passed."""

from __future__ import annotations

import json
import time
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickerloom.contracts import CONTRACTS, FUNDAMENTALS, PRICES, SECURITIES
from tickerloom.functions.expressions import in_years
from tickerloom.operators import quality
from tickerloom.operators.enrich import latest_filings, stocks_enriched
from tickerloom.operators.marts import fundamentals_vs_return, sector_performance_of_years, sector_years
from tickerloom.operators.metrics import staging, stock_metrics
from tickerloom.operators.prices import prices_yearly, prices_yearly_with_grain
from tickerloom.operators.reports import report_pack
from tickerloom.plans import risk
from tickerloom.sources import tables
from tickerloom.sources.csv_files import read_cells
from tickerloom.sources.landing import landed, prepare, years_of

YEARLY = "prices_yearly"
ENRICHED = "stocks_enriched"
SECTOR_YEARS = "sector_years"
SECTOR_MART = "mart_sector_performance"
FUNDAMENTALS_MART = "mart_fundamentals_vs_return"
QUALITY_LOG = "_quality"
METRICS_LOG = "_run_metrics"

# File layout: partition columns prune reads of one year, clustering serves row-group skipping.
LAYOUTS = {
    ENRICHED: {"partition_by": ("stock_year",), "cluster_by": ("symbol",)},
    SECTOR_MART: {},
    FUNDAMENTALS_MART: {
        "partition_by": ("stock_year",), "cluster_by": ("company_name",), "balance": False,
    },
}
ROLL_UP_LAYOUT = {"partition_by": ("year",), "cluster_by": ("symbol",)}
BY_YEAR = (ENRICHED, FUNDAMENTALS_MART)


class AuditFailed(RuntimeError):
    """Quality tests failed; nothing was published."""

    def __init__(self, failures: list):
        self.failures = failures
        super().__init__(
            "; ".join(f"{r.model}.{r.column_name} {r.test}: {r.failures}" for r in failures)
        )


@dataclass(frozen=True)
class Config:
    """Source and lake locations: any URI Spark's file systems can open."""

    csv: dict[str, str]  # contract name -> file, folder or glob
    lake: str
    filings: str | None = None  # "all" (a run's default) or "latest": one filing per company-year
    check_grain: bool = True  # fail on several price rows of a symbol and day
    as_of: str | None = None  # with max_age_days: warn of sources older than that
    max_age_days: int | None = None
    ordered_by_date: bool = False  # CSV files are in the order of their dates: land without a shuffle
    risk_days: int | None = None  # also bring daily returns and rolling volatility up to date, by this window
    run: str = field(default_factory=lambda: f"{time.time_ns():020d}")


def build_enriched(
    prices: DataFrame, fundamentals: DataFrame, securities: DataFrame, filings: str = "all"
) -> DataFrame:
    """The staged enriched table from the three sources."""
    return enriched_of(prices_yearly(prices), fundamentals, securities, filings)


def enriched_of(
    yearly: DataFrame, fundamentals: DataFrame, securities: DataFrame, filings: str
) -> DataFrame:
    if filings == "latest":
        fundamentals = latest_filings(fundamentals)
    return staging(stocks_enriched(yearly, fundamentals, securities))


def _year_of(name: str) -> str:
    return "year" if name == YEARLY else "stock_year"


class _Writer:
    """Writes the tables of one run, times them and counts their rows.

    Rows are counted from the written files' footers: counters updated while writing
    would count the rows of repeated tasks twice.
    """

    def __init__(self, spark: SparkSession, config: Config):
        self.spark, self.lake, self.run = spark, config.lake, config.run
        self.current = tables.current_versions(spark, config.lake)
        self.measured: list[tuple[str, str, int, float]] = []

    def write(self, name: str, df: DataFrame, years: list[int] | None = None, **notes) -> tuple[tables.Version, DataFrame]:
        """A new version (with ``years``: of these partitions only) and the rows just written."""
        started = time.monotonic()
        written = tables.next_version(self.lake, name, df.schema, self.current, self.run, **notes)
        layout = ROLL_UP_LAYOUT if name == YEARLY else LAYOUTS.get(name, {})
        tables.write_table(df, written.path, **layout)
        version = written
        if years is not None:
            version = self.current[name].with_partitions(_year_of(name), years, written.path, self.run)
        seconds = time.monotonic() - started
        if name in LAYOUTS:
            self.measured.append((self.run, name, version.read(self.spark).count(), seconds))
        return version, written.read(self.spark)

    def log_metrics(self) -> None:
        schema = "run string, model string, n_rows long, seconds double"
        tables.append_rows(self.spark, self.measured, schema, f"{self.lake}/{METRICS_LOG}")


def audit(
    spark: SparkSession,
    config: Config,
    staged: DataFrame,
    sectors: DataFrame,
    mart: DataFrame,
    yearly: DataFrame,
    all_years: DataFrame,
    fundamentals: DataFrame,
    securities: DataFrame,
    measured: list[tuple],
) -> None:
    """Run the 21 tests and the grain test on written rows, log the results, raise if one failed.

    Values out of range, orphaned rows, old sources and tables that shrank are logged as
    warnings. The grain comes with the roll-up: with repeated days, which close counts as a
    year's first or last is not determined. ``yearly`` has the years just built, ``all_years`` all of them.
    """
    results = quality.suite(staged, sectors, mart, True)
    more = [quality.orphan_checks(quality.orphans(all_years, fundamentals, securities))]
    if config.check_grain:
        more.append(quality.grain(yearly))
    if config.as_of and config.max_age_days is not None:
        dates = {"fundamentals": (fundamentals, "period_ending"), "prices": (all_years, "last_day")}
        more.append(quality.freshness_checks(quality.freshness(dates, config.as_of, config.max_age_days)))
    more.append(quality.row_count_checks(_row_counts(spark, config, measured), config.run))
    for rows in more:
        results = results.unionByName(quality.with_status(rows))
    _judge(config, results)


def _audit_sectors(spark: SparkSession, config: Config, sectors: DataFrame) -> None:
    """The tests of the sector mart alone, as it was built anew over what others published."""
    rows = quality.not_null(sectors, SECTOR_MART).unionByName(quality.unique(sectors, SECTOR_MART))
    _judge(config, quality.with_status(rows))


def _judge(config: Config, results: DataFrame) -> None:
    """Log test results; raise if one failed."""
    results = tables.stored(results.select(F.lit(config.run).alias("run"), "*").coalesce(1), "audit")
    results.write.mode("append").parquet(f"{config.lake}/{QUALITY_LOG}")
    failures = results.filter("status = 'fail'").collect()  # at most one row per test
    if failures:
        raise AuditFailed(failures)


def _row_counts(spark: SparkSession, config: Config, measured: list[tuple]) -> DataFrame:
    """This run's row counts beside those of the last published run."""
    schema = "run string, model string, n_rows long, seconds double"
    tables.append_rows(spark, [], schema, f"{config.lake}/{METRICS_LOG}")
    history = spark.read.schema(schema).parquet(f"{config.lake}/{METRICS_LOG}")
    last = history.groupBy("model").agg(F.max_by(F.struct("run", "n_rows"), "run").alias("l"))
    now = spark.createDataFrame(measured, schema)
    return quality.row_count_anomalies(
        last.select("l.run", "model", "l.n_rows").unionByName(now.select("run", "model", "n_rows"))
    )


def _build(
    spark: SparkSession, config: Config, raw: dict[str, tables.Version | None], filings: str, years: list[int] | None, seen: int
) -> str:
    """Build, audit and publish: everything, or the partitions of ``years``, in one commit.

    The roll-up and the enriched rows are written once and read back: models, marts and tests are then
    narrow scans of them, and a lost executor does not recompute the joins. Orphans and ages are those of the whole
    tables, also where only some years were built: the roll-up of the others is read as published. ``seen`` is the last commit
    before anything was read.
    """
    writer = _Writer(spark, config)
    prices, fundamentals, securities = (
        landed(spark, c, config.lake, raw.get(c.name)) for c in (PRICES, FUNDAMENTALS, SECURITIES)
    )
    all_filings = fundamentals
    if years is not None:
        prices = of_years(prices, PRICES, years)
        fundamentals = of_years(fundamentals, FUNDAMENTALS, years)
    yearly_version, yearly = writer.write(YEARLY, prices_yearly_with_grain(prices), years)
    rows = enriched_of(yearly.drop("n_rows", "n_days", "last_day"), fundamentals, securities, filings)
    enriched, staged = writer.write(ENRICHED, rows, years, filings=filings)
    metrics = stock_metrics(staged)
    mart_version, mart = writer.write(FUNDAMENTALS_MART, fundamentals_vs_return(metrics), years)
    own_sums = sector_years(metrics)
    sums_version, sectors_version, sectors = _sector_tables(writer, own_sums, years)
    audit(
        spark, config, staged, sectors, mart, yearly, yearly_version.read(spark), all_filings, securities, writer.measured
    )
    landed_now = [v for v in raw.values() if v is not None]
    by_year = [yearly_version, enriched, mart_version]
    resecured = years is not None and raw.get(SECURITIES.name) is not None
    if resecured:  # other refreshes read the old securities: none of them may stand beside this one
        by_year = [replace(v, info=json.dumps({k: x for k, x in v.notes.items() if k != "touched"}, sort_keys=True)) for v in by_year]
    while True:
        try:
            tables.publish(spark, config.lake, [*landed_now, *by_year, sums_version, sectors_version], seen)
            break
        except tables.Overtaken as overtaken:
            others = [v for v in overtaken.others if v.name not in (SECTOR_YEARS, SECTOR_MART)]
            touched = tables.Overtaken(others).touched()
            if years is None or resecured or touched is None or touched & set(years):
                raise
            writer.current = tables.current_versions(spark, config.lake)
            seen = tables.last_commit(writer.current)
            landed_now = [_after(v, writer.current.get(v.name), overtaken) for v in landed_now]
            by_year = [_after(v, writer.current[v.name], overtaken) for v in by_year]
            sums_version, sectors_version, sectors = _sector_tables(writer, own_sums, years)
            _audit_sectors(spark, config, sectors)
    writer.log_metrics()
    return config.run


def _sector_tables(writer: _Writer, own_sums: DataFrame, years: list[int] | None) -> tuple[tables.Version, tables.Version, DataFrame]:
    """The sums per sector and year with those of the years just built, and the sector mart over them."""
    sums = own_sums
    if years is not None:
        kept = writer.current[SECTOR_YEARS].read(writer.spark)
        sums = kept.filter(~F.col("stock_year").isin(years)).unionByName(sums)
    sums_version, sums = writer.write(SECTOR_YEARS, sums)
    sectors_version, sectors = writer.write(SECTOR_MART, sector_performance_of_years(sums))
    return sums_version, sectors_version, sectors


def _after(version: tables.Version, current: tables.Version | None, overtaken: tables.Overtaken) -> tables.Version:
    """A refreshed version on top of what others published of its table, whose partitions differ from its own."""
    touched = version.notes["touched"]
    if current is None:
        raise overtaken
    if "moved" not in version.notes:  # a landed load
        if current.path != version.path:
            raise overtaken
        return replace(version, info=json.dumps(current.notes | {"touched": touched}, sort_keys=True))
    folders = version.notes["moved"]["folders"]
    folder = folders[str(touched[0])] if touched else version.path
    return current.with_partitions(_year_of(version.name), touched, folder, version.run)


def run(spark: SparkSession, config: Config) -> str:
    """Run everything for the configured sources; return the run id.

    The sources replace what was landed before, files appended by ``refresh`` included.
    Raw loads, models and marts become current together, and only after the audit passed.
    """
    for contract in CONTRACTS:  # all headers, before the first source is landed
        read_cells(spark, config.csv[contract.name], contract)
    tables.create_lake(spark, config.lake)
    seen = tables.last_commit(tables.current_versions(spark, config.lake))
    raw = {
        c.name: prepare(spark, c, config.csv[c.name], config.lake, ordered_by_date=config.ordered_by_date)
        for c in CONTRACTS
    }
    return _with_risk(spark, config, _build(spark, config, raw, config.filings or "all", None, seen))


def _with_risk(spark: SparkSession, config: Config, run_id: str) -> str:
    """The risk model follows in a commit of its own: it needs prices only, and a crash before it is made up by the next update."""
    if config.risk_days:
        risk.update(spark, config.lake, config.risk_days)
    return run_id


def of_years(df: DataFrame, contract, years: list[int]) -> DataFrame:
    """Rows of the given calendar years, from the table's partitions of these where it has them."""
    df = df.filter(in_years(F.col(contract.year_of), years))
    return df.filter(F.col(contract.year_column).isin(years)) if contract.year_column in df.columns else df


def refreshed_years(
    prices: DataFrame,
    fundamentals: DataFrame,
    securities: DataFrame,
    years: list[int],
    filings: str = "all",
) -> DataFrame:
    """Enriched rows of the given years only, from the sources' partitions of these years."""
    return build_enriched(
        of_years(prices, PRICES, years), of_years(fundamentals, FUNDAMENTALS, years), securities, filings
    )


def refresh(spark: SparkSession, config: Config, years: tuple[int, ...] = ()) -> str:
    """Recompute only the years that new files touch, and ``years``.

    ``config.csv`` names new price and filing files; they are appended to what was
    landed before. A securities file replaces the one before; a security whose rows differ touches all years it has prices of. Filings are
    treated as the published table was built ("all" or "latest"); asking for the other mode is an
    error. Recomputed partitions are written aside and audited; new raw loads, partitions and marts
    are then published together. Files that were landed before change nothing. If another refresh published
    other years meanwhile, both stand; if it touched a year of this one, Overtaken is raised, nothing is published, and the
    refresh can be run again.
    """
    current = tables.current_versions(spark, config.lake)
    enriched, seen = current[ENRICHED], tables.last_commit(current)
    filings = enriched.notes["filings"]
    if config.filings not in (None, filings):
        raise ValueError(f"the table holds {filings} filings: {config.filings} need a full run")
    raw, stale = {}, set(years)
    for contract in (PRICES, FUNDAMENTALS):
        if contract.name in config.csv:
            path = config.csv[contract.name]
            version = prepare(
                spark, contract, path, config.lake, append=True, ordered_by_date=config.ordered_by_date
            )
            raw[contract.name] = version
            stale.update(years_of(spark, contract, version) if version is not None else ())
    if SECURITIES.name in config.csv:
        version = prepare(spark, SECURITIES, config.csv[SECURITIES.name], config.lake)
        raw[SECURITIES.name] = version
        if version is not None:
            old, new = (landed(spark, SECURITIES, config.lake, v) for v in (None, version))
            known = current[YEARLY].read(spark).select("symbol", "year")
            touched = known.join(changed_symbols(old, new), "symbol", "left_semi").select("year").distinct().collect()
            stale.update(r.year for r in touched if r.year is not None)  # calendar years
    return _with_risk(spark, config, _build(spark, config, raw, filings, sorted(stale), seen))


def changed_symbols(old: DataFrame, new: DataFrame) -> DataFrame:
    """Symbols whose rows are not the same in two tables; rows of a symbol are compared as a bag."""
    cells = [F.col(c) for c in sorted(old.columns)]
    bag = [F.sum(F.xxhash64(*cells, *[c.isNull() for c in cells]).cast("decimal(38,0)")), F.count(F.lit(1))]
    sides = [df.groupBy("symbol").agg(F.struct(*bag).alias(name)) for df, name in ((old, "was"), (new, "is"))]
    return sides[0].join(sides[1], "symbol", "full").filter(~F.col("was").eqNullSafe(F.col("is"))).select("symbol")


def quality_history(spark: SparkSession, lake: str) -> DataFrame:
    """Pass rate of every run's tests, per model."""
    return quality.pass_rate(spark.read.parquet(f"{lake}/{QUALITY_LOG}"))


def row_count_history(spark: SparkSession, lake: str) -> DataFrame:
    """Row counts of every run against the run before, per table."""
    return quality.row_count_anomalies(spark.read.parquet(f"{lake}/{METRICS_LOG}"))


def register_models(spark: SparkSession, lake: str) -> None:
    """Temporary views of the published models: staging and metrics lazy, marts as stored."""
    versions = tables.current_versions(spark, lake)
    staged = versions[ENRICHED].read(spark)
    tables.register_views(
        stg_stocks_enriched=staged,
        int_stock_metrics=stock_metrics(staged),
        **{name: versions[name].read(spark) for name in (SECTOR_MART, FUNDAMENTALS_MART)},
    )


def reports_of(spark: SparkSession, lake: str, year: int | None = None) -> dict[str, DataFrame]:
    """All reports over the published marts, each of which is scanned once for all of them.

    The marts stay cached for later packs until a newer commit is read; ``tables.release`` drops them.
    """
    versions = tables.current_versions(spark, lake)
    return report_pack(
        tables.held(spark, lake, versions[SECTOR_MART]), tables.held(spark, lake, versions[FUNDAMENTALS_MART]), year
    )
