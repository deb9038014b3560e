"""Daily returns and rolling volatility as a published model, kept up to date by halo windows.

The model ``daily_risk`` is partitioned by calendar year. Beside it lies ``risk_tails``: the last ``days`` prices of each
symbol and year. A row's return and volatility look back ``days`` rows at most, so a year that is made anew needs
its own prices and the tails of the years before, not their prices; and new prices of a year change, of later years, only
those whose first rows lie within ``days`` rows of it. Which raw loads came since stands in the lake's log.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickerloom.contracts import PRICES
from tickerloom.functions.expressions import in_years
from tickerloom.operators.prices import daily_risk
from tickerloom.sources import tables
from tickerloom.sources.landing import MERGED, landed

MODEL = "daily_risk"
TAILS = "risk_tails"
DAYS = 20
YEAR = PRICES.year_column


def tails_of(prices: DataFrame, days: int) -> DataFrame:
    """The last ``days`` prices of each symbol and year; each task keeps as many of a key before the shuffle."""
    last = Window.partitionBy("symbol", YEAR).orderBy(F.col("date").desc(), F.col("close").desc_nulls_last())
    ranked = prices.select("symbol", "date", "close", YEAR).withColumn("_rank", F.row_number().over(last))
    return ranked.filter(F.col("_rank") <= days).drop("_rank")


def reached_years(tails: DataFrame, touched: list[int], days: int) -> list[int]:
    """Years not touched themselves, in which some symbol has one of the ``days`` rows after a touched year.

    A tail counts a year's rows up to ``days``, and more do not matter. Returns calendar years.
    """
    before = Window.partitionBy("symbol").orderBy(YEAR).rowsBetween(Window.unboundedPreceding, -1)
    counts = tails.groupBy("symbol", YEAR).agg(F.count(F.lit(1)).alias("n"))
    start = F.coalesce(F.sum("n").over(before), F.lit(0))
    hit = F.col(YEAR).isin(touched)
    spans = counts.withColumn("start", start).withColumn("end", F.when(hit, F.col("start") + F.col("n")))
    since = F.col("start") - F.last("end", ignorenulls=True).over(before)
    near = spans.withColumn("since", since).filter((F.col("since") < days) & ~hit)
    return sorted(r[0] for r in near.select(YEAR).distinct().collect())


def risk_of_years(prices: DataFrame, tails: DataFrame, years: list[int], days: int) -> DataFrame:
    """Rows of the model of ``years``, from their prices and the tails of the other years before the last of them."""
    own = prices.filter(F.col(YEAR).isin(years) & in_years(F.col(PRICES.year_of), years))
    columns = ["symbol", "date", "close", YEAR]
    halo = tails.filter((F.col(YEAR) < max(years)) & ~F.col(YEAR).isin(years)).select(*columns)
    rows = own.select(*columns, F.lit(True).alias("_own")).unionByName(halo.withColumn("_own", F.lit(False)))
    return daily_risk(rows, days).filter("_own").drop("_own")


def _touched(spark: SparkSession, lake: str, through: int) -> list[int] | None:
    """Years that raw loads published after ``through`` touch; None if one replaced what was landed before."""
    log = tables.publications(spark, lake)
    later = log.filter((F.col("name") == f"raw_{PRICES.name}") & (F.col("commit") > through))
    years = F.from_json(F.get_json_object("info", "$.touched"), "array<int>")
    later = later.filter(~F.col("run").startswith(f"{MERGED}.")).select(years.alias("years"))
    if later.filter("years IS NULL").count():
        return None
    return sorted(r[0] for r in later.select(F.explode("years")).distinct().collect())


def update(spark: SparkSession, lake: str, days: int | None = None) -> list[int] | None:
    """Bring the model up to the landed prices; returns the years made anew, None for all of them.

    Everything is built if the model is new, if ``days`` differs from the published one (default: that, or 20), or if a load
    replaced the prices. Otherwise only years that new files touch and those their halo reaches. Raises ``Overtaken``, and publishes
    nothing, if another update was published meanwhile.
    """
    current = tables.current_versions(spark, lake)
    seen, raw, old = tables.last_commit(current), current[f"raw_{PRICES.name}"], current.get(MODEL)
    days = days or (old.notes["days"] if old else DAYS)
    if days < 2:
        raise ValueError("a deviation needs two returns")
    touched = _touched(spark, lake, old.notes["through"]) if old and old.notes["days"] == days else None
    prices, notes = landed(spark, PRICES, lake, raw), {"days": days, "through": seen}
    if touched == []:
        return []
    if touched is None:
        years = None
        tails, _ = _write(lake, current, TAILS, tails_of(prices, days), None, notes)
        rows = daily_risk(prices.select("symbol", "date", "close", YEAR), days)
    else:
        own = prices.filter(F.col(YEAR).isin(touched))
        tails, read = _write(lake, current, TAILS, tails_of(own, days), touched, notes)
        years = sorted({*touched, *reached_years(read, touched, days)})
        rows = risk_of_years(prices, read, years, days)
    model, _ = _write(lake, current, MODEL, rows, years, notes)
    tables.publish(spark, lake, [tails, model], seen)
    return years


def _write(
    lake: str, current: dict[str, tables.Version], name: str, rows: DataFrame, years: list[int] | None, notes: dict
) -> tuple[tables.Version, DataFrame]:
    """A new version of a table, or of its partitions ``years``, and the whole table as it will be read."""
    written = tables.next_version(lake, name, rows.schema, current, "risk", **notes)
    tables.write_table(rows, written.path, (YEAR,), ("symbol", "date"))
    if years is None:
        return written, written.read(rows.sparkSession)
    version = current[name].with_partitions(YEAR, years, written.path, "risk").with_notes(**notes)
    return version, version.read(rows.sparkSession)
