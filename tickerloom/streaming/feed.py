"""A live feed into the lake: ticks, late ones apart, and daily bars, published once per micro-batch.

Each micro-batch is one commit of the lake's log: the ticks it landed, the bars of the days it closed and the
feed's state (batch number, watermark, open days). A batch that is repeated after a crash finds its number
in the log and does nothing, or finds it missing and starts over in folders of its own; so bars appear once, whatever
broke. The state lies in the log, not in the stream's checkpoint, so a lost checkpoint loses no open day.

A day is closed when the watermark, the newest tick's time less the allowed lateness, has passed its end. Ticks
of a closed day are late: they are kept and counted, and ``reconcile`` makes the bars of their days anew.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tickerloom.sources import tables
from tickerloom.streaming.bars import SECONDS_PER_DAY, daily_bars

MICROS_PER_DAY = SECONDS_PER_DAY * 1_000_000
EPOCH = dt.date(1970, 1, 1)


def bar_date(ts: str = "ts") -> Column:
    return F.date_from_unix_date(F.floor(F.unix_seconds(ts) / F.lit(SECONDS_PER_DAY)).cast("int"))


def _day_end(day: dt.date) -> int:
    return ((day - EPOCH).days + 1) * MICROS_PER_DAY


def feed_into_lake(
    ticks: DataFrame, lake: str, checkpoint: str, feed: str = "live", lateness: dt.timedelta = dt.timedelta(days=1)
) -> None:
    """Land all available ticks (symbol, ts, price) of a stream; returns when they are used up."""
    query = (
        ticks.writeStream.foreachBatch(lambda batch, number: land_ticks(batch, number, lake, feed, lateness))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def land_ticks(batch: DataFrame, number: int, lake: str, feed: str, lateness: dt.timedelta) -> None:
    """One micro-batch: land its ticks, close days, publish; nothing if the log has this batch already.

    Ticks without a time belong to no day and are only counted. What reaches the driver is a row per day of the batch.
    """
    spark = batch.sparkSession
    tables.create_lake(spark, lake)
    current = tables.current_versions(spark, lake)
    state = current.get(f"{feed}_feed")
    notes = state.notes if state else {"batch": -1, "watermark": None, "open": []}
    if number <= notes["batch"]:
        return
    seen, watermark, load = tables.last_commit(current), notes["watermark"], uuid.uuid4().hex
    day_end = (F.unix_date("bar_date").cast("long") + 1) * MICROS_PER_DAY
    late = F.lit(False) if watermark is None else day_end <= F.lit(watermark)
    rows = batch.select("symbol", "ts", "price", bar_date().alias("bar_date")).withColumn("late", late)
    schema = StructType(rows.select("symbol", "ts", "price", "late", "bar_date").schema.fields).add("load", "string")
    ticks = _table(current, lake, f"{feed}_ticks", schema)
    folder = f"{ticks.path}/load={load}"
    tables.write_table(rows, folder, ("late", "bar_date"), ("symbol", "ts"))
    written = spark.read.schema(rows.schema).parquet(folder)
    days = written.groupBy("late", "bar_date").agg(F.count("*").alias("n"), F.max(F.unix_micros("ts")).alias("last")).collect()

    newest = max((d["last"] for d in days if d["last"] is not None), default=None)
    if newest is not None:
        reached = newest - lateness // dt.timedelta(microseconds=1)
        watermark = reached if watermark is None else max(watermark, reached)
    on_time = {d.bar_date for d in days if d.bar_date is not None and not d.late}
    open_days = {dt.date.fromisoformat(d) for d in notes["open"]} | on_time
    closing = sorted(d for d in open_days if watermark is not None and _day_end(d) <= watermark)
    late_days = sorted(d.bar_date for d in days if d.late)
    published = []
    if days:
        info = {"load": load, "late_days": [d.isoformat() for d in late_days]}
        published.append(replace(ticks, run=f"{feed}.{number}", info=json.dumps(info)))
    if closing:
        landed = _loads(spark, lake, ticks, load).filter(~F.col("late"))
        published.append(_write_bars(spark, lake, current, feed, landed, closing, f"{feed}.{number}", seen))
    count = lambda found: sum(d.n for d in days if found(d))
    notes = {
        "batch": number, "watermark": watermark, "open": sorted(d.isoformat() for d in open_days - set(closing)),
        "n_ticks": count(lambda d: True), "n_late": count(lambda d: d.late), "n_without_time": count(lambda d: d.bar_date is None),
    }
    name = f"{feed}_feed"
    published.append(tables.Version(name, 0, "", StructType().json(), f"{feed}.{number}", json.dumps(notes)))
    _publish(spark, lake, published, seen, {name, ticks.name})


def reconcile(spark: SparkSession, lake: str, feed: str = "live") -> list[dt.date]:
    """Make the bars of closed days with late ticks anew, from all their ticks; returns these days.

    Afterwards the bars of closed days equal the batch operator's over all ticks.
    """
    current = tables.current_versions(spark, lake)
    seen, name = tables.last_commit(current), f"{feed}_ticks"
    if name not in current:
        return []
    log = tables.publications(spark, lake).filter(F.col("commit") <= seen)
    late = log.filter(F.col("name") == name).select("commit", F.explode(_listed("late_days")).alias("bar_date"))
    late = late.groupBy("bar_date").agg(F.max("commit").alias("late"))
    made = _live_days(log, f"{feed}_bars").select("bar_date", "through")
    stale = late.join(made, "bar_date", "left").filter("through IS NULL OR late > through").select("bar_date")
    days = sorted(r.bar_date for r in stale.collect())  # days with late ticks since the last time
    if days:
        version = _write_bars(spark, lake, current, feed, _loads(spark, lake, current[name]), days, f"{feed}.reconciled", seen)
        _publish(spark, lake, [version], seen, set())
    return days


def read_bars(spark: SparkSession, lake: str, feed: str = "live") -> DataFrame:
    """The published bars; of each day those of its latest load."""
    version = tables.current_version(spark, lake, f"{feed}_bars")
    live = _live_days(tables.publications(spark, lake), version.name).select("bar_date", "load")
    return version.read(spark).join(F.broadcast(live), ["load", "bar_date"], "left_semi").drop("load")


def read_ticks(spark: SparkSession, lake: str, feed: str = "live") -> DataFrame:
    """All landed ticks, with their day and whether they were late."""
    return _loads(spark, lake, tables.current_version(spark, lake, f"{feed}_ticks")).drop("load")


def feed_runs(spark: SparkSession, lake: str, feed: str = "live") -> DataFrame:
    """(batch, watermark, n_ticks, n_late, n_without_time) of every published micro-batch."""
    fields = "batch long, watermark long, n_ticks long, n_late long, n_without_time long"
    states = tables.publications(spark, lake).filter(F.col("name") == f"{feed}_feed")
    return states.select(F.from_json("info", fields).alias("s")).select(
        "s.batch", F.timestamp_micros("s.watermark").alias("watermark"), "s.n_ticks", "s.n_late", "s.n_without_time"
    )


def _table(current: dict, lake: str, name: str, schema: StructType) -> tables.Version:
    if name in current:
        return current[name]
    return tables.next_version(lake, name, schema, current, "")


def _listed(field: str) -> Column:
    days = F.from_json(F.get_json_object("info", f"$.{field}"), "array<string>")
    return F.transform(days, lambda d: d.cast("date"))


def _live_days(log: DataFrame, name: str) -> DataFrame:
    """Each day's latest load, and the last commit whose ticks are in it: a row per day."""
    parts = log.filter(F.col("name") == name).select(
        "number", F.get_json_object("info", "$.load").alias("load"),
        F.get_json_object("info", "$.through").cast("long").alias("through"), F.explode(_listed("days")).alias("bar_date"),
    )
    return parts.groupBy("bar_date").agg(F.max_by("load", "number").alias("load"), F.max_by("through", "number").alias("through"))


def _loads(spark: SparkSession, lake: str, version: tables.Version, own: str | None = None) -> DataFrame:
    """Ticks of the published loads, and of one that is about to be."""
    log = tables.publications(spark, lake).filter(F.col("name") == version.name)
    loads = log.select(F.get_json_object("info", "$.load").alias("load"))
    if own is not None:
        loads = loads.union(spark.range(1).select(F.lit(own)))
    return version.read(spark).join(loads, "load", "left_semi")


def _write_bars(
    spark: SparkSession, lake: str, current: dict, feed: str, ticks: DataFrame, days: list[dt.date], run: str, through: int
) -> tables.Version:
    """Bars of ``days`` as a load; ``ticks`` is read from the partitions of these days alone."""
    made = daily_bars(ticks.filter(F.col("bar_date").isin(days)).select("symbol", "ts", "price"))
    ordered = made.select("symbol", "open", "close", "high", "low", "n_ticks", "bar_date")
    version = _table(current, lake, f"{feed}_bars", StructType(ordered.schema.fields).add("load", "string"))
    load = uuid.uuid4().hex
    tables.write_table(ordered, f"{version.path}/load={load}", ("bar_date",), ("symbol",))
    info = {"load": load, "days": [d.isoformat() for d in days], "through": through}
    return replace(version, run=run, info=json.dumps(info))


def _publish(spark: SparkSession, lake: str, versions: list[tables.Version], seen: int, mine: set[str]) -> None:
    """Publish; others may have published bars of other days meanwhile, but none of ``mine``, which one writer owns."""
    while True:
        try:
            tables.publish(spark, lake, versions, seen)
            return
        except tables.Overtaken as overtaken:
            if mine & {v.name for v in overtaken.others}:
                raise
            paths = {v.name: v.path for v in overtaken.others}
            if any(paths.get(v.name, v.path) != v.path for v in versions):  # the other began the table
                raise
            seen = max(v.commit for v in overtaken.others)
