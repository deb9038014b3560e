"""Daily bars from a stream of ticks, with late data bounded by a watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SECONDS_PER_DAY = 86_400


def tick_stream(spark: SparkSession, path: str) -> DataFrame:
    """Ticks from the Parquet events feed. The feed stores zone-less times, taken as UTC."""
    schema = spark.read.parquet(path).schema
    wall_clock = F.col("ts").cast("timestamp")
    return spark.readStream.schema(schema).parquet(path).select(
        F.col("user_id").alias("symbol"),
        F.from_utc_timestamp(wall_clock, spark.conf.get("spark.sql.session.timeZone")).alias("ts"),
        F.col("value").alias("price"),
    )


def daily_bars(ticks: DataFrame, lateness: str = "1 day") -> DataFrame:
    """First, last, highest and lowest price and tick count per symbol and UTC day.

    The same plan serves batch frames, where the watermark has no effect. State is one
    row per symbol and open day; ticks are pre-aggregated before they reach it.
    """
    return (
        ticks.withWatermark("ts", lateness)
        .groupBy("symbol", F.window("ts", "1 day").alias("day"))
        .agg(
            F.min_by("price", "ts").alias("open"),
            F.max_by("price", "ts").alias("close"),
            F.max("price").alias("high"),
            F.min("price").alias("low"),
            F.count(F.lit(1)).alias("n_ticks"),
        )
        .select(
            "symbol",
            F.date_from_unix_date(
                F.floor(F.unix_seconds("day.start") / F.lit(SECONDS_PER_DAY)).cast("int")
            ).alias("bar_date"),
            "open", "close", "high", "low", "n_ticks",
        )
    )


def write_bars(bars: DataFrame, path: str, checkpoint: str) -> None:
    """Append closed bars to a Parquet table until the available input is used up."""
    query = (
        bars.writeStream.outputMode("append")
        .format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
