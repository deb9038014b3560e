"""Tables bucketed by a key: aggregates, joins and windows on it read them without a shuffle.

A bucketed folder is a version like any other; the number of buckets and the key stand in its notes. Spark takes
buckets from catalog entries only, so ``read`` makes one for the folder if the session's catalog has none. A bucket is read by one
task, which AQE cannot split. A table with a bucket that AQE would call skewed (by the session's own settings of the
skew join) is therefore read as plain files: the rows are the same, and the shuffle that follows is one AQE splits.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickerloom.sources.tables import Version

TARGET_BYTES = 256 << 20  # of a bucket's files


def buckets_for(n_bytes: int, target_bytes: int = TARGET_BYTES) -> int:
    return max(8, -(-n_bytes // target_bytes))


def _entry(version: Version) -> str:
    """The catalog name of a version's folder, the same in every session."""
    return f"`{version.name}_{hashlib.sha256(version.path.encode()).hexdigest()[:16]}`"


def write(df: DataFrame, version: Version) -> Version:
    """Write ``df`` in the buckets of the notes ``by`` (key columns) and ``buckets`` (their number); returns the version with bytes per bucket noted.

    The shuffle has one partition per bucket; AQE splits large ones among tasks and merges small ones, so a hot key is
    written by many.
    """
    by, buckets = version.notes["by"], version.notes["buckets"]
    df = df.hint("rebalance", buckets, *by)
    writer = df.write.format("parquet").option("compression", "zstd").option("path", version.path).bucketBy(buckets, *by).sortBy(*by)
    writer.saveAsTable(_entry(version))
    median, largest = _sizes(df.sparkSession, version.path)
    return version.with_notes(median_bytes=median, largest_bytes=largest)


def _bucket() -> Column:
    return F.regexp_extract("path", r"_(\d+)(?:\.[^/]*)?$", 1)


def _sizes(spark: SparkSession, path: str) -> tuple[float, int]:
    """Median and largest bytes of a bucket, from the listing alone."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path).select("path", "length")
    sizes = files.groupBy(_bucket().alias("bucket")).agg(F.sum("length").alias("n_bytes"))
    median, largest = sizes.agg(F.median("n_bytes"), F.max("n_bytes")).first()
    return median or 0.0, largest or 0


def is_even(spark: SparkSession, version: Version) -> bool:
    """No bucket is one that AQE's skew join would split if it were a shuffle's partition."""
    conf, notes = spark.conf, version.notes
    factor = float(conf.get("spark.sql.adaptive.skewJoin.skewedPartitionFactor"))
    least = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(
        conf.get("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes")
    )
    return notes["largest_bytes"] <= max(least, factor * notes["median_bytes"])


def read(spark: SparkSession, version: Version) -> DataFrame:
    """The version's rows, by buckets if these are even."""
    if not is_even(spark, version):
        return version.read(spark)
    entry, notes = _entry(version), version.notes
    if not spark.catalog.tableExists(entry):
        columns = ", ".join(
            f"`{f.name}` {f.dataType.simpleString()}" for f in version.read(spark).schema
        )
        keys = ", ".join(f"`{c}`" for c in notes["by"])
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {entry} ({columns}) USING parquet CLUSTERED BY ({keys}) "
            f"SORTED BY ({keys}) INTO {notes['buckets']} BUCKETS LOCATION '{version.path}'"
        )
    return spark.table(entry)


def forget(spark: SparkSession, version: Version) -> None:
    """Drop the catalog entry; the files stay for ``upkeep.sweep``."""
    spark.sql(f"DROP TABLE IF EXISTS {_entry(version)}")
