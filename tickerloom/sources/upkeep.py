"""Upkeep of a lake: compaction of what is in small files, removal of folders that no publication names.

Both work from two lists, the folders that are there and the log of publications, and touch nothing else.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickerloom.contracts import Contract
from tickerloom.sources import landing, tables

TARGET_BYTES = 128 << 20
VERSION = r"([^/]+/v\d+-[0-9a-f]{32})"
LOAD = r"(load=[0-9a-f]+)"


# --- compaction by need --------------------------------------------------------------


def _files(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(path, length, modificationTime) of the data files under folders, from the listing alone."""
    reader = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", True)
    return reader.load(paths).select("path", "length", "modificationTime")


def _wasteful(target: int) -> Column:
    """At least twice as many files as their bytes need."""
    needed = F.greatest(F.ceil(F.sum("length") / F.lit(target)), F.lit(1))
    return F.count(F.lit(1)) >= 2 * needed


def crowded_partitions(spark: SparkSession, version: tables.Version, by: str, target: int = TARGET_BYTES) -> list[int]:
    """Partitions of a published table (calendar years) whose files are at least twice as many as needed."""
    moved = version.notes.get("moved", {}).get("folders", {})
    value = F.regexp_extract("path", f"/{by}=(-?\\d+)/", 1)
    key = F.regexp_extract("path", f"/{VERSION}/", 1)
    home = F.lit("/".join(version.path.rstrip("/").split("/")[-2:]))
    lies = F.create_map(*[F.lit(x) for v, f in moved.items() for x in (v, "/".join(f.rstrip("/").split("/")[-2:]))]) if moved else None
    where = F.coalesce(F.try_element_at(lies, value), home) if moved else home
    files = _files(spark, sorted({version.path, *moved.values()})).filter((value != "") & (key == where))
    found = files.groupBy(value.cast("int").alias("value")).agg(_wasteful(target).alias("crowded"))
    return sorted(r.value for r in found.filter("crowded").collect())


def compact_partitions(
    spark: SparkSession, lake: str, name: str, by: str, cluster_by: tuple[str, ...] = (), target: int = TARGET_BYTES
) -> list[int]:
    """Rewrite only the crowded partitions of a published table; returns them. All others keep their files.

    Raises ``Overtaken`` if the table was published meanwhile; nothing is published then.
    """
    current = tables.current_versions(spark, lake)
    version = current[name]
    values = crowded_partitions(spark, version, by, target)
    if values:
        rows = version.read(spark).filter(F.col(by).isin(values))
        written = tables.next_version(lake, name, rows.schema, current, "compaction")
        tables.write_table(rows, written.path, (by,), cluster_by)
        tables.publish(spark, lake, [version.with_partitions(by, values, written.path, version.run)], tables.last_commit(current))
    return values


def compact_loads(spark: SparkSession, contract: Contract, lake: str, target: int = TARGET_BYTES) -> int:
    """Merge the loads of a raw table whose files are small into one load; returns their number.

    Small are files of less than half the target on average. Large loads keep their files; merged ones stay known as
    landed. A load that is landed meanwhile is not affected, and a refresh under way goes on.
    """
    current = tables.current_versions(spark, lake)
    version = current[f"raw_{contract.name}"]
    load = F.regexp_extract("path", f"/{LOAD}/", 1)
    sizes = _files(spark, [version.path]).groupBy(F.substring_index(load, "=", -1).alias("load"))
    sizes = sizes.agg(F.avg("length").alias("mean")).join(landing.live_loads(spark, lake, version), "load", "left_semi")
    small = sorted(r.load for r in sizes.filter(F.col("mean") < target / 2).collect())  # names of loads
    if len(small) < 2:
        return 0
    rows = version.read(spark).filter(F.col("load").isin(small)).drop("load")
    merged = uuid.uuid4().hex
    partition_by = ("status",) + ((contract.year_column,) if contract.year_column else ())
    tables.write_table(rows, f"{version.path}/load={merged}", partition_by, contract.columns[:1])
    notes = version.notes | {"replaced": small, "touched": []}
    merged_version = replace(version, run=f"{landing.MERGED}.{merged}", info=json.dumps(notes, sort_keys=True))
    tables.publish(spark, lake, [merged_version], tables.last_commit(current))
    return len(small)


# --- retention -----------------------------------------------------------------------


def _folders(spark: SparkSession, lake: str) -> DataFrame:
    """(key, version, path, changed) of the lake's version folders and of the loads in them and in the ledger.

    One row a folder of a version or load, as many as the log has; not of partitions or files.
    """
    hadoop = spark._jvm.org.apache.hadoop.fs
    root = hadoop.Path(lake)
    system, found = root.getFileSystem(spark._jsc.hadoopConfiguration()), []
    for depth, pattern in ((2, "*/v*"), (3, "*/v*/load=*"), (3, f"{landing.FILES}/*/load=*")):
        for status in system.globStatus(hadoop.Path(root, pattern)) or []:
            if status.isDirectory():
                path = status.getPath().toString()
                parts = path.split("/")[-depth:]
                found.append(("/".join(parts), "/".join(parts[:2]), path, status.getModificationTime()))
    return spark.createDataFrame(found, "key string, version string, path string, changed long")


def _key(path) -> Column:
    return F.array_join(F.slice(F.split(path, "/"), -2, 2), "/")


def reachable(spark: SparkSession, lake: str, keep: int, since: dt.datetime) -> DataFrame:
    """Keys of the folders that a reader may need: those of each table's last ``keep`` publications, and of those that were
    current at ``since`` or later; in them all published loads, but those a compaction replaced before ``since``."""
    log = tables.publications(spark, lake).filter("path <> ''")
    log = log.select("name", "number", "path", "run", "info", F.col("_metadata.file_modification_time").alias("at"))
    of_table = Window.partitionBy("name").orderBy("number")
    newest = F.row_number().over(Window.partitionBy("name").orderBy(F.desc("number")))
    log = log.withColumn("ended", F.lead("at").over(of_table)).withColumn("nth", newest)
    live = log.filter((F.col("nth") <= keep) | F.col("ended").isNull() | (F.col("ended") >= F.lit(since)))
    moved = F.map_values(F.from_json(F.get_json_object("info", "$.moved.folders"), "map<string,string>"))
    paths = live.select("path").union(live.select(F.explode(moved)))
    versions = paths.select(_key("path").alias("key")).distinct()
    load = F.coalesce(F.get_json_object("info", "$.load"), F.get(F.split("run", r"\."), F.lit(1)))
    named = log.select("name", _key("path").alias("version"), load.alias("load")).filter("load IS NOT NULL")
    gone = log.filter(F.col("at") < F.lit(since)).select(F.explode(landing.replaced()).alias("load")).distinct()
    loads = named.join(versions.withColumnRenamed("key", "version"), "version", "left_semi").join(gone, "load", "left_anti")
    ledger = named.select(F.concat(F.lit(f"{landing.FILES}/"), "name", F.lit("/load="), "load"))
    return versions.union(loads.select(F.concat("version", F.lit("/load="), "load"))).union(ledger).distinct()


def unreachable(
    spark: SparkSession, lake: str, keep: int = 2, grace: dt.timedelta = dt.timedelta(days=7), now: dt.datetime | None = None
) -> DataFrame:
    """(key, path) of the folders that no reader needs and that were last written before the grace time.

    They are left by crashed and refused runs, by landings of known rows, by replaced versions and merged loads. Their age is that of
    their newest data file, or of the folder if it has none; one whose store tells no time is kept.
    """
    since = (now or dt.datetime.now(dt.timezone.utc)) - grace
    folders = tables.stored(_folders(spark, lake), "folders")
    dead = folders.join(reachable(spark, lake, keep, since), "key", "left_anti")
    whole = dead.filter("key = version").select(F.col("key").alias("version"))
    dead = tables.stored(dead.filter("key = version").unionByName(dead.filter("key <> version").join(whole, "version", "left_anti")), "dead")
    paths = [r.path for r in dead.select("path").collect()]
    if not paths:
        return dead.select("key", "path")
    version = F.regexp_extract("path", f"/{VERSION}/", 1)
    load = F.regexp_extract("path", f"/{VERSION}/{LOAD}/", 2)
    ledger = F.regexp_extract("path", f"/({landing.FILES}/[^/]+/{LOAD})/", 1)
    keys = F.array_distinct(F.array(version, F.concat_ws("/", version, load), ledger))
    ages = _files(spark, paths).select(F.explode(keys).alias("key"), F.unix_millis("modificationTime").alias("at"))
    ages = ages.groupBy("key").agg(F.max("at").alias("at"))
    old = F.coalesce("at", F.when(F.col("changed") > 0, F.col("changed"))) < F.lit(int(since.timestamp() * 1000))
    return dead.join(ages, "key", "left").filter(old).select("key", "path")


def sweep(spark: SparkSession, lake: str, keep: int = 2, grace: dt.timedelta = dt.timedelta(days=7), now=None) -> list[str]:
    """Delete what ``unreachable`` finds; returns the keys. ``grace`` must be longer than any run and any reader takes.

    Can be repeated after a crash, and run beside writers and readers.
    """
    hadoop, conf = spark._jvm.org.apache.hadoop.fs, spark._jsc.hadoopConfiguration()
    found = sorted((r.key, r.path) for r in unreachable(spark, lake, keep, grace, now).collect())  # a row per folder
    for _, path in found:
        target = hadoop.Path(path)
        target.getFileSystem(conf).delete(target, True)
    return [key for key, _ in found]
