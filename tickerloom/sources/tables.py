"""Parquet tables: partitioned writes, versions published through a log, refresh, compaction."""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass, replace

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tickerloom.session import work_dir

BUCKETS = 64  # parts of a partition that keep the rows of a key together
PUBLICATIONS = "_publications"
PUBLICATION_SCHEMA = "commit long, name string, number long, path string, schema string, run string, info string"


def write_table(
    df: DataFrame,
    path: str,
    partition_by: tuple[str, ...] = (),
    cluster_by: tuple[str, ...] | list[str] = (),
    balance: bool = True,
    together: str | None = None,
) -> None:
    """Write Parquet partitioned by ``partition_by``, sorted inside files by ``cluster_by``.

    ``balance`` shuffles the rows into evenly sized files: the rebalance hint lets AQE
    merge small and split large write partitions, so a partition value that holds a
    third of all rows is written by many tasks. File sizes follow
    ``spark.sql.adaptive.advisoryPartitionSizeInBytes``. Leave it off for rows straight
    from a scan, whose tasks are even already.

    ``together`` names a column whose equal values stay in one task of a partition, as far as BUCKETS parts of it are enough:
    without it a large partition is split by where its rows came from, each key lies in as many files as there are, and
    an aggregate on the key hardly shrinks before its shuffle.
    """
    if balance and together:
        bucket = F.pmod(F.xxhash64(together), F.lit(BUCKETS)).cast("byte")
        df = df.withColumn("_bucket", bucket).hint("rebalance", *partition_by, "_bucket").drop("_bucket")
    elif balance:
        df = df.hint("rebalance", *partition_by)
    if cluster_by:
        df = df.sortWithinPartitions(*partition_by, *cluster_by)
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static").option("compression", "zstd")
    writer.partitionBy(*partition_by).parquet(path)


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written to the working folder and read back: computed once, lineage cut."""
    path = work_dir(df.sparkSession, purpose)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def register_views(**frames: DataFrame) -> None:
    """Register frames as temporary views for SQL users."""
    for name, df in frames.items():
        df.createOrReplaceTempView(name)


def append_rows(spark: SparkSession, rows: list[tuple], schema: str, path: str) -> None:
    """Append a few driver-side rows to a log as one file."""
    fields = StructType.fromDDL(schema).fields
    literals = [
        F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(row, fields)])
        for row in rows
    ]
    if not rows:  # start the log
        spark.createDataFrame([], schema).write.mode("ignore").parquet(path)
        return
    log_rows = spark.range(1, numPartitions=1).select(F.inline(F.array(*literals)))
    log_rows.write.mode("append").parquet(path)


# --- versions -----------------------------------------------------------------------
# A version is a directory nobody reads until a row for it stands in the log. A commit is
# one file of the log, named by its number and created only if no other writer has that number, so
# readers see all tables of a run or none, and writers see what was published since they began to read.


class Overtaken(RuntimeError):
    """Others published some of the same tables after a writer had read them; nothing was published."""

    def __init__(self, others: list[Version]):
        self.others = others
        super().__init__(", ".join(f"{v.name} by {v.run}" for v in others))

    def touched(self, by: str = "touched") -> set | None:
        """The partitions that the others replaced or added to; None if one of them replaced a whole table."""
        parts = [v.notes.get(by) for v in self.others]
        return None if None in parts else {value for values in parts for value in values}


@dataclass(frozen=True)
class Version:
    name: str
    number: int
    path: str
    schema: str  # of the written frame, as JSON: reading needs no inference job
    run: str  # pipeline run or load that wrote it
    info: str = "{}"  # JSON: partitions that lie elsewhere, settings of the run that built it
    commit: int = 0  # that published it

    @property
    def notes(self) -> dict:
        return json.loads(self.info)

    def read(self, spark: SparkSession) -> DataFrame:
        """The table: its folder, and the folders of partitions replaced since it was written.

        The number of those is bounded by the partition values (calendar years).
        """
        reader = spark.read.schema(StructType.fromJson(json.loads(self.schema)))
        moved = self.notes.get("moved", {})
        if not moved:
            return reader.parquet(self.path)
        column = F.col(moved["by"])
        folders: dict[str, list[int]] = {}
        for value, folder in moved["folders"].items():
            folders.setdefault(folder, []).append(int(value))
        gone = [v for values in folders.values() for v in values]
        df = reader.parquet(self.path).filter(~column.isin(gone) | column.isNull())
        for folder, values in folders.items():
            df = df.unionByName(reader.parquet(folder).filter(column.isin(values)))
        return df

    def with_partitions(self, by: str, values: list[int], folder: str, run: str) -> Version:
        """The next version: partitions ``values`` are read from ``folder``, all others as before."""
        folders = self.notes.get("moved", {}).get("folders", {}) | {str(v): folder for v in values}
        info = self.notes | {"moved": {"by": by, "folders": folders}, "touched": values}
        return replace(self, number=self.number + 1, run=run, info=json.dumps(info, sort_keys=True))

    def with_notes(self, **notes) -> Version:
        return replace(self, info=json.dumps(self.notes | notes, sort_keys=True))


def _create_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file whole, unless one of that name is there: written aside, then renamed.

    The rename fails if the name is taken, in one step on HDFS; on a local disk a link does the same.
    """
    hadoop, conf = spark._jvm.org.apache.hadoop.fs, spark._jsc.hadoopConfiguration()
    target = hadoop.Path(path)
    system = target.getFileSystem(conf)
    target = system.makeQualified(target)
    aside = hadoop.Path(target.getParent(), f".{uuid.uuid4().hex}")
    out = system.create(aside, True)
    out.write(bytearray(text, "utf-8"))
    out.close()
    try:
        if target.toUri().getScheme() == "file":
            paths = [spark._jvm.java.io.File(p.toUri().getPath()).toPath() for p in (target, aside)]
            spark._jvm.java.nio.file.Files.createLink(*paths)
        else:
            keep = spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 0)
            hadoop.FileContext.getFileContext(target.toUri(), conf).rename(aside, target, keep)
    except Py4JJavaError as error:
        if "AlreadyExists" in error.java_exception.getClass().getName():
            return False
        raise
    finally:
        system.delete(aside, False)
    return True


def create_lake(spark: SparkSession, lake: str) -> None:
    """Start an empty publication log unless the lake has one."""
    _create_if_absent(spark, _commit_path(lake, 0), "")


def _commit_path(lake: str, commit: int) -> str:
    return f"{lake}/{PUBLICATIONS}/{commit:012d}.json"


def publications(spark: SparkSession, lake: str) -> DataFrame:
    return spark.read.schema(PUBLICATION_SCHEMA).json(f"{lake}/{PUBLICATIONS}")


def _versions(rows: DataFrame) -> list[Version]:
    return [Version(**row.asDict()) for row in rows.collect()]


def current_versions(spark: SparkSession, lake: str) -> dict[str, Version]:
    """The latest published version of each table (one row per table)."""
    latest = publications(spark, lake).groupBy("name").agg(
        F.max("number").alias("number"),
        *[F.max_by(c, "number").alias(c) for c in ("path", "schema", "run", "info", "commit")],
    )
    return {v.name: v for v in _versions(latest)}


def last_commit(current: dict[str, Version]) -> int:
    return max((v.commit for v in current.values()), default=0)


def next_version(
    lake: str, name: str, schema: StructType, current: dict[str, Version], run: str, **notes
) -> Version:
    """A version in a folder of its own: runs at the same time never share one."""
    number = current[name].number + 1 if name in current else 1
    path = f"{lake}/{name}/v{number:06d}-{uuid.uuid4().hex}"
    return Version(name, number, path, schema.json(), run, json.dumps(notes, sort_keys=True))


def publish(spark: SparkSession, lake: str, versions: list[Version], seen: int | None = None) -> int:
    """Make written versions current in one commit; returns its number.

    ``seen`` is the last commit that the writer has read. If one of its tables was published since, Overtaken is
    raised: the writer decides whether its work still holds.
    """
    names = {v.name for v in versions}
    while True:
        current = current_versions(spark, lake)
        last = last_commit(current)
        if seen is not None:
            log = publications(spark, lake)
            others = _versions(log.filter((F.col("commit") > seen) & F.col("name").isin(sorted(names)))) if last > seen else []
            if others:
                raise Overtaken(others)
        numbered = [
            replace(v, number=current[v.name].number + 1 if v.name in current else 1, commit=last + 1) for v in versions
        ]
        lines = "".join(json.dumps(asdict(v), sort_keys=True) + "\n" for v in numbered)
        if _create_if_absent(spark, _commit_path(lake, last + 1), lines):
            return last + 1


def current_version(spark: SparkSession, lake: str, name: str) -> Version:
    versions = current_versions(spark, lake)
    if name not in versions:
        raise ValueError(f"{name} has not been published in {lake}")
    return versions[name]


def read_current(spark: SparkSession, lake: str, name: str) -> DataFrame:
    return current_version(spark, lake, name).read(spark)


_held: dict[tuple[str, str, str], tuple[int, DataFrame]] = {}


def held(spark: SparkSession, lake: str, version: Version) -> DataFrame:
    """A published version, kept in Spark's cache for all that read it until another commit of its table is asked for.

    Partitions that do not fit in memory go to disk; lost ones are read again. One version of a table is held at a time.
    """
    key = (spark.sparkContext.applicationId, lake, version.name)
    commit, df = _held.get(key, (None, None))
    if commit != version.commit:
        if df is not None:
            df.unpersist()
        df = version.read(spark).persist()
        _held[key] = (version.commit, df)
    return df


def release(spark: SparkSession, lake: str) -> None:
    """Drop what is held of a lake."""
    for key in [k for k in _held if k[:2] == (spark.sparkContext.applicationId, lake)]:
        _held.pop(key)[1].unpersist()


def register_current(spark: SparkSession, lake: str, name: str, database: str = "default") -> None:
    """Point a catalog view at the current version (one catalog operation)."""
    version = current_version(spark, lake, name)
    moved = version.notes.get("moved")
    if moved is None:
        rest, parts = "", []
    else:
        parts = sorted((folder, int(value)) for value, folder in moved["folders"].items())
        gone = ", ".join(str(value) for _, value in parts)
        rest = f" WHERE {moved['by']} NOT IN ({gone}) OR {moved['by']} IS NULL"
    names = ", ".join(f"`{c}`" for c in StructType.fromJson(json.loads(version.schema)).names)
    queries = [f"SELECT {names} FROM parquet.`{version.path}`{rest}"]
    queries += [
        f"SELECT {names} FROM parquet.`{folder}` WHERE {moved['by']} = {value}" for folder, value in parts
    ]
    spark.sql(f"CREATE OR REPLACE VIEW {database}.{name} AS {' UNION ALL '.join(queries)}")


# --- compaction --------------------------------------------------------------------------


def compact(
    spark: SparkSession,
    source: str,
    target: str,
    partition_by: tuple[str, ...] = (),
    cluster_by: tuple[str, ...] = (),
) -> None:
    """Rewrite a table of many small files as a new version with even files."""
    write_table(spark.read.parquet(source), target, partition_by, cluster_by)


def file_stats(spark: SparkSession, path: str) -> DataFrame:
    """Number of data files and bytes under a path, from the listing alone."""
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.parquet")
        .option("recursiveFileLookup", True)
        .load(path)
        .select("path", "length")
    )
    return files.agg(F.count("path").alias("n_files"), F.sum("length").alias("n_bytes"))
