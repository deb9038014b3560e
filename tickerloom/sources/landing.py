"""Landing CSV sources as typed, partitioned Parquet, once per content."""

from __future__ import annotations

import json
import uuid
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tickerloom.contracts import Contract
from tickerloom.sources import tables
from tickerloom.sources.csv_files import parsed, read_cells, rejected_rows

MERGED = "merged"  # content of loads that compaction wrote
FILES = "_files"  # digests of the files of each load
APART = ("source_file", "file")  # columns that say where a row came from
DIGEST = ("first", "second", "n")


def digest(rows: DataFrame) -> list[Column]:
    """A digest of rows as a bag: two sums of row hashes and the count; no order, no cancelling.

    Which cells are null is hashed too, as a null alone leaves a hash unchanged.
    """
    cells = [F.col(c) for c in rows.columns if c not in APART]
    cells += [c.isNull() for c in cells]
    sums = [F.sum(F.xxhash64(F.lit(seed), *cells).cast("decimal(38,0)")) for seed in (1, 2)]
    return [s.alias(name) for s, name in zip([*sums, F.count(F.lit(1))], DIGEST)]


def _content(sums) -> str:
    first, second, n = sums
    return f"{int(first or 0):x}_{int(second or 0):x}_{int(n or 0):x}"


def content_of(rows: DataFrame) -> str:
    return _content(rows.agg(*digest(rows)).first())


def prepare(
    spark: SparkSession,
    contract: Contract,
    csv_path: str,
    lake: str,
    append: bool = False,
    ordered_by_date: bool = False,
) -> tables.Version | None:
    """Write a CSV source as a load that becomes visible once its version is published.

    By default the files replace what was landed before, as a new version. With
    ``append`` they are added to the current version, without those files whose rows it holds already: files are known
    by the digests of their rows, whatever their names, sizes and times. None
    if the table already holds exactly this content (``append``: no file is new).

    Where something was landed before, the text is read for its digests first, so that only rows that are new are shuffled and
    written. The digests that are kept are those of the written rows.

    The header is checked before anything is written. Accepted and rejected rows come
    from one pass over the text and go to partitions of their own, the accepted ones by
    year, so that a refresh of some years reads those only. Rows are rebalanced on these
    partitions, so their files are even however many tasks read the text, and a symbol's prices of a year lie together in
    them, so that the roll-up is aggregated before its shuffle; files in the order of their dates need no shuffle.
    """
    cells = read_cells(spark, csv_path, contract)
    tables.create_lake(spark, lake)
    name = f"raw_{contract.name}"
    current = tables.current_versions(spark, lake)
    append = append and name in current

    status = F.when(F.col("bad_columns").isNull(), "accepted").otherwise("rejected")
    rows = parsed(cells, contract).withColumn("status", status)
    partition_by = ("status",)
    if contract.year_of:
        rows = rows.withColumn(contract.year_column, F.year(contract.year_of))
        partition_by += (contract.year_column,)
    schema = StructType([*rows.schema.fields]).add("load", "string")
    cells_of = [c for c in rows.columns if c not in partition_by] + ["load", *partition_by]  # in the order their digest has them
    version = tables.next_version(lake, name, schema, current, "")
    if append:
        notes = {k: v for k, v in current[name].notes.items() if k != "replaced"}
        version = replace(version, path=current[name].path, info=json.dumps(notes, sort_keys=True))

    def write(df: DataFrame, balance: bool) -> tuple[str, DataFrame]:
        """Rows in a load of their own, and the digests of its files."""
        load = uuid.uuid4().hex
        cluster_by = (contract.together,) if balance and contract.together else ()
        tables.write_table(df, f"{version.path}/load={load}", partition_by, cluster_by, balance, contract.together)
        written = spark.read.schema(schema).parquet(f"{version.path}/load={load}").select(*cells_of)
        written.groupBy("file").agg(*digest(written)).write.parquet(f"{_ledger(lake, name)}/load={load}")
        return load, spark.read.parquet(f"{_ledger(lake, name)}/load={load}")

    if name in current:
        read = rows.withColumn("load", F.lit(None).cast("string")).select(*cells_of)
        files = tables.stored(read.groupBy("file").agg(*digest(read)), "digests")
        if _is_landed(spark, lake, current[name], _load_content(files), append):
            return None
        if append:
            loads = _published(spark, lake, current[name]).select("load")
            known = spark.read.parquet(_ledger(lake, name)).join(loads, "load", "left_semi").select(*DIGEST).distinct()
            new = files.join(known, list(DIGEST), "left_anti").select("file")
            n_files, n_new = files.count(), new.count()
            if n_files and not n_new:
                return None
            if n_new < n_files:
                rows = rows.join(tables.stored(new, "new-files"), "file", "left_semi").select(*rows.columns)
    load, files = write(rows, not ordered_by_date)
    version = replace(version, run=f"{_load_content(files)}.{load}")
    if append and contract.year_of:
        notes = version.notes | {"touched": years_of(spark, contract, version)}
        version = replace(version, info=json.dumps(notes, sort_keys=True))
    return version


def _ledger(lake: str, name: str) -> str:
    return f"{lake}/{FILES}/{name}"


def _load_content(files: DataFrame) -> str:
    """The digest of a load from those of its files, as sums add up."""
    return _content(files.agg(*[F.sum(F.col(c).cast("decimal(38,0)")) for c in DIGEST]).first())


def land(spark: SparkSession, contract: Contract, csv_path: str, lake: str, append: bool = False, **options) -> bool:
    """Land a CSV source as ``raw_<name>``; False if this content has been landed already.

    If another writer landed files of this source meanwhile, what is new is found out again.
    """
    while True:
        tables.create_lake(spark, lake)
        seen = tables.last_commit(tables.current_versions(spark, lake))
        version = prepare(spark, contract, csv_path, lake, append, **options)
        if version is None:
            return False
        try:
            tables.publish(spark, lake, [version], seen)
        except tables.Overtaken:
            continue
        return True


def compact_landed(spark: SparkSession, contract: Contract, lake: str) -> None:
    """Merge the files of all loads into a new version; the loads stay known as landed."""
    current = tables.current_versions(spark, lake)
    version = current[f"raw_{contract.name}"]
    load = uuid.uuid4().hex
    rows = _loaded(spark, lake, version).drop("load")
    schema = StructType(rows.schema.fields).add("load", "string")
    merged = tables.next_version(lake, version.name, schema, current, f"{MERGED}.{load}")
    merged = replace(merged, info=json.dumps({"merges": [*version.notes.get("merges", []), version.path]}))
    partition_by = ("status",) + ((contract.year_column,) if contract.year_column else ())
    tables.write_table(rows, f"{merged.path}/load={load}", partition_by, contract.columns[:1])
    tables.publish(spark, lake, [merged], tables.last_commit(current))


def _published(spark: SparkSession, lake: str, version: tables.Version) -> DataFrame:
    """(path, content, load) of the loads of a raw table and of the versions merged into it."""
    paths = [version.path, *version.notes.get("merges", [])]  # one per compaction
    run = F.split("run", r"\.")
    return (
        tables.publications(spark, lake)
        .filter(F.col("path").isin(paths))
        .select("path", run[0].alias("content"), run[1].alias("load"))
        .distinct()
    )


def _is_landed(spark: SparkSession, lake: str, version: tables.Version, content: str, append: bool) -> bool:
    loads = _published(spark, lake, version).filter(F.col("content") != MERGED)
    found, others = loads.agg(
        F.count_if(F.col("content") == content), F.count_if(F.col("content") != content)
    ).first()
    return found > 0 and (append or others == 0 and found == 1)


def replaced() -> Column:
    """Loads that a publication merged into its own."""
    return F.from_json(F.get_json_object("info", "$.replaced"), "array<string>")


def live_loads(spark: SparkSession, lake: str, version: tables.Version) -> DataFrame:
    """The version's published loads, and its own before that is published, without those merged into others."""
    loads = _published(spark, lake, version).filter(F.col("path") == version.path).select("load")
    own = spark.range(1).select(F.lit(version.run.split(".")[1]).alias("load"))
    log = tables.publications(spark, lake).filter(F.col("path") == version.path)
    merged = log.select(F.explode(replaced()).alias("load"), F.lit(True).alias("gone"))
    marked = loads.union(own).withColumn("gone", F.lit(False)).union(merged)
    return marked.groupBy("load").agg(F.max("gone").alias("gone")).filter("NOT gone").select("load")


def _loaded(spark: SparkSession, lake: str, version: tables.Version) -> DataFrame:
    return version.read(spark).join(live_loads(spark, lake, version), "load", "left_semi")


def _with_status(spark: SparkSession, contract: Contract, lake: str, status: str, version) -> DataFrame:
    version = version or tables.current_version(spark, lake, f"raw_{contract.name}")
    rows = _loaded(spark, lake, version)
    return rows.filter(F.col("status") == status).drop("load", "status")


def landed(spark: SparkSession, contract: Contract, lake: str, version: tables.Version | None = None) -> DataFrame:
    """Accepted rows, with the partition year where the contract has one.

    ``version`` adds a prepared load that is not published yet.
    """
    rows = _with_status(spark, contract, lake, "accepted", version)
    return rows.drop("bad_columns", "text", *APART)


def landing_rejects(spark: SparkSession, contract: Contract, lake: str) -> DataFrame:
    return rejected_rows(_with_status(spark, contract, lake, "rejected", None))


def years_of(spark: SparkSession, contract: Contract, version: tables.Version) -> list[int]:
    """Calendar years of the accepted rows of a prepared load, from its partitions alone."""
    folder = f"{version.path}/load={version.run.split('.')[1]}"
    schema = StructType([f for f in StructType.fromJson(json.loads(version.schema)) if f.name != "load"])
    rows = spark.read.schema(schema).parquet(folder).filter("status = 'accepted'")
    return sorted(r[0] for r in rows.select(contract.year_column).distinct().collect() if r[0] is not None)
