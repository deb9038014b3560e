"""Words, keys and batches that the operators of this package share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickerloom.session import work_dir

SPACES = " \t\n\x0b\x0c\r"  # the characters that part words, 0x20 and 0x09 to 0x0D
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LAST_ID = (1 << 63) - 1  # stands for a missing id, so that it sorts last
FILES, ROWS_A_FILE = 24, 1 << 20  # of small written tables


def words(text: Column) -> Column:
    """The words of a text as an array; none for null and for text without a word."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(
        F.split(trimmed, "[\\x20\\x09-\\x0D]+")
    )


def n_words(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def lower_ascii(text: Column) -> Column:
    """A to Z in lower case, all else unchanged."""
    return F.translate(text, UPPER, UPPER.lower())


def row_key(id_col: str, text_col: str) -> list[Column]:
    """Two longs that name a row: its id (missing: the last one) and its text's hash.

    Rows equal in both are copies of one row and are treated alike.
    """
    return [
        F.coalesce(F.col(id_col).cast("long"), F.lit(LAST_ID)).alias("_id"),
        F.xxhash64(F.col(text_col)).alias("_hash"),
    ]


def bounded_batches(spark: SparkSession) -> None:
    """Keep Arrow batches of texts small: at most 512 rows, and 8 MB where Spark can cut by bytes."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "512")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))


def sealed(df: DataFrame) -> DataFrame:
    """The same rows, with a border that no filter crosses.

    Pushed below, a filter's copy of an array column would be computed anew for each element of the
    arrays that look it up.
    """
    return df.select(F.inline(F.array(F.struct(*[F.col(f"`{c}`") for c in df.columns]))))


def kept_table(df: DataFrame, purpose: str) -> DataFrame:
    """Write to the folder all executors share and read back: the lineage ends here."""
    spark = df.sparkSession
    path = work_dir(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def in_few_files(df: DataFrame, rows: int = 0) -> DataFrame:
    """Merge the last stage's tasks for a table of about ``rows`` rows: FILES tasks, more from ROWS_A_FILE rows for each.

    A table that is written after a shuffle otherwise has as many files as the shuffle has partitions, where AQE does not merge
    them; for a table of few rows creating and renaming those takes longer than the rows.
    """
    return df.coalesce(max(FILES, rows // ROWS_A_FILE))


def bounded_sample(rows: DataFrame, most: int, *by: str) -> DataFrame:
    """At most ``most`` rows, chosen by the hash of the columns ``by``.

    A share of the rows, fixed by their count, is let through before they are ordered, so the task that
    orders them reads about ``most`` rows whatever the input.
    """
    n = rows.count()
    draw = F.pmod(F.xxhash64(*by), F.lit(1 << 32))
    if n > 2 * most:
        rows = rows.where(draw < F.lit(int((1 << 32) * min(1.0, (1.2 * most + 200) / n))))
    return rows.orderBy(draw, *by).limit(most)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
