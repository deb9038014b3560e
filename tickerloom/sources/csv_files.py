"""CSV ingestion by contract: columns by name, typed cells, rejected rows kept apart."""

from __future__ import annotations

from collections import Counter
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tickerloom.contracts import Contract

RAW_ROW = "_raw_row"


class ContractError(ValueError):
    """A source lacks columns its contract requires."""


def _quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


WHOLE_ROW = "row"  # named among the bad columns where a row has too few or too many cells


def _names_in_file(names: list[str]) -> tuple[list[str], bool]:
    """Column names as the header has them, and whether they are: Spark numbers names that repeat.

    Only a header without repeated names can be held against the headers of other files.
    """
    plain = ["" if name == f"_c{i}" else name for i, name in enumerate(names)]
    numbered = Counter(n.removesuffix(str(i)) for i, n in enumerate(plain) if n and n.endswith(str(i)))
    if plain.count("") > 1 or any(n > 1 for n in numbered.values()):
        return names, False
    return plain, True


def read_cells(spark: SparkSession, path: str, contract: Contract) -> DataFrame:
    """The contract's columns as text, renamed, with the file each row came from.

    Columns are found by header name, whose case matters only if the session says so;
    others are skipped. There is no inference pass.
    With ``enforceSchema`` off, a file whose header order differs from the first file's
    fails the job instead of shifting its values into other columns (unless the header repeats names,
    which cannot be compared). A row with another number
    of cells than its header keeps its line in ``raw_row``; all cells are parsed for that.
    """
    reader = spark.read.option("header", True).option("enforceSchema", False)
    header = reader.csv(path).schema
    folded = str if spark.conf.get("spark.sql.caseSensitive") == "true" else str.lower
    present = {folded(column) for column in header.names}
    missing = [f.source for f in contract.fields if folded(f.source) not in present]
    if missing:
        raise ContractError(f"{contract.name}: missing columns {missing} in {path}")
    names, in_file = _names_in_file(header.names)
    fields = [StructField(name, StringType()) for name in (*names, RAW_ROW)]
    raw = (
        reader.option("columnNameOfCorruptRecord", RAW_ROW)
        .option("columnPruning", False)
        .option("enforceSchema", not in_file)
        .schema(StructType(fields))
        .csv(path)
    )
    return raw.select(
        *[_quoted(f.source).alias(f.name) for f in contract.fields],
        F.col(RAW_ROW).alias("raw_row"),
        F.col("_metadata.file_path").alias("source_file"),
    )


def parsed(cells: DataFrame, contract: Contract) -> DataFrame:
    """Typed columns and a number for the file, plus for each malformed row the columns at fault and its text.

    A row is malformed if it has too few or too many cells, if a required cell is missing, or if a
    cell is present but not of the contract's type. Other missing cells are allowed. One
    pass over the text; each cell is cast once.
    """

    def text(field) -> Column:
        return F.col(f"text_{field.name}")

    def at_fault(field) -> Column:
        wrong = text(field).isNotNull() & F.col(field.name).isNull()
        return F.col(field.name).isNull() if field.required else wrong

    whole = F.col("raw_row").isNotNull()
    malformed = reduce(Column.__or__, map(at_fault, contract.fields), whole)
    fault_names = F.when(whole, F.array(F.lit(WHOLE_ROW))).otherwise(
        F.array_compact(F.array(*[F.when(at_fault(f), F.lit(f.name)) for f in contract.fields]))
    )
    row_text = F.struct(*[text(f).alias(f.name) for f in contract.fields], "raw_row")
    return (
        cells.select(
            *[F.col(f.name).try_cast(f.type).alias(f.name) for f in contract.fields],
            *[F.col(f.name).alias(f"text_{f.name}") for f in contract.fields],
            "raw_row",
            "source_file",
            F.xxhash64("source_file").alias("file"),
        )
        .withColumn("malformed", malformed)
        .select(
            *contract.columns,
            F.when(F.col("malformed"), fault_names).alias("bad_columns"),
            F.when(F.col("malformed"), row_text).alias("text"),
            F.when(F.col("malformed"), F.col("source_file")).alias("source_file"),
            "file",
        )
    )


def typed_rows(rows: DataFrame, contract: Contract) -> DataFrame:
    """The well-formed rows of a parsed source."""
    return rows.filter(F.col("bad_columns").isNull()).select(*contract.columns)


def rejected_rows(rows: DataFrame) -> DataFrame:
    """The malformed rows of a parsed source as text."""
    return rows.filter(F.col("bad_columns").isNotNull()).select(
        "text.*", "bad_columns", "source_file"
    )


def read_csv(spark: SparkSession, path: str, contract: Contract) -> DataFrame:
    """The well-formed rows of a CSV source, typed."""
    return typed_rows(parsed(read_cells(spark, path, contract), contract), contract)
