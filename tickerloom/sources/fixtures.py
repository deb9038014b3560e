"""Market-shaped views over the benchmark tables (orders, lineitem, customer, nation, events)."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickerloom.contracts import FUNDAMENTALS, PRICES, SECURITIES, Contract
from tickerloom.session import work_dir


class MarketFixture:
    """The three source relations, derived lazily from the tables in ``sf_dir``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        """A benchmark table; its schema is inferred once."""
        if name not in self._tables:
            self._tables[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._tables[name]

    @cached_property
    def price_rows(self) -> DataFrame:
        """Price observations before the (symbol, date) grain is made unique."""
        return self._observed(self._lines)

    @cached_property
    def _lines(self) -> DataFrame:
        orders = self.table("orders").select("o_orderkey", "o_custkey")
        lines = self.table("lineitem").withColumn("date", F.col("l_shipdate").cast("date"))  # narrower than the time
        return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).withColumnRenamed("o_custkey", "symbol")

    def _observed(self, lines: DataFrame) -> DataFrame:
        return lines.select(
            "symbol",
            "date",
            F.col("l_extendedprice").alias("close"),
            (F.col("l_extendedprice") * (1 + F.col("l_tax"))).alias("high"),
            (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("low"),
            "l_returnflag",
            "l_linestatus",
            "l_linenumber",
        )

    @cached_property
    def prices(self) -> DataFrame:
        """One row per symbol and date. Shuffled as the lines have them: a price and two rates are narrower than three prices."""
        lines = self._lines.repartition("symbol", "date")
        return self._observed(lines).groupBy("symbol", "date").agg(
            F.max("close").alias("close"), F.max("high").alias("high"), F.min("low").alias("low")
        )

    @cached_property
    def fundamentals(self) -> DataFrame:
        price = F.col("l_extendedprice")
        per_order = (
            self.table("lineitem")
            .groupBy("l_orderkey")
            .agg(
                F.sum(price).alias("gross"),
                F.sum(price * F.col("l_discount")).alias("discount"),
                F.sum(price * F.col("l_tax")).alias("tax"),
                F.sum("l_quantity").alias("quantity"),
            )
        )
        customers = self.table("customer").select("c_custkey", "c_acctbal")
        orders = self.table("orders").join(customers, F.col("o_custkey") == F.col("c_custkey"))  # while rows are narrow
        gross, discount, tax = F.col("gross"), F.col("discount"), F.col("tax")
        total = F.col("o_totalprice")
        return (
            orders.join(per_order, F.col("o_orderkey") == F.col("l_orderkey"), "left")
            .select(
                F.col("o_orderkey").alias("filing_id"),
                F.col("o_custkey").alias("symbol"),
                F.col("o_orderdate").cast("date").alias("period_ending"),
                total.alias("total_revenue"),
                (total - discount).alias("net_income"),
                F.try_divide(100 * (gross - discount), gross).alias("gross_margin"),
                F.try_divide(100 * (gross - discount - tax), gross).alias("operating_margin"),
                F.try_divide(total - discount, 100 * F.col("quantity")).alias("eps"),
                tax.alias("long_term_debt"),
                F.col("c_acctbal").alias("total_equity"),
            )
        )

    @cached_property
    def securities(self) -> DataFrame:
        nations = self.table("nation").select("n_nationkey", "n_name")
        return (
            self.table("customer")
            .join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
            .select(
                F.col("c_custkey").alias("symbol"),
                F.col("c_name").alias("company_name"),
                F.col("c_mktsegment").alias("sector"),
                F.col("n_name").alias("sub_industry"),
            )
        )

    def write_csv(self, contract: Contract, df: DataFrame) -> str:
        """Write a relation as compressed CSV files under the contract's headers; return the folder."""
        path = work_dir(self.spark, f"csv-{contract.name}")
        headed = df.select(*[F.col(f.name).alias(f.source) for f in contract.fields])
        headed.write.options(header=True, compression="gzip").csv(path)
        return path

    def write_csv_parts(self, contract: Contract, df: DataFrame, part: Column) -> str:
        """Write a relation once, as a folder ``part=<value>`` of CSV files for each value; return the folder that holds them."""
        path = work_dir(self.spark, f"csv-{contract.name}")
        headed = df.select(*[F.col(f.name).alias(f.source) for f in contract.fields], part.alias("part"))
        headed.write.options(header=True, compression="gzip").partitionBy("part").csv(path)
        return path

    def csv_sources(self) -> dict[str, str]:
        """The three relations as CSV folders, by contract name."""
        return {
            contract.name: self.write_csv(contract, df)
            for contract, df in (
                (PRICES, self.prices),
                (FUNDAMENTALS, self.fundamentals),
                (SECURITIES, self.securities),
            )
        }

    def malformed_price_csv(self) -> str:
        """All price observations as CSV, malformed by line class.

        Dates or closes that cannot be read, lines with too few or too many cells, no symbol.
        """
        returned, still_open = F.col("l_returnflag") == "R", F.col("l_linestatus") == "O"
        line = F.col("l_linenumber")
        cells = [
            F.when(line == 3, "").otherwise(F.col("symbol").cast("string")),
            F.when(returned, "soon").otherwise(F.col("date").cast("string")),
            F.when(still_open, "n/a").otherwise(F.col("close").cast("string")),
            F.col("high").cast("string"),
            F.col("low").cast("string"),
        ]
        text = F.when(line == 1, F.concat_ws(",", *cells[:3])).when(
            line == 2, F.concat_ws(",", *cells, F.lit("more"))
        )
        header = ",".join(f.source for f in PRICES.fields)
        path = work_dir(self.spark, "csv-malformed")
        lines = self.price_rows.select(text.otherwise(F.concat_ws(",", *cells)).alias(header))
        lines.write.option("header", True).option("sep", "\u0001").csv(path)  # one cell a line
        return path
