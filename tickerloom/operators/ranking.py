"""Exact percent rank without bringing a whole group into one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickerloom.sources.tables import stored

VALUES_PER_RANGE = 1_000_000  # distinct values that one task ranks


def percent_ranks(df: DataFrame, group: str, value: str, per_range: int = VALUES_PER_RANGE) -> DataFrame:
    """One row per distinct (group, value) with its percent rank among the group's rows.

    Equal values are counted first, so copies collapse to one row. Approximate
    percentiles then cut each group into ranges, as many as its distinct values ask for; rows below a range come from the
    ranges' totals, rows below a value inside its range from a window. The cut points
    only balance the work, the ranks are exact. Nulls are not ranked. The counted values are
    written once, as cut points, totals and ranks all read them.
    """
    counted = (
        df.filter(F.col(value).isNotNull() & F.col(group).isNotNull())
        .groupBy(group, value)
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    counted = stored(counted, "counted-values")
    most = counted.groupBy(group).count().agg(F.max("count")).first()[0] or 0
    ranges = max(2, -(-most // per_range))
    cuts = counted.groupBy(group).agg(
        F.percentile_approx(value, [i / ranges for i in range(1, ranges)], 10 * ranges).alias("_cuts")
    )
    below = F.size(F.filter("_cuts", lambda cut: cut < F.col(value)))
    ranged = (
        counted.join(cuts, group).withColumn("_range", below).drop("_cuts")
    )

    ranges_of_group = Window.partitionBy(group).orderBy("_range")
    totals = (
        ranged.groupBy(group, "_range")
        .agg(F.sum("_n").alias("_in_range"))
        .withColumn("_up_to", F.sum("_in_range").over(ranges_of_group))
        .withColumn("_total", F.sum("_in_range").over(Window.partitionBy(group)))
        .select(group, "_range", (F.col("_up_to") - F.col("_in_range")).alias("_before"), "_total")
    )

    inside = Window.partitionBy(group, "_range").orderBy(value)
    smaller = F.coalesce(
        F.sum("_n").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    return (
        ranged.withColumn("_smaller", smaller)
        .join(totals, [group, "_range"])
        .select(
            group,
            value,
            F.coalesce(
                F.try_divide(F.col("_before") + F.col("_smaller"), F.col("_total") - 1), F.lit(0.0)
            ).alias("percent_rank"),
        )
    )
