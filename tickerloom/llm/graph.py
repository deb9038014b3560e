"""Connected components of a graph too large for one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerloom.llm.text import in_few_files, kept_table


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (columns a, b, of a type with an order).

    Large stars and small stars alternate: each node's larger neighbours, then the node and its
    smaller ones, are linked to its smallest neighbour, until nothing changes and every
    component is one star. Minima are prepared map-side; the join that hands them back may
    be split where a node has many neighbours. Each round's edges are written, in files by their
    number (a round never has more than the one before), so an executor that is lost costs one round.
    """
    edges = kept_table(
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .where("a <> b")
        .distinct(),
        "star-edges",
    )
    seen = None
    while True:
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
                edges.select("b", "b").distinct()
            )
        seen = state
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy(F.col("a").alias("b")).agg(F.least(F.min("b"), F.col("a")).alias("m"))
        # Only smaller ends have larger neighbours. Repeated links stay: they are fewer than the edges, and the minima
        # and the last distinct() meet them map-side, so no shuffle is spent on them here.
        large = edges.join(lowest, "b").select("a", F.col("m").alias("b")).where("a <> b")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.explode(F.array(
            F.struct(F.col("b").alias("a"), F.col("m").alias("b")),
            F.struct(F.col("a").alias("a"), F.col("m").alias("b")),
        )).alias("e")).select("e.a", "e.b")
        edges = kept_table(in_few_files(small.where("a <> b").distinct(), state[0]), "star-edges")
