"""Mixing sources to target weights by Pareto order sampling.

Every document first gets the whole copies that its source's rate (target / size) is certain
of. The rest of the target is drawn: a document's inclusion is in proportion to its size, one at most, so that the
words expected are those that are left. Documents are ranked by the odds of a random number over
the odds of their inclusion, and the sample has a fixed size, measured in words. Three
documents close the sample: twice the largest that still fits, then the one that comes nearest.

Edge cases: a null text has size 0; a null source is a source of its own, last in order; rows
equal in id, text and source are numbered and drawn each by itself; an empty table gives an
empty result; other columns of the input are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickerloom.llm.text import in_few_files, kept_table, n_words

WEIGHTS = (1, 2, 3)
MOST_COPIES = 3
BITS = 52  # of a draw
CLOSING = 3  # documents that fill what the ranked ones leave of a budget
SLICES = 10  # bits of a draw that name a slice of its source


def draw(id_col: str, text_col: str, source_col: str, seed: int) -> Column:
    """An even draw from [0, 2^52), fixed by the row's id, text and source."""
    of = lambda c, mark: F.coalesce(F.concat(F.lit(mark), F.col(c).cast("string")), F.lit(""))
    text = F.md5(F.coalesce(F.col(text_col), F.lit("")))
    return _even(F.concat_ws(":", F.lit(str(seed)), of(id_col, "i"), text, of(source_col, "s")))


def _even(name: Column) -> Column:
    return F.conv(F.substring(F.md5(name), 1, BITS // 4), 16, 10).cast("long")


def numbered(rows: DataFrame, col: str) -> DataFrame:
    """``rows`` with another draw (column ``col``) for each row but the first of those that share one.

    Equal rows are counted per partition of a written table, so a value that holds any share of all rows is numbered by many tasks.
    """
    repeated = kept_table(rows.groupBy(col).count().where("count > 1").select(col), "mix-repeated")
    if repeated.isEmpty():
        return rows
    part, place, offset = (f"_mix_{c}" for c in ("part", "place", "offset"))
    many = kept_table(rows.join(repeated, col, "left_semi").withColumn(part, F.spark_partition_id()), "mix-copies")
    before = Window.partitionBy(col).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    offsets = many.groupBy(col, part).agg(F.count("*").alias(place)).select(
        col, part, F.coalesce(F.sum(place).over(before), F.lit(0)).alias(offset)
    )
    each = many.withColumn(place, F.row_number().over(Window.partitionBy(col, part).orderBy(col)) - 1)
    number = F.col(offset) + F.col(place)
    other = F.when(number == 0, F.col(col)).otherwise(_even(F.concat_ws(":", F.col(col).cast("string"), number.cast("string"))))
    every = each.join(offsets, [col, part]).withColumn(col, other).select(*rows.columns)
    return rows.join(repeated, col, "left_anti").select(*rows.columns).unionByName(every)


def sized(
    docs: DataFrame, id_col="doc_id", text_col="text", source_col="source", seed=42
) -> DataFrame:
    """One narrow row per document: id, source, size and draw."""
    return docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(source_col).alias("source"),
        n_words(F.col(text_col)).alias("size"),
        draw(id_col, text_col, source_col, seed).alias("draw"),
    )


def ranked(draw_col: Column, size: Column, slope: Column) -> Column:
    """A long in the order of random odds over inclusion odds, if inclusion is ``slope`` times the size, one at most."""
    chance = F.least(F.lit(1.0), slope * size.cast("double"))
    u = (draw_col.cast("double") + 0.5) / F.lit(float(1 << BITS))
    mine, others = u * (1 - chance), (1 - u) * chance
    return F.floor(mine / (mine + others) * float(1 << BITS)).cast("long")


def slopes(rows: DataFrame, goals: DataFrame) -> DataFrame:
    """``goals`` with the slope of inclusion over size that fills each source's budget.

    The largest documents may be certain: of the sizes that could be the largest uncertain one, the largest counts for which no
    inclusion is above one. Sums per size are prepared by the tasks; a source has a row per size here.
    """
    sizes = rows.where("size > 0").groupBy("source", "size").agg(F.count("*").alias("n"))
    same = F.col("g.source").eqNullSafe(F.col("s.source"))
    upto = Window.partitionBy("source").orderBy("size")
    every = Window.partitionBy("source")
    words, squares = F.col("n") * F.col("size"), (F.col("n") * F.col("size") * F.col("size")).cast("double")
    sums = sizes.select(
        "source", "size", (F.sum(words).over(every) - F.sum(words).over(upto)).alias("certain"), F.sum(squares).over(upto).alias("squares")
    )
    slope = (F.col("g.budget") - F.col("s.certain").cast("double")) / F.col("s.squares")
    fitting = (
        sums.alias("s").join(goals.alias("g"), same)
        .select("g.source", "s.size", slope.alias("slope"))
        .where((F.col("slope") >= 0) & (F.col("slope") * F.col("size").cast("double") <= 1))
    )
    best = fitting.groupBy("source").agg(F.max_by("slope", "size").alias("slope"))
    return goals.alias("g").join(best.alias("s"), same, "left").select("g.*", F.coalesce("s.slope", F.lit(0.0)).alias("slope"))


def targets(sizes: DataFrame, weights=WEIGHTS, most=MOST_COPIES) -> DataFrame:
    """Per source (columns source, source_size): its target in words.

    Sources reach their ceiling in the order of ceiling / weight; the first that stays below
    its share of what the ones before it leave fixes the rate for all later ones, which is where resharing
    round by round ends. One row per source meets in the windows.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    all_rows = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    weighed = sizes.withColumn(
        "weight",
        F.element_at(cycle, (F.row_number().over(by_name) - 1) % len(weights) + 1),
    ).withColumn("ceiling", F.col("source_size") * F.lit(float(most)))
    order = [F.col("ceiling") / F.col("weight"), F.col("source").asc_nulls_last()]
    before = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    rate = weighed.select(
        "*",
        (
            (F.sum("source_size").over(all_rows) - F.coalesce(F.sum("ceiling").over(before), F.lit(0.0)))
            / (F.sum("weight").over(all_rows) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
        ).alias("rate"),
        F.row_number().over(Window.orderBy(*order)).alias("place"),
    )
    free = F.when(F.col("weight") * F.col("rate") <= F.col("ceiling"), F.col("place"))
    settled = rate.withColumn("first_free", F.min(free).over(all_rows))
    final = F.max(F.when(F.col("place") == F.col("first_free"), F.col("rate"))).over(all_rows)
    return settled.withColumn("final", final).select(
        "source",
        "source_size",
        F.when(F.col("place") < F.col("first_free"), F.col("ceiling"))
        .otherwise(F.least("ceiling", F.col("weight") * F.col("final")))
        .alias("target"),
    )


def goals_of(rows: DataFrame, weights=WEIGHTS, most=MOST_COPIES) -> DataFrame:
    """Per source: its target, whole copies, the budget that is left, and the slope of inclusion."""
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    goals = targets(kept_table(in_few_files(sizes), "mix-sizes"), weights, most)
    rate = F.coalesce(F.try_divide("target", "source_size"), F.lit(0.0))
    goals = goals.withColumn("whole", F.floor(rate)).withColumn(
        "budget", F.col("target") - F.col("whole") * F.col("source_size")
    )
    return kept_table(in_few_files(slopes(rows, goals)), "mix-goals")


def with_ranks(rows: DataFrame, goals: DataFrame) -> DataFrame:
    """Rows with their rank in place of their draw."""
    same = F.col("g.source").eqNullSafe(F.col("s.source"))
    rank = ranked(F.col("s.draw"), F.col("s.size"), F.col("g.slope"))
    return rows.alias("s").join(goals.alias("g"), same).select("s.doc_id", "s.source", "s.size", rank.alias("draw"))


def cuts(rows: DataFrame, goals: DataFrame) -> DataFrame:
    """Per source: target, whole copies, the rank up to which documents are in, the closing ranks.

    Only the slice of a source in which its budget ends is ordered row by row; all else works on
    sums that tasks prepare, so a source with any share of the rows is never gathered.
    """
    piece = F.shiftright("draw", BITS - SLICES)
    slices = rows.groupBy("source", piece.alias("slice")).agg(F.sum("size").alias("words"))
    slices = kept_table(in_few_files(slices), "mix-slices")  # at most 1025 rows a source
    upto = Window.partitionBy("source").orderBy("slice")
    same = F.col("g.source").eqNullSafe(F.col("s.source"))
    running = slices.withColumn("end", F.sum("words").over(upto))
    ending = (
        running.alias("s")
        .join(goals.alias("g"), same & (F.col("end") > F.col("budget")))
        .groupBy(F.col("g.source").alias("source"))
        .agg(F.min(F.struct("slice", (F.col("end") - F.col("words")).alias("start"))).alias("e"))
        .select("source", F.col("e.slice").alias("slice"), F.col("e.start").alias("start"))
    )
    goals = (
        goals.alias("g")
        .join(ending.alias("s"), same, "left")
        .select("g.*", F.col("s.slice").alias("slice"), F.coalesce("s.start", F.lit(0)).alias("start"))
    )
    open_rows = (
        rows.withColumn("slice", piece)
        .alias("s")
        .join(goals.alias("g"), same)
        .where(F.col("s.slice") == F.col("g.slice"))
        .select("g.source", "s.draw", "s.size", "g.start", "g.budget")
    )
    by_rank = open_rows.groupBy("source", "draw", "start", "budget").agg(F.sum("size").alias("size"))
    sums = by_rank.withColumn(
        "end",
        F.col("start")
        + F.sum("size").over(
            Window.partitionBy("source").orderBy("draw").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        ),
    )
    last = (
        sums.where(F.col("end") <= F.col("budget"))
        .groupBy("source")
        .agg(F.max("draw").alias("last"), F.max("end").alias("end"))
    )
    # Without a row of the open slice inside the budget, the slices before it are all that is in.
    floor_draw = F.coalesce(F.shiftleft(F.col("g.slice").cast("long"), BITS - SLICES), F.lit(1 << BITS)) - 1
    limits = (
        goals.alias("g")
        .join(last.alias("s"), same, "left")
        .select(
            "g.source", "g.source_size", "g.target", "g.whole", "g.budget",
            F.when(F.col("g.budget") > 0, F.coalesce("s.last", floor_draw))
            .otherwise(F.lit(-1)).cast("long").alias("last"),
            (F.col("g.budget") - F.coalesce("s.end", "g.start")).alias("gap"),
            F.col("g.slice").isNotNull().alias("open"),
        )
    )
    limits = kept_table(
        in_few_files(limits.withColumn("closing", F.array().cast("array<long>"))), "mix-limits"
    )
    miss = F.abs(F.col("s.size") - F.col("g.gap"))
    for turn in range(CLOSING):
        fits = miss < F.col("g.gap")
        if turn < CLOSING - 1:
            fits = fits & (F.col("s.size") <= F.col("g.gap"))
        best = (
            rows.alias("s")
            .join(limits.where("open and gap > 0").alias("g"), same)
            .where(fits & (F.col("s.draw") > F.col("g.last")))
            .where(~F.array_contains("g.closing", F.col("s.draw")))
            .groupBy(F.col("g.source").alias("source"))
            .agg(F.min(F.struct(miss.alias("miss"), F.col("s.draw").alias("draw"), "s.size")).alias("best"))
        )
        closed = limits.alias("g").join(best.alias("s"), same, "left").select(
            "g.source", "g.source_size", "g.target", "g.whole", "g.last", "g.open",
            (F.col("g.gap") - F.coalesce("s.best.size", F.lit(0))).alias("gap"),
            F.when(F.col("s.best").isNull(), F.col("g.closing"))
            .otherwise(F.array_append("g.closing", F.col("s.best.draw"))).alias("closing"),
        )
        limits = kept_table(in_few_files(closed), "mix-limits")
    return limits.select("source", "source_size", "target", "whole", "last", "closing")


def copies(limits_alias: str, draw_col: Column) -> Column:
    """How often the mix takes a row: its whole copies, and one more if it is drawn."""
    g = limits_alias
    drawn = (draw_col <= F.col(f"{g}.last")) | F.array_contains(F.col(f"{g}.closing"), draw_col)
    return F.col(f"{g}.whole") + drawn.cast("long")


def mix(docs: DataFrame, weights=WEIGHTS, most=MOST_COPIES, seed=42, **names) -> DataFrame:
    """doc_id, size, source_size, target, taken and n_copies of every document."""
    rows = kept_table(numbered(sized(docs, seed=seed, **names), "draw"), "mix-rows")
    goals = goals_of(rows, weights, most)
    rows = with_ranks(rows, goals)
    same = F.col("g.source").eqNullSafe(F.col("s.source"))
    n = copies("g", F.col("s.draw"))
    return (
        rows.alias("s")
        .join(cuts(rows, goals).alias("g"), same)
        .select(
            "s.doc_id", "s.size", "g.source_size", "g.target",
            (F.col("s.size") * n).alias("taken"), n.alias("n_copies"),
        )
    )


def mixed_documents(
    docs: DataFrame, id_col="doc_id", text_col="text", source_col="source", seed=42,
    weights=WEIGHTS, most=MOST_COPIES,
) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it; columns as they were.

    Each row decides by its own rank against its source's cuts, so texts are not shuffled
    while the cuts are below the broadcast threshold and no row is repeated.
    """
    rows = kept_table(numbered(sized(docs, id_col, text_col, source_col, seed), "draw"), "mix-rows")
    goals = goals_of(rows, weights, most)
    limits = cuts(with_ranks(rows, goals), goals)
    same = F.col("s.source").eqNullSafe(F.col("g.source"))
    limits = kept_table(limits.alias("s").join(goals.alias("g"), same).select("s.*", "g.slope"), "mix-limits")  # of known size
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")  # its names meet no other
    own = numbered(docs.select(whole, draw(id_col, text_col, source_col, seed).alias("draw"), F.col(source_col).alias("source"), n_words(F.col(text_col)).alias("size")), "draw")
    joined = own.alias("s").join(limits.alias("g"), same)
    rank = ranked(F.col("s.draw"), F.col("s.size"), F.col("g.slope"))
    times = copies("g", rank).cast("int")
    return joined.withColumn("copy", F.explode(F.array_repeat(F.lit(1), times))).select("row.*")
