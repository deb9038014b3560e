"""Quality rules as a short-circuit cascade.

Each rule's cost and selectivity are estimated on a sample; rules then stand in one CASE in the
order of rejections per cost, where a rule's rejections are those among documents that the rules before it let
pass. Costs are measured over repeated rows, less the time to read them. The order changes the work, never the verdict: a rejected
document is not looked at by later rules, of which those over letters scan the whole text. The base counts
are part of the result and are made for all documents.

Edge cases: a null text has no words and fails the word count; equal rows get equal results; an
empty table gives an empty result; other columns are not looked at. Three-word windows are
compared by a 64-bit hash of their words within one document (two different windows of a
20,000-word text agree with a probability of 1e-11).
"""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickerloom.llm.text import bounded_sample, kept_table, sealed, words

SYMBOLS = "#*$%&|<>"
SAMPLE = 2000  # documents on which rules are weighed
WINDOW = 3
MEASURED = 16 << 20  # bytes of text that a rule's cost is measured on
MOST_REPEATS = 4096
RUNS = 2
LEAST = 0.01  # of the time to read the rows: the least cost of a rule

#: Rejecting conditions of the method: limits on shares, in percent of words, lines or characters.
RULES = {
    "symbols": "100 * n_symbols > 30 * n_words",
    "shouting": "100 * length(regexp_replace(text, '[^\\\\p{Lu}]+', '')) > 50 * word_chars",
    "same_lines": "100 * n_dup_lines > 50 * n_lines",
    "long_words": "word_chars > 25 * n_words",
    "short_words": "word_chars < 2 * n_words",
    "few_letters": "100 * length(regexp_replace(text, '[^\\\\p{L}]+', '')) < 40 * word_chars",
}


def counted(docs: DataFrame, id_col="doc_id", text_col="text") -> DataFrame:
    """The base counts of every document, in row: nothing is shuffled.

    Windows that occur again are neighbours once a document's windows are sorted by hash.
    """
    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    )
    rows = rows.select("doc_id", "text", words(F.col("text")).alias("w"))
    rows = rows.select(
        "doc_id",
        "text",
        F.size("w").cast("long").alias("n_words"),
        F.filter(F.split("text", "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]")).alias("lines"),
        F.transform(
            F.slice("w", F.lit(1), F.greatest(F.size("w") - (WINDOW - 1), F.lit(0))),
            lambda x, i: F.xxhash64(x, F.get("w", i + 1), F.get("w", i + 2)),
        ).alias("h"),
    )
    rows = rows.select(
        "*",
        F.when(
            F.size(F.array_distinct("h")) < F.size("h"),
            F.sort_array(F.transform("h", lambda x, i: F.struct(x.alias("h"), i.alias("i")))),
        ).alias("g"),
    )
    same = lambda x, j: (F.get("g", j)["h"] == x["h"])
    rows = rows.select(
        "*",
        F.sort_array(
            F.filter(
                F.transform(
                    "g",
                    lambda x, j: F.when(
                        F.coalesce(same(x, j - 1), F.lit(False)) | F.coalesce(same(x, j + 1), F.lit(False)),
                        x["i"],
                    ),
                ),
                lambda i: i.isNotNull(),
            )
        ).alias("p"),
    )
    covered = F.aggregate(
        F.transform("p", lambda x, j: F.least(F.lit(WINDOW), F.coalesce(F.get("p", j + 1) - x, F.lit(WINDOW)))),
        F.lit(0),
        lambda a, x: a + x,
    )
    gaps = "[\\x20\\x09-\\x0D]+"
    rows = rows.select(
        "doc_id",
        "text",
        "n_words",
        F.length(F.regexp_replace("text", gaps, "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
        F.size("lines").cast("long").alias("n_lines"),
    )
    return sealed(rows)


def base_failed() -> Column:
    return F.expr("n_words < 50 OR 100 * n_repeat_words > 50 * n_words")


def rule_costs(rows: DataFrame, rules=RULES) -> dict[str, float]:
    """Seconds that each rule takes over the counted rows, beyond those of reading them.

    Rows are repeated until they hold MEASURED bytes of text (MOST_REPEATS times at most), so that a rule's own work outweighs
    the start of a job; the least of RUNS times counts, as the first one compiles. No rule is cheaper than LEAST of the
    reading. Without rows all rules cost the same.
    """
    n_bytes = rows.agg(F.sum(F.octet_length("text"))).first()[0]
    if n_bytes is None:
        return dict.fromkeys(rules, 1.0)
    repeats = min(MOST_REPEATS, max(1, MEASURED // max(n_bytes, 1)))
    repeated = rows.select("*", F.explode(F.sequence(F.lit(1), F.lit(repeats))).alias("_again"))

    def seconds(condition: Column) -> float:
        times = []
        for _ in range(RUNS):
            began = time.perf_counter()
            repeated.agg(F.count_if(condition)).collect()
            times.append(time.perf_counter() - began)
        return min(times)

    used = sum((F.col(c) for c in rows.columns if c.startswith("n_")), F.col("word_chars"))
    reading = seconds((F.octet_length("text") < 0) | (used < 0))
    return {name: max(seconds(F.expr(rule)) - reading, LEAST * reading) for name, rule in rules.items()}


def best_order(outcomes: list[tuple[tuple[bool, ...], int]], costs: dict[str, float]) -> list[str]:
    """Rules by rejections per cost, each among the documents that those before it let pass.

    ``outcomes``: which rules (in the order of ``costs``) reject, and how many documents. Of rules that reject
    nothing more the cheapest comes first.
    """
    names, order = list(costs), []
    while len(order) < len(names):
        def worth(name):
            rejected = sum(n for found, n in outcomes if found[names.index(name)])  # noqa: B023
            return -rejected / costs[name], costs[name], name

        best = min((name for name in names if name not in order), key=worth)
        order.append(best)
        outcomes = [(found, n) for found, n in outcomes if not found[names.index(best)]]
    return order


def cascade_order(docs: DataFrame, rules=RULES, sample=SAMPLE, **names) -> list[str]:
    """The order of the rules by their costs and joint outcomes on a sample of documents."""
    id_col, text_col = names.get("id_col", "doc_id"), names.get("text_col", "text")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    some = bounded_sample(rows, sample, "doc_id", "text").repartition(8)
    some = kept_table(counted(some).where(~base_failed()), "quality-sample")
    found = some.select(F.array(*[F.coalesce(F.expr(r), F.lit(False)) for r in rules.values()]).alias("found"))
    outcomes = [(tuple(r.found), r.n) for r in found.groupBy("found").agg(F.count("*").alias("n")).collect()]
    return best_order(outcomes, rule_costs(some, rules))  # ``sample`` outcomes at most


def judged(docs: DataFrame, order: list[str], rules=RULES, **names) -> DataFrame:
    """Base counts, base_failed and kept; a rule is evaluated only where none before it rejected."""
    kept = F.when(base_failed(), F.lit(False))
    for name in order:
        kept = kept.when(F.expr(rules[name]), F.lit(False))
    return counted(docs, **names).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base_failed().alias("base_failed"), kept.otherwise(F.lit(True)).alias("kept"),
    )


def judge(docs: DataFrame, rules=RULES, sample=SAMPLE, **names) -> DataFrame:
    """Every document judged by the cascade."""
    return judged(docs, cascade_order(docs, rules, sample, **names), rules, **names)
