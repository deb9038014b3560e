"""License scans: an exact set-similarity join of text blocks with license templates.

A block is a line; its tokens are its distinct words. Tokens are ordered by how many documents
hold them, rarest first. A block contains a template if it holds at least 90 % of its tokens.
Such a block must hold one of the template's first tokens in that order (prefix filter), must have as many tokens as are
needed (length filter), and from the first shared token on the block must have enough tokens
of templates left in that order (positional filter). What passes is counted exactly.

Edge cases: a null text is empty: no words, no labels, score 0; equal rows get equal results;
templates with equal tokens each give their label; an empty table gives an empty result; other
columns are not looked at.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickerloom.llm.text import lower_ascii, row_key, sealed

# Phrases and labels of the base scan.
PHRASES = {
    "cc-by": ("cc", "by"),
    "gpl": ("general", "public", "license"),
    "reserved": ("all", "rights", "reserved"),
}
# Notices by which licenses are recognised, with their labels.
TEMPLATES = {
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "mit": "Released under the MIT License.",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "cc-by-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "cc-by-sa-4.0": "Licensed under CC BY-SA 4.0.",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted.",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "permission": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software.",
    "all-rights-reserved": "All rights reserved.",
    "public-domain": "This work has been dedicated to the public domain.",
}
THRESHOLD = 0.9
WORD = "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
GAP = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"


def scan_words(text: Column) -> Column:
    """Words of a lower-cased text: ASCII letters and digits, and all that is not ASCII."""
    spaced = F.trim(F.regexp_replace(lower_ascii(F.coalesce(text, F.lit(""))), GAP, " "))
    return F.when(spaced == "", F.array().cast("array<string>")).otherwise(F.split(spaced, " "))


def template_tokens(templates: dict[str, str]) -> dict[str, list[str]]:
    found = {k: re.findall(WORD, v.lower(), re.ASCII) for k, v in templates.items()}
    return {k: list(dict.fromkeys(v)) for k, v in found.items()}


def needed(n: int, threshold: float) -> int:
    return max(1, -int(-n * threshold // 1)) if n else 1


def frequencies(docs: DataFrame, tokens: set[str], text_col="text") -> dict[str, int]:
    """In how many documents each template token occurs; one row per token is collected."""
    vocabulary = F.array(*[F.lit(t) for t in sorted(tokens)])
    held = F.array_intersect(scan_words(F.col(text_col)), vocabulary)
    counts = docs.select(F.explode(held).alias("t")).groupBy("t").agg(F.count("*").alias("n"))
    return {r.t: r.n for r in counts.collect()}


def candidates(docs: DataFrame, templates=TEMPLATES, threshold=THRESHOLD, id_col="doc_id", text_col="text") -> DataFrame:
    """(_id, _hash, label, tokens, need, held) for lines that pass the filters; held: the line's template tokens, in order."""
    spark = docs.sparkSession
    tokens = template_tokens(templates)
    vocabulary = set().union(*tokens.values())
    counts = frequencies(docs, vocabulary, text_col)
    order = lambda t: (counts.get(t, 0), t)
    index, full = [], []
    for label, found in tokens.items():
        ranked, need = sorted(found, key=order), needed(len(found), threshold)
        full.append((label, ranked, need))
        for i, t in enumerate(ranked[: len(ranked) - need + 1]):
            index.append((t, label, i))
    prefix = F.array(*[F.lit(t) for t in sorted({t for t, _, _ in index})])
    index = spark.createDataFrame(index, "token string, label string, place int")
    full = spark.createDataFrame(full, "label string, tokens array<string>, need int")
    lines = docs.select(
        *row_key(id_col, text_col), F.explode(F.split(F.coalesce(F.col(text_col), F.lit("")), "\n")).alias("line")
    )
    blocks = lines.select("_id", "_hash", F.array_distinct(scan_words(F.col("line"))).alias("block"))
    # No other token of a line can be shared; an intersection keeps the order of its first array.
    held = F.array_intersect(F.array(*[F.lit(t) for t in sorted(vocabulary, key=order)]), "block")
    first = F.array_intersect("held", prefix)
    # The templates are few and fixed: both small tables are bounded.
    found = (
        blocks.where(F.arrays_overlap("block", prefix))
        .select("_id", "_hash", F.size("block").alias("n"), held.alias("held"))
        .select("*", F.explode(first).alias("token"))
        .join(F.broadcast(index), "token")
        .join(F.broadcast(full), "label")
        .where(F.col("n") >= F.col("need"))
        .where(F.size("held") - F.array_position("held", F.col("token")) + 1 >= F.col("need"))
    )
    # A pair counts at its first shared prefix token only.
    earlier = F.slice("tokens", F.lit(1), F.col("place"))
    return found.where(~F.arrays_overlap("held", earlier)).select("_id", "_hash", "label", "tokens", "need", "held")


def matches(docs: DataFrame, templates=TEMPLATES, threshold=THRESHOLD, id_col="doc_id", text_col="text") -> DataFrame:
    """(_id, _hash, label, containment) for every line and template above the threshold."""
    found = candidates(docs, templates, threshold, id_col, text_col)
    return (
        found.withColumn("shared", F.size(F.array_intersect("tokens", "held")))
        .where("shared >= need")
        .select("_id", "_hash", "label", (F.col("shared") / F.size("tokens")).alias("containment"))
    )


def places(w: str, phrase: tuple[str, ...]) -> Column:
    """Start positions of a phrase in the word array ``w``."""
    hit = lambda i: reduce(lambda a, b: a & b, [F.get(w, i + k) == t for k, t in enumerate(phrase)])
    some = reduce(lambda a, b: a & b, [F.array_contains(w, t) for t in phrase])
    at = F.filter(F.sequence(F.lit(0), F.size(w) - 1), lambda i: F.coalesce(hit(i), F.lit(False)))
    return F.when(some, at).otherwise(F.array().cast("array<int>"))


def scan(docs: DataFrame, templates=TEMPLATES, threshold=THRESHOLD, id_col="doc_id", text_col="text") -> DataFrame:
    """One row per document: base counts, labels and score.

    ``score`` is 1 with a base phrase, else the highest containment found, else 0.
    """
    found = matches(docs, templates, threshold, id_col, text_col)
    found = found.groupBy("_id", "_hash").agg(
        F.collect_set("label").alias("_labels"), F.max("containment").alias("_best")
    )  # at most one label per template
    base = docs.select(
        F.col(id_col).alias("doc_id"), *row_key(id_col, text_col), scan_words(F.col(text_col)).alias("w")
    )
    base = base.select("*", *[places("w", p).alias(f"at_{i}") for i, p in enumerate(PHRASES.values())])
    at = [F.col(f"at_{i}") for i in range(len(PHRASES))]
    labels = F.array_sort(F.array_compact(F.array(*[F.when(F.size(a) > 0, F.lit(k)) for a, k in zip(at, PHRASES)])))
    base = base.select(
        "doc_id", "_id", "_hash",
        F.size("w").cast("long").alias("n_words"),
        F.array_sort(F.concat(*at)).alias("starts"),
        labels.alias("base"),
    )
    base = sealed(base)
    none = F.array().cast("array<string>")
    every = F.array_sort(F.array_union("base", F.coalesce("_labels", none)))
    return base.join(found, ["_id", "_hash"], "left").select(
        "doc_id",
        "n_words",
        F.size("starts").cast("long").alias("n_base"),
        F.get("starts", F.lit(0)).cast("long").alias("first_word"),
        F.element_at(F.when(F.size("starts") > 0, F.col("starts")), -1).cast("long").alias("last_word"),
        F.array_join("base", ",").alias("base_labels"),
        F.array_join(every, ",").alias("labels"),
        F.when(F.size("base") > 0, 1.0).otherwise(F.coalesce("_best", F.lit(0.0))).alias("score"),
    )
