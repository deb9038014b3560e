"""SimHash near-duplicates: fingerprints of word shingles, linked through BK-trees.

Two fingerprints at most two bits apart agree in at least two of four 16-bit blocks. Each
distinct fingerprint therefore goes to the six shards named by two of its blocks, and in each
shard a BK-tree (children keyed by their Hamming distance to the parent) finds its neighbours,
following only edges within the radius. A tree lives in the task that holds its shard and its
queries: trees of the whole corpus grow with it, so none is broadcast. A shard of more than
256 fingerprints is resolved without a tree, by the 65 values at most one bit away: two
fingerprints are linked if and only if they share such a value. Shards emit links to a
representative, never all pairs.

Edge cases: a null or wordless text has fingerprint zero and is linked like any other; equal
texts share a fingerprint; a component's id is its smallest id, null if all its ids are; an empty table gives an
empty result; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerloom.llm import graph
from tickerloom.llm.text import bounded_batches, kept_table, row_key

SHINGLE = 3
RADIUS = 2
SEED = 42
MOST_IN_TREE = 256
BLOCKS = 4


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """64 bits, each set if it is set in over half of the shingles' hashes; as a signed long."""
    w = text.lower().split()  # bytes: only A-Z change, only the six ASCII spaces part words
    if not w:
        return 0
    if len(w) <= shingle:
        value = xxhash.xxh64_intdigest(b" ".join(w), SEED)
        return value - (1 << 64) if value >> 63 else value
    parts = map(b" ".join, zip(*[w[i:] for i in range(shingle)]))
    digests = b"".join([xxhash.xxh64_digest(p, SEED) for p in parts])
    bits = np.unpackbits(np.frombuffer(digests, np.uint8).reshape(-1, 8), axis=1)
    ones = bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(bits)).view(">i8")[0])


def fingerprints(docs: DataFrame, id_col="doc_id", text_col="text", shingle=SHINGLE) -> DataFrame:
    """doc_id, the row's key and its fingerprint."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(3).cast(pa.binary()).to_pylist()
            found = [fingerprint(t or b"", shingle) for t in texts]
            columns = [*batch.columns[:3], pa.array(found, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "_id", "_hash", "fp"])

    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), *row_key(id_col, text_col), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, _id long, _hash long, fp long")


class BKTree:
    """Integers under Hamming distance; children are keyed by their distance to the parent."""

    def __init__(self, root: int):
        self.root = (root, {})

    def add(self, value: int) -> None:
        node = self.root
        while (d := (node[0] ^ value).bit_count()) and d in node[1]:
            node = node[1][d]
        if d:
            node[1][d] = (value, {})

    def within(self, value: int, radius: int) -> Iterator[int]:
        stack = [self.root]
        while stack:
            at, children = stack.pop()
            d = (at ^ value).bit_count()
            if d <= radius:
                yield at
            for k in range(max(1, d - radius), d + radius + 1):
                if k in children:
                    stack.append(children[k])


def linked(values: list[int], radius: int) -> list[tuple[int, int]]:
    """Links (value, representative) that connect all values within the radius of each other."""
    mask = (1 << 64) - 1
    parent = {v: v for v in values}

    def top(v: int) -> int:
        while parent[v] != v:
            parent[v] = v = parent[parent[v]]
        return v

    tree = BKTree(values[0] & mask)
    signed = {v & mask: v for v in values}
    for v in values[1:]:
        for other in tree.within(v & mask, radius):
            a, b = top(v), top(signed[other])
            if a != b:
                parent[max(a, b)] = min(a, b)
        tree.add(v & mask)
    return [(v, top(v)) for v in values if top(v) != v]


def shard_links(fps: DataFrame, radius: int, most: int) -> DataFrame:
    """(a, b): links found in the shards' trees; b is null for members of shards too large for one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, members, large = None, [], False

        def close():
            if large:  # what was passed on before may be a neighbour of a single last member
                return [(v, None) for v in members]
            return linked(members, radius) if len(members) > 1 else []

        for batch in batches:
            out = []
            for key, fp in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if key != shard:
                    out += close()
                    shard, members, large = key, [], False
                if len(members) >= most:  # passed on as they come: no shard is gathered
                    out += [(v, None) for v in members]
                    members, large = [], True
                members.append(fp)
            yield _pairs(out)
        yield _pairs(close())

    def _pairs(out):
        a, b = zip(*out) if out else ((), ())
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    block = lambda i: F.shiftrightunsigned("fp", 16 * i).bitwiseAND(F.lit(0xFFFF))
    keys = [
        F.lit(n << 32) + F.shiftleft(block(i), 16) + block(j)
        for n, (i, j) in enumerate(combinations(range(BLOCKS), 2))
    ]
    return (
        fps.select(F.explode(F.array(*keys)).alias("key"), "fp")
        .repartition("key")
        .sortWithinPartitions("key", "fp")
        .mapInArrow(run, "a long, b long")
    )


def near_classes(fps: DataFrame, radius=RADIUS, most=MOST_IN_TREE) -> DataFrame:
    """(node, root) of all distinct fingerprints (column fp) that have a neighbour."""
    if radius != RADIUS:
        raise ValueError("four blocks, two shared, and one-bit values hold for a radius of two")
    found = kept_table(shard_links(fps, radius, most), "simhash-links")
    flips = F.array(F.col("fp"), *[F.col("fp").bitwiseXOR(F.lit(1 << i if i < 63 else -(1 << 63))) for i in range(64)])
    large = found.where("b IS NULL").select(F.col("a").alias("fp")).distinct()
    around = large.select("fp", F.explode(flips).alias("value"))
    stars = around.groupBy("value").agg(F.min("fp").alias("m"), F.count("*").alias("n")).where("n > 1")
    # At most 65 fingerprints share a value.
    extra = around.join(stars, "value").where("fp <> m").select(F.col("fp").alias("a"), F.col("m").alias("b"))
    return graph.components(found.where("b IS NOT NULL").select("a", "b").union(extra))


def classified(docs: DataFrame, id_col="doc_id", text_col="text", shingle=SHINGLE, radius=RADIUS) -> DataFrame:
    """Every row's key, fingerprint and component.

    Rows are first reduced to distinct fingerprints, so copies meet only as counts and minima.
    """
    rows = kept_table(fingerprints(docs, id_col, text_col, shingle), "simhash-rows")
    first = F.min(F.struct("_id", "_hash"))
    distinct = kept_table(rows.groupBy("fp").agg(F.min("doc_id").alias("low"), first.alias("first")), "simhash-fps")
    roots = near_classes(distinct, radius)
    classes = distinct.join(roots, distinct["fp"] == roots["node"], "left").select(
        "fp", "low", "first", F.coalesce("root", "fp").alias("root")
    )
    lows = classes.groupBy("root").agg(F.min("low").alias("component_id"), F.min("first").alias("keeper"))
    named = classes.join(lows, "root").select("fp", "component_id", "keeper")
    return rows.join(named, "fp")


def near_duplicates(docs: DataFrame, **options) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of every document."""
    return classified(docs, **options).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def one_of_each(docs: DataFrame, id_col="doc_id", text_col="text", shingle=SHINGLE, radius=RADIUS) -> DataFrame:
    """One row of each component, with its columns as they were: the one with the smallest id.

    Rows equal in id and text are copies of one document; the one whose columns have the smallest hash stays, whatever the
    order in which rows are read. What is dropped is found on keys alone and written; texts are then read
    once more and, while the list of dropped keys is below ``spark.sql.autoBroadcastJoinThreshold``, not shuffled.
    """
    key = ["_id", "_hash"]
    kept = (F.col("_id") == F.col("keeper._id")) & (F.col("_hash") == F.col("keeper._hash"))
    rows = classified(docs, id_col, text_col, shingle, radius).select(*key, kept.alias("kept"))
    marks = rows.groupBy(*key).agg(F.max("kept").alias("kept"), F.count("*").alias("n")).where("NOT kept OR n > 1")
    marks = kept_table(marks.select(*key, "kept"), "simhash-marks")
    names = [F.col(f"`{c}`") for c in docs.columns]
    whole = docs.select(F.struct(*names).alias("_row"), *row_key(id_col, text_col))
    found = whole.join(marks, key, "left_anti").select("_row.*")
    copies = marks.where("kept")
    if copies.isEmpty():
        return found
    comparable = [F.col(f"_row.`{f.name}`") for f in docs.schema.fields if "map<" not in f.dataType.simpleString()]
    order = F.struct(F.xxhash64(*comparable), F.xxhash64(F.lit(1), *comparable, *[c.isNull() for c in comparable]))
    one = whole.join(copies, key, "left_semi").groupBy(*key).agg(F.min_by("_row", order).alias("_row"))
    return found.unionByName(one.select("_row.*"))
