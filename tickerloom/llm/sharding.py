"""Sharding into near-equal bytes by sampled splitters.

A size-weighted sample of keys gives quantile boundaries; records are range-partitioned by
them, ranges that came out overfull are subdivided, and the exact sums of all ranges say at
which byte each range starts. A record's shard follows from its byte position. The few records
larger than 1/64 of a shard (1024 at most can exist for 16 shards) are placed first, each into the lightest
shard, and the others fill what is left evenly; so no shard is off by more than such a record.

The key is (hash of the text, id): equal texts are neighbours and mostly share a shard, and a
group of copies larger than a range is still cut by id.

Edge cases: a null text has 0 bytes (size 1) and the checksum of the empty text; a null id sorts last; equal rows
are told apart by their place in the written key table; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickerloom.llm.text import LAST_ID, kept_table

SAMPLE = 8192  # keys drawn for the boundaries
SIDE = 32  # boundaries are searched in two steps of 32: 1024 ranges
HEAVY = 64  # records above 1/64 of a shard are placed one by one


def keyed(docs: DataFrame, id_col="doc_id", text_col="text") -> DataFrame:
    """One narrow row per record; ``rid`` is fixed once the table is written."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(text).cast("long") + 1).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(F.col(text_col)).alias("h"),
        F.coalesce(F.col(id_col).cast("long"), F.lit(LAST_ID)).alias("d"),
        F.monotonically_increasing_id().alias("rid"),
    )


def _structs(keys) -> str:
    return "array(" + ",".join(f"struct(bigint('{h}') h, bigint('{d}') d)" for h, d in keys) + ")"


def sampled_boundaries(rows: DataFrame, total: int, seed: int) -> list[tuple[int, int]]:
    """At most 1023 keys that cut the bytes into even ranges, from a size-weighted sample.

    A record's turn is exponential with its size as rate; the first SAMPLE turns are the sample. Turns beyond
    twice the expected last one are dropped before the ordering.
    """
    u = (F.pmod(F.xxhash64("h", "d", "rid", F.lit(seed)), F.lit(1 << 52)) + 0.5) / float(1 << 52)
    turns = rows.select("h", "d", "rid", (-F.log(u) / F.col("size")).alias("turn"))
    turns = turns.where(F.col("turn") * F.lit(float(max(1, total))) < 2.0 * SAMPLE)
    drawn = turns.orderBy("turn", "rid").limit(SAMPLE).select("h", "d").collect()
    keys = sorted((r.h, r.d) for r in drawn)
    n = SIDE * SIDE
    return sorted({keys[len(keys) * i // n] for i in range(1, n)}) if keys else []


def range_of(bounds: list[tuple[int, int]]) -> tuple[Column, Column]:
    """The block of boundaries for a row's key (column _head), and from it the row's range."""
    if not bounds:
        return F.lit(0), F.lit(0)
    heads, groups = bounds[::SIDE], [bounds[i : i + SIDE] for i in range(0, len(bounds), SIDE)]
    first = f"size(filter({_structs(heads)}, b -> b <= struct(h, d)))"
    inner = "array(" + ",".join(map(_structs, groups)) + ")"
    second = f"size(filter(get({inner}, _head - 1), b -> b <= struct(h, d)))"
    place = F.expr(f"CASE WHEN _head = 0 THEN 0 ELSE (_head - 1) * {SIDE} + {second} END")
    return F.expr(first), place


def _levels(loads: list[int], rest: int) -> list[float]:
    """What each shard still takes so that all end as level as possible."""
    order = sorted(loads)
    for k in range(len(order), 0, -1):
        level = (rest + sum(order[:k])) / k
        if level >= order[k - 1]:
            break
    return [max(0.0, level - x) for x in loads]


def shard(docs: DataFrame, n_shards=16, id_col="doc_id", text_col="text", seed=42) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard for every record."""
    spark = docs.sparkSession
    rows = kept_table(keyed(docs, id_col, text_col), "shard-keys")
    total = rows.agg(F.sum("size")).first()[0] or 0
    is_heavy = F.col("size") * F.lit(n_shards * HEAVY) >= F.lit(total)
    heavy = rows.where(is_heavy).select("rid", "size").collect()  # n_shards * HEAVY rows at most
    light = rows.where(~is_heavy)

    loads, counts, placed = [0] * n_shards, [0] * n_shards, []
    queue = [(0, s) for s in range(n_shards)]
    for r in sorted(heavy, key=lambda r: (-r.size, r.rid)):
        load, s = heapq.heappop(queue)
        placed.append((r.rid, s, counts[s]))
        counts[s] += 1
        loads[s] = load + r.size
        heapq.heappush(queue, (loads[s], s))
    room = _levels(loads, total - sum(loads))
    ends = list(accumulate(room))

    head, place = range_of(sampled_boundaries(light, total - sum(loads), seed))
    light = light.withColumn("_head", head).withColumn("range", place.cast("int")).drop("_head")
    light = kept_table(light, "shard-ranges")
    filled = {r["range"]: r["n"] for r in light.groupBy("range").agg(F.count("*").alias("n")).collect()}
    even = max(1, -(-sum(filled.values()) // max(1, len(filled))))
    parts = [max(1, -(-filled.get(i, 0) // (2 * even))) for i in range(max(filled, default=0) + 1)]
    fold = "array(" + ",".join(map(str, parts)) + ")"
    light = light.withColumn("part", F.expr(f"int(pmod(xxhash64(rid), get({fold}, `range`)))"))

    sums = (
        light.groupBy("range", "part")
        .agg(F.sum("size").alias("bytes"), F.count("*").alias("n"))
        .orderBy("range", "part")
        .collect()  # one row per range or part of one: 3 * 1024 at most
    )
    starts, byte, place = [], 0, 0
    for r in sums:
        starts.append((r["range"], r["part"], byte, place))
        byte, place = byte + r.bytes, place + r.n
    starts = spark.createDataFrame(starts, "range int, part int, byte long, place long")
    upto = Window.partitionBy("range", "part").orderBy("h", "d", "rid")
    before = upto.rowsBetween(Window.unboundedPreceding, -1)
    at = F.col("byte") + F.coalesce(F.sum("size").over(before), F.lit(0)) + F.col("size") / 2
    limits = "array(" + ",".join(f"double('{x!r}')" for x in ends[:-1]) + ")"
    spread = kept_table(
        light.join(F.broadcast(starts), ["range", "part"])
        .select(
            "doc_id", "size", "text_crc32",
            at.alias("at"),
            (F.col("place") + F.row_number().over(upto) - 1).alias("place"),
        )
        .withColumn("shard", F.expr(f"size(filter({limits}, b -> b <= at))")),
        "shard-placed",
    )
    firsts = {r.shard: r.f for r in spread.groupBy("shard").agg(F.min("place").alias("f")).collect()}
    shift = "array(" + ",".join(f"bigint('{firsts.get(s, 0) - counts[s]}')" for s in range(n_shards)) + ")"
    fixed = spark.createDataFrame(placed, "rid long, shard int, slot long")
    columns = [
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int").alias("shard"),
        F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    ]
    return (
        spread.withColumn("slot", F.expr(f"place - get({shift}, shard)"))
        .select(columns)
        .unionByName(rows.where(is_heavy).join(F.broadcast(fixed), "rid").select(columns))
    )
