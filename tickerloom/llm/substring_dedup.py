"""Substring dedup: windows of 20 words whose words also start a window earlier are removed.

Each window has a minimiser: the smallest hash among its runs of three words. Consecutive windows with
one minimiser occurrence travel as one packed string, a super-k-mer, to the minimiser's
bucket. Equal windows have equal minimisers, so a bucket holds all occurrences of its windows;
there they are sorted by their words, and all but the first are marked. Super-k-mers of one
batch of texts and one bucket share a compressed row; copies within a batch are settled before the
shuffle, so a passage that very many documents share arrives once per batch. Minimisers that
a sample of documents shows to be hot are spread window by window. Words themselves are
compared, never hashes.

"Earlier" means a smaller id, or an earlier start in the same document. Rows equal in id and text are
one document and are treated alike; rows of one id and different texts are ordered by the
text's hash; a missing id comes last. A null text has no words; texts under 20 words keep all.
An empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import pickle
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerloom.llm.text import bounded_batches, bounded_sample, kept_table, row_key
from tickerloom.llm.wordhash import U, grams, leftmost_minima, mixed, split_words, word_hashes

WINDOW = 20
GRAM = 3
BATCH_BYTES = 4 << 20  # text that one batch of super-k-mers is made of
BUCKET_BYTES = 16 << 20  # text aimed at per bucket; buckets hold about three times it, unpacked
HOT_SAMPLE = 4000  # documents looked at for hot minimisers
FILTER_BITS = 1 << 26  # of the filter that spares texts without a removed word the shuffle
PAGE_BITS = 1 << 15  # of one of its pages, as Spark's bitmap functions have it
HOT_SHARE = 2e-4  # of the sample's super-k-mers; at most 1 / HOT_SHARE minimisers can be hot


class Batch:
    """Texts as one run of words, in the order of their keys, each key once."""

    def __init__(self, rows: list[tuple[int, int, bytes]], window: int):
        split = {(i, h): t for i, h, t in rows}
        self.keys = sorted(split)
        parts, counts = [], []
        for k in self.keys:
            w = split[k].split()  # bytes: only the six ASCII spaces part words
            parts.append(b" ".join([*w, b""]))
            counts.append(len(w))
        self.joined = b"".join(parts)
        counts = np.array(counts, np.int64)
        data = np.frombuffer(self.joined, np.uint8)
        self.starts, self.ends = split_words(data)
        self.words = word_hashes(data, self.starts)
        self.first = np.concatenate([[0], np.cumsum(counts)])
        self.doc = np.repeat(np.arange(len(counts)), counts)
        self.window = window

    def super_kmers(self, gram: int):
        """(document, place, windows, hash of the minimiser) of each run; places count from the batch's first word."""
        h = grams(self.words, gram)
        at = leftmost_minima(h, self.window - gram + 1)
        n = len(at)
        whole = np.flatnonzero(self.doc[:n] == self.doc[self.window - 1 :][:n])
        if not len(whole):
            none = np.zeros(0, np.int64)
            return none, none, none, np.zeros(0, U)
        new = np.ones(len(whole), bool)
        new[1:] = (np.diff(whole) != 1) | (np.diff(at[whole]) != 0)
        lead = np.flatnonzero(new)
        sizes = np.diff(np.append(lead, len(whole)))
        places = whole[lead]
        return self.doc[places], places, sizes, h[at[places]]

    def text(self, place: int, windows: int) -> bytes:
        return self.joined[self.starts[place] : self.ends[place + windows + self.window - 2]]


def _texts(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[list[tuple[int, int, bytes]]]:
    rows, size = [], 0
    for batch in batches:
        ids, hashes = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for i, h, t in zip(ids, hashes, batch.column(2).cast(pa.binary())):
            t = t.as_py() or b""
            rows.append((i, h, t))
            size += len(t)
            if size >= most:
                yield rows
                rows, size = [], 0
    if rows:
        yield rows


def hot_minimisers(rows: DataFrame, window: int, gram: int) -> set[int]:
    """Minimisers with more than HOT_SHARE of a sample's super-k-mers: it only guides where windows go."""

    def run(batches):
        for texts in _texts(batches, BATCH_BYTES):
            found = Counter(Batch(texts, window).super_kmers(gram)[3].view(np.int64).tolist())
            yield pa.RecordBatch.from_arrays(
                [pa.array(found.keys(), pa.int64()), pa.array(found.values(), pa.int64())], ["m", "n"]
            )

    sample = bounded_sample(rows, HOT_SAMPLE, "_id", "_hash").repartition(4)
    counts = sample.mapInArrow(run, "m long, n long").groupBy("m").agg(F.sum("n").alias("n"))
    counts = kept_table(counts, "hot-minimisers")
    total = counts.agg(F.sum("n")).first()[0] or 0
    return {r.m for r in counts.where(F.col("n") > max(8, HOT_SHARE * total)).collect()}


def packed(rows: DataFrame, window: int, gram: int, buckets: int, hot: set[int]) -> DataFrame:
    """(bucket, load): the super-k-mers of a batch for a bucket; bucket -1 holds spans settled in the batch."""
    hot_array = np.array(sorted(hot), np.int64).view(U)

    def pack(texts: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
        press = zstandard.ZstdCompressor(level=3)
        batch = Batch(texts, window)
        docs, places, sizes, minis = batch.super_kmers(gram)
        ids, ties = (np.array(x) for x in zip(*batch.keys))
        ids, ties = ids.astype(np.int64), ties.astype(np.int64)
        if len(hot_array) and len(minis):
            alone = np.isin(minis, hot_array)
            times = np.where(alone, sizes, 1)
            each = np.repeat(np.arange(len(minis)), times)
            shift = np.arange(len(each)) - np.repeat(np.cumsum(times) - times, times)
            alone, docs, minis = alone[each], docs[each], minis[each]
            places = places[each] + np.where(alone, shift, 0)
            sizes = np.where(alone, 1, sizes[each])
            wide = grams(batch.words, window)
            minis = np.where(alone, wide[places], minis)
        strings = [batch.text(p, n) for p, n in zip(places.tolist(), sizes.tolist())]
        seen: dict[bytes, int] = {}
        own = np.fromiter((seen.setdefault(s, i) == i for i, s in enumerate(strings)), bool, len(strings))
        names, loads = [], []
        again = np.flatnonzero(~own)
        inner = places - batch.first[docs]
        if len(again):
            a, b = inner[again], inner[again] + sizes[again] + window - 1
            settled = zip(docs[again].tolist(), a.tolist(), b.tolist())
            names.append(-1)
            loads.append(pickle.dumps(merged([(*batch.keys[d], x, y) for d, x, y in settled]), 5))
        send = np.flatnonzero(own)
        bucket = (mixed(minis[send]) % U(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")  # in a bucket, by document
        send, bucket = send[order], bucket[order]
        cuts = np.flatnonzero(np.diff(bucket)) + 1
        for part in np.split(np.arange(len(send)), cuts) if len(send) else []:
            chosen = send[part]
            used, index = np.unique(docs[chosen], return_inverse=True)
            load = (
                ids[used], ties[used], index.astype(np.uint16), inner[chosen].astype(np.uint32),
                sizes[chosen].astype(np.uint8), (minis[chosen] >> U(32)).astype(np.uint32),
                b"\n".join([strings[i] for i in chosen]),
            )
            names.append(int(bucket[part[0]]))
            loads.append(press.compress(pickle.dumps(load, 5)))
        return _rows(names, loads)

    def run(batches):
        for texts in _texts(batches, BATCH_BYTES):
            yield pack(texts)

    return rows.mapInArrow(run, "bucket int, load binary")


def _rows(buckets, loads):
    return pa.RecordBatch.from_arrays(
        [pa.array(buckets, pa.int32()), pa.array(loads, pa.binary())], ["bucket", "load"]
    )


def merged(spans: list[tuple]) -> list[tuple[int, int, int, int]]:
    """Spans (id, hash, start, end) in order, joined where they touch."""
    out: list[tuple] = []
    for i, h, a, b in sorted(spans):
        if out and out[-1][:2] == (i, h) and a <= out[-1][3]:
            out[-1] = (i, h, out[-1][2], max(out[-1][3], b))
        else:
            out.append((i, h, a, b))
    return out


def repeated_in(loads: list[tuple], window: int) -> list[tuple[int, int, int, int]]:
    """Spans (id, hash, start, end) of a bucket's windows that are not the first of their words."""
    keys, docs, strings = [], [], []
    for ids, ties, doc, *_, text in loads:
        docs.append(doc.astype(np.int64) + len(keys))
        keys += zip(ids.tolist(), ties.tolist())
        strings += text.split(b"\n")
    docs = np.concatenate(docs)
    starts, sizes, minis = (np.concatenate([x[k] for x in loads]) for k in (3, 4, 5))
    order = np.argsort(minis, kind="stable")
    ordered = minis[order]
    edges = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1]))
    lengths = np.diff(np.append(edges, len(ordered)))
    out = []
    for lead, n in zip(edges[lengths > 1].tolist(), lengths[lengths > 1].tolist()):
        windows = []
        for i in order[lead : lead + n].tolist():
            key, at, w = keys[docs[i]], int(starts[i]), strings[i].split(b" ")
            windows += [(w[j : j + window], key, at + j) for j in range(int(sizes[i]))]
        windows.sort()
        for (w0, *first), (w1, *other) in zip(windows, windows[1:]):
            if w0 == w1 and first != other:
                out.append((*other[0], other[1], other[1] + window))
    return merged(out)


def spans(loads: DataFrame, window: int) -> DataFrame:
    """(_id, _hash, a, b): spans of words to remove; they may overlap."""

    def table(out):
        columns = list(zip(*out)) or [(), (), (), ()]
        types = [pa.int64()] * 4
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["_id", "_hash", "a", "b"])

    def run(batches):
        open_ = zstandard.ZstdDecompressor()
        bucket, loads = None, []
        for batch in batches:
            for name, load in zip(batch.column(0).to_pylist(), batch.column(1)):
                if name == -1:
                    yield table(pickle.loads(load.as_py()))
                    continue
                if name != bucket:
                    if loads:
                        yield table(repeated_in(loads, window))
                    bucket, loads = name, []
                loads.append(pickle.loads(open_.decompress(load.as_py())))
        if loads:
            yield table(repeated_in(loads, window))

    # Settled spans go anywhere, the others to their bucket.
    place = F.when(F.col("bucket") < 0, F.xxhash64("load")).otherwise(F.xxhash64("bucket"))
    dealt = loads.repartition(place).sortWithinPartitions("bucket")
    return dealt.mapInArrow(run, "_id long, _hash long, a long, b long")


def _kept(text: bytes, removed) -> tuple[int, int, bytes]:
    w = text.split()
    if not removed:
        return len(w), 0, b" ".join(w)
    keep = np.ones(len(w), bool)
    for r in removed:
        keep[r["a"] : r["b"]] = False
    return len(w), int((~keep).sum()), b" ".join([x for x, k in zip(w, keep) if k])


def dedup(docs: DataFrame, id_col="doc_id", text_col="text", window=WINDOW, gram=GRAM) -> DataFrame:
    """doc_id, n_words, n_removed and kept (the words that stay, joined by spaces) of every row."""
    spark = docs.sparkSession
    bounded_batches(spark)
    key = row_key(id_col, text_col)
    rows = docs.select(*key, F.col(text_col).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(4 * int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // BUCKET_BYTES))
    hot = hot_minimisers(rows, window, gram)
    found = spans(packed(rows, window, gram, buckets, hot), window)
    removed = kept_table(
        found.groupBy("_id", "_hash").agg(F.collect_set(F.struct("a", "b")).alias("removed")), "removed-spans"
    )
    bits = removal_filter(removed)
    slot = _slot().alias("slot")
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), *key, F.col(text_col).alias("text"))
    texts = texts.select("doc_id", "text", slot, "_id", "_hash")

    def hits(batch) -> np.ndarray:
        at = batch.column(2).to_numpy() - 1
        return bits[at >> 3] >> (at & 7).astype(np.uint8) & 1 == 1

    def result(ids, texts, removed):
        out = [_kept(t.as_py() or b"", r) for t, r in zip(texts.cast(pa.binary()), removed)]
        counts = [pa.array([x[k] for x in out], pa.int64()) for k in (0, 1)]
        kept = pa.array([x[2] for x in out], pa.binary()).cast(pa.string())
        return pa.RecordBatch.from_arrays([ids, *counts, kept], ["doc_id", "n_words", "n_removed", "kept"])

    def untouched(batches):
        for batch in batches:
            batch = batch.filter(pa.array(~hits(batch)))
            yield result(batch.column(0), batch.column(1), [None] * batch.num_rows)

    def suspected(batches):
        for batch in batches:
            yield batch.filter(pa.array(hits(batch))).select([0, 1, 3, 4])

    def cut(batches):
        for batch in batches:
            yield result(batch.column(0), batch.column(1), batch.column(2).to_pylist())

    kept = "doc_id long, n_words long, n_removed long, kept string"
    others = texts.mapInArrow(suspected, "doc_id long, text string, _id long, _hash long")
    others = others.join(removed, ["_id", "_hash"], "left").select("doc_id", "text", "removed")
    return texts.mapInArrow(untouched, kept).union(others.mapInArrow(cut, kept))


def _slot():
    return F.pmod(F.xxhash64("_id", "_hash"), F.lit(FILTER_BITS)) + 1


def removal_filter(removed: DataFrame) -> np.ndarray:
    """Bits set for the rows of ``removed``: texts that hit none are surely whole and are not shuffled.

    The filter has 8 MB whatever the input; the more it fills, the more texts go through the join.
    """
    slot = _slot()
    pages = (
        removed.groupBy(F.bitmap_bucket_number(slot).alias("page"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias("bits"))
        .collect()
    )
    bits = np.zeros(FILTER_BITS // 8, np.uint8)
    for r in pages:
        at = (r.page - 1) * PAGE_BITS // 8
        bits[at : at + PAGE_BITS // 8] = np.frombuffer(r.bits, np.uint8)
    return bits
