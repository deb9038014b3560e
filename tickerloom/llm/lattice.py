"""Likelihood of texts under a unigram model of subwords, summed over all segmentations.

The pieces are those of a given vocabulary and all single bytes, so that every text has a
segmentation. Their probabilities start from the vocabulary's ranks and are fitted by expectation
maximisation on the words of the training documents, each distinct word once, weighed by its count. A word stands with
a mark before it and no piece crosses words, so a text's probability is the product of its words'
(and of one end): a word's is found by forward recursion in log space, over all words of a batch at once.

Beside it, an add-one model of whole words is scored. Its counts are of all training words; the most frequent ones are broadcast
(a bounded number), the others joined.

Null texts are empty: they hold one end. A null id belongs to the training documents. Repeated rows count, and are scored,
each by itself. Without training documents every piece is as likely as its rank says, and the base score is 0.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tickerloom.llm import double_array
from tickerloom.llm.text import bounded_batches, kept_table
from tickerloom.llm.tokens import LOWER, WINDOW, Tally, Tokens, kinds, windows

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"  # stands before each word, as in the vocabulary
FOLDS, HELD_OUT = 7, 2
ROUNDS = 3  # of expectation maximisation
COMMON = 1 << 17  # words whose counts are broadcast, at most
COMMON_BYTES = 64  # the longest of them
CHUNK = 1 << 18  # bytes of words whose lattices are built at once: a piece of them takes about 160 bytes a byte
SPAN = 1 << 16  # bytes of one word whose lattice is built at once
UNIT = 4096  # expected counts are summed as whole parts of this: the order does not matter

KIND = kinds(spaces=b" ", breaks=b"\t\n\x0b\x0c\r")


@dataclass(frozen=True)
class Pieces:
    """The vocabulary as a trie over bytes; ``piece`` is a state's piece, or -1."""

    base: np.ndarray
    check: np.ndarray
    piece: np.ndarray
    ranks: np.ndarray  # of each piece, 0 for the first

    @classmethod
    def load(cls, path: str = VOCABULARY) -> Pieces:
        """The pieces of a sentencepiece model; those with a mark inside cannot occur and are left out."""
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        ids = [i for i in range(model.get_piece_size()) if not (model.is_unknown(i) or model.is_control(i) or model.is_byte(i))]
        ids.sort(key=lambda i: -model.get_score(i))
        ordered = [model.id_to_piece(i) for i in ids]
        return cls.of([p.encode() for p in ordered if MARK not in p[1:]])

    @classmethod
    def of(cls, ordered: list[bytes]) -> Pieces:
        every = list(dict.fromkeys([*ordered, *(bytes([b]) for b in range(256))]))
        matrix = np.full((len(every), max(map(len, every))), -1, np.int64)
        for i, p in enumerate(every):
            matrix[i, : len(p)] = list(p)
        base, check, state = double_array.trie(matrix)
        piece = np.full(len(base), -1, np.int32)
        piece[state] = np.arange(len(every))
        return cls(base, check, piece, np.minimum(np.arange(len(every)), len(ordered)))


@dataclass(frozen=True)
class Model:
    pieces: Pieces
    log_p: np.ndarray  # natural logarithm of each piece's probability, the end's last
    counts: DataFrame  # word, n: of all training words
    train_tokens: int
    distinct: int
    documents: int


def held_out(id_col: Column) -> Column:
    return F.pmod(F.crc32(F.coalesce(id_col.cast("string"), F.lit(""))), F.lit(FOLDS)) == HELD_OUT


def fit(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", pieces: Pieces | None = None, rounds: int = ROUNDS
) -> Model:
    """Counts of all training words, and the piece probabilities fitted to them."""
    bounded_batches(docs.sparkSession)
    pieces = pieces or Pieces.load()
    train = docs.where(~held_out(F.col(id_col)))
    texts = train.select(F.lit("").alias("group"), F.col(text_col).alias("text"))
    counts = texts.mapInArrow(_count_words, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    counts = kept_table(counts, "word-counts")
    tokens, distinct = counts.agg(F.sum("n"), F.count("*")).first()
    documents = train.count()
    weight = 1.0 / (1.0 + pieces.ranks)
    log_p = np.log(np.append(weight, weight[0]) / (weight.sum() + weight[0]))
    for _ in range(rounds if documents else 0):
        log_p = _refitted(counts, pieces, log_p, documents)
    return Model(pieces, log_p, counts, (tokens or 0) + documents, distinct + (documents > 0), documents)


def _refitted(counts: DataFrame, pieces: Pieces, log_p: np.ndarray, documents: int) -> np.ndarray:
    """Each piece's share of the expected pieces, and ends, of the training text; one is added to each."""
    parts = (pieces.base, pieces.check, pieces.piece, log_p)

    def expected(batches):
        total = np.zeros(len(log_p), np.int64)
        for batch in batches:
            n = batch.column(1).to_numpy()
            for at, lattice in _lattices(batch.column(0), *parts[:3]):
                total[:-1] += lattice.expected(log_p, n[at : at + lattice.n_words])
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found.astype(np.int32)), pa.array(total[found])], names=["piece", "n"])

    sums = counts.select("word", "n").mapInArrow(expected, "piece int, n long")
    n = np.zeros(len(log_p))
    for piece, units in sums.groupBy("piece").agg(F.sum("n").alias("n")).collect():  # a row per piece at most
        n[piece] = units / UNIT
    n[-1] = documents
    return np.log((n + 1) / (n.sum() + len(n)))


def score(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every document.

    ``score`` is the log10 probability of the text, ``base_score`` that of the words' add-one model.
    """
    bounded_batches(docs.sparkSession)
    schema = StructType([docs.schema[docs.select(id_col).columns[0]]]).add("_held", "boolean")
    schema = schema.add("_row", "long").add("_tokens", "long").add("_known", "long").add("_common", "double")
    schema = schema.add("_score", "double").add("_word", "string").add("_n", "long")
    rows = docs.select(F.col(id_col), held_out(F.col(id_col)), F.col(text_col))
    shared = docs.sparkSession.sparkContext.broadcast(_common_words(model))
    end = (math.log10(model.documents + 1), int(model.documents > 0))
    names = schema.names
    scored = kept_table(rows.mapInArrow(lambda b: _score_batches(b, shared, end, names), schema), "scores")
    shared.destroy()
    rare = (
        scored.where("_word IS NOT NULL").select("_row", F.col("_word").alias("word"), "_n")
        .join(model.counts, "word")
        .groupBy("_row")
        .agg(F.sum("_n").alias("_more"), F.sum(F.col("_n") * F.log10(F.col("n") + 1)).alias("_rare"))
    )
    none = lambda c: F.coalesce(F.col(c), F.lit(0))
    per_token = math.log10(model.train_tokens + model.distinct + 1)
    return (
        scored.where("_word IS NULL").drop("_word", "_n").join(rare, "_row", "left")
        .select(
            F.col(names[0]), F.col("_held").alias("held_out"), F.col("_tokens").alias("n_tokens"),
            (F.col("_known") + none("_more")).alias("n_known"), F.lit(model.train_tokens).cast("long").alias("train_tokens"),
            (F.col("_common") + none("_rare") - F.col("_tokens") * F.lit(per_token)).alias("base_score"),
            F.col("_score").alias("score"),
        )
    )


def _common_words(model: Model) -> dict:
    """The most frequent words with their counts and log probabilities, COMMON at most: whole classes of counts."""
    short = model.counts.where(F.octet_length("word") <= COMMON_BYTES)
    grade = F.floor(F.log2("n") * 8).cast("int")
    room, least = COMMON, None
    for r in short.groupBy(grade.alias("g")).count().orderBy(F.desc("g")).collect():  # 512 grades at most
        if r["count"] > room:
            break
        room, least = room - r["count"], r.g
    rows = short.where(grade >= least).select("word", "n").toArrow() if least is not None else None
    words = rows["word"].combine_chunks() if rows is not None else pa.array([], pa.string())
    words = words.combine_chunks() if isinstance(words, pa.ChunkedArray) else words
    n = rows["n"].to_numpy() if rows is not None else np.zeros(0, np.int64)
    p = model.pieces
    out = {"base": p.base, "check": p.check, "piece": p.piece, "log_p": model.log_p, "words": words, "n": n}
    return out | {"log_words": _log_words(words, out)}


# --- inside tasks ---------------------------------------------------------------------------


def _count_words(batches):
    tally = Tally(["word"])
    for _, text in windows(batches, KIND):
        yield from tally.add(text.words, np.bincount(text.ids, minlength=len(text.words)))
    yield from tally.rest()


def _score_batches(batches, shared, end, names):
    known = shared.value
    partition, row = TaskContext.get().partitionId() << 33, 0
    for ids, held, texts in _documents(batches):
        data = LOWER.take(np.frombuffer(b"\n".join(texts) + b"\n", np.uint8))
        text = Tokens(data, KIND)
        ends = np.cumsum([len(t) + 1 for t in texts])
        doc = np.searchsorted(ends, text.starts, side="right")
        n_docs, n_words = len(texts), len(text.words)
        pairs, times = np.unique(doc * np.int64(max(n_words, 1)) + text.ids, return_counts=True)
        doc, word = pairs // max(n_words, 1), pairs % max(n_words, 1)
        found = pc.index_in(text.words, value_set=known["words"]).fill_null(-1).to_numpy(zero_copy_only=False)
        log_p = np.empty(n_words)
        log_p[found >= 0] = known["log_words"][found[found >= 0]]
        log_p[found < 0] = _log_words(text.words.filter(pa.array(found < 0)), known)
        common = found[word] >= 0
        part = lambda values: np.bincount(doc, weights=values, minlength=n_docs)
        n = np.where(common, known["n"][found[word]] if len(known["n"]) else 0, 0)
        rows = partition + row + np.arange(n_docs)
        row += n_docs
        columns = [
            ids, held, pa.array(rows), pa.array(part(times).astype(np.int64) + 1),
            pa.array(part(times * common).astype(np.int64) + end[1]), pa.array(part(times * np.log10(n + 1.0)) + end[0]),
            pa.array((part(times * log_p[word]) + known["log_p"][-1]) / math.log(10)),
            pa.nulls(n_docs, pa.string()), pa.nulls(n_docs, pa.int64()),
        ]
        yield pa.RecordBatch.from_arrays(columns, names=names)
        rare = ~common
        for a in range(0, int(rare.sum()), 1 << 16):
            at = np.flatnonzero(rare)[a : a + (1 << 16)]
            none = lambda kind, k=len(at): pa.nulls(k, kind)
            columns = [
                none(ids.type), none(pa.bool_()), pa.array(rows[doc[at]]), none(pa.int64()), none(pa.int64()), none(pa.float64()),
                none(pa.float64()), text.words.take(pa.array(word[at])), pa.array(times[at].astype(np.int64)),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=names)


def _documents(batches) -> Iterator[tuple[pa.Array, pa.Array, list[bytes]]]:
    """Ids, folds and texts of whole documents, about WINDOW bytes or 65,536 rows at a time."""
    ids, held, texts, size = [], [], [], 0
    for batch in batches:
        if not batch.num_rows:
            continue
        ids.append(batch.column(0))
        held.append(batch.column(1))
        texts += [t or b"" for t in batch.column(2).cast(pa.binary()).to_pylist()]
        size = size + batch.column(2).nbytes
        if size >= WINDOW or len(texts) >= 1 << 16:
            yield pa.concat_arrays(ids), pa.concat_arrays(held), texts
            ids, held, texts, size = [], [], [], 0
    if texts:
        yield pa.concat_arrays(ids), pa.concat_arrays(held), texts


def _log_words(words: pa.Array, known: dict) -> np.ndarray:
    out = np.empty(len(words))
    for at, lattice in _lattices(words, known["base"], known["check"], known["piece"]):
        out[at : at + lattice.n_words] = lattice.forward(known["log_p"])[lattice.last]
    return out


def _lattices(words: pa.Array, base, check, piece) -> Iterator[tuple[int, _Lattice]]:
    """Lattices of consecutive words, CHUNK bytes at a time (or one longer word)."""
    n_bytes = pc.binary_length(words).to_numpy(zero_copy_only=False)
    upto = np.cumsum(n_bytes + len(MARK.encode()))
    a = 0
    while a < len(words):
        before = upto[a - 1] if a else 0
        b = max(a + 1, int(np.searchsorted(upto, before + CHUNK, side="right")))
        yield a, _Lattice(words.slice(a, b - a), n_bytes[a:b], base, check, piece)
        a = b


class _Lattice:
    """All pieces that lie in the marked words; the nodes are the places between bytes."""

    def __init__(self, words: pa.Array, n_bytes: np.ndarray, base, check, piece):
        mark = np.frombuffer(MARK.encode(), np.uint8)
        self.trie, self.n_words = (base, check, piece), len(words)
        length = n_bytes.astype(np.int64) + len(mark)
        start = np.cumsum(length) - length
        self.data = np.empty(int(length.sum()), np.uint8)
        body = np.ones(len(self.data), bool)
        for k, byte in enumerate(mark):
            self.data[start + k] = byte
            body[start + k] = False
        self.data[body] = np.frombuffer(b"".join(words.cast(pa.binary()).to_pylist()), np.uint8)
        self.word = np.repeat(np.arange(self.n_words), length)
        self.stop = np.repeat(start + length, length)
        self.place = np.arange(len(self.data)) - np.repeat(start, length)
        self.first, self.last = start + np.arange(self.n_words), start + length + np.arange(self.n_words)
        self.longest = int(length.max(initial=0))

    def edges(self, low: int, high: int):
        """Pieces that start at places low to high - 1 of their word: sources, targets, pieces, words, and where each place begins."""
        base, check, piece = self.trie
        at = np.flatnonzero((self.place >= low) & (self.place < high)) if self.longest > SPAN else np.arange(len(self.data))
        states, parts, depth = np.zeros(len(at), np.int32), [], 0
        while len(at):
            states = double_array.step(base, check, states, self.data[at + depth])
            on = states >= 0
            at, states = at[on], states[on]
            depth += 1
            p = piece[states]
            whole = p >= 0
            parts.append((at[whole], np.full(int(whole.sum()), depth, np.int32), p[whole]))
            on = at + depth < self.stop[at]
            at, states = at[on], states[on]
        at, size, p = (np.concatenate(c) for c in zip(*parts))
        order = np.lexsort((at, self.place[at]))
        at, size, p = at[order], size[order], p[order]
        word = self.word[at]
        cuts = np.searchsorted(self.place[at], np.arange(low, min(high, self.longest) + 1))
        return at + word, at + size + word, p, word, cuts

    def spans(self) -> list[tuple[int, int]]:
        return [(a, min(a + SPAN, self.longest)) for a in range(0, self.longest, SPAN)]

    def forward(self, log_p: np.ndarray) -> np.ndarray:
        """Log of the summed probability of all ways to each node."""
        alpha = np.full(len(self.data) + self.n_words, -np.inf)
        alpha[self.first] = 0
        for low, high in self.spans():
            source, target, p, _, cuts = self.edges(low, high)
            weight = log_p[p]
            for a, b in zip(cuts[:-1], cuts[1:]):  # targets of one place are all different
                to = target[a:b]
                alpha[to] = np.logaddexp(alpha[to], alpha[source[a:b]] + weight[a:b])
        return alpha

    def expected(self, log_p: np.ndarray, times: np.ndarray) -> np.ndarray:
        """Expected uses of each piece, in units, if word i stands ``times[i]`` times."""
        alpha = self.forward(log_p)
        total = alpha[self.last]
        beta = np.full(len(alpha), -np.inf)
        beta[self.last] = 0
        out = np.zeros(len(log_p) - 1, np.int64)
        for low, high in reversed(self.spans()):
            source, target, p, word, cuts = self.edges(low, high)
            weight = log_p[p]
            for a, b in zip(cuts[-2::-1], cuts[:0:-1]):
                if a < b:
                    s = source[a:b]
                    begin = np.flatnonzero(np.diff(s, prepend=-1))
                    beta[s[begin]] = np.logaddexp.reduceat(weight[a:b] + beta[target[a:b]], begin)
            share = np.exp(alpha[source] + weight + beta[target] - total[word])
            units = np.rint(share * UNIT) * times[word]
            out += np.bincount(p, weights=units, minlength=len(out)).astype(np.int64)
        return out
