"""Benchmark decontamination by latent semantic retrieval.

Texts and benchmark items are cut into passages of 32 words. A passage's TF-IDF vector (hashed
terms; document frequencies counted over all passages of the corpus) is taken to a latent space
found by a randomised SVD of all passages of all documents, whose passes run as Spark jobs; in it, directions are
scaled so that the corpus varies evenly in all. Passages whose cosine with a piece of an item reaches the threshold are
candidates. So are places that hold enough of an item's rarest words to hold its share of all (an exact prefix
filter with counts), as a few words of a short item, or a much changed one, weigh little in a passage of 32.
A candidate counts if the longest common subsequence of its surroundings and the item
covers enough of the item's words, and enough of its answer's (its last sentence), so
reworded copies are found too.

The space is fitted on every passage of every document and of all items, and every passage is searched. The terms
of all texts, two bytes each, are written once (a term table), and the passes of the fit read those; a task holds the terms
of about GRID words, or of one longer text, and one matrix of sums, TERMS x (RANK + EXTRA), whatever the corpus. Items are the
query set: they are held whole by each task and may take up ITEM_BYTES at most; passages are compared with them in blocks.

Edge cases: a null or wordless text has no passage and is clean; null and wordless items are not looked for;
equal items each give their row; equal rows get equal results; an empty corpus or benchmark
gives an empty result; other columns pass unchanged.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerloom.llm.text import bounded_batches, kept_table
from tickerloom.llm.wordhash import U, split_words, word_hashes

PASSAGE, STEP = 32, 16  # words
TERMS = 1 << 14  # hashed terms
RANK, EXTRA, POWER = 64, 8, 2  # of the randomised SVD
COSINE = 0.5
ITEM_SHARE, ANSWER_SHARE = 0.7, 0.5  # of an item's words, in order
SHORT_ITEM = 8  # items of fewer words must be there in full
SPREAD = 2  # a copy may take up this many times the words of its item
ITEM_BYTES = 64 << 20
BATCH_BYTES = 4 << 20
BLOCK = 512  # pieces of items compared at once
GRID = 1 << 19  # words whose terms are summed at once
CHUNK, GROUP = 512, 16  # rows of a sum, and places of a term, that are added at once
ROWS = 64  # of a matrix of sums in one row of a table, so that many tasks can add them

# Letters in lower case; ASCII other than letters and digits parts words.
FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


@dataclass
class Words:
    """The words of several texts, each text's padded with blanks so that no passage spans two."""

    texts: list[bytes]
    first: np.ndarray = field(init=False)  # of each text, its first place on the grid
    counts: np.ndarray = field(init=False)
    hashes: np.ndarray = field(init=False)  # 0 for blanks

    def __post_init__(self):
        joined = b" ".join(self.texts) + b" "
        data = np.frombuffer(joined.translate(FOLD), np.uint8)
        starts, _ = split_words(data)
        lengths = np.array([len(t) + 1 for t in self.texts], np.int64)
        ends = np.searchsorted(starts, np.cumsum(lengths))
        self.counts = np.diff(np.append(0, ends))
        grid = (-(-self.counts // STEP) + PASSAGE // STEP - 1) * STEP
        grid[self.counts == 0] = 0
        self.first = np.cumsum(grid) - grid
        self.hashes = np.zeros(int(grid.sum()), U)
        at = np.arange(len(starts)) + np.repeat(self.first - (ends - self.counts), self.counts)
        self.hashes[at] = word_hashes(data, starts) | U(1)

    def terms(self) -> np.ndarray:
        """Hashed terms, TERMS for blanks."""
        return np.where(self.hashes == 0, U(TERMS), self.hashes >> U(50)).astype(np.int64)

    def grid(self) -> np.ndarray:
        """The terms, STEP to a row."""
        return self.terms().reshape(-1, STEP)

    def passages(self, values: np.ndarray) -> np.ndarray:
        return passage_sums(self.grid(), values)


def row_sums(places: np.ndarray, values: np.ndarray) -> np.ndarray:
    """For each row of places the sum of the rows of values there."""
    out = np.empty((len(places), values.shape[1]), values.dtype)
    more = np.empty((CHUNK, values.shape[1]), values.dtype)
    for a in range(0, len(places), CHUNK):  # small enough to stay in the cache
        columns = np.ascontiguousarray(places[a : a + CHUNK].T)
        total = out[a : a + CHUNK]
        np.take(values, columns[0], axis=0, out=total, mode="clip")
        for column in columns[1:]:
            total += np.take(values, column, axis=0, out=more[: len(total)], mode="clip")
    return out


def passage_sums(grid: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Sums of term values (rows by term, the last one zero) per passage, one each STEP words."""
    steps = row_sums(grid, values)
    out = steps.copy()
    for k in range(1, PASSAGE // STEP):
        out[:-k] += steps[k:]
    out[grid[:, 0] == TERMS] = 0  # a text's closing blanks; the words after them are another's
    return out


def term_sums(grid: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Sums of step values (rows by step, the last one zero) per term, one for each place the term has."""
    flat = grid.ravel()
    counts = np.bincount(flat, minlength=TERMS)[:TERMS]
    steps = np.argsort(flat.astype(np.uint16), kind="stable")[: counts.sum()] // STEP  # blanks come last
    groups = -(-counts // GROUP)
    first = np.cumsum(groups) - groups
    places = np.full(groups.sum() * GROUP, len(values) - 1)
    places[np.arange(len(steps)) + np.repeat(first * GROUP - (np.cumsum(counts) - counts), counts)] = steps
    sums = row_sums(places.reshape(-1, GROUP), values)
    out = np.zeros((TERMS, values.shape[1]), values.dtype)
    held = np.flatnonzero(counts)
    out[held] = np.add.reduceat(sums, first[held], axis=0)
    return out


def batches_of(column, most=BATCH_BYTES) -> Iterator[tuple[int, list[bytes]]]:
    """(place of the first, texts) in parts of bounded size."""
    rows, size, start = [], 0, 0
    for i, t in enumerate(column.cast(pa.binary())):
        t = t.as_py() or b""
        rows.append(t)
        size += len(t)
        if size >= most:
            yield start, rows
            rows, size, start = [], 0, i + 1
    if rows:
        yield start, rows


def term_table(texts: DataFrame) -> DataFrame:
    """The terms of all texts, padded as Words has them; a row has those of texts of up to BATCH_BYTES."""

    def run(batches):
        for batch in batches:
            for _, part in batches_of(batch.column(0)):
                terms = Words(part).terms().astype(np.int16)
                if len(terms):
                    yield pa.RecordBatch.from_arrays([pa.array([terms.tobytes()], pa.binary())], ["terms"])

    return kept_table(texts.mapInArrow(run, "terms binary"), "latent-terms")


def grids(batches: Iterator[pa.RecordBatch], least: int = GRID) -> Iterator[np.ndarray]:
    """The rows of a term table in order, STEP terms to a row, about ``least`` words at once."""
    held, size = [], 0
    for batch in batches:
        for cell in batch.column(0):
            held.append(np.frombuffer(cell.as_py(), np.int16))
            size += len(held[-1])
            if size >= least:
                yield np.concatenate(held).reshape(-1, STEP).astype(np.int64)
                held, size = [], 0
    if held:
        yield np.concatenate(held).reshape(-1, STEP).astype(np.int64)


def inverse_frequencies(table: DataFrame) -> np.ndarray:
    """Weights of terms from the number of passages (blocks of PASSAGE words) that hold them, over all documents."""

    def run(batches):
        total = np.zeros(TERMS, np.int64)
        for steps in grids(batches, 1):  # row by row, so that the blocks do not depend on the tasks
            steps = steps.astype(np.int16)
            if len(steps) % 2:
                steps = np.vstack([steps, np.full((1, STEP), TERMS, np.int16)])
            terms = np.sort(steps.reshape(-1, PASSAGE), axis=1)
            new = np.ones(terms.shape, bool)
            new[:, 1:] = terms[:, 1:] != terms[:, :-1]
            total += np.bincount(terms[new], minlength=TERMS + 1)[:TERMS]
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(TERMS)), pa.array(total)], ["term", "n"])

    counts = table.mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()
    held = np.zeros(TERMS + 1)
    for r in counts:
        held[r.term] = r.n
    weights = np.log1p(max(1.0, held[:TERMS].max(initial=1)) / (1 + held))
    weights[TERMS] = 0
    return weights


def _summed(table: DataFrame, make, shape: tuple[int, int]) -> np.ndarray:
    """Sum of the matrices that ``make`` gives for the grids of a term table; each task gives one matrix."""

    def batch_of(parts: Iterable[tuple[int, np.ndarray]]) -> pa.RecordBatch:
        parts, sums = zip(*((part, total.astype(np.float32).tobytes()) for part, total in parts))
        return pa.RecordBatch.from_arrays([pa.array(parts, pa.int32()), pa.array(sums, pa.binary())], ["part", "sums"])

    def run(batches):
        total, some = np.zeros(shape), False
        for grid in grids(batches):
            total += make(grid)
            some = True
        if some:
            yield batch_of((i, total[i : i + ROWS]) for i in range(0, shape[0], ROWS))

    def add(batches):
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, sums in zip(batch.column(0).to_pylist(), batch.column(1)):
                totals[part] = np.frombuffer(sums.as_py(), np.float32).astype(float) + totals.get(part, 0.0)
        if totals:
            yield batch_of(totals.items())

    schema = "part int, sums binary"
    out = np.zeros(shape)
    for r in table.mapInArrow(run, schema).repartition("part").mapInArrow(add, schema).collect():
        out[r.part : r.part + ROWS] += np.frombuffer(r.sums, np.float32).reshape(-1, shape[1])
    return out


def latent_space(table: DataFrame, items: list[bytes], weights: np.ndarray, seed: int) -> np.ndarray:
    """Values of terms in the latent space, (TERMS + 1) x RANK, from a randomised SVD of all passages of a term table.

    The items' passages weigh as much as the corpus's.
    """
    own = Words(items).grid()

    def gram(values):
        """A^T A values, the sketch of one power step, but for the weights of its rows."""
        basis = np.vstack([values * weights[:-1, None], np.zeros((1, values.shape[1]))]).astype(np.float32)

        def make(grid: np.ndarray) -> np.ndarray:
            sums = passage_sums(grid, basis)
            around = sums.copy()  # of the passages that hold a step
            for k in range(1, PASSAGE // STEP):
                around[k:] += sums[:-k]
            around[-1] = 0  # blanks
            return term_sums(grid, around)

        return make

    rng = np.random.default_rng(seed)
    basis = np.linalg.qr(rng.standard_normal((TERMS, RANK + EXTRA)))[0]
    share = 1.0
    for turn in range(POWER):
        make = gram(basis)
        corpus, mine = (weights[:-1, None] * sums for sums in (_summed(table, make, basis.shape), make(own)))
        if turn == 0:
            share = np.linalg.norm(corpus) / max(1e-9, np.linalg.norm(mine)) or 1.0
        basis = np.linalg.qr(corpus + share * mine)[0]
    wide = np.vstack([basis * weights[:-1, None], np.zeros((1, basis.shape[1]))]).astype(np.float32)

    def spread(grid: np.ndarray) -> np.ndarray:
        x = passage_sums(grid, wide)
        return x.T @ x

    size = (basis.shape[1], basis.shape[1])
    corpus = _summed(table, spread, size)
    values, turns = np.linalg.eigh(corpus + share * spread(own))
    turns = turns[:, ::-1][:, :RANK]
    even = turns.T @ corpus @ turns
    even += np.eye(len(even)) * 1e-6 * max(1e-9, np.trace(even))
    lengths, axes = np.linalg.eigh(even)
    return (wide @ turns @ (axes / np.sqrt(lengths))).astype(np.float32)


def answer_of(text: str) -> str:
    """The last sentence of an item, or its last five words where that is shorter than three."""
    sentences = [s for s in re.split(r"[.!?\n]+", text) if s.split()]
    last = sentences[-1] if sentences else ""
    return last if len(last.split()) >= 3 else " ".join(text.split()[-5:])


def lcs_length(words: list[int], places: dict[int, int], n: int) -> int:
    """Length of the longest common subsequence, bit-parallel: ``places`` has a bit per place of a word."""
    full = (1 << n) - 1
    v = full
    for w in words:
        m = places.get(w)
        if m:
            u = v & m
            v = ((v + u) | (v - u)) & full
    return n - v.bit_count()


def _places(words: list[int]) -> dict[int, int]:
    out: dict[int, int] = defaultdict(int)
    for i, w in enumerate(words):
        out[w] |= 1 << i
    return dict(out)


@dataclass
class Index:
    """Items with their words, answers and pieces in the latent space."""

    ids: list
    texts: list[str]
    space: np.ndarray
    weights: np.ndarray  # of terms; the rarest weigh most

    def __post_init__(self):
        own = Words([t.encode() for t in self.texts])
        sums = own.passages(self.space)
        self.words, self.sets, self.answers, pieces, self.item = [], [], [], [], []
        for i, (a, n) in enumerate(zip(own.first, own.counts)):
            words = own.hashes[a : a + n].tolist()
            self.words.append((_places(words), n))
            self.sets.append(set(words))
            answer = Words([answer_of(self.texts[i]).encode()]).hashes
            answer = answer[answer != 0].tolist()
            self.answers.append((_places(answer), len(answer)))
            last = max(0, -(-(int(n) - PASSAGE) // STEP))
            for k in range(last + 1):
                pieces.append(sums[a // STEP + k])
                self.item.append(i)
        self.pieces = _unit(np.array(pieces, np.float32).reshape(-1, self.space.shape[1]))
        self.item = np.array(self.item, np.int64)
        self._rare_words(own)

    def _rare_words(self, own: Words) -> None:
        """The words to look up for each item, and how many of them a copy holds at least.

        Of n words a copy holds ``needed`` or more, so of any n - needed + c of them it holds at least c.
        """
        self.length, self.least, pairs = own.counts.astype(np.int64), np.ones(len(own.counts), np.int64), []
        terms = own.terms()
        for i, (a, n) in enumerate(zip(own.first, own.counts)):
            if n:
                needed = int(np.ceil(_need(n) * n - 1e-9))
                self.least[i] = min(needed, max(3, n // 4))
                rarest = np.lexsort((own.hashes[a : a + n], -self.weights[terms[a : a + n]]))
                looked = rarest[: n - needed + self.least[i]]
                pairs += [(h, i) for h in set(own.hashes[a + looked].tolist())]
        pairs.sort()
        hashes = np.array([h for h, _ in pairs], U)
        self.owners = np.array([i for _, i in pairs], np.int64)
        self.looked, self.from_, self.n_owners = np.unique(hashes, return_index=True, return_counts=True)
        self.heads = np.zeros(1 << 18, bool)  # first bits of the words looked up
        self.heads[self.looked >> U(46)] = True

    def _rare_places(self, words: Words) -> Iterator[tuple[int, int, int, int]]:
        """(text, item, first, last place) of rare words near enough to each other to lie in one copy."""
        if not len(self.looked):
            return
        place = np.flatnonzero(self.heads[words.hashes >> U(46)])
        at = np.searchsorted(self.looked, words.hashes[place])
        at[at == len(self.looked)] = 0
        same = self.looked[at] == words.hashes[place]
        at, place = at[same], place[same]
        many = self.n_owners[at]
        of = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        item, place = self.owners[np.repeat(self.from_[at], many) + of], np.repeat(place, many)
        order = np.lexsort((place, item))
        item, place = item[order], place[order]
        lead = np.arange(len(item))
        end = lead + self.least[item] - 1
        lead, end = lead[end < len(item)], end[end < len(item)]
        near = (item[lead] == item[end]) & (place[end] - place[lead] < SPREAD * self.length[item[lead]])
        lead, end = lead[near], end[near]
        text = np.searchsorted(words.first, place[lead], side="right") - 1  # an empty text starts where the next one does
        inside = place[end] < words.first[text] + words.counts[text]
        found = zip(text[inside], item[lead[inside]], place[lead[inside]], place[end[inside]])
        for t, i, a, b in found:
            yield int(t), int(i), int(a), int(b)

    def matches(self, texts: list[bytes], cosine: float) -> list[tuple[int, int, float, float, int, int]]:
        """(text, item, cosine, share of the item's words, first and last word) of contaminated texts."""
        words = Words(texts)
        if not len(words.hashes) or not len(self.pieces):
            return []
        vectors = _unit(words.passages(self.space))
        text_of = np.repeat(np.arange(len(texts)), np.diff(np.append(words.first, len(words.hashes))) // STEP)
        near = []
        for b in range(0, len(self.pieces), BLOCK):
            scores = vectors @ self.pieces[b : b + BLOCK].T
            hits = np.flatnonzero(scores >= cosine)
            rows, columns = np.divmod(hits, scores.shape[1])
            near.append((text_of[rows], self.item[b + columns], rows, scores.ravel()[hits]))
        text, item, row, score = (np.concatenate(x) for x in zip(*near))
        order = np.lexsort((row, item, text))
        text, item, row, score = (x[order] for x in (text, item, row, score))
        # Runs of neighbouring passages of one text that are near one item.
        new = np.ones(len(row), bool)
        new[1:] = (np.diff(text) != 0) | (np.diff(item) != 0) | (np.diff(row) > PASSAGE // STEP)
        lead = np.flatnonzero(new)
        last = row[np.append(lead[1:], len(row)) - 1] if len(row) else row
        top = np.maximum.reduceat(score, lead) if len(row) else score
        best: dict[tuple[int, int], tuple] = {}
        runs = zip(text[lead].tolist(), item[lead].tolist(), row[lead].tolist(), last.tolist(), top.tolist())
        for t, i, a, b, s in runs:
            n = int(self.length[i])
            found = self._check(words, t, i, a * STEP - n, b * STEP + PASSAGE + n)
            if found:
                old = best.get((t, i))
                best[t, i] = (max(s, old[0]), *max(found, old[1:])) if old else (s, *found)
        more: dict[tuple[int, int], tuple] = {}
        for t, i, a, b in self._rare_places(words):
            if (t, i) not in best:
                wide = SPREAD * int(self.length[i])
                found = self._check(words, t, i, b - wide + 1, a + wide)
                if found and found > more.get((t, i), ()):
                    more[t, i] = found
        for (t, i), found in more.items():
            a, b = (int(words.first[t]) + x for x in found[1:])
            s = float((vectors[a // STEP : b // STEP + 1] @ self.pieces[self.item == i].T).max())
            best[t, i] = (s, *found)
        return [(t, i, *x) for (t, i), x in best.items()]

    def _check(self, words: Words, t: int, i: int, first: int, end: int):
        places, n = self.words[i]
        a = max(int(words.first[t]), first)
        b = min(int(words.first[t] + words.counts[t]), end)
        region = words.hashes[a:b].tolist()
        need = _need(n)
        if n - len(self.sets[i].difference(region)) < need * n:
            return None  # a common subsequence misses at least the words that do not occur
        shared = lcs_length(region, places, int(n)) / n
        if shared < need:
            return None
        answer, m = self.answers[i]
        if m and lcs_length(region, answer, m) < ANSWER_SHARE * m:
            return None
        return float(shared), a - int(words.first[t]), b - 1 - int(words.first[t])


def _need(n: int) -> float:
    return ITEM_SHARE if n >= SHORT_ITEM else 1


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)


def fit(docs: DataFrame, benchmark: DataFrame, id_col="doc_id", text_col="text", item_id="item_id", item_text="text", seed=42) -> Index | None:
    bounded_batches(docs.sparkSession)
    wanted = benchmark.where(F.col(item_text).rlike("[\\p{L}\\p{N}]")).select(
        F.col(item_id).cast("long").alias("id"), F.col(item_text).alias("text")
    )
    if (wanted.agg(F.sum(F.octet_length("text"))).first()[0] or 0) > ITEM_BYTES:
        raise ValueError("the benchmark is larger than a task may hold: pass it in parts")
    items = wanted.orderBy("id", "text").collect()
    if not items:
        return None
    table = term_table(docs.select(F.col(text_col).alias("text")))
    weights = inverse_frequencies(table)
    space = latent_space(table, [r.text.encode() for r in items], weights, seed)
    return Index([r.id for r in items], [r.text for r in items], space, weights)


def contaminated(docs: DataFrame, index: Index | None, id_col="doc_id", text_col="text", cosine=COSINE) -> DataFrame:
    """doc_id, item_id, cosine, item_share, first_word, last_word for each document and item it holds."""
    names = "doc_id long, item_id long, cosine double, item_share double, first_word long, last_word long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_pylist()
            out = [
                (ids[start + t], index.ids[i], round(score, 4), *rest)
                for start, part in batches_of(batch.column(1))
                for t, i, score, *rest in index.matches(part, cosine)
            ]
            columns = list(zip(*out)) or [()] * 6
            types = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types)], [n.split()[0] for n in names.split(", ")]
            )

    if index is None:
        return docs.sparkSession.createDataFrame([], names)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, names)


def clean(docs: DataFrame, index: Index | None, text_col="text", cosine=COSINE) -> DataFrame:
    """The rows that hold no item, with all their columns."""
    place = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.ones(batch.num_rows, bool)
            for start, part in batches_of(batch.column(place)):
                keep[[start + t for t, *_ in index.matches(part, cosine)]] = False
            yield batch.filter(pa.array(keep))

    return docs if index is None else docs.mapInArrow(run, docs.schema)
