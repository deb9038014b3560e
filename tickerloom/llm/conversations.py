"""Repair of conversations so that user and assistant take turns, by the cheapest edits.

A row is kept (0), given another role (3), or deleted (4); an empty row may be put in anywhere (3). Kept
truncated rows cost 3 more; blank and repeated rows have to go. The roles' initials that are left have to read
``(s?(ua)+)?``: four states (nothing yet, after s, after u, after a). Costs of the states form a vector; less
its smallest entry, and without entries that no cheapest repair can use, only few different vectors exist, so what a
block of ``BLOCK`` rows does to a vector is looked up in a table made once. From the last block backward each
block is expanded again, and every place notes the ASCII-least letter among its cheapest edits; as the letters at a
place lead to one state each, reading them from the front gives the ASCII-least sequence of all cheapest ones.

A row of null or blank text is blank. A null role, text, id or turn counts as one space; turns that are null come
first and take no part in gaps. Rows of one turn are ordered by role, then by their texts' SHA-256; a null id is a
conversation like any other. Rows are sorted by Spark and streamed: a task holds a conversation's
letters (its audit, a cell of the result anyway), never its texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickerloom.llm.text import SPACES, bounded_batches, kept_table

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
BLOCK = 4

# Symbols of rows: 0 has to go; 1 to 4 are whole rows with the role initial s, u, a or another, 5 to 8 truncated ones.
INITIALS = "sua"
N_SYMBOLS = 9
FAR = 1 << 20  # no cheapest repair comes through here
OPEN, SYSTEM, USER, ASSISTANT = range(4)  # states
ROLES = {SYSTEM: "system", USER: "user", ASSISTANT: "assistant"}
NEXT_ROLE = {OPEN: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}

AUDITS = "_conv string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
HASHES = "_conv string, repaired_sha256 string"
LEGAL = {"su", "ua", "au"}


def damaged(rows: DataFrame, *, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``rows`` with faults put in by crc32 of ``id:turn``, modulo 20.

    0 drops the row, 1 empties its text, 2 removes its sentence ends, 3 repeats it, 4 makes it the user's.
    """
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.pmod(F.crc32(F.concat(space(id_col), F.lit(":"), space(turn_col))), F.lit(20))
    return (
        rows.select(
            F.col(id_col), F.col(turn_col), space(role_col).alias(role_col), space(text_col).alias(text_col), kind.alias("_kind")
        )
        .where("_kind <> 0")
        .select(
            F.col(id_col), F.col(turn_col),
            F.when(F.col("_kind") == 4, "user").otherwise(F.col(role_col)).alias(role_col),
            F.when(F.col("_kind") == 1, "")
            .when(F.col("_kind") == 2, F.translate(text_col, ".!?", ""))
            .otherwise(F.col(text_col)).alias(text_col),
            F.explode(F.when(F.col("_kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_copy"),
        )
        .drop("_copy")
    )


def _named(id_col: str) -> Column:
    """A conversation's id as text; null has a name of its own."""
    return F.when(F.col(id_col).isNull(), "n").otherwise(F.concat(F.lit("i"), F.col(id_col).cast("string")))


def repair(
    rows: DataFrame, ids: DataFrame, *, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """Each of ``ids`` (distinct): its gaps and faults, the cheapest repair's letters and cost, the repaired text's hash."""
    bounded_batches(rows.sparkSession)
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    lines = rows.select(
        _named(id_col).alias("_conv"), F.col(turn_col).cast("long").alias("_turn"), space(role_col).alias("_role"), space(text_col).alias("_text")
    ).withColumn("_digest", F.sha2("_text", 256))
    audits = kept_table(_audited(lines), "audits")
    out = (
        ids.select(F.col(id_col)).distinct()
        .withColumn("_conv", _named(id_col))
        .join(audits, "_conv", "left")
        .join(_hashed(lines, audits), "_conv", "left")
        .drop("_conv")
    )
    empty = hashlib.sha256(b"").hexdigest()
    return out.fillna("", ["audit"]).fillna(empty, ["repaired_sha256"]).fillna(0, ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"])


def _in_order(rows: DataFrame, *first: str) -> DataFrame:
    """A conversation's rows in one task, in order."""
    return rows.repartition("_conv").sortWithinPartitions("_conv", *first, F.asc_nulls_first("_turn"), "_role", "_digest")


def _audited(lines: DataFrame) -> DataFrame:
    order = F.struct(F.col("_turn").isNotNull().alias("known"), F.col("_turn").alias("turn"))
    groups = lines.groupBy("_conv", "_role", "_digest").agg(F.min(order).alias("_first"), F.count("*").alias("_times"))
    repeated = groups.where("_times > 1").drop("_times")
    trimmed = F.btrim(F.col("_text"), F.lit(SPACES))
    last = F.right(trimmed, F.lit(1))
    state = F.when(trimmed == "", "b").when(~last.isin(".", "!", "?"), "t").otherwise("w")
    narrow = (
        lines.select("_conv", "_turn", "_role", "_digest", state.alias("_state"))
        .join(repeated, ["_conv", "_role", "_digest"], "left")
        .select(
            "_conv", "_turn", "_role", "_digest", "_state",
            (F.col("_first").isNotNull() & ~F.col("_first").eqNullSafe(order)).alias("_later"),
        )
    )
    return _in_order(narrow).mapInArrow(_audit_batches, AUDITS)


def _hashed(lines: DataFrame, audits: DataFrame) -> DataFrame:
    ops = audits.select(
        "_conv", F.lit(None).cast("long").alias("_turn"), F.lit("").alias("_role"), F.col("audit").alias("_text"),
        F.lit("").alias("_digest"), F.lit(0).alias("_kind"),
    )
    rows = ops.unionByName(lines.withColumn("_kind", F.lit(1)))
    ordered = _in_order(rows, "_kind").select("_conv", "_kind", "_role", "_text")
    return ordered.mapInArrow(_hash_batches, HASHES)


# --- inside tasks ---------------------------------------------------------------------------


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns))


def _table(rows: list[tuple], names: list[str], types: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows), types)], names=names)


def _audit_batches(batches):
    names = ["_conv", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]
    types = [pa.string(), *[pa.int64()] * 6, pa.string()]
    out, size, conv, symbols = [], 0, None, bytearray()
    repairs = Repairs()

    def finish():
        cost, audit = repairs.cheapest(bytes(symbols))
        gaps = turns[1] - turns[0] + 1 - turns[2] if turns else 0
        return (conv, gaps, *faults, illegal, cost, audit)

    for name, turn, role, digest, state, later in _rows(batches):
        if name != conv:
            if conv is not None:
                out.append(finish())
                size += len(symbols)
                if size > 1 << 20 or len(out) >= 1 << 14:
                    yield _table(out, names, types)
                    out, size = [], 0
            conv, symbols, faults, illegal, turns, before = name, bytearray(), [0, 0, 0], 0, None, None
        if turn is not None:
            if turns is None:
                turns = [turn, turn, 1]  # least, greatest, how many
            elif turn != turns[1]:
                turns[1:] = [turn, turns[2] + 1]
        again = later or (turn, role, digest) == before
        if before is not None and before[1][:1] + role[:1] not in LEGAL:
            illegal += 1
        before = (turn, role, digest)
        fault = 0 if state == "b" else 1 if again else 2 if state == "t" else None
        if fault is not None:
            faults[fault] += 1
        if fault in (0, 1):
            symbols.append(0)
        else:
            initial = INITIALS.find(role[:1]) if role else -1
            symbols.append(1 + initial % 4 + (4 if fault == 2 else 0))
    if conv is not None:
        out.append(finish())
    if out:
        yield _table(out, names, types)


def _hash_batches(batches):
    out, conv = [], None
    names, types = ["_conv", "repaired_sha256"], [pa.string(), pa.string()]

    def line(role, text):
        nonlocal fresh
        digest.update((f"{role}:{text}" if fresh else f"\n{role}:{text}").encode())
        fresh = False

    def inserted():
        nonlocal at, state
        while at < len(audit) and audit[at] == "I":
            state = NEXT_ROLE[state]
            line(ROLES[state], "")
            at += 1

    for name, kind, role, text in _rows(batches):
        if kind == 0:
            if conv is not None:
                inserted()
                out.append((conv, digest.hexdigest()))
                if len(out) >= 1 << 14:
                    yield _table(out, names, types)
                    out = []
            conv, audit, at, state, fresh, digest = name, text, 0, OPEN, True, hashlib.sha256()
            continue
        inserted()
        letter = audit[at]
        at += 1
        if letter == "K":
            state = _kept(state, INITIALS.find(role[:1]))
            line(role, text)
        elif letter == "R":
            state = NEXT_ROLE[state]
            line(ROLES[state], text)
    if conv is not None:
        inserted()
        out.append((conv, digest.hexdigest()))
    if out:
        yield _table(out, names, types)


# --- cheapest repairs ------------------------------------------------------------------------


def _kept(state: int, initial: int) -> int | None:
    """Where a kept row leads; ``initial`` counts in INITIALS."""
    if initial == 0:
        return SYSTEM if state == OPEN else None
    return NEXT_ROLE[state] if ROLES[NEXT_ROLE[state]][0] == INITIALS[initial : initial + 1] else None


def _edits(symbol: int) -> list[tuple[int, str, int, int]]:
    """(from state, letter, cost, to state) of the edits a row allows."""
    edits = [(s, "D", DELETE, s) for s in range(4)]
    if symbol:
        more = TRUNCATED if symbol > 4 else 0
        for s in range(4):
            edits.append((s, "R", REROLE + more, NEXT_ROLE[s]))
            to = _kept(s, (symbol - 1) % 4)
            if to is not None:
                edits.append((s, "K", KEEP + more, to))
    return edits


def _settled(costs: list[int]) -> tuple[tuple[int, ...], int]:
    """The vector after insertions, less its smallest entry, and that entry.

    What state OPEN is good for beyond ASSISTANT is keeping one s row, worth a deletion at most; SYSTEM is good for nothing more
    than ASSISTANT. Entries that are strictly worse by more are out of every cheapest repair.
    """
    o, s, u, a = costs
    u = min(u, min(o, s, a) + INSERT)
    a = min(a, u + INSERT)
    o = FAR if o > a + DELETE else o
    s = FAR if s > a else s
    least = min(o, s, u, a)
    return tuple(FAR if c >= FAR else c - least for c in (o, s, u, a)), least


class Repairs:
    """The tables, made once for a task, and the repairs read off them."""

    def __init__(self):
        start, _ = _settled([0, FAR, FAR, FAR])
        self.vectors, to, off = [start], [], []
        for vector in self.vectors:  # grows while it is read
            to.append([])
            off.append([])
            for symbol in range(N_SYMBOLS):
                costs = [FAR] * 4
                for s, _, cost, t in _edits(symbol):
                    costs[t] = min(costs[t], vector[s] + cost)
                new, least = _settled(costs)
                if new not in self.vectors:
                    self.vectors.append(new)
                to[-1].append(self.vectors.index(new))
                off[-1].append(least)
        self.to, self.off = np.array(to, np.int32), np.array(off, np.int32)  # after a vector and a symbol
        self.block_to, self.block_off = self.to, self.off  # after a block, numbered in base N_SYMBOLS
        for _ in range(BLOCK - 1):
            self.block_off = (self.block_off[:, :, None] + self.off[self.block_to]).reshape(len(to), -1)
            self.block_to = self.to[self.block_to].reshape(len(to), -1)
        self.known: dict[tuple, str] = {}

    def letters(self, before: int, symbol: int, after: str) -> str:
        """The least letter of each state on a cheapest way, "-" off it, given that of the states after the row."""
        key = (before, symbol, after)
        if key not in self.known:
            old, new, least = self.vectors[before], self.vectors[self.to[before, symbol]], self.off[before, symbol]
            choice = ["-"] * 4
            for s, letter, cost, t in _edits(symbol):
                if after[t] != "-" and old[s] < FAR and old[s] + cost == new[t] + least:
                    choice[s] = letter if choice[s] == "-" else min(choice[s], letter)
            _inserts(old, choice)
            self.known[key] = "".join(choice)
        return self.known[key]

    def cheapest(self, symbols: bytes) -> tuple[int, str]:
        """Cost and letters of the ASCII-least of the cheapest repairs of a row of symbols."""
        whole = len(symbols) // BLOCK
        blocks = np.frombuffer(symbols, np.uint8)[: whole * BLOCK].reshape(-1, BLOCK)
        vector, cost, borders = 0, 0, []
        for code in blocks.astype(np.int64) @ (N_SYMBOLS ** np.arange(BLOCK)[::-1]):
            borders.append(vector)
            cost += int(self.block_off[vector, code])
            vector = int(self.block_to[vector, code])
        borders.append(vector)
        for symbol in symbols[whole * BLOCK :]:
            cost += int(self.off[vector, symbol])
            vector = int(self.to[vector, symbol])
        last = self.vectors[vector]
        end = min(last[OPEN], last[ASSISTANT])
        choice = ["." if s in (OPEN, ASSISTANT) and last[s] == end else "-" for s in range(4)]  # "." ends
        _inserts(last, choice)
        levels = ["".join(choice)]
        for block in reversed(range(len(borders))):
            part = symbols[block * BLOCK : (block + 1) * BLOCK]
            inside = [borders[block]]
            for symbol in part[:-1]:
                inside.append(int(self.to[inside[-1], symbol]))
            for v, symbol in zip(reversed(inside), reversed(part)):
                levels.append(self.letters(v, symbol, levels[-1]))
        levels.reverse()
        state, at, out = OPEN, 0, []
        while (letter := levels[at][state]) != ".":
            out.append(letter)
            if letter == "K":
                state = _kept(state, (symbols[at] - 1) % 4)
            elif letter != "D":
                state = NEXT_ROLE[state]
            at += letter != "I"
        return cost + end, "".join(out)


def _inserts(vector: tuple[int, ...], choice: list[str]) -> None:
    """Note I where an insertion leads to a state on a cheapest way and no letter before it does."""
    for s in sorted(range(4), key=lambda s: -vector[s]):
        if choice[NEXT_ROLE[s]] != "-" and vector[s] < FAR and vector[s] + INSERT == vector[NEXT_ROLE[s]]:
            choice[s] = "I" if choice[s] == "-" else min(choice[s], "I")
