"""Words of many texts at once, as numbers, and sums of counts by key inside a task."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

WINDOW = 4 << 20  # bytes of text worked on at once
HELD = 1 << 18  # rows of counts a task holds before it hands them on

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def kinds(spaces: bytes, breaks: bytes) -> np.ndarray:
    """What each byte is: 0 part of a word, 1 a space, 2 a break between pieces."""
    kind = np.zeros(256, np.uint8)
    kind[list(spaces)] = 1
    kind[list(breaks)] = 2
    return kind


class Tokens:
    """The words of some bytes: the distinct ones (``words``), each place's word (``ids``), piece and start."""

    def __init__(self, data: np.ndarray, kind: np.ndarray):
        kind = kind.take(data)
        inside = kind == 0
        edge = np.diff(inside.view(np.int8), prepend=0, append=0)
        self.starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        offsets = np.zeros(len(ends) + 1, np.int64)
        np.cumsum(ends - self.starts, out=offsets[1:])
        every = pa.Array.from_buffers(
            pa.large_string(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(data[inside])]
        ).dictionary_encode()
        self.words = every.dictionary.cast(pa.string())
        self.ids = every.indices.to_numpy()
        self.piece = np.cumsum(kind == 2, dtype=np.int32)[self.starts]


def windows(batches: Iterator[pa.RecordBatch], kind: np.ndarray) -> Iterator[tuple[str, Tokens]]:
    """(group, words in lower case) of about ``WINDOW`` bytes at a time, cut at breaks only.

    The first column names a text's group, the second is the text; a text's end is a break.
    """
    held: dict[str, list[bytes]] = {}
    size: dict[str, int] = {}

    def flush(group):
        data = LOWER.take(np.frombuffer(b"\n".join(held.pop(group)) + b"\n", np.uint8))
        del size[group]
        while len(data):
            end = len(data)
            if end > WINDOW:
                breaks = np.flatnonzero(kind.take(data[:WINDOW]) == 2)
                end = int(breaks[-1]) + 1 if len(breaks) else WINDOW + int(np.argmax(kind.take(data[WINDOW:]) == 2)) + 1
            yield group, Tokens(data[:end], kind)
            data = data[end:]

    for batch in batches:
        for group, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
            if text:
                held.setdefault(group, []).append(text)
                size[group] = size.get(group, 0) + len(text)
                if size[group] >= WINDOW:
                    yield from flush(group)
        while sum(size.values()) > 4 * WINDOW:
            yield from flush(max(size, key=size.get))
    for group in list(held):
        yield from flush(group)


class Tally:
    """Sums counts (column n) by key inside a task; hands them on when it holds many keys."""

    def __init__(self, keys: list[str]):
        self.keys, self.parts, self.rows = keys, [], 0

    def add(self, *columns) -> Iterator[pa.RecordBatch]:
        self.parts.append(pa.table(list(map(pa.array, columns)), names=[*self.keys, "n"]))
        self.rows += len(columns[0])
        if self.rows > HELD:
            self._merge()
            if self.rows > HELD // 2:
                yield from self.rest()

    def _merge(self) -> None:
        merged = pa.concat_tables(self.parts).group_by(self.keys).aggregate([("n", "sum")])
        self.parts = [merged.select([*self.keys, "n_sum"]).rename_columns([*self.keys, "n"])]
        self.rows = merged.num_rows

    def rest(self) -> Iterator[pa.RecordBatch]:
        if self.parts:
            self._merge()
            yield from self.parts[0].to_batches(1 << 16)
            self.parts, self.rows = [], 0
