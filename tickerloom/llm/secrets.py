"""Secret scans: three base patterns, and a linear-chain conditional random field beside them.

Words are tagged as the begin of a secret, inside one, or outside, from their shape, the words
around them and features of the text, decoded by Viterbi. A chain is a line with all of its words; every word of every
line is scored and decoded, the lines of a part of a batch side by side.

The field is trained here, on pieces of chains tagged by the values that the base patterns name; the patterns themselves are
not among its features. All documents are searched for base matches; a bounded number of the pieces with one, of those
with an odd word or a cue only, and of all others is drawn from all pieces of all documents.

Edge cases: a null text is empty; without a base match in any document nothing is added to
the base spans; spans that overlap a base span are not added; equal rows get equal results; an empty table gives
an empty result; other columns are not looked at.
"""

from __future__ import annotations

import heapq
import math
import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerloom.llm.text import bounded_batches, kept_table

KINDS = ("assign", "access", "hex", "crf")
# The base patterns.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")

APART = r"\s\"'`,;:=()<>{}\[\]"  # characters between words
WORD = re.compile(rf"[^{APART}]+")
BOUNDS = 0x3001  # no character between words is this one or a later one
IS_APART = np.array([*[WORD.match(chr(c)) is None for c in range(BOUNDS)], False])
GAP = re.compile(rf"[{APART}]*\Z")
CUES = frozenset(("pass", "password", "passwd", "passphrase", "passcode", "pwd", "secret", "token", "key", "api_key", "apikey", "credential", "credentials", "auth", "bearer", "login"))
NEAR = 3  # words back in which a cue counts
LONGEST = 8  # words of a piece that is learnt from; longer chains are cut there
RUNS = 4000  # pieces of each kind: with a secret, with an odd word or a cue; half as many others
KNOWN = 1 << 18  # words whose scores a task keeps
CHARACTERS = 1 << 20  # of texts whose words are scored at once
CLEAR = 1e-6  # a difference of scores that rounding cannot make
OUT, BEGIN, INSIDE = 0, 1, 2
TAGS = 3
QUOTES = (chr(34), chr(39))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base patterns, in order."""
    found = []
    low = text.lower()
    if any(k in low for k in KEYWORDS):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def values(text: str, without: int | None = None) -> list[tuple[int, int]]:
    """(start, end) of what the base patterns call secret, in order, each character once; ``without`` leaves a kind out."""
    found = []
    for a, kind, b in base_spans(text):
        if kind != without:
            found.append((ASSIGN.match(text, a).start(2) if kind == 0 else a, b))
    out: list[tuple[int, int]] = []
    for a, b in sorted(found):
        if out and a < out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def runs(text: str) -> list[list[tuple[int, int]]]:
    """Chains: the words of each line that has any."""
    out, at = [], 0
    for line in text.split("\n"):
        words = [(at + m.start(), at + m.end()) for m in WORD.finditer(line)]
        if words:
            out.append(words)
        at += len(line) + 1
    return out


CLASSES = [re.compile(c) for c in ("[a-z]", "[A-Z]", "[0-9]", "[+/_=-]", r"\.", r"[!#$%&*?@^|~\\]", r"[^\x00-\x7f]")]
SHAPES = {ord(c): k for letters, k in (("abcdef", "x"), ("ghijklmnopqrstuvwxyz", "l"), ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "U"), ("0123456789", "9")) for c in letters}
REPEATED, MIXED = re.compile(r"([xlU9])\1+"), re.compile(r"(x9|9x)+")
HEXLIKE, CAPITAL, NUMBER = (re.compile(c) for c in ("[0-9a-f]+", "[A-Z0-9]+", "[0-9.+/=-]+"))


def _shape(word: str) -> str:
    """Classes of characters in order, runs of one class written once."""
    s = REPEATED.sub(r"\1", word.translate(SHAPES))
    return (MIXED.sub("h", s) if "9" in s else s)[:6]


@lru_cache(1 << 14)
def _entropy(counts: tuple[int, ...]) -> float:
    n = sum(counts)
    return -sum(c / n * math.log2(c / n) for c in counts)


def _halves(word: str) -> int:
    return int(_entropy(tuple(sorted(map(word.count, set(word))))) * 2)


def _name(word: str) -> str:
    return word.lower() if len(word) <= 24 else ""


def _is_cue(word: str) -> bool:
    return len(word) <= 24 and word.lower().strip("_-") in CUES


def _is_odd(name: str) -> bool:
    return not name.isalpha() and any(c.isdigit() for c in name)


def _kind(word: str) -> tuple:
    """What the features of a word alone are made of."""
    head = word[:64]  # what a longer one goes on with tells no more
    entropy = _halves(head)
    shape, letters = _shape(head), head.isalpha()
    if letters and head.isascii():
        upper, lower = head.isupper(), head.islower()
        classes = (not upper, not lower, False, False, False, False, False)
        return len(word), shape, classes, 0.0, entropy, lower and not head.strip("abcdef"), upper, False, True, False
    classes = tuple([c.search(head) is not None for c in CLASSES])
    digits = sum(c.isdigit() for c in head) / len(head)
    full = [c.fullmatch(head) is not None for c in (HEXLIKE, CAPITAL, NUMBER)]
    return len(word), shape, classes, digits, entropy, *full, letters, "@" in head


def _features_of(kind: tuple) -> list[str]:
    n, shape, classes, digits, entropy, hexlike, capital, number, letters, mail = kind
    return [
        "bias",
        f"length={min(n // 4, 12)}",
        f"shape={shape}",
        f"classes={classes}",
        f"kinds={sum(classes)}",
        f"digits={int(digits * 5)}",
        f"entropy={entropy}",
        f"hexlike={hexlike}",
        f"capital={capital}",
        f"number={number}",
        f"letters={letters}",
        f"long={n >= 16},{digits > 0}",
        f"mail={mail}",
    ]


def word_features(word: str) -> list[str]:
    """Features of a word alone."""
    return _features_of(_kind(word))


def _wide(word: str) -> tuple[bool, bool]:
    """Whether a word has a digit, and eight characters: after a cue both tell more."""
    return not word.isalpha() and CLASSES[2].search(word, 0, 64) is not None, len(word) >= 8


AFTER = ("", "word", "odd")  # what follows a word in its line


def context_features(after: int, cue: int, wide: tuple[bool, bool], quoted: bool, assigned: bool, lines: int) -> list[str]:
    return [
        f"after={AFTER[after]}",
        f"cue={cue}",
        f"cue={cue > 0},{wide[0]},{wide[1]}",
        f"quoted={quoted}",
        f"assigned={assigned}",
        f"lines={lines}",
    ]


def _mark(gap: str, before: str) -> str:
    """The last visible character of the eight before a word: of the gap, or of the word before it."""
    seen = gap[-8:].strip()[-1:] or (before[-1:] if len(gap) < 8 else "")
    return "a" if seen.isalnum() else seen


def _assigned(gap: str) -> bool:
    return bool(re.search("[:=] *.?$", gap[-8:]))


def run_features(text: str, run: list[tuple[int, int]], lines: int | None = None, part: slice = slice(None)) -> list[list[str]]:
    """Features of the words of a chain (``part``: of some of them): shape, neighbours, text. ``lines`` of the text, counted if not given."""
    lines = text.count("\n") if lines is None else lines
    out = []
    for i in range(len(run))[part]:
        a, b = run[i]
        left, right = text[max(0, a - 8) : a], text[b : b + 1]
        gap = GAP.search(left)[0]
        cue = next((k for k in range(1, NEAR + 1) if i >= k and _is_cue(text[slice(*run[i - k])])), 0)
        after = 0 if i + 1 == len(run) else 2 if _is_odd(_name(text[slice(*run[i + 1])])) else 1
        quoted = gap[-1:] in QUOTES and right in QUOTES
        out.append(
            [
                *word_features(text[a:b]),
                f"before={_name(text[slice(*run[i - 1])]) if i else ''}",
                f"mark={_mark(gap, left[: len(left) - len(gap)])}",
                *context_features(after, cue, _wide(text[a:b]), quoted, _assigned(gap), min(3, lines // 10)),
            ]
        )
    return out


def run_tags(run: list[tuple[int, int]], secret: list[tuple[int, int]]) -> list[int]:
    """Tags of a chain's words by sorted spans that do not overlap."""
    tags, last = [], None
    ends = [e for _, e in secret]
    for a, b in run:
        at = bisect_right(ends, a)
        owner = at if at < len(secret) and secret[at][0] < b else None
        tags.append(OUT if owner is None else INSIDE if owner == last else BEGIN)
        last = owner
    return tags


class Field:
    """A linear-chain conditional random field; weights by feature and tag, and by tag pair."""

    def __init__(self, names: list[str]):
        self.place = {f: i for i, f in enumerate(names)}
        self.own = np.zeros((len(names), TAGS))
        self.pair = np.zeros((TAGS + 1, TAGS))  # the last row starts a chain
        self.barred = np.zeros((TAGS + 1, TAGS))
        self.barred[[OUT, TAGS], INSIDE] = -1e9  # inside follows begin or inside

    def rows(self, features: list[list[str]]) -> list[list[int]]:
        return [[self.place[f] for f in fs if f in self.place] for fs in features]

    def _scores(self, rows) -> tuple[np.ndarray, np.ndarray]:
        return np.array([self.own[r].sum(axis=0) for r in rows]), self.pair + self.barred

    def learn(self, chains: list[tuple[list[list[int]], list[int]]], turns=8, rate=0.2, ridge=1e-4, seed=42) -> None:
        """Ascent on the log-likelihood, chain by chain, with steps scaled by past slopes."""
        rng = np.random.default_rng(seed)
        seen_own, seen_pair = np.full(self.own.shape, 1e-6), np.full(self.pair.shape, 1e-6)
        for _ in range(turns):
            for c in rng.permutation(len(chains)):
                rows, tags = chains[c]
                own, pair = self._scores(rows)
                n = len(rows)
                ahead, back = np.zeros((n, TAGS)), np.zeros((n, TAGS))
                ahead[0] = own[0] + pair[TAGS]
                for t in range(1, n):
                    ahead[t] = own[t] + _log_sum(ahead[t - 1][:, None] + pair[:TAGS], 0)
                for t in range(n - 2, -1, -1):
                    back[t] = _log_sum(pair[:TAGS] + (own[t + 1] + back[t + 1])[None, :], 1)
                total = _log_sum(ahead[-1], 0)
                g_pair = np.zeros_like(self.pair)
                g_pair[TAGS, tags[0]] += 1
                g_pair[TAGS] -= np.exp(ahead[0] + back[0] - total)
                for t in range(n):
                    g = -np.exp(ahead[t] + back[t] - total)
                    g[tags[t]] += 1
                    r = rows[t]
                    step = g[None, :] - ridge * self.own[r]
                    seen_own[r] += step * step
                    self.own[r] += rate * step / np.sqrt(seen_own[r])
                    if t:
                        both = ahead[t - 1][:, None] + pair[:TAGS] + (own[t] + back[t])[None, :]
                        g_pair[:TAGS] -= np.exp(both - total)
                        g_pair[tags[t - 1], tags[t]] += 1
                seen_pair += g_pair * g_pair
                self.pair += rate * g_pair / np.sqrt(seen_pair)

    def decode(self, rows: list[list[int]]) -> list[int]:
        """The likeliest tags, by Viterbi."""
        own, pair = self._scores(rows)
        best, back = own[0] + pair[TAGS], []
        for t in range(1, len(rows)):
            ways = best[:, None] + pair[:TAGS]
            back.append(ways.argmax(axis=0))
            best = ways.max(axis=0) + own[t]
        tags = [int(best.argmax())]
        for b in reversed(back):
            tags.append(int(b[tags[-1]]))
        return tags[::-1]

    def open_words(self, own: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Words that are not outside on every likeliest path, whatever stands around them, and the words beside those in their line.

        A word is outside for sure if even the most that the other tags can gain over it, by the word before and the ways on, is a
        loss. Each chain may be cut at such words: ``tags`` of what is left is ``tags`` of the whole.
        """
        pair, ways = self.pair + self.barred, (OUT, BEGIN)
        after = np.append(own[1:, INSIDE] - own[1:, BEGIN], 0.0) + np.max(pair[INSIDE] - pair[BEGIN], initial=0.0)
        after[np.append(starts[1:], True)] = -np.inf  # nothing follows in the line
        sure = np.ones(len(own), bool)
        for tag, sources in ((BEGIN, slice(None)), (INSIDE, slice(BEGIN, INSIDE + 1))):
            gain = own[:, tag] - own[:, OUT] + np.max(pair[sources, tag] - pair[sources, OUT])
            on = max(0.0, *[pair[tag, k] - pair[OUT, k] for k in ways])  # nothing, or another tag, follows
            sure &= gain + np.maximum(on, pair[tag, INSIDE] - pair[OUT, BEGIN] + after) < -CLEAR
        left = ~sure
        left[1:] |= ~sure[:-1] & ~starts[1:]
        left[:-1] |= ~sure[1:] & ~starts[1:]
        return left

    def tags(self, own: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """The likeliest tags of the words of many chains, which begin where ``starts`` is true: as ``decode`` for each, side by side."""
        pair = self.pair + self.barred
        lead = np.flatnonzero(starts)
        length = np.diff(np.append(lead, len(own)))
        order = np.argsort(-length, kind="stable")
        lead, length = lead[order], length[order]
        most = int(length[0])
        left = np.searchsorted(-length, -np.arange(most), "left")  # chains that are longer than that
        back = np.zeros((len(own), TAGS), np.int8)
        best = own[lead] + pair[TAGS]
        last = np.zeros(len(lead), np.int8)
        for t in range(1, most + 1):
            k = int(left[t]) if t < most else 0
            last[k : len(best)] = best[k:].argmax(axis=1)
            if not k:
                break
            ways = best[:k, :, None] + pair[:TAGS]
            back[lead[:k] + t] = ways.argmax(axis=1)
            best = ways.max(axis=1) + own[lead[:k] + t]
        tags = np.zeros(len(own), np.int8)
        for t in range(most - 1, -1, -1):
            k = int(left[t])
            tags[lead[:k] + t] = last[:k]
            if t:
                last[:k] = back[lead[:k] + t, last[:k]]
        return tags


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis=axis)) + top.squeeze(axis)


class Kept(dict):
    """What ``make`` gives for words or gaps: the place of each in ``values``, made once while it is kept."""

    def __init__(self, make, width: int):
        self.make, self.values = make, np.zeros((256, width))

    def places(self, keys: list[str]) -> np.ndarray:
        """Places of keys, each of which is named once."""
        new = [k for k in keys if k not in self]
        if new:
            have, need = len(self), len(self) + len(new)
            if need > len(self.values):
                self.values = np.vstack([self.values, np.zeros((max(need, 2 * have) - len(self.values), self.values.shape[1]))])
            self.values[have:need] = self.make(new)
            self.update(zip(new, range(have, need)))
        return np.fromiter(map(self.__getitem__, keys), np.int64, len(keys))


TELLS = [re.compile(c) for c in ("[^0-9a-f]", "[^A-Z0-9]", "[^0-9.+/=-]")]
DIGIT, OTHER, ANY_DIGIT = 1 << 2, 1 << 6, 1 << 12  # bits of ``_told``: 0 to 9, not ASCII, a digit of any script


@lru_cache(1 << 14)
def _told(c: str) -> int:
    """What a character tells of its word, as bits: its classes, what the word is not, whether it is a digit of any script."""
    told = [x.match(c) is not None for x in (*CLASSES, *TELLS)] + [not c.isalpha(), c == "@", c.isdigit()]
    return sum(1 << i for i, x in enumerate(told) if x)


class Spelled:
    """The characters of words, one word after the other."""

    def __init__(self, words: list[str], size: np.ndarray):
        self.words, self.size, self.lead = words, size, np.cumsum(size) - size
        codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        place = np.zeros(int(codes.max()) + 1, np.uint32)
        place[codes] = 1
        letters = np.flatnonzero(place)
        place[letters] = np.arange(len(letters))
        self.alphabet, self.letter = [chr(c) for c in letters.tolist()], place[codes]
        self.each = np.array([_told(c) for c in self.alphabet], np.uint16)[self.letter]
        self.told = np.bitwise_or.reduceat(self.each, self.lead).astype(np.int64)

    def shapes(self) -> np.ndarray:
        """Numbers of the shapes; equal numbers, equal shapes."""
        shapes = [c.translate(SHAPES) for c in self.alphabet]
        number = {c: i + 1 for i, c in enumerate(dict.fromkeys(shapes))}
        width = len(number).bit_length()
        shape = np.array([number[c] for c in shapes], np.int64)[self.letter]
        stays = np.append(True, shape[1:] != shape[:-1]) | ~np.array([c in "xlU9" for c in shapes])[self.letter]
        stays[self.lead] = True
        rank = np.cumsum(stays)
        rank -= np.repeat(rank[self.lead], self.size)
        out = np.add.reduceat(np.where(stays & (rank < 6), shape << width * np.minimum(rank, 6) % 60, 0), self.lead)
        # Digits make longer runs: such words go one by one, and so do all where six characters do not fit in a number.
        alone = np.flatnonzero(self.told & DIGIT) if width <= 10 else np.arange(len(out))
        forms: dict[str, int] = {}
        out[alone] = [-1 - forms.setdefault(_shape(self.words[i]), len(forms)) for i in alone.tolist()]
        return out

    def entropies(self) -> np.ndarray:
        """Entropy of each word's characters in halves of a bit, rounded down."""
        n, letters = len(self.size), len(self.alphabet)
        key = np.repeat(np.arange(n), self.size) * letters + self.letter
        key = np.sort(key.astype(np.uint32) if n * letters < 1 << 32 else key)
        first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        times, owner = np.diff(np.append(first, len(key))), key[first] // letters
        halves = 2 * (np.log2(self.size) - np.bincount(owner, LOGS[times], n) / self.size)
        out = np.floor(halves).astype(np.int64)
        close = np.flatnonzero(np.abs(halves - np.round(halves)) < 1e-9)  # rounding may tell: as for one word, once for equal counts
        counts = np.add.reduceat(MIX[times], np.flatnonzero(np.append(True, owner[1:] != owner[:-1])))[close]
        _, one, which = np.unique(counts, return_index=True, return_inverse=True)
        exact = [_halves(self.words[i]) for i in close[one].tolist()]
        out[close] = np.array(exact, np.int64)[which] if exact else 0
        return out

    def digits(self) -> np.ndarray:
        return np.add.reduceat((self.each & ANY_DIGIT) > 0, self.lead, dtype=np.int64)


LOGS = np.arange(65) * np.log2(np.maximum(np.arange(65), 1))
MIX = np.random.default_rng(42).integers(-(1 << 63), (1 << 63) - 1, 65) | 1


def _cue_heads() -> np.ndarray:
    """First two characters a cue can have, in either case, with what is stripped off before it or not ASCII (128)."""
    heads = np.zeros((129, 129), bool)
    for cue in CUES:
        for a in {cue[0], cue[0].upper()}:
            for b in {cue[1], cue[1].upper()}:
                heads[ord(a), ord(b)] = True
    heads[[ord("_"), ord("-"), 128]] = True
    heads[:, 128] = True
    return heads


CUE_HEADS = _cue_heads()


def _borders(joined: str, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray | None]:
    """First and end character of the words of texts that begin at ``begins``, and the byte of each character (None: the same)."""
    widths = None
    if joined.isascii():
        apart = IS_APART[np.frombuffer(joined.encode(), np.uint8)]
    else:
        codes = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        apart = IS_APART[np.minimum(codes, BOUNDS)]
        widths = np.append(0, np.cumsum(1 + (codes >= 0x80) + (codes >= 0x800) + (codes >= 0x10000), dtype=np.int64))
    border = np.zeros(len(apart) + 1, bool)  # before a character: a text begins, or the last one ends
    border[begins], border[-1] = True, True
    starts = ~apart & (np.append(True, apart[:-1]) | border[:-1])
    ends = ~apart & (np.append(apart[1:], True) | border[1:])
    return np.flatnonzero(starts), np.flatnonzero(ends) + 1, widths


def _numbered(joined: str, borders: np.ndarray) -> tuple[np.ndarray, list[str]]:
    """Numbers of the pieces of a text between borders (of bytes), and what each number stands for."""
    data = joined.encode()
    first = np.minimum(borders[:-1], len(data) - 1)
    blank = (np.diff(borders) == 1) & (np.frombuffer(data, np.uint8)[first] == 32)  # one space: most gaps
    pieces = pa.LargeStringArray.from_buffers(len(borders) - 1, pa.py_buffer(borders), pa.py_buffer(data))
    others = pieces.filter(pa.array(~blank)).dictionary_encode()
    number = np.full(len(blank), len(others.dictionary))
    number[~blank] = others.indices.to_numpy()
    return number, [*others.dictionary.to_numpy(zero_copy_only=False).tolist(), " "]


class Lines:
    """All words of texts, line by line, with the scores of a field (none: marks of odd words and cues only)."""

    def __init__(self, field: Field | None):
        self.field, self.marks = field, {}
        self.words, self.gaps = Kept(self._words, 11), Kept(lambda gaps: [self._gap(g) for g in gaps], 5)
        self.alone: dict[tuple, tuple] = {}
        if field is not None:
            self.names = {f.removeprefix("before="): i for f, i in field.place.items() if f.startswith("before=")}
            self.context = np.array(
                [
                    self._sum(context_features(after, cue, (digit, wide), quoted, assigned, lines))
                    for after in range(3)
                    for cue in range(NEAR + 1)
                    for digit in (False, True)
                    for wide in (False, True)
                    for quoted in (False, True)
                    for assigned in (False, True)
                    for lines in range(4)
                ]
            )

    def _sum(self, features: list[str]) -> np.ndarray:
        return self.field.own[self.field.rows([features])[0]].sum(axis=0)

    def _mark_of(self, mark: str) -> int:
        return self.marks.setdefault(mark, len(self.marks))

    def _word(self, word: str) -> tuple:
        """Scores alone and as the word before, and whether it is odd to the field, its marks, cue, odd shape."""
        odd = len(word) >= 6 and not word.isalpha() and bool(CLASSES[2].search(word))
        name, (digit, wide) = _name(word), _wide(word)
        flags = (_is_odd(name), 2 * digit + wide, self._mark_of(_mark("", word)), _is_cue(word), odd)
        at = self.names.get(name)
        return (*self._alone(word), *((0.0,) * TAGS if at is None else self.field.own[at]), *flags)

    def _alone(self, word: str) -> tuple:
        kind = _kind(word)
        alone = self.alone.get(kind)
        if alone is None:
            alone = self.alone[kind] = tuple(self._sum(_features_of(kind)))
        return alone

    def _words(self, words: list[str]) -> np.ndarray:
        """``_word`` of each; words of up to 64 characters together."""
        out = np.zeros((len(words), 11))
        size = np.fromiter(map(len, words), np.int64, len(words))
        for i in np.flatnonzero(size > 64).tolist():
            out[i] = self._word(words[i])
        some = np.flatnonzero(size <= 64)
        if not len(some):
            return out
        words, size = [words[i] for i in some.tolist()], size[some]
        low = "\n".join(words).lower().split("\n")
        spelled = Spelled(words, size)
        digit, short = (spelled.told & DIGIT) > 0, size <= 24
        cue = np.fromiter((w.strip("_-") in CUES for w in low), bool, len(low))
        out[some, 9], out[some, 10] = cue & short, digit & (size >= 6)
        digits = spelled.digits()
        out[some, :3] = self._sum(["bias"])
        for told, names in (
            (spelled.told, ("classes=", "kinds=", "hexlike=", "capital=", "number=", "letters=", "mail=")),
            (np.minimum(size // 4, 12) * 4 + 2 * (size >= 16) + (digits > 0), ("length=", "long=")),
            ((digits / size * 5).astype(np.int64), ("digits=",)),
            (spelled.shapes(), ("shape=",)),
            (spelled.entropies(), ("entropy=",)),
        ):
            _, one, which = np.unique(told, return_index=True, return_inverse=True)
            sums = [self._sum([f for f in word_features(words[i]) if f.startswith(names)]) for i in one.tolist()]
            out[some, :3] += np.array(sums)[which]
        at = np.fromiter((self.names.get(w if s else "", -1) for w, s in zip(low, short.tolist())), np.int64, len(low))
        out[some, 3:6] = np.where((at >= 0)[:, None], self.field.own[at], 0.0)
        odd = digit & short
        for i in np.flatnonzero((spelled.told & OTHER > 0) & short).tolist():
            odd[i] = _is_odd(low[i])
        out[some, 6], out[some, 7] = odd, 2 * digit + (size >= 8)
        last, which = np.unique(spelled.letter[spelled.lead + size - 1], return_inverse=True)
        out[some, 8] = np.array([self._mark_of(_mark("", spelled.alphabet[c])) for c in last.tolist()])[which]
        return out

    def _gap(self, gap: str) -> tuple:
        """Whether a line ends in it, its mark (-1: that of the word before), quotes at its ends, whether it assigns."""
        mark = self._mark_of(_mark(gap, "")) if _mark(gap, "") or len(gap) >= 8 else -1
        return "\n" in gap, mark, gap[-1:] in QUOTES, gap[:1] in QUOTES, _assigned(gap)

    def read(self, texts: list[str]) -> None:
        """Word by word: its text, first and end character there, whether a line begins, its marks and scores."""
        joined = "".join(texts)
        ends = np.cumsum([len(t) for t in texts], dtype=np.int64)
        begins = np.append(0, ends)[:-1]
        self.start, self.end, widths = _borders(joined, begins)
        n, upto = len(self.start), np.searchsorted(self.start, ends)
        counts = np.diff(np.append(0, upto))
        self.of = np.repeat(np.arange(len(texts)), counts)
        place = np.arange(n)
        first_of_text = np.zeros(n, bool)
        first_of_text[(upto - counts)[counts > 0]] = True
        if not n:
            self.first = self.odd = first_of_text
            self.at = place
            return
        if self.field is None:
            self._read_marks(joined, begins, first_of_text)
            return
        if max(len(self.words), len(self.gaps)) > KNOWN:
            self.marks.clear()
            self.alone.clear()
            self.words.clear()
            self.gaps.clear()
        # Gaps and words of a text in turn, a gap at either end, cover it; Arrow numbers those that differ.
        borders = np.empty(2 * n + len(texts) + 1, np.int64)
        borders[2 * (upto - counts) + np.arange(len(texts))] = begins
        borders[2 * place + self.of + 1], borders[2 * place + self.of + 2] = self.start, self.end
        borders[-1] = len(joined)
        number, values = _numbered(joined, borders if widths is None else widths[borders])
        of_word = number[2 * place + self.of + 1]
        is_word = np.zeros(len(values), bool)
        is_word[of_word] = True
        row = np.empty(len(values), np.int64)
        for kept, those in ((self.words, is_word), (self.gaps, ~is_word)):
            row[those] = kept.places([values[i] for i in np.flatnonzero(those).tolist()])
        word = self.words.values[row[of_word]]
        left, right = (self.gaps.values[row[number[2 * place + self.of + k]]] for k in (0, 2))
        self.start, self.end = self.start - begins[self.of], self.end - begins[self.of]
        self.first = first_of_text | (left[:, 0] > 0)
        self.at = place - np.maximum.accumulate(np.where(self.first, place, 0))  # in its line
        cue = self._after_cues(word[:, 9] > 0)
        self.odd = (word[:, 10] > 0) | (cue > 0)
        follows = np.append(~self.first[1:], False)
        after = np.where(follows, 1 + np.append(word[1:, 6], 0), 0)
        lines = np.array([min(3, t.count("\n") // 10) for t in texts], np.int64)[self.of]
        quoted = (left[:, 2] > 0) & (right[:, 3] > 0)
        code = ((((after * (NEAR + 1) + cue) * 4 + word[:, 7]) * 2 + quoted) * 2 + left[:, 4]) * 4 + lines
        none = self._mark_of("")
        mark = np.where(left[:, 1] >= 0, left[:, 1], np.where(first_of_text, none, np.append(none, word[:-1, 8])))
        marks = np.array([self._sum([f"mark={m}"]) for m in self.marks])
        before = np.vstack([np.zeros((1, TAGS)), word[:-1, 3:6]])
        before[self.first] = self._sum(["before="])
        self.own = word[:, :3] + before + marks[mark.astype(np.int64)] + self.context[code.astype(np.int64)]

    def _after_cues(self, cues: np.ndarray) -> np.ndarray:
        """How many words back in the line the last cue stands, 0 for none near."""
        cue = np.zeros(len(cues), np.int64)
        for k in range(NEAR, 0, -1):
            cue[k:][(self.at[k:] >= k) & cues[:-k]] = k
        return cue

    def _read_marks(self, joined: str, begins: np.ndarray, first_of_text: np.ndarray) -> None:
        """Where lines begin, and words that are odd or follow a cue, without scores: from the characters, only likely cues one by one."""
        codes = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        start, size, place = self.start, self.end - self.start, np.arange(len(self.start))
        digits = np.append(0, np.cumsum((codes >= 48) & (codes <= 57), dtype=np.int32))
        line = np.searchsorted(np.flatnonzero(codes == 10), start)
        self.first = first_of_text | (line != np.append(-1, line[:-1]))
        self.at = place - np.maximum.accumulate(np.where(self.first, place, 0))
        pairs = [np.minimum(codes[np.minimum(start + k, len(codes) - 1)], 128) for k in (0, 1)]
        cues = np.zeros(len(start), bool)
        for i in np.flatnonzero(CUE_HEADS[pairs[0], pairs[1]] & (size <= 24)).tolist():
            cues[i] = _is_cue(joined[start[i] : self.end[i]])
        self.odd = (size >= 6) & (digits[self.end] > digits[start]) | (self._after_cues(cues) > 0)
        self.start, self.end = start - begins[self.of], self.end - begins[self.of]

    def spans(self, texts: list[str]) -> list[list[tuple[int, int, int]]]:
        """(start, kind, end) of what the field calls secret in each text."""
        out: list[list] = [[] for _ in texts]
        self.read(texts)
        if len(self.of):
            tags = np.zeros(len(self.of), np.int8)
            open_ = self.field.open_words(self.own, self.first)
            if open_.any():
                begins = self.first | ~np.append(False, open_[:-1])
                tags[open_] = self.field.tags(self.own[open_], begins[open_])
            for i in np.flatnonzero(tags != OUT).tolist():
                found = out[self.of[i]]
                if tags[i] == BEGIN:
                    found.append((int(self.start[i]), 3, int(self.end[i])))
                else:
                    found[-1] = (found[-1][0], 3, int(self.end[i]))
        return out


def _parts(texts: list[str]) -> Iterator[tuple[int, list[str]]]:
    """(place of the first, texts) with about CHARACTERS in each part."""
    start = size = 0
    for i, text in enumerate(texts):
        size += len(text)
        if size >= CHARACTERS:
            yield start, texts[start : i + 1]
            start, size = i + 1, 0
    if start < len(texts):
        yield start, texts[start:]


class Fewest:
    """The ``most`` items with the smallest keys of those offered; an item is made only if it is kept."""

    def __init__(self, most: int):
        self.most, self.heap = most, []

    def limit(self) -> int:
        """Keys from here on are not kept."""
        return -self.heap[0][0] if len(self.heap) == self.most else (1 << 63) - 1

    def offer(self, key: int, make) -> None:
        if len(self.heap) < self.most:
            heapq.heappush(self.heap, (-key, make()))
        elif self.heap and -key > self.heap[0][0]:
            heapq.heapreplace(self.heap, (-key, make()))


PIECE_NAMES = ["kind", "draw", "at", "tags", "spans", "text", "lines"]
PIECE = [pa.int32(), pa.int64(), pa.int32(), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.string(), pa.int64()]
PLAIN, ODD, HELD = 0, 1, 2  # kinds of pieces: others, with an odd word or a cue, with a secret


def _drawn(hashes: np.ndarray, number: np.ndarray) -> np.ndarray:
    """63 bits, drawn by the text's hash and the piece's number in it: equal texts give equal pieces."""
    x = hashes + number.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return ((x ^ (x >> np.uint64(31))) >> np.uint64(1)).astype(np.int64)


def _offer_pieces(lines: Lines, texts: list[str], kept: dict[int, Fewest], without: int | None) -> None:
    """Offer all pieces of the texts' lines."""
    lines.read(texts)
    if not len(lines.of):
        return
    secrets = [values(t) for t in texts]
    told = secrets if without is None else [values(t, without) if s else s for t, s in zip(texts, secrets)]
    held = np.zeros(len(lines.of), bool)
    text_from = np.searchsorted(lines.of, np.arange(len(texts) + 1))
    for i, found in enumerate(secrets):
        a, b = text_from[i], text_from[i + 1]
        for x, y in found:
            held[a + np.searchsorted(lines.end[a:b], x, "right") : a + np.searchsorted(lines.start[a:b], y)] = True
    lead = np.flatnonzero(lines.at % LONGEST == 0)
    end = np.append(lead[1:], len(lines.of))
    kind = np.where(np.logical_or.reduceat(held, lead), HELD, np.logical_or.reduceat(lines.odd, lead).astype(int))
    of = lines.of[lead]
    number = np.arange(len(lead)) - np.searchsorted(of, of)
    hashes = np.array([xxhash.xxh64_intdigest(t.encode()) for t in texts], np.uint64)
    key = _drawn(hashes[of], number)
    breaks = [t.count("\n") for t in texts]

    def make(j: int):
        i, a, b = int(of[j]), int(lead[j]), int(end[j])
        low = a - min(NEAR, int(lines.at[a]))  # words of the line that the features look at
        high = b + (b < text_from[i + 1] and not lines.first[b])
        run = list(zip(lines.start[low:high].tolist(), lines.end[low:high].tolist()))
        tags = run_tags(run[a - low : b - low], told[i])
        cut = max(0, run[0][0] - 8)
        return a - low, tags, [x - cut for w in run for x in w], texts[i][cut : run[-1][1] + 1], breaks[i]

    for k, fewest in kept.items():
        some = np.flatnonzero((kind == k) & (key < fewest.limit()))
        some = some[np.argsort(key[some], kind="stable")][: fewest.most]
        for j in some.tolist():
            if k == HELD and without is not None:
                run = list(zip(lines.start[lead[j] : end[j]].tolist(), lines.end[lead[j] : end[j]].tolist()))
                if run_tags(run, secrets[of[j]]) != run_tags(run, told[of[j]]):
                    continue
            fewest.offer(int(key[j]), lambda: make(j))  # noqa: B023


def train(docs: DataFrame, id_col="doc_id", text_col="text", most=RUNS, without: int | None = None) -> Field | None:
    """A field fitted on a bounded draw of the lines of all documents; None if no document holds a secret.

    Every document is searched for base matches. Each task writes at most ``most`` pieces of each kind (with a secret, with an
    odd word or a cue, others), those of the smallest hashes, so the choice over all tasks does not depend on how rows lie; a share of
    them, about ``most`` of each, is let through to the driver. ``without`` leaves out the pieces with a value of one base kind.
    """
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, lines = {PLAIN: Fewest(most // 2), ODD: Fewest(most), HELD: Fewest(most)}, Lines(None)
        for batch in batches:
            for _, part in _parts(batch.column(0).to_pylist()):
                _offer_pieces(lines, part, kept, without)
        for kind, fewest in kept.items():
            for i in range(0, len(fewest.heap), 256):
                part = fewest.heap[i : i + 256]
                columns = [[kind] * len(part), [-k for k, _ in part], *zip(*[x for _, x in part])]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, PIECE)], PIECE_NAMES)

    texts = docs.select(F.col(text_col).alias("text")).where("text IS NOT NULL")
    found = kept_table(
        texts.mapInArrow(run, "kind int, draw long, at int, tags array<int>, spans array<long>, text string, lines long"),
        "secret-runs",
    )
    chosen = _smallest(found.where(F.col("kind") == HELD), most)
    if not chosen:
        return None
    chosen += _smallest(found.where(F.col("kind") == ODD), most) + _smallest(found.where(F.col("kind") == PLAIN), most // 2)
    place: dict[str, int] = {}
    pieces = []
    for r in chosen:
        words = list(zip(r.spans[::2], r.spans[1::2]))
        features = run_features(r.text, words, r.lines, slice(r.at, r.at + len(r.tags)))
        pieces.append(([[place.setdefault(f, len(place)) for f in fs] for fs in features], list(r.tags)))
    counts = Counter(f for rows, _ in pieces for fs in rows for f in fs)
    field = Field(sorted(f for f, i in place.items() if counts[i] >= 2))
    now = {i: field.place[f] for f, i in place.items() if f in field.place}
    field.learn([([[now[f] for f in fs if f in now] for fs in rows], tags) for rows, tags in pieces])
    return field


def _smallest(found: DataFrame, most: int) -> list:
    """The ``most`` rows of the smallest draws. Draws are counted by grade first, so that few others come near the driver."""
    grade = F.floor(F.log2(F.col("draw") + 1.0) * 8).cast("int")
    upto = total = 0
    for upto, n in found.groupBy(grade.alias("grade")).count().orderBy("grade").collect():  # 504 grades at most
        total += n
        if total >= most:
            break
    return found.where(grade <= upto).orderBy("draw").limit(most).collect()


def _free(found: list[tuple[int, int, int]], base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """The spans that overlap no base span."""
    starts, furthest = [s[0] for s in base], []
    for s in base:
        furthest.append(max(s[2], furthest[-1] if furthest else 0))
    free = lambda s: not (n := bisect_left(starts, s[2])) or furthest[n - 1] <= s[0]
    return [s for s in found if free(s)]


def added_spans(text: str, field: Field | None, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Spans the field finds beside the base ones."""
    return [] if field is None else _free(Lines(field).spans([text])[0], base)


def _joined(spans) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def scan(docs: DataFrame, field: Field | None, id_col="doc_id", text_col="text") -> DataFrame:
    """doc_id, counts of the base kinds, base_spans and spans of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lines = None if field is None else Lines(field)
        for batch in batches:
            rows = []
            for _, texts in _parts([t or "" for t in batch.column(1).to_pylist()]):
                added = [[] for _ in texts] if lines is None else lines.spans(texts)
                for text, found in zip(texts, added):
                    base = base_spans(text)
                    kinds = [k for _, k, _ in base]
                    every = sorted(base + _free(found, base))
                    rows.append((kinds.count(0), kinds.count(1), kinds.count(2), _joined(base), _joined(every)))
            columns = list(zip(*rows)) or [()] * 5
            types = [pa.int64()] * 3 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, t) for c, t in zip(columns, types)]],
                ["doc_id", "n_assign", "n_access", "n_hex", "base_spans", "spans"],
            )

    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(
        run, "doc_id long, n_assign long, n_access long, n_hex long, base_spans string, spans string"
    )
