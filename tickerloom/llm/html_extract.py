"""Main text of web pages: page structure, and differencing against the page with the nearest URL.

A page is cut into lines, one per block. Lines in menus, headers, footers, sidebars, notices,
adverts, forms and comments are left out by their elements and by class, id and role; an article or main element and what
holds it are never left out by class, id or role. Pages of a host are ordered by path; each is aligned by longest
common subsequence with the neighbour whose path shares more with its own, and lines outside an article (or
main) element that both have are deleted. All other lines are text.

Lines inside an article element are never deleted: on pages whose articles repeat passages or copy each other,
shared lines are text. Pages of a host with the same lines are aligned once, and none with another of them. A neighbour
with nearly the same lines (``COPY_REST``) is a copy and says nothing of the host's template; the other neighbour is taken then.

Edge cases: a null or empty page gives an empty text; a null or unparsable URL has an empty host and path;
pages equal in id and html are one page; broken and cut-off markup is read as far as
it goes; an empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from os.path import commonprefix

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerloom.llm.text import bounded_batches, kept_table, row_key

# Elements by what they mean for a reader.
RAW = frozenset("script style template textarea title iframe svg select".split())
CHROME = frozenset("nav header footer aside form head button menu dialog fieldset".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset"
    " figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol p"
    " pre section summary table tbody td tfoot th thead tr ul".split()
)
SELF_CLOSING = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
HINTS = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments"
    " commentlist consent cookie cookies disqus footer header masthead menu modal nav navbar navigation"
    " newsletter notice overlay pagination popup promo promoted related respond share sharing sidebar"
    " signup social sponsor sponsored subscribe toolbar widget".split()
)
# Words that may stand beside a hint in a class of several words: "site-footer", "sidebar-left".
BESIDE = frozenset("area bar block bottom box container content item left link links list main page right section site top wrap wrapper".split())
HOLDERS = frozenset("form fieldset".split())  # hold whole pages on some sites
ROLES = frozenset("alert banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+>?|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)((?:[^>\"']|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)([^>]*+)(?:>|\Z)",
    re.S,
)
ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
HOST = "^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)"
PATH = "^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)"
COPY_REST = 0.1  # of either page's different lines are its own, at most: then the pages are copies


def _is_hint(name: str) -> bool:
    """A whole class or id, or one of several words that are all hints or stand beside one."""
    parts = set(re.split("[_-]+", name)) - {""}
    return bool(parts & HINTS) and parts <= HINTS | BESIDE


def _kind(tag: str, attributes: str) -> tuple[bool, bool, bool]:
    """Whether an element is outside the main text by its name, by its attributes, and whether it holds the main text."""
    core = tag in ("article", "main")
    if not attributes or attributes.isspace():
        return tag in CHROME, False, core
    found = {k.lower(): v.strip("\"'").lower() for k, v in ATTRIBUTE.findall(attributes)}
    hidden = "hidden" in found or found.get("aria-hidden") == "true" or "display:none" in found.get("style", "").replace(" ", "")
    core = core or found.get("role") == "main" or found.get("itemprop") == "articlebody"
    names = found.get("class", "").split() + [found.get("id", "").strip()]
    hinted = tag not in ("html", "body") and (found.get("role") in ROLES or any(map(_is_hint, names)))
    return tag in CHROME or hidden, hinted, core


def page_lines(page: str) -> list[tuple[str, bool]]:
    """Lines of a page outside its chrome, each with whether an article or main element holds it."""
    elements = [(0, "", False, False, False)]  # parent, name, chrome by name, by attributes, core; the first holds the page
    holds = [False]  # whether a core element is inside
    found: list[list[tuple[int, str]]] = []  # lines as texts of elements
    parts: list[tuple[int, str]] = []
    stack = [0]  # open elements

    def flush():
        if parts:
            found.append(parts.copy())
            parts.clear()

    def pop_to(place: int):
        while len(stack) > place:
            if elements[stack.pop()][1] in BLOCK:
                flush()

    at, end = 0, len(page)
    while at < end:
        m = TOKEN.search(page, at)
        stop = m.start() if m else end
        if stop > at:
            parts.append((stack[-1], entities.unescape(page[at:stop])))
        if not m:
            break
        at = m.end()
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            continue
        if m[1] or m[4]:
            place = next((i for i in range(len(stack) - 1, 0, -1) if elements[stack[i]][1] == tag), None)
            if place is not None:
                pop_to(place)
            elif tag in BLOCK:
                flush()
            continue
        attributes = m[3] if m[2] else m[6]
        if tag in RAW:
            closing = re.compile(f"</{tag}[^>]*>", re.I).search(page, at)
            at = closing.end() if closing else end
            continue
        if tag == "body":
            pop_to(next((i for i, x in enumerate(stack) if elements[x][1] == "head"), len(stack)))
        if tag in BLOCK:
            for i in range(len(stack) - 1, 0, -1):
                name = elements[stack[i]][1]
                if name == "p" or name in SELF_CLOSING.get(tag, ()):
                    pop_to(i)
                    break
                if name in BLOCK:
                    break
            flush()
        elif tag == "br":
            parts.append((stack[-1], " "))
        if tag in VOID or attributes.rstrip().endswith("/"):
            continue
        named, hinted, core = _kind(tag, attributes)
        if core:
            for e in stack:
                holds[e] = True
        elements.append((stack[-1], tag, named, hinted, core))
        holds.append(core)
        stack.append(len(elements) - 1)
    flush()

    chrome, inside = [False], [False]
    for (parent, tag, named, hinted, core), held in zip(elements[1:], holds[1:]):
        own = named and not (held and tag in HOLDERS) or hinted and not held
        if tag == "header" and inside[parent] and not hinted:
            own = False  # an article's own header holds its title
        chrome.append(chrome[parent] or own)
        inside.append(inside[parent] or core)
    lines = []
    for line in found:
        text = " ".join("".join(t for e, t in line if not chrome[e]).split())
        if text:
            lines.append((text, any(inside[e] for e, t in line if not chrome[e] and t.strip())))
    return lines


def common_places(a: list[int], b: list[int]) -> list[int]:
    """Places in ``a`` of a longest common subsequence with ``b``.

    Equal ends are taken off; the rest is aligned bit-parallel, halving ``a`` where it is long, so memory stays linear.
    """
    head = 0
    while head < min(len(a), len(b)) and a[head] == b[head]:
        head += 1
    tail = 0
    while tail < min(len(a), len(b)) - head and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    places = list(range(head)) + list(range(len(a) - tail, len(a)))
    x, y = a[head : len(a) - tail], b[head : len(b) - tail]
    held = set(y)
    kept = [i for i, v in enumerate(x) if v in held]
    return sorted(places + [head + kept[i] for i in _aligned([x[i] for i in kept], y)])


def _lengths(a: list[int], b: list[int]) -> np.ndarray:
    """Lengths of the longest common subsequence of ``a`` and each prefix of ``b``."""
    masks: dict[int, int] = {}
    for j, v in enumerate(b):
        masks[v] = masks.get(v, 0) | 1 << j
    full = (1 << len(b)) - 1
    row = full
    for v in a:
        u = row & masks.get(v, 0)
        row = ((row + u) | (row - u)) & full
    bits = np.unpackbits(np.frombuffer(row.to_bytes(len(b) // 8 + 1, "little"), np.uint8), bitorder="little")[: len(b)]
    return np.concatenate([[0], np.cumsum(1 - bits.astype(np.int64))])


def _aligned(a: list[int], b: list[int]) -> list[int]:
    if not a or not b:
        return []
    if len(a) == 1:
        return [0] if a[0] in b else []
    half = len(a) // 2
    front = _lengths(a[:half], b)
    rear = _lengths(a[half:][::-1], b[::-1])[::-1]
    cut = int((front + rear).argmax())
    return _aligned(a[:half], b[:cut]) + [half + i for i in _aligned(a[half:], b[cut:])]


def _to_delete(row, before, after) -> list[int]:
    """Numbers of the row's lines outside an article that the nearest page has too.

    Of two neighbours in URL order that is the one that shares more of the row's path, the earlier of equals, unless it is a copy.
    """
    if all(row["core"]):
        return []
    shared = lambda other: len(commonprefix([row["path"], other["path"]]))
    near = [x for x in (before, after) if x is not None and x["host"] == row["host"]]
    for other in sorted(near, key=shared, reverse=True):
        same = common_places(row["lines"], other["lines"])
        if not _copies(row, other):
            return [i for i in same if not row["core"][i]]
    return []


def _copies(a, b) -> bool:
    """Whether one of two pages has next to no line of its own, whatever the lines' lengths."""
    x, y = set(a["lines"]), set(b["lines"])
    return any(len(one - other) <= COPY_REST * len(one) for one, other in ((x, y), (y, x)))


PAGE = "host string, path string, _id long, _hash long, _outline long, lines array<long>, sizes array<int>, core array<boolean>"
FOUND = f"{PAGE}, role string, dead array<int>"


def outlines(pages: DataFrame, id_col="page_id", url_col="url", html_col="html") -> DataFrame:
    """Host, path, key and hashed lines of every page."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [page_lines(p or "") for p in batch.column(4).to_pylist()]
            signed = lambda t: xxhash.xxh64_intdigest(t.encode("utf-8", "surrogatepass")) - (1 << 63)
            whole = [signed("\n".join(f"{core:d}{t}" for t, core in x)) for x in found]
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:4],
                    pa.array(whole, pa.int64()),
                    pa.array([[signed(t) for t, _ in x] for x in found], pa.list_(pa.int64())),
                    pa.array([[len(t) for t, _ in x] for x in found], pa.list_(pa.int32())),
                    pa.array([[c for _, c in x] for x in found], pa.list_(pa.bool_())),
                ],
                [n.split()[0] for n in PAGE.split(", ")],
            )

    url = F.coalesce(F.col(url_col), F.lit(""))
    rows = pages.select(
        F.regexp_extract(url, HOST, 1).alias("host"), F.regexp_extract(url, PATH, 1).alias("path"),
        *row_key(id_col, html_col), F.col(html_col).alias("html"),
    )
    return rows.mapInArrow(run, PAGE)


def _table(rows) -> pa.RecordBatch:
    schema = pa.schema(
        [("host", pa.string()), ("path", pa.string()), ("_id", pa.int64()), ("_hash", pa.int64()),
         ("_outline", pa.int64()), ("lines", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int32())), ("core", pa.list_(pa.bool_())),
         ("role", pa.string()), ("dead", pa.list_(pa.int32()))]
    )
    return pa.RecordBatch.from_pylist(rows, schema)


def _settled(row, before, after) -> list[dict]:
    dead = _to_delete(row, before, after)
    return [{"host": row["host"], "_outline": row["_outline"], "role": "settled", "dead": dead}] if dead else []


def shared_lines(outline: DataFrame) -> DataFrame:
    """(_id, _hash, dead): numbers of the lines to delete, for pages that have any.

    Of pages of a host with the same lines the one with the first path is aligned. Pages are sorted by URL over all tasks, so a host of any size is spread. The first and the last
    page of each task (open) meet again, with their neighbours in the task, to be paired across tasks.
    """

    def inner(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head: list[dict] = []
        tail: list[dict] = []
        count = 0
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                head = head if len(head) == 2 else [*head, row]
                tail = [*tail[-2:], row]
                count += 1
                if count > 2:
                    out += _settled(tail[1], tail[0], tail[2])
            yield _table(out)
        ends = dict(zip(range(2), head)) | dict(zip(range(max(0, count - 2), count), tail[-2:]))
        yield _table([r | {"role": "open" if i in (0, count - 1) else "near"} for i, r in ends.items()])

    def across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = row = None
        for batch in batches:
            out = []
            for after in batch.to_pylist():
                if row and row["role"] == "open":
                    out += _settled(row, before, after)
                before, row = row, after
            yield _table(out)
        yield _table(_settled(row, before, None) if row and row["role"] == "open" else [])

    order = ["host", "path", "_outline"]
    rest = F.struct("lines", "sizes", "core")
    distinct = (
        outline.where(F.size("lines") > 0).groupBy("host", "_outline")
        .agg(F.min("path").alias("path"), F.first(rest).alias("rest"))
        .select("host", "path", F.lit(0).cast("long").alias("_id"), F.lit(0).cast("long").alias("_hash"), "_outline", "rest.*")
    )
    found = distinct.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(inner, FOUND)
    found = kept_table(found, "page-neighbours")
    ends = found.where("role <> 'settled'").coalesce(1).sortWithinPartitions(*order)  # four pages a task
    settled = found.where("role = 'settled'").union(ends.mapInArrow(across, FOUND)).select("host", "_outline", "dead")
    pages = outline.select("host", "_outline", "_id", "_hash").dropDuplicates(["_id", "_hash"])
    return pages.join(settled, ["host", "_outline"]).select("_id", "_hash", "dead")


def extract(pages: DataFrame, id_col="page_id", url_col="url", html_col="html") -> DataFrame:
    """page_id, url, text and n_chars of every page."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for page, dead in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                lines, gone = page_lines(page or ""), set(dead or ())
                texts.append("\n".join(t for i, (t, _) in enumerate(lines) if i not in gone))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    bounded_batches(pages.sparkSession)
    outline = kept_table(outlines(pages, id_col, url_col, html_col), "page-outlines")
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"),
        *row_key(id_col, html_col),
    )
    return (
        rows.join(shared_lines(outline), ["_id", "_hash"], "left")
        .select("page_id", "url", "html", "dead")
        .mapInArrow(run, "page_id long, url string, text string, n_chars long")
    )
