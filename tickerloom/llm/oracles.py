"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from tickerloom.llm.license_scan import PHRASES, TEMPLATES, THRESHOLD, needed, template_tokens
from tickerloom.llm.mixing import BITS, CLOSING, MOST_COPIES, SLICES, WEIGHTS

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

SUBSTRING_DEDUP = rf"""
WITH d AS (SELECT doc_id, {WORDS} AS w FROM documents),
s AS (SELECT doc_id, w, unnest(generate_series(1, len(w) - 19)) AS a FROM d),
r AS (
  SELECT doc_id, a,
    row_number() OVER (PARTITION BY array_to_string(w[a:a+19], ' ') ORDER BY doc_id, a) AS n
  FROM s),
gone AS (SELECT DISTINCT doc_id, unnest(generate_series(a, a + 19)) AS i FROM r WHERE n > 1),
each AS (SELECT doc_id, unnest(w) AS word, unnest(generate_series(1, len(w))) AS i FROM d),
kept AS (
  SELECT e.doc_id, count(g.i) AS n_removed,
    string_agg(CASE WHEN g.i IS NULL THEN e.word END, ' ' ORDER BY e.i) AS kept
  FROM each e LEFT JOIN gone g ON g.doc_id = e.doc_id AND g.i = e.i GROUP BY e.doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(k.n_removed, 0)::BIGINT AS n_removed,
  sha256(coalesce(k.kept, '')) AS kept_sha256
FROM d LEFT JOIN kept k USING (doc_id)
"""


def _scan_words(text: str) -> str:
    low = f"translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return rf"regexp_extract_all({low}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


def _license_scan() -> str:
    at = {}
    for label, phrase in PHRASES.items():
        hit = " AND ".join(f"w[i + {k}] = '{t}'" for k, t in enumerate(phrase))
        at[label] = f"[i - 1 for i in generate_series(1, len(w)) if {hit}]"
    starts = "list_sort(" + " || ".join(f"({x})" for x in at.values()) + ")"
    labels = ", ".join(f"CASE WHEN len({x}) > 0 THEN '{k}' END" for k, x in at.items())
    base = f"[x for x in [{labels}] if x IS NOT NULL]"
    rows = ", ".join(
        f"('{label}', {tokens!r}, {needed(len(tokens), THRESHOLD)})"
        for label, tokens in template_tokens(TEMPLATES).items()
    )
    return rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
b AS (SELECT doc_id, {_scan_words("t")} AS w FROM d),
base AS (SELECT doc_id, len(w) AS n_words, {starts} AS starts, {base} AS base FROM b),
templates(label, tokens, need) AS (VALUES {rows}),
lines AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d),
blocks AS (SELECT doc_id, list_distinct({_scan_words("line")}) AS block FROM lines),
found AS (
  SELECT doc_id, label, len(list_intersect(block, tokens)) / len(tokens) AS share
  FROM blocks, templates WHERE len(list_intersect(block, tokens)) >= need),
best AS (SELECT doc_id, list(DISTINCT label) AS labels, max(share) AS share FROM found GROUP BY doc_id)
SELECT doc_id, n_words::BIGINT AS n_words, len(starts)::BIGINT AS n_base,
  starts[1]::BIGINT AS first_word, starts[len(starts)]::BIGINT AS last_word,
  array_to_string(list_sort(base), ',') AS base_labels,
  array_to_string(list_sort(list_distinct(base || coalesce(labels, []))), ',') AS labels,
  CASE WHEN len(base) > 0 THEN 1.0::DOUBLE ELSE coalesce(share, 0)::DOUBLE END AS score
FROM base LEFT JOIN best USING (doc_id)
"""


QUALITY = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, {WORDS} AS w FROM documents),
l AS (
  SELECT doc_id, t, w,
    [x for x in string_split(t, chr(10)) if regexp_matches(x, '[^\x20\x09-\x0D]')] AS lines
  FROM d),
s AS (SELECT doc_id, unnest(generate_series(1, len(w) - 2)) AS a, w FROM d),
r AS (SELECT doc_id, a, count(*) OVER (PARTITION BY doc_id, w[a], w[a + 1], w[a + 2]) AS n FROM s),
p AS (SELECT DISTINCT doc_id, unnest(generate_series(a, a + 2)) AS i FROM r WHERE n > 1),
q AS (SELECT doc_id, count(*) AS n FROM p GROUP BY doc_id),
c AS (
  SELECT l.doc_id, t AS text, len(w) AS n_words,
    length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
    length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
    len(lines) - len(list_distinct(lines)) AS n_dup_lines,
    coalesce(q.n, 0) AS n_repeat_words, len(lines) AS n_lines
  FROM l LEFT JOIN q USING (doc_id)),
f AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM c)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
  n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed,
  NOT (base_failed
    OR 100 * n_symbols > 30 * n_words
    OR 100 * length(regexp_replace(text, '[^\p{{Lu}}]+', '', 'g')) > 50 * word_chars
    OR 100 * n_dup_lines > 50 * n_lines
    OR word_chars > 25 * n_words
    OR word_chars < 2 * n_words
    OR 100 * length(regexp_replace(text, '[^\p{{L}}]+', '', 'g')) < 40 * word_chars) AS kept
FROM f
"""


def _mixing(seed: int = 42) -> str:
    cycle = "[" + ", ".join(f"{w}.0" for w in WEIGHTS) + "]"
    closing = []
    for turn in range(CLOSING):
        fits = "" if turn == CLOSING - 1 else "AND r.size <= g.gap"
        closing.append(f"""
best{turn} AS (
  SELECT g.source, min((abs(r.size - g.gap), r.draw, r.size)) AS b
  FROM rows r JOIN gap{turn} g ON r.source IS NOT DISTINCT FROM g.source
  WHERE g.open AND g.gap > 0 AND abs(r.size - g.gap) < g.gap {fits} AND r.draw > g.last
    AND NOT list_contains(g.closing, r.draw)
  GROUP BY g.source),
gap{turn + 1} AS (
  SELECT g.* EXCLUDE (gap, closing), g.gap - coalesce(b.b[3], 0) AS gap,
    CASE WHEN b.b IS NULL THEN g.closing ELSE list_append(g.closing, b.b[2]) END AS closing
  FROM gap{turn} g LEFT JOIN best{turn} b ON b.source IS NOT DISTINCT FROM g.source)""")
    closing = ",".join(closing)
    return rf"""
WITH sized AS (
  SELECT doc_id, source, len({WORDS})::BIGINT AS size,
    ('0x' || substr(md5('{seed}:' || coalesce('i' || doc_id, '') || ':' || md5(coalesce(text, '')) || ':' || coalesce('s' || source, '')), 1, {BITS // 4}))::BIGINT AS first
  FROM documents),
drawn AS (SELECT *, row_number() OVER (PARTITION BY first) - 1 AS nth FROM sized),
plain AS (
  SELECT doc_id, source, size,
    CASE WHEN nth = 0 THEN first ELSE ('0x' || substr(md5(first || ':' || nth), 1, {BITS // 4}))::BIGINT END AS u
  FROM drawn),
sources AS (SELECT source, sum(size)::BIGINT AS source_size FROM plain GROUP BY source),
weighed AS (
  SELECT *, source_size * {MOST_COPIES}.0::DOUBLE AS ceiling,
    ({cycle}[(row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(WEIGHTS)} + 1])::DOUBLE AS weight
  FROM sources),
placed AS (
  SELECT *, row_number() OVER (ORDER BY ceiling / weight, source NULLS LAST) AS place,
    (sum(source_size) OVER ()
      - coalesce(sum(ceiling) OVER (ORDER BY ceiling / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / (sum(weight) OVER ()
      - coalesce(sum(weight) OVER (ORDER BY ceiling / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS rate
  FROM weighed),
free AS (SELECT min_by(rate, place) AS rate, min(place) AS place FROM placed WHERE weight * rate <= ceiling),
goals AS (
  SELECT p.source, p.source_size,
    CASE WHEN p.place < f.place THEN ceiling ELSE least(ceiling, weight * f.rate) END AS target
  FROM placed p, free f),
parts AS (
  SELECT *, floor(coalesce(target / nullif(source_size, 0), 0))::BIGINT AS whole,
    target - floor(coalesce(target / nullif(source_size, 0), 0)) * source_size AS budget
  FROM goals),
sizes AS (SELECT source, size, count(*) AS n FROM plain WHERE size > 0 GROUP BY source, size),
larger AS (
  SELECT a.source, a.size,
    (SELECT coalesce(sum(b.n * b.size), 0) FROM sizes b WHERE b.source IS NOT DISTINCT FROM a.source AND b.size > a.size)::DOUBLE AS certain,
    (SELECT sum(b.n * b.size * b.size) FROM sizes b WHERE b.source IS NOT DISTINCT FROM a.source AND b.size <= a.size)::DOUBLE AS squares
  FROM sizes a),
slopes AS (
  SELECT p.source, max_by((budget - certain) / squares, l.size) AS slope
  FROM parts p JOIN larger l ON l.source IS NOT DISTINCT FROM p.source
  WHERE budget >= certain AND (budget - certain) / squares * l.size::DOUBLE <= 1 GROUP BY p.source),
chances AS (
  SELECT p.*, least(1.0::DOUBLE, coalesce(slope, 0) * p.size::DOUBLE) AS chance, (p.u::DOUBLE + 0.5) / (1::BIGINT << {BITS})::DOUBLE AS v
  FROM plain p LEFT JOIN slopes s ON s.source IS NOT DISTINCT FROM p.source),
rows AS (
  SELECT doc_id, source, size,
    floor(v * (1 - chance) / (v * (1 - chance) + (1 - v) * chance) * (1::BIGINT << {BITS})::DOUBLE)::BIGINT AS draw
  FROM chances),
upto AS (
  SELECT source, draw, sum(size) OVER (PARTITION BY source ORDER BY draw) AS words FROM rows),
lasts AS (
  SELECT p.source, max(u.draw) AS last, max(u.words) AS words
  FROM parts p JOIN upto u ON u.source IS NOT DISTINCT FROM p.source
  WHERE u.words <= p.budget GROUP BY p.source),
over AS (
  SELECT p.source, min(u.draw) >> {BITS - SLICES} AS slice
  FROM parts p JOIN upto u ON u.source IS NOT DISTINCT FROM p.source
  WHERE u.words > p.budget GROUP BY p.source),
gap0 AS (
  SELECT p.*,
    CASE WHEN budget <= 0 THEN -1
      ELSE greatest(coalesce(l.last, -1), coalesce((o.slice << {BITS - SLICES}) - 1, (1::BIGINT << {BITS}) - 1)) END AS last,
    budget - coalesce(l.words, 0) AS gap, o.slice IS NOT NULL AS open, []::BIGINT[] AS closing
  FROM parts p LEFT JOIN lasts l ON l.source IS NOT DISTINCT FROM p.source
    LEFT JOIN over o ON o.source IS NOT DISTINCT FROM p.source),{closing}
SELECT r.doc_id, r.size, g.source_size, g.target,
  r.size * (g.whole + (r.draw <= g.last OR list_contains(g.closing, r.draw))::BIGINT) AS taken
FROM rows r JOIN gap{CLOSING} g ON r.source IS NOT DISTINCT FROM g.source
"""


COLLOCATIONS = r"""
WITH d AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
p AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM d),
totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM p GROUP BY lang),
places AS (SELECT lang, w, unnest(generate_series(1, len(w))) AS i FROM p),
counted AS (
  SELECT lang, w[i : i + k - 1] AS g, count(*) AS f
  FROM places, (VALUES (1), (2), (3), (4)) AS lengths(k) WHERE i + k - 1 <= len(w)
  GROUP BY 1, 2 HAVING count(*) >= 30),
cuts AS (
  SELECT lang, g, f AS a, unnest(generate_series(1, len(g) - 1)) AS k FROM counted WHERE len(g) > 1),
scored AS (
  SELECT c.lang, c.g, c.a, c.k, l.f AS l, r.f AS r, (2000000::HUGEINT * c.a) // (l.f::HUGEINT + r.f) AS score
  FROM cuts c JOIN counted l ON l.lang = c.lang AND l.g = c.g[1 : c.k]
    JOIN counted r ON r.lang = c.lang AND r.g = c.g[c.k + 1 : len(c.g)]),
weakest AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1),
inner_parts AS (
  SELECT lang, f, g, unnest(generate_series(1, len(g) - 1)) AS i FROM counted WHERE len(g) > 2),
parts AS (
  SELECT lang, f, g[i : i + m - 1] AS g
  FROM inner_parts, (VALUES (2), (3)) AS lengths(m) WHERE m < len(g) AND i + m - 1 <= len(g)),
around AS (SELECT lang, g, max(f) AS longer FROM parts GROUP BY lang, g),
kept AS (
  SELECT w.lang, array_to_string(w.g, ' ') AS phrase, a, l, r, score
  FROM weakest w LEFT JOIN around o ON o.lang = w.lang AND o.g = w.g
  WHERE o.longer IS NULL OR 100::HUGEINT * o.longer < 80::HUGEINT * w.a),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM kept)
SELECT r.lang, rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n, score::BIGINT AS score
FROM ranked r JOIN totals USING (lang) WHERE rank <= 2000
"""


def _conversations() -> str:
    line = "role || ':' || text"
    more = "CASE WHEN cut THEN 3 ELSE 0 END"

    def way(after: str, cost: str, letter: str, line: str = "") -> str:
        lines = f"list_prepend({line}, {after}.t)" if line else f"{after}.t"
        return f"{{'c': {after}.c + {cost}, 'a': '{letter}' || {after}.a, 't': {lines}}}"

    def least(*ways: str) -> str:
        return f"list_min([{', '.join(ways)}])"

    def insert(after: str, role: str) -> str:
        return way(after, "3", "I", f"'{role}:'")

    def row(state: int, after: int) -> str:
        """The best way from a state through a row; ``after`` is where the next turn leads."""
        role = "assistant" if state == 2 else "user"
        ways = [
            way(f"e{state}", "4", "D"),
            f"CASE WHEN NOT gone THEN {way(f'e{after}', more + ' + 3', 'R', f"'{role}:' || text")} END",
            f"CASE WHEN NOT gone AND role[1] = '{role[0]}' THEN {way(f'e{after}', more, 'K', line)} END",
        ]
        if state == 0:
            ways.append(f"CASE WHEN NOT gone AND role[1] = 's' THEN {way('e1', more, 'K', line)} END")
        return least(*ways)

    return rf"""
WITH RECURSIVE keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    [ascii(x) for x in string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), '')] AS bytes
  FROM conversations),
dealt AS (
  SELECT *, xor(list_reduce(list_prepend(4294967295::UBIGINT, bytes::UBIGINT[]), lambda c, b:
    list_reduce(list_prepend(xor(c, b), [0, 1, 2, 3, 4, 5, 6, 7]::UBIGINT[]), lambda v, i:
      CASE WHEN v % 2 = 1 THEN xor(v >> 1, 3988292384::UBIGINT) ELSE v >> 1 END)), 4294967295::UBIGINT) % 20 AS kind
  FROM keyed),
rows AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
    unnest(CASE WHEN kind = 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM dealt WHERE kind <> 0),
placed AS (
  SELECT *, row_number() OVER w AS i, lag(role[1]) OVER w AS before,
    rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS trimmed,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) > 1 AS again
  FROM rows WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy)),
judged AS (
  SELECT *, trimmed = '' AS blank, trimmed <> '' AND again AS duplicate,
    trimmed <> '' AND NOT again AND trimmed[-1] NOT IN ('.', '!', '?') AS cut,
    trimmed = '' OR again AS gone
  FROM placed),
counted AS (
  SELECT conv_id, count(*) AS n,
    coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps,
    count_if(blank)::BIGINT AS blank, count_if(duplicate)::BIGINT AS duplicate, count_if(cut)::BIGINT AS truncated,
    count_if(i > 1 AND before || role[1] NOT IN ('su', 'ua', 'au'))::BIGINT AS illegal
  FROM judged GROUP BY conv_id),
ways(conv_id, i, e0, e1, e2, e3) AS (
  SELECT conv_id, n + 1, {{'c': 0, 'a': '', 't': []::VARCHAR[]}}, {{'c': 6, 'a': 'II', 't': ['user:', 'assistant:']}},
    {{'c': 3, 'a': 'I', 't': ['assistant:']}}, {{'c': 0, 'a': '', 't': []::VARCHAR[]}}
  FROM counted
  UNION ALL
  SELECT conv_id, i, {least('f0', insert('g2', 'user'))}, {least('f1', insert('g2', 'user'))}, g2, {least('f3', insert('g2', 'user'))}
  FROM (
    SELECT *, {least('f2', insert('f3', 'assistant'))} AS g2
    FROM (
      SELECT w.conv_id, j.i, {row(0, 2)} AS f0, {row(1, 2)} AS f1, {row(2, 3)} AS f2, {row(3, 2)} AS f3
      FROM ways w JOIN judged j ON j.conv_id IS NOT DISTINCT FROM w.conv_id AND j.i = w.i - 1))),
ids AS (SELECT DISTINCT conv_id FROM conversations)
SELECT s.conv_id, coalesce(c.gaps, 0) AS gaps, coalesce(c.blank, 0) AS blank, coalesce(c.duplicate, 0) AS duplicate,
  coalesce(c.truncated, 0) AS truncated, coalesce(c.illegal, 0) AS illegal, coalesce(w.e0.c, 0)::BIGINT AS cost,
  coalesce(w.e0.a, '') AS audit, sha256(coalesce(array_to_string(w.e0.t, chr(10)), '')) AS repaired_sha256
FROM ids s LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM s.conv_id
  LEFT JOIN ways w ON w.conv_id IS NOT DISTINCT FROM s.conv_id AND w.i = 1
"""


ORACLES = {
    "op1_substring_dedup": SUBSTRING_DEDUP,
    "op5_license_scans": _license_scan(),
    "op8_quality_rules": QUALITY,
    "op9_mixing": _mixing(),
    "op11_collocations": COLLOCATIONS,
    "op13_conversation_repair": _conversations(),
}
