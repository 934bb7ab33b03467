"""The results of the corpus queries in SQL, where SQL can express them."""

from __future__ import annotations

from starloom.llm import licenses, rules

_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_LOWERED = f"translate(coalesce(text, ''), '{_CAPITALS}', '{_CAPITALS.lower()}')"
_WORD = r"'[^ \t\n\x0B\f\r]+'"
_ALNUM_WORD = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _decontamination() -> str:
    return f"""
WITH d AS (SELECT doc_id, regexp_extract_all({_LOWERED}, {_ALNUM_WORD}) AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all({_LOWERED}, {_ALNUM_WORD}) AS w FROM benchmark WHERE item_id IS NOT NULL),
bw AS (
    SELECT DISTINCT item_id, least(len(w), 13) AS size, array_to_string(w[i : i + least(len(w), 13) - 1], ' ') AS span
    FROM b, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS t(i) WHERE len(w) > 0
),
sizes AS (SELECT DISTINCT size FROM bw),
dw AS (
    SELECT doc_id, size, i, array_to_string(w[i : i + size - 1], ' ') AS span
    FROM d, sizes, unnest(range(1, len(w) - size + 2)) AS t(i)
),
hits AS (SELECT DISTINCT doc_id, size, i, item_id FROM dw JOIN bw USING (size, span)),
covered AS (SELECT doc_id, count(DISTINCT i + j) AS n_hit FROM hits, unnest(range(0, size)) AS t(j) GROUP BY doc_id),
items AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
    sha256(coalesce(listed, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)
"""


def _near_dedup() -> str:
    return f"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_LOWERED}, {_WORD}) AS w FROM documents),
s AS (
    SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS shingle
    FROM d, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS t(i) WHERE len(w) > 0
),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y USING (shingle) WHERE x.doc_id <> y.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
reach(doc_id, other) AS (
    SELECT doc_id, doc_id FROM n
    UNION
    SELECT reach.doc_id, links.b FROM reach JOIN links ON links.a = reach.other
),
least_id AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, coalesce(component_id, doc_id) AS component_id, coalesce(component_id, doc_id) = doc_id AS kept
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN least_id USING (doc_id)
"""


def _substring_dedup() -> str:
    return f"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), {_WORD}) AS w FROM documents),
wins AS (SELECT doc_id, i, array_to_string(w[i : i + 12], ' ') AS span FROM d, unnest(range(1, len(w) - 11)) AS t(i)),
firsts AS (SELECT span, min(doc_id) AS first_id FROM wins GROUP BY span),
gone AS (SELECT DISTINCT doc_id, i + j AS pos FROM wins JOIN firsts USING (span), unnest(range(0, 13)) AS t(j) WHERE doc_id > first_id),
each_word AS (SELECT doc_id, i AS pos, w[i] AS word FROM d, unnest(range(1, len(w) + 1)) AS t(i)),
kept AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY pos) AS kept_text FROM each_word ANTI JOIN gone USING (doc_id, pos) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept_text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""


def _quality_rules() -> str:
    measures = {
        "symbols_per_word": ("n_symbols", "n_words"), "capitals_share": ("n_capitals", "word_chars"), "marks_per_word": ("n_marks", "n_words"),
        "repeated_words_share": ("n_repeat_words", "n_words"), "repeated_lines_share": ("n_dup_lines", "n_lines"), "doubled_words_share": ("n_doubled", "n_words"),
    }
    rate = rules.ALPHA
    grid = ", ".join(f"({i}, '{rule}', {cut}::DOUBLE)" for i, (rule, cut) in enumerate(rules.PATH))
    long_rows = " UNION ALL ".join(f"SELECT row_id, '{rule}' AS rule, CASE WHEN {b} > 0 THEN {a}::DOUBLE / {b} ELSE 0 END AS value FROM m" for rule, (a, b) in measures.items())
    return f"""
WITH t AS (SELECT row_number() OVER () AS row_id, doc_id, coalesce(lang, '') AS stratum, coalesce(text, '') AS x FROM documents),
w AS (SELECT *, regexp_extract_all(x, {_WORD}) AS w, [l FOR l IN string_split(x, chr(10)) IF regexp_matches(l, {_WORD})] AS lines FROM t),
g AS (SELECT row_id, i, array_to_string(w[i : i + 2], ' ') AS span FROM w, unnest(range(1, len(w) - 1)) AS u(i)),
twice AS (SELECT row_id, span FROM g GROUP BY ALL HAVING count(*) > 1),
rep AS (SELECT row_id, count(DISTINCT i + j) AS n_repeat_words FROM g JOIN twice USING (row_id, span), unnest(range(0, 3)) AS u(j) GROUP BY row_id),
m AS (
    SELECT row_id, doc_id, stratum, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars, length(x) - length(translate(x, '#*$%&|<>', '')) AS n_symbols,
        len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words, len(lines) AS n_lines,
        length(x) - length(translate(x, '{_CAPITALS}', '')) AS n_capitals, length(x) - length(replace(x, '!', '')) AS n_marks,
        len([i FOR i IN range(1, len(w)) IF w[i] = w[i + 1]]) AS n_doubled
    FROM w LEFT JOIN rep USING (row_id)
),
base AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m),
v AS ({long_rows}),
good AS (SELECT doc_id FROM labels WHERE quality IS NOT NULL GROUP BY doc_id HAVING min(quality) = 1),
held AS (SELECT row_id, stratum FROM base WHERE NOT base_failed AND doc_id IN (SELECT doc_id FROM good)),
grid(step, rule, cut) AS (VALUES {grid}),
strata AS (SELECT count(DISTINCT stratum) AS strata FROM held),
firsts AS (SELECT row_id, stratum, min(step) AS first_step FROM held JOIN v USING (row_id) JOIN grid USING (rule) WHERE value > cut GROUP BY ALL),
sizes AS (SELECT stratum, count(*) AS n FROM held GROUP BY stratum),
counts AS (SELECT stratum, step, any_value(n) AS n, count(first_step) FILTER (first_step <= step) AS k FROM sizes CROSS JOIN grid LEFT JOIN firsts USING (stratum) GROUP BY ALL),
tails AS (
    SELECT *, CASE WHEN k < n * {rate!r}
        THEN list_sum([exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln({rate!r}) + (n - i) * ln(1 - {rate!r})) FOR i IN range(0, k + 1)]) ELSE 1 END AS tail
    FROM counts
),
stops AS (SELECT stratum, min(step) AS stop FROM tails, strata WHERE tail * strata > {rules.DELTA} GROUP BY stratum),
chosen AS (SELECT stratum, rule, min(cut) AS cut FROM sizes CROSS JOIN grid LEFT JOIN stops USING (stratum) WHERE stop IS NULL OR step < stop GROUP BY ALL),
over AS (SELECT DISTINCT row_id FROM base JOIN v USING (row_id) JOIN chosen USING (stratum, rule) WHERE value > cut)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
    CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed, NOT base_failed AND row_id NOT IN (SELECT row_id FROM over) AS kept
FROM base
"""


def _license_scan() -> str:
    normal = "trim(regexp_replace(lower({}), '[^a-z0-9]+', ' ', 'g'))"
    grams = "list_distinct([w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))])"
    notices = ", ".join(f"({_text(name)}, {_text(notice)})" for name, notice in licenses.TEMPLATES)
    return f"""
WITH known(license, notice) AS (VALUES {notices}),
k AS (SELECT license, {grams} AS b FROM (SELECT license, string_split({normal.format("notice")}, ' ') AS w FROM known)),
t AS (SELECT row_number() OVER () AS row_id, doc_id, coalesce(text, '') AS x FROM documents),
lines AS (SELECT row_id, string_split(x, chr(10)) AS l, x FROM t),
segments AS (SELECT row_id, unnest(CASE WHEN len(l) > 1 THEN list_append(l, x) ELSE l END) AS segment, generate_subscripts(CASE WHEN len(l) > 1 THEN list_append(l, x) ELSE l END, 1) AS pos FROM lines),
pairs AS (SELECT row_id, pos, {grams} AS a FROM (SELECT row_id, pos, string_split({normal.format("segment")}, ' ') AS w FROM segments)),
close_pairs AS (SELECT row_id, pos, a, license, b FROM pairs, k WHERE len(a) BETWEEN len(b) * 0.66 AND len(b) * 1.51),
dice AS (SELECT row_id, pos, license, len(list_intersect(a, b)) * 2.0::DOUBLE / (len(a) + len(b)) AS dice FROM close_pairs),
best AS (SELECT row_id, pos, first(license ORDER BY dice DESC, license) AS license, max(dice) AS dice FROM dice WHERE dice >= {licenses.THRESHOLD} GROUP BY ALL),
found AS (
    SELECT row_id, count(*) AS n, string_agg(DISTINCT license, ',' ORDER BY license) AS listed, first(license ORDER BY dice DESC, license) AS license, max(dice) AS dice FROM best GROUP BY row_id
)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_segments, coalesce(listed, '') AS licenses, license AS best_license, coalesce(dice, 0.0::DOUBLE)::DOUBLE AS best_dice
FROM t LEFT JOIN found USING (row_id)
"""


def _crc32(text: str) -> str:
    """crc32 of an ASCII text, bit by bit."""
    bits = f"[((ascii(substr({text}, k // 8 + 1, 1)) >> (k % 8)) & 1)::BIGINT FOR k IN range(0, 8 * length({text}))]"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {bits}), lambda c, b: xor(c >> 1, (xor(c, b) & 1) * 3988292384)), 4294967295::BIGINT)"


def _periodic_runs() -> str:
    gram = " || ' ' || ".join(["word", *(f"lead(word, {k}) OVER text" for k in range(1, 6))])
    lags = ", ".join(f"CASE WHEN lag(word, {q}) OVER text = word THEN {q} END" for q in range(1, 6))
    return f"""
WITH t AS (SELECT row_number() OVER () AS r, doc_id, {_crc32("CAST(doc_id AS VARCHAR)")} AS h, regexp_extract_all(coalesce(text, ''), {_WORD}) AS w FROM documents),
cut AS (SELECT *, len(w) AS n, CASE WHEN len(w) > 0 THEN (h // 10) % len(w) END AS a FROM t),
made AS (
    SELECT r, doc_id, CASE WHEN h % 10 = 0 AND n > 0
        THEN [w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // (3 + (h // 10) % 8)) END] FOR i IN range(0, n)] ELSE w END AS w
    FROM cut
),
each_word AS (SELECT r, generate_subscripts(w, 1) - 1 AS i, unnest(w) AS word FROM made),
grams AS (SELECT r, i, {gram} AS gram FROM each_word WINDOW text AS (PARTITION BY r ORDER BY i) QUALIFY lead(word, 5) OVER text IS NOT NULL),
same AS (
    SELECT r, q, i - q AS i, 0 AS more
    FROM (SELECT r, i, unnest([{lags}]) AS q FROM each_word WINDOW text AS (PARTITION BY r ORDER BY i)) WHERE q IS NOT NULL
    UNION ALL
    SELECT x.r, y.i - x.i AS q, x.i, 5 AS more FROM grams x JOIN grams y USING (r, gram) WHERE y.i - x.i > 5
),
stretches AS (
    SELECT r, q, min(i) AS start, max(i) - min(i) + 1 + any_value(more) AS agree
    FROM (SELECT *, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS island FROM same) GROUP BY r, q, island
),
runs AS (SELECT r, start, agree + q AS size, min(q) AS period FROM stretches WHERE agree >= greatest(q, 12 - q) GROUP BY ALL),
listed AS (
    SELECT r, count(*) AS n_runs, string_agg(start || ',' || size || ',' || period || chr(10), '' ORDER BY start, period) AS list,
        first(struct_pack(start := start, size := size, period := period) ORDER BY size DESC, start, period) AS best
    FROM runs GROUP BY r
),
gone AS (SELECT DISTINCT r, i FROM runs, unnest(range(start + period, start + size)) AS u(i)),
kept AS (SELECT r, string_agg(word, ' ' ORDER BY i) AS kept_text FROM each_word ANTI JOIN gone USING (r, i) GROUP BY r)
SELECT doc_id, CAST(coalesce(n_runs, 0) AS BIGINT) AS n_runs, CAST(best.start AS BIGINT) AS start, CAST(best.size AS BIGINT) AS length, CAST(best.period AS BIGINT) AS period,
    CAST((1000 * best.size) // best.period AS BIGINT) AS exponent_milli, sha256(coalesce(list, '')) AS runs_sha256, sha256(coalesce(kept_text, '')) AS collapsed_sha256
FROM made LEFT JOIN listed USING (r) LEFT JOIN kept USING (r)
"""


def _lexical_search() -> str:
    term = r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'"
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWERED}, {term}) AS w FROM documents),
c AS (SELECT count(*)::BIGINT AS n_docs, sum(len(w))::BIGINT AS total FROM d WHERE len(w) > 0),
b AS (SELECT row_number() OVER () AS b, item_id, regexp_extract_all({_LOWERED}, {term}) AS w FROM benchmark),
wanted AS (SELECT b, term, count(*)::BIGINT AS repeats FROM (SELECT b, unnest(w) AS term FROM b) GROUP BY ALL),
vocabulary AS (SELECT DISTINCT term FROM wanted),
has AS (SELECT r, term, count(*)::BIGINT AS tf FROM (SELECT r, unnest(w) AS term FROM d) SEMI JOIN vocabulary USING (term) GROUP BY ALL),
weights AS (SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS weight FROM has, c GROUP BY term, n_docs),
m AS (SELECT r, doc_id, 100 - 75 + (75 * len(w)::BIGINT * n_docs) // total AS m FROM d, c WHERE len(w) > 0),
scores AS (
    SELECT b, r, doc_id, sum(repeats * weight * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
    FROM wanted JOIN has USING (term) JOIN weights USING (term) JOIN m USING (r) WHERE doc_id IS NOT NULL GROUP BY ALL
),
ranked AS (SELECT b, doc_id, score, row_number() OVER (PARTITION BY b ORDER BY score DESC, doc_id) AS place FROM scores WHERE score > 0)
SELECT item_id, CAST(place AS INTEGER) AS rank, doc_id, score FROM ranked JOIN b USING (b) WHERE place <= 10
"""


ORACLE: dict[str, str] = {
    "op1_license_scan": _license_scan(),
    "op5_decontamination": _decontamination(),
    "op7_near_dedup": _near_dedup(),
    "op8_quality_rules": _quality_rules(),
    "op9_substring_dedup": _substring_dedup(),
    "op11_periodic_runs": _periodic_runs(),
    "op13_lexical_search": _lexical_search(),
}
