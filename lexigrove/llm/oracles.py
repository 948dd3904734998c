"""SQL twins of the registered queries that SQL can express, written apart from the operators."""

from __future__ import annotations

from lexigrove.llm.decontaminate import COVERAGE, MIN_PLAIN, UNITS, WINDOW

_HOLDS = "IN ('<number>', '<unit>', '<name>')"
_UNITS = ", ".join(f"'{u}'" for u in UNITS)


def _templates(table: str, key: str) -> str:
    """Words and their templates, by key and text."""
    return rf"""
  (SELECT {key}, text, words, list_transform(words, lambda w, i: CASE WHEN ascii(w) BETWEEN 48 AND 57 THEN '<number>' WHEN w[1] = chr(1) THEN '<name>'
     WHEN lower(w) IN ({_UNITS}) AND i > 1 AND ascii(words[i - 1]) BETWEEN 48 AND 57 THEN '<unit>' ELSE lower(w) END) AS template
   FROM (SELECT DISTINCT {key}, text, regexp_extract_all(regexp_replace(text, '([\p{{L}}0-9,;:] )(\p{{Lu}}\p{{Ll}})', '\1' || chr(1) || '\2', 'g'),
     chr(1) || '?\p{{L}}+|[0-9]+') AS words FROM {table}))"""


def _windows(table: str, key: str) -> str:
    return f"""
  (SELECT {key}, text, pos, array_to_string(template[pos : pos + {WINDOW - 1}], ' ') AS win,
     list_transform(template[pos : pos + {WINDOW - 1}], lambda t, i: CASE WHEN t {_HOLDS} THEN lower(words[pos + i - 1]) END) AS slots
   FROM (SELECT *, unnest(range(1, len(words) - {WINDOW - 2})) AS pos FROM {_templates(table, key)})
   WHERE len(list_filter(template[pos : pos + {WINDOW - 1}], lambda t: NOT (t {_HOLDS}))) >= {MIN_PLAIN})"""


_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"


def _share(count: str, total: str, terms: str) -> str:
    return f"1 + (1000000000::HUGEINT * ({count} + 5)) // ({total} + 5 * {terms})"


LLM_ORACLES: dict[str, str] = {
    "op2_decontaminate": f"""
WITH asked AS {_windows('benchmark', 'item_id')}, ours AS {_windows('documents', 'doc_id')},
sizes AS (SELECT item_id, text AS item_text, count(*) AS item_windows FROM asked GROUP BY ALL),
met AS (SELECT o.doc_id, o.text, a.item_id, a.text AS item_text, a.pos AS item_pos, o.pos - a.pos AS shift, a.slots AS item_slots, o.slots
  FROM ours o JOIN asked a USING (win)),
pairs AS (SELECT doc_id, text, item_id, item_text, shift, unnest(item_slots) AS was, unnest(slots) AS now FROM met),
slot AS (SELECT doc_id, text, item_id, item_text, shift, count(DISTINCT was) AS values, count(DISTINCT (was, now)) AS pairs,
  count(DISTINCT CASE WHEN was <> now THEN (was, now) END) AS changed FROM pairs WHERE was IS NOT NULL GROUP BY ALL),
aligned AS (SELECT doc_id, text, item_id, item_text, shift, count(DISTINCT item_pos) AS covered FROM met GROUP BY ALL),
fit AS (SELECT a.*, coalesce(changed, 0) AS changed FROM aligned a LEFT JOIN slot s
  ON s.doc_id = a.doc_id AND s.text = a.text AND s.item_id = a.item_id AND s.item_text = a.item_text AND s.shift = a.shift
  WHERE coalesce(values = pairs, true)),
best AS (SELECT doc_id, text, item_id, item_text, changed AS slots_changed FROM fit
  QUALIFY row_number() OVER (PARTITION BY doc_id, text, item_id, item_text ORDER BY covered DESC, changed) = 1),
found AS (SELECT f.doc_id, f.text, f.item_id, f.item_text, count(DISTINCT item_pos) AS windows FROM fit f JOIN met m
  ON m.doc_id = f.doc_id AND m.text = f.text AND m.item_id = f.item_id AND m.item_text = f.item_text AND m.shift = f.shift GROUP BY ALL)
SELECT doc_id, item_id, windows, item_windows, windows::DOUBLE / item_windows AS coverage, slots_changed
FROM found JOIN best USING (doc_id, text, item_id, item_text) JOIN sizes USING (item_id, item_text)
WHERE windows::DOUBLE / item_windows >= {COVERAGE}
UNION ALL SELECT doc_id, item_id, 1, 1, 1.0, changed FROM
  (SELECT *, list_distinct(list_filter(list_zip(was, now), lambda p: p[1] IS NOT NULL)) AS pairs, len(list_filter(pairs, lambda p: p[1] <> p[2])) AS changed
   FROM (SELECT o.doc_id, o.text, a.item_id, a.text AS item_text, a.template,
     list_transform(a.template, lambda t, i: CASE WHEN t {_HOLDS} THEN lower(a.words[i]) END) AS was,
     list_transform(o.template, lambda t, i: CASE WHEN t {_HOLDS} THEN lower(o.words[i]) END) AS now
     FROM {_templates('documents', 'doc_id')} o JOIN {_templates('benchmark', 'item_id')} a ON o.template = a.template
     WHERE len(a.words) > 0 AND NOT EXISTS (SELECT 1 FROM sizes s WHERE s.item_id = a.item_id AND s.item_text = a.text)))
  WHERE len(list_distinct(list_transform(pairs, lambda p: p[1]))) = len(pairs)
    AND (changed = 0 OR len(list_filter(template, lambda t: NOT (t {_HOLDS}))) > 0)""",
    "op11_source_divergence": rf"""
WITH docs AS (SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, translate(coalesce(text, ''), {_LOWER}) AS body FROM documents),
word AS (SELECT id, lang, source, unnest(regexp_extract_all(body, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs),
kept AS (SELECT lang, term FROM word GROUP BY lang, term HAVING count(DISTINCT id) >= 30),
grp AS (SELECT DISTINCT lang, source FROM docs),
occ AS (SELECT lang, source, term, count(*) AS n FROM word JOIN kept USING (lang, term) GROUP BY ALL),
size AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
cell AS (SELECT g.lang, g.source, k.term, coalesce(n, 0) AS n FROM grp g JOIN kept k USING (lang) LEFT JOIN occ USING (lang, source, term)),
p AS (SELECT lang, source, term, n, {_share("n", "sum(n) OVER (PARTITION BY lang, source)", "v")} AS p FROM cell JOIN size USING (lang)),
q AS (SELECT lang, term, {_share("n", "sum(n) OVER (PARTITION BY lang)", "v")} AS q FROM (SELECT lang, term, sum(n) AS n FROM cell GROUP BY ALL) JOIN size USING (lang)),
gap AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pair AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
  FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN gap g ON g.lang = a.lang AND g.source = a.source AND g.item = b.source),
used AS (SELECT lang, source, 'term' AS part, term AS item, p - q AS value FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM (FROM pair UNION ALL FROM used))
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM ranked WHERE part = 'pair' OR rank <= 50""",
    "op12_collocations": rf"""
WITH docs AS (SELECT coalesce(lang, 'und') AS lang, regexp_split_to_array(translate(coalesce(text, ''), {_LOWER}), '[.,;:!?\x0A-\x0D]') AS pieces FROM documents),
piece AS (SELECT lang, regexp_extract_all(unnest(pieces), '[^\x20\x09]+') AS words FROM docs),
held AS (SELECT lang, words FROM piece WHERE len(words) > 0),
gram AS (SELECT lang, m, unnest([words[i : i + m - 1] for i in range(1, len(words) - m + 2)]) AS words FROM held, (SELECT unnest([1, 2, 3, 4]) AS m) WHERE m <= len(words)),
f AS (SELECT lang, m, words, count(*) AS f FROM gram GROUP BY ALL HAVING count(*) >= 30),
total AS (SELECT lang, sum(len(words))::BIGINT AS n FROM held GROUP BY lang),
cut AS (SELECT c.lang, c.words, c.f AS a, l.f AS l, r.f AS r, (2000000::HUGEINT * c.f) // (l.f + r.f) AS score, l.m AS k
  FROM f c JOIN f l ON l.lang = c.lang AND l.m < c.m AND l.words = c.words[1 : l.m] JOIN f r ON r.lang = c.lang AND r.m = c.m - l.m AND r.words = c.words[l.m + 1 : c.m]),
weak AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, words ORDER BY score, k) = 1),
sub AS (SELECT lang, f, words[i : i + m - 1] AS words FROM (SELECT lang, f, words, unnest(range(1, t.m - s.m + 2)) AS i, s.m FROM f t JOIN (SELECT unnest([2, 3]) AS m) s ON s.m < t.m)),
inside AS (SELECT lang, words, max(f) AS longer FROM sub GROUP BY ALL),
listed AS (SELECT lang, array_to_string(words, ' ') AS phrase, a, l, r, score FROM weak LEFT JOIN inside USING (lang, words) WHERE longer IS NULL OR 100 * longer < 80 * a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score::BIGINT AS score
FROM listed JOIN total USING (lang) QUALIFY rank <= 2000""",
}
