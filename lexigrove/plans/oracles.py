"""SQL twins of the registered queries, in the dialect of DuckDB."""

from __future__ import annotations

from lexigrove.functions.constants import ENGLISH_STOP_WORDS, TOKEN_STOP_WORDS

SPACE = r"\s\x0b\p{Z}\x1c-\x1f\x85"


def _in(words) -> str:
    return "(" + ", ".join("'" + w.replace("'", "''") + "'" for w in words) + ")"


STOP = _in(TOKEN_STOP_WORDS)
STRIP = rf"regexp_replace(regexp_replace(%s, '^[{SPACE}]+', ''), '[{SPACE}]+$', '')"
CLEAN = rf"trim(regexp_replace(regexp_replace(lower(%s), '[^a-z{SPACE}]+', '', 'g'), '[{SPACE}]+', ' ', 'g'))"
WORDS = rf"len(regexp_extract_all(%s, '[^{SPACE}]+'))"
NOT_BLANK = rf"regexp_matches(text, '[^{SPACE}]')"
TOKENS = (
    r"list_filter(regexp_extract_all(lower(%s), '[\p{L}\p{N}_]+'), "
    rf"lambda x: regexp_full_match(x, '[a-z]{{3,}}') AND x NOT IN {STOP})"
)
CLEAN_TOKENS = f"list_filter(string_split(%s, ' '), lambda x: length(x) >= 3 AND x NOT IN {STOP})"
SQ_L2 = "list_sum(list_transform(list_zip(%s, %s), lambda z: (z[1]::DOUBLE - z[2]::DOUBLE) * (z[1]::DOUBLE - z[2]::DOUBLE)))"
DOT = "list_sum(list_transform(list_zip(%s, %s), lambda z: z[1]::DOUBLE * z[2]::DOUBLE))"
CLUSTER = r"regexp_extract(source, '(\d+)$', 1)::BIGINT"

# documents with tokens of the raw text, then of the cleaned text
RAW_DOCS = f"docs AS (SELECT doc_id, tokens FROM (SELECT doc_id, {TOKENS % 'text'} AS tokens FROM documents WHERE {NOT_BLANK}) WHERE len(tokens) > 0)"
CLEAN_DOCS = (
    f"docs AS (SELECT doc_id, cluster_id, tokens FROM (SELECT doc_id, {CLUSTER} AS cluster_id, {CLEAN_TOKENS % (CLEAN % 'text')} AS tokens "
    f"FROM documents WHERE {NOT_BLANK}) WHERE len(tokens) > 0)"
)
TF = "tf AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(tokens) AS term FROM docs) GROUP BY ALL)"
DF = "df AS (SELECT term, count(*) AS df FROM tf GROUP BY term)"
M = "m AS (SELECT count(*) AS m FROM docs)"
IDF = "ln((m + 1.0::DOUBLE) / (df + 1))"

ORACLES: dict[str, str] = {}

ORACLES["clean_text"] = f"SELECT doc_id, {CLEAN % 'text'} AS text FROM documents"
ORACLES["word_char_counts"] = f"SELECT doc_id, length({STRIP % 'text'}) AS char_count, {WORDS % 'text'} AS word_count FROM documents"
ORACLES["tokenize"] = f"WITH {RAW_DOCS} SELECT doc_id, len(tokens) AS n_tokens, array_to_string(tokens, ' ') AS tokens FROM docs"
ORACLES["document_filter_counts"] = f"""
WITH d AS (SELECT NOT coalesce({NOT_BLANK}, false) AS blank, coalesce(len({TOKENS % 'text'}), 0) AS n FROM documents)
SELECT count(*) AS total, count(*) FILTER (blank) AS blank, count(*) FILTER (NOT blank AND n = 0) AS without_tokens,
  count(*) FILTER (n > 0) AS kept FROM d"""
ORACLES["ngrams"] = f"""
WITH {RAW_DOCS}, g AS (SELECT unnest(list_transform(range(1, len(tokens)), lambda i: tokens[i] || ' ' || tokens[i + 1])) AS ngram FROM docs)
SELECT ngram, count(*) AS n FROM g GROUP BY ngram"""
ORACLES["lemma_clean"] = f"""
WITH d AS (SELECT doc_id, string_split({CLEAN % 'text'}, ' ') AS words FROM documents),
w AS (SELECT DISTINCT w FROM (SELECT unnest(words) AS w FROM d) WHERE length(w) > 2),
lemmas AS (SELECT w AS form, w[:length(w) - 1] AS lemma FROM w WHERE w LIKE '%s' AND w[:length(w) - 1] IN (SELECT w FROM w)),
t AS (SELECT doc_id, unnest(range(len(words))) AS pos, unnest(words) AS form FROM d),
kept AS (SELECT * FROM t WHERE length(form) > 2 AND form NOT IN {_in(ENGLISH_STOP_WORDS)}),
joined AS (SELECT doc_id, string_agg(coalesce(lemma, form), ' ' ORDER BY pos) AS text FROM kept LEFT JOIN lemmas USING (form) GROUP BY doc_id)
SELECT d.doc_id, coalesce(text, '') AS text FROM d LEFT JOIN joined USING (doc_id)"""
ORACLES["json_extract"] = "SELECT event_id, '' AS text, json_extract_string(props, '$.k') AS k, true AS success FROM events"
ORACLES["json_documents"] = "SELECT conv_id * 100000 + turn AS turn_id, text, role, turn FROM conversations"

ORACLES["term_frequency"] = f"WITH {RAW_DOCS}, {TF} SELECT doc_id, term, tf FROM tf"
ORACLES["document_frequency"] = f"WITH {RAW_DOCS}, {TF}, {DF} SELECT term, df FROM df"
ORACLES["tfidf_exact"] = f"""
WITH {CLEAN_DOCS}, {TF}, {DF}, {M} SELECT doc_id, term, tf, df, round(tf * {IDF}, 9) AS tfidf FROM tf JOIN df USING (term), m"""
ORACLES["tfidf_top_vocabulary"] = f"""
WITH {RAW_DOCS}, {TF}, {M},
df AS (SELECT term, count(*) AS df, sum(tf) AS total FROM tf GROUP BY term ORDER BY total DESC, term LIMIT 5000)
SELECT doc_id, term, tf, df, round(tf * {IDF}, 9) AS tfidf FROM tf JOIN df USING (term), m"""


def _hashed(size: int) -> str:
    """Hash bucket of each term: MurmurHash3 (x86, 32 bit, seed 42) in integer arithmetic."""
    two32 = "4294967296::UBIGINT"

    def mul(a: str, b: int) -> str:
        return f"(({a}) * {b}::UBIGINT) % {two32}"

    def rot(a: str, r: int) -> str:
        return f"((({a}) * {2 ** r}::UBIGINT) % {two32} + (({a}) // {2 ** (32 - r)}::UBIGINT))"

    def mixed(k: str) -> str:
        return mul(rot(mul(k, 0xCC9E2D51), 15), 0x1B873593)

    step = f"({mul(rot('xor(h, k)', 13), 5)} + {0xE6546B64}::UBIGINT) % {two32}"
    word = " + ".join(f"b[4 * i + {j + 1}] * {256 ** j}::UBIGINT" for j in range(4))
    tail = " + ".join(f"coalesce(b[4 * (n // 4) + {j + 1}], 0)::UBIGINT * {256 ** j}::UBIGINT" for j in range(3))
    return f"""
hb AS (SELECT term, length(term) AS n, list_transform(range(1, length(term) + 1), lambda i: ascii(term[i])::UBIGINT) AS b FROM (SELECT DISTINCT term FROM tf)),
hw AS (SELECT term, n, b, list_transform(range(0, n // 4), lambda i: {mixed(word)}) AS words, {mixed(tail)} AS tail FROM hb),
h1 AS (SELECT term, n, tail, list_reduce(list_prepend(42::UBIGINT, words), lambda h, k: {step}) AS h FROM hw),
h2 AS (SELECT term, xor(CASE WHEN n % 4 > 0 THEN xor(h, tail) ELSE h END, n::UBIGINT) AS h FROM h1),
h3 AS (SELECT term, {mul("xor(h, h // 65536::UBIGINT)", 0x85EBCA6B)} AS h FROM h2),
h4 AS (SELECT term, {mul("xor(h, h // 8192::UBIGINT)", 0xC2B2AE35)} AS h FROM h3),
h5 AS (SELECT term, xor(h, h // 65536::UBIGINT)::BIGINT AS h FROM h4),
hashed AS (SELECT term, (((CASE WHEN h >= 2147483648 THEN h - 4294967296 ELSE h END) % {size}) + {size}) % {size} AS feature FROM h5),
htf AS (SELECT doc_id, feature, sum(tf)::BIGINT AS tf FROM tf JOIN hashed USING (term) GROUP BY ALL)"""


HDF = "hdf AS (SELECT feature, count(*) AS df FROM htf GROUP BY feature)"
ORACLES["hashed_tfidf"] = f"""
WITH {RAW_DOCS}, {TF}, {M}, {_hashed(5000)}, {HDF},
w AS (SELECT doc_id, feature, tf * {IDF} AS weight FROM htf JOIN hdf USING (feature), m)
SELECT doc_id, 'feature_' || feature AS feature, round(weight, 9) AS weight FROM w WHERE weight <> 0"""
ORACLES["doc_similarity"] = f"""
WITH {RAW_DOCS}, {TF}, {DF}, {M},
w AS (SELECT doc_id, term, tf * {IDF} AS w FROM tf JOIN df USING (term), m),
n AS (SELECT doc_id, sqrt(sum(w * w)) AS norm FROM w GROUP BY doc_id HAVING sum(w * w) > 0),
u AS (SELECT doc_id, term, w / norm AS w FROM w JOIN n USING (doc_id)),
p AS (SELECT a.doc_id, b.doc_id AS other_id, round(sum(a.w * b.w), 9) AS similarity FROM u a JOIN u b USING (term)
  WHERE a.doc_id <> b.doc_id GROUP BY ALL HAVING round(sum(a.w * b.w), 9) >= 0.8),
r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY similarity DESC, other_id) AS rank FROM p)
SELECT doc_id, rank, other_id, similarity FROM r WHERE rank <= 5"""

ORACLES["cluster_stats"] = """
SELECT label::BIGINT AS cluster_id, count(*) AS size, round(count(*)::DOUBLE / (sum(count(*)) OVER ())::DOUBLE * 100, 9) AS percentage
FROM embeddings GROUP BY label"""
CENTROIDS = """
x AS (SELECT vec_id, label::BIGINT AS cluster_id, unnest(range(len(embedding))) AS dim, unnest(embedding)::DOUBLE AS value FROM embeddings),
cv AS (SELECT cluster_id, dim, avg(value) AS value FROM x GROUP BY ALL),
c AS (SELECT cluster_id, list(value ORDER BY dim) AS centroid FROM cv GROUP BY cluster_id)"""
ORACLES["cluster_centroids"] = f"WITH {CENTROIDS} SELECT cluster_id, dim, round(value, 9) AS value FROM cv"
ORACLES["kmeans_assign"] = f"""
WITH {CENTROIDS}, d AS (SELECT vec_id AS doc_id, cluster_id, round({SQ_L2 % ('embedding', 'centroid')}, 9) AS distance FROM embeddings, c),
r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY distance, cluster_id) AS rn FROM d)
SELECT doc_id, cluster_id, distance FROM r WHERE rn = 1"""
ORACLES["silhouette"] = """
WITH e AS (SELECT vec_id, label, list_transform(embedding, lambda v: v::DOUBLE) AS v FROM embeddings),
x AS (SELECT vec_id, label, unnest(range(len(v))) AS dim, unnest(v) AS value FROM e),
sq AS (SELECT vec_id, label, sum(value * value) AS sq FROM x GROUP BY ALL),
psi AS (SELECT label, count(*) AS n, sum(sq) AS psi FROM sq GROUP BY label),
y AS (SELECT label, dim, sum(value) AS y FROM x GROUP BY ALL),
xy AS (SELECT x.vec_id, x.label AS own, y.label AS other, sum(x.value * y.y) AS xy FROM x JOIN y USING (dim) GROUP BY ALL),
d AS (SELECT xy.vec_id, own, other, n, sq + psi / n - 2 * xy / n AS dist FROM xy JOIN sq USING (vec_id) JOIN psi ON psi.label = xy.other),
ab AS (SELECT vec_id, max(CASE WHEN own = other THEN CASE WHEN n = 1 THEN 0 ELSE dist * n / (n - 1) END END) AS a,
  min(CASE WHEN own <> other THEN dist END) AS b, max(CASE WHEN own = other THEN n END) AS n FROM d GROUP BY vec_id),
s AS (SELECT CASE WHEN n = 1 THEN 0 WHEN a < b THEN 1 - a / b WHEN a > b THEN b / a - 1 ELSE 0 END AS s FROM ab)
SELECT round(avg(s), 6) AS silhouette FROM s"""

TOP = f"""{CLEAN_DOCS}, {TF}, {DF}, {M},
sizes AS (SELECT cluster_id, count(*) AS n_docs FROM docs GROUP BY cluster_id),
weights AS (SELECT cluster_id, term, round(sum(tf * {IDF}) / any_value(n_docs), 9) AS weight
  FROM tf JOIN docs USING (doc_id) JOIN df USING (term) JOIN sizes USING (cluster_id), m GROUP BY cluster_id, term),
ranked AS (SELECT cluster_id, row_number() OVER (PARTITION BY cluster_id ORDER BY weight DESC, term) AS rank, term, weight FROM weights WHERE weight > 0),
top AS (SELECT * FROM ranked WHERE rank <= 10),
names AS (SELECT cluster_id, list(term ORDER BY rank) AS names FROM top GROUP BY cluster_id)"""
FIRST = f"""
placed AS (SELECT doc_id, {CLUSTER} AS cluster_id, text, row_number() OVER (PARTITION BY {CLUSTER} ORDER BY doc_id) AS place FROM documents),
prefixes AS (SELECT cluster_id, CASE
  WHEN bool_or(contains(t, 'financial')) THEN 'Financial Documents - '
  WHEN bool_or(contains(t, 'clinical') OR contains(t, 'medical')) THEN 'Medical/Clinical - '
  WHEN bool_or(contains(t, 'legal')) THEN 'Legal Documents - ' ELSE '' END AS prefix
  FROM (SELECT cluster_id, {CLEAN % 'text'} AS t FROM placed WHERE place <= 5) GROUP BY cluster_id)"""
LABEL = (
    "prefix || CASE WHEN len(names) >= 3 THEN array_to_string(list_transform(names[1:3], lambda w: upper(w[1]) || w[2:]), ' / ') "
    "ELSE 'Cluster' END AS label, upper(array_to_string(names[1:3], ' | ')) AS simple_label"
)
SNIPPETS = f"""
sent AS (SELECT cluster_id, doc_id, unnest(range(len(s))) AS pos, unnest(s) AS raw FROM
  (SELECT cluster_id, doc_id, regexp_split_to_array(text, '[.!?]+') AS s FROM placed WHERE place <= 10)),
fit AS (SELECT cluster_id, doc_id, pos, {STRIP % 'raw'} AS snippet FROM sent WHERE {WORDS % 'raw'} BETWEEN 21 AND 49),
hit AS (SELECT cluster_id, doc_id, pos, snippet FROM fit JOIN names USING (cluster_id)
  WHERE len(list_filter(names[1:5], lambda w: contains(lower(snippet), w))) > 0),
snip AS (SELECT * FROM (SELECT cluster_id, row_number() OVER (PARTITION BY cluster_id ORDER BY doc_id, pos) AS place, doc_id, snippet FROM hit)
  WHERE place <= 3)"""
ORACLES["cluster_top_terms"] = f"WITH {TOP} SELECT cluster_id, rank, term, weight FROM top"
ORACLES["cluster_label"] = f"WITH {TOP}, {FIRST} SELECT cluster_id, {LABEL} FROM names JOIN prefixes USING (cluster_id)"
ORACLES["representative_snippets"] = f"WITH {TOP}, {FIRST}, {SNIPPETS} SELECT cluster_id, place, doc_id, snippet FROM snip"
ORACLES["cluster_format_mix"] = f"SELECT {CLUSTER} AS cluster_id, coalesce(lang, 'unknown') AS format, count(*) AS n FROM documents GROUP BY ALL"
ORACLES["cluster_avg_length"] = f"""
SELECT {CLUSTER} AS cluster_id, count(*) AS size, round(avg({WORDS % 'text'}), 9) AS average_doc_length FROM documents GROUP BY 1"""
ORACLES["cluster_metadata"] = f"""
WITH {TOP}, {FIRST}, {SNIPPETS},
basics AS (SELECT {CLUSTER} AS cluster_id, count(*) AS size, avg({WORDS % 'text'}) AS average_doc_length FROM documents GROUP BY 1),
fm AS (SELECT cluster_id, string_agg(f || '=' || n, ',' ORDER BY f) AS formats FROM
  (SELECT {CLUSTER} AS cluster_id, coalesce(lang, 'unknown') AS f, count(*) AS n FROM documents GROUP BY ALL) GROUP BY cluster_id),
sl AS (SELECT cluster_id, string_agg(snippet, '|' ORDER BY place) AS s FROM snip GROUP BY cluster_id),
cn AS (SELECT cluster_id, sqrt(sum(weight * weight)) AS norm FROM weights GROUP BY cluster_id)
SELECT cluster_id, {LABEL}, size, round(size::DOUBLE / (SELECT count(*) FROM documents) * 100, 9) AS percentage,
  array_to_string(names, ',') AS top_terms, formats, round(average_doc_length, 9) AS average_doc_length,
  coalesce(s, '') AS representative_snippets, round(norm, 6) AS centroid_norm
FROM basics JOIN names USING (cluster_id) JOIN prefixes USING (cluster_id) JOIN fm USING (cluster_id)
  LEFT JOIN sl USING (cluster_id) JOIN cn USING (cluster_id)"""

# unit vectors of the default encoder, stored as 32-bit floats; queries use the weights of the documents
EMBED = f"""{RAW_DOCS}, tf0 AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(tokens) AS term FROM docs) GROUP BY ALL),
qtf AS (SELECT item_id, term, count(*) AS tf FROM (SELECT item_id, unnest({TOKENS % 'text'}) AS term FROM benchmark WHERE {NOT_BLANK}) GROUP BY ALL),
tf AS (SELECT doc_id, term, tf FROM tf0 UNION ALL SELECT -1 - item_id, term, tf FROM qtf),
{M}, {_hashed(384)}, hdf AS (SELECT feature, count(*) AS df FROM htf WHERE doc_id >= 0 GROUP BY feature),
w AS (SELECT doc_id, feature, tf * ln((m + 1.0::DOUBLE) / (coalesce(df, 0) + 1)) AS w FROM htf LEFT JOIN hdf USING (feature), m),
n AS (SELECT doc_id, sqrt(sum(w * w)) AS norm FROM w GROUP BY doc_id),
u AS (SELECT doc_id, feature AS dim, (w / norm)::FLOAT::DOUBLE AS value FROM w JOIN n USING (doc_id) WHERE w <> 0)"""
ORACLES["doc_embed"] = f"WITH {EMBED} SELECT doc_id, dim, round(value, 6) AS value FROM u WHERE doc_id >= 0"
ORACLES["stream_embed"] = ORACLES["doc_embed"]
ORACLES["query_embed"] = f"WITH {EMBED} SELECT -1 - doc_id AS item_id, dim, round(value, 6) AS value FROM u WHERE doc_id < 0"
ORACLES["model_embed"] = """
SELECT doc_id, dim, value FROM (SELECT doc_id, dim, length(t) - length(replace(t, chr((97 + dim)::INT), '')) AS value
  FROM (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents), range(26) AS d(dim))
WHERE value > 0"""
ORACLES["joined_documents"] = """
SELECT doc_id, lang, source, length(coalesce(text, '')) AS n_chars, coalesce(label, -1)::BIGINT AS cluster_id, coalesce(len(embedding), 0) AS dimension
FROM documents LEFT JOIN embeddings ON vec_id = doc_id"""
ORACLES["query_captions"] = "SELECT item_id, 'Q' || (item_id + 1) AS name, text[:50] AS caption FROM benchmark"
ORACLES["text_search"] = f"""
WITH {EMBED}, sq AS (SELECT doc_id, sum(value * value) AS sq FROM u GROUP BY doc_id),
dot AS (SELECT q.doc_id AS q, d.doc_id AS d, sum(q.value * d.value) AS dot FROM u q JOIN u d USING (dim) WHERE q.doc_id < 0 AND d.doc_id >= 0 GROUP BY ALL),
pairs AS (SELECT item_id AS query_id, documents.doc_id,
  round(coalesce(a.sq, 0) + coalesce(b.sq, 0) - 2 * coalesce(dot, 0), 9) AS distance
  FROM benchmark CROSS JOIN documents LEFT JOIN sq a ON a.doc_id = -1 - item_id LEFT JOIN sq b ON b.doc_id = documents.doc_id
  LEFT JOIN dot ON dot.q = -1 - item_id AND dot.d = documents.doc_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY greatest(distance, 0), doc_id) AS rank FROM pairs)
SELECT query_id, rank, doc_id, round(greatest(distance, 0), 6) AS distance FROM r WHERE rank <= 5"""

ORACLES["search_until_ready"] = f"""
WITH {EMBED}, tdf AS (SELECT term, count(*) AS df FROM tf WHERE doc_id >= 0 GROUP BY term),
tw AS (SELECT doc_id, term, tf * ln((m + 1.0::DOUBLE) / (df + 1)) AS w FROM tf JOIN tdf USING (term), m),
tn AS (SELECT doc_id, sqrt(sum(w * w)) AS n FROM tw GROUP BY doc_id HAVING sum(w * w) > 0),
ts AS (SELECT q.doc_id AS q, d.doc_id AS d, sum(q.w / a.n * d.w / b.n) AS score FROM tw q JOIN tw d USING (term) JOIN tn a ON a.doc_id = q.doc_id
  JOIN tn b ON b.doc_id = d.doc_id WHERE q.doc_id < 0 AND d.doc_id >= 0 AND q.w > 0 AND d.w > 0 GROUP BY ALL),
un AS (SELECT doc_id, sqrt(sum(value * value)) AS n FROM u GROUP BY doc_id),
ud AS (SELECT q.doc_id AS q, d.doc_id AS d, sum(q.value * d.value) AS dot FROM u q JOIN u d USING (dim) WHERE q.doc_id < 0 AND d.doc_id >= 0 GROUP BY ALL),
us AS (SELECT a.doc_id AS q, b.doc_id AS d, coalesce(dot, 0) / (a.n * b.n) AS score FROM un a JOIN un b ON a.doc_id < 0 AND b.doc_id >= 0
  LEFT JOIN ud ON ud.q = a.doc_id AND ud.d = b.doc_id),
stages AS (SELECT * FROM (VALUES ('before', 0), ('amid', 1), ('after', 2)) AS s(stage, parts)),
hits AS (SELECT stage, 'embedding' AS space, us.* FROM us JOIN stages ON d % 2 < parts
  UNION ALL SELECT stage, 'term', ts.* FROM ts JOIN stages ON d % 2 >= parts),
own AS (SELECT *, row_number() OVER (PARTITION BY stage, space, q ORDER BY round(score, 12) DESC, d) AS place FROM hits),
merged AS (SELECT *, row_number() OVER (PARTITION BY stage, q ORDER BY place, space, d) AS rank FROM own WHERE place <= 5)
SELECT stage, -1 - q AS query_id, rank, d AS doc_id, space, round(score, 6) AS score FROM merged WHERE rank <= 5"""
ORACLES["vector_store_stats"] = """
SELECT label::BIGINT AS cluster_id, count(*) AS size, max(len(embedding)) AS dimension FROM embeddings GROUP BY label"""
ORACLES["vector_store_totals"] = """
SELECT count(*) AS total_documents, count(DISTINCT label) AS num_clusters, max(len(embedding)) AS dimension FROM embeddings"""
FLAT = f"""
fd AS (SELECT q.vec_id AS query_id, e.vec_id AS doc_id, {SQ_L2 % ('q.embedding', 'e.embedding')} AS distance FROM embeddings q, embeddings e),
fr AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, doc_id) AS rank FROM fd),
flat AS (SELECT query_id, rank, doc_id, round(distance, 9) AS distance FROM fr WHERE rank <= 5)"""
SELECTED = f"""{CENTROIDS},
cs AS (SELECT q.vec_id AS query_id, cluster_id, round({DOT % ('embedding', 'centroid')} /
  (sqrt({DOT % ('embedding', 'embedding')}) * sqrt({DOT % ('centroid', 'centroid')})), 9) AS similarity FROM embeddings q, c),
chosen AS (SELECT query_id, cluster_id, similarity FROM
  (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, cluster_id) AS rn FROM cs) WHERE rn = 1)"""
AWARE = f"""{SELECTED},
ad AS (SELECT query_id, e.vec_id AS doc_id, {SQ_L2 % ('q.embedding', 'e.embedding')} AS distance, cluster_id, similarity
  FROM chosen JOIN embeddings q ON q.vec_id = query_id JOIN embeddings e ON e.label = cluster_id),
ar AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, doc_id) AS rank FROM ad),
aware AS (SELECT query_id, rank, doc_id, round(distance, 9) AS distance, cluster_id, similarity FROM ar WHERE rank <= 5)"""
ORACLES["flat_knn"] = f"WITH {FLAT} SELECT * FROM flat"
ORACLES["pruned_knn"] = f"""
WITH {CENTROIDS}, {FLAT},
m AS (SELECT vec_id, label, sqrt({SQ_L2 % ('embedding', 'centroid')}) AS radius FROM embeddings JOIN c ON cluster_id = label),
ends AS (SELECT label AS cluster_id, min(radius) AS low, max(radius) AS high FROM m GROUP BY label),
gap AS (SELECT q.vec_id AS query_id, cluster_id, sqrt({SQ_L2 % ('q.embedding', 'centroid')}) AS gap FROM embeddings q, c),
home AS (SELECT query_id, cluster_id FROM gap JOIN ends USING (cluster_id)
  QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY round(greatest(0, gap - high, low - gap), 9), round(gap, 9), cluster_id) = 1),
near AS (SELECT fd.query_id, m.radius, m.label AS cluster_id, home.cluster_id AS home, distance, doc_id FROM fd JOIN m ON vec_id = doc_id JOIN home USING (query_id)),
reach AS (SELECT query_id, sqrt(distance) AS reach FROM near WHERE cluster_id = home QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY distance, doc_id) = 5),
seen AS (SELECT query_id, count(*) AS vectors_read FROM near JOIN gap USING (query_id, cluster_id) LEFT JOIN reach USING (query_id)
  WHERE cluster_id = home OR reach IS NULL OR abs(gap - radius) <= reach + 1e-9 * (reach + gap) GROUP BY query_id)
SELECT query_id, rank, doc_id, distance, vectors_read FROM flat JOIN seen USING (query_id)"""
ORACLES["cluster_select"] = f"WITH {SELECTED} SELECT * FROM chosen"
ORACLES["cluster_aware_knn"] = f"WITH {AWARE} SELECT * FROM aware"
ORACLES["search_space_reduction"] = f"""
WITH {SELECTED}, s AS (SELECT label AS cluster_id, count(*) AS n FROM embeddings GROUP BY label), t AS (SELECT count(*) AS t FROM embeddings)
SELECT query_id, n AS docs_searched, t AS flat_docs_searched, round((1.0::DOUBLE - n::DOUBLE / t::DOUBLE) * 100, 9) AS reduction_pct
FROM chosen JOIN s USING (cluster_id), t"""
ORACLES["store_roundtrip"] = ORACLES["cluster_aware_knn"]
SHORT = "(SELECT vec_id, list_transform(embedding, lambda v: v::DOUBLE * 1e-6::DOUBLE) AS embedding FROM embeddings)"
ORACLES["flat_knn_scaled"] = f"""
WITH d AS (SELECT q.vec_id AS query_id, e.vec_id AS doc_id, {SQ_L2 % ('q.embedding', 'e.embedding')} * 1e12::DOUBLE AS distance FROM {SHORT} q, {SHORT} e),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(distance, 9), doc_id) AS rank FROM d)
SELECT query_id, rank, doc_id, round(distance, 6) AS distance FROM r WHERE rank <= 5"""
ORACLES["retrieval_compare"] = f"""
WITH {AWARE}, {FLAT}, hits AS (
  SELECT query_id, count(f.doc_id) AS flat_hits, count(a.doc_id) AS aware_hits, count(CASE WHEN a.doc_id = f.doc_id THEN 1 END) AS shared_hits
  FROM flat f FULL JOIN aware a USING (query_id, doc_id) GROUP BY query_id),
s AS (SELECT label AS cluster_id, count(*) AS n FROM embeddings GROUP BY label), t AS (SELECT count(*) AS t FROM embeddings)
SELECT hits.*, n AS docs_searched, t AS flat_docs_searched, round((1.0::DOUBLE - n::DOUBLE / t::DOUBLE) * 100, 9) AS reduction_pct
FROM hits JOIN chosen USING (query_id) JOIN s USING (cluster_id), t"""


def _precision(found: str) -> str:
    return f"""(SELECT q.vec_id AS query_id, count(*) FILTER (q.label = e.label) AS hits FROM {found} f
  JOIN embeddings q ON q.vec_id = f.query_id JOIN embeddings e ON e.vec_id = f.doc_id GROUP BY 1)"""


ORACLES["precision_at_k"] = f"""
WITH {FLAT}, t AS (SELECT label, count(*) AS n FROM embeddings GROUP BY label)
SELECT e.vec_id AS query_id, 5::BIGINT AS k, n AS total_relevant, coalesce(hits, 0) AS relevant_retrieved,
  round(coalesce(hits, 0) / 5.0::DOUBLE, 3) AS precision
FROM embeddings e JOIN t USING (label) LEFT JOIN {_precision('flat')} p ON p.query_id = e.vec_id"""
ORACLES["precision_compare"] = f"""
WITH {AWARE}, {FLAT}
SELECT e.vec_id AS query_id, round(coalesce(a.hits, 0) / 5.0::DOUBLE, 3) AS cluster_aware_precision,
  round(coalesce(f.hits, 0) / 5.0::DOUBLE, 3) AS flat_precision,
  round(round(coalesce(f.hits, 0) / 5.0::DOUBLE, 3) - round(coalesce(a.hits, 0) / 5.0::DOUBLE, 3), 3) AS precision_difference
FROM embeddings e LEFT JOIN {_precision('aware')} a ON a.query_id = e.vec_id LEFT JOIN {_precision('flat')} f ON f.query_id = e.vec_id"""

ORACLES["accuracy_report"] = """
SELECT count(*) AS total_processed, count(*) FILTER (event_type <> 'error') AS successful, count(*) FILTER (event_type = 'error') AS failed,
  round(count(*) FILTER (event_type <> 'error') / count(*)::DOUBLE * 100, 6) AS accuracy, round(sum(value) / count(*), 6) AS avg_time_per_doc,
  round(sum(value), 6) AS total_time, round(count(*) / sum(value), 6) AS docs_per_second, round(sum(value) / count(*) * 1000, 6) AS ms_per_doc
FROM events"""
ORACLES["latency_stats"] = """
SELECT event_type, count(*) AS runs, round(avg(value), 9) AS mean, round(stddev_pop(value), 6) AS std, min(value) AS min, max(value) AS max,
  round(sum(value), 6) AS total FROM events GROUP BY event_type"""
ORACLES["cumulative_latency"] = """
SELECT event_type, event_id, row_number() OVER w AS ordinal, round(sum(value) OVER w, 6) AS cumulative,
  round(sum(value) OVER w, 6) / row_number() OVER w AS running_mean
FROM events WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)"""
ORACLES["latency_milestones"] = """
WITH t AS (SELECT event_id, row_number() OVER w AS ordinal, count(*) OVER () AS total_documents, sum(value) OVER w AS c
  FROM events WINDOW w AS (ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING))
SELECT ordinal, event_id, total_documents, round(c, 6) AS cumulative, round(c, 6) / ordinal AS running_mean FROM t
WHERE ordinal = total_documents OR ordinal % CASE WHEN total_documents <= 50 THEN 10 WHEN total_documents <= 200 THEN 25
  WHEN total_documents <= 500 THEN 50 WHEN total_documents <= 1000 THEN 100 ELSE 250 END = 0"""


def _measured(kind: str) -> str:
    return f"avg(value) FILTER (event_type = '{kind}')"


SUMMARY = f"""
e AS (SELECT 'user ' || user_id AS query, event_id, event_type, value, json_extract_string(props, '$.k')::BIGINT AS k FROM events),
g AS (SELECT query, count(*) AS num_runs, avg(k) AS emb, {_measured('view')} AS c, {_measured('signup')} AS cs, {_measured('purchase')} AS cq,
  {_measured('click')} AS f, {_measured('error')} AS fq, arg_min(k, event_id) AS docs FROM e GROUP BY query),
s AS (SELECT query, (SELECT count(*) FROM documents) AS corpus_size, 5::BIGINT AS k, num_runs, emb AS embedding_time_ms,
  c AS cluster_aware_latency_ms, cs AS cluster_selection_ms, cq AS cluster_faiss_search_ms, docs AS cluster_aware_docs_searched,
  f AS flat_latency_ms, fq AS flat_faiss_search_ms, 100::BIGINT AS flat_docs_searched,
  coalesce(f / nullif(c, 0), 0) AS speedup, f - c AS latency_diff_ms, (1 - docs / 100.0::DOUBLE) * 100 AS search_space_reduction_pct FROM g)"""
_TIMES = (
    "embedding_time_ms cluster_aware_latency_ms cluster_selection_ms cluster_faiss_search_ms flat_latency_ms flat_faiss_search_ms "
    "speedup latency_diff_ms search_space_reduction_pct"
).split()
ORACLES["experiment_summary"] = f"""
WITH {SUMMARY} SELECT query, corpus_size, k, num_runs, cluster_aware_docs_searched, flat_docs_searched,
  {', '.join(f'round({c}, 6) AS {c}' for c in _TIMES)} FROM s"""
ORACLES["experiment_batch"] = f"""
WITH {SUMMARY} SELECT count(*) AS queries, round(avg(cluster_aware_latency_ms), 6) AS cluster_mean_ms,
  round(stddev_pop(cluster_aware_latency_ms), 6) AS cluster_std_ms, round(avg(flat_latency_ms), 6) AS flat_mean_ms,
  round(stddev_pop(flat_latency_ms), 6) AS flat_std_ms, round(avg(speedup), 6) AS speedup_mean, round(min(speedup), 6) AS speedup_min,
  round(max(speedup), 6) AS speedup_max, round(avg(search_space_reduction_pct), 6) AS reduction_mean_pct,
  CASE WHEN avg(speedup) > 1.5 THEN 'significant' ELSE 'modest' END AS verdict FROM s"""
ORACLES["latency_breakdown"] = f"""
WITH {SUMMARY} SELECT 'cluster_aware' AS method, round(avg(embedding_time_ms), 6) AS embedding, round(avg(cluster_selection_ms), 6) AS cluster_selection,
  round(avg(cluster_faiss_search_ms), 6) AS search FROM s
UNION ALL SELECT 'flat', round(avg(embedding_time_ms), 6), 0.0::DOUBLE, round(avg(flat_faiss_search_ms), 6) FROM s"""
SCALING = """
r AS (SELECT (1 << (user_id % 4)::INT)::BIGINT AS num_workers, count(*) AS num_documents, sum(value) AS t FROM events GROUP BY 1),
b AS (SELECT min(t) AS b FROM r WHERE num_workers = 1),
a AS (SELECT num_workers, num_documents, t, b / t AS speedup, b / t / num_workers AS efficiency, (1 - t / b) * 100 AS red,
  (num_workers - b / t) / num_workers * 100 AS over FROM r, b)"""
ORACLES["scaling_analysis"] = f"""
WITH {SCALING} SELECT num_workers, num_documents, round(t, 6) AS total_time_sec, round(speedup, 6) AS speedup, round(efficiency, 6) AS efficiency,
  round(red, 6) AS time_reduction_pct, round(over, 6) AS overhead_pct FROM a"""
ORACLES["scaling_summary"] = f"""
WITH {SCALING} SELECT (SELECT num_workers FROM a ORDER BY speedup DESC, num_workers LIMIT 1) AS optimal_workers, max(num_workers) AS max_workers,
  arg_max(over, num_workers) < 50 AS overhead_ok, round(max(speedup), 6) AS max_speedup, round(max(efficiency), 6) AS best_efficiency,
  round(arg_max(red, num_workers), 6) AS total_reduction_pct, round(arg_max(over, num_workers), 6) AS overhead_pct FROM a"""
ORACLES["latest_wins"] = """
SELECT user_id, event_id, event_type, value FROM
  (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1"""

ORACLES["kmeans_cluster"] = """
SELECT count(*) AS points, 0::BIGINT AS clusters_out_of_range, true AS clusters_at_most_k, true AS cost_not_above_one_cluster,
  0::BIGINT AS not_nearest FROM embeddings"""
ORACLES["kmeans_documents"] = f"""
WITH {RAW_DOCS} SELECT count(*) AS points, 0::BIGINT AS clusters_out_of_range, true AS clusters_at_most_k, true AS cost_not_above_one_cluster,
  0::BIGINT AS not_nearest FROM docs"""
ORACLES["corpus_roundtrip"] = f"""
SELECT doc_id::VARCHAR AS doc_id, text, n_chars AS word_count, 0.5::DOUBLE AS processing_time FROM documents WHERE {NOT_BLANK}"""
_FILES = f"(SELECT doc_id, {STRIP % 'text'} AS text FROM documents)"
ORACLES["files_roundtrip"] = f"""
SELECT d.doc_id, '.txt' AS format, d.text AS raw_text, c.text, {WORDS % 'd.text'} AS word_count
FROM {_FILES} d JOIN ({ORACLES["clean_text"]}) c ON c.doc_id = d.doc_id"""
ORACLES["files_stream"] = ORACLES["files_roundtrip"]
ORACLES["stream_latest"] = "SELECT doc_id, length(text) AS n_chars FROM documents"
ORACLES["store_upsert"] = ORACLES["latest_wins"]
ORACLES["stream_progress"] = "SELECT 8 AS batches, count(*) AS processed, 0 AS waiting, count(*) AS total FROM documents"
ORACLES["stream_batches"] = "SELECT doc_id, length(text) AS n_chars, true AS sound FROM documents"
ORACLES["corpus_rejects"] = """
SELECT kind, count(doc_id) AS lines FROM (SELECT unnest(['kept', 'blank', 'bad']) AS kind) LEFT JOIN
  (SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN 'bad' WHEN doc_id % 5 = 0 OR NOT regexp_matches(text, '\\S') THEN 'blank' ELSE 'kept' END AS kind FROM documents)
  USING (kind) GROUP BY kind"""
