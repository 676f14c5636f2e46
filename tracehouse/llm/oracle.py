"""The numbered queries in DuckDB's SQL, where SQL can express them."""

from __future__ import annotations

from tracehouse.llm import line_quality as lq
from tracehouse.llm import secret_scan as ss

ORACLE: dict[str, str] = {}

_WORDS = r"list_filter(string_split_regex({}, '[\x20\x09-\x0D]+'), lambda x: x <> '')"
_TEXTS = f"SELECT doc_id, coalesce(text, '') AS t, {_WORDS.format("coalesce(text, '')")} AS w FROM documents"

# transitive closure of the links e(a, b), both ways, over the ids n(a)
_COMPONENTS = """
reach AS (
  SELECT a, a AS b FROM n
  UNION
  SELECT reach.a, e.b FROM reach JOIN e ON reach.b = e.a
),
component AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)"""

ORACLE["op2_near_duplicates"] = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, {_WORDS.format("translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS w
  FROM documents
),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE
    WHEN len(w) >= 2 THEN list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])
    WHEN len(w) = 1 THEN [w[1]] ELSE []::VARCHAR[] END) AS x
  FROM d
),
c AS (SELECT doc_id, count(*) AS k FROM s GROUP BY doc_id),
p AS (
  SELECT l.doc_id AS a, r.doc_id AS b, count(*) AS both_
  FROM s l JOIN s r ON l.x = r.x AND l.doc_id < r.doc_id GROUP BY ALL
),
e1 AS (
  SELECT p.a, p.b FROM p JOIN c ca ON ca.doc_id = p.a JOIN c cb ON cb.doc_id = p.b
  WHERE 100 * both_ >= 80 * (ca.k + cb.k - both_)
),
e AS (SELECT a, b FROM e1 UNION ALL SELECT b, a FROM e1),
n AS (SELECT doc_id AS a FROM documents),
{_COMPONENTS}
SELECT d.doc_id, coalesce(c.k, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM d LEFT JOIN c USING (doc_id) JOIN component ON component.a = d.doc_id"""

ORACLE["op3_substrings"] = f"""
WITH d AS ({_TEXTS}),
win AS (
  SELECT doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS h
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d)
),
first_ AS (SELECT h, min(doc_id) AS lo FROM win GROUP BY h),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS j FROM win JOIN first_ USING (h) WHERE lo < doc_id
),
word AS (SELECT doc_id, unnest(w) AS x, generate_subscripts(w, 1) AS j FROM d),
kept AS (
  SELECT doc_id, string_agg(x, ' ' ORDER BY j) AS k
  FROM word ANTI JOIN gone USING (doc_id, j) GROUP BY doc_id
),
lost AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n, 0) AS n_removed, sha256(coalesce(k, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id) LEFT JOIN lost USING (doc_id)"""

_LESS = "length({0}) - length(regexp_replace({0}, '{1}', '', 'g'))"
ORACLE["op4_line_quality"] = rf"""
WITH d AS ({_TEXTS}),
l AS (
  SELECT doc_id, x, length(regexp_replace(x, '[\x20\x09-\x0D]', '', 'g')) AS packed,
    len({_WORDS.format("x")}) AS n,
    {_LESS.format("x", "[#*$%&|<>]")} AS symbols, {_LESS.format("x", "!")} AS loud, {_LESS.format("x", "[|»›•]")} AS cuts
  FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS x FROM d)
  WHERE regexp_matches(x, '[^\x20\x09-\x0D]')
),
lines AS (
  SELECT doc_id, count(*) - count(DISTINCT x) AS n_dup_lines,
    coalesce(sum(packed) FILTER (WHERE
      symbols * 100 > packed * {lq.MAX_SYMBOLS} OR loud * 100 > n * {lq.MAX_EXCLAMATIONS}
      OR (cuts >= 3 AND cuts * 100 > n * {lq.MAX_SEPARATORS})
      OR (n >= {lq.LOUD_WORDS} AND regexp_matches(x, '\p{{Lu}}') AND NOT regexp_matches(x, '\p{{Ll}}'))
      OR (n <= {lq.SHORT_LINE} AND regexp_matches(x, '{lq.BOILERPLATE_PATTERN}'))), 0) AS lost
  FROM l GROUP BY doc_id
),
win AS (
  SELECT doc_id, i, array_to_string(w[i:i + 4], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM d)
),
again AS (
  SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS j
  FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, s) AS c FROM win) WHERE c > 1
),
repeated AS (SELECT doc_id, sum(least(5, coalesce(j - i, 5))) AS n FROM again GROUP BY doc_id),
base AS (
  SELECT doc_id, len(w) AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
    {_LESS.format("t", "[#*$%&|<>]")} AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
    coalesce(repeated.n, 0)::BIGINT AS n_repeat_words, coalesce(lost, 0) AS lost
  FROM d LEFT JOIN lines USING (doc_id) LEFT JOIN repeated USING (doc_id)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < {lq.MIN_WORDS} OR 100 * n_repeat_words > {lq.MAX_REPEATED} * n_words AS base_failed,
  NOT (n_words < {lq.MIN_WORDS} OR 100 * n_repeat_words > {lq.MAX_REPEATED} * n_words)
    AND NOT (lost * 100 > word_chars * {lq.MAX_LOST}) AS kept
FROM base"""


def _either_case(word: str) -> str:
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)


_KEYS = "|".join(_either_case(w) for w in ("password", "passwd", "secret", "token", "api_?key"))
_ASSIGN = rf"({_KEYS})[\"'']?\x20*[:=]\x20*[\"'']?([A-Za-z0-9+/_.=-]+)"
_RUN = "[A-Za-z0-9+/_=-]{20,}"
ORACLE["op7_secret_scan"] = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
p(k, kind, re, g, least_) AS (VALUES
  (0, 'assign', '{_ASSIGN}', 2, {ss.MIN_ASSIGNED}), (1, 'access', '{ss.ACCESS}', 0, {ss.MIN_ACCESS}),
  (2, 'hex', '{ss.HEX}', 0, {ss.MIN_HEX}), (3, 'entropy', '{_RUN}', 0, 0)),
m AS (
  SELECT doc_id, 0 AS k, regexp_extract_all(t, '{_ASSIGN}') AS f, regexp_extract_all(t, '{_ASSIGN}', 2) AS v,
    string_split_regex(t, '{_ASSIGN}') AS g FROM d
  UNION ALL SELECT doc_id, 1, regexp_extract_all(t, '{ss.ACCESS}') AS f, f, string_split_regex(t, '{ss.ACCESS}') FROM d
  UNION ALL SELECT doc_id, 2, regexp_extract_all(t, '{ss.HEX}') AS f, f, string_split_regex(t, '{ss.HEX}') FROM d
  UNION ALL SELECT doc_id, 3, regexp_extract_all(t, '{_RUN}') AS f, f, string_split_regex(t, '{_RUN}') FROM d
),
x AS (
  SELECT doc_id, k, unnest(f) AS hit, unnest(v) AS v, unnest(g[1:len(f)]) AS gap, generate_subscripts(f, 1) AS i
  FROM m WHERE len(f) > 0
),
placed AS (
  SELECT *, sum(length(gap) + length(hit)) OVER (PARTITION BY doc_id, k ORDER BY i)::BIGINT AS e, e - length(hit) AS s
  FROM x
),
base AS (SELECT placed.* FROM placed JOIN p USING (k) WHERE k < 3 AND length(v) >= least_),
more AS (
  SELECT * FROM placed o
  WHERE k = 3 AND regexp_matches(hit, '[0-9]') AND regexp_matches(hit, '[A-Za-z]') AND NOT regexp_matches(hit, '{ss.UUID}')
    AND list_max(list_transform(range(1, length(hit) - {ss.ENTROPY_WINDOW - 2}),
      lambda j: list_entropy(string_split(substring(hit, j, {ss.ENTROPY_WINDOW}), '')))) >=
      CASE WHEN regexp_full_match(hit, '[0-9a-f]+|[0-9A-F]+') THEN {ss.HEX_BITS}
        WHEN regexp_matches(hit, '[0-9]') AND regexp_matches(hit, '[A-Z]') AND regexp_matches(hit, '[a-z]')
        THEN {ss.ALL_CLASSES_BITS} ELSE {ss.MIXED_BITS} END
    AND NOT EXISTS (SELECT 1 FROM base b WHERE b.doc_id = o.doc_id AND b.s <= o.s AND o.e <= b.e)
),
r AS (
  SELECT doc_id, k, s, kind || ':' || s || ':' || e AS a FROM (FROM base UNION ALL FROM more) JOIN p USING (k)
),
f AS (
  SELECT doc_id, count(*) FILTER (WHERE k = 0) AS n_assign, count(*) FILTER (WHERE k = 1) AS n_access,
    count(*) FILTER (WHERE k = 2) AS n_hex, string_agg(a, ',' ORDER BY s, k) FILTER (WHERE k < 3) AS base_,
    string_agg(a, ',' ORDER BY s, k) AS spans FROM r GROUP BY doc_id
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base_, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN f USING (doc_id)"""

ORACLE["op9_embedding_groups"] = f"""
WITH RECURSIVE v AS (SELECT vec_id, embedding::DOUBLE[] AS x FROM embeddings),
e AS (
  SELECT l.vec_id AS a, r.vec_id AS b FROM v l JOIN v r ON l.vec_id <> r.vec_id
  WHERE list_cosine_similarity(l.x, r.x) >= 0.9
),
n AS (SELECT vec_id AS a FROM v),
{_COMPONENTS},
k AS (SELECT a, count(*) AS n_links FROM e GROUP BY a)
SELECT v.vec_id, coalesce(n_links, 0) AS n_links, component_id, v.vec_id = component_id AS kept
FROM v LEFT JOIN k ON k.a = v.vec_id JOIN component ON component.a = v.vec_id"""

# crc32 of the id's decimal digits: a byte is added, and eight steps divide by the fixed polynomial
_CRC32 = """
xor(list_reduce(
  list_concat([4294967295::BIGINT], flatten(list_transform(string_split(doc_id::VARCHAR, ''),
    lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
  lambda r, x: CASE WHEN x >= 0 THEN xor(r, x) WHEN r % 2 = 1 THEN xor(r // 2, 3988292384) ELSE r // 2 END),
  4294967295)"""

# All pairs of equal 5-grams of a text, up to a quarter of it apart, as islands on their diagonals. A stretch whose period
# is a multiple of a smaller one of a stretch around it is no run.
ORACLE["op12_periodic_runs"] = rf"""
WITH h AS (SELECT doc_id, t, w, len(w) AS n, {_CRC32} AS h FROM ({_TEXTS})),
g AS (SELECT *, h // 10 AS g, CASE WHEN n > 0 THEN (h // 10) % n END AS a FROM h),
p AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM g),
d AS (
  SELECT doc_id, n, CASE WHEN h % 10 = 0 AND n > 0
    THEN list_transform(range(0, n), lambda i: w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % p END]) ELSE w END AS w
  FROM p
),
gram AS (
  SELECT doc_id, n, i, md5(array_to_string(w[i + 1:i + 5], ' ')) AS x
  FROM (SELECT doc_id, n, w, unnest(range(0, n - 4)) AS i FROM d)
),
pair AS (
  SELECT l.doc_id, l.i, r.i - l.i AS q FROM gram l JOIN gram r
  ON l.doc_id = r.doc_id AND l.x = r.x AND l.i < r.i AND 4 * (r.i - l.i) <= l.n
),
island AS (SELECT doc_id, q, i, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS k FROM pair),
stretch AS (SELECT doc_id, q, min(i) AS s, count(*) + 4 + q AS l FROM island GROUP BY doc_id, q, k),
long_ AS (SELECT * FROM stretch WHERE l >= greatest(6, 4 * q)),
run AS (
  SELECT * FROM long_ a WHERE NOT EXISTS (
    SELECT 1 FROM long_ b WHERE a.doc_id = b.doc_id AND b.q < a.q AND a.q % b.q = 0 AND b.s <= a.s AND b.s + b.l >= a.s + a.l)
),
best AS (
  SELECT doc_id, s, l, q FROM run
  QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY l::DOUBLE / q DESC, s, q) = 1
),
lines AS (
  SELECT doc_id, count(*) AS n_runs, string_agg(s || ',' || l || ',' || q || chr(10), '' ORDER BY s, q) AS x
  FROM run GROUP BY doc_id
),
gone AS (SELECT DISTINCT doc_id, unnest(range(s + q, s + l)) AS i FROM run),
word AS (SELECT doc_id, unnest(w) AS x, generate_subscripts(w, 1) - 1 AS i FROM d),
kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY i) AS x FROM word ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_runs, 0) AS n_runs, s AS start, l AS length, q AS period, 1000 * l // q AS exponent_milli,
  sha256(coalesce(lines.x, '')) AS runs_sha256, sha256(coalesce(kept.x, '')) AS collapsed_sha256
FROM d LEFT JOIN best USING (doc_id) LEFT JOIN lines USING (doc_id) LEFT JOIN kept USING (doc_id)"""

ORACLE["op13_hard_negatives"] = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS x
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
score AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
    list_sum(list_transform(range(1, len(a.x) + 1), lambda i: a.x[i] * b.x[i]))::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
),
positive AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM score WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, positive_id,
  (row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id))::INTEGER AS rank,
  vec_id AS negative_id, positive_score, score AS negative_score
FROM positive p JOIN score s ON p.anchor_id = s.anchor_id AND NOT same
  AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10"""
