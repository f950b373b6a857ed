"""DuckDB SQL for the registered queries that SQL can express."""

from __future__ import annotations

from turnspool.llm import line_dedup, quality, secrets


def text_literal(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
HAS_WORD = r"regexp_matches({0}, '[^\x20\x09-\x0D]')"


def quality_sql() -> str:
    rules = " AND ".join(
        [
            f"regexp_matches(l, {text_literal(quality.SENTENCE_END)})",
            *[
                f"NOT regexp_matches(l, {text_literal(bad)})"
                for bad in (quality.NOISE, quality.NAVIGATION, quality.BOILERPLATE)
            ],
        ]
    )
    return rf"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, {WORDS} AS w,
         string_split(coalesce(text, ''), chr(10)) AS lines
  FROM documents),
p AS (
  SELECT *, list_filter(lines, lambda l: NOT {HAS_WORD.format("l")} OR ({rules})) AS passed,
         list_filter(lines, lambda l: {HAS_WORD.format("l")}) AS worded
  FROM d),
runs AS (
  SELECT doc_id, i, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d WHERE len(w) >= 3)),
again AS (
  SELECT doc_id, i FROM (
    SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, a, b, c) AS n FROM runs) WHERE n > 1),
cover AS (
  SELECT doc_id, count(DISTINCT k) AS n FROM (
    SELECT doc_id, unnest([i, i + 1, i + 2]) AS k FROM again) GROUP BY doc_id),
base AS (
  SELECT p.doc_id,
         CAST(len(w) AS BIGINT) AS n_words,
         length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
         length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         CAST(len(worded) - len(list_distinct(worded)) AS BIGINT) AS n_dup_lines,
         coalesce(n, 0) AS n_repeat_words,
         CAST(len(worded) AS BIGINT) AS n_lines,
         CAST(len(lines) - len(passed) AS BIGINT) AS n_dropped_lines,
         length(regexp_replace(array_to_string(passed, ''), '[\x20\x09-\x0D]', '', 'g')) AS remain
  FROM p LEFT JOIN cover USING (doc_id)),
judged AS (
  SELECT *, n_words < {quality.MIN_WORDS}
         OR 100 * n_repeat_words > {quality.MAX_REPEAT_PERCENT} * n_words AS base_failed
  FROM base)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines,
       n_dropped_lines, base_failed,
       NOT base_failed AND 100 * remain >= {quality.MIN_LEFT_PERCENT} * word_chars AS kept
FROM judged
"""


def secrets_sql() -> str:
    parts = []
    for number, rule in enumerate(secrets.RULES):
        pattern = text_literal(rule.pattern)
        parts.append(f"""
  SELECT doc_id, {number} AS number, '{rule.kind}' AS kind, s AS start, s + length(whole) AS stop
  FROM (
    SELECT doc_id, whole[i] AS whole, part[i] AS part,
           list_sum(list_transform(gaps[1:i], lambda g: length(g)))
           + coalesce(list_sum(list_transform(whole[1:i - 1], lambda g: length(g))), 0) AS s
    FROM (
      SELECT doc_id, whole, part, gaps, unnest(range(1, len(whole) + 1)) AS i
      FROM (
        SELECT doc_id, regexp_extract_all(text, {pattern}, 0) AS whole,
               regexp_extract_all(text, {pattern}, {rule.group}) AS part,
               string_split_regex(text, {pattern}) AS gaps
        FROM documents WHERE regexp_matches(text, {pattern}))))
  WHERE length(part) >= {rule.least}""")
    spans = "\n  UNION ALL".join(parts)
    listed = (
        "string_agg(kind || ':' || CAST(CAST(start AS BIGINT) AS VARCHAR) || ':' "
        "|| CAST(CAST(stop AS BIGINT) AS VARCHAR), ',' ORDER BY start, number)"
    )
    return f"""
WITH s AS ({spans}),
g AS (
  SELECT doc_id,
         count(*) FILTER (number = 0) AS n_assign,
         count(*) FILTER (number = 1) AS n_access,
         count(*) FILTER (number = 2) AS n_hex,
         {listed} FILTER (number < {secrets.BASE}) AS base,
         {listed} AS spans
  FROM s GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access,
       coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256,
       coalesce(spans, '') AS spans
FROM documents d LEFT JOIN g USING (doc_id)
"""


DECONTAMINATION_SQL = r"""
WITH b AS (
  SELECT CAST(item_id AS VARCHAR) AS item_id,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
d AS (
  SELECT doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
sizes AS (SELECT DISTINCT least(10, len(w)) AS m FROM b WHERE len(w) > 0),
bw AS (
  SELECT item_id, least(10, len(w)) AS m,
         unnest(list_transform(range(1, greatest(1, len(w) - 9) + 1),
           lambda i: array_to_string(w[i:i + least(10, len(w)) - 1], ' '))) AS win
  FROM b WHERE len(w) > 0),
dw AS (
  SELECT doc_id, m, i, array_to_string(w[i:i + m - 1], ' ') AS win
  FROM (SELECT doc_id, m, w, unnest(range(1, len(w) - m + 2)) AS i
        FROM d, sizes WHERE len(w) >= m)),
hit AS (SELECT DISTINCT doc_id, dw.m AS m, i, item_id FROM dw JOIN bw USING (m, win)),
words AS (
  SELECT doc_id, count(DISTINCT k) AS n
  FROM (SELECT doc_id, unnest(range(i, i + m)) AS k FROM hit) GROUP BY doc_id),
found AS (
  SELECT doc_id, count(*) AS n, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT doc_id, item_id FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(words.n, 0) AS n_hit,
       coalesce(found.n, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(words.n, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN found USING (doc_id)
"""


NEAR_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(list_transform(range(1, greatest(1, len(w) - 4) + 1),
           lambda i: array_to_string(w[i:i + 4], ' '))) AS g
  FROM d WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS k
  FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (
  SELECT u, v FROM common JOIN n x ON x.doc_id = u JOIN n y ON y.doc_id = v
  WHERE 100 * k >= 75 * (x.n + y.n - k)),
reach AS (
  SELECT doc_id, doc_id AS r FROM d
  UNION
  SELECT links.v, reach.r FROM reach JOIN links ON links.u = reach.doc_id),
root AS (SELECT doc_id, min(r) AS component_id FROM reach GROUP BY doc_id)
SELECT doc_id, coalesce(n.n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM root LEFT JOIN n USING (doc_id)
"""

LINES_SQL = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text,
  CASE WHEN coalesce(text, '') = '' THEN [] ELSE string_split(text, chr(10)) END AS l
  FROM documents),
starts AS (SELECT doc_id, l, unnest(range(1, len(l))) AS i FROM d WHERE len(l) > 1),
runs AS (SELECT doc_id, l, i, unnest(range(i + 1, len(l) + 1)) AS j FROM starts),
later AS (
  SELECT doc_id, i, j FROM runs
  QUALIFY row_number() OVER (
    PARTITION BY array_to_string(l[i:j], chr(10)), j - i ORDER BY doc_id, i) > 1
    AND length(array_to_string(l[i:j], '')) >= {line_dedup.MIN_CHARS}),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, j + 1)) AS k FROM later),
spans AS (
  SELECT doc_id, min(k) - 1 AS a, max(k) AS b FROM (
    SELECT *, k - row_number() OVER (PARTITION BY doc_id ORDER BY k) AS span FROM gone)
  GROUP BY doc_id, span),
long AS (SELECT doc_id, list({{'a': a, 'b': b}} ORDER BY a) AS r FROM spans GROUP BY doc_id)
SELECT doc_id, CAST(len(l) AS BIGINT) AS n_lines,
  CAST(coalesce(list_sum(list_transform(r, lambda q: q.b - q.a)), 0) AS BIGINT) AS n_deleted_lines,
  coalesce(array_to_string(list_transform(r, lambda q: q.a || ':' || q.b), ','), '') AS deleted,
  sha256(CASE WHEN r IS NULL THEN text ELSE coalesce(array_to_string(
    list_transform(list_filter(range(1, len(l) + 1), lambda k:
      len(list_filter(r, lambda q: k > q.a AND k <= q.b)) = 0), lambda k: l[k]), chr(10)), '')
    END) AS clean_sha256
FROM d LEFT JOIN long USING (doc_id)
"""


SUBSTRINGS_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
x AS (
  SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d WHERE len(w) >= 13)),
copied AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY g) AS m FROM x)
  WHERE doc_id > m),
gone AS (
  SELECT doc_id, list(DISTINCT k) AS ks
  FROM (SELECT doc_id, unnest(range(i, i + 13)) AS k FROM copied) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
       CAST(coalesce(len(ks), 0) AS BIGINT) AS n_removed,
       sha256(coalesce(array_to_string(CASE WHEN ks IS NULL THEN w ELSE
         list_transform(list_sort(list_filter(range(1, len(w) + 1),
           lambda k: NOT list_contains(ks, k))), lambda k: w[k]) END, ' '), '')) AS kept_sha256
FROM d LEFT JOIN gone USING (doc_id)
"""


NEGATIVES_SQL = """
WITH points AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
         CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM points a JOIN points b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5),
negatives AS (
  SELECT anchor_id, positive_id, positive_score, other_id AS negative_id, score AS negative_score,
         row_number() OVER (
           PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id) AS rank
  FROM positives JOIN scores USING (anchor_id)
  WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score,
       negative_score
FROM negatives WHERE rank <= 10
"""


ORACLES: dict[str, str] = {
    "op11_hard_negatives": NEGATIVES_SQL,
    "op2_wu_manber": DECONTAMINATION_SQL,
    "op3_b_bit_minhash": NEAR_SQL,
    "op9_line_runs": LINES_SQL,
    "op8_seed_and_extend": SUBSTRINGS_SQL,
    "op5_line_first_cleaning": quality_sql(),
    "op6_secret_scan": secrets_sql(),
}
