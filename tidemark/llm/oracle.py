"""DuckDB SQL for the results of the queries that SQL can express."""

from __future__ import annotations

_WORDS = r"""list_filter(string_split_regex({text}, '[\x20\x09-\x0D]+'), lambda x: x <> '')"""
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_OP5 = f"""
WITH RECURSIVE split AS (SELECT doc_id, {_WORDS.format(text=_LOWER)} AS w FROM documents),
grams AS (
  SELECT DISTINCT doc_id, list_aggregate(list_slice(w, i, i + 3), 'string_agg', ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM split WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS m
  FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * m >= 85 * (x.n + y.n - m)),
reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b)
SELECT d.doc_id, coalesce(s.n, 0)::BIGINT AS n_shingles, r.component_id
FROM documents d LEFT JOIN sizes s USING (doc_id)
JOIN (SELECT a, min(b) AS component_id FROM reach GROUP BY a) r ON r.a = d.doc_id
"""

_OP8 = """
WITH bytes AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
cuts AS (
  SELECT doc_id, c, substr(h, 2 * c + 1, 1398) AS s, least(500, len(h) // 2 - 199 - c) AS n
  FROM (SELECT doc_id, h, unnest(range(0, greatest(len(h) // 2 - 199, 0), 500)) AS c FROM bytes)),
strings AS (
  SELECT doc_id, c + j AS i, hash(substr(s, 2 * j + 1, 400)) AS g FROM (SELECT doc_id, c, s, unnest(range(0, n)) AS j FROM cuts)),
twice AS (SELECT g FROM strings GROUP BY g HAVING count(*) > 1),
hits AS (SELECT doc_id, i FROM strings JOIN twice USING (g)),
begun AS (
  SELECT doc_id, i, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 200 THEN 0 ELSE 1 END AS new FROM hits),
numbered AS (SELECT doc_id, i, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM begun),
runs AS (SELECT doc_id, min(i) AS a, max(i) + 200 AS b FROM numbered GROUP BY doc_id, run),
kept AS (
  SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS before FROM runs),
rest AS (
  SELECT k.doc_id, sum(b - a)::BIGINT AS n_removed, count(*) AS n_spans, max(b) AS ending,
         string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) AS head
  FROM kept k JOIN bytes USING (doc_id) GROUP BY k.doc_id)
SELECT d.doc_id, (len(h) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
       sha256(unhex(coalesce(head || substr(h, 2 * ending + 1), h))) AS kept_sha256
FROM bytes d LEFT JOIN rest USING (doc_id)
"""

_OP11 = """
WITH r AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, r.vec_id AS other, a.label = r.label AS same, list_dot_product(a.v, r.v)::BIGINT AS score
  FROM r a JOIN r ON a.vec_id <> r.vec_id WHERE a.vec_id % 100 = 0),
p AS (
  SELECT anchor_id, other AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5),
n AS (
  SELECT anchor_id, positive_id, positive_score, other AS negative_id, score AS negative_score,
         row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other) AS rank
  FROM p JOIN s USING (anchor_id)
  WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10
"""

# Bytes of the id, each followed by eight steps of the checksum (-1).
_CRC32 = """xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(
  string_split(doc_id::VARCHAR, ''), lambda c: list_prepend(ascii(c)::BIGINT, list_transform(range(8), lambda i: -1::BIGINT))))),
  lambda x, y: CASE WHEN y >= 0 THEN xor(x, y) ELSE xor(x >> 1, (x % 2) * 3988292384) END))"""

_OP12 = f"""
WITH split AS (SELECT doc_id, {_WORDS.format(text="coalesce(text, '')")} AS w, {_CRC32} AS h FROM documents),
dealt AS (
  SELECT doc_id, w, h % 10 = 0 AND len(w) > 0 AS tail, (h // 10) % greatest(len(w), 1) AS a, h // 10 AS g, len(w) AS n FROM split),
texts AS (
  SELECT doc_id, n, CASE WHEN tail THEN list_transform(range(0, n), lambda i:
    w[(CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // (3 + g % 8)) END) + 1]) ELSE w END AS w FROM dealt),
tokens AS (SELECT doc_id, n, unnest(w) AS word, unnest(range(0, n)) AS i FROM texts),
pairs AS (
  SELECT x.doc_id, x.i, y.i - x.i AS p FROM tokens x JOIN tokens y
  ON x.doc_id = y.doc_id AND x.word = y.word AND y.i > x.i AND 3 * (y.i - x.i) <= x.n),
numbered AS (SELECT doc_id, i, p, i - row_number() OVER (PARTITION BY doc_id, p ORDER BY i) AS part FROM pairs),
stretches AS (
  SELECT doc_id, p, min(i) AS a, max(i) + 1 + p AS b FROM numbered
  GROUP BY doc_id, p, part HAVING max(i) + 1 + p - min(i) >= greatest(24, 3 * p)),
runs AS (SELECT doc_id, a AS start, b - a AS length, min(p) AS period FROM stretches GROUP BY doc_id, a, b),
listed AS (
  SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS every FROM runs GROUP BY doc_id),
best AS (
  SELECT * FROM runs QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY length::DOUBLE / period DESC, start, period) = 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM runs),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS words FROM tokens t
  WHERE NOT EXISTS (SELECT 1 FROM gone g WHERE g.doc_id = t.doc_id AND g.i = t.i) GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, start::BIGINT AS start, length::BIGINT AS length, period::BIGINT AS period,
       (1000 * length // period)::BIGINT AS exponent_milli, sha256(coalesce(every, '')) AS runs_sha256, sha256(coalesce(words, '')) AS collapsed_sha256
FROM documents d LEFT JOIN listed USING (doc_id) LEFT JOIN best USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

_OP13 = f"""
WITH split AS (SELECT doc_id, {_WORDS.format(text="coalesce(text, '')")} AS w FROM documents),
windows AS (
  SELECT doc_id, i, hash(list_slice(w, i + 1, i + 35)) AS g FROM (SELECT doc_id, w, unnest(range(0, greatest(len(w) - 34, 0))) AS i FROM split)),
twice AS (SELECT g FROM windows GROUP BY g HAVING count(*) > 1),
hits AS (SELECT doc_id, i FROM windows JOIN twice USING (g)),
begun AS (
  SELECT doc_id, i, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 35 THEN 0 ELSE 1 END AS new FROM hits),
numbered AS (SELECT doc_id, i, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM begun),
runs AS (SELECT doc_id, min(i) AS a, max(i) + 35 AS b FROM numbered GROUP BY doc_id, run),
kept AS (SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS before FROM runs),
rest AS (
  SELECT k.doc_id, sum(b - a)::BIGINT AS n_removed, max(b) AS ending, flatten(list(list_slice(w, before + 1, a) ORDER BY a)) AS head
  FROM kept k JOIN split USING (doc_id) GROUP BY k.doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed,
       sha256(array_to_string(CASE WHEN head IS NULL THEN w ELSE list_concat(head, list_slice(w, ending + 1, len(w))) END, ' ')) AS kept_sha256
FROM split d LEFT JOIN rest USING (doc_id)
"""

ORACLES: dict[str, str] = {
    "op5_ngram_join": _OP5,
    "op8_repeats": _OP8,
    "op11_hard_negatives": _OP11,
    "op12_periodic_runs": _OP12,
    "op13_substring_dedup": _OP13,
}
