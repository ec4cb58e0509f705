"""SQL for the queries that SQL can express, written independently of the operators."""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _words(text: str) -> str:
    pattern = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    return f"regexp_extract_all(translate(coalesce({text}, ''), '{_UPPER}', '{_LOWER}'), '{pattern}')"


OP4 = f"""
WITH d AS (SELECT doc_id, {_words('text')} AS w FROM documents),
items AS (SELECT item_id, {_words('text')} AS w FROM benchmark),
wins AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS n,
         array_to_string(w[k : k + least(len(w), 13) - 1], ' ') AS phrase
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 13, 0) + 2)) AS k FROM items WHERE len(w) > 0)),
places AS (
  SELECT doc_id, n, k, array_to_string(w[k : k + n - 1], ' ') AS phrase
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS k
        FROM d, (SELECT DISTINCT n FROM wins) WHERE len(w) >= n)),
found AS (SELECT doc_id, k, n, item_id FROM places JOIN wins USING (n, phrase)),
hit AS (SELECT doc_id, count(DISTINCT place) AS n_hit
        FROM (SELECT doc_id, unnest(range(k, k + n)) AS place FROM found) GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(name, ',' ORDER BY name) AS names
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS name FROM found) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)
"""

OP10 = """
WITH v AS (
  SELECT row_number() OVER () AS k, vec_id,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (
  SELECT a.k, a.vec_id AS query_id, b.vec_id,
         CAST(list_sum(list_transform(range(1, len(a.q) + 1), lambda i: a.q[i] * b.q[i])) AS BIGINT) AS score
  FROM v a JOIN v b ON len(a.q) = len(b.q) AND a.k <> b.k WHERE a.vec_id % 50 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY k ORDER BY score DESC, vec_id) AS rank FROM pairs)
WHERE rank <= 5
"""


def _mix_rounds(rounds: int) -> str:
    """Rounds of the mix: what is left goes, in the order of hashes, to documents not taken yet that fit into it."""
    steps, chosen = "", "false"
    for k in range(rounds):
        rows = "e" if k == 0 else f"t{k - 1}"
        fits = "size > 0" if k == 0 else f"NOT ({chosen}) AND size > 0 AND size <= left{k}"
        left = "left0" if k == 0 else f"left{k}"
        chosen = f"{chosen} OR in{k}"
        steps += f""",
c{k} AS (
  SELECT *, CASE WHEN {fits} THEN sum(CASE WHEN {fits} THEN size ELSE 0 END)
    OVER (PARTITION BY key ORDER BY h, rid ROWS UNBOUNDED PRECEDING) END AS cum{k} FROM {rows}),
m{k} AS (SELECT *, coalesce(cum{k} <= {left}, false) AS in{k} FROM c{k}),
t{k} AS (
  SELECT *, {left} - coalesce(sum(CASE WHEN in{k} THEN size ELSE 0 END) OVER (PARTITION BY key), 0) AS left{k + 1} FROM m{k})"""
    return steps + f"""
SELECT doc_id, size, source_size, target,
       CAST(size * (passes + CASE WHEN {chosen} THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM t{rounds - 1}"""


OP13 = r"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS rid, CASE WHEN source IS NULL THEN '1' ELSE '0' || source END AS key,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '-') || ':' || md5(coalesce(text, ''))), 1, 15) AS BIGINT) AS h
  FROM documents),
per AS (
  SELECT key, CAST(sum(size) AS BIGINT) AS source_size, [5, 2, 1][1 + (row_number() OVER (ORDER BY key) - 1) % 3] AS w
  FROM d GROUP BY key),
ordered AS (
  SELECT *, 3.0 * CAST(source_size AS DOUBLE) / w AS ratio,
         row_number() OVER (ORDER BY 3.0 * CAST(source_size AS DOUBLE) / w, key) AS k FROM per),
levels AS (
  SELECT *, CAST(sum(source_size) OVER () - 3 * coalesce(sum(source_size)
              OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE)
            / CAST(sum(w) OVER (ORDER BY k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS DOUBLE) AS level
  FROM ordered),
best AS (SELECT coalesce(arg_min(level, k), 0) AS level FROM levels WHERE 3 * source_size > level * w),
t AS (SELECT key, source_size, least(CAST(3 * source_size AS DOUBLE), (SELECT level FROM best) * w) AS target FROM per),
p AS (
  SELECT *, CASE WHEN source_size > 0 THEN least(3, CAST(floor(target / source_size) AS BIGINT)) ELSE 0 END AS passes
  FROM t),
e AS (
  SELECT doc_id, rid, key, size, h, source_size, target, passes,
         CASE WHEN passes < 3 THEN greatest(target - passes * source_size, 0) ELSE 0 END AS left0
  FROM d JOIN p USING (key))""" + _mix_rounds(4)


OP12 = """
WITH v AS (
  SELECT row_number() OVER () AS k, vec_id,
         CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (
  SELECT a.k, a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS alike, b.k AS other,
         CAST(list_sum(list_transform(range(1, len(a.q) + 1), lambda i: a.q[i] * b.q[i])) AS BIGINT) AS score
  FROM v a JOIN v b ON len(a.q) = len(b.q) AND a.k <> b.k WHERE a.vec_id % 100 = 0),
positives AS (
  SELECT k, anchor_id, vec_id AS positive_id, score AS positive_score, place FROM (
    SELECT *, row_number() OVER (PARTITION BY k ORDER BY score DESC, vec_id, other) AS place FROM pairs WHERE alike)
  WHERE place <= 5)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM (
  SELECT p.*, n.vec_id AS negative_id, n.score AS negative_score,
         row_number() OVER (PARTITION BY p.k, place ORDER BY n.score DESC, n.vec_id, n.other) AS rank
  FROM positives p JOIN pairs n ON p.k = n.k AND NOT n.alike
   AND 30 * positive_score <= 100 * n.score AND 100 * n.score <= 90 * positive_score)
WHERE rank <= 10
"""
