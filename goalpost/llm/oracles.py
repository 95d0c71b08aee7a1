"""DuckDB SQL for the queries of this subpackage that SQL can express."""

from __future__ import annotations

_WORDS = r"""list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')"""

OP1 = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
    ELSE list_distinct(list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i+3], ' '))) END AS sh
  FROM w),
k AS (SELECT doc_id, len(sh) AS n, CASE WHEN len(sh) > 0 THEN md5(array_to_string(list_sort(sh), chr(10))) END AS sig
  FROM s),
reps AS (SELECT sig, min(doc_id) AS rep, any_value(n) AS n FROM k WHERE sig IS NOT NULL GROUP BY sig),
tok AS (SELECT r.rep, r.n, unnest(s.sh) AS t FROM reps r JOIN s ON s.doc_id = r.rep),
p AS (SELECT a.rep AS a, b.rep AS b FROM tok a JOIN tok b
        ON a.t = b.t AND a.rep < b.rep AND 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n)
      GROUP BY a.rep, b.rep, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
e AS (SELECT a, b FROM p UNION ALL SELECT b, a FROM p),
reach(a, b) AS (SELECT rep, rep FROM reps UNION SELECT reach.a, e.b FROM reach JOIN e ON reach.b = e.a),
comp AS (SELECT a, min(b) AS root FROM reach GROUP BY a)
SELECT k.doc_id, CAST(k.n AS BIGINT) AS n_shingles, coalesce(comp.root, k.doc_id) AS component_id
FROM k LEFT JOIN reps USING (sig) LEFT JOIN comp ON comp.a = reps.rep
"""


def op7(rounds: int, steps: int, flatten: float, fraction: float, seed: int) -> str:
    """The raking written out, one table a step."""
    sql = [rf"""rows_ AS (SELECT doc_id, source, lang,
  CASE WHEN length(coalesce(text, '')) = 0 THEN 'empty' WHEN contains(text, ' | ') THEN 'table'
       WHEN contains(text, '!! ') THEN 'shout'
       WHEN contains(text, '&&& ') OR contains(text, '### ') THEN 'symbols' ELSE 'prose' END AS topic,
  CAST(len({_WORDS}) AS BIGINT) AS n_tokens,
  CAST(CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR) || ':{seed}'), 1, 13) AS BIGINT) AS DOUBLE) / 4503599627370496
    AS u FROM documents)""",
           "c0 AS (SELECT source, lang, topic, sum(n_tokens) AS n, CAST(sum(n_tokens) AS DOUBLE) AS w "
           "FROM rows_ GROUP BY ALL)"]
    for k in ("source", "lang", "topic"):
        sql.append(f"t_{k} AS (SELECT {k}, pow(CAST(sum(n) AS DOUBLE), {flatten}) AS target FROM c0 "
                   f"GROUP BY {k} HAVING sum(n) > 0)")
        sql.append(f"g_{k} AS MATERIALIZED (SELECT {k}, target / (SELECT sum(target) FROM t_{k}) "
                   f"* (SELECT sum(w) FROM c0) AS goal FROM t_{k})")
    i = 0
    for _ in range(rounds):
        for k in ("source", "lang", "topic"):
            sql.append(f"c{i + 1} AS MATERIALIZED (SELECT c.source, c.lang, c.topic, c.n, c.w * CASE WHEN h.have > 0 "
                       f"THEN coalesce(g.goal, 0) / h.have ELSE 0 END AS w FROM c{i} c "
                       f"JOIN (SELECT {k}, sum(w) AS have FROM c{i} GROUP BY {k}) h "
                       f"ON c.{k} IS NOT DISTINCT FROM h.{k} "
                       f"LEFT JOIN g_{k} g ON c.{k} IS NOT DISTINCT FROM g.{k})")
            i += 1
    sql.append(f"r AS MATERIALIZED (SELECT *, CASE WHEN n > 0 THEN w / n ELSE 0 END AS ratio FROM c{i})")
    sql.append(f"s0 AS (SELECT CAST({fraction} AS DOUBLE) AS c)")
    for j in range(steps):
        sql.append(f"s{j + 1} AS MATERIALIZED (SELECT CASE WHEN coalesce(sum(CASE WHEN ratio * c < 1 THEN w END), 0) = 0 "
                   f"THEN any_value(c) ELSE greatest(0, ({fraction} * sum(n) - coalesce(sum(CASE WHEN ratio * c >= 1 "
                   f"THEN n END), 0)) / sum(CASE WHEN ratio * c < 1 THEN w END)) END AS c FROM r, s{j})")
    return ("WITH " + ",\n".join(sql) + f"""
SELECT d.doc_id, d.source, d.lang, d.topic, d.n_tokens, round(least(1.0, r.ratio * s{steps}.c), 6) AS probability,
  d.u < round(least(1.0, r.ratio * s{steps}.c), 6) AS sampled
FROM rows_ d JOIN r ON d.source IS NOT DISTINCT FROM r.source AND d.lang IS NOT DISTINCT FROM r.lang
  AND d.topic = r.topic, s{steps}""")


_VECTORS = """SELECT vec_id, label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
  FROM embeddings WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"""

OP12 = f"""
WITH v AS ({_VECTORS}),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS BIGINT) AS rank, vec_id, score FROM r WHERE rank <= 5
"""

OP13 = f"""
WITH v AS (SELECT vec_id, e, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label
  FROM ({_VECTORS}) WHERE label IS NOT NULL),
s AS (SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, CAST(list_dot_product(a.e, c.e) AS BIGINT) AS score
  FROM v a JOIN v c ON a.vec_id <> c.vec_id WHERE a.vec_id % 100 = 0),
p AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS place
  FROM s WHERE same) WHERE place <= 5),
n AS (SELECT p.anchor_id, p.vec_id AS positive_id, s.vec_id AS negative_id, p.score AS positive_score,
    s.score AS negative_score,
    row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY s.score DESC, s.vec_id) AS rank
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
    AND 80 * p.score <= 100 * s.score AND 100 * s.score <= 100 * p.score)
SELECT anchor_id, positive_id, CAST(rank AS BIGINT) AS rank, negative_id, positive_score, negative_score
FROM n WHERE rank <= 5
"""
