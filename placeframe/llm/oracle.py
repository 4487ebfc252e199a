"""DuckDB SQL for the queries of this subpackage that SQL can express.

Not here, and held against brute force in tests/llm: op1 and op8 (trained
models), op2 (its checksum and permutation have no SQL form), op3 and op4
(merges), op5 (approximate), op9 (sampling over hashed weights).
"""

from __future__ import annotations

_PERIOD, _MOST, _FLATTEN, _BLOCK = 1000, 1 << 20, 0.9, 16

ORACLE: dict[str, str] = {
    "op6_vector_dedup": """
WITH RECURSIVE v AS (
  SELECT vec_id, embedding::DOUBLE[] AS x FROM embeddings
  WHERE len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0 AND len(list_filter(embedding, lambda e: e <> 0)) > 0
), link AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.x) = len(b.x)
  WHERE list_cosine_similarity(a.x, b.x) >= 0.9
), reach AS (
  SELECT a AS node, a AS other FROM link UNION SELECT r.node, l.b FROM reach r JOIN link l ON r.other = l.a
), least AS (SELECT node, min(other) AS component FROM reach GROUP BY node),
degree AS (SELECT a AS node, count(*) AS n FROM link GROUP BY a)
SELECT e.vec_id, coalesce(d.n, 0)::BIGINT AS n_links, coalesce(l.component, e.vec_id) AS component_id,
       e.vec_id = coalesce(l.component, e.vec_id) AS kept
FROM embeddings e LEFT JOIN degree d ON d.node = e.vec_id LEFT JOIN least l ON l.node = e.vec_id
""",
    "op7_mixing": f"""
WITH RECURSIVE r AS (
  SELECT doc_id, source, coalesce(source, '') AS s,
         row_number() OVER (PARTITION BY coalesce(source, '') ORDER BY doc_id) - 1 AS n
  FROM documents
), z AS (SELECT s, (count(*) + {_BLOCK} - 1) // {_BLOCK} AS blocks FROM r GROUP BY s),
share AS (
  SELECT s, blocks, pow(blocks, {_FLATTEN}) AS wanted, sum(pow(blocks, {_FLATTEN})) OVER () AS total,
         min(pow(blocks, {_FLATTEN})) OVER () AS least, count(*) OVER () AS sources
  FROM z
), weight AS (
  SELECT s, blocks, row_number() OVER (ORDER BY s) AS i,
         greatest(1, round(greatest({_PERIOD}, 20 * sources, least({_MOST}, ceil(total / least))) * wanted / total))::BIGINT AS a
  FROM share
), common AS (SELECT list_reduce(list(a), lambda x, y: gcd(x, y)) AS c FROM weight),
w AS (SELECT s, blocks, i, a // c AS a FROM weight, common), p AS (SELECT sum(a)::BIGINT AS period, list(a ORDER BY i) AS ws FROM w),
-- one period: in each slot the released block with the earliest deadline
turn AS (
  SELECT -1::BIGINT AS slot, list_transform(ws, lambda x: 0::BIGINT) AS done, NULL::BIGINT AS i, NULL::BIGINT AS j FROM p
  UNION ALL
  SELECT slot + 1, list_transform(range(1, len(done) + 1), lambda k: done[k] + (k = pick)::BIGINT), pick, done[pick]
  FROM (
    SELECT slot, done, list_position(due, list_min(due))::BIGINT AS pick
    FROM (
      SELECT slot, done, list_transform(range(1, len(ws) + 1), lambda k:
        CASE WHEN done[k] < ws[k] AND (done[k] * period) // ws[k] <= slot + 1
             THEN ((done[k] + 1) * period + ws[k] - 1) // ws[k] ELSE 1000000000 END) AS due
      FROM turn, p WHERE slot + 1 < period
    )
  )
), plan AS (SELECT i, j, slot FROM turn WHERE i IS NOT NULL),
stop AS (
  SELECT max((w.blocks - 1) // w.a * p.period + plan.slot) + 1 AS horizon
  FROM w CROSS JOIN p JOIN plan ON plan.i = w.i AND plan.j = (w.blocks - 1) % w.a
), g AS (
  SELECT w.s, w.i, w.a, w.blocks, p.period, horizon // p.period * w.a
         + (SELECT count(*) FROM plan WHERE plan.i = w.i AND plan.slot < horizon % p.period) AS given
  FROM w, p, stop
), placed AS (
  SELECT doc_id, source, n // {_BLOCK} AS block, (n % {_BLOCK})::INT AS place, i, a, period, blocks,
         unnest(range(0, (given - 1 - n // {_BLOCK}) // blocks + 1)) AS epoch
  FROM r JOIN g USING (s)
), timed AS (SELECT *, (block + epoch * blocks) // a AS cycle, (block + epoch * blocks) % a AS j FROM placed)
SELECT doc_id, source, epoch, block, cycle * period + (t.j * period) // a AS release,
       cycle * period + ((t.j + 1) * period + a - 1) // a AS deadline, cycle * period + plan.slot AS slot, place
FROM timed t JOIN plan ON plan.i = t.i AND plan.j = t.j
""",
    "op10_warc": """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
q AS (SELECT page_id, strlen(h)::BIGINT AS n, sha1(h) AS digest, max(page_id) OVER (PARTITION BY h) AS first FROM p)
SELECT page_id, n AS payload_bytes, digest AS payload_digest,
       CASE WHEN n >= 1000 AND page_id IS DISTINCT FROM first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 1000 AND page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM q
""",
}
