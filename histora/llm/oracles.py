"""The SQL that gives the rows of a query, for DuckDB, where SQL can express it.

Without SQL: packing (ids of a tokenizer), classifiers and language models (fitted by gradients), approximate search, alignment,
surrogates and binary files. Those queries are tested against brute force.
"""

from __future__ import annotations

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

NEAR_DUPLICATES = f"""WITH RECURSIVE
w AS MATERIALIZED (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'),
  '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws FROM documents),
s AS MATERIALIZED (SELECT DISTINCT doc_id, CASE WHEN len(ws) < 5 THEN array_to_string(ws, ' ') ELSE array_to_string(ws[i:i + 4], ' ') END AS sh
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS i FROM w WHERE len(ws) > 0)),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS MATERIALIZED (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id <> b.doc_id GROUP BY ALL),
l AS MATERIALIZED (SELECT x, y FROM p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * c >= 75 * (nx.n + ny.n - c)),
r AS (SELECT doc_id AS node, doc_id AS root FROM documents UNION SELECT l.y, r.root FROM r JOIN l ON l.x = r.node)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, m.component_id, d.doc_id = m.component_id AS kept
FROM documents d LEFT JOIN n USING (doc_id) JOIN (SELECT node, min(root) AS component_id FROM r GROUP BY node) m ON m.node = d.doc_id"""

# The 256 entries of the CRC-32 table follow from its polynomial
_CRC_TABLE = """(SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i::BIGINT, range(8)),
  lambda a, b: CASE WHEN a % 2 = 1 THEN xor(3988292384, a // 2) ELSE a // 2 END)))"""

SHARDS = f"""WITH RECURSIVE
tab AS MATERIALIZED (SELECT {_CRC_TABLE} AS k),
d AS MATERIALIZED (SELECT doc_id, coalesce(text, '') AS t, encode(coalesce(text, '')) AS b FROM documents),
rows_ AS MATERIALIZED (SELECT doc_id, ('0x' || substr(md5(t), 1, 15))::BIGINT AS g, octet_length(b)::BIGINT + 1 AS size,
  xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT,
    list_transform(range(1, octet_length(b) + 1), lambda i: ('0x' || hex(b)[2 * i - 1 : 2 * i])::BIGINT)),
    lambda c, x: xor(k[1 + (xor(c, x) & 255)], c // 256))) AS crc FROM d, tab),
groups_ AS MATERIALIZED (SELECT g, sum(size)::BIGINT AS w FROM rows_ GROUP BY g),
ranked AS MATERIALIZED (SELECT g, w, row_number() OVER (ORDER BY w DESC, g) - 1 AS k,
  coalesce(sum(w) OVER (ORDER BY w DESC, g ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before,
  (SELECT sum(w) FROM groups_)::BIGINT AS total FROM groups_),
alone AS MATERIALIZED (SELECT min(k) AS h FROM (SELECT k FROM ranked WHERE NOT (k < 15 AND w * (16 - k) > total - before) UNION ALL SELECT count(*) FROM ranked)),
o AS MATERIALIZED (SELECT g, w, sum(w) OVER (ORDER BY g)::BIGINT AS p FROM ranked, alone WHERE k >= h),
f AS MATERIALIZED (SELECT 16 - h AS shards, max(p) AS total, greatest(max(w), ceil(max(p) / (16 - h))::BIGINT) AS low FROM o, alone GROUP BY h),
seek AS (
  SELECT low AS lo, total AS hi, 0::BIGINT AS n, 0::BIGINT AS pos FROM f
  UNION ALL
  SELECT CASE WHEN pos < total AND n = shards THEN (lo + hi) // 2 + 1 ELSE lo END,
    CASE WHEN pos >= total THEN (lo + hi) // 2 ELSE hi END,
    CASE WHEN pos >= total OR n = shards THEN 0 ELSE n + 1 END,
    CASE WHEN pos >= total OR n = shards THEN 0 ELSE (SELECT max(p) FROM o WHERE p <= pos + (lo + hi) // 2) END
  FROM seek, f WHERE lo < hi),
best AS MATERIALIZED (SELECT min(hi) AS c FROM seek WHERE lo = hi),
cuts AS (
  SELECT 0::BIGINT AS pos FROM f
  UNION ALL SELECT (SELECT max(p) FROM o WHERE p <= pos + c) FROM cuts, best, f WHERE pos < total),
placed AS MATERIALIZED (
  SELECT g, (h - 1 + (SELECT count(*) FROM cuts WHERE cuts.pos < o.p))::INTEGER AS shard FROM o, alone
  UNION ALL SELECT g, k::INTEGER FROM ranked, alone WHERE k < h)
SELECT doc_id, size, crc AS text_crc32, 'bytes' AS law, shard,
  row_number() OVER (PARTITION BY shard ORDER BY ('0x' || substr(md5(concat(doc_id, ':', g)), 1, 8))::BIGINT % 4096, doc_id, g) - 1 AS slot,
  CAST(NULL AS INTEGER) AS grown_shard
FROM rows_ JOIN placed USING (g)"""

ORACLES = {"op3_minhash_neardup": NEAR_DUPLICATES, "op9_minimax_sharding": SHARDS}
