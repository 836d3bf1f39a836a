"""DuckDB twins of those operator queries that SQL can state."""

MERKLE = """
WITH RECURSIVE fields AS (
  SELECT doc_id, lang,
         CASE WHEN doc_id IS NULL THEN '-' ELSE length(doc_id::VARCHAR) || ':' || doc_id END
           || CASE WHEN source IS NULL THEN '-' ELSE strlen(source) || ':' || source END
           || CASE WHEN lang IS NULL THEN '-' ELSE strlen(lang) || ':' || lang END
           || CASE WHEN n_chars IS NULL THEN '-' ELSE length(n_chars::VARCHAR) || ':' || n_chars END AS head,
         CASE WHEN text IS NULL THEN '-' ELSE strlen(text) || ':' || text END AS body,
         CASE WHEN text IS NULL THEN '-' ELSE strlen(text) || ':' || translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') END AS lower_body,
         -- CRC-32 of the decimal digits, bit by bit
         xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
             lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), list_transform(range(8), lambda i: i::BIGINT)),
                 lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295) AS crc
  FROM documents
), leaves AS (
  SELECT doc_id, lang, sha256(head || body) AS leaf, CASE WHEN crc % 3 = 0 THEN sha256(head || lower_body) END AS changed
  FROM fields
), numbered AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY lang) AS n FROM leaves
), nodes AS (
  SELECT lang, 0 AS level, i, n, leaf AS h FROM numbered
  UNION ALL
  SELECT lang, level + 1, i // 8, (n + 7) // 8, sha256(string_agg(h, '' ORDER BY i)) FROM nodes WHERE n > 1 GROUP BY lang, level, i // 8, n
), subroots AS (
  SELECT lang, h, level AS height, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS i, count(*) OVER () AS n FROM nodes WHERE n = 1
), top_nodes AS (
  SELECT 0 AS level, i, n, h FROM subroots
  UNION ALL
  SELECT level + 1, i // 8, (n + 7) // 8, sha256(string_agg(h, '' ORDER BY i)) FROM top_nodes WHERE n > 1 GROUP BY level, i // 8, n
), root AS (SELECT h AS root FROM top_nodes WHERE n = 1
), runs AS (  -- every node with its siblings before and behind it
  SELECT lang, level, i, coalesce(string_agg(h, '') OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS before,
         coalesce(string_agg(h, '') OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS after
  FROM nodes WHERE n > 1 WINDOW w AS (PARTITION BY lang, level, i // 8 ORDER BY i)
), top_runs AS (
  SELECT level, i, coalesce(string_agg(h, '') OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS before,
         coalesce(string_agg(h, '') OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS after
  FROM top_nodes WHERE n > 1 WINDOW w AS (PARTITION BY level, i // 8 ORDER BY i)
), walk AS (
  SELECT t.lang, t.i AS leaf_i, 0 AS step, coalesce(t.changed, t.leaf) AS folded, '' AS proof FROM numbered t
  UNION ALL
  SELECT w.lang, w.leaf_i, w.step + 1, sha256(r.before || w.folded || r.after), w.proof || r.before || r.after
  FROM walk w JOIN runs r ON w.lang IS NOT DISTINCT FROM r.lang AND r.level = w.step AND r.i = w.leaf_i // (8 ** w.step)::BIGINT
), low AS (
  SELECT w.lang, w.leaf_i, w.folded, w.proof, s.i AS sub_i, s.h AS subroot FROM walk w JOIN subroots s ON w.lang IS NOT DISTINCT FROM s.lang AND w.step = s.height
), climb AS (
  SELECT lang, leaf_i, sub_i, subroot, 0 AS step, folded, proof FROM low
  UNION ALL
  SELECT c.lang, c.leaf_i, c.sub_i, c.subroot, c.step + 1, sha256(r.before || c.folded || r.after), c.proof || r.before || r.after
  FROM climb c JOIN top_runs r ON r.level = c.step AND r.i = c.sub_i // (8 ** c.step)::BIGINT
), done AS (SELECT * FROM climb WHERE step = (SELECT max(level) FROM top_nodes))
SELECT t.doc_id, t.leaf, d.subroot, root.root, sha256(d.proof) AS proof_sha256, d.folded AS folded_root, d.folded = root.root AS verified
FROM numbered t JOIN done d ON t.lang IS NOT DISTINCT FROM d.lang AND t.i = d.leaf_i CROSS JOIN root
"""

ORACLE: dict[str, str] = {"op12_merkle": MERKLE}
