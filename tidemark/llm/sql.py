"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

SQL: dict[str, str] = {}

LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

SQL["op1_decontamination"] = f"""
WITH d AS (
  SELECT doc_id, list_filter(regexp_split_to_array({LOWERED}, '[ \\t-\\r]+'), lambda x: x <> '') AS w FROM documents
), p AS (
  SELECT doc_id, len(w) AS size, i AS at, array_to_string(w[i + 1 : i + 5], ' ') AS shingle
  FROM (SELECT doc_id, w, unnest(range(len(w) - 4)) AS i FROM d WHERE len(w) >= 5)
), b AS (
  SELECT item_id, list_filter(regexp_split_to_array({LOWERED}, '[ \\t-\\r]+'), lambda x: x <> '') AS w FROM benchmark
), q AS (
  SELECT item_id, len(w) AS n, i AS at, array_to_string(w[i + 1 : i + 5], ' ') AS shingle
  FROM (SELECT item_id, w, unnest(range(len(w) - 4)) AS i FROM b WHERE len(w) >= 5)
), windows AS (
  SELECT DISTINCT doc_id, item_id, n, size, greatest(0, least(p.at - q.at, size - n)) AS start
  FROM p JOIN q USING (shingle)
), inside AS (
  SELECT doc_id, item_id, start, p.shingle, count(*) AS times
  FROM windows v JOIN p USING (doc_id)
  WHERE p.at >= start AND p.at <= start + least(n, v.size) - 5
  GROUP BY ALL
), own AS (
  SELECT item_id, shingle, count(*) AS times FROM q GROUP BY ALL
), shared AS (
  SELECT doc_id, item_id, start, sum(least(i.times, o.times))::BIGINT AS hit
  FROM inside i JOIN own o USING (item_id, shingle) GROUP BY ALL
), scored AS (
  SELECT doc_id, item_id, start, hit, (n - 4) + (least(n, size) - 4) - hit AS total
  FROM shared JOIN windows USING (doc_id, item_id, start)
)
SELECT doc_id, item_id, arg_max(start, (hit / total, -start))::INTEGER AS start, max(hit / total) AS similarity
FROM scored WHERE 100 * hit >= 75 * total GROUP BY doc_id, item_id
"""

SQL["op10_exact_dedup"] = f"""
WITH d AS (SELECT doc_id, {LOWERED} AS norm FROM documents)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, sha256(norm) AS text_sha256
FROM d WINDOW g AS (PARTITION BY norm)
"""

# CRC-32 bit by bit: a step of -1 shifts, any other is a byte to be mixed in.
_CRC32 = """
xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(
  string_split(c::VARCHAR, ''), lambda s: [ascii(s)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
  lambda a, s: CASE WHEN s < 0 THEN xor(a >> 1, 3988292384 * (a & 1)) ELSE xor(a, s) END))
"""

SQL["op12_prefix_trie"] = f"""
WITH t AS (
  SELECT conv_id AS c, turn, coalesce(role, '') AS r, coalesce(text, '') AS x FROM conversations WHERE conv_id IS NOT NULL
), o AS (
  SELECT c, list({{'r': r, 'x': x}} ORDER BY turn NULLS FIRST, sha256(octet_length(encode(r)) || ':' || r || x)) AS turns
  FROM t GROUP BY c
), h AS (
  SELECT c, turns, ({_CRC32} % 4)::INTEGER AS h FROM o
), w AS (
  SELECT a.c, list_concat(list_slice(coalesce(b.turns, []), 1, a.h), list_slice(a.turns, a.h + 1, len(a.turns))) AS s
  FROM h a LEFT JOIN o b ON b.c = a.c - a.c % 20
), p AS (
  SELECT c, d, list_slice(s, 1, d) AS pre, len(s) = d AS ended FROM (SELECT c, s, unnest(range(len(s) + 1)) AS d FROM w)
), n AS (
  SELECT pre, d, min(c) AS conv_id, count(*) AS n_convs,
         sha256(coalesce(string_agg(CASE WHEN ended THEN c::VARCHAR END, ',' ORDER BY c), '')) AS ends_sha256,
         CASE WHEN d = 0 THEN 0 ELSE
           (count(*) - 1) * len(regexp_extract_all(pre[d].x, '[^\\x20\\x09-\\x0D]+')) END AS own
  FROM p GROUP BY pre, d
), k AS (
  SELECT list_slice(pre, 1, d - 1) AS pre, d - 1 AS d, count(*) AS n FROM n WHERE d > 0 GROUP BY ALL
), f AS (
  SELECT n.*, coalesce(k.n, 0) AS n_children FROM n LEFT JOIN k USING (pre, d)
), u AS (
  SELECT list_slice(pre, 1, e) AS pre, e AS d, sum(own)::BIGINT AS saved_tokens, count(*) FILTER (n_children = 0) AS n_leaves
  FROM (SELECT *, unnest(range(d + 1)) AS e FROM f) GROUP BY ALL
)
SELECT f.conv_id, f.d AS depth, q.conv_id AS parent_conv_id, f.n_convs, f.n_children, u.n_leaves, u.saved_tokens, f.ends_sha256
FROM f JOIN u USING (pre, d) LEFT JOIN n q ON q.d = f.d - 1 AND q.pre = list_slice(f.pre, 1, f.d - 1)
"""
