"""Independent DuckDB SQL for the operators that SQL can express (op1's windows can be written in SQL too, but take minutes)."""

ORACLE: dict[str, str] = {}

ORACLE["op10_exact_dedup"] = """
WITH d AS (SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256 FROM documents),
g AS (SELECT text_sha256, max(doc_id) AS keep_id, CAST(count(*) AS BIGINT) AS group_size FROM d GROUP BY 1)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id IS NOT DISTINCT FROM g.keep_id AS kept, d.text_sha256
FROM d JOIN g USING (text_sha256)
"""

_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

ORACLE["op9_decontamination"] = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS k, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS win
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 8, 2))) AS i FROM b WHERE len(w) > 0)),
ks AS (SELECT DISTINCT k FROM bw),
dw AS (
  SELECT doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') AS win
  FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d CROSS JOIN ks WHERE len(w) >= k)),
h AS (SELECT dw.doc_id, dw.k, dw.i, bw.item_id FROM dw JOIN bw USING (k, win)),
hw AS (SELECT doc_id, count(DISTINCT p) AS n_hit
       FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM (SELECT DISTINCT doc_id, k, i FROM h)) GROUP BY 1),
hi AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
       FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM h) GROUP BY 1)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hw USING (doc_id) LEFT JOIN hi USING (doc_id)
"""

# Similarity of word 5-gram sets of 0.8 or more, closed over chains; texts of fewer words have one element.
ORACLE["op2_dart_minhash"] = f"""
WITH RECURSIVE d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
g AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + least(5, len(w)) - 1], ' ') AS e
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY 1),
o AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM g a JOIN g b ON a.e = b.e AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT x, y FROM o JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE c >= 0.8 * (nx.n + ny.n - c)),
sym AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
reach AS (SELECT x, y FROM sym UNION SELECT r.x, b.y FROM reach r JOIN sym b ON r.y = b.x),
c AS (SELECT d.doc_id, least(d.doc_id, min(y)) AS class_id FROM d LEFT JOIN reach ON x = d.doc_id GROUP BY d.doc_id)
SELECT doc_id, class_id, count(*) OVER (PARTITION BY class_id) AS class_size, doc_id = class_id AS kept FROM c
"""

ORACLE["op11_fill_in_middle"] = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
u AS (SELECT *, regexp_extract_all(t, '[^\n]*\n|[^\n]+') AS u FROM d),
k AS (SELECT *, CAST(len(u) AS BIGINT) AS n, CAST('0x' || h[1:8] AS BIGINT) % (len(u) + 1) AS x, CAST('0x' || h[9:16] AS BIGINT) % (len(u) + 1) AS y,
        CAST('0x' || h[17:24] AS BIGINT) % 100 AS r, CAST('0x' || h[25:32] AS BIGINT) % 100 AS s FROM u),
f AS (SELECT *, CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR r >= 100 THEN 'plain'
                     WHEN s < 50 THEN 'spm' ELSE 'psm' END AS form,
        array_to_string(u[1:least(x, y)], '') AS p, array_to_string(u[least(x, y) + 1:greatest(x, y)], '') AS m,
        array_to_string(u[greatest(x, y) + 1:], '') AS e FROM k)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || e || '<M>' || m
                   ELSE '<S>' || e || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM f
"""

ORACLE["op12_warc"] = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
g AS (SELECT page_id, octet_length(b) AS payload_bytes, sha1(b) AS h, min(page_id) OVER (PARTITION BY b) AS first_id FROM p)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(1 +
    ((CAST('0x' || substr(h, CAST(1 + 5 * (i // 4) AS INT), 5) AS INT) >> CAST(15 - 5 * (i % 4) AS INT)) & 31) AS INT), 1)), '') AS payload_digest,
  CASE WHEN page_id IS NOT DISTINCT FROM first_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id IS DISTINCT FROM first_id THEN first_id END AS refers_to
FROM g
"""
