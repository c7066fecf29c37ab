"""SQL for DuckDB beside the queries whose results SQL can express."""

from __future__ import annotations


def crc32_sql(text: str) -> str:
    """CRC-32 of an ASCII text: for each byte eight steps of the reversed polynomial."""
    steps = "list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda u, v: xor(u >> 1, 3988292384 * (u & 1)))"
    data = f"list_transform(string_split({text}, ''), lambda x: CAST(ascii(x) AS BIGINT))"
    return f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {data}), lambda a, b: {steps}), 4294967295)"


def base32_sql(code: str) -> str:
    """Base 32, as RFC 4648 writes it, of a text of 40 hexadecimal digits."""
    nibbles = "[" + ", ".join(f"'{n:04b}'" for n in range(16)) + "]"
    bits = f"array_to_string(list_transform(string_split({code}, ''), lambda x: {nibbles}[strpos('0123456789abcdef', x)]), '')"
    value = " + ".join(f"{1 << 4 - i} * CAST(substr(w, 1 + 5 * k + {i}, 1) AS INTEGER)" for i in range(5))
    digit = f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + {value}, 1)"
    return f"(SELECT array_to_string(list_transform(range(32), lambda k: {digit}), '') FROM (SELECT {bits} AS w))"


REVISITS = f"""
    WITH p AS (SELECT page_id, replace(replace(url, chr(13), '%0D'), chr(10), '%0A') AS url,
                      strlen(coalesce(html, '')) AS payload_bytes, {base32_sql("sha1(coalesce(html, ''))")} AS payload_digest
               FROM pages),
    o AS (SELECT payload_digest, max(page_id) AS first FROM p GROUP BY 1)
    SELECT page_id, url, payload_bytes, payload_digest,
           CASE WHEN page_id IS DISTINCT FROM first THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN page_id IS DISTINCT FROM first THEN first END AS refers_to, true AS intact
    FROM p JOIN o USING (payload_digest)
"""

# Nodes are known by their depth and the SHA-256 of all turns on the way to them.
TRIE = f"""
    WITH t AS (SELECT conv_id AS c, coalesce(role, '') AS r, coalesce(text, '') AS x,
                      row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
                          sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) - 1 AS k
               FROM conversations WHERE conv_id IS NOT NULL),
    n AS (SELECT c, count(*) AS n_own, c - ((c % 5) + 5) % 5 AS b, {crc32_sql("CAST(c AS VARCHAR)")} % 9 AS h FROM t GROUP BY c),
    m AS (SELECT n.c, n.h, n.b, least(n.h, coalesce(o.n_own, 0)) AS taken,
                 least(n.h, coalesce(o.n_own, 0)) + greatest(n.n_own - n.h, 0) AS n_turns
          FROM n LEFT JOIN n o ON o.c = n.b),
    u AS (SELECT t.c, t.k - m.h + m.taken AS p, r, x FROM t JOIN m ON t.c = m.c WHERE t.k >= m.h
          UNION ALL SELECT m.c, t.k, r, x FROM m JOIN t ON t.c = m.b WHERE t.k < m.taken),
    w AS (SELECT c, p + 1 AS d, strlen(x) AS bytes,
                 sha256(string_agg(length(r) || ':' || length(x) || ':' || r || x, '') OVER (PARTITION BY c ORDER BY p)) AS node
          FROM u
          UNION ALL SELECT c, 0, 0, '' FROM m),
    g AS (SELECT d, node, min(c) AS conv_id, count(*) AS n_convs, (count(*) - 1) * max(bytes) AS saved FROM w GROUP BY 1, 2),
    e AS (SELECT DISTINCT a.d, a.node, b.node AS up FROM w a JOIN w b ON a.c = b.c AND b.d = a.d - 1),
    kids AS (SELECT d - 1 AS d, up AS node, count(*) AS n_children FROM e GROUP BY 1, 2),
    l AS (SELECT g.*, coalesce(n_children, 0) AS n_children FROM g LEFT JOIN kids USING (d, node)),
    s AS (SELECT DISTINCT b.d, b.node, a.d AS d2, a.node AS node2 FROM w a JOIN w b ON a.c = b.c AND b.d <= a.d),
    sums AS (SELECT s.d, s.node, sum(l.saved) AS saved_tokens, count(*) FILTER (WHERE l.n_children = 0) AS n_leaves
             FROM s JOIN l ON l.d = s.d2 AND l.node = s.node2 GROUP BY 1, 2),
    ends AS (SELECT w.d, w.node, string_agg(CAST(w.c AS VARCHAR), ',' ORDER BY w.c) AS ids
             FROM w JOIN m ON w.c = m.c AND w.d = m.n_turns GROUP BY 1, 2)
    SELECT l.conv_id, l.d AS depth, up.conv_id AS parent_conv_id, l.n_convs, l.n_children, sums.n_leaves,
           CAST(sums.saved_tokens AS BIGINT) AS saved_tokens, sha256(coalesce(ends.ids, '')) AS ends_sha256
    FROM l JOIN sums USING (d, node) LEFT JOIN ends USING (d, node)
    LEFT JOIN e ON e.d = l.d AND e.node = l.node
    LEFT JOIN g up ON up.d = l.d - 1 AND up.node = e.up
"""
