"""DuckDB SQL for the rows of queries whose method has a plain declarative counterpart."""

#: CRC-32 byte table, made from its polynomial, as a list.
_CRC = """crc(i, j, v) AS (SELECT i, 0, i FROM range(256) t(i) UNION ALL
      SELECT i, j + 1, xor(v >> 1, 3988292384 * (v & 1)) FROM crc WHERE j < 8),
    crc_table AS (SELECT list(v ORDER BY i) AS t FROM crc WHERE j = 8)"""


def _crc32(text: str) -> str:
    return (
        f"xor(list_reduce(list_concat([4294967295], list_transform(string_split({text}, ''), lambda x: ascii(x)::BIGINT)), "
        "lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295)"
    )


CONVERSATION_TRIE = f"""WITH RECURSIVE {_CRC},
    own AS (SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (
        PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS p
      FROM conversations WHERE conv_id IS NOT NULL),
    ids AS (SELECT c, {_crc32("c::VARCHAR")} % 6 AS h FROM (SELECT DISTINCT c FROM own) i, crc_table),
    head AS (SELECT ids.c, o.p AS d, o.role, o.text FROM ids JOIN own o ON o.c = ids.c - ids.c % 100 AND o.p <= ids.h),
    held AS (SELECT ids.c, ids.h, count(head.d) AS n FROM ids LEFT JOIN head ON head.c = ids.c GROUP BY ids.c, ids.h),
    turns AS (SELECT c, d, role, text FROM head UNION ALL
      SELECT o.c, held.n + o.p - held.h, o.role, o.text FROM own o JOIN held ON held.c = o.c WHERE o.p > held.h),
    path AS (SELECT c, 0 AS d, '' AS k, 0 AS n_chars FROM ids UNION ALL
      SELECT c, d, string_agg(length(role) || ':' || role || length(text) || ':' || text, '') OVER (
        PARTITION BY c ORDER BY d ROWS UNBOUNDED PRECEDING), length(text) FROM turns),
    above AS (SELECT c, d, k, n_chars, lag(k) OVER (PARTITION BY c ORDER BY d) AS up, lead(d) OVER (PARTITION BY c ORDER BY d) IS NULL AS ends
      FROM path),
    node AS (SELECT k, d, min(c) AS conv_id, count(*) AS n_convs, max(n_chars) AS n_chars, min(up) AS up FROM above GROUP BY k, d),
    kids AS (SELECT up AS k, count(*) AS n FROM node WHERE d > 0 GROUP BY up),
    full_node AS (SELECT node.k, node.d, node.conv_id, node.n_convs, node.n_chars, node.up, coalesce(kids.n, 0) AS n_children
      FROM node LEFT JOIN kids ON kids.k = node.k),
    sub AS (SELECT a.k, sum(CASE WHEN n.n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum((n.n_convs - 1) * n.n_chars) AS saved
      FROM full_node n JOIN above a ON a.c = n.conv_id AND a.d <= n.d GROUP BY a.k),
    ended AS (SELECT k, sha256(string_agg(c::VARCHAR, ',' ORDER BY c)) AS told FROM above WHERE ends GROUP BY k)
    SELECT n.conv_id, n.d::BIGINT AS depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children,
      sub.n_leaves::BIGINT AS n_leaves, sub.saved::BIGINT AS saved_tokens, coalesce(ended.told, sha256('')) AS ends_sha256
    FROM full_node n JOIN sub ON sub.k = n.k LEFT JOIN node p ON n.d > 0 AND p.k = n.up LEFT JOIN ended ON ended.k = n.k"""


def _near(parts: str, book: str) -> str:
    return (
        f"SELECT r.id, r.p, min(r.d * 64 + r.e) % 64 AS e, min(r.d) AS d FROM (SELECT x.id, x.p, b.e, sum((x.x - b.y) * (x.x - b.y)) AS d "
        f"FROM {parts} x JOIN {book} b ON b.p = x.p AND b.j = x.j GROUP BY x.id, x.p, b.e) r GROUP BY r.id, r.p"
    )


def _moved(book: str, near: str) -> str:
    return (
        f"SELECT b.p, b.e, b.j, coalesce(s.y, b.y) AS y FROM {book} b LEFT JOIN (SELECT n.p, n.e, x.j, floor(sum(x.x) / count(*))::BIGINT AS y "
        f"FROM {near} n JOIN comp x ON x.id = n.id AND x.p = n.p GROUP BY n.p, n.e, x.j) s ON s.p = b.p AND s.e = b.e AND s.j = b.j"
    )


#: For vectors of one length, as the tables have them.
VECTOR_CODES = f"""WITH kept AS (SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) - 1 AS id, vec_id, label, embedding,
        len(embedding) // 16 AS w FROM embeddings WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: isfinite(x))) = len(embedding)),
    spread AS (SELECT id, w, unnest(embedding) AS v, unnest(range(len(embedding))) AS i FROM kept),
    comp AS (SELECT id, i // w AS p, i % w AS j, floor(256 * v::DOUBLE)::BIGINT AS x FROM spread),
    book0 AS (SELECT p, id AS e, j, x AS y FROM comp WHERE id < 64),
    near0 AS ({_near("comp", "book0")}), book1 AS ({_moved("book0", "near0")}),
    near1 AS ({_near("comp", "book1")}), book2 AS ({_moved("book1", "near1")}),
    near2 AS ({_near("comp", "book2")}),
    coded AS (SELECT id, string_agg(lpad(lower(to_hex(e::BIGINT)), 2, '0'), '' ORDER BY p) AS code, sum(d)::BIGINT AS error FROM near2 GROUP BY id),
    told AS (SELECT sha256(string_agg(y::VARCHAR, ',' ORDER BY p, e, j)) AS books FROM book2)
    SELECT k.vec_id, c.code, c.error, (sum(c.error) OVER (PARTITION BY k.label))::BIGINT AS label_error, told.books AS codebooks_sha256
    FROM kept k JOIN coded c ON c.id = k.id, told"""
