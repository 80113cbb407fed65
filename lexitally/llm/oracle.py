"""DuckDB SQL of the queries that SQL can express on whole tables."""

from __future__ import annotations

_USABLE = "vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"


def _top(vector: str, where: str, score: str) -> str:
    """The 20 best of every twentieth vector."""
    return f"""WITH v AS (SELECT vec_id, {vector} AS e FROM embeddings WHERE {_USABLE} AND {where}),
          s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e) AS s
                FROM v q JOIN v c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id)
        SELECT query_id, place::INTEGER AS rank, vec_id, s::{score} AS score FROM (
          SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY s DESC, vec_id) AS place FROM s) WHERE place <= 20"""


# The digits of base 32.
_DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def _base32(hexadecimal: str) -> str:
    digits = "[7, 6, 5, 4, 3, 2, 1, 0]"
    number = f"('0x' || substr({hexadecimal}, 1 + 10 * {{}}, 10))::BIGINT"
    return " || ".join(
        f"array_to_string(list_transform({digits}, lambda i: substr('{_DIGITS}', ((({number.format(k)}) >> (5 * i)) & 31)::INTEGER + 1, 1)), '')"
        for k in range(4))


_BLANK = r"[\x20\x09-\x0D]+"


def _runs(words: str) -> str:
    """Distinct runs of five words of a list."""
    return f"list_distinct(list_transform(range(1, len({words}) - 3), lambda i: array_to_string({words}[i:i + 4], ' ')))"


_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"



def _crc32(text: str) -> str:
    """CRC-32 of ASCII text, bit by bit."""
    bit = "lambda k, i: xor(k >> 1, 3988292384 * (k & 1))"
    return (f"xor(list_reduce(list_transform(string_split({text}, ''), lambda c: ord(c)::BIGINT), "
            f"lambda a, b: list_reduce(range(8), {bit}, xor(a, b)), 4294967295), 4294967295)")


def _field(value: str) -> str:
    return f"CASE WHEN {value} IS NULL THEN '-' ELSE strlen({value}::VARCHAR) || ':' || {value}::VARCHAR END"


def _leaf(text: str) -> str:
    return f"sha256(concat({', '.join(map(_field, ('doc_id', 'source', 'lang', 'n_chars', text)))}))"


def _tree(name: str, leaves: str) -> str:
    """Nodes of trees over `leaves` (tree, i, n, h), and the siblings of each node."""
    return f"""{name} AS (SELECT 0 AS level, tree, i, n, h FROM {leaves} UNION ALL
            SELECT level + 1, tree, i // 3, (any_value(n) + 2) // 3, sha256(string_agg(h, '' ORDER BY i))
            FROM {name} WHERE n > 1 GROUP BY level, tree, i // 3),
          {name}_sides AS (SELECT a.level, a.tree, a.i,
              coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (WHERE b.i < a.i), '') AS before,
              coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (WHERE b.i > a.i), '') AS behind
            FROM {name} a JOIN {name} b ON a.level = b.level AND a.tree = b.tree AND a.i // 3 = b.i // 3
            WHERE a.n > 1 GROUP BY a.level, a.tree, a.i)"""


def _walk(name: str, tree: str, start: str) -> str:
    """From `start` (row, tree, i, x, proof) to the roots; the row of the highest level is the result."""
    return f"""{name} AS (SELECT row, tree, i, x, proof, 0 AS level FROM ({start}) UNION ALL
            SELECT w.row, w.tree, w.i // 3, sha256(concat(s.before, w.x, s.behind)), concat(w.proof, s.before, s.behind), w.level + 1
            FROM {name} w JOIN {tree}_sides s ON w.level = s.level AND w.tree = s.tree AND w.i = s.i)"""


_SYMBOL = "substr(sha256(concat(strlen(r), ':', r, x)), 1, 32) || printf('%016x', length(x))"

SQL: dict[str, str] = {
    "op2_ann": _top("embedding::DOUBLE[]", "len(list_filter(embedding, lambda x: x <> 0)) > 0", "DOUBLE"),
    "op3_warc": f"""WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
          m AS (SELECT *, max(page_id) OVER (PARTITION BY html) AS last FROM p)
        SELECT page_id, strlen(html)::BIGINT AS payload_bytes, {_base32('h')} AS payload_digest,
          CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
          CASE WHEN page_id <> last THEN last END AS refers_to FROM m""",
    "op7_impact": _top("list_transform(embedding, lambda x: floor(64 * x::DOUBLE))", "true", "BIGINT"),
    "op8_linededup": f"""WITH l AS (SELECT doc_id, (unnest(range(1, len(a) + 1)) - 1)::INTEGER AS line, unnest(a) AS value
            FROM (SELECT doc_id, string_split(text, chr(10)) AS a FROM documents)),
          w AS (SELECT doc_id, line, list_filter(regexp_split_to_array(lower(value), '{_BLANK}'), lambda x: x <> '') AS w FROM l),
          s AS MATERIALIZED (SELECT doc_id, line, CASE WHEN len(w) >= 5 THEN {_runs('w')} ELSE [array_to_string(w, ' ')] END AS s FROM w WHERE len(w) > 0),
          e AS MATERIALIZED (SELECT doc_id, line, len(s) AS n, unnest(s) AS r FROM s),
          c AS (SELECT x.doc_id, x.line, any_value(x.n) AS n, y.doc_id AS d, y.line AS k, any_value(y.n) AS m, count(*) AS common
                FROM e x JOIN e y ON x.r = y.r AND (y.doc_id < x.doc_id OR y.doc_id = x.doc_id AND y.line < x.line)
                GROUP BY x.doc_id, x.line, y.doc_id, y.line),
          g AS (SELECT DISTINCT doc_id, line FROM c WHERE 4 * common >= 3 * (n + m - common)),
          r AS (SELECT doc_id, string_agg(line::VARCHAR, ',' ORDER BY line) AS removed FROM g GROUP BY doc_id)
        SELECT d.doc_id, coalesce(len(string_split(text, chr(10))), 0)::INTEGER AS n_lines, coalesce(removed, '') AS removed
        FROM documents d LEFT JOIN r ON d.doc_id = r.doc_id""",
    "op10_minhash": f"""WITH RECURSIVE t AS (SELECT doc_id, list_filter(regexp_split_to_array(
              translate(coalesce(text, ''), '{_CAPITALS}', '{_CAPITALS.lower()}'), '{_BLANK}'), lambda x: x <> '') AS w FROM documents),
          s AS MATERIALIZED (SELECT doc_id, CASE WHEN len(w) >= 5 THEN {_runs('w')} WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s FROM t),
          e AS MATERIALIZED (SELECT doc_id, len(s) AS n, unnest(s) AS r FROM s),
          c AS (SELECT x.doc_id AS a, y.doc_id AS b, any_value(x.n) AS n, any_value(y.n) AS m, count(*) AS common
                FROM e x JOIN e y ON x.r = y.r AND x.doc_id <> y.doc_id GROUP BY x.doc_id, y.doc_id),
          k AS (SELECT a, b FROM c WHERE 100 * common >= 75 * (n + m - common)),
          reach AS (SELECT doc_id AS a, doc_id AS b FROM s UNION SELECT reach.a, k.b FROM reach JOIN k ON reach.b = k.a),
          f AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
        SELECT doc_id, len(s)::BIGINT AS n_shingles, component_id, component_id = doc_id AS kept
        FROM s JOIN f ON f.a = s.doc_id""",
    "op12_prefixtrie": f"""WITH t AS (SELECT conv_id, turn, {_SYMBOL} AS s FROM (
              SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS x FROM conversations WHERE conv_id IS NOT NULL)),
          own AS (SELECT conv_id, string_agg(s, '' ORDER BY turn NULLS FIRST, s) AS p FROM t GROUP BY conv_id),
          cut AS (SELECT conv_id, p, conv_id - conv_id % 100 AS head, 48 * ({_crc32('conv_id::VARCHAR')} % 6) AS h FROM own),
          built AS (SELECT c.conv_id, substr(coalesce(o.p, ''), 1, h) || substr(c.p, h + 1) AS p FROM cut c LEFT JOIN own o ON o.conv_id = c.head),
          m AS (SELECT conv_id, substr(p, 1, 48 * d) AS k, d, 48 * d = length(p) AS ended
                FROM (SELECT conv_id, p, unnest(range(length(p) // 48 + 1)) AS d FROM built)),
          n AS MATERIALIZED (SELECT k, any_value(d) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs,
                  sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE ended), '')) AS ends_sha256
                FROM m GROUP BY k),
          c AS (SELECT substr(k, 1, length(k) - 48) AS k, count(*) AS n FROM n WHERE k <> '' GROUP BY ALL),
          v AS (SELECT n.k, CASE WHEN c.n IS NULL THEN 1 ELSE 0 END AS leaf,
                  CASE WHEN n.k = '' THEN 0 ELSE (n_convs - 1) * ('0x' || right(n.k, 16))::BIGINT END AS saved FROM n LEFT JOIN c ON n.k = c.k),
          b AS (SELECT substr(k, 1, 48 * d) AS k, sum(leaf)::BIGINT AS n_leaves, sum(saved)::BIGINT AS saved_tokens
                FROM (SELECT *, unnest(range(length(k) // 48 + 1)) AS d FROM v) GROUP BY ALL)
        SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(c.n, 0) AS n_children, n_leaves, saved_tokens, n.ends_sha256
        FROM n JOIN b ON n.k = b.k LEFT JOIN c ON n.k = c.k LEFT JOIN n p ON n.k <> '' AND p.k = substr(n.k, 1, length(n.k) - 48)""",
    "op13_merkle": f"""WITH RECURSIVE d AS (SELECT *, coalesce({_crc32('doc_id::VARCHAR')} % 2 = 0, false) AS even FROM documents),
          l AS MATERIALIZED (SELECT doc_id, coalesce('=' || source, '') AS tree, {_leaf('text')} AS h,
                  {_leaf("CASE WHEN even THEN replace(text, chr(10), '') ELSE text END")} AS x FROM d),
          o AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, h) - 1 AS i,
                  count(*) OVER (PARTITION BY tree) AS n, row_number() OVER () AS row FROM l),
          {_tree('low', 'o')},
          g AS (SELECT '' AS tree, tree AS of, h, row_number() OVER (ORDER BY tree) - 1 AS i, count(*) OVER () AS n FROM low WHERE n = 1),
          {_tree('top', 'g')},
          {_walk('walk', 'low', "SELECT row, tree, i, x, '' AS proof FROM o")},
          {_walk('finish', 'top', "SELECT w.row, '' AS tree, g.i, w.x, w.proof FROM walk w JOIN g ON w.tree = g.of WHERE w.level = (SELECT max(level) FROM low WHERE low.tree = w.tree)")}
        SELECT o.doc_id, o.h AS leaf, g.h AS subroot, r.h AS root, sha256(e.proof) AS proof_sha256, e.x AS folded_root, e.x = r.h AS verified
        FROM o JOIN g ON o.tree = g.of JOIN top r ON r.n = 1 JOIN finish e ON e.row = o.row
        WHERE e.level = (SELECT max(level) FROM top)""",
}
