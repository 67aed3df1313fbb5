"""DuckDB twins of the queries on manifests, mixing and prefix tries."""

from __future__ import annotations


def crc32_sql(text: str) -> str:
    """Unsigned crc32 of ASCII text, one bit at a time."""
    bits = (f"flatten(list_transform(string_split({text}, ''), lambda ch: "
            "list_transform(range(8), lambda i: (ord(ch) >> i::INTEGER) & 1)))")
    return (f"xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform({bits}, lambda b: b::BIGINT)), "
            "lambda c, b: xor(c >> 1, 3988292384 * (xor(c, b) & 1))), 4294967295)")


def _field(column: str) -> str:
    return (f"CASE WHEN {column} IS NULL THEN '-' ELSE strlen({column}::VARCHAR)::VARCHAR || ':' "
            f"|| {column}::VARCHAR END")


def _leaf(n_chars: str) -> str:
    return "sha256(" + " || ".join(map(_field, ("doc_id", "source", "lang", n_chars, "text"))) + ")"


def _levels(name: str, nodes: str) -> str:
    """(tree, level, pos, node, n) of all levels of all trees."""
    return f"""{name} AS (
  {nodes}
  UNION ALL
  SELECT tree, level, pos, node, count(*) OVER (PARTITION BY tree) AS n FROM (
    SELECT tree, any_value(level) + 1 AS level, pos // 2 AS pos,
           sha256(string_agg(node, '' ORDER BY pos)) AS node
    FROM {name} WHERE n > 1 GROUP BY tree, pos // 2) t)"""


OP11_SQL = f"""
WITH RECURSIVE leaves AS (
  SELECT *, coalesce('=' || lang, '') AS tree, {_leaf("n_chars")} AS leaf,
    CASE WHEN doc_id IS NOT NULL AND {crc32_sql("doc_id::VARCHAR")} % 7 = 0
         THEN {_leaf("(n_chars + 1)")} ELSE {_leaf("n_chars")} END AS seen
  FROM documents),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos
  FROM leaves),
{_levels("inner_nodes", "SELECT tree, 0 AS level, pos, leaf AS node, "
                        "count(*) OVER (PARTITION BY tree) AS n FROM placed")},
subroots AS (
  SELECT tree, node, row_number() OVER (ORDER BY tree) - 1 AS pos FROM inner_nodes WHERE n = 1),
{_levels("top_nodes", "SELECT '' AS tree, 0 AS level, pos, node, count(*) OVER () AS n FROM subroots")},
proofs AS (
  SELECT p.doc_id, p.tree, p.pos, p.leaf, p.seen, s.node AS subroot, s.pos AS at,
    (SELECT any_value(node) FROM top_nodes WHERE n = 1) AS root
  FROM placed p JOIN subroots s ON p.tree = s.tree),
steps AS (
  SELECT p.tree, p.pos, i.level, i.pos AS sib, i.node
  FROM proofs p JOIN inner_nodes i ON i.tree = p.tree AND i.pos = xor(p.pos >> i.level, 1) AND i.n > 1
  UNION ALL
  SELECT p.tree, p.pos, 1000 + t.level, t.pos, t.node
  FROM proofs p JOIN top_nodes t ON t.pos = xor(p.at >> t.level, 1) AND t.n > 1),
levels AS (
  SELECT tree, level FROM inner_nodes WHERE n > 1 GROUP BY ALL
  UNION ALL
  SELECT s.tree, 1000 + t.level FROM subroots s, (SELECT DISTINCT level FROM top_nodes WHERE n > 1) t),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY level) AS k FROM levels),
path AS (
  SELECT p.tree, p.pos, n.k, s.node,
    CASE WHEN s.node IS NULL THEN '-' WHEN s.sib % 2 = 0 THEN '<' ELSE '>' END AS side
  FROM proofs p JOIN numbered n ON n.tree = p.tree
  LEFT JOIN steps s ON s.tree = p.tree AND s.pos = p.pos AND s.level = n.level),
folds AS (
  SELECT tree, pos, 0::BIGINT AS k, seen AS node FROM proofs
  UNION ALL
  SELECT f.tree, f.pos, p.k, sha256(CASE p.side WHEN '<' THEN p.node || f.node
                                    WHEN '>' THEN f.node || p.node ELSE f.node END)
  FROM folds f JOIN path p ON p.tree = f.tree AND p.pos = f.pos AND p.k = f.k + 1),
ends AS (SELECT tree, pos, max_by(node, k) AS folded_root FROM folds GROUP BY ALL),
digests AS (
  SELECT tree, pos, string_agg(node, '' ORDER BY k) AS hashes FROM path GROUP BY ALL)
SELECT p.doc_id, p.leaf, p.subroot, p.root, sha256(coalesce(d.hashes, '')) AS proof_sha256,
  e.folded_root, e.folded_root = p.root AS verified
FROM proofs p JOIN ends e ON e.tree = p.tree AND e.pos = p.pos
LEFT JOIN digests d ON d.tree = p.tree AND d.pos = p.pos
"""

OP12_SQL = r"""
WITH docs AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
    substr(sha256('mix:' || coalesce(doc_id::VARCHAR, 'null')), 1, 15) AS shuffled
  FROM documents),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
    row_number() OVER (ORDER BY source IS NULL, source) - 1 AS rank FROM docs GROUP BY source),
weighed AS (SELECT *, [5, 2, 1][rank % 3 + 1] AS weight FROM sources),
total AS (SELECT sum(size)::BIGINT AS n FROM docs),
limits AS (
  SELECT *, 3 * source_size AS room,
    sum(3 * source_size) OVER w AS rooms, sum(weight) OVER w AS weights,
    sum(weight) OVER () AS all_weights
  FROM weighed WINDOW w AS (ORDER BY 3 * source_size / weight, rank)),
level AS (
  SELECT min_by((n - (rooms - room)) / (all_weights - weights + weight), (room / weight, rank)) AS height
  FROM limits, total WHERE rooms + room / weight * (all_weights - weights) >= n),
targets AS (
  SELECT source, rank, weight, source_size, least(weight * height, room)::DOUBLE AS target FROM limits, level),
queues AS (
  SELECT d.*, t.rank, t.weight, t.source_size, t.target,
    row_number() OVER w AS place, sum(d.size) OVER w AS sent
  FROM docs d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source
  WINDOW w AS (PARTITION BY t.rank ORDER BY d.shuffled, d.doc_id NULLS FIRST, d.size
               ROWS UNBOUNDED PRECEDING)),
copies AS (
  SELECT q.*, c.turn, (2 * (source_size * c.turn + sent) - size) / (2.0::DOUBLE * weight) AS time
  FROM queues q, (VALUES (0), (1), (2)) c(turn)),
ordered AS (
  SELECT *, sum(size) OVER (ORDER BY time, turn, rank, place ROWS UNBOUNDED PRECEDING) AS upto FROM copies)
SELECT doc_id, size, any_value(source_size) AS source_size, any_value(target) AS target,
  (size * count(*) FILTER (upto <= (SELECT n FROM total)))::BIGINT AS taken
FROM ordered GROUP BY doc_id, size, rank, place
"""

OP13_SQL = rf"""
WITH turns AS (
  SELECT conv_id AS c, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL),
stored AS (
  SELECT *, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST,
    sha256(strlen(role)::VARCHAR || ':' || role || text)) AS i FROM turns),
convs AS (
  SELECT c, c - c % 20 AS base, {crc32_sql("c::VARCHAR")} % 4 AS h FROM turns GROUP BY c),
heads AS (
  SELECT v.c, coalesce(least(v.h, max(s.i)), 0) AS taken FROM convs v LEFT JOIN stored s ON s.c = v.base
  GROUP BY v.c, v.h),
rebuilt AS (
  SELECT v.c, s.i AS d, s.role, s.text FROM convs v JOIN stored s ON s.c = v.base AND s.i <= v.h
  UNION ALL
  SELECT v.c, x.taken + s.i - v.h, s.role, s.text
  FROM convs v JOIN heads x ON x.c = v.c JOIN stored s ON s.c = v.c AND s.i > v.h),
prefixes AS (
  SELECT c, d, text, string_agg(strlen(role)::VARCHAR || ':' || strlen(text)::VARCHAR || ':' || role || text, '')
    OVER (PARTITION BY c ORDER BY d ROWS UNBOUNDED PRECEDING) AS prefix FROM rebuilt
  UNION ALL SELECT c, 0, '', '' FROM convs),
members AS (
  SELECT *, min(c) OVER (PARTITION BY d, prefix) AS owner, max(d) OVER (PARTITION BY c) AS last
  FROM prefixes),
groups AS (
  SELECT owner, d, count(*) AS n_convs,
    (count(*) - 1) * any_value(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+'))) AS saved,
    sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (last = d), '')) AS ends_sha256
  FROM members GROUP BY owner, d),
linked AS (
  SELECT g.*, p.owner AS parent FROM groups g
  LEFT JOIN members p ON p.c = g.owner AND p.d = g.d - 1),
children AS (SELECT parent, d - 1 AS d, count(*) AS n FROM linked WHERE d > 0 GROUP BY ALL),
nodes AS (
  SELECT l.*, coalesce(k.n, 0) AS n_children FROM linked l
  LEFT JOIN children k ON k.parent = l.owner AND k.d = l.d),
subtrees AS (
  SELECT m.owner, m.d, count(*) FILTER (v.n_children = 0) AS n_leaves, sum(v.saved)::BIGINT AS saved_tokens
  FROM nodes v JOIN members m ON m.c = v.owner AND m.d <= v.d GROUP BY m.owner, m.d)
SELECT n.owner AS conv_id, n.d::BIGINT AS depth, n.parent AS parent_conv_id, n.n_convs, n.n_children,
  s.n_leaves, s.saved_tokens, n.ends_sha256
FROM nodes n JOIN subtrees s ON s.owner = n.owner AND s.d = n.d
"""
