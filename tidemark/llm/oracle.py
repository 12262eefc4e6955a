"""SQL of the operators that SQL can state."""

from __future__ import annotations

# crc32 of a whole number's decimal digits: eight shifts for each byte
CRC32 = """
xor(4294967295, list_reduce(
  list_concat([4294967295::BIGINT], list_transform(string_split({value}::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
  lambda c, b: list_reduce(list_concat([xor(c, b)], [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
    lambda d, z: xor(d >> 1, 3988292384::BIGINT * (d & 1)))))"""

WORDS = r"len(regexp_extract_all(coalesce({text}, ''), '[^\x20\x09-\x0D]+'))"


def coded(value: str) -> str:
    return f"coalesce(octet_length(encode({value}::VARCHAR)) || ':' || ({value}::VARCHAR), '-')"


def leaf(text: str) -> str:
    return "sha256(" + " || ".join(coded(v) for v in ("doc_id", "source", "lang", "n_chars", text)) + ")"


def tree(name: str, start: str, levels: int) -> list[str]:
    """Level by level: runs of 16 become one node while their tree has several."""
    out = [f"{name}0 AS (SELECT *, count(*) OVER (PARTITION BY tree) AS n FROM {start})"]
    for i in range(levels):
        out.append(
            f"{name}{i + 1} AS (SELECT tree, pos, node, count(*) OVER (PARTITION BY tree) AS n FROM ("
            f"SELECT tree, pos // 16 AS pos, CASE WHEN any_value(n) = 1 THEN any_value(node) "
            f"ELSE sha256(string_agg(node, '' ORDER BY pos)) END AS node FROM {name}{i} GROUP BY tree, pos // 16))"
        )
    return out


def climb(name: str, tree_name: str, start: str, levels: int) -> list[str]:
    """Each row's siblings and fold, level by level; a tree's only node has none."""
    out = [f"{name}0 AS ({start})"]
    for i in range(levels):
        out.append(
            f"{name}{i + 1} AS (SELECT c.id, c.tree, c.at // 16 AS at, "
            "any_value(c.proof) || coalesce(string_agg(t.node, '' ORDER BY t.pos) FILTER (t.pos <> c.at AND t.n > 1), '') AS proof, "
            "CASE WHEN any_value(t.n) = 1 THEN any_value(c.fold) ELSE "
            "sha256(string_agg(CASE WHEN t.pos = c.at THEN c.fold ELSE t.node END, '' ORDER BY t.pos)) END AS fold "
            f"FROM {name}{i} c JOIN {tree_name}{i} t ON t.tree = c.tree AND t.pos // 16 = c.at // 16 GROUP BY c.id, c.tree, c.at)"
        )
    return out


#: Four levels hold 65,536 documents a source and three 4096 sources.
DOCUMENT_LEVELS, SOURCE_LEVELS = 4, 3

MANIFEST = f"""
WITH docs AS (
  SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS id, coalesce('s' || source, 'n') AS tree, {leaf("text")} AS node,
    CASE WHEN {CRC32.format(value="doc_id")} % 5 = 0
      THEN {leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} END AS claimed
  FROM documents),
placed AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id, node) - 1 AS pos FROM docs),
{", ".join(tree("own", "(SELECT tree, pos, node FROM placed)", DOCUMENT_LEVELS))},
subroots AS (SELECT tree AS name, node, row_number() OVER (ORDER BY encode(tree)) - 1 AS pos FROM own{DOCUMENT_LEVELS}),
{", ".join(tree("top", "(SELECT '' AS tree, pos, node FROM subroots)", SOURCE_LEVELS))},
{", ".join(climb("up", "own", "SELECT id, tree, pos AS at, '' AS proof, coalesce(claimed, node) AS fold FROM placed", DOCUMENT_LEVELS))},
{", ".join(climb("over", "top", f"SELECT id, '' AS tree, s.pos AS at, proof, fold FROM up{DOCUMENT_LEVELS} u JOIN subroots s ON s.name = u.tree", SOURCE_LEVELS))}
SELECT p.doc_id, p.node AS leaf, s.node AS subroot, r.node AS root, sha256(o.proof) AS proof_sha256,
  o.fold AS folded_root, o.fold = r.node AS verified
FROM placed p JOIN subroots s ON s.name = p.tree JOIN over{SOURCE_LEVELS} o ON o.id = p.id, top{SOURCE_LEVELS} r
"""

MIX = f"""
WITH sized AS (
  SELECT doc_id, source, {WORDS.format(text="text")} AS size,
    md5('0:' || coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, ''))) AS key FROM documents),
sources AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
weighed AS (SELECT *, [5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS w, 2.0::DOUBLE * source_size AS most,
    1.5::DOUBLE * sum(source_size) OVER () AS whole FROM sources),
filled AS (SELECT *, whole - coalesce(sum(most) OVER (ORDER BY most / w, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
    sum(w) OVER (ORDER BY most / w, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS free FROM weighed),
level AS (SELECT arg_min(rest, most / w) AS rest, arg_min(free, most / w) AS free FROM filled WHERE most * free >= rest * w),
targets AS (SELECT source, source_size, least(most, w * level.rest / level.free) AS target FROM filled, level),
placed AS (SELECT s.*, t.source_size, t.target,
    sum(size) OVER (PARTITION BY s.source ORDER BY key ROWS UNBOUNDED PRECEDING) - size AS before
  FROM sized s JOIN targets t ON t.source IS NOT DISTINCT FROM s.source),
cut AS (SELECT *, floor(target)::BIGINT // source_size AS times, floor(target)::BIGINT % source_size AS rest FROM placed)
SELECT doc_id, size::BIGINT AS size, source_size, target,
  (times * size + least(greatest(rest - before, 0), size))::BIGINT AS taken FROM cut
"""

TRIE = f"""
WITH turns AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS place, coalesce(role, '') AS role,
    coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
convs AS (SELECT conv_id, conv_id - conv_id % 20 AS base, {CRC32.format(value="conv_id")} % 4 AS h, count(*) AS turns
  FROM turns GROUP BY conv_id),
based AS (SELECT c.*, least(c.h, coalesce(b.turns, 0)) AS taken FROM convs c LEFT JOIN convs b ON b.conv_id = c.base),
rebuilt AS (
  SELECT c.conv_id, t.place AS depth, role, text FROM based c JOIN turns t ON t.conv_id = c.base AND t.place <= c.h
  UNION ALL
  SELECT c.conv_id, t.place - c.h + c.taken, role, text FROM based c JOIN turns t ON t.conv_id = c.conv_id AND t.place > c.h),
chained AS (
  SELECT conv_id, depth, {WORDS.format(text="text")} AS words,
    string_agg(sha256(role || ':' || length(role) || ':' || text), '') OVER (PARTITION BY conv_id ORDER BY depth) AS path
  FROM rebuilt
  UNION ALL SELECT conv_id, 0, 0, '' FROM convs),
placed AS (SELECT *, min(conv_id) OVER (PARTITION BY path) AS node, count(*) OVER (PARTITION BY path) AS n_convs,
    max(depth) OVER (PARTITION BY conv_id) AS length FROM chained),
nodes AS (SELECT node AS conv_id, depth, any_value(n_convs) AS n_convs, any_value(words) AS words,
    coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (length = depth), '') AS ends
  FROM placed GROUP BY node, depth),
parents AS (SELECT n.*, p.node AS parent_conv_id FROM nodes n LEFT JOIN placed p ON p.conv_id = n.conv_id AND p.depth = n.depth - 1),
families AS (SELECT parent_conv_id, depth - 1 AS depth, count(*) AS n_children FROM parents WHERE depth > 0 GROUP BY ALL),
sized AS (SELECT p.*, coalesce(f.n_children, 0) AS n_children FROM parents p
  LEFT JOIN families f ON f.parent_conv_id = p.conv_id AND f.depth = p.depth),
subtrees AS (
  SELECT a.node AS conv_id, a.depth, count(*) FILTER (s.n_children = 0) AS n_leaves, sum((s.n_convs - 1) * s.words)::BIGINT AS saved_tokens
  FROM sized s JOIN placed a ON a.conv_id = s.conv_id AND a.depth <= s.depth GROUP BY ALL)
SELECT s.conv_id, s.depth, s.parent_conv_id, s.n_convs, s.n_children, n_leaves, saved_tokens, sha256(ends) AS ends_sha256
FROM sized s JOIN subtrees t ON t.conv_id = s.conv_id AND t.depth = s.depth
"""
