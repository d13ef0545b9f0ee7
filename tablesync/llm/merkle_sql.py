"""SQL of the Merkle manifest: the tree level by level, one common table expression a level."""

#: 3^12 rows a source and 3^8 sources.
LEAF_LEVELS, SOURCE_LEVELS = 12, 8


def _levels(name: str, levels: int) -> str:
    """From <name>0 (key, pos, n, h): <name>1... with the level's nodes, and <name>s1... with each node's siblings."""
    parts = []
    for k in range(1, levels + 1):
        more = f"n > {3 ** (k - 1)}"
        parts.append(
            f"{name}{k} AS (SELECT key, pos // 3 AS pos, n, CASE WHEN {more} THEN sha256(string_agg(h, '' ORDER BY pos)) ELSE min(h) END AS h "
            f"FROM {name}{k - 1} GROUP BY key, pos // 3, n)"
        )
        side = "coalesce(string_agg(h, '') OVER (PARTITION BY key, pos // 3 ORDER BY pos ROWS BETWEEN {} AND {}), '')"
        parts.append(
            f"{name}s{k} AS (SELECT key, pos, {more} AS more, {side.format('UNBOUNDED PRECEDING', '1 PRECEDING')} AS l, "
            f"{side.format('1 FOLLOWING', 'UNBOUNDED FOLLOWING')} AS r FROM {name}{k - 1})"
        )
    return ", ".join(parts)


def _walk(name: str, siblings: str, levels: int, key: str, pos: str) -> str:
    """From <name>0 with proof and fold: the same after each level."""
    parts = []
    for k in range(1, levels + 1):
        parts.append(
            f"{name}{k} AS (SELECT p.* EXCLUDE (proof, fold), CASE WHEN s.more THEN proof || l || r ELSE proof END AS proof, "
            f"CASE WHEN s.more THEN sha256(l || fold || r) ELSE fold END AS fold "
            f"FROM {name}{k - 1} p JOIN {siblings}s{k} s ON p.{key} = s.key AND p.{pos} // {3 ** (k - 1)} = s.pos)"
        )
    return ", ".join(parts)


def manifest_sql() -> str:
    framed = lambda c: f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')"
    front = " || ".join(framed(c) for c in ("doc_id", "source", "lang", "n_chars"))
    crc = (
        "list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))), "
        "lambda crc, byte: list_reduce([xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, i: xor(x >> 1, (x & 1) * 3988292384)))"
    )
    return f"""
    WITH d AS (
        SELECT doc_id, CASE WHEN source IS NULL THEN '' ELSE '=' || source END AS key, sha256({front} || {framed('text')}) AS leaf,
               sha256({front} || CASE WHEN xor({crc}, 4294967295) % 2 = 0 THEN {framed("replace(text, chr(10), '')")} ELSE {framed('text')} END) AS start
        FROM documents),
    placed AS (
        SELECT *, row_number() OVER (PARTITION BY key ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY key) AS n FROM d),
    a0 AS (SELECT key, pos, n, leaf AS h FROM placed),
    {_levels('a', LEAF_LEVELS)},
    b0 AS (SELECT '' AS key, row_number() OVER (ORDER BY key) - 1 AS pos, count(*) OVER () AS n, h, key AS of FROM a{LEAF_LEVELS}),
    {_levels('b', SOURCE_LEVELS)},
    p0 AS (SELECT *, '' AS proof, start AS fold FROM placed),
    {_walk('p', 'a', LEAF_LEVELS, 'key', 'pos')},
    q0 AS (SELECT p.*, b.h AS subroot, '' AS tree, b.pos AS place FROM p{LEAF_LEVELS} p JOIN b0 b ON p.key = b.of),
    {_walk('q', 'b', SOURCE_LEVELS, 'tree', 'place')}
    SELECT doc_id, leaf, subroot, b.h AS root, sha256(proof) AS proof_sha256, fold AS folded_root, fold = b.h AS verified
    FROM q{SOURCE_LEVELS}, b{SOURCE_LEVELS} b
    """
