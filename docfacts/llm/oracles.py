"""The operators that SQL can state, in SQL over the same tables."""

from __future__ import annotations

from docfacts.llm import hash_tree

_TABLE = """
    SELECT list_transform(range(256), lambda n: list_reduce([n] || range(8),
               lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)) AS tab"""


def crc32(text: str) -> str:
    """CRC-32 of a text's UTF-8 bytes, byte by byte; reads ``tab`` of the table of 256 entries."""
    digits = f"regexp_extract_all(hex(encode({text})), '..')"
    numbers = f"list_transform({digits}, lambda d: CAST('0x' || d AS BIGINT))"
    step = "lambda a, b: xor(a >> 8, tab[(xor(a, b) & 255) + 1])"
    return f"xor(list_reduce([4294967295::BIGINT] || {numbers}, {step}), 4294967295)"


def _descent(name: str, shards: list[hash_tree.Shard]) -> str:
    """Blocks that take each key of ``keys`` down a tree, level by level."""
    rows = ", ".join(
        f"('{node}', '{path}', {weight!r}, {number})"
        for node, below in hash_tree.tree(shards).items()
        for path, weight, number in below
    )
    blocks = [f"{name}_tree(node, path, weight, number) AS (VALUES {rows})"]
    above = "SELECT key, '' AS node FROM keys"
    for level in range(3):
        blocks.append(f"""{name}_{level} AS (
            SELECT key, path AS node, number FROM ({above}) JOIN {name}_tree USING (node)
            QUALIFY row_number() OVER (PARTITION BY key ORDER BY
                -ln((CAST('0x' || substr(md5('{hash_tree.SEED}:' || path || ':' || key), 1, {hash_tree.DIGITS}) AS BIGINT) + 0.5)
                    / {float(16**hash_tree.DIGITS)!r}) / weight, path) = 1)""")
        above = f"SELECT key, node FROM {name}_{level}"
    return ", ".join(blocks)


SHARDS = 8
_NOW = hash_tree.topology(SHARDS)
_HASH_TREE = f"""
    WITH crc AS ({_TABLE}),
    sized AS (SELECT doc_id, coalesce(CAST(doc_id AS VARCHAR), '') AS key,
                     strlen(coalesce(text, '')) + 1 AS size, {crc32("coalesce(text, '')")} AS text_crc32
              FROM documents, crc),
    keys AS (SELECT DISTINCT key FROM sized),
    {_descent("now", _NOW)}, {_descent("grown", hash_tree.extended(_NOW))}
    SELECT doc_id, size, text_crc32, 'key' AS law, n.number AS shard,
           row_number() OVER (PARTITION BY n.number ORDER BY
               substr(md5(key || ':' || size || ':' || text_crc32), 1, {hash_tree.BUCKET_DIGITS}),
               doc_id NULLS LAST, size, text_crc32) - 1 AS slot,
           g.number AS grown_shard
    FROM sized JOIN now_2 n USING (key) JOIN grown_2 g USING (key)"""

# Nodes are grouped by the list of their turns itself, subtrees by all ancestors of a node.
_PREFIX_TRIE = f"""
    WITH crc AS ({_TABLE}),
    own AS (SELECT conv_id, list({{'role': coalesce(role, ''), 'text': coalesce(text, '')}}
                                 ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS turns
            FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
    cut AS (SELECT conv_id, turns, {crc32("CAST(conv_id AS VARCHAR)")} % 6 AS h FROM own, crc),
    rebuilt AS (SELECT c.conv_id, list_concat(coalesce(b.turns[1:c.h], []), c.turns[c.h + 1:]) AS turns
                FROM cut c LEFT JOIN own b ON b.conv_id = c.conv_id - c.conv_id % 100),
    member AS (SELECT conv_id, depth, turns[1:depth] AS path, depth = len(turns) AS ends
               FROM (SELECT *, unnest(range(len(turns) + 1)) AS depth FROM rebuilt)),
    node AS (SELECT depth, path, min(conv_id) AS conv_id, count(*) AS n_convs,
                    (count(*) - 1) * CASE WHEN depth = 0 THEN 0 ELSE length(path[depth].text) END AS saved,
                    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), ''))
                        AS ends_sha256
             FROM member GROUP BY depth, path),
    above AS (SELECT *, unnest(range(depth + 1)) AS up FROM node),
    kids AS (SELECT path[1:depth - 1] AS path, count(*) AS n FROM node WHERE depth > 0 GROUP BY 1),
    leafy AS (SELECT node.path, kids.path IS NULL AS leaf FROM node LEFT JOIN kids USING (path)),
    below AS (SELECT a.path[1:up] AS path, sum(saved) AS saved, count(*) FILTER (leaf) AS leaves
              FROM above a JOIN leafy USING (path) GROUP BY 1)
    SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(kids.n, 0) AS n_children,
           below.leaves AS n_leaves, CAST(below.saved AS BIGINT) AS saved_tokens, n.ends_sha256
    FROM node n JOIN below USING (path) LEFT JOIN kids USING (path)
    LEFT JOIN node p ON n.depth > 0 AND p.path = n.path[1:n.depth - 1]"""

_RESAMPLING = f"""
    WITH crc AS ({_TABLE}),
    docs AS (SELECT row_number() OVER () AS r, doc_id,
                    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                       '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+') AS words FROM documents),
    wanted AS (SELECT unnest(regexp_extract_all(
                   translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+')) AS word FROM benchmark),
    given AS (SELECT r, unnest(words) AS word FROM docs),
    hashed AS (SELECT word, {crc32("word")} % 10000 AS bucket
               FROM (SELECT word FROM given UNION SELECT word FROM wanted), crc),
    totals AS (SELECT bucket, count(*) FILTER (mine) AS s, count(*) FILTER (NOT mine) AS t
               FROM (SELECT word, true AS mine FROM given UNION ALL SELECT word, false FROM wanted)
               JOIN hashed USING (word) GROUP BY bucket),
    sums AS (SELECT CAST(sum(s) AS BIGINT) AS all_s, CAST(sum(t) AS BIGINT) AS all_t FROM totals),
    gains AS (SELECT bucket, CAST(floor(1000 * ln(CAST((t + 1) * (all_s + 10000) AS DOUBLE)
                                                  / CAST((s + 1) * (all_t + 10000) AS DOUBLE))) AS BIGINT) AS gain
              FROM totals, sums),
    weights AS (SELECT r, count(*) AS n, CAST(floor(sum(gain) / count(*)) AS BIGINT) AS w
                FROM given JOIN hashed USING (word) JOIN gains USING (bucket) GROUP BY r),
    scored AS (SELECT doc_id, len(words) AS n_words, len(words) AS n_features, coalesce(w, 0) AS weight,
                      coalesce(w, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256(
                          '2024:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) + 0.5) / 4294967296.0))) AS BIGINT) AS score
               FROM docs LEFT JOIN weights USING (r)),
    placed AS (SELECT *, row_number() OVER (PARTITION BY n_words >= 20
                                            ORDER BY score DESC, doc_id NULLS LAST, n_features, weight) AS place,
                      10 * count(*) FILTER (n_words >= 20) OVER () // 100 AS drawn FROM scored)
    SELECT doc_id, n_words, n_features, weight, score,
           CASE WHEN n_words >= 20 AND place <= drawn THEN place END AS rank FROM placed"""

ORACLES = {
    "op11_hash_tree": _HASH_TREE,
    "op12_prefix_trie": _PREFIX_TRIE,
    "op13_resampling": _RESAMPLING,
}
