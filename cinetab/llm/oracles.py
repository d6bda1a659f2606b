"""DuckDB SQL for the queries that SQL can express on whole tables."""

from __future__ import annotations

#: Words, and the text with null as empty.
_DOCS = r"""d AS (SELECT doc_id, source, coalesce(text, '') AS text, row_number() OVER () AS k FROM documents),
    w AS (SELECT *, list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM d)"""


def _crc32(text: str) -> str:
    """CRC-32 of a text's UTF-8 bytes, byte by byte with the table ``t.t`` of 256 remainders."""
    some = f"list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda x: ('0x' || x)::BIGINT)"
    return f"xor(list_reduce({some}, lambda c, b: xor(c >> 8, t.t[(xor(c, b) & 255) + 1]), 4294967295), 4294967295)"


def _digits(digest: str, first: int, n: int) -> str:
    return f"('0x' || substr({digest}, {first}, {n}))::BIGINT"


def _time(digest: str) -> str:
    return f"-ln(({_digits(digest, 1, 15)} + 0.5) / 1152921504606846976.0) / 12"


def _leaf(digest: str, region: str) -> str:
    """The place of an attempt: 12 a region, in 3 racks of 4."""
    return f"({region} * 12 + CAST(floor({_digits(digest, 16, 6)} * 3 / 16777216) AS INT) * 4 + CAST(floor({_digits(digest, 22, 6)} * 4 / 16777216) AS INT))"


#: Two full regions of 12 shards have one attempt each; the 25th shard stands at the first attempt in its region that ends at its place.
_PLACED = f"""h AS (SELECT *, md5(id || ':0:1') AS h0, md5(id || ':1:1') AS h1, list_transform(range(1, 65), lambda j: md5(id || ':2:' || j)) AS h2 FROM c),
    e AS (SELECT *, {_time('h0')} AS t0, {_time('h1')} AS t1, list_position(list_transform(h2, lambda x: {_leaf('x', '2')}), 24) AS hit FROM h),
    s AS (SELECT *, CASE WHEN t0 < t1 THEN {_leaf('h0', '0')} ELSE {_leaf('h1', '1')} END AS shard, hit > 0 AND list_sum(list_transform(h2[:hit], lambda x: {_time('x')})) < least(t0, t1) AS moves FROM e)"""

_SHARDING = f"""WITH t AS (SELECT list_transform(range(0, 256), lambda n: list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
    d AS (SELECT doc_id, coalesce(CAST(doc_id AS VARCHAR), '') AS id, coalesce(text, '') AS text FROM documents),
    c AS (SELECT doc_id, id, octet_length(encode(text)) + 8 AS size, {_crc32('text')} AS crc FROM d, t),
    {_PLACED},
    p AS (SELECT *, {_crc32("(id || ':' || crc)")} % 1024 AS bucket FROM s, t)
    SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(crc AS BIGINT) AS text_crc32, 'key' AS law, shard,
      row_number() OVER (PARTITION BY shard ORDER BY bucket, doc_id NULLS FIRST, crc, size) - 1 AS slot, CASE WHEN moves THEN 24 ELSE shard END AS grown_shard FROM p"""

#: The water level: the first number of capped sources, by cap per weight, whose level caps no further one.
_MIXING = f"""WITH {_DOCS},
    z AS (SELECT k, doc_id, source, len(words) AS size, ('0x' || substr(md5('17:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || text), 1, 15))::BIGINT AS draw FROM w),
    s AS (SELECT source, sum(size) AS source_size FROM z GROUP BY source),
    r AS (SELECT *, CAST((row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 + 1 AS DOUBLE) AS weight, CAST(source_size * 3 AS DOUBLE) AS cap FROM s),
    o AS (SELECT *, cap / weight AS full_at, (sum(source_size) OVER () - coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
      / sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM r WINDOW o AS (ORDER BY cap / weight, encode(source) NULLS LAST)),
    g AS (SELECT source, source_size, least(cap, coalesce((SELECT max(level) FROM o WHERE full_at >= level), 0) * weight) AS target FROM o),
    p AS (SELECT *, CAST(floor(CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END + 1e-12) AS BIGINT) AS whole FROM g),
    q AS (SELECT z.*, p.source_size, p.target, p.whole, greatest(CAST(round_even(p.target, 0) AS BIGINT) - p.whole * p.source_size, 0) AS rest,
      sum(z.size) OVER (PARTITION BY z.source ORDER BY draw, doc_id NULLS FIRST, z.size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - z.size AS past FROM z JOIN p ON z.source IS NOT DISTINCT FROM p.source)
    SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(source_size AS BIGINT) AS source_size, target, CAST(whole * size + least(greatest(rest - past, 0), size) AS BIGINT) AS taken FROM q"""

_RULES = rf"""WITH {_DOCS},
    l AS (SELECT *, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines,
      list_transform(range(1, len(words) - 3), lambda i: {{'g': list_aggregate(words[i : i + 4], 'string_agg', ' '), 'i': i}}) AS grams FROM w),
    u AS (SELECT k, unnest(grams, recursive := true) FROM l), n AS (SELECT k, i, count(*) OVER (PARTITION BY k, g) AS n FROM u),
    c AS (SELECT k, count(DISTINCT i + j) AS n_repeat_words FROM n, range(0, 5) x(j) WHERE n > 1 GROUP BY k),
    m AS (SELECT l.k, doc_id, len(words) AS n_words, CAST(coalesce(list_sum(list_transform(words, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
      length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols, len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
      length(text) - length(regexp_replace(text, '[A-Z]', '', 'g')) AS n_upper, length(text) - length(regexp_replace(text, '[A-Za-z]', '', 'g')) AS n_letters, coalesce(c.n_repeat_words, 0) AS n_repeat_words
      FROM l LEFT JOIN c ON l.k = c.k),
    f AS (SELECT *, (n_words < 10)::BIGINT + 2 * (100 * n_repeat_words > 20 * n_words)::BIGINT + 4 * (10 * n_symbols > 3 * n_words)::BIGINT + 8 * (2 * n_dup_lines > n_lines)::BIGINT
      + 16 * (word_chars > 25 * n_words)::BIGINT + 32 * (word_chars < 2 * n_words)::BIGINT + 64 * (10 * n_upper > 6 * n_letters)::BIGINT AS failed FROM m)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, failed & 3 > 0 AS base_failed, failed = 0 AS kept, failed FROM f"""

#: A prefix is the MD5s of its turns one after another; a node's subtree is found from the prefixes of each node below it.
_TRIE = f"""WITH t AS (SELECT list_transform(range(0, 256), lambda n: list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
    u AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS place FROM conversations WHERE conv_id IS NOT NULL),
    n AS (SELECT conv_id, CAST(conv_id AS VARCHAR) AS id, count(*) AS n FROM u GROUP BY conv_id),
    c AS (SELECT conv_id, n, conv_id - conv_id % 100 AS base, {_crc32("id")} % 6 AS h FROM n, t),
    r AS (SELECT c.conv_id, u.place AS depth, role, text FROM c JOIN u ON u.conv_id = c.base AND u.place <= c.h
      UNION ALL SELECT c.conv_id, u.place - c.h + least(c.h, coalesce(b.n, 0)), role, text FROM c JOIN u ON u.conv_id = c.conv_id AND u.place > c.h LEFT JOIN n b ON b.conv_id = c.base),
    p AS (SELECT conv_id, depth, text, string_agg(md5(length(role) || ':' || role || text), '') OVER (PARTITION BY conv_id ORDER BY depth) AS key FROM r UNION ALL SELECT conv_id, 0, '', '' FROM c),
    g AS (SELECT depth, key, min(conv_id) AS conv_id, count(*) AS n_convs, max(length(text)) AS chars FROM p GROUP BY depth, key),
    k AS (SELECT left(key, length(key) - 32) AS key, count(*) AS n_children FROM g WHERE depth > 0 GROUP BY 1),
    e AS (SELECT key, string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) AS ids FROM (SELECT conv_id, arg_max(key, depth) AS key FROM p GROUP BY conv_id) GROUP BY key),
    o AS (SELECT g.*, coalesce(k.n_children, 0) AS n_children, coalesce(e.ids, '') AS ids FROM g LEFT JOIN k ON g.key = k.key LEFT JOIN e ON g.key = e.key),
    s AS (SELECT p.key, sum(CASE WHEN o.n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum((o.n_convs - 1) * o.chars) AS saved FROM o JOIN p ON p.conv_id = o.conv_id AND p.depth <= o.depth GROUP BY p.key)
    SELECT o.conv_id, CAST(o.depth AS BIGINT) AS depth, a.conv_id AS parent_conv_id, o.n_convs, CAST(o.n_children AS BIGINT) AS n_children, CAST(n_leaves AS BIGINT) AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens, sha256(ids) AS ends_sha256
      FROM o JOIN s ON o.key = s.key LEFT JOIN g a ON o.depth > 0 AND a.depth = o.depth - 1 AND a.key = left(o.key, length(o.key) - 32)"""

_TOPK = """WITH v AS (SELECT row_number() OVER () AS k, vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v FROM embeddings
      WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS (SELECT q.k, q.vec_id AS query_id, v.vec_id, CAST(list_dot_product(q.v, v.v) AS BIGINT) AS score FROM v q, v WHERE q.vec_id % 100 = 0 AND v.k <> q.k),
    r AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY score DESC, vec_id NULLS LAST) AS rank FROM s)
    SELECT query_id, CAST(rank AS INT) AS rank, vec_id, score FROM r WHERE rank <= 10"""

ORACLES: dict[str, str] = {"op3_sharding": _SHARDING, "op4_mixing": _MIXING, "op10_rules": _RULES, "op11_trie": _TRIE, "op12_topk": _TOPK}
