"""SQL counterparts of the queries whose results SQL can express, by plainer methods."""

from __future__ import annotations

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: All distances; components are added in their order, as the operator adds them.
NEAREST = """
WITH usable AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings
    WHERE vec_id IS NOT NULL AND len(embedding) = 64
      AND list_bool_and(list_transform(embedding,
                                       lambda x: coalesce(isfinite(CAST(x AS DOUBLE)), false)))
      AND list_bool_or(list_transform(embedding, lambda x: x <> 0))),
pairs AS (
    SELECT q.vec_id AS query_id, v.vec_id,
           list_transform(list_zip(q.e, v.e),
                          lambda p: (p[1] - p[2]) * (p[1] - p[2])) AS squares
    FROM usable q JOIN usable v ON v.vec_id <> q.vec_id WHERE q.vec_id % 100 = 0),
scored AS (
    SELECT query_id, vec_id,
           sqrt(list_reduce(list_prepend(CAST(0 AS DOUBLE), squares),
                            lambda a, b: a + b)) AS score FROM pairs),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS place
    FROM scored)
SELECT query_id, CAST(place AS INTEGER) AS rank, vec_id, score FROM ranked WHERE place <= 10
"""


def _base32(digest: str) -> str:
    """Base32 of a 40-digit hexadecimal text, five bits at a time."""
    alphabet = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    digits = []
    for group in range(4):
        number = f"CAST('0x' || substr({digest}, {1 + 10 * group}, 10) AS UBIGINT)"
        digits += [
            f"substr('{alphabet}', CAST(({number} // {32 ** place}) % 32 AS INTEGER) + 1, 1)"
            for place in range(7, -1, -1)
        ]
    return " || ".join(digits)


PAGES = f"""
WITH payloads AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
known AS (
    SELECT page_id, strlen(payload) AS size, sha1(payload) AS hex,
           min(page_id) OVER (PARTITION BY payload) AS origin
    FROM payloads)
SELECT page_id, CAST(size AS BIGINT) AS payload_bytes, {_base32('hex')} AS payload_digest,
       CASE WHEN page_id = origin THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> origin THEN origin END AS refers_to
FROM known
"""


def _words(table: str) -> str:
    lowered = f"translate(coalesce({table}.text, ''), '{UPPER}', '{LOWER}')"
    return f"regexp_extract_all({lowered}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"


PASSAGES = f"""
WITH docs AS (SELECT doc_id, {_words('documents')} AS words FROM documents),
asked AS (SELECT item_id, {_words('benchmark')} AS words FROM benchmark),
starts AS (
    SELECT item_id, words, unnest(range(1, greatest(len(words) - 9, 1) + 1)) AS s
    FROM asked WHERE len(words) > 0),
windows AS (
    SELECT DISTINCT item_id, array_to_string(words[s : s + 9], ' ') AS passage,
           len(words[s : s + 9]) AS n
    FROM starts),
places AS (
    SELECT doc_id, words, n, unnest(range(1, len(words) - n + 2)) AS s
    FROM docs, (SELECT DISTINCT n FROM windows) sizes WHERE len(words) >= n),
found AS (
    SELECT doc_id, s, windows.n, item_id
    FROM places JOIN windows
      ON windows.n = places.n AND passage = array_to_string(words[s : s + places.n - 1], ' ')),
hits AS (
    SELECT doc_id, count(DISTINCT word) AS n_hit
    FROM (SELECT doc_id, unnest(range(s, s + n)) AS word FROM found) w GROUP BY doc_id),
items AS (
    SELECT doc_id, count(*) AS n_items, string_agg(name, ',' ORDER BY name) AS names
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS name FROM found) i GROUP BY doc_id)
SELECT docs.doc_id, CAST(len(words) AS BIGINT) AS n_words,
       CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)
"""

def _field(column: str) -> str:
    text = f"CAST({column} AS VARCHAR)"
    return f"CASE WHEN {column} IS NULL THEN '-' ELSE strlen({text}) || ':' || {text} END"


def _leaf(text: str) -> str:
    fields = " || ".join(map(_field, ("doc_id", "source", "lang", "n_chars", text)))
    return f"sha256({fields})"


def _crc32(text: str) -> str:
    """CRC-32 of an ASCII text, bit by bit."""
    codes = f"list_transform(string_split({text}, ''), lambda c: CAST(ascii(c) AS UBIGINT))"
    bit = "xor(x >> 1, CASE WHEN x % 2 = 1 THEN 3988292384::UBIGINT ELSE 0::UBIGINT END)"
    bits = "[" + ", ".join(["0::UBIGINT"] * 8) + "]"
    byte = f"list_reduce(list_prepend(xor(crc, code), {bits}), lambda x, y: {bit})"
    return (
        f"xor(4294967295::UBIGINT, list_reduce(list_prepend(4294967295::UBIGINT, {codes}),"
        f" lambda crc, code: {byte}))"
    )


def _levels(name: str, leaves: str, tree: str) -> str:
    """A tree level by level, until one node is left, and the siblings of each node."""
    return f"""
{name}(tree, lvl, place, node, n) AS (
    SELECT {tree}, 0, place, node, n FROM {leaves}
    UNION ALL
    SELECT tree, lvl + 1, place // 8, sha256(string_agg(node, '' ORDER BY place)), (n + 7) // 8
    FROM {name} WHERE n > 1 GROUP BY tree, lvl, place // 8, n),
{name}_runs AS (
    SELECT tree, lvl, place // 8 AS run, list(node ORDER BY place) AS nodes FROM {name}
    WHERE n > 1 GROUP BY tree, lvl, place // 8),
{name}_siblings AS (
    SELECT a.tree, a.lvl, a.place,
           array_to_string(nodes[1 : CAST(a.place % 8 AS INTEGER)], '') AS before,
           array_to_string(nodes[CAST(a.place % 8 AS INTEGER) + 2 :], '') AS after
    FROM {name} a JOIN {name}_runs r
      ON r.tree = a.tree AND r.lvl = a.lvl AND r.run = a.place // 8 WHERE a.n > 1)"""


def _climb(name: str, start: str, levels: str) -> str:
    """Nodes folded with their siblings up to the root of ``levels``."""
    return f"""
{name}(item, tree, lvl, place, node, proof) AS (
    SELECT item, tree, 0, place, node, proof FROM {start}
    UNION ALL
    SELECT c.item, c.tree, c.lvl + 1, c.place // 8, sha256(before || c.node || after),
           c.proof || before || after
    FROM {name} c JOIN {levels}_siblings s
      ON s.tree = c.tree AND s.lvl = c.lvl AND s.place = c.place),
{name}_top AS (
    SELECT item, arg_max(node, lvl) AS node, arg_max(proof, lvl) AS proof
    FROM {name} GROUP BY item)"""


MANIFEST = f"""
WITH RECURSIVE hashed AS (
    SELECT doc_id, lang, {_leaf('text')} AS node,
           CASE WHEN {_crc32('CAST(doc_id AS VARCHAR)')} % 3 = 0
                THEN {_leaf(f"translate(text, '{UPPER}', '{LOWER}')")}
                ELSE {_leaf('text')} END AS claimed
    FROM documents),
leaves AS (
    SELECT *, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree,
           row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, node) - 1 AS place,
           row_number() OVER (ORDER BY lang NULLS FIRST, doc_id NULLS FIRST, node) AS item,
           count(*) OVER (PARTITION BY lang) AS n
    FROM hashed),
{_levels('grown', 'leaves', 'tree')},
subroots AS (
    SELECT tree AS place, node, count(*) OVER () AS n FROM grown WHERE n = 1),
{_levels('crown', 'subroots', '0')},
claims AS (SELECT item, tree, place, claimed AS node, '' AS proof FROM leaves),
{_climb('inner_climb', 'claims', 'grown')},
entering AS (
    SELECT t.item, 0 AS tree, l.tree AS place, t.node, t.proof
    FROM inner_climb_top t JOIN leaves l ON l.item = t.item),
{_climb('outer_climb', 'entering', 'crown')}
SELECT l.doc_id, l.node AS leaf, s.node AS subroot, r.node AS root,
       sha256(t.proof) AS proof_sha256, t.node AS folded_root, t.node = r.node AS verified
FROM leaves l JOIN subroots s ON s.place = l.tree JOIN outer_climb_top t ON t.item = l.item,
     (SELECT node FROM crown WHERE n = 1) r
"""

ORACLES = {
    "op3_nearest": NEAREST,
    "op8_warc_round_trip": PAGES,
    "op10_decontamination": PASSAGES,
    "op11_merkle_manifest": MANIFEST,
}
