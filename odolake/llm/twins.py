"""SQL twins of the operators' queries, for DuckDB."""

from __future__ import annotations

#: crc32 of the UTF-8 bytes of the text that ``{0}`` gives; ``crc`` is the table of the polynomial's remainders.
_CRC_TABLE = """
bits(n, k, c) AS (
    SELECT range, 0, range FROM range(256)
    UNION ALL
    SELECT n, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM bits WHERE k < 8
),
crc AS (SELECT list(c ORDER BY n) AS steps FROM bits WHERE k = 8)"""
_CRC = """xor(list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(regexp_extract_all(hex(encode({0})), '..'), lambda h: ('0x' || h)::BIGINT)),
    lambda a, b: xor(a >> 8, crc.steps[(xor(a, b) & 255) + 1])), 4294967295)"""

SHARDS = f"""
WITH RECURSIVE {_CRC_TABLE},
sized AS (
    SELECT doc_id, coalesce(('0x' || substr(md5(text), 1, 15))::BIGINT, -1) AS k1,
           coalesce(octet_length(encode(text)), 0) + 1 AS size, {_CRC.format("coalesce(text, '')")} AS text_crc32
    FROM documents, crc
),
laid AS (
    SELECT *, sum(size) OVER lying - size AS start, sum(size) OVER () AS total, row_number() OVER lying AS place
    FROM sized WINDOW lying AS (ORDER BY k1, doc_id NULLS FIRST ROWS UNBOUNDED PRECEDING)
),
texts AS (SELECT k1, min(start) AS start, sum(size) AS bytes, any_value(total) AS total FROM laid GROUP BY k1),
cuts AS (
    SELECT i, CASE WHEN t.bytes * 16 * 32 > t.total THEN i * t.total // 16
                   WHEN 2 * (i * t.total // 16 - t.start) <= t.bytes THEN t.start ELSE t.start + t.bytes END AS cut
    FROM range(1, 16) r(i) JOIN texts t ON i * t.total // 16 >= t.start AND i * t.total // 16 < t.start + t.bytes
),
dealt AS (SELECT l.*, (SELECT count(*) FROM cuts WHERE 2 * cut <= 2 * l.start + l.size) AS shard FROM laid l)
SELECT doc_id, size::BIGINT AS size, text_crc32::BIGINT AS text_crc32, 'bytes' AS law, shard::INT AS shard,
       (place - min(place) OVER (PARTITION BY shard))::BIGINT AS slot, NULL::INT AS grown_shard
FROM dealt
"""


def _leaf(text: str) -> str:
    fields = ["doc_id", "source", "lang", "n_chars", text]
    return "sha256(concat(" + ", ".join(
        f"CASE WHEN {f} IS NULL THEN '-' ELSE octet_length(encode({f}::VARCHAR)) || ':' || {f} END" for f in fields
    ) + "))"


#: Rows of all levels: a node holds its parent's number; sources stand in one tree under the key 0.
_TREE = """
    SELECT {key} AS tree, 0 AS level, {pos} AS pos, {digest} AS digest, {count} AS n, []::VARCHAR[] AS kids FROM {rows}
    UNION ALL
    SELECT tree, level + 1, pos // 3, sha256(string_agg(digest, '' ORDER BY pos)), (max(n) + 2) // 3, list(digest ORDER BY pos)
    FROM {name} WHERE n > 1 GROUP BY tree, level, pos // 3"""

MANIFEST = f"""
WITH RECURSIVE {_CRC_TABLE},
rows AS (
    SELECT doc_id, coalesce('=' || source, '') AS tree, {_leaf("text")} AS leaf,
           CASE WHEN {_CRC.format("doc_id::VARCHAR")} % 2 = 0 THEN {_leaf("replace(text, chr(10), '')")} ELSE {_leaf("text")} END AS shown
    FROM documents, crc
),
leaves AS (
    SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY tree) AS n
    FROM rows
),
nodes(tree, level, pos, digest, n, kids) AS ({_TREE.format(key="tree", pos="pos", digest="leaf", count="n", rows="leaves", name="nodes")}),
subroots AS (
    SELECT tree, digest AS subroot, row_number() OVER (ORDER BY encode(tree)) - 1 AS pos, count(*) OVER () AS n FROM nodes WHERE n = 1
),
tops(tree, level, pos, digest, n, kids) AS ({_TREE.format(key="0", pos="pos", digest="subroot", count="n", rows="subroots", name="tops")}),
{{lower}},
{{upper}}
SELECT doc_id, leaf, subroot, t.digest AS root, sha256(proof) AS proof_sha256, own AS folded_root, own = t.digest AS verified
FROM upper JOIN (SELECT digest FROM tops WHERE n = 1) t ON true WHERE upper.n = 1
"""

#: Every leaf climbs level by level with its own digest and the siblings met so far.
_CLIMB = """{name}(doc_id, leaf, subroot, tree, pos, n, level, own, proof) AS (
    {start}
    UNION ALL
    SELECT doc_id, leaf, subroot, f.tree, f.pos // 3, (f.n + 2) // 3, f.level + 1,
           sha256(array_to_string(list_concat(kids[:f.pos % 3], [own], kids[f.pos % 3 + 2:]), '')),
           proof || array_to_string(list_concat(kids[:f.pos % 3], kids[f.pos % 3 + 2:]), '')
    FROM {name} f JOIN {nodes} k ON k.level = f.level AND k.pos = f.pos // 3 AND k.tree = f.tree
    WHERE f.n > 1
)"""
MANIFEST = MANIFEST.format(
    lower=_CLIMB.format(
        name="lower", nodes="nodes",
        start="SELECT doc_id, leaf, subroot, tree, l.pos, l.n, 1, shown, '' FROM leaves l JOIN subroots USING (tree)",
    ),
    upper=_CLIMB.format(
        name="upper", nodes="tops",
        start="SELECT doc_id, leaf, l.subroot, 0, s.pos, s.n, 1, own, proof FROM lower l JOIN subroots s USING (tree) WHERE l.n = 1",
    ),
)

DIVERGENCE = r"""
WITH docs AS (
    SELECT row_number() OVER () AS no, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
    FROM documents
),
found AS (SELECT no, lang, source, unnest(terms) AS term FROM docs),
kept AS (SELECT lang, term, count(*)::HUGEINT AS total FROM found GROUP BY lang, term HAVING count(DISTINCT no) >= 3),
langs AS (SELECT lang, count(*) AS v, sum(total)::HUGEINT AS n FROM kept GROUP BY lang),
counts AS (SELECT lang, source, term, count(*)::HUGEINT AS c FROM found SEMI JOIN kept USING (lang, term) GROUP BY ALL),
every AS (SELECT DISTINCT lang, source FROM docs),
shares AS (
    SELECT e.lang, e.source, k.term, coalesce(c, 0) AS c,
           1 + 1000000000 * (coalesce(c, 0) + 1) // (sum(coalesce(c, 0)) OVER (PARTITION BY e.lang, e.source) + l.v)::HUGEINT AS p,
           1 + 1000000000 * (k.total + 1) // (l.n + l.v) AS q
    FROM every e JOIN kept k USING (lang) JOIN langs l USING (lang) LEFT JOIN counts c USING (lang, source, term)
),
pairs AS (
    SELECT a.lang, a.source, b.source AS item, coalesce(v.value, 0) AS value
    FROM every a JOIN every b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN (
        SELECT s.lang, s.source, t.source AS item, sum((s.p - t.p) * (s.p - t.p) // t.p) AS value
        FROM shares s JOIN shares t ON s.lang = t.lang AND s.term = t.term AND s.source <> t.source GROUP BY ALL
    ) v ON v.lang = a.lang AND v.source = a.source AND v.item = b.source
),
ranked AS (
    SELECT lang, source, 'pair' AS part, item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, encode(item)) AS rank
    FROM pairs
    UNION ALL
    SELECT lang, source, 'term', term, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, encode(term))
    FROM (SELECT *, (p - q) * (p - q) // q AS value FROM shares WHERE c > 0 AND p > q)
)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INT AS rank FROM ranked WHERE part = 'pair' OR rank <= 200
"""

_WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

CONTAMINATION = f"""
WITH items AS (SELECT item_id, {_WORDS} AS words FROM benchmark),
windows AS (
    SELECT DISTINCT item_id, n, array_to_string(words[i:i + n - 1], ' ') AS run
    FROM (SELECT *, least(len(words), 10) AS n FROM items WHERE len(words) > 0), unnest(range(1, len(words) - n + 2)) AS t(i)
),
docs AS (SELECT row_number() OVER () AS no, doc_id, {_WORDS} AS words FROM documents),
runs AS (
    SELECT no, i, n, array_to_string(words[i:i + n - 1], ' ') AS run
    FROM docs, (SELECT DISTINCT n FROM windows), unnest(range(1, len(words) - n + 2)) AS t(i)
),
hits AS (SELECT no, i, n, item_id FROM runs JOIN windows USING (n, run)),
hit_words AS (SELECT no, count(DISTINCT p) AS n_hit FROM hits, unnest(range(i, i + n)) AS t(p) GROUP BY no),
hit_items AS (
    SELECT no, count(*) AS n_items, string_agg(item_id, ',' ORDER BY encode(item_id)) AS ids
    FROM (SELECT DISTINCT no, item_id::VARCHAR AS item_id FROM hits) GROUP BY no
)
SELECT doc_id, len(words) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hit_words USING (no) LEFT JOIN hit_items USING (no)
"""

#: Ids are taken to be distinct and not null.
LINES = r"""
WITH lines AS (
    SELECT doc_id, no, line, list_filter(regexp_split_to_array(lower(line), '[ \t\x0B\f\r]+'), lambda w: w <> '') AS words
    FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS no
          FROM documents)
),
named AS (SELECT *, array_to_string(words, ' ') AS name FROM lines),
firsts AS (
    SELECT name, any_value(words) AS words, len(any_value(words)) AS n, min({'d': doc_id, 'no': no}) AS at,
           row_number() OVER (ORDER BY min({'d': doc_id, 'no': no})) AS spot
    FROM named WHERE len(words) > 0 GROUP BY name
),
long_lines AS (SELECT * FROM firsts WHERE n >= 8),
cuts AS (
    SELECT spot, n, i, array_to_string(list_concat(words[:i - 1], words[i + 1:]), ' ') AS rest
    FROM long_lines, unnest(range(1, n + 1)) AS t(i)
),
near AS (
    SELECT spot FROM (SELECT spot, min(spot) OVER (PARTITION BY n, i, rest) AS low FROM cuts) WHERE low < spot
    UNION SELECT l.spot FROM long_lines l JOIN cuts c ON c.rest = l.name WHERE c.spot < l.spot
    UNION SELECT c.spot FROM cuts c JOIN long_lines l ON l.name = c.rest WHERE l.spot < c.spot
),
judged AS (
    SELECT m.doc_id, m.no, m.line, coalesce(f.at <> {'d': m.doc_id, 'no': m.no}, false) AS is_exact,
           coalesce(f.spot IN (SELECT spot FROM near), false) AS is_near
    FROM named m LEFT JOIN firsts f USING (name)
),
kept AS (
    SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE is_exact) AS n_exact,
           count(*) FILTER (WHERE is_near AND NOT is_exact) AS n_near,
           string_agg(line, chr(10) ORDER BY no) FILTER (WHERE NOT is_exact AND NOT is_near) AS text
    FROM judged GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_exact, 0) AS n_exact, coalesce(n_near, 0) AS n_near,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM documents d LEFT JOIN kept USING (doc_id)
"""

ORACLES = {
    "op3_decontaminate": CONTAMINATION,
    "op5_dedup_lines": LINES,
    "op11_shards": SHARDS,
    "op12_merkle_manifest": MANIFEST,
    "op13_source_divergence": DIVERGENCE,
}
