"""SQL that checks those queries which SQL can express, written from the contracts and not from the operators."""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

from tradewind.llm.hilbert import curve_tables

_LOWER = f"translate(coalesce(text, ''), '{ascii_uppercase}', '{ascii_lowercase}')"

MIX = """
WITH sizes AS (SELECT source, sum(CAST(coalesce(strlen(text), 0) + 8 AS DOUBLE)) AS size FROM documents GROUP BY source),
rates AS (SELECT source, sqrt(size) / (SELECT sum(sqrt(size)) FROM sizes) * (SELECT sum(size) FROM sizes) / size AS rate FROM sizes),
means AS (SELECT source, draws, rate / draws AS mean FROM (SELECT *, greatest(ceil(rate / 64), 1) AS draws FROM rates)),
terms AS (SELECT source, mean, unnest(range(0, CAST(ceil(mean + 12 * sqrt(mean) + 24) AS BIGINT) + 1)) AS k FROM means),
steps AS (SELECT source, sum(exp(-mean + k * ln(mean) - lgamma(k + 1))) OVER (PARTITION BY source ORDER BY k) AS below FROM terms),
drawn AS (SELECT d.doc_id, d.source, d.text, unnest(range(1, CAST(draws AS BIGINT) + 1)) AS draw
    FROM documents d JOIN means m ON m.source IS NOT DISTINCT FROM d.source),
uniform AS (SELECT *, CAST('0x' || substr(md5('mix:' || doc_id || ':' || draw), 1, 13) AS BIGINT) / 4503599627370496.0 AS u FROM drawn),
counted AS (SELECT doc_id, count(below) AS n FROM uniform x LEFT JOIN steps s ON s.source IS NOT DISTINCT FROM x.source AND s.below <= x.u GROUP BY doc_id),
copies AS (SELECT d.doc_id, d.source, CAST(unnest(range(1, n + 1)) AS INTEGER) AS copy, d.text FROM documents d JOIN counted c ON c.doc_id = d.doc_id)
SELECT doc_id, source, copy, md5('mix:order:' || doc_id || ':' || copy) AS shuffle_key, text FROM copies
"""

NEAR = rf"""
WITH RECURSIVE words AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents),
shingles AS (SELECT DISTINCT doc_id, array_to_string(w[k:k + 3], ' ') AS s FROM
    (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS k FROM words WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
links AS (SELECT a.doc_id AS x, b.doc_id AS y FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
    JOIN sizes p ON p.doc_id = a.doc_id JOIN sizes q ON q.doc_id = b.doc_id
    GROUP BY a.doc_id, b.doc_id, p.n, q.n HAVING 100 * count(*) >= 80 * (p.n + q.n - count(*))),
reached(doc_id, other) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, l.y FROM reached r JOIN links l ON l.x = r.other)
SELECT d.doc_id, coalesce(any_value(n), 0) AS n_shingles, min(other) AS component_id, d.doc_id = min(other) AS kept
FROM documents d JOIN reached r ON r.doc_id = d.doc_id LEFT JOIN sizes s ON s.doc_id = d.doc_id GROUP BY d.doc_id
"""

CONTAMINATED = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
asked AS (SELECT DISTINCT item_id, least(len(w), 13) AS n, array_to_string(w[k:k + 12], ' ') AS phrase FROM
    (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS k FROM b WHERE len(w) > 0)),
lengths AS (SELECT DISTINCT n FROM asked),
places AS (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS k FROM d, lengths WHERE len(w) >= n),
found AS (SELECT doc_id, k, p.n, item_id FROM places p JOIN asked a ON a.n = p.n AND a.phrase = array_to_string(p.w[k:k + p.n - 1], ' ')),
hit AS (SELECT doc_id, count(DISTINCT position) AS n_hit FROM (SELECT doc_id, unnest(range(k, k + n)) AS position FROM found) GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM
    (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
    sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit h ON h.doc_id = d.doc_id LEFT JOIN named i ON i.doc_id = d.doc_id
"""


def _crc_table() -> list[int]:
    """The step of CRC-32 for each value of a byte: eight shifts by its polynomial."""
    steps = list(range(256))
    for _ in range(8):
        steps = [(x >> 1) ^ (0xEDB88320 if x & 1 else 0) for x in steps]
    return steps


def _text_cell(column: str) -> str:
    """Cell of a text among 256: the 7 bytes behind the prefix that the smallest and largest value share, as a number."""
    number = lambda x: f"CAST(CAST('0x' || rpad(hex(encode(substr({x}, shared_{column} + 1, 7))), 14, '0') AS UBIGINT) AS DOUBLE)"
    low, high = number(f"low_{column}"), number(f"high_{column}")
    return _cell(number(column), low, high)


def _cell(value: str, low: str, high: str) -> str:
    return (
        f"CASE WHEN {high} > {low} THEN coalesce(least(greatest(CAST(floor(({value} - {low}) * (256 / ({high} - {low}))) AS BIGINT), 0), 255), 0) ELSE 0 END"
    )


def shards(count: int) -> str:
    number, following = curve_tables(4)
    ends = ", ".join(f"min({c}) AS low_{c}, max({c}) AS high_{c}" for c in ("source", "lang", "length", "doc_id"))
    shared = ", ".join(
        f"(SELECT max(i) FROM range(0, least(len(low_{c}), len(high_{c})) + 1) t(i) WHERE left(low_{c}, i) = left(high_{c}, i)) AS shared_{c}"
        for c in ("source", "lang")
    )
    cells = {
        "a": _text_cell("source"), "b": _text_cell("lang"), "c": _cell("length", "low_length", "high_length"),
        "d": _cell("CAST(doc_id AS DOUBLE)", "CAST(low_doc_id AS DOUBLE)", "CAST(high_doc_id AS DOUBLE)"),
    }
    corner = " + ".join(f"((({name} >> (7 - i)) & 1) << {axis})" for axis, name in enumerate("abcd"))
    return f"""
WITH tables AS (SELECT {number} AS numbers, {following} AS states, {_crc_table()} AS crcs),
docs AS (SELECT doc_id, source, lang, hex(encode(coalesce(text, ''))) AS digits, CAST(strlen(coalesce(text, '')) + 8 AS BIGINT) AS size,
    ln(CAST(strlen(coalesce(text, '')) + 8 AS DOUBLE)) / ln(2.0) AS length FROM documents),
ends AS (SELECT {ends} FROM docs),
bounds AS (SELECT *, {shared} FROM ends),
cells AS (SELECT docs.*, {', '.join(f'{v} AS {k}' for k, v in cells.items())} FROM docs, bounds),
walked AS (SELECT cells.*, list_reduce(list_prepend(CAST(0 AS BIGINT), list_transform(range(0, 8), lambda i: CAST({corner} AS BIGINT))),
    lambda acc, corner: ((acc // 64) * 16 + numbers[(acc % 64) * 16 + corner + 1]) * 64 + states[(acc % 64) * 16 + corner + 1]) // 64 AS place,
    xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(0, strlen(digits) // 2), lambda i: CAST('0x' || substr(digits, 2 * i + 1, 2) AS BIGINT))),
    lambda crc, byte: xor(crc >> 8, crcs[(xor(crc, byte) & 255) + 1])), 4294967295) AS text_crc32 FROM cells, tables),
ranked AS (SELECT *, row_number() OVER (ORDER BY place, doc_id, text_crc32) - 1 AS r, count(*) OVER () AS n FROM walked)
SELECT doc_id, size, text_crc32, 'rows' AS law, CAST(r * {count} // n AS INTEGER) AS shard,
    r - ((r * {count} // n) * n + {count - 1}) // {count} AS slot, CAST(NULL AS INTEGER) AS grown_shard FROM ranked
"""


def _crc(value: str) -> str:
    """Unsigned CRC-32 of a text without letters beyond ASCII; needs the column `crcs`."""
    return (
        f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split({value}, ''), lambda c: CAST(ord(c) AS BIGINT))),"
        " lambda crc, byte: xor(crc >> 8, crcs[(xor(crc, byte) & 255) + 1])), 4294967295)"
    )


def manifest() -> str:
    def field(value: str) -> str:
        return f"coalesce(strlen(CAST({value} AS VARCHAR)) || ':' || {value}, '-')"

    def leaf(chars: str) -> str:
        return "sha256(" + " || ".join(map(field, ("doc_id", "source", "lang", chars, "text"))) + ")"

    def levels(name: str, rows: str) -> str:
        """All levels of the trees over `rows` (g, idx, n, node)."""
        return f"""{name}(g, level, idx, n, node) AS (SELECT g, 0, idx, n, node FROM {rows} UNION ALL
    SELECT g, level + 1, idx // 2, (n + 1) // 2, sha256(string_agg(node, '' ORDER BY idx)) FROM {name} WHERE n > 1 GROUP BY g, level, idx // 2, n)"""

    def walk(name: str, start: str, tree: str) -> str:
        """From each node of `start` to the top of its tree: the siblings so far, and the node folded so far."""
        beside = f"(SELECT g, level, idx, node FROM {tree})"
        return f"""{name}(doc_id, g, level, idx, n, acc, beside) AS (SELECT doc_id, g, 0, idx, n, acc, beside FROM {start} UNION ALL
    SELECT w.doc_id, w.g, w.level + 1, w.idx // 2, (w.n + 1) // 2,
    sha256(CASE WHEN w.idx % 2 = 0 THEN w.acc || coalesce(s.node, '') ELSE s.node || w.acc END), w.beside || coalesce(s.node, '')
    FROM {name} w LEFT JOIN {beside} s ON s.g = w.g AND s.level = w.level AND s.idx = xor(w.idx, 1) WHERE w.n > 1)"""

    return f"""
WITH RECURSIVE tables AS (SELECT {_crc_table()} AS crcs),
leaves AS (SELECT doc_id, coalesce('1' || lang, '0') AS g, {leaf('n_chars')} AS node, {leaf('(n_chars + 1)')} AS changed,
    {_crc("CAST(doc_id AS VARCHAR)")} % 7 = 0 AS hit FROM documents, tables),
numbered AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id, node) - 1 AS idx, count(*) OVER (PARTITION BY g) AS n FROM leaves),
{levels('nodes', 'numbered')},
tops AS (SELECT '' AS g, row_number() OVER (ORDER BY g) - 1 AS idx, count(*) OVER () AS n, node, g AS member FROM nodes WHERE n = 1),
{levels('crown', 'tops')},
low AS (SELECT doc_id, g, idx, n, CASE WHEN hit THEN changed ELSE node END AS acc, '' AS beside FROM numbered),
{walk('inner_walk', 'low', 'nodes')},
middle AS (SELECT doc_id, '' AS g, t.idx, t.n, acc, beside FROM inner_walk w JOIN tops t ON t.member = w.g WHERE w.n = 1),
{walk('outer_walk', 'middle', 'crown')},
top AS (SELECT node FROM crown WHERE n = 1)
SELECT l.doc_id, l.node AS leaf, t.node AS subroot, top.node AS root, sha256(w.beside) AS proof_sha256, w.acc AS folded_root, w.acc = top.node AS verified
FROM leaves l JOIN tops t ON t.member = l.g JOIN outer_walk w ON w.doc_id = l.doc_id AND w.n = 1, top
"""


_CONTROLS = ("<</SYS>>", "<<SYS>>", "[/INST]", "[/ROLE]", "[INST]", "[ROLE", "</s>", "<s>")
_ESCAPES = " + ".join(["length(text) - length(replace(text, chr(92), ''))"] + [f"(length(text) - length(replace(text, '{c}', ''))) // {len(c)}" for c in _CONTROLS])

FORMATTED = f"""
WITH turns AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, k, role, '</s>[INST] ok [/INST]' FROM (VALUES (0, 'user'), (1, 'assistant')) t(k, role)),
-- the marks around a text, by role, and what escaping adds to it
sized AS (SELECT *, length(text) + {_ESCAPES} +
    CASE role WHEN 'system' THEN 17 WHEN 'user' THEN 15 WHEN 'assistant' THEN 7 ELSE 16 + length(role) END AS size FROM turns)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
    CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
    CAST(sum(size) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id
"""


def trie() -> str:
    return f"""
WITH tables AS (SELECT {_crc_table()} AS crcs),
own AS (SELECT conv_id, list(struct_pack(r := coalesce(role, ''), t := coalesce(text, '')) ORDER BY turn NULLS FIRST) AS said
    FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
cut AS (SELECT own.*, {_crc("CAST(conv_id AS VARCHAR)")} % 6 AS h FROM own, tables),
whole AS (SELECT c.conv_id, list_concat(coalesce(b.said[1:c.h], []), c.said[c.h + 1:]) AS said FROM cut c LEFT JOIN own b ON b.conv_id = c.conv_id - (c.conv_id % 100 + 100) % 100),
steps AS (SELECT conv_id, unnest(range(0, len(said) + 1)) AS depth, said FROM whole),
nodes AS (SELECT depth, said[1:depth] AS path, min(conv_id) AS conv_id, count(*) AS n_convs,
    string_agg(conv_id, ',' ORDER BY conv_id) FILTER (WHERE len(said) = depth) AS ends FROM steps GROUP BY 1, 2),
kept AS (SELECT *, CASE WHEN depth > 0 THEN (n_convs - 1) * length(path[depth].t) ELSE 0 END AS weight FROM nodes),
counted AS (SELECT depth - 1 AS depth, path[1:depth - 1] AS path, count(*) AS n_children FROM kept WHERE depth > 0 GROUP BY 1, 2),
seen AS (SELECT k.*, coalesce(n_children, 0) AS n_children FROM kept k LEFT JOIN counted c ON c.depth = k.depth AND c.path = k.path),
sums AS (SELECT up AS depth, path[1:up] AS path, sum(weight) AS saved, count(*) FILTER (WHERE n_children = 0) AS n_leaves
    FROM (SELECT *, unnest(range(0, depth + 1)) AS up FROM seen) GROUP BY 1, 2)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children, s.n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens,
    sha256(coalesce(n.ends, '')) AS ends_sha256
FROM seen n JOIN sums s ON s.depth = n.depth AND s.path = n.path LEFT JOIN nodes p ON p.depth = n.depth - 1 AND p.path = n.path[1:n.depth - 1]
"""


REPEATS = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, CAST(strlen(coalesce(text, '')) AS BIGINT) AS n FROM documents),
blocks AS (SELECT doc_id, n, b, substr(h, 2 * b + 1, 1400) AS h FROM (SELECT doc_id, h, n, unnest(range(0, n - 199, 500)) AS b FROM d WHERE n >= 200)),
strings AS (SELECT doc_id, b + j AS k, hash(substr(h, 2 * j + 1, 400)) AS m FROM (SELECT doc_id, b, h, unnest(range(0, least(500, n - 199 - b))) AS j FROM blocks)),
again AS (SELECT doc_id, k FROM strings SEMI JOIN (SELECT m FROM strings GROUP BY m HAVING count(*) > 1) USING (m)),
runs AS (SELECT doc_id, k, sum(opens) OVER (PARTITION BY doc_id ORDER BY k) AS run FROM
    (SELECT *, CASE WHEN k <= lag(k) OVER (PARTITION BY doc_id ORDER BY k) + 200 THEN 0 ELSE 1 END AS opens FROM again)),
spans AS (SELECT doc_id, min(k) AS a, max(k) + 199 AS b FROM runs GROUP BY doc_id, run),
pieces AS (SELECT *, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), -1) + 1 AS c FROM spans),
cut AS (SELECT p.doc_id, sum(b - a + 1) AS n_removed, count(*) AS n_spans, string_agg(substr(h, 2 * c + 1, 2 * (a - c)), '' ORDER BY a) || substr(any_value(h), 2 * max(b) + 3) AS rest
    FROM pieces p JOIN d ON d.doc_id = p.doc_id GROUP BY p.doc_id)
SELECT d.doc_id, n AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(rest, h))) AS kept_sha256
FROM d LEFT JOIN cut ON cut.doc_id = d.doc_id
"""
