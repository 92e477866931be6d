"""SQL of a second engine for those queries of this subpackage that SQL can express."""

from __future__ import annotations

# The table of the CRC-32 polynomial.
_TAB = """tab AS (
    SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t
    FROM range(256) r(i)
)"""


def _crc(x: str) -> str:
    """Unsigned CRC-32 of decimal text."""
    codes = f"list_transform(range(1, length({x}) + 1), lambda k: ascii(substr({x}, k, 1))::BIGINT)"
    return f"xor(list_reduce(list_concat([4294967295], {codes}), lambda c, b: xor(c >> 8, tab.t[xor(c, b) % 256 + 1])), 4294967295)"


def _field(x: str) -> str:
    return f"coalesce(strlen({x}::VARCHAR)::VARCHAR || ':' || {x}::VARCHAR, '-')"


def _leaf(n_chars: str) -> str:
    return f"sha256({' || '.join(_field(x) for x in ('doc_id', 'source', 'lang', n_chars, 'text'))})"


def _climb(name: str, start: str, tree: str) -> str:
    return f"""{name} AS (
    SELECT * FROM {start}
    UNION ALL
    SELECT c.doc_id, c.tree, c.level + 1, c.pos // 2, c.own_tree,
           sha256(CASE WHEN s.h IS NULL THEN c.folded WHEN c.pos % 2 = 1 THEN s.h || c.folded ELSE c.folded || s.h END),
           c.proof || coalesce(s.h, '')
    FROM {name} c JOIN {tree} own ON own.tree = c.tree AND own.level = c.level AND own.pos = c.pos AND own.n > 1
    LEFT JOIN {tree} s ON s.tree = c.tree AND s.level = c.level AND s.pos = xor(c.pos, 1)
)"""


def _levels(name: str, start: str) -> str:
    return f"""{name} AS (
    SELECT * FROM {start}
    UNION ALL
    SELECT tree, level + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), (n + 1) // 2 FROM {name} WHERE n > 1 GROUP BY tree, level, pos // 2, n
)"""


MERKLE_MANIFEST = f"""
WITH RECURSIVE {_TAB},
leaves AS (
    SELECT doc_id, lang, {_leaf("n_chars")} AS leaf,
           CASE WHEN {_crc("doc_id::VARCHAR")} % 7 = 0 THEN {_leaf("(n_chars + 1)")} ELSE {_leaf("n_chars")} END AS given,
           dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree
    FROM documents, tab
),
placed AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id, leaf) - 1 AS pos, count(*) OVER (PARTITION BY tree) AS n FROM leaves),
low_start AS (SELECT tree, 0 AS level, pos, leaf AS h, n FROM placed),
{_levels("low", "low_start")},
subroots AS (SELECT tree, h AS subroot FROM low WHERE n = 1),
high_start AS (SELECT 0::BIGINT AS tree, 0 AS level, tree AS pos, subroot AS h, count(*) OVER () AS n FROM subroots),
{_levels("high", "high_start")},
way_start AS (SELECT doc_id, tree, 0 AS level, pos, tree AS own_tree, given AS folded, '' AS proof FROM placed),
{_climb("way", "way_start", "low")},
over_start AS (
    SELECT doc_id, 0::BIGINT AS tree, 0 AS level, w.tree AS pos, own_tree, folded, proof FROM way w JOIN low l ON l.tree = w.tree AND l.level = w.level AND l.pos = w.pos AND l.n = 1
),
{_climb("over_way", "over_start", "high")}
SELECT o.doc_id, p.leaf, s.subroot, r.h AS root, sha256(o.proof) AS proof_sha256, o.folded AS folded_root, o.folded = r.h AS verified
FROM over_way o JOIN high r ON r.n = 1 AND r.level = o.level AND r.pos = o.pos
JOIN placed p ON p.doc_id = o.doc_id JOIN subroots s ON s.tree = o.own_tree
"""

# A turn is named by its role and text; a node by the list of its turns' names.
PREFIX_TRIE = f"""
WITH {_TAB},
turns AS (
    SELECT conv_id, turn, coalesce(text, '') AS text, md5(strlen(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '')) AS name
    FROM conversations WHERE conv_id IS NOT NULL
),
own AS (SELECT conv_id, list({{'name': name, 'size': strlen(text)}} ORDER BY turn NULLS FIRST, name) AS t FROM turns GROUP BY conv_id),
head AS (SELECT conv_id AS donor, t AS ht FROM own),
rebuilt AS (
    SELECT conv_id, list_concat(coalesce(list_slice(ht, 1, h), []), list_slice(own_t, h + 1, length(own_t))) AS t
    FROM (SELECT conv_id, own.t AS own_t, {_crc("conv_id::VARCHAR")} % 9 AS h FROM own, tab) o LEFT JOIN head ON donor = conv_id - conv_id % 5
),
members AS (
    SELECT conv_id, d, md5(array_to_string(list_transform(list_slice(t, 1, d), lambda x: x.name), '')) AS node,
           CASE WHEN d > 0 THEN md5(array_to_string(list_transform(list_slice(t, 1, d - 1), lambda x: x.name), '')) END AS up,
           CASE WHEN d > 0 THEN t[d].size ELSE 0 END AS size, d = length(t) AS ends
    FROM (SELECT *, unnest(range(0, length(t) + 1)) AS d FROM rebuilt)
),
nodes AS (
    SELECT node, any_value(d) AS depth, any_value(up) AS up, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(size) AS size,
           sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256
    FROM members GROUP BY node
),
children AS (SELECT up AS node, count(*) AS n_children FROM nodes WHERE up IS NOT NULL GROUP BY up),
under AS (SELECT DISTINCT a.node AS top, b.node FROM members a JOIN members b ON a.conv_id = b.conv_id AND b.d >= a.d),
sums AS (
    SELECT top, sum((n.n_convs - 1) * n.size) AS saved_tokens, count(*) FILTER (WHERE c.node IS NULL) AS n_leaves
    FROM under u JOIN nodes n ON n.node = u.node LEFT JOIN children c ON c.node = u.node GROUP BY top
)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(c.n_children, 0) AS n_children, s.n_leaves, s.saved_tokens::BIGINT AS saved_tokens, n.ends_sha256
FROM nodes n LEFT JOIN nodes p ON p.node = n.up LEFT JOIN children c ON c.node = n.node JOIN sums s ON s.top = n.node
"""

_HELD = r"regexp_replace({x}, '(</?|\[/?)(\\*)(s>|INST\]|ROLE\])', '\1\\\2\3', 'g')"


def _held(x: str) -> str:
    return _HELD.format(x=x)


CHAT_FORMAT = f"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL
    UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
    UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
),
shown AS (
    SELECT *, CASE role WHEN 'user' THEN '[INST] ' || {_held("text")} || ' [/INST]' WHEN 'assistant' THEN ' ' || {_held("text")} || '</s>'
                        ELSE '[ROLE]' || {_held("role")} || '[/ROLE] ' || {_held("text")} || '</s>' END AS line
    FROM turns
)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       3 + sum(length(line))::BIGINT AS formatted_chars, -1 AS rewrites
FROM shown GROUP BY conv_id
"""
