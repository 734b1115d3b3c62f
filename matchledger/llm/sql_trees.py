"""The same results of the manifest and of the trie in SQL, for small tables: levels are spelled out."""

from __future__ import annotations


def _crc32(text: str) -> str:
    """crc32 of an ASCII text, bit by bit."""
    bits = f"flatten(list_transform(string_split({text}, ''), lambda ch: list_transform(range(8), lambda i: (ord(ch)::BIGINT >> i) & 1)))"
    step = "lambda c, b: xor(c >> 1, 3988292384 * (xor(c, b) & 1))"
    return f"xor(list_reduce(list_concat([4294967295::BIGINT], {bits}), {step}), 4294967295)"


def _tree(name: str, leaves: str, levels: int) -> str:
    """CTEs of a tree over leaves (grp, pos, d): <name><k> (grp, pos, d), the nodes of a level, and <name>r<k> (grp, pos, run, n), its runs and how many nodes it has."""
    out = [f"{name}0 AS ({leaves})"]
    for k in range(levels):
        out.append(f"{name}r{k} AS (SELECT grp, pos // 8 AS pos, list(d ORDER BY pos) AS run, sum(count(*)) OVER (PARTITION BY grp) AS n FROM {name}{k} GROUP BY grp, pos // 8)")
        out.append(f"{name}{k + 1} AS (SELECT grp, pos, CASE WHEN n = 1 AND len(run) = 1 THEN run[1] ELSE sha256(array_to_string(run, '')) END AS d FROM {name}r{k})")
    return ",\n".join(out)


def _climb(rows: str, name: str, levels: int) -> str:
    """CTEs that take rows (.., grp, at, proof, f) up a tree, from <rows>0 to <rows><levels>: siblings are added to proof, f is folded."""
    out = []
    for k in range(levels):
        lone = "r.n = 1 AND len(r.run) = 1"
        out.append(f"""{rows}{k + 1} AS (SELECT l.* REPLACE (l.spot // 8 AS spot,
  CASE WHEN {lone} THEN l.proof ELSE l.proof || array_to_string(list_filter(r.run, lambda x, i: i <> l.spot % 8 + 1), '') END AS proof,
  CASE WHEN {lone} THEN l.f ELSE sha256(array_to_string(list_transform(r.run, lambda x, i: CASE WHEN i = l.spot % 8 + 1 THEN l.f ELSE x END), '')) END AS f)
  FROM {rows}{k} l JOIN {name}r{k} r ON r.grp = l.grp AND r.pos = l.spot // 8)""")
    return ",\n".join(out)


_FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_LOWERED = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _leaf(*fields: str) -> str:
    coded = (f"coalesce(strlen(({f})::VARCHAR)::VARCHAR || ':' || ({f})::VARCHAR, '-')" for f in fields)
    return f"sha256({' || '.join(coded)})"


_LEVELS, _OVER = 6, 2  # enough for 8^6 documents of a language and 64 languages
MERKLE = f"""WITH doc AS (SELECT doc_id, lang, coalesce(lang::VARCHAR || '.', '-') AS grp, {_leaf(*_FIELDS)} AS leaf, {_leaf(*_FIELDS[:-1], _LOWERED)} AS lowered, {_crc32("doc_id::VARCHAR")} % 3 = 0 AS tampered FROM documents),
placed AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM doc),
{_tree("t", "SELECT grp, pos, leaf AS d FROM placed", _LEVELS)},
langs AS (SELECT t.grp AS lang_grp, d AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS lang_pos FROM t{_LEVELS} t JOIN (SELECT DISTINCT grp, lang FROM doc) g ON g.grp = t.grp),
{_tree("u", "SELECT '' AS grp, lang_pos AS pos, subroot AS d FROM langs", _OVER)},
way0 AS (SELECT doc_id, leaf, grp, pos AS spot, '' AS proof, CASE WHEN coalesce(tampered, false) THEN lowered ELSE leaf END AS f FROM placed),
{_climb("way", "t", _LEVELS)},
up0 AS (SELECT doc_id, leaf, subroot, '' AS grp, lang_pos AS spot, proof, f FROM way{_LEVELS} JOIN langs ON grp = lang_grp),
{_climb("up", "u", _OVER)}
SELECT doc_id, leaf, subroot, d AS root, sha256(proof) AS proof_sha256, f AS folded_root, f = d AS verified FROM up{_OVER}, u{_OVER}"""

TRIE = rf"""WITH own AS (SELECT conv_id AS c, x, words, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, x) AS k FROM (SELECT *,
  sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS x, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS words FROM conversations WHERE conv_id IS NOT NULL)),
convs AS (SELECT c, c - ((c % 20) + 20) % 20 AS base, {_crc32("c::VARCHAR")} % 4 AS h FROM (SELECT DISTINCT c FROM own)),
told AS (SELECT v.c, k, x, words FROM convs v JOIN own o ON o.c = v.base AND k <= h UNION ALL
  SELECT v.c, k + 1000000, x, words FROM convs v JOIN own o ON o.c = v.c AND k > h),
placed AS (SELECT c, x, words, row_number() OVER (PARTITION BY c ORDER BY k) AS depth FROM told),
members AS MATERIALIZED (SELECT c, depth, words, sha256(string_agg(x, '') OVER (PARTITION BY c ORDER BY depth)) AS node FROM placed UNION ALL SELECT c, 0, 0, '' FROM convs),
sized AS MATERIALIZED (SELECT *, lag(node) OVER (PARTITION BY c ORDER BY depth) AS parent, depth = max(depth) OVER (PARTITION BY c) AS ends FROM members),
nodes AS MATERIALIZED (SELECT node, min(parent) AS parent, min(depth) AS depth, min(c) AS c, count(*) AS n, (count(*) - 1) * min(words) AS saved, coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (ends), '') AS ends FROM sized GROUP BY node),
kids AS (SELECT parent AS node, count(*) AS n_children FROM nodes WHERE parent IS NOT NULL GROUP BY parent),
sums AS (SELECT m.node, count(*) FILTER (kids.node IS NULL) AS n_leaves, sum(n.saved) AS saved FROM nodes n JOIN members m ON m.c = n.c AND m.depth <= n.depth LEFT JOIN kids ON kids.node = n.node GROUP BY m.node)
SELECT n.c AS conv_id, n.depth::BIGINT AS depth, p.c AS parent_conv_id, n.n AS n_convs, coalesce(n_children, 0)::BIGINT AS n_children, n_leaves::BIGINT AS n_leaves, sums.saved::BIGINT AS saved_tokens, sha256(n.ends) AS ends_sha256
FROM nodes n LEFT JOIN nodes p ON p.node = n.parent LEFT JOIN kids ON kids.node = n.node JOIN sums ON sums.node = n.node"""
