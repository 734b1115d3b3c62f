"""The registered queries of the text operators in SQL, where SQL can express them."""

from __future__ import annotations

from matchledger.llm import mixing, urlfilter

_A_Z = f"'{urlfilter.UPPER}', '{urlfilter.LOWER}'"


def _mixing() -> str:
    """Raking written out: the targets, a step for each round and margin, and the first round whose error is small enough."""
    keep, margins = mixing.KEEP, mixing.MARGINS
    steps = [f"c0 AS MATERIALIZED (SELECT source, lang, topic, sum(n_tokens) AS tokens, {keep} * sum(n_tokens) AS w FROM facts GROUP BY ALL HAVING sum(n_tokens) > 0)"]
    steps.append("v0 AS (" + " UNION ALL ".join(f"SELECT '{m}' AS margin, {m} AS value, sum(tokens) AS tokens, pow(sum(tokens)::DOUBLE, {mixing.POWERS[m]}) AS part, false AS full_, NULL::DOUBLE AS scale FROM c0 GROUP BY {m}" for m in margins) + ")")
    for i in range(mixing.FILLS):
        scale = f"({keep} * sum(tokens) OVER g - coalesce(sum(tokens) FILTER (WHERE full_) OVER g, 0)) / nullif(sum(part) FILTER (WHERE NOT full_) OVER g, 0)"
        steps.append(f"s{i} AS MATERIALIZED (SELECT margin, value, tokens, part, full_, {scale} AS scale FROM v{i} WINDOW g AS (PARTITION BY margin))")
        steps.append(f"v{i + 1} AS MATERIALIZED (SELECT margin, value, tokens, part, full_ OR coalesce(part * scale >= tokens, true) AS full_, scale FROM s{i})")
    steps.append(f"target AS MATERIALIZED (SELECT margin, value, CASE WHEN full_ THEN tokens ELSE part * scale END AS target FROM v{mixing.FILLS})")
    k = 0
    for r in range(mixing.ROUNDS):
        for m in margins:
            factor = "CASE WHEN sum(w) >= target THEN target / sum(w) WHEN sum(w) FILTER (WHERE w < tokens) > 0 THEN (target - coalesce(sum(tokens) FILTER (WHERE w >= tokens), 0)) / sum(w) FILTER (WHERE w < tokens) ELSE 1 END"
            factors = f"SELECT {m}, {factor} AS f FROM c{k} JOIN target ON margin = '{m}' AND value = {m} GROUP BY {m}, target"
            steps.append(f"c{k + 1} AS MATERIALIZED (SELECT source, lang, topic, tokens, least(tokens, w * f) AS w FROM c{k} JOIN ({factors}) USING ({m}))")
            k += 1
        sums = " UNION ALL ".join(f"SELECT '{m}' AS margin, {m} AS value, sum(w) AS w FROM c{k} GROUP BY {m}" for m in margins)
        steps.append(f"e{r} AS MATERIALIZED (SELECT max(most / all_) AS error FROM (SELECT max(abs(w - target)) AS most, sum(target) AS all_ FROM ({sums}) JOIN target USING (margin, value) GROUP BY margin))")
    last = mixing.ROUNDS - 1
    stalled = [f" OR (SELECT error FROM e{r}) > {mixing.STALLED} * (SELECT error FROM e{r - 2})" if r > 1 else "" for r in range(last)]
    steps.append("ended AS (SELECT CASE " + " ".join(f"WHEN (SELECT error FROM e{r}) < {mixing.TOLERANCE}{stalled[r]} THEN {r}" for r in range(last)) + f" ELSE {last} END AS r)")
    steps.append("chance AS (" + " UNION ALL ".join(f"SELECT source, lang, topic, round(w / tokens, 6) AS p FROM c{3 * r + 3} WHERE (SELECT r FROM ended) = {r}" for r in range(last + 1)) + ")")
    return f"""WITH facts AS MATERIALIZED (
  SELECT doc_id, coalesce(source, '') AS source, coalesce(lang, '') AS lang,
    CASE WHEN regexp_matches(coalesce(text, ''), '[Ll]icen[sc]e|[Cc]opyright') THEN 'licence' WHEN regexp_matches(coalesce(text, ''), '@|://') THEN 'address'
      WHEN regexp_matches(coalesce(text, ''), '[0-9]{{3}}') THEN 'record' ELSE 'prose' END AS topic,
    len(regexp_extract_all(coalesce(text, ''), '[^ \\t\\n\\r]+'))::BIGINT AS n_tokens
  FROM documents),
{", ".join(steps)}
SELECT doc_id, source, lang, topic, n_tokens, coalesce(p, 0.0) AS p,
  ('0x' || substr(md5('{mixing.SEED}:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT / 4294967296.0 < coalesce(p, 0.0) AS kept
FROM facts LEFT JOIN chance USING (source, lang, topic)"""


_WARC = """SELECT page_id, bytes AS payload_bytes, digest AS payload_digest,
  CASE WHEN bytes >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN bytes >= 100 AND page_id <> first THEN first END AS refers_to
FROM (SELECT page_id, bytes, digest, min(page_id) OVER (PARTITION BY digest) AS first
  FROM (SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS bytes, sha256(coalesce(html, '')) AS digest FROM pages))"""

_URLS = f"""WITH split AS (
  SELECT page_id, translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''), {_A_Z}) AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path FROM pages),
rules(rule, rhost, rpath, verdict) AS (VALUES ('net/', 'net', '/', 'block'), ('example.net/en/', 'example.net', '/en/', 'allow'), ('example.com/de/', 'example.com', '/de/', 'block'), ('org/fr/', 'org', '/fr/', 'allow')),
best AS (SELECT host, path, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict
  FROM (SELECT DISTINCT host, path FROM split) JOIN rules ON (host = rhost OR host LIKE '%.' || rhost) AND starts_with(path, rpath) GROUP BY ALL)
SELECT page_id, s.host, s.path, b.rule, coalesce(b.verdict, CASE WHEN {" OR ".join(f"regexp_matches(s.host || s.path, '{r.pattern}')" for r in urlfilter.MORE)} THEN 'block' ELSE 'allow' END) AS verdict
FROM split s LEFT JOIN best b ON s.host = b.host AND s.path = b.path"""

_WORDS = "regexp_extract_all(translate(coalesce(text, ''), " + _A_Z + r"), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_DECONTAMINATION = f"""WITH item AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
wins AS (SELECT DISTINCT item_id, size, array_to_string(w[s : s + size - 1], ' ') AS g
  FROM (SELECT item_id, w, least(10, len(w)) AS size, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS s FROM item WHERE len(w) > 0)),
doc AS MATERIALIZED (SELECT doc_id, {_WORDS} AS w FROM documents),
runs AS (SELECT doc_id, size, p, array_to_string(w[p : p + size - 1], ' ') AS g
  FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS p FROM doc, (SELECT DISTINCT size FROM wins) WHERE len(w) >= size)),
found AS MATERIALIZED (SELECT doc_id, item_id, p, runs.size FROM runs JOIN wins ON runs.size = wins.size AND runs.g = wins.g),
hit AS (SELECT doc_id, count(DISTINCT q)::BIGINT AS n_hit FROM (SELECT doc_id, unnest(range(p, p + size)) AS q FROM found) GROUP BY doc_id),
items AS (SELECT doc_id, count(*)::BIGINT AS n_items, sha256(string_agg(i, ',' ORDER BY i)) AS items_sha256 FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS i FROM found) GROUP BY doc_id),
texts AS (SELECT DISTINCT item_id::VARCHAR AS item, w FROM item WHERE len(w) > 0),
own AS (SELECT item, md5(array_to_string(w, ' ')) AS copy, len(w) AS n, least(10, len(w)) AS size, unnest(list_transform(w, lambda x: lower(x))) AS key, unnest(range(len(w))) AS pos FROM texts),
posted AS MATERIALIZED (SELECT doc_id, key, pos FROM (SELECT doc_id, unnest(list_transform(w, lambda x: lower(x))) AS key, unnest(range(len(w))) AS pos FROM doc) WHERE key IN (SELECT key FROM own)),
known AS (SELECT own.*, coalesce(df, 0) AS df FROM own LEFT JOIN (SELECT key, count(*) AS df FROM posted GROUP BY key) USING (key)),
windows AS (SELECT item, copy, key, pos, df, unnest(range(greatest(0, pos - size + 1), least(pos, n - size) + 1)) AS start FROM known),
rare AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY item, copy, start ORDER BY df, pos) AS rank FROM windows) WHERE rank <= 3),
need AS (SELECT item, copy, min(n) AS need FROM (SELECT item, copy, start, count(*) AS n FROM rare GROUP BY ALL) GROUP BY ALL),
anchors AS (SELECT DISTINCT item, copy, need, key, pos AS anchor FROM rare JOIN need USING (item, copy)),
placed AS (SELECT doc_id, item, copy, need, p.pos - anchor AS shift, anchor FROM posted p JOIN anchors USING (key)),
near AS (SELECT doc_id, count(DISTINCT item)::BIGINT AS n_near FROM (SELECT doc_id, item, need,
  count(DISTINCT anchor) OVER (PARTITION BY doc_id, item, copy ORDER BY shift RANGE BETWEEN CURRENT ROW AND 5 FOLLOWING) AS held FROM placed) WHERE held >= need GROUP BY doc_id)
SELECT doc.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, coalesce(items_sha256, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated,
  coalesce(n_near, 0) AS n_near
FROM doc LEFT JOIN hit ON doc.doc_id = hit.doc_id LEFT JOIN items ON doc.doc_id = items.doc_id LEFT JOIN near ON doc.doc_id = near.doc_id"""

ORACLE_SQL: dict[str, str] = {
    "op3_mixing": _mixing(),
    "op4_warc": _WARC,
    "op6_url_filter": _URLS,
    "op9_decontamination": _DECONTAMINATION,
}
