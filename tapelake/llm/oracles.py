"""SQL twins of the operators' queries, for DuckDB over the same tables."""

from __future__ import annotations

from tapelake.llm.license_scan import FILE_COSINE, LINE_COSINE, TEMPLATES

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _shingles(name: str, key: str, source: str) -> str:
    """CTEs ``name`` (key, s) of the distinct 5-word shingles of ``source``; fewer words make one shingle."""
    return rf"""{name}_words AS (
SELECT {key}, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS w FROM {source}),
{name} AS (
SELECT DISTINCT {key}, unnest(list_transform(range(1, greatest(len(w) - 4, 1) + 1), lambda i: array_to_string(w[i:i + 4], ' '))) AS s
FROM {name}_words WHERE len(w) > 0)"""


def _components(nodes: str, links: str) -> str:
    """CTE ``reach`` (a, b): everything that links reach from a, itself included; ``links`` must hold both directions."""
    return f"""reach(a, b) AS (
SELECT id, id FROM {nodes} UNION SELECT r.a, l.b FROM reach r JOIN {links} l ON l.a = r.b)"""


# Five bits of the SHA-1 digest per character of the alphabet.
OP1 = """WITH p AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
h AS (SELECT page_id, octet_length(CAST(encode(payload) AS BLOB)) AS payload_bytes, sha1(payload) AS hex, payload FROM p),
b AS (SELECT *, array_to_string(list_transform(range(0, 8), lambda g: array_to_string(list_transform([15, 10, 5, 0], lambda s:
  substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + (CAST('0x' || substr(hex, CAST(1 + 5 * g AS BIGINT), 5) AS BIGINT) >> s) % 32, 1)), '')), '') AS payload_digest,
  max(page_id) OVER (PARTITION BY payload) AS top FROM h)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> top THEN top END AS refers_to FROM b"""

OP2 = f"""WITH RECURSIVE v AS (
SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
ok AS (SELECT id, e FROM v WHERE e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
  AND len(list_filter(e, lambda x: x <> 0)) > 0),
links AS (SELECT x.id AS a, y.id AS b FROM ok x JOIN ok y ON x.id <> y.id AND list_cosine_similarity(x.e, y.e) >= 0.95),
{_components("v", "links")},
sums AS (SELECT a AS id, count(*) AS n FROM links GROUP BY 1)
SELECT r.a AS vec_id, coalesce(any_value(n), 0) AS n_links, min(r.b) AS component_id, r.a = min(r.b) AS kept
FROM reach r LEFT JOIN sums ON sums.id = r.a GROUP BY r.a"""

_TEMPLATE_ROWS = ", ".join(f"({k}, '{name}', '{text}')" for k, (name, text) in enumerate(TEMPLATES))
_WORDS = r"regexp_extract_all(lower({0}), '[\p{{L}}\p{{N}}]+')"
# Units are the lines of a document (line_no from 0) and the whole of it (line_no -1).
OP5 = f"""WITH t(k, name, txt) AS (VALUES {_TEMPLATE_ROWS}),
tw AS (SELECT k, name, w, count(*) AS c FROM (SELECT k, name, unnest({_WORDS.format("txt")}) AS w FROM t) GROUP BY ALL),
dw AS (SELECT w, count(*) AS c FROM (SELECT doc_id, unnest(list_distinct({_WORDS.format("text")})) AS w FROM documents) WHERE w IN (SELECT w FROM tw) GROUP BY w),
n AS (SELECT count(*) AS total FROM documents),
idf AS (SELECT w, ln((1 + total) / (1 + coalesce(c, 0))) + 1 AS x FROM (SELECT DISTINCT w FROM tw) LEFT JOIN dw USING (w) CROSS JOIN n),
tv AS (SELECT k, name, w, tw.c * x / sqrt(sum((tw.c * x) * (tw.c * x)) OVER (PARTITION BY k)) AS v FROM tw JOIN idf USING (w)),
lines AS (SELECT doc_id, unnest(range(len(l))) AS line_no, unnest(l) AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents)),
units AS (SELECT doc_id, line_no, {_WORDS.format("line")} AS words FROM lines UNION ALL SELECT doc_id, -1, {_WORDS.format("text")} FROM documents),
uw AS (SELECT doc_id, line_no, w, count(*) AS tf FROM (SELECT doc_id, line_no, unnest(words) AS w FROM units) GROUP BY ALL),
weighted AS (SELECT doc_id, line_no, w, tf * coalesce(x, ln(1 + total) + 1) AS y FROM uw LEFT JOIN idf USING (w) CROSS JOIN n),
lengths AS (SELECT doc_id, line_no, sqrt(sum(y * y)) AS length FROM weighted GROUP BY ALL),
dots AS (SELECT doc_id, line_no, name, k, sum(y * v) AS dot FROM weighted JOIN tv USING (w) GROUP BY ALL),
best AS (SELECT doc_id, line_no, name, round(dot / length, 6) AS score FROM dots JOIN lengths USING (doc_id, line_no)
  QUALIFY row_number() OVER (PARTITION BY doc_id, line_no ORDER BY round(dot / length, 6) DESC, name) = 1),
own AS (SELECT doc_id, name, score FROM best WHERE line_no >= 0 AND score >= {LINE_COSINE}
  QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, line_no) = 1),
paths AS (SELECT doc_id, concat_ws('/', coalesce(source, 'unknown'), coalesce(lang, 'unknown'), CAST(doc_id // 1000 AS VARCHAR)) AS directory FROM documents),
told AS (SELECT directory, CASE WHEN b.score >= coalesce(own.score, 0) THEN b.name ELSE own.name END AS license, greatest(b.score, own.score) AS score
  FROM best b JOIN paths USING (doc_id) LEFT JOIN own USING (doc_id) WHERE line_no = -1 AND b.score >= {FILE_COSINE}),
licensed AS (SELECT directory, license FROM told QUALIFY row_number() OVER (PARTITION BY directory ORDER BY score DESC, license) = 1)
SELECT p.doc_id, p.directory || '/' || CAST(p.doc_id AS VARCHAR) || '.txt' AS path, own.name AS own_license, own.score AS own_score,
  coalesce(own.name, l.license) AS license, CASE WHEN own.name IS NULL THEN l.directory END AS from_directory
FROM paths p LEFT JOIN own ON own.doc_id = p.doc_id LEFT JOIN licensed l ON l.directory = p.directory"""

_ESCAPED = "replace(replace(replace(replace({0}, '&', '&amp;'), '<', '&lt;'), '[', '&lb;'), ']', '&rb;')"
OP6 = f"""WITH c AS (
SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]'))
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(7 + sum(length({_ESCAPED.format("text")}) + CASE WHEN role = 'assistant' THEN 11 ELSE 19 + length({_ESCAPED.format("role")}) END) AS BIGINT) AS formatted_chars
FROM c GROUP BY conv_id"""

# Items of fewer than five words are looked for among the documents' runs of as many words.
OP7 = f"""WITH {_shingles("d", "doc_id", "documents")}, {_shingles("q", "item_id", "benchmark")},
long AS (SELECT item_id, s FROM q JOIN (SELECT item_id FROM q_words WHERE len(w) >= 5) USING (item_id)),
short AS (SELECT item_id, len(w) AS l, array_to_string(w, ' ') AS s FROM q_words WHERE len(w) BETWEEN 1 AND 4),
runs AS (SELECT DISTINCT doc_id, l, unnest(list_transform(range(1, len(w) - l + 2), lambda i: array_to_string(w[i:i + l - 1], ' '))) AS s
  FROM d_words JOIN (SELECT DISTINCT l FROM short) ON len(w) >= l),
sizes AS (SELECT item_id, count(*) AS n_item FROM long GROUP BY 1)
SELECT d.doc_id, q.item_id, n_item, count(*) AS n_shared, count(*) / n_item AS containment
FROM d JOIN long q ON d.s = q.s JOIN sizes ON sizes.item_id = q.item_id
GROUP BY d.doc_id, q.item_id, n_item HAVING 100 * count(*) >= 75 * n_item
UNION ALL SELECT doc_id, item_id, 1, 1, 1.0 FROM runs JOIN short ON runs.l = short.l AND runs.s = short.s"""

OP9 = f"""WITH RECURSIVE {_shingles("d", "doc_id", "documents")},
sizes AS (SELECT documents.doc_id AS id, count(s) AS n FROM documents LEFT JOIN d ON d.doc_id = documents.doc_id GROUP BY 1),
shared AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM d x JOIN d y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM shared JOIN sizes m ON m.id = a JOIN sizes n ON n.id = b WHERE 100 * k >= 75 * (m.n + n.n - k)),
{_components("sizes", "links")}
SELECT id AS doc_id, any_value(n) AS n_shingles, min(b) AS component_id FROM sizes JOIN reach ON a = id GROUP BY id"""

OP10 = r"""WITH parts AS (
SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
split AS (
SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM parts),
rules(rule_host, rule_path, rule_verdict) AS (
VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
fits AS (
SELECT page_id, rule_host || rule_path AS rule, rule_verdict FROM split JOIN rules
  ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY length(rule_host || rule_path) DESC) = 1)
SELECT split.page_id, host, path, rule, coalesce(rule_verdict, 'allow') AS verdict FROM split LEFT JOIN fits ON fits.page_id = split.page_id"""

_P = "CAST(1 + (1000000000::HUGEINT * ({0} + 1)) // ({1} + v) AS HUGEINT)"
OP11 = rf"""WITH d AS (SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, {_LOWER} AS low FROM documents),
w AS (SELECT id, lang, source, unnest(regexp_extract_all(low, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS n FROM w GROUP BY 1, 2 HAVING count(DISTINCT id) >= 3),
counts AS (SELECT lang, source, term, count(*) AS n FROM w SEMI JOIN kept USING (lang, term) GROUP BY ALL),
langs AS (SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY 1),
groups AS (SELECT g.lang, g.source, coalesce(v, 0) AS v, coalesce(l.total, 0) AS lang_total, coalesce(c.total, 0) AS total
  FROM (SELECT DISTINCT lang, source FROM d) g LEFT JOIN langs l USING (lang)
  LEFT JOIN (SELECT lang, source, sum(n) AS total FROM counts GROUP BY 1, 2) c USING (lang, source)),
cells AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, {_P.format("coalesce(c.n, 0)", "total")} AS p, {_P.format("k.n", "lang_total")} AS q
  FROM groups g JOIN kept k USING (lang) LEFT JOIN counts c USING (lang, source, term)),
pairs AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM cells a JOIN cells b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY 1, 2, 3),
pair AS (SELECT a.lang, a.source, b.source AS item, CAST(coalesce(value, 0) AS BIGINT) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source),
term AS (SELECT lang, source, term AS item, CAST((p - q) * (p - q) // q AS BIGINT) AS value FROM cells WHERE n > 0 AND p > q)
SELECT lang, source, 'pair' AS part, item, value, CAST(row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS INTEGER) AS rank FROM pair
UNION ALL
SELECT lang, source, 'term', item, value, CAST(row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS INTEGER) AS r FROM term QUALIFY r <= 200"""

_H = "CAST('0x' || substr(hex, {0}, 8) AS BIGINT)"
OP12 = f"""WITH d AS (SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS hex FROM documents),
h AS (SELECT doc_id, text, length(text) AS n, {_H.format(1)} AS h1, {_H.format(9)} AS h2, {_H.format(17)} AS h3, {_H.format(25)} AS h4 FROM d),
c AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
  CASE WHEN n = 0 OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain'
    WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM h),
x AS (SELECT *, substr(text, 1, a) AS prefix, substr(text, a + 1, b - a) AS middle, substr(text, b + 1) AS suffix FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(text) AS restored_sha256 FROM x"""

ORACLES: dict[str, str] = {
    "op1_warc_capture_index": OP1,
    "op2_pivot_permutation_index": OP2,
    "op5_license_scan": OP5,
    "op6_chat_formatting": OP6,
    "op7_benchmark_decontamination": OP7,
    "op9_ngram_jaccard_join": OP9,
    "op10_url_filters": OP10,
    "op11_source_divergence_audit": OP11,
    "op12_fill_in_middle": OP12,
}
