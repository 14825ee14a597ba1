"""The registered queries in DuckDB SQL, where SQL can express them."""

from __future__ import annotations

from perimetry.llm import licences
from perimetry.llm.reputation import RULES, STRONGEST, SUFFIXES, WEAKEST

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = "regexp_extract_all({}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"


def _rules() -> str:
    rows = []
    for verdict, rule in RULES:
        host, slash, rest = rule.partition("/")
        rows.append(f"('{verdict}', '{rule}', '{host}', '{slash}{rest}')")
    return ", ".join(rows)


def _suffix(labels: int, plain: int) -> str:
    listed = " OR ".join(f"host = '{s}' OR ends_with(host, '.{s}')" for s in SUFFIXES)
    size = SUFFIXES[0].count(".") + 1 + labels
    tail = "array_to_string(list_slice(string_split(host, '.'), -least({0}, len(string_split(host, '.'))), -1), '.')"
    return f"CASE WHEN {listed} THEN {tail.format(size)} ELSE {tail.format(plain)} END"


def _level(name: str, before: str) -> str:
    return f"""
{name}_groups AS (SELECT {name}, sum(n) AS n, sum(good) AS good FROM counted GROUP BY {name}),
{name}_moments AS (SELECT count(*) AS k, sum(n) AS total, sum(n * n) AS squares, sum(n * pow(good / n - rate, 2)) AS spread, any_value(rate) AS rate
  FROM {name}_groups, overall),
{name}_strength AS (SELECT CASE WHEN rate > 0 AND rate < 1 AND k > 0 AND total - squares / total - (k - 1) > 0
    AND (spread / (rate * (1 - rate)) - (k - 1)) / (total - squares / total - (k - 1)) > 0
  THEN least({STRONGEST}, greatest({WEAKEST}, 1 / ((spread / (rate * (1 - rate)) - (k - 1)) / (total - squares / total - (k - 1))) - 1))
  ELSE {STRONGEST} END AS strength FROM {name}_moments),
{name}_level AS (SELECT host, suffix, domain, (mean * strength + coalesce(good, 0)) / (strength + coalesce(n, 0)) AS mean,
  strength + coalesce(n, 0) AS weight FROM {before} LEFT JOIN {name}_groups USING ({name}), {name}_strength)"""


OP1 = f"""
WITH parsed AS (
  SELECT page_id, {_LOWER.format("coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), '')")} AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path FROM pages),
outcomes AS (
  SELECT host, quality AS good FROM (
    SELECT host, try_cast(nullif(regexp_extract(path, '/([0-9]{{1,18}})(?:/|\\.html)?$', 1), '') AS BIGINT) AS doc_id FROM parsed)
  JOIN labels USING (doc_id) WHERE quality IN (0, 1) AND host <> ''),
hosts AS (SELECT DISTINCT host, {_suffix(0, 1)} AS suffix, {_suffix(1, 2)} AS domain FROM parsed),
counted AS (SELECT host, any_value({_suffix(0, 1)}) AS suffix, any_value({_suffix(1, 2)}) AS domain, count(*)::DOUBLE AS n, sum(good)::DOUBLE AS good
  FROM outcomes GROUP BY host),
overall AS (SELECT CASE WHEN sum(n) > 0 THEN sum(good) / sum(n) ELSE 0.5 END AS rate FROM counted),
top AS (SELECT host, suffix, domain, rate AS mean FROM hosts, overall),
{_level("suffix", "top")}, {_level("domain", "suffix_level")}, {_level("host", "domain_level")},
bounds AS (SELECT host, mean - 1.645 * sqrt(mean * (1 - mean) / (weight + 1)) AS bound FROM host_level),
rules AS (SELECT * FROM (VALUES {_rules()}) AS r(verdict, rule, rule_host, rule_path)),
fitting AS (SELECT page_id, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict FROM parsed JOIN rules
  ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path) GROUP BY page_id)
SELECT page_id, host, path, rule, coalesce(verdict, CASE WHEN bound >= 0.5 THEN 'allow' ELSE 'block' END) AS verdict
FROM parsed JOIN bounds USING (host) LEFT JOIN fitting USING (page_id)"""

OP2 = f"""
WITH docs AS (SELECT doc_id, {_WORDS.format(_LOWER.format("coalesce(text, '')"))} AS w FROM documents),
items AS (SELECT item_id, {_WORDS.format(_LOWER.format("coalesce(text, '')"))} AS w FROM benchmark),
windows AS (SELECT DISTINCT item_id, least(13, len(w)) AS size, array_to_string(w[s + 1 : s + least(13, len(w))], ' ') AS gram
  FROM (SELECT item_id, w, unnest(range(len(w) - least(13, len(w)) + 1)) AS s FROM items WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT size FROM windows),
grams AS (SELECT doc_id, size, s, array_to_string(w[s + 1 : s + size], ' ') AS gram
  FROM (SELECT doc_id, w, size, unnest(range(len(w) - size + 1)) AS s FROM docs, sizes WHERE len(w) >= size)),
met AS (SELECT doc_id, size, s, item_id FROM grams JOIN windows USING (size, gram)),
hit AS (SELECT doc_id, count(*) AS n_hit FROM (
  SELECT DISTINCT doc_id, unnest(range(s, s + size)) AS p FROM (SELECT DISTINCT doc_id, size, s FROM met)) GROUP BY doc_id),
named AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids FROM met GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM docs LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)"""

OP3 = licences.oracle()

OP6 = """
WITH docs AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
windows AS (SELECT doc_id, s, md5(array_to_string(w[s + 1 : s + 50], ' ')) AS h
  FROM (SELECT doc_id, w, unnest(range(len(w) - 49)) AS s FROM docs WHERE len(w) >= 50)),
first AS (SELECT h, min(doc_id) AS least FROM windows GROUP BY h),
gone AS (SELECT doc_id, list(DISTINCT p) AS ps FROM (
  SELECT doc_id, unnest(range(s, s + 50)) AS p FROM windows JOIN first USING (h) WHERE least < doc_id) GROUP BY doc_id),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS text FROM (
  SELECT doc_id, unnest(w) AS word, unnest(range(len(w))) AS i FROM docs) a
  WHERE NOT EXISTS (SELECT 1 FROM (SELECT doc_id, unnest(ps) AS p FROM gone) g WHERE g.doc_id = a.doc_id AND g.p = a.i) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(len(ps), 0) AS BIGINT) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM docs LEFT JOIN gone USING (doc_id) LEFT JOIN kept USING (doc_id)"""

OP7 = f"""
WITH lines AS (SELECT doc_id, unnest(l) AS line, unnest(range(len(l))) AS i
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)),
keyed AS (SELECT *, {_LOWER.format("trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))")} AS k FROM lines),
frequent AS (SELECT k FROM keyed WHERE length(k) >= 1 GROUP BY k HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, CAST(count(*) AS BIGINT) AS n_lines, CAST(count(frequent.k) AS BIGINT) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (frequent.k IS NULL), '')) AS kept_sha256
FROM keyed LEFT JOIN frequent USING (k) GROUP BY doc_id"""

OP8 = """
WITH RECURSIVE usable AS (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
pairs AS (SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b ON a.label = b.label AND a.vec_id < b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
links AS (SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs),
reach AS (SELECT a AS vec_id, b AS other FROM links UNION SELECT r.vec_id, l.b FROM reach r JOIN links l ON r.other = l.a)
SELECT vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, least(vec_id, coalesce(least_id, vec_id)) AS component_id,
  vec_id = least(vec_id, coalesce(least_id, vec_id)) AS kept
FROM embeddings LEFT JOIN (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a) USING (vec_id)
LEFT JOIN (SELECT vec_id, min(other) AS least_id FROM reach GROUP BY vec_id) USING (vec_id)"""

ORACLES = {
    "op1_url_filter": OP1,
    "op2_decontamination": OP2,
    "op3_licence_scan": OP3,
    "op6_substring_dedup": OP6,
    "op7_line_dedup": OP7,
    "op8_embedding_near_dedup": OP8,
}
