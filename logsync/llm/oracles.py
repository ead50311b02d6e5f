"""The results of the queries that DuckDB can state, in its SQL."""

from __future__ import annotations

from logsync.llm.license_scan import EQUIVALENTS, KNOWN
from logsync.llm.queries import URL_RULES
from logsync.llm.url_filter import LOWER, UPPER

_RULES = ", ".join(f"('{r.verdict}', '{r.host}', '{r.path}')" for r in URL_RULES)

_URLS = rf"""
WITH addresses AS (
  SELECT page_id,
    coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), '{UPPER}', '{LOWER}'), '') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages
), rules(verdict, rule_host, rule_path) AS (VALUES {_RULES})
SELECT page_id, host, path,
  (SELECT arg_max(rule_host || rule_path, length(rule_host || rule_path)) FROM rules
   WHERE (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)) AS rule,
  coalesce((SELECT arg_max(verdict, length(rule_host || rule_path)) FROM rules
   WHERE (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)), 'allow') AS verdict
FROM addresses
"""


def _canonical(text: str) -> str:
    low = f"translate(coalesce({text}, ''), '{UPPER}', '{LOWER}')"
    kept = (
        f"regexp_replace({low}, '(^|\\n)[ \\t#*/;%\\-]*(copyright|\\(c\\)|©|all rights reserved)[^\\n]*', "
        "chr(10), 'g')"
    )
    words = f"regexp_replace({kept}, '[^a-z0-9\\x{{80}}-\\x{{10FFFF}}]+', '  ', 'g')"
    out = f"' ' || trim({words}, ' ') || ' '"
    for spelling, usual in EQUIVALENTS:
        out = f"replace({out}, ' {spelling} ', ' {usual} ')"
    return out


_TEXTS = ", ".join("('{}', '{}')".format(i, t.replace("'", "''")) for i, t in KNOWN)

_LICENSES = f"""
WITH known(license_id, text) AS (VALUES {_TEXTS}),
digests AS (
  SELECT sha256({_canonical("text")}) AS license_digest, min(license_id) AS license_id FROM known GROUP BY 1
), scanned AS (SELECT doc_id, sha256({_canonical("text")}) AS license_digest FROM documents)
SELECT doc_id, license_digest, license_id FROM scanned LEFT JOIN digests USING (license_digest)
"""

_JACCARD = rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] ELSE list_distinct(list_transform(
    range(1, greatest(2, len(w) - 2)), lambda i: array_to_string(w[i : i + 3], ' '))) END AS s
  FROM words
), shingles AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM shingles a JOIN shingles b ON a.x = b.x AND a.doc_id < b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n
  HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
), edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents
  UNION SELECT reach.doc_id, edges.b FROM reach JOIN edges ON reach.other = edges.a
)
SELECT sets.doc_id, len(s) AS n_shingles, min(other) AS component_id
FROM sets JOIN reach USING (doc_id) GROUP BY sets.doc_id, s
"""

ORACLES = {
    "op2_url_filter": _URLS,
    "op3_license_scan": _LICENSES,
    "op6_jaccard_join": _JACCARD,
}
