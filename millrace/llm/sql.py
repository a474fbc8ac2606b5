"""DuckDB SQL for the operators that SQL can express."""

from .quality import STOP_WORDS

_SPANS = {
    "assign": (r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"'']?\x20*[:=]\x20*[\"'']?([A-Za-z0-9+/_.=-]+)", 2, 12),
    "access": (r"AKIA[A-Z0-9]+", 0, 18),
    "hex": (r"[0-9a-f]{16,}", 0, 16),
    "pem": (r"-----BEGIN [A-Z ]*PRIVATE KEY-----(?:[^-]*(?:-{1,4}[^-]+){0,64}-----END [A-Z ]*PRIVATE KEY-----|(?:[\x09-\x0D\x20]+[A-Za-z0-9+/=]{16,})*)", 0, 0),
    "jwt": (r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0, 0),
    "prefixed": (r"gh[opsru]_[A-Za-z0-9]{36,}|xox[abprs]-[A-Za-z0-9-]{10,}|sk_live_[A-Za-z0-9]{16,}|AIza[A-Za-z0-9_-]{35}", 0, 0),
    "login": (r"[a-z][a-z0-9+.-]{1,15}://[^\x00-\x20:/@]+:[^\x00-\x20:/@]+@", 0, 0),
}


def _found(place: int, kind: str, pattern: str, group: int, least: int) -> str:
    return f"""SELECT row, {place} AS place, '{kind}' AS kind, unnest(list_filter(list_transform(range(1, len(hit) + 1), lambda k: {{
      'start': list_sum(list_transform(gap[1:k], lambda x: length(x))) + coalesce(list_sum(list_transform(hit[1:k - 1], lambda x: length(x))), 0),
      'stop': list_sum(list_transform(gap[1:k], lambda x: length(x))) + list_sum(list_transform(hit[1:k], lambda x: length(x))),
      'chars': length(part[k])}}), lambda s: s.chars >= {least})) AS span
    FROM (SELECT row, regexp_extract_all(t, '{pattern}') AS hit, regexp_extract_all(t, '{pattern}', {group}) AS part,
      string_split_regex(t, '{pattern}') AS gap FROM d WHERE regexp_matches(t, '{pattern}'))"""


SECRETS = """
WITH d AS (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS t FROM documents),
found AS (
    %s
), ordered AS (
    SELECT row, place, kind, span.start AS start, kind || ':' || CAST(span.start AS BIGINT) || ':' || CAST(span.stop AS BIGINT) AS words FROM found
), joined AS (
    SELECT row, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
      count(*) FILTER (kind = 'hex') AS n_hex, string_agg(words, ',' ORDER BY start, place) FILTER (place < 3) AS base,
      string_agg(words, ',' ORDER BY start, place) AS spans
    FROM ordered GROUP BY row
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN joined USING (row)
""" % "\n    UNION ALL ".join(_found(i, k, *v) for i, (k, v) in enumerate(_SPANS.items()))

QUALITY = r"""
WITH d AS (
    SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS t,
      list_filter(regexp_split_to_array(coalesce(text, ''), '[ \t\n\x0B\f\r]+'), lambda w: w <> '') AS words,
      list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^ \t\n\x0B\f\r]')) AS lines
    FROM documents
), windows AS (
    SELECT row, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS w
    FROM (SELECT row, words, unnest(range(1, len(words) - 1)) AS i FROM d)
), twice AS (
    SELECT row, i FROM windows QUALIFY count(*) OVER (PARTITION BY row, w) > 1
), covered AS (
    SELECT row, CAST(sum(least(3, coalesce(following - i, 3))) AS BIGINT) AS n
    FROM (SELECT row, i, lead(i) OVER (PARTITION BY row ORDER BY i) AS following FROM twice) GROUP BY row
), m AS (
    SELECT doc_id, len(words) AS n_words, CAST(coalesce(list_sum(list_transform(words, lambda w: length(w))), 0) AS BIGINT) AS word_chars,
      length(t) - length(translate(t, '#*$%&|<>', '')) AS n_symbols, len(lines) AS n_lines,
      CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words,
      len(list_filter(words, lambda w: lower(w) IN (STOPS))) AS n_stop,
      len(list_filter(lines, lambda x: regexp_matches(x, '^[ \t]*[-*•]'))) AS n_bullet,
      len(list_filter(lines, lambda x: regexp_matches(x, '(…|\.\.\.)[ \t\r]*$'))) AS n_ellipsis
    FROM d LEFT JOIN covered USING (row)
), judged AS (
    SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, list_filter([
      CASE WHEN word_chars / nullif(n_words, 0) NOT BETWEEN 2.0 AND 15.0 THEN 'mean_word_length' END,
      CASE WHEN n_symbols / nullif(n_words, 0) > 0.25 THEN 'symbols_per_word' END,
      CASE WHEN n_stop / nullif(n_words, 0) < 0.02 THEN 'stop_word_ratio' END,
      CASE WHEN n_dup_lines / nullif(n_lines, 0) > 0.5 THEN 'duplicate_line_ratio' END,
      CASE WHEN n_bullet / nullif(n_lines, 0) > 0.9 THEN 'bullet_line_ratio' END,
      CASE WHEN n_ellipsis / nullif(n_lines, 0) > 0.5 THEN 'ellipsis_line_ratio' END], lambda x: x IS NOT NULL) AS broken
    FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND len(broken) = 0 AS kept, array_to_string(broken, ',') AS broken_rules
FROM judged
""".replace("STOPS", ", ".join(f"'{w}'" for w in STOP_WORDS))

URLS = r"""
WITH rest AS (
    SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), parts AS (
    SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS raw FROM rest
), urls AS (
    SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
      regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path
    FROM parts
)
SELECT page_id, host, path, fit.rule AS rule, coalesce(fit.verdict, 'allow') AS verdict
FROM (SELECT *, CASE
    WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/de/') THEN {'rule': 'example.com/de/', 'verdict': 'block'}
    WHEN (host = 'example.net' OR host LIKE '%.example.net') AND starts_with(path, '/en/') THEN {'rule': 'example.net/en/', 'verdict': 'allow'}
    WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/fr/') THEN {'rule': 'org/fr/', 'verdict': 'allow'}
    WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/') THEN {'rule': 'net/', 'verdict': 'block'} END AS fit
  FROM urls)
"""

_ASCII = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
_SPACE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

LINES = f"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT row, unnest(lines) AS line, unnest(range(len(lines))) AS i FROM d),
k AS (SELECT row, i, line, translate(trim(line, {_SPACE}), {_ASCII}) AS key FROM l),
shared AS (SELECT key FROM k WHERE key <> '' GROUP BY key HAVING count(DISTINCT row) >= 10),
kept AS (SELECT row, string_agg(line, chr(10) ORDER BY i) AS text, count(*) AS n FROM k ANTI JOIN shared USING (key) GROUP BY row)
SELECT doc_id, CAST(len(lines) AS BIGINT) AS n_lines, CAST(len(lines) - coalesce(n, 0) AS BIGINT) AS n_dropped, sha256(coalesce(text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (row)
"""


def _framed(*columns: str) -> str:
    return "sha256(" + " || ".join(f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')" for c in columns) + ")"


# DuckDB has no CRC, so the tampered ids are found by the bits of the polynomial.
_CRC = """list_reduce(list_prepend(4294967295::UBIGINT, list_transform(range(length(CAST(doc_id AS VARCHAR))), lambda i: ascii(CAST(doc_id AS VARCHAR)[i + 1])::UBIGINT)),
  lambda c, b: list_reduce(list_prepend(xor(c, b), [0::UBIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda x, y: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384::UBIGINT) ELSE x // 2 END))"""

MERKLE = f"""
WITH RECURSIVE leaves AS (
  SELECT row_number() OVER () AS row, doc_id, coalesce('=' || lang, '') AS tree, {_framed("doc_id", "source", "lang", "n_chars", "text")} AS leaf,
    CASE WHEN doc_id IS NOT NULL AND xor({_CRC}, 4294967295::UBIGINT) % 7 = 0 THEN {_framed("doc_id", "source", "lang", "n_chars + 1", "text")} END AS changed
  FROM documents
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf, row) - 1 AS place, count(*) OVER (PARTITION BY tree) AS total FROM leaves
), low AS (
  SELECT tree, 0 AS level, place, total, leaf AS digest FROM placed
  UNION ALL
  SELECT tree, level + 1, place // 2, (total + 1) // 2, sha256(string_agg(digest, '' ORDER BY place)) FROM low WHERE total > 1 GROUP BY tree, level, place // 2, total
), subroots AS (
  SELECT tree, digest, row_number() OVER (ORDER BY tree) - 1 AS place, level AS height FROM low WHERE total = 1
), high AS (
  SELECT 0 AS level, place, count(*) OVER () AS total, digest FROM subroots
  UNION ALL
  SELECT level + 1, place // 2, (total + 1) // 2, sha256(string_agg(digest, '' ORDER BY place)) FROM high WHERE total > 1 GROUP BY level, place // 2, total
), steps AS (
  SELECT p.row, a.level AS step, a.place % 2 AS side, b.digest AS sibling FROM placed p JOIN low a ON a.tree = p.tree AND a.place = p.place // (1 << a.level) AND a.total > 1
  LEFT JOIN low b ON b.tree = a.tree AND b.level = a.level AND b.place = xor(a.place, 1)
  UNION ALL
  SELECT p.row, s.height + a.level, a.place % 2, b.digest FROM placed p JOIN subroots s USING (tree) JOIN high a ON a.place = s.place // (1 << a.level) AND a.total > 1
  LEFT JOIN high b ON b.level = a.level AND b.place = xor(a.place, 1)
), proofs AS (
  SELECT row, sha256(string_agg(sibling, '' ORDER BY step)) AS proof FROM steps GROUP BY row
), walk AS (
  SELECT row, 0 AS step, coalesce(changed, leaf) AS digest FROM placed
  UNION ALL
  SELECT w.row, w.step + 1, sha256(CASE WHEN sibling IS NULL THEN digest WHEN side = 1 THEN sibling || digest ELSE digest || sibling END) FROM walk w JOIN steps s ON s.row = w.row AND s.step = w.step
), ends AS (
  SELECT row, arg_max(digest, step) AS folded FROM walk GROUP BY row
)
SELECT doc_id, leaf, s.digest AS subroot, r.digest AS root, coalesce(proof, sha256('')) AS proof_sha256, folded AS folded_root, folded = r.digest AS verified
FROM placed p JOIN subroots s USING (tree) JOIN ends USING (row) LEFT JOIN proofs USING (row) CROSS JOIN (SELECT digest FROM high WHERE total = 1) r
"""

SQL = {"op2_secret_scan": SECRETS, "op6_quality_rules": QUALITY, "op10_url_filter": URLS, "op11_line_dedup": LINES, "op13_merkle_manifest": MERKLE}
