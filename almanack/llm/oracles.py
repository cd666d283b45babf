"""SQL for the queries of this folder that SQL can express."""

from __future__ import annotations

_WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def _base32(digest: str) -> str:
    """40 hex digits as 32 characters: five digits make four."""
    number = f"CAST('0x' || substr({digest}, 5 * i + 1, 5) AS BIGINT)"
    four = " || ".join(
        f"substr('{_BASE32}', CAST(({number} >> {shift}) & 31 AS BIGINT) + 1, 1)" for shift in (15, 10, 5, 0)
    )
    return f"list_aggregate(list_transform(range(8), lambda i: {four}), 'string_agg', '')"


DECONTAMINATION = f"""
WITH doc_words AS (SELECT doc_id, {_WORDS.format(_LOWER)} AS w FROM documents),
item_words AS (
  SELECT item_id, w, least(5, len(w)) AS k
  FROM (SELECT DISTINCT item_id, {_WORDS.format(_LOWER)} AS w FROM benchmark) WHERE len(w) > 0),
item_shingles AS (
  SELECT DISTINCT item_id, k, array_to_string(w[i:i + k - 1], ' ') AS s
  FROM (SELECT *, unnest(range(1, len(w) - k + 2)) AS i FROM item_words)),
sized AS (SELECT *, count(*) OVER (PARTITION BY item_id) AS n FROM item_shingles),
doc_shingles AS (
  SELECT DISTINCT doc_id, k, array_to_string(w[i:i + k - 1], ' ') AS s
  FROM (SELECT *, unnest(range(1, len(w) - k + 2)) AS i
        FROM doc_words, (SELECT DISTINCT k FROM item_words)))
SELECT doc_id, item_id, count(*) AS n_shared, n AS n_shingles, count(*) / n AS containment
FROM doc_shingles JOIN sized USING (k, s)
GROUP BY doc_id, item_id, n HAVING 100 * count(*) >= 75 * n
"""

WARC = f"""
WITH paid AS (
  SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS digest FROM pages),
placed AS (SELECT *, min(page_id) OVER (PARTITION BY html) AS first FROM paid)
SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes,
       {_base32("digest")} AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM placed
"""

_URL = r"regexp_extract(coalesce(url, ''), '(?s)\A.*?://([^/?#]*)([^?#]*)', {})"
_UPPER, _LOWERED = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _reputation(level: str, above: str, parent: str) -> str:
    """Groups of one level with the posterior (alpha, beta) that the parent's one leads to."""
    return f"""
{level}_groups AS (
  SELECT g.*, p.alpha / (p.alpha + p.beta) AS prior, p.alpha + p.beta AS worth
  FROM (SELECT {above} AS above, {level}, sum(n) AS n, sum(bad) AS bad FROM counted GROUP BY ALL) AS g
  JOIN {parent} AS p ON p.name = g.above),
{level}_moments AS (
  SELECT sum((bad - n * prior) ** 2 - n * prior * (1 - prior)) AS excess,
         sum(n * (n - 1) * prior * (1 - prior)) AS room
  FROM {level}_groups WHERE n > 0),
{level}_worth AS (
  SELECT 1 / least(greatest(CASE WHEN room > 0 THEN excess / room ELSE 0 END, 1 / 1001), 1 / 2) - 1 AS most
  FROM {level}_moments),
{level}_posterior AS (
  SELECT {level} AS name, prior * least(most, worth) + bad AS alpha,
         (1 - prior) * least(most, worth) + n - bad AS beta
  FROM {level}_groups, {level}_worth)"""


URLS = f"""
WITH parts AS (
  SELECT page_id, translate({_URL.format(1)}, '{_UPPER}', '{_LOWERED}') AS host, {_URL.format(2)} AS path FROM pages),
sites AS (
  SELECT *, string_split(site, '.') AS names,
         regexp_matches(site, '^[0-9]+(\\.[0-9]+){{3}}$|^\\[') AS numbers
  FROM (SELECT *, regexp_replace(regexp_replace(host, '^[^@]*@', ''), '\\.?(:[0-9]*)?$', '') AS site FROM parts)),
sized AS (
  SELECT *, CASE WHEN len(names) > 2 AND length(names[-1]) = 2
                  AND names[-2] IN ('ac', 'co', 'com', 'edu', 'gov', 'net', 'org') THEN 2 ELSE 1 END AS taken
  FROM sites),
levelled AS (
  SELECT page_id, host, path, site,
         CASE WHEN numbers THEN site ELSE array_to_string(names[greatest(len(names) - taken, 1):], '.') END AS domain,
         CASE WHEN numbers THEN '' ELSE array_to_string(names[greatest(len(names) - taken + 1, 1):], '.') END AS suffix
  FROM sized),
outcomes AS (
  SELECT doc_id AS page_id, count(*) AS n, sum(CASE WHEN quality = 0 OR toxic = 1 THEN 1 ELSE 0 END) AS bad
  FROM labels WHERE (quality = 0 OR toxic = 1) IS NOT NULL GROUP BY doc_id),
counted AS (
  SELECT 'all' AS whole, site, domain, suffix, coalesce(sum(n), 0) AS n, coalesce(sum(bad), 0) AS bad
  FROM levelled LEFT JOIN outcomes USING (page_id) GROUP BY ALL),
top AS (SELECT 'all' AS name, 1 + sum(bad) AS alpha, 9 + sum(n) - sum(bad) AS beta FROM counted),
{_reputation("suffix", "whole", "top")},
{_reputation("domain", "suffix", "suffix_posterior")},
{_reputation("site", "domain", "domain_posterior")},
blocked AS (
  SELECT name AS site FROM site_posterior
  WHERE alpha / (alpha + beta) - 1.645 * sqrt(alpha * beta / ((alpha + beta) ** 2 * (alpha + beta + 1))) > 0.3),
rules AS (
  SELECT * FROM (VALUES ('org/', 'allow', 'org', '/'), ('example.org/es/', 'block', 'example.org', '/es/'),
    ('example.org/en/1', 'block', 'example.org', '/en/1'), ('com/fr/', 'allow', 'com', '/fr/'),
    ('com/de/', 'block', 'com', '/de/')) AS r(rule, ruled, rule_host, rule_path)),
hosts AS (SELECT DISTINCT host FROM parts),
host_rules AS (SELECT * FROM hosts JOIN rules ON host = rule_host OR ends_with(host, '.' || rule_host)),
urls AS (SELECT DISTINCT host, path FROM parts),
ruled AS (
  SELECT host, path, arg_max(rule, length(rule)) AS rule, arg_max(ruled, length(rule)) AS ruled
  FROM urls JOIN host_rules USING (host) WHERE starts_with(path, rule_path) GROUP BY host, path)
SELECT page_id, host, path, rule,
       coalesce(ruled, CASE WHEN site IN (SELECT site FROM blocked) THEN 'block' ELSE 'allow' END) AS verdict
FROM levelled LEFT JOIN ruled USING (host, path)
"""


JACCARD = f"""
WITH RECURSIVE words AS (SELECT doc_id, {_WORDS.format(_LOWER)} AS w FROM documents),
sets AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
  FROM (SELECT *, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM words WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM sets AS a JOIN sets AS b USING (s)
  WHERE a.doc_id < b.doc_id GROUP BY ALL),
links AS (
  SELECT x, y FROM shared JOIN sizes AS a ON x = a.doc_id JOIN sizes AS b ON y = b.doc_id
  WHERE 100 * c >= 75 * (a.n + b.n - c)),
edges AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reached(node, other) AS (
  SELECT x, x FROM edges UNION SELECT node, y FROM reached JOIN edges ON other = x)
SELECT doc_id, coalesce(n, 0) AS n_shingles, coalesce(least_one, doc_id) AS component_id
FROM documents LEFT JOIN sizes USING (doc_id)
LEFT JOIN (SELECT node AS doc_id, min(other) AS least_one FROM reached GROUP BY node) USING (doc_id)
"""


def _repeated(size: int) -> str:
    """Places of words in windows of so many words that a text has twice or more."""
    return f"""
repeated_{size} AS (
  SELECT DISTINCT doc_id, i + k AS i
  FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, s) AS times
        FROM (SELECT doc_id, i, array_to_string(w[i:i + {size - 1}], ' ') AS s
              FROM (SELECT doc_id, w, unnest(range(1, len(w) - {size - 2})) AS i FROM words)))
       CROSS JOIN range({size}) AS r(k)
  WHERE times > 1),
covered_{size} AS (
  SELECT doc_id, count(*) AS words_{size}, sum(length(w[i])) AS chars_{size}
  FROM repeated_{size} JOIN words USING (doc_id) GROUP BY doc_id)"""


REPETITION = f"""
WITH words AS (SELECT doc_id, {_WORDS.format("coalesce(text, '')")} AS w FROM documents),
{_repeated(3)}, {_repeated(5)}, {_repeated(7)}, {_repeated(10)},
lines AS (
  SELECT doc_id, line, length(regexp_replace(line, '[\x20\x09-\x0D]', '', 'g')) AS chars
  FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line FROM documents)),
line_sums AS (
  SELECT doc_id, sum(times - 1) AS dup_lines, sum(CASE WHEN times > 1 THEN times * chars ELSE 0 END) AS dup_chars
  FROM (SELECT doc_id, line, chars, count(*) AS times FROM lines WHERE chars > 0 GROUP BY ALL) GROUP BY doc_id),
measured AS (
  SELECT doc_id, len(w) AS n_words,
         CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
         length(regexp_replace(coalesce(text, ''), '[^#*$%&|<>]', '', 'g')) AS n_symbols,
         CAST(coalesce(dup_lines, 0) AS BIGINT) AS n_dup_lines, coalesce(words_5, 0) AS n_repeat_words,
         coalesce(chars_3, 0) / greatest(word_chars, 1) > CAST(0.50 AS DOUBLE)
           OR coalesce(chars_5, 0) / greatest(word_chars, 1) > CAST(0.30 AS DOUBLE)
           OR coalesce(chars_7, 0) / greatest(word_chars, 1) > CAST(0.25 AS DOUBLE)
           OR coalesce(chars_10, 0) / greatest(word_chars, 1) > CAST(0.20 AS DOUBLE)
           OR coalesce(dup_chars, 0) / greatest(word_chars, 1) > CAST(0.30 AS DOUBLE) AS "over"
  FROM documents JOIN words USING (doc_id) LEFT JOIN line_sums USING (doc_id) LEFT JOIN covered_3 USING (doc_id)
  LEFT JOIN covered_5 USING (doc_id) LEFT JOIN covered_7 USING (doc_id) LEFT JOIN covered_10 USING (doc_id)),
judged AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM measured)
SELECT * EXCLUDE ("over"), NOT base_failed AND NOT "over" AS kept FROM judged
"""


def _drawn(k: int) -> str:
    return f"CAST('0x' || substr(drawn, {8 * k - 7}, 8) AS BIGINT)"


FILL_IN_MIDDLE = f"""
WITH units AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\\n]*\\n|[^\\n]+') AS u,
         sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS drawn
  FROM documents),
places AS (
  SELECT *, len(u) AS n, {_drawn(1)} % (len(u) + 1) AS x, {_drawn(2)} % (len(u) + 1) AS y,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') THEN 'plain'
              WHEN {_drawn(4)} % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
  FROM units),
parts AS (
  SELECT *, array_to_string(u[1:least(x, y)], '') AS p,
         array_to_string(u[least(x, y) + 1:greatest(x, y)], '') AS m,
         array_to_string(u[greatest(x, y) + 1:], '') AS s
  FROM places)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                        ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parts
"""

ORACLES = {
    "op5_decontamination": DECONTAMINATION,
    "op6_repetition": REPETITION,
    "op7_jaccard_join": JACCARD,
    "op8_warc": WARC,
    "op11_url_reputation": URLS,
    "op12_fill_in_middle": FILL_IN_MIDDLE,
}
