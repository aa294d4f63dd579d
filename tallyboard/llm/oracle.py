"""DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations

from .quality_rules import COMMON_WORDS, Limits

WORDS = r"list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '')"

OP1 = r"""
WITH unified AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       row_number() OVER (PARTITION BY t ORDER BY doc_id NULLS LAST) = 1 AS kept, sha256(t) AS text_sha256
FROM unified WINDOW same AS (PARTITION BY t)
"""

OP3 = r"""
WITH rules(rule, host_, path_, verdict_) AS (VALUES
       ('net/', 'net', '/', 'block'), ('example.net/en/', 'example.net', '/en/', 'allow'),
       ('example.com/de/', 'example.com', '/de/', 'block'), ('org/fr/', 'org', '/fr/', 'allow')),
parsed AS (
  SELECT row_number() OVER () AS r, page_id,
         translate(regexp_extract(coalesce(url, ''), '^(?s:.*?)://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '^(?s:.*?)://[^/?#]*(/[^?#]*)', 1) AS path
  FROM pages),
fits AS (
  SELECT r, max_by(rule, length(rule) * 1000 + length(host_)) AS rule, max_by(verdict_, length(rule) * 1000 + length(host_)) AS verdict
  FROM parsed JOIN rules ON (host = host_ OR ends_with(host, '.' || host_)) AND starts_with(path, path_) GROUP BY r)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM parsed LEFT JOIN fits USING (r)
"""

_LIMITS = Limits()
_LANGS = ", ".join(f"'{lang}'" for lang in COMMON_WORDS)
_KNOWN = ", ".join(f"'{w}'" for w in sorted({w for listed in COMMON_WORDS.values() for w in listed.split()}))
_CLASSES = ("upper", "digit", "punct", "symbol", "space", "other")
_PART = "CASE WHEN {x} > 0 THEN {x} * log2({x} / (({a} + {b}) / 2)) ELSE 0 END"


def _js(value: str) -> str:
    return "sqrt(greatest(0, least(1, sum(" + " + ".join(_PART.format(x=x, a="p", b="q") for x in "pq") + f") / 2))) AS {value}"


OP4 = rf"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t, CASE WHEN lang IN ({_LANGS}) THEN lang ELSE 'other' END AS lang FROM documents),
cut AS (
  SELECT *, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda w: w <> '') AS ws, list_filter(regexp_split_to_array(lower(t), '[^\p{{L}}]+'), lambda w: w <> '') AS ls,
         list_filter(string_split(t, chr(10)), lambda line: regexp_matches(line, '[^\x20\x09-\x0D]')) AS lines FROM docs),
counted AS (
  SELECT *, CAST(length(t) AS DOUBLE) AS chars, len(ws) AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
         length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
         length(t) - length(regexp_replace(t, '\p{{Lu}}', '', 'g')) AS upper, length(t) - length(regexp_replace(t, '\p{{Nd}}', '', 'g')) AS digit,
         length(t) - length(regexp_replace(t, '\p{{P}}', '', 'g')) AS punct, length(t) - length(regexp_replace(t, '\p{{S}}', '', 'g')) AS symbol FROM cut),
kinds AS (SELECT *, length(t) - word_chars AS space, word_chars - upper - digit - punct - symbol AS other FROM counted),
windows AS (SELECT r, i, array_to_string(ws[i:i + 7], ' ') AS w FROM (SELECT r, ws, unnest(range(1, len(ws) - 6)) AS i FROM kinds)),
again AS (SELECT r, w FROM windows GROUP BY 1, 2 HAVING count(*) > 1),
covered AS (SELECT r, count(DISTINCT i + j) AS n FROM windows JOIN again USING (r, w), range(8) t(j) GROUP BY 1),
said AS (SELECT r, lang, w, count(*) AS n FROM (SELECT r, lang, unnest(ls) AS w FROM kinds) WHERE w IN ({_KNOWN}) GROUP BY ALL),
totals AS (SELECT lang, sum(len(ls)) AS all_words, sum(chars) AS all_chars, {", ".join(f"sum({c}) AS {c}" for c in _CLASSES)} FROM kinds GROUP BY 1),
ref_words AS (SELECT lang, w, sum(n) / CAST(all_words AS DOUBLE) AS q FROM said JOIN totals USING (lang) GROUP BY lang, w, all_words),
pairs AS (
  SELECT k.r, coalesce(s.n, 0) / CAST(len(k.ls) AS DOUBLE) AS p, f.q FROM kinds k JOIN ref_words f USING (lang) LEFT JOIN said s ON s.r = k.r AND s.w = f.w WHERE len(k.ls) >= {_LIMITS.min_letter_words}),
both_ AS (SELECT * FROM pairs UNION ALL SELECT r, 1 - sum(p), 1 - sum(q) FROM pairs GROUP BY r),
by_words AS (SELECT r, {_js("word_distance")} FROM both_ GROUP BY r),
char_pairs AS ({" UNION ALL ".join(f"SELECT r, k.{c} / k.chars AS p, t.{c} / t.all_chars AS q FROM kinds k JOIN totals t USING (lang) WHERE chars >= {_LIMITS.min_chars}" for c in _CLASSES)}),
by_chars AS (SELECT r, {_js("char_distance")} FROM char_pairs GROUP BY r),
judged AS (
  SELECT *, n_words < {_LIMITS.min_words} OR 100 * coalesce(covered.n, 0) > {_LIMITS.max_repeat_percent} * n_words AS base_failed
  FROM kinds LEFT JOIN covered USING (r) LEFT JOIN by_words USING (r) LEFT JOIN by_chars USING (r))
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
       CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words, base_failed,
       NOT base_failed AND coalesce(char_distance, 0) <= {_LIMITS.max_char_distance} AND coalesce(word_distance, 0) <= {_LIMITS.max_word_distance} AS kept,
       round(char_distance, 6) AS char_distance, round(word_distance, 6) AS word_distance
FROM judged
"""

OP9 = rf"""
WITH sized AS (
  SELECT row_number() OVER () AS r, doc_id, source, CAST(len({WORDS}) AS BIGINT) AS size,
         md5('mix-1:' || coalesce(CAST(doc_id AS VARCHAR), 'null') || ':' || md5(coalesce(text, ''))) AS drawn FROM documents),
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source IS NULL, source) AS place FROM sized GROUP BY source),
weighed AS (SELECT *, CAST([1, 2, 3][1 + (place - 1) % 3] AS DOUBLE) AS w, source_size * 3 AS cap, sum(source_size) OVER () AS total FROM sources),
levels AS (
  SELECT *, total - coalesce(sum(cap) OVER (ORDER BY source_size / w, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest_here,
         sum(w) OVER (ORDER BY source_size / w, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open_here FROM weighed),
filled AS (SELECT *, cap * open_here <= w * rest_here AS is_full FROM levels),
shared AS (
  SELECT *, CAST(total - sum(CASE WHEN is_full THEN cap ELSE 0 END) OVER () AS DOUBLE) AS rest,
         sum(CASE WHEN is_full THEN 0 ELSE w END) OVER () AS open FROM filled),
aims AS (SELECT source, source_size, place, CASE WHEN is_full THEN CAST(cap AS DOUBLE) ELSE least(rest * w / nullif(open, 0), CAST(cap AS DOUBLE)) END AS target FROM shared),
seats AS (
  SELECT place, (2 * k - 1) / target AS cost
  FROM (SELECT place, target, unnest(range(1, CAST(ceil(target / 8) AS BIGINT) + (SELECT count(*) FROM aims) + 2)) AS k FROM aims WHERE target > 0)),
houses AS (SELECT shard, floor((SELECT round(sum(target) / 8) FROM aims) * (shard + 1) / 16) AS house FROM range(16) t(shard)),
turns AS (SELECT place, row_number() OVER (ORDER BY cost, place) AS turn FROM seats),
won AS (SELECT place, shard, count(*) AS blocks FROM turns JOIN houses ON turn <= house GROUP BY ALL),
plan AS (
  SELECT source, source_size, target, shard, CAST(least(coalesce(blocks, 0) * 8, source_size * 3) AS BIGINT) AS words
  FROM (SELECT * FROM aims, houses) LEFT JOIN won USING (place, shard)),
laid AS (
  SELECT r, doc_id, source, size,
         coalesce(sum(size) OVER (PARTITION BY source ORDER BY drawn, size, r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM sized)
, reached AS (
  SELECT r, doc_id, size, source_size, target, shard,
       CAST(CASE WHEN source_size = 0 THEN 0 ELSE (words // source_size) * size + greatest(0, least(size, words % source_size - before)) END AS BIGINT) AS upto
  FROM laid JOIN plan ON laid.source IS NOT DISTINCT FROM plan.source),
steps AS (SELECT *, upto - lag(upto, 1, 0) OVER (PARTITION BY r ORDER BY shard) AS words FROM reached)
SELECT doc_id, size, source_size, target, max(upto) AS taken,
       coalesce(string_agg(CASE WHEN words > 0 THEN shard || ':' || CAST(words AS BIGINT) END, ' ' ORDER BY shard), '') AS by_shard
FROM steps GROUP BY r, doc_id, size, source_size, target
"""

ORACLE_SQL = {"op1_exact_dedup": OP1, "op3_url_filter": OP3, "op4_quality_rules": OP4, "op9_source_mix": OP9}
