"""DuckDB SQL for the operators on words, digests and fingerprints."""

from __future__ import annotations

# CRC-32 in SQL: the table by its rule, then a byte at a time.
CRC_TABLE = """crc_table AS (
  SELECT list(c ORDER BY i) AS tab FROM (
    SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, _: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM range(256) t(i)))"""


def crc32(value: str) -> str:
    """Unsigned CRC-32 of a text expression without a null, where ``tab`` is in scope."""
    digits = f"hex({value})"
    steps = f"list_transform(range(CAST(len({digits}) // 2 AS BIGINT)), lambda i: CAST('0x' || substr({digits}, CAST(2 * i + 1 AS BIGINT), 2) AS BIGINT))"
    return f"xor(list_reduce(list_prepend(4294967295, {steps}), lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1])), 4294967295)"


OP11 = rf"""
WITH RECURSIVE {CRC_TABLE},
runs AS (
  SELECT doc_id, w, count(*) AS n FROM (
    SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]+')) AS w FROM documents)
  GROUP BY ALL),
drawn AS (SELECT w, n, {crc32("coalesce(CAST(doc_id AS VARCHAR), '') || ':' || w")} AS h FROM runs, crc_table),
cut AS (SELECT n, CASE WHEN h % 97 = 0 THEN substr(w, 1, h % length(w)) || substr(w, h % length(w) + 2) ELSE w END AS word FROM drawn),
words AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM cut WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
fewer AS (SELECT word, n, length(word) AS l, i, substr(word, 1, i) || substr(word, i + 2) AS d FROM words, range(length(word)) t(i)),
near AS (
  SELECT a.word, a.n, b.word AS other, b.n AS n_other FROM fewer a JOIN fewer b ON a.l = b.l AND a.i = b.i AND a.d = b.d AND a.word <> b.word
  UNION SELECT a.word, a.n, b.word, b.n FROM fewer a JOIN words b ON a.d = b.word
  UNION SELECT b.word, b.n, a.word, a.n FROM fewer a JOIN words b ON a.d = b.word),
best AS (SELECT *, count(*) OVER (PARTITION BY word) AS n_near, row_number() OVER (PARTITION BY word ORDER BY n_other DESC, other) AS turn FROM near),
formed AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN n_other >= 2 * w.n THEN other END AS form, CASE WHEN n_other >= 2 * w.n THEN n_other END AS form_n
  FROM words w LEFT JOIN best b ON b.word = w.word AND turn = 1),
walk(word, here) AS (SELECT word, word FROM formed UNION ALL SELECT w.word, f.form FROM walk w JOIN formed f ON f.word = w.here WHERE f.form IS NOT NULL)
SELECT f.word, f.form, w.here AS root, f.n, f.n_near, f.form_n
FROM formed f JOIN walk w ON w.word = f.word JOIN formed g ON g.word = w.here AND g.form IS NULL
"""


def _framed(column: str) -> str:
    return f"CASE WHEN {column} IS NULL THEN '-' ELSE strlen(CAST({column} AS VARCHAR)) || ':' || CAST({column} AS VARCHAR) END"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(_framed(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"


_UP = "list_transform(range((len(nodes) + 7) // 8), lambda i: sha256(array_to_string(nodes[8 * i + 1:8 * i + 8], '')))"
_LEFT, _RIGHT = ("array_to_string(nodes[(p >> (3 * lvl)) // 8 * 8 + 1:(p >> (3 * lvl))], '')",
                 "array_to_string(nodes[(p >> (3 * lvl)) + 2:(p >> (3 * lvl)) // 8 * 8 + 8], '')")

OP12 = rf"""
WITH RECURSIVE {CRC_TABLE},
lowered AS (
  SELECT *, CASE WHEN doc_id IS NOT NULL AND {crc32("CAST(doc_id AS VARCHAR)")} % 3 = 0
                 THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END AS other_text FROM documents, crc_table),
leaves AS (SELECT doc_id, lang, {_leaf("text")} AS leaf, {_leaf("other_text")} AS other FROM lowered),
placed AS (SELECT *, row_number() OVER () AS r, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS p FROM leaves),
trees(lang, lvl, nodes) AS (
  SELECT lang, 0, list(leaf ORDER BY p) FROM placed GROUP BY lang
  UNION ALL SELECT lang, lvl + 1, {_UP} FROM trees WHERE len(nodes) > 1),
subroots AS (SELECT lang, nodes[1] AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS p FROM trees WHERE len(nodes) = 1),
tops(lvl, nodes) AS (
  SELECT 0, list(subroot ORDER BY p) FROM subroots UNION ALL SELECT lvl + 1, {_UP} FROM tops WHERE len(nodes) > 1),
top_steps AS (
  SELECT lang, list({_LEFT} || '|' || {_RIGHT} ORDER BY lvl) AS steps FROM subroots, tops WHERE len(nodes) > 1 GROUP BY lang),
steps AS (
  SELECT r, list({_LEFT} || '|' || {_RIGHT} ORDER BY lvl) AS steps FROM placed x JOIN trees t ON x.lang IS NOT DISTINCT FROM t.lang AND len(nodes) > 1 GROUP BY r),
ways AS (
  SELECT doc_id, leaf, other, subroot, list_concat(coalesce(s.steps, []), coalesce(u.steps, [])) AS steps
  FROM placed x JOIN subroots b ON x.lang IS NOT DISTINCT FROM b.lang LEFT JOIN steps s ON s.r = x.r LEFT JOIN top_steps u ON u.lang IS NOT DISTINCT FROM x.lang),
folded AS (
  SELECT doc_id, leaf, subroot, (SELECT nodes[1] FROM tops WHERE len(nodes) = 1) AS root, sha256(replace(array_to_string(steps, ''), '|', '')) AS proof_sha256,
         list_reduce(list_prepend(other, steps), lambda h, s: sha256(split_part(s, '|', 1) || h || split_part(s, '|', 2))) AS folded_root FROM ways)
SELECT *, folded_root = root AS verified FROM folded
"""


def _modulo(product: str) -> str:
    return f"CAST(({product}) % 18446744073709551616::UHUGEINT AS UBIGINT)"


def _times(value: str, factor: int) -> str:
    return _modulo(f"CAST({value} AS UHUGEINT) * {factor}::UHUGEINT")


_SHIFTED = "xor({x}, {x} >> {n})"
_DIGIT = "substr('0123456789abcdef', CAST(1 + {bits} AS BIGINT), 1)"
_BIT = "{value} * CAST(2 * sum(CASE WHEN (v >> {at}) & 1 = 1 THEN weight ELSE 0 END) > sum(weight) AS BIGINT)"
_WORD = " || ".join(_DIGIT.format(bits=" + ".join(_BIT.format(value=8 >> j, at=63 - 4 * d - j) for j in range(4))) for d in range(16))
_NUMBERS = [f"CAST('0x' || substr({{x}}, {16 * i + 1}, 16) AS UBIGINT)" for i in range(4)]
_APART = " + ".join(f"CAST(bit_count(CAST(xor({n.format(x='{a}')}, {n.format(x='{b}')}) AS HUGEINT)) AS BIGINT)" for n in _NUMBERS)

OP13 = rf"""
WITH RECURSIVE own AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
following AS (
  SELECT *, length(t) AS n_chars, coalesce(lead(t) OVER o, first_value(t) OVER o) AS f
  FROM own WINDOW o AS (ORDER BY doc_id DESC NULLS LAST, md5(t) ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)),
changed AS (SELECT *, substr(t, 1, n_chars - n_chars // 2) || substr(f, 1, n_chars // 2) AS e FROM following),
texts AS (SELECT row_number() OVER () AS i, t FROM (SELECT t FROM changed UNION SELECT e FROM changed)),
worded AS (
  SELECT i, list_transform(list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda w: w <> ''), lambda w: CAST(CAST('0x' || substr(md5(w), 1, 16) AS UBIGINT) AS UHUGEINT)) AS ws FROM texts),
terms AS (
  SELECT i, unnest(ws) AS term, 1 AS weight FROM worded
  UNION ALL SELECT i, list_reduce(ws[k + 1:k + 5], lambda a, b: (a * {0xD1342543DE82EF95}::UHUGEINT + b) % 18446744073709551616::UHUGEINT), 5
  FROM (SELECT i, ws, unnest(range(greatest(len(ws) - 4, 1))) AS k FROM worded WHERE len(ws) > 0)),
weighed AS (SELECT i, CAST(term AS UHUGEINT) AS term, sum(weight) AS weight FROM terms GROUP BY ALL),
x0 AS (SELECT i, weight, k, {_modulo(f"term + {0x9E3779B97F4A7C15}::UHUGEINT * CAST(k AS UHUGEINT)")} AS x FROM weighed, range(1, 5) s(k)),
x1 AS (SELECT i, weight, k, {_times(_SHIFTED.format(x="x", n=30), 0xBF58476D1CE4E5B9)} AS x FROM x0),
x2 AS (SELECT i, weight, k, {_times(_SHIFTED.format(x="x", n=27), 0x94D049BB133111EB)} AS x FROM x1),
x3 AS (SELECT i, weight, k, {_SHIFTED.format(x="x", n=31)} AS v FROM x2),
parts AS (SELECT i, k, {_WORD} AS part FROM x3 GROUP BY i, k),
prints AS (SELECT i, string_agg(part, '' ORDER BY k) AS print FROM parts GROUP BY i),
printed AS (SELECT t, coalesce(print, repeat('0', 64)) AS print FROM texts LEFT JOIN prints USING (i)),
beside AS (
  SELECT doc_id, n_chars, sha256(e) AS edited_sha256, a.print AS fingerprint, b.print AS edited_fingerprint, c.print AS next_print
  FROM changed x JOIN printed a ON a.t = x.t JOIN printed b ON b.t = x.e JOIN printed c ON c.t = x.f),
own_prints AS (SELECT fingerprint AS p, min(doc_id) AS least FROM beside GROUP BY 1),
near AS (SELECT a.p AS a, b.p AS b FROM own_prints a JOIN own_prints b ON a.p <> b.p AND {_APART.format(a="a.p", b="b.p")} <= 7),
reached(p, q) AS (SELECT p, p FROM own_prints UNION SELECT p, b FROM reached JOIN near ON q = a),
classes AS (SELECT r.p, min(o.least) AS near_class FROM reached r JOIN own_prints o ON o.p = r.q GROUP BY r.p)
SELECT doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
       1 - ({_APART.format(a="fingerprint", b="edited_fingerprint")}) / 256 AS near_edited, 1 - ({_APART.format(a="fingerprint", b="next_print")}) / 256 AS near_next, near_class
FROM beside JOIN classes ON p = fingerprint
"""
