"""SQL for DuckDB that gives the rows of the queries of problems 1, 3, 4, 5 and 6.

The consistent form is built in steps over a table src(k, id, a, b, text): invisible characters and blanks, width by runs,
accents, then look-alike letters by tokens. Nothing is taken from the operators.
"""

from __future__ import annotations

SQL: dict[str, str] = {}

# Spelt out here and not taken from the operators, so that an error in their tables shows.
PART_LABELS = ("gloss", "usage", "note", "origin")
THRESHOLD = 0.7
_CYRILLIC = zip("асԁеһіјӏорԛѕѵԝхуүёїАВСЕԌНІЈКМОРԚЅТѴԜХУҮЁЇ", "acdehijlopqsvwxyyëïABCEGHIJKMOPQSTVWXYYËÏ", strict=True)
_GREEK = zip("αινορυϲϳΑΒΕΖΗΙΚΜΝΟΡΤΥΧϹͿ", "aivopucjABEZHIKMNOPTYXCJ", strict=True)
_ARMENIAN = zip("օսհցզՕՍԼ", "ouhgqOUL", strict=True)
_SEEN = dict([*_CYRILLIC, *_GREEK, *_ARMENIAN])
_HAN = r"\x{3005}\x{3007}\x{3400}-\x{4DBF}\x{4E00}-\x{9FFF}\x{F900}-\x{FAFF}"
_WIDE = r"\x{FF01}-\x{FF0F}\x{FF1A}-\x{FF20}\x{FF3B}-\x{FF40}\x{FF5B}-\x{FF5E}"
_CJK = r"\x{3001}-\x{3004}\x{3008}-\x{3020}\x{3030}"
_INVISIBLE = r"[\x{AD}\x{34F}\x{61C}\x{115F}\x{1160}\x{17B4}\x{17B5}\x{180B}-\x{180E}\x{200B}-\x{200F}\x{202A}-\x{202E}\x{2060}-\x{2064}\x{2066}-\x{206F}\x{3164}\x{FEFF}\x{FFA0}\x{FE00}-\x{FE0F}]"
_BLANK = r"[\x{A0}\x{1680}\x{2000}-\x{200A}\x{202F}\x{205F}\x{3000}]"


def _wide(codes: range) -> tuple[str, str]:
    a, b = "".join(map(chr, codes)), "".join(chr(c - 0xFEE0) for c in codes)
    return a.replace("'", "''"), b.replace("'", "''")


_PUNCTUATION = _wide([c for c in range(0xFF01, 0xFF5F) if not chr(c - 0xFEE0).isalnum()])
_LETTERS = _wide([c for c in range(0xFF01, 0xFF5F) if chr(c - 0xFEE0).isalnum()])
_FOREIGN = r"\x{370}-\x{3FF}\x{400}-\x{52F}\x{530}-\x{58F}"
_ALIKE = "".join(_SEEN)


def form(src: str) -> str:
    """CTEs that end in form(k, id, a, b, text, form) for a SELECT of k, id, a, b, text."""
    ligatures = "t"
    for x, y in (("ﬀ", "ff"), ("ﬁ", "fi"), ("ﬂ", "fl"), ("ﬃ", "ffi"), ("ﬄ", "ffl"), ("ﬅ", "st"), ("ﬆ", "st")):
        ligatures = f"replace({ligatures}, '{x}', '{y}')"
    return f"""src AS (SELECT DISTINCT * FROM ({src}) WHERE text IS NOT NULL),
s1 AS (SELECT *, regexp_replace(regexp_replace(text, '{_INVISIBLE}', '', 'g'), '{_BLANK}', ' ', 'g') AS t FROM src),
s2 AS (SELECT * EXCLUDE (t), regexp_extract_all(t, '[{_WIDE}{_CJK}]+|[^{_WIDE}{_CJK}]+') AS p FROM s1),
s3 AS (SELECT * EXCLUDE (p), array_to_string(list_transform(p, lambda x, i: CASE WHEN regexp_matches(x, '^[{_WIDE}{_CJK}]') AND NOT (i > 1 AND regexp_matches(p[i - 1], '[{_HAN}]$'))
  AND NOT (i < len(p) AND regexp_matches(p[i + 1], '^[{_HAN}]')) THEN translate(x, '{_PUNCTUATION[0]}', '{_PUNCTUATION[1]}') ELSE x END), '') AS t FROM s2),
s4 AS (SELECT * EXCLUDE (t), nfc_normalize(translate({ligatures}, '{_LETTERS[0]}', '{_LETTERS[1]}')) AS t FROM s3),
s5 AS (SELECT * EXCLUDE (t), regexp_extract_all(t, '/[^/\\s]+/|[\\p{{L}}\\p{{M}}]+|[^\\p{{L}}\\p{{M}}/]+|/') AS p FROM s4),
form AS (SELECT * EXCLUDE (p), nfc_normalize(array_to_string(list_transform(p, lambda x: CASE WHEN starts_with(x, '/') THEN x
  WHEN regexp_matches(x, '[{_FOREIGN}]') AND NOT regexp_matches(regexp_replace(x, '[{_ALIKE}]', '', 'g'), '[{_FOREIGN}]') THEN translate(x, '{_ALIKE}', '{"".join(_SEEN.values())}') ELSE x END), '')) AS form FROM s5)"""


_TEXTS = """SELECT 'definition' AS k, dictionary_entry_parsed_id AS id, NULL::BIGINT AS a, NULL::VARCHAR AS b, definition AS text FROM dictionary_entry_parsed
UNION ALL SELECT 'synonym_text', dictionary_entry_synonym_id, dictionary_entry_parsed_id, source_code, synonym_text FROM dictionary_entry_synonym"""
_DEFINITIONS = "SELECT 'definition' AS k, dictionary_entry_parsed_id AS id, NULL::BIGINT AS a, NULL::VARCHAR AS b, definition AS text FROM dictionary_entry_parsed"

SQL["p3_found"] = f"WITH {form(_TEXTS)} SELECT k AS field, id AS row_id FROM form WHERE form <> text"
SQL["p3_forms"] = f"WITH {form(_TEXTS)} SELECT k AS field, id AS row_id, form FROM form"


def _letters(c: str) -> str:
    return f"regexp_replace(lower({c}), '[^\\p{{L}}\\p{{N}}]+', '', 'g')"


_PARTS = f"list_sort(list_filter(list_transform(string_split_regex(form, '[;|\\r\\n]'), lambda x: {_letters('x')}), lambda x: x <> ''))"
_DEFINITION_KEY = f"CASE WHEN regexp_matches(form, '(?i)^\\s*(?:{'|'.join(PART_LABELS)})\\s*:') THEN ';' || array_to_string({_PARTS}, ';') ELSE {_letters('form')} END"
_FIRST, _LAST = _letters("split_part(form, ',', 1)"), _letters("split_part(form, ',', -1)")
_SYNONYM_KEY = f"CASE WHEN length(form) - length(replace(form, ',', '')) = 1 AND {_FIRST} <> '' AND {_LAST} <> '' THEN {_LAST} || {_FIRST} ELSE {_letters('form')} END"
_KEYED = f"keyed AS (SELECT k, id, a, b, CASE WHEN k = 'definition' THEN {_DEFINITION_KEY} ELSE {_SYNONYM_KEY} END AS key FROM form WHERE {_letters('form')} <> ''), least AS (SELECT k, id, min(id) OVER (PARTITION BY k, a, b, key) AS keep_id, count(*) OVER (PARTITION BY k, a, b, key) AS copies FROM keyed)"
SQL["p5_found"] = f"WITH {form(_TEXTS)}, {_KEYED} SELECT k AS field, keep_id, id AS copy_id FROM least WHERE id <> keep_id"
SQL["p5_records"] = f"WITH {form(_TEXTS)}, {_KEYED} SELECT k AS field, id AS record_id, copies FROM least WHERE id = keep_id"

_WORDS = "list_distinct(list_filter(string_split_regex(lower(form), '[^\\p{L}\\p{N}]+'), lambda w: w <> ''))"
_PAIRS = f"""{form(_DEFINITIONS)}, d AS (SELECT id, {_DEFINITION_KEY} AS key, {_WORDS} AS w FROM form), x AS (SELECT id, unnest(w) AS word FROM d WHERE len(w) > 0),
df AS (SELECT word, count(*) AS n FROM x GROUP BY word),
ranked AS (SELECT id, word, row_number() OVER (PARTITION BY id ORDER BY n, word) AS r, count(*) OVER (PARTITION BY id) AS size FROM x JOIN df USING (word)),
-- Sets this similar share one of their rarest words: as many as may differ, and one more.
prefix AS (SELECT id, word FROM ranked WHERE r <= size - ceil({THRESHOLD} * size - 1e-9) + 1),
pairs AS (SELECT DISTINCT p.id AS a, q.id AS b FROM prefix p JOIN prefix q ON p.word = q.word AND p.id < q.id),
common AS (SELECT a, b, da.key AS ka, db.key AS kb, len(list_intersect(da.w, db.w)) AS i, len(da.w) AS na, len(db.w) AS nb FROM pairs JOIN d da ON da.id = a JOIN d db ON db.id = b),
alike AS (SELECT * FROM common WHERE i::DOUBLE / (na + nb - i) >= {THRESHOLD})"""
SQL["p1_found"] = f"WITH {_PAIRS} SELECT a AS id_a, b AS id_b FROM alike WHERE ka <> kb"
SQL["p1_links"] = f"""
WITH {_PAIRS}, c AS (SELECT id, min(id) OVER (PARTITION BY key, list_sort(w)) AS class_id FROM d WHERE len(w) > 0),
l AS (SELECT ca.class_id AS a, cb.class_id AS b FROM alike JOIN c ca ON ca.id = alike.a JOIN c cb ON cb.id = alike.b WHERE ka <> kb), n AS (SELECT x, count(DISTINCT y) AS links FROM (SELECT a AS x, b AS y FROM l UNION SELECT b, a FROM l) GROUP BY x)
SELECT c.id AS dictionary_entry_parsed_id, c.class_id, coalesce(n.links, 0) AS links FROM c LEFT JOIN n ON n.x = c.class_id"""
SQL["p1_groups"] = f"""
WITH RECURSIVE {_PAIRS}, u AS MATERIALIZED (SELECT a, b FROM alike UNION SELECT b, a FROM alike), c AS (SELECT a AS id, a AS other FROM u UNION SELECT c.id, u.b FROM c JOIN u ON u.a = c.other),
g AS (SELECT id, min(other) AS group_id FROM c GROUP BY id)
SELECT id AS dictionary_entry_parsed_id, group_id, count(*) OVER (PARTITION BY group_id) AS members FROM g"""

_N = 12
_GRAMS = f"""g AS (SELECT k, id, unnest(list_transform(range(1, len(w) - {_N - 2}), lambda i: array_to_string(w[i : i + {_N - 1}], ' '))) AS gram FROM (
  SELECT k, id, list_filter(string_split_regex(lower(form), '[^\\p{{L}}\\p{{N}}]+'), lambda w: w <> '') AS w FROM form) WHERE len(w) >= {_N})"""
_CORPUS = "SELECT 'd' AS k, doc_id AS id, NULL AS a, NULL AS b, text FROM documents UNION ALL SELECT 'i', item_id, NULL, NULL, item_text FROM eval_item"
SQL["p6_found"] = f"WITH {form(_CORPUS)}, {_GRAMS} SELECT DISTINCT d.id AS doc_id, i.id AS item_id FROM g d JOIN g i ON d.gram = i.gram AND d.k = 'd' AND i.k = 'i'"

# Overlaps with substitutions: seeds, then the best stretch of each diagonal, word by word.
_OPEN = [[k for k, c in enumerate(m) if c == "x"] for m in ("xxx-x-xxxx", "xxxxx--x--xx", "x-x--xxx-xxx", "xxx-xx---xxx", "xx-xxxx-x-x", "x-xxx-xx-xx", "xxx---x-xxxx", "xx--x-xx-xxx")]
_SEED = " UNION ALL ".join(f"SELECT k, id, {n} AS seed, p, concat_ws(' ', {', '.join(f'w[p + {o}]' for o in open_)}) AS h FROM placed WHERE p + {open_[-1]} <= len(w)" for n, open_ in enumerate(_OPEN))
_OVERLAPS = f"""{form(_CORPUS)}, t AS MATERIALIZED (SELECT k, id, list_filter(string_split_regex(lower(form), '[^\\p{{L}}\\p{{N}}]+'), lambda w: w <> '') AS w FROM form),
own AS (SELECT word FROM (SELECT unnest(list_distinct(w)) AS word FROM t WHERE k = 'i') GROUP BY word HAVING count(*) < greatest(3, 0.05 * (SELECT count(*) FROM t WHERE k = 'i'))),
placed AS (SELECT k, id, w, unnest(range(1, len(w) + 1)) AS p FROM t WHERE k = 'd' OR len(w) >= 12), seeds AS MATERIALIZED ({_SEED}),
hits AS (SELECT DISTINCT d.id AS doc, i.id AS item, d.p AS p, d.p - i.p AS diagonal FROM seeds d JOIN seeds i ON d.k = 'd' AND i.k = 'i' AND d.seed = i.seed AND d.h = i.h),
lines AS MATERIALIZED (SELECT doc, item, diagonal, first, list_transform(range(first, last + 1), lambda n: (d.w[n] = i.w[n - diagonal])::INT) AS same, d.w[first:last] AS words
  FROM (SELECT DISTINCT doc, item, diagonal, greatest(1, 1 + diagonal) AS first FROM hits) h JOIN t d ON d.k = 'd' AND d.id = h.doc JOIN t i ON i.k = 'i' AND i.id = h.item, LATERAL (SELECT least(len(d.w), len(i.w) + diagonal) AS last)),
marked AS MATERIALIZED (SELECT doc, item, diagonal, first, same, list_transform(list_zip(same, words), lambda z: (z[1] = 1 AND list_contains(words_, z[2]))::INT) AS mine FROM lines, (SELECT list(word) AS words_ FROM own)),
near AS (SELECT m.*, h.p - m.first + 1 AS pos FROM marked m JOIN hits h USING (doc, item, diagonal)),
kept AS (SELECT DISTINCT doc, item, diagonal, same, mine FROM near WHERE (list_sum(same[greatest(1, pos - 12):pos + 23]) >= 12 AND list_sum(mine[greatest(1, pos - 12):pos + 23]) >= 3) OR contains(array_to_string(same[greatest(1, pos - 12):pos + 23], ''), '111111111111')),
steps AS (SELECT doc, item, diagonal, same, mine, 0 AS n, 0 AS run, 0 AS longest, 0 AS score, 0 AS peak, 0 AS begun, 0 AS best, 0 AS b, 0 AS e FROM kept
  UNION ALL SELECT doc, item, diagonal, same, mine, n + 1, r, greatest(longest, r), CASE WHEN lost THEN 0 ELSE s END, CASE WHEN lost THEN 0 WHEN x AND s >= peak THEN s ELSE peak END, CASE WHEN lost THEN n + 1 ELSE begun END,
    CASE WHEN up THEN s ELSE best END, CASE WHEN up THEN begun ELSE b END, CASE WHEN up THEN n + 1 ELSE e END
  FROM (SELECT *, x AND NOT lost AND s >= peak AND (s > best OR (s = best AND b = begun)) AS up FROM (SELECT *, s < 0 OR s < peak - 4 AS lost FROM (SELECT *, same[n + 1] = 1 AS x, CASE WHEN same[n + 1] = 1 THEN run + 1 ELSE 0 END AS r, score + CASE WHEN same[n + 1] = 1 THEN 1 ELSE -1 END AS s FROM steps WHERE n < len(same))))),
ends AS (SELECT doc, item, longest AS run, coalesce(list_sum(same[b + 1:e]), 0)::INT AS matches, coalesce(list_sum(mine[b + 1:e]), 0) AS mine, e - b AS size FROM steps WHERE n = len(same)),
found_ AS (SELECT doc AS doc_id, item AS item_id, run, matches, (size - matches)::INT AS substitutions FROM ends WHERE run >= 12 OR (matches >= greatest(12, 3 * (size - matches)) AND mine >= 3)
  QUALIFY row_number() OVER (PARTITION BY doc, item ORDER BY run DESC, matches DESC, size - matches) = 1)"""
SQL["p6_overlaps"] = f"WITH RECURSIVE {_OVERLAPS} SELECT * FROM found_"
SQL["p6_items"] = f"""WITH RECURSIVE {_OVERLAPS} SELECT i.item_id, i.suite, count(*) FILTER (o.run >= 12) AS documents, count(*) FILTER (o.run < 12) AS partly
FROM (SELECT DISTINCT item_id, suite FROM eval_item) i LEFT JOIN found_ o USING (item_id) GROUP BY ALL"""
