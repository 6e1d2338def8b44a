"""SQL for DuckDB that gives the same rows as the queries of catalogue.py. Nothing is taken from the operators."""

from __future__ import annotations

#: White space of any script, for RE2.
SPACE = r"[\s\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
# Spelt out here and not taken from the operators, so that an error in their tables shows.
_SPELLINGS = {
    "noun": "noun n. n", "verb": "verb v. v vi. vt.", "adj": "adjective adj. adj", "adv": "adverb adv. adv", "preposition": "preposition prep. prep", "pronoun": "pronoun pron. pron", "conjunction": "conjunction conj. conj",
    "exclamation": "interjection interj. exclamation", "determiner": "determiner det. article", "numeral": "numeral", "particle": "particle", "phrase": "phrase", "prefix": "prefix pref.", "suffix": "suffix suf.", "abbreviation": "abbreviation abbr.", "symbol": "symbol",
}
PARTS_OF_SPEECH = {k: v for v, ks in _SPELLINGS.items() for k in ks.split()}
SHORT_WORDS = "('a', 'i', 'an', 'be', 'is', 'am', 'to', 'do', 'go', 'no', 'so')"
SMALL = "('a', 'an', 'and', 'as', 'at', 'but', 'by', 'for', 'from', 'in', 'into', 'nor', 'of', 'on', 'or', 'over', 'per', 'so', 'the', 'to', 'up', 'via', 'with', 'yet')"
_CODES = "old english ang, middle english enm, old french fro, old norse non, latin la, greek el, french fr, german de, dutch nl, italian it, spanish es, portuguese pt, arabic ar, hebrew he, sanskrit sa, persian fa, hindi hi, chinese zh, japanese ja, russian ru, welsh cy, malay ms"
LANGUAGES = dict(x.rsplit(" ", 1) for x in _CODES.split(", "))

SQL: dict[str, str] = {}


def _trim(c: str) -> str:
    return f"regexp_replace({c}, '^{SPACE}+|{SPACE}+$', '', 'g')"


def _squeeze(c: str) -> str:
    return f"trim(regexp_replace({c}, '{SPACE}+', ' ', 'g'))"


def _blank(c: str) -> str:
    return f"({c} IS NULL OR {_trim(c)} = '')"


def _chain(c: str, *steps: tuple[str, str]) -> str:
    for a, b in steps:
        c = "regexp_replace({}, '{}', '{}', 'g')".format(c, a.replace("'", "''"), b.replace("'", "''"))
    return c


def _values(pairs: dict[str, str]) -> str:
    return ", ".join("('{}', '{}')".format(k.replace("'", "''"), v) for k, v in pairs.items())


ENTRIES = "(SELECT DISTINCT ON (dictionary_entry_id) * FROM dictionary_entry)"
SENSES = "(SELECT DISTINCT ON (dictionary_entry_parsed_id) * FROM dictionary_entry_parsed)"
SYNONYMS = "(SELECT DISTINCT ON (dictionary_entry_synonym_id) * FROM dictionary_entry_synonym)"
EDGES = "(SELECT DISTINCT from_node_id, to_node_id, relation_type FROM graph_edge WHERE from_node_id IS NOT NULL AND to_node_id IS NOT NULL)"

_BROKEN = """
WITH refs AS (
  SELECT edge_id, 'from_node_id' AS ref_field, from_node_id AS v, created_utc AS t FROM graph_edge
  UNION ALL SELECT edge_id, 'to_node_id', to_node_id, created_utc FROM graph_edge),
broken AS (
  SELECT DISTINCT edge_id, ref_field, v, t FROM refs r WHERE v IS NOT NULL AND CASE
    WHEN regexp_full_match(v, '(Domain|Language):[0-9]+') THEN NOT EXISTS (
      SELECT 1 FROM label_catalog l WHERE (l.label_kind = 'domain' AND v = 'Domain:' || l.label_id) OR (l.label_kind = 'language' AND v = 'Language:' || l.label_id))
    ELSE NOT EXISTS (SELECT 1 FROM graph_node n WHERE n.node_id = v AND n.created_utc <= r.t AND (n.deleted_utc IS NULL OR n.deleted_utc > r.t)) END
  UNION SELECT DISTINCT edge_id, 'relation_type', relation_type, created_utc FROM graph_edge
  WHERE relation_type IS NOT NULL AND relation_type NOT IN (SELECT relation_type FROM graph_relation))
"""
SQL["p2_found"] = _BROKEN + "SELECT DISTINCT edge_id, ref_field FROM broken"
SQL["p2_report"] = _BROKEN + """SELECT ref_field, CASE WHEN ref_field = 'relation_type' THEN 'relation' WHEN contains(v, ':') THEN split_part(v, ':', 1) ELSE 'other' END AS kind,
  coalesce(strftime(t, '%Y-%m'), 'unknown') AS period, count(*) AS broken FROM broken GROUP BY ALL"""

_LANG = "CASE WHEN regexp_matches({0}, '[一-鿿]') THEN 'zh' ELSE 'en' END"
_SANITIZED = f"coalesce(CASE WHEN regexp_matches(word, '[一-鿿]') THEN {_trim('word')} ELSE " + _squeeze(r"regexp_replace(lower(word), '[^\p{L}\s]', ' ', 'g')") + " END, '')"
SQL["canonical_words"] = f"""
WITH w AS (SELECT {_SANITIZED} AS normalized_word, {_LANG.format('word')} AS language, source_code FROM {ENTRIES})
SELECT sha256(normalized_word) AS canonical_id, normalized_word, language, count(*) AS entries, count(DISTINCT source_code) AS sources
FROM w WHERE NOT {_blank('normalized_word')} AND NOT contains(normalized_word, ' ') AND NOT contains(normalized_word, '''') GROUP BY normalized_word, language"""
SQL["canonical_link_stats"] = f"""
SELECT source_code, count(*) FILTER (c.canonical_word_id IS NOT NULL) AS linked, count(*) FILTER (e.canonical_word_id IS NULL) AS unlinked,
  count(*) FILTER (e.canonical_word_id IS NOT NULL AND c.canonical_word_id IS NULL) AS dangling
FROM {ENTRIES} e LEFT JOIN canonical_word c ON e.canonical_word_id = c.canonical_word_id GROUP BY source_code"""
SQL["canonical_resolve"] = """SELECT DISTINCT e.dictionary_entry_id, c.canonical_word_id FROM dictionary_entry e JOIN canonical_word c USING (normalized_word) WHERE e.canonical_word_id IS NULL"""


def _short(c: str, n: int) -> str:
    return f"CASE WHEN NOT {_blank(c)} THEN {_trim(f'substring({_trim(c)}, 1, {n})')} END"


SQL["staging_rows"] = f"""
WITH s AS (SELECT dictionary_entry_id, {_short('word', 200)} AS word, {_short('normalized_word', 200)} AS normalized_word, {_short('part_of_speech', 50)} AS part_of_speech,
  {_short('etymology', 4000)} AS etymology, {_short('source_code', 30)} AS source_code, coalesce(sense_number, 1) AS sense_number FROM {ENTRIES} WHERE NOT {_blank('word')})
SELECT *, upper(sha256(word)) AS word_hash, upper(sha256(coalesce(source_code, 'UNKNOWN') || '|' || coalesce(normalized_word, '') || '|' || sense_number)) AS key_hash FROM s"""
SQL["staging_stats"] = """SELECT source_code, count(*) AS total_rows, count(DISTINCT (coalesce(normalized_word, ''), coalesce(sense_number, 1))) AS unique_keys,
  count(*) - count(DISTINCT (coalesce(normalized_word, ''), coalesce(sense_number, 1))) AS duplicates FROM dictionary_entry GROUP BY source_code"""
_MERGED = f"""SELECT dictionary_entry_id, word, normalized_word, coalesce(sense_number, 1) AS sense_number, source_code FROM dictionary_entry WHERE NOT {_blank("word")} @@
QUALIFY row_number() OVER (PARTITION BY source_code, normalized_word, coalesce(sense_number, 1) ORDER BY created_utc NULLS FIRST, dictionary_entry_id) = 1"""
SQL["merge_dedupe"] = _MERGED.replace("@@", "")
SQL["merge_append"] = f"""SELECT * FROM ({_MERGED.replace("@@", "AND source_code = 'KAIKKI'")}) n WHERE NOT EXISTS (SELECT 1 FROM dictionary_entry e WHERE e.source_code <> 'KAIKKI'
  AND e.normalized_word IS NOT DISTINCT FROM n.normalized_word AND coalesce(e.sense_number, 1) = n.sense_number)"""
_STATUS = "CASE WHEN failures = 0 THEN 'PASS' WHEN failures <= {0} THEN 'WARN' ELSE 'FAIL' END AS status"
SQL["post_merge_verify"] = f"""
WITH c AS (
  SELECT 'merge' AS phase, 'duplicate keys' AS check_name, count(*) AS failures FROM (SELECT 1 FROM {ENTRIES} GROUP BY source_code, normalized_word, sense_number HAVING count(*) > 1)
  UNION ALL SELECT 'merge', 'canonical missing', count(*) FROM {ENTRIES} WHERE canonical_word_id IS NULL
  UNION ALL SELECT 'merge', 'canonical unknown', count(*) FROM {ENTRIES} e WHERE canonical_word_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM canonical_word c WHERE c.canonical_word_id = e.canonical_word_id))
SELECT *, {_STATUS.format(0)} FROM c"""
_D, _W = _trim("definition"), _trim("meaning_title")
SQL["validate_entries"] = f"""
SELECT DISTINCT dictionary_entry_parsed_id, CASE WHEN {_blank('meaning_title')} THEN 'word missing' WHEN {_blank('definition')} THEN 'definition missing'
  WHEN (length({_W}) = 1 OR lower({_W}) IN {SHORT_WORDS}) AND length({_D}) >= 3 THEN 'ok' WHEN length({_D}) < 5 THEN 'definition too short'
  WHEN NOT regexp_matches({_D}, '\\p{{L}}') THEN 'no letters' ELSE 'ok' END AS reason FROM dictionary_entry_parsed"""
SQL["running_senses"] = f"""SELECT dictionary_entry_parsed_id, row_number() OVER (PARTITION BY dictionary_entry_id ORDER BY sense_number NULLS LAST, dictionary_entry_parsed_id)::INT AS running FROM {SENSES}"""
SQL["labels_by_source"] = f"""SELECT source_code, domain, count(*) AS senses FROM {SENSES} WHERE domain IN (SELECT canonical_label FROM label_catalog WHERE label_kind = 'domain') GROUP BY ALL"""

_DASH = "regexp_replace(regexp_replace(regexp_replace({0}, '[\\x{{2010}}-\\x{{2015}}\\x{{2053}}\\x{{2E17}}\\x{{2E1A}}\\x{{2E3A}}\\x{{2E3B}}\\x{{FE58}}\\x{{FE63}}\\x{{FF0D}}~]', '-', 'g'), '[\\x{{AD}}\\x{{1806}}]', '', 'g'), '_', ' ', 'g')"


def _word(c: str) -> str:
    t = f"strip_accents(regexp_replace({_DASH.format(f'lower({c})')}, '[★☆●○▶【】]', '', 'g'))"
    return "coalesce(" + _squeeze(f"regexp_replace({t}, '[^\\p{{L}}\\p{{N}}\\s\\-'']', ' ', 'g')") + ", '')"


_WORD = _word("word")
SQL["word_normalize"] = f"SELECT DISTINCT dictionary_entry_id, {_WORD} AS value FROM dictionary_entry"
SQL["word_sanitize"] = f"SELECT DISTINCT dictionary_entry_id, {_SANITIZED} AS value FROM dictionary_entry"
SQL["word_for_source"] = f"""SELECT DISTINCT dictionary_entry_id, coalesce(CASE WHEN upper(source_code) IN ('ENG_CHN', 'CENTURY21', 'ENG_COLLINS')
  THEN {_squeeze("regexp_replace(" + _DASH.format(_trim('word')) + ", '[★☆●○▶]', '', 'g')")} ELSE {_WORD} END, '') AS value FROM dictionary_entry"""
SQL["word_variants"] = f"""SELECT DISTINCT dictionary_entry_id, word AS variant, CASE WHEN lower(word) = normalized_word THEN 'case' WHEN {_WORD} = normalized_word THEN 'marks' ELSE 'spelling' END AS kind
FROM dictionary_entry WHERE word <> normalized_word"""
_POS = f"CASE WHEN {_blank('part_of_speech')} THEN 'unk' ELSE coalesce(pos.v, regexp_replace(lower({_trim('part_of_speech')}), '\\.$', '')) END"
_POS_FROM = f"LEFT JOIN (VALUES {_values(PARTS_OF_SPEECH)}) pos(k, v) ON pos.k = lower({_trim('part_of_speech')})"
SQL["pos_normalize"] = f"SELECT DISTINCT dictionary_entry_id, {_POS} AS value FROM dictionary_entry {_POS_FROM}"
SQL["pos_confidence"] = f"""
WITH p AS (SELECT DISTINCT dictionary_entry_id, {_POS} AS pos, CASE WHEN source_code = 'ENG_OXFORD' THEN 80 ELSE 70 END AS base FROM dictionary_entry {_POS_FROM})
SELECT dictionary_entry_id, pos, CASE WHEN trim(pos) = '' OR pos = 'unk' THEN 0 WHEN pos IN ('noun', 'verb', 'adjective', 'adverb') THEN least(base + 15, 95)
  WHEN pos IN ('preposition', 'conjunction', 'pronoun', 'interjection') THEN least(base + 10, 90) WHEN pos IN ('determiner', 'numeral', 'particle', 'article') THEN least(base + 5, 85) ELSE base END::INT AS confidence FROM p"""
_INFER = f"""CASE WHEN {_blank('definition')} THEN ('unk', 0) WHEN regexp_matches({_D}, '(?i)\\b(noun|n\\.)\\b') THEN ('noun', 95) WHEN regexp_matches({_D}, '(?i)\\b(verb|v\\.)\\b') THEN ('verb', 95)
  WHEN regexp_matches({_D}, '(?i)\\b(adjective|adj\\.)\\b') THEN ('adj', 90) WHEN regexp_matches({_D}, '(?i)\\b(adverb|adv\\.)\\b') THEN ('adv', 90) WHEN regexp_matches({_D}, '(?i)^to ') THEN ('verb', 80)
  WHEN regexp_matches({_D}, '(?i)^(a|an|the|one who) ') THEN ('noun', 80) WHEN regexp_matches({_D}, '(?i)^of or relating to ') THEN ('adj', 75) ELSE ('unk', 30) END"""
SQL["pos_infer"] = f"SELECT DISTINCT dictionary_entry_parsed_id, x[1] AS pos, x[2]::INT AS confidence FROM (SELECT dictionary_entry_parsed_id, {_INFER} AS x FROM dictionary_entry_parsed)"
SQL["pos_history"] = f"""
WITH i AS (SELECT DISTINCT dictionary_entry_id FROM (SELECT dictionary_entry_id, {_INFER} AS x FROM dictionary_entry_parsed) WHERE x[1] <> 'unk')
SELECT source_code, CASE WHEN {_POS} <> 'unk' THEN 'given' WHEN i.dictionary_entry_id IS NOT NULL THEN 'inferred' ELSE 'unknown' END AS status, count(*) AS entries
FROM {ENTRIES} e {_POS_FROM} LEFT JOIN i ON i.dictionary_entry_id = e.dictionary_entry_id GROUP BY ALL"""

_ENDS = "trim({0}, '\"''“”‘’.,;:!?')"


def _synonym(c: str) -> str:
    t = _ENDS.format(_squeeze(c))
    return f"CASE WHEN {_blank(c)} OR lower(trim({c})) = '[non_english]' OR NOT regexp_matches({t}, '[A-Za-z]') THEN '' WHEN length({t}) > 80 THEN trim(substring({t}, 1, 80)) ELSE {t} END"


SQL["synonym_clean"] = f"SELECT DISTINCT dictionary_entry_synonym_id, {_synonym('synonym_text')} AS value FROM dictionary_entry_synonym"
_BAD = r"(?i)\b(syn|synonym|synonyms|see|etc|viz|cf|pl|sing|vb|imp|comp|superl|shak|chaucer|milton|dryden|lowell|tennyson|wordsworth|bible)\b"
_VALID_SYNONYMS = f"""
s AS (SELECT dictionary_entry_parsed_id, {_synonym('synonym_text')} AS synonym, source_code FROM dictionary_entry_synonym),
h AS (SELECT dictionary_entry_parsed_id, min(meaning_title) AS head FROM dictionary_entry_parsed GROUP BY 1),
v AS (SELECT dictionary_entry_parsed_id, min(synonym) AS synonym, source_code FROM s JOIN h USING (dictionary_entry_parsed_id) WHERE length(synonym) BETWEEN 2 AND 40 AND NOT regexp_matches(synonym, '{_BAD}')
  AND NOT regexp_matches(synonym, '[^A-Za-z\\s\\-]') AND regexp_matches(synonym, '[A-Za-z]') AND len(list_filter(string_split(synonym, ' '), lambda w: w <> '')) <= 3
  AND ({_blank('head')} OR regexp_replace(lower(head), '[ ''-]', '', 'g') <> regexp_replace(lower(synonym), '[ ''-]', '', 'g')) GROUP BY dictionary_entry_parsed_id, source_code, lower(synonym))"""
SQL["synonym_filter"] = f"WITH {_VALID_SYNONYMS} SELECT * FROM v"
SQL["synonym_anti_join"] = f"""WITH {_VALID_SYNONYMS} SELECT * FROM v WHERE NOT EXISTS (SELECT 1 FROM dictionary_entry_synonym e WHERE e.dictionary_entry_parsed_id = v.dictionary_entry_parsed_id
  AND e.synonym_text = v.synonym AND e.source_code IS NOT DISTINCT FROM v.source_code)"""
SQL["alias_clean"] = f"""SELECT DISTINCT dictionary_entry_parsed_id, CASE WHEN {_blank('meaning_title')} OR lower(trim(meaning_title)) = '[non_english]' THEN '' ELSE trim(substring({_squeeze('meaning_title')}, 1, 150)) END AS value FROM dictionary_entry_parsed"""
_TARGET = "trim(" + _squeeze(r"regexp_replace(regexp_replace(synonym_text, '\[\[|\]\]|\{\{|\}\}', '', 'g'), '\|', ' ', 'g')") + ", '\"''“”‘’.,;:!?()[]{}')"
SQL["reference_target"] = f"""SELECT DISTINCT dictionary_entry_synonym_id, CASE WHEN {_blank('synonym_text')} OR NOT regexp_matches({_TARGET}, '[A-Za-z]') THEN '' ELSE lower(trim(substring({_TARGET}, 1, 80))) END AS value FROM dictionary_entry_synonym"""
_ETYMOLOGY = f"CASE WHEN {_blank('etymology')} OR lower({_squeeze('etymology')}) = '[non_english]' OR length({_squeeze('etymology')}) < 3 THEN '' ELSE trim(substring({_squeeze('etymology')}, 1, 4000)) END"
SQL["etymology_clean"] = f"SELECT DISTINCT dictionary_entry_id, {_ETYMOLOGY} AS value FROM dictionary_entry"
_NAMES = "|".join(sorted(LANGUAGES, key=lambda n: (-len(n), n)))
SQL["etymology_language"] = f"""
WITH e AS (SELECT DISTINCT dictionary_entry_id, {_ETYMOLOGY} AS etymology FROM dictionary_entry)
SELECT dictionary_entry_id, etymology, l.v AS language_code FROM e LEFT JOIN (VALUES {_values(LANGUAGES)}) l(k, v) ON l.k = regexp_extract(lower(etymology), '\\b({_NAMES})\\b', 1) WHERE etymology <> ''"""
SQL["example_key"] = f"SELECT DISTINCT dictionary_entry_parsed_id, coalesce(trim(substring({_squeeze(chr(114) + 'eplace(definition, ' + chr(39) + '’' + chr(39) + ', ' + chr(39) * 4 + ')')}, 1, 800)), '') AS value FROM dictionary_entry_parsed"

_OCR = _chain("definition", (r"\r\n?", "\n"), (r"\t", " "))
_OCR = f"translate({_OCR}, '“”’', '\"\"''')"
_OCR = _chain(_OCR, (r"\s+([,.;:!?])", r"\1"), (r"([,.;:!?])([A-Za-z])", r"\1 \2"), (r"([(\[])\s+", r"\1"), (r"\s+([)\]])", r"\1"), (r"\s{2,}", " "), (r"[ \t\r\f\v]*\n[ \t\r\f\v]*", "\n"), (r"\s{2,}", " "))
SQL["ocr_normalize"] = f"SELECT DISTINCT dictionary_entry_parsed_id, {_trim(_OCR)} AS value FROM dictionary_entry_parsed"
_TIDY = f"translate({_squeeze('definition')}, '“”‘’`', '\"\"''''''')"
_TIDY = "trim(" + _chain(_TIDY, (r"\s+([,.;:!?])", r"\1"), (r"([(\[])\s+", r"\1"), (r"\s+([)\]])", r"\1"), (r"\s+([/\\])\s+", r"\1"), (r";\s*;", ";"), (r"\.\s*\.", "."), (r",\s*,", ",")) + ")"
_TIDY = "trim(" + _chain(_TIDY, (r"(?i)^\s*(n\.|v\.|adj\.|adv\.|prep\.|conj\.|interj\.|pron\.)\s*", ""), (r"\s*\([^)]*\)\s*", " "), (r"\s*\[[^\]]*\]\s*", " "), (r";\s*", "; ")) + ")"
SQL["definition_tidy"] = f"""
WITH a AS (SELECT DISTINCT dictionary_entry_parsed_id, {_TIDY} AS t FROM dictionary_entry_parsed),
b AS (SELECT dictionary_entry_parsed_id, CASE WHEN regexp_matches(t, '^\\p{{Ll}}') THEN upper(substring(t, 1, 1)) || substring(t, 2) ELSE t END AS t FROM a)
SELECT dictionary_entry_parsed_id, CASE WHEN t = '' OR regexp_matches(t, '[.!?:;]$') THEN t ELSE t || '.' END AS value FROM b"""


def _balance(c: str) -> str:
    n = lambda t, x: f"(length({t}) - length(replace({t}, '{x}', '')))"
    steps = []
    for i, (a, b) in enumerate(("()", "[]", "{}")):
        d = f"({n('t', a)} - {n('t', b)})"
        steps.append(f"b{i} AS (SELECT id, c, CASE WHEN {d} = 1 THEN t || '{b}' WHEN {d} = -1 AND ends_with(t, '{b}') THEN substring(t, 1, length(t) - 1) ELSE t END AS t FROM {'a' if i == 0 else f'b{i - 1}'})")
    q = f"q AS (SELECT id, c, CASE WHEN {n('t', chr(34))} = 1 AND NOT ends_with(t, '\"') THEN t || '\"' ELSE t END AS t FROM b2)"
    r = f"r AS (SELECT id, c, CASE WHEN {n('t', '“')} = 1 AND {n('t', '”')} = 0 THEN t || '”' WHEN {n('t', '“')} = 0 AND {n('t', '”')} = 1 AND ends_with(t, '”') THEN substring(t, 1, length(t) - 1) ELSE t END AS t FROM q)"
    return ", ".join([*steps, q, r])


SQL["bracket_balance"] = f"""WITH a AS (SELECT DISTINCT dictionary_entry_parsed_id AS id, definition AS c, definition AS t FROM dictionary_entry_parsed), {_balance('definition')}
SELECT id AS dictionary_entry_parsed_id, CASE WHEN t <> c THEN {_trim('t')} ELSE c END AS value FROM r"""
SQL["title_case"] = f"""
WITH a AS (SELECT DISTINCT dictionary_entry_parsed_id AS id, meaning_title AS c, {_squeeze('meaning_title')} AS t FROM dictionary_entry_parsed),
w AS (SELECT id, c, string_split(CASE WHEN upper(t) = t AND length(t) > 4 THEN lower(t) ELSE t END, ' ') AS w FROM a)
SELECT id AS dictionary_entry_parsed_id, CASE WHEN {_blank('c')} THEN c ELSE array_to_string(list_transform(w, lambda x, i: CASE WHEN i > 1 AND i < len(w) AND lower(x) IN {SMALL} THEN lower(x)
  WHEN regexp_matches(x, '\\p{{Ll}}\\p{{Lu}}|[0-9]') THEN x ELSE array_to_string(list_transform(string_split(x, '-'), lambda p: upper(substring(p, 1, 1)) || lower(substring(p, 2))), '-') END), ' ') END AS value FROM w"""

_HAN = r"\x{4E00}-\x{9FFF}\x{3400}-\x{4DBF}"
_JA, _KO, _LA = r"\x{3040}-\x{30FF}\x{31F0}-\x{31FF}", r"\x{AC00}-\x{D7AF}\x{1100}-\x{11FF}\x{3130}-\x{318F}", "A-Za-zÀ-ÿ"
_IPA = r"/\[\]ˈˌːɑæəɛɪɔʊʌθðŋʃʒʤʧɡɜɒɫɾɹɻʲˑ˘˞\x{300}-\x{33F}"


def _has(c: str, s: str) -> str:
    return f"coalesce(regexp_matches({c}, '[{s}]'), false)"


def _bilingual(c: str) -> str:
    return f"({_has(c, _LA)} AND {_has(c, _HAN + _JA + _KO)})"


def _other(c: str) -> str:
    return f"(NOT {_blank(c)} AND NOT {_has(c, _IPA)} AND coalesce(regexp_matches(regexp_replace({c}, '[{_LA}]', '', 'g'), '\\p{{L}}'), false))"


def _english(c: str) -> str:
    rest = f"regexp_replace({c}, '[\\s\\p{{P}}\\p{{Nd}}]', '', 'g')"
    return f"coalesce(length({rest}) > 0 AND floor(length(regexp_replace({rest}, '[^{_LA}]', '', 'g')) * 100 / length({rest})) > 70, false)"


def _primary(c: str) -> str:
    return f"CASE WHEN {_blank(c)} THEN 'unknown' WHEN {_has(c, _IPA)} THEN 'ipa' WHEN {_bilingual(c)} THEN 'bilingual' WHEN {_has(c, _HAN)} THEN 'zh' WHEN {_has(c, _JA)} THEN 'ja' WHEN {_has(c, _KO)} THEN 'ko' WHEN {_english(c)} THEN 'en' ELSE 'unknown' END"


SQL["primary_language"] = f"SELECT DISTINCT dictionary_entry_parsed_id, {_primary('definition')} AS value FROM dictionary_entry_parsed"
SQL["language_flags"] = f"SELECT doc_id, {_other('text')} AS non_english, {_bilingual('text')} AS bilingual, {_english('text')} AS english FROM documents"
_FOUND = f"(SELECT DISTINCT dictionary_entry_parsed_id, source_code, definition AS text, sha256(coalesce(source_code, 'UNKNOWN') || '|' || definition) AS text_id FROM dictionary_entry_parsed WHERE {_other('definition')} OR {_bilingual('definition')})"
SQL["non_english_texts"] = f"SELECT DISTINCT text_id, source_code, {_primary('text')} AS language, length(text)::INT AS characters, text FROM {_FOUND}"
SQL["non_english_shown"] = f"SELECT DISTINCT dictionary_entry_parsed_id, text_id, CASE WHEN {_bilingual('text')} THEN '[BILINGUAL_DEFINITION]' ELSE '[NON_ENGLISH_DEFINITION]' END AS shown FROM {_FOUND}"
SQL["tokenize_words"] = r"""SELECT word, count(*) AS occurrences FROM (SELECT unnest(string_split_regex(lower(text), '[^\p{L}\p{N}]+')) AS word FROM documents) WHERE word <> '' GROUP BY word"""
SQL["top_synonyms"] = f"""SELECT dictionary_entry_parsed_id, (row_number() OVER (PARTITION BY dictionary_entry_parsed_id ORDER BY dictionary_entry_synonym_id))::INT AS rank, synonym_text FROM {SYNONYMS}
QUALIFY row_number() OVER (PARTITION BY dictionary_entry_parsed_id ORDER BY dictionary_entry_synonym_id) <= 3"""
_RELATED = " UNION ".join(
    f"SELECT dictionary_entry_parsed_id, unnest(regexp_extract_all(lower(definition), '{p}', 1)) AS word, '{k}' AS kind FROM dictionary_entry_parsed"
    for k, p in {"compare": "compare ([a-z]+)", "antonym": "opposed to ([a-z]+)", "likeness": "as with (?:a |an |the )?([a-z]+)", "shape": "shaped like (?:a |an |the )?([a-z]+)"}.items()
)
SQL["related_words"] = _RELATED
SQL["antonym_anti_join"] = f"WITH r AS ({_RELATED}) SELECT * FROM r WHERE kind <> 'antonym' AND NOT EXISTS (SELECT 1 FROM r b WHERE b.kind = 'antonym' AND b.dictionary_entry_parsed_id = r.dictionary_entry_parsed_id AND b.word = r.word)"
SQL["cross_references"] = f"""WITH r AS ({_RELATED}) SELECT DISTINCT r.dictionary_entry_parsed_id AS from_id, p.dictionary_entry_parsed_id AS to_id, 'COMPARE' AS relation_type
FROM r JOIN dictionary_entry e ON r.kind = 'compare' AND lower(e.normalized_word) = r.word JOIN dictionary_entry_parsed p ON p.dictionary_entry_id = e.dictionary_entry_id"""

SQL["sha256_keys"] = "SELECT p_partkey, upper(sha256(p_name)) AS name_hash, upper(sha256(p_brand || '|' || p_type || '|' || p_size)) AS key_hash FROM part"
SQL["json_props"] = """SELECT event_type, count(k) AS with_k, sum(k)::BIGINT AS sum_k, max(k) AS max_k FROM (SELECT event_type, TRY_CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events) GROUP BY event_type"""
SQL["keyset_page"] = "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey > 100 ORDER BY o_orderkey LIMIT 50"
SQL["offset_page"] = "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 50 OFFSET 100"
SQL["grammar_sample"] = f"""
WITH s AS (SELECT definition AS d FROM {SENSES} WHERE length(definition) > 50 ORDER BY sha256(dictionary_entry_parsed_id::VARCHAR) LIMIT 100),
c AS (SELECT count(*) AS sampled, count(*) FILTER (regexp_matches(d, '\\s[,.;:!?]') OR regexp_matches(d, '\\s{{2,}}') OR regexp_matches(d, '[,;]{{2,}}')) AS failures FROM s)
SELECT *, CASE WHEN failures = 0 THEN 'PASS' WHEN failures < 10 THEN 'WARN' ELSE 'FAIL' END AS status FROM c"""
_NW = "normalized_word"
SQL["qa_summary"] = f"""
WITH c AS (
  SELECT 'entries' AS phase, 'word blank' AS check_name, count(*) FILTER ({_blank('word')}) AS failures FROM {ENTRIES}
  UNION ALL SELECT 'entries', 'without senses', count(*) FROM {ENTRIES} WHERE dictionary_entry_id NOT IN (SELECT dictionary_entry_id FROM dictionary_entry_parsed WHERE dictionary_entry_id IS NOT NULL)
  UNION ALL SELECT 'senses', 'entry unknown', count(*) FROM {SENSES} WHERE dictionary_entry_id IS NULL OR dictionary_entry_id NOT IN (SELECT dictionary_entry_id FROM dictionary_entry)
  UNION ALL SELECT 'senses', 'definition blank', count(*) FILTER ({_blank('definition')}) FROM {SENSES}
  UNION ALL SELECT 'senses', 'parent unknown', count(*) FROM {SENSES} WHERE parent_parsed_id IS NOT NULL AND parent_parsed_id NOT IN (SELECT dictionary_entry_parsed_id FROM dictionary_entry_parsed)
  UNION ALL SELECT 'synonyms', 'sense unknown', count(*) FROM {SYNONYMS} WHERE dictionary_entry_parsed_id NOT IN (SELECT dictionary_entry_parsed_id FROM dictionary_entry_parsed)
  UNION ALL SELECT 'canonical', 'word blank', count(*) FILTER ({_blank(_NW)}) FROM canonical_word
  UNION ALL SELECT 'canonical', 'word not eligible', count(*) FILTER (NOT (NOT {_blank(_NW)} AND NOT contains({_NW}, ' ') AND NOT contains({_NW}, ''''))) FROM canonical_word)
SELECT *, {_STATUS.format(10)} FROM c"""

SQL["graph_nodes"] = """
SELECT 'Word:' || canonical_word_id AS node_id, 'Word' AS node_type FROM canonical_word UNION SELECT 'Sense:' || dictionary_entry_parsed_id, 'Sense' FROM dictionary_entry_parsed
UNION SELECT 'Concept:' || dictionary_entry_parsed_id, 'Concept' FROM dictionary_entry_parsed UNION SELECT 'Domain:' || label_id, 'Domain' FROM label_catalog WHERE label_kind = 'domain'
UNION SELECT 'Language:' || label_id, 'Language' FROM label_catalog WHERE label_kind = 'language'"""
_BUILT = """
SELECT 'Word:' || e.canonical_word_id AS from_node_id, 'Sense:' || p.dictionary_entry_parsed_id AS to_node_id, 'HAS_SENSE' AS relation_type FROM dictionary_entry_parsed p JOIN dictionary_entry e USING (dictionary_entry_id) WHERE e.canonical_word_id IS NOT NULL
UNION SELECT 'Sense:' || dictionary_entry_parsed_id, 'Sense:' || parent_parsed_id, 'SUB_SENSE_OF' FROM dictionary_entry_parsed WHERE parent_parsed_id IS NOT NULL
UNION SELECT 'Sense:' || dictionary_entry_parsed_id, 'Concept:' || dictionary_entry_parsed_id, 'BELONGS_TO' FROM dictionary_entry_parsed
UNION SELECT 'Sense:' || dictionary_entry_parsed_id, 'Domain:' || label_id, 'IN_DOMAIN' FROM dictionary_entry_parsed JOIN label_catalog ON label_kind = 'domain' AND canonical_label = domain"""
_REFERRED = r"""
SELECT DISTINCT s, word, k FROM (
  SELECT dictionary_entry_parsed_id AS s, unnest(regexp_extract_all(definition, '(?i)\bsee also ([A-Za-z][\w''-]*)', 1)) AS word, 'RELATED_TO' AS k FROM dictionary_entry_parsed
  UNION ALL SELECT dictionary_entry_parsed_id, unnest(regexp_extract_all(definition, '(?i)\b(?:compare|cf\.) ([A-Za-z][\w''-]*)', 1)), 'COMPARE' FROM dictionary_entry_parsed
  UNION ALL SELECT dictionary_entry_parsed_id, unnest(list_filter(regexp_extract_all(definition, '(?i)\bsee ([A-Za-z][\w''-]*)', 1), lambda w: lower(w) <> 'also')), 'SEE' FROM dictionary_entry_parsed)"""
_BUILT += f"""
UNION SELECT 'Sense:' || r.s, 'Sense:' || p.dictionary_entry_parsed_id, r.k FROM ({_REFERRED}) r JOIN dictionary_entry e ON lower(e.normalized_word) = lower(trim(r.word, '"''“”‘’.,;:!?()[]{{}}'))
JOIN dictionary_entry_parsed p ON p.dictionary_entry_id = e.dictionary_entry_id WHERE p.dictionary_entry_parsed_id <> r.s
UNION SELECT 'Word:' || e.canonical_word_id, 'Language:' || l.label_id, 'DERIVED_FROM' FROM dictionary_entry e JOIN label_catalog l ON l.label_kind = 'language'
AND regexp_matches(' ' || regexp_replace(lower(e.etymology), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g') || ' ', ' ' || lower(l.canonical_label) || ' ') WHERE e.canonical_word_id IS NOT NULL"""
SQL["graph_edges"] = _BUILT
SQL["graph_append"] = f"""SELECT relation_type, count(*) AS added FROM ({_BUILT}) b WHERE NOT EXISTS (SELECT 1 FROM graph_edge g WHERE g.from_node_id = b.from_node_id AND g.to_node_id = b.to_node_id AND g.relation_type = b.relation_type) GROUP BY relation_type"""
_KNOWN = "(SELECT node_id FROM graph_node WHERE node_id IS NOT NULL)"
SQL["graph_validate"] = f"""
SELECT 'self_loop' AS check_name, count(*) AS failures FROM {EDGES} WHERE from_node_id = to_node_id
UNION ALL SELECT 'orphan_from', count(*) FROM {EDGES} WHERE from_node_id NOT IN {_KNOWN} UNION ALL SELECT 'orphan_to', count(*) FROM {EDGES} WHERE to_node_id NOT IN {_KNOWN}
UNION ALL SELECT 'unknown_relation', count(*) FROM {EDGES} WHERE relation_type IS NULL OR relation_type NOT IN ('HAS_SENSE', 'SUB_SENSE_OF', 'IN_DOMAIN', 'DERIVED_FROM', 'SEE', 'RELATED_TO', 'COMPARE', 'BELONGS_TO')
UNION ALL SELECT 'broken_hierarchy', count(*) FROM {EDGES} WHERE relation_type = 'SUB_SENSE_OF' AND NOT (from_node_id LIKE 'Sense:%' AND to_node_id LIKE 'Sense:%')"""
SQL["graph_senses"] = f"SELECT from_node_id AS node_id, to_node_id AS other_id, relation_type FROM {EDGES} WHERE relation_type = 'HAS_SENSE' AND from_node_id LIKE 'Word:%'"
SQL["graph_sense_count"] = f"""SELECT canonical_word_id, count(e.to_node_id) AS senses, (count(e.to_node_id) > 0)::INT AS has_sense FROM canonical_word
LEFT JOIN {EDGES} e ON e.from_node_id = 'Word:' || canonical_word_id AND e.relation_type = 'HAS_SENSE' GROUP BY canonical_word_id"""
SQL["graph_refs_out"] = f"SELECT from_node_id AS node_id, to_node_id AS other_id, relation_type FROM {EDGES} WHERE relation_type IN ('SEE', 'RELATED_TO', 'COMPARE') AND from_node_id LIKE 'Sense:%'"
SQL["graph_refs_in"] = f"SELECT to_node_id AS node_id, from_node_id AS other_id, relation_type FROM {EDGES} WHERE relation_type IN ('SEE', 'RELATED_TO', 'COMPARE') AND to_node_id LIKE 'Sense:%'"
SQL["graph_words_of_concept"] = f"""SELECT DISTINCT g.to_node_id AS concept_id, e.word FROM {EDGES} g JOIN dictionary_entry_parsed p ON g.from_node_id = 'Sense:' || p.dictionary_entry_parsed_id
JOIN dictionary_entry e USING (dictionary_entry_id) WHERE g.to_node_id LIKE 'Concept:%' AND e.word IS NOT NULL"""
SQL["graph_degrees"] = f"""SELECT node_id, sum(o)::BIGINT AS out_degree, sum(i)::BIGINT AS in_degree FROM (SELECT from_node_id AS node_id, 1 AS o, 0 AS i FROM {EDGES} UNION ALL SELECT to_node_id, 0, 1 FROM {EDGES}) GROUP BY node_id"""
SQL["graph_concept_confidence"] = """SELECT e.canonical_word_id, count(DISTINCT p.source_code) AS sources, round(count(DISTINCT p.source_code) / (SELECT count(DISTINCT source_code) FROM dictionary_entry_parsed), 4) AS confidence
FROM dictionary_entry_parsed p JOIN dictionary_entry e USING (dictionary_entry_id) WHERE e.canonical_word_id IS NOT NULL AND p.source_code IS NOT NULL GROUP BY e.canonical_word_id"""
SQL["graph_walk"] = f"""
WITH RECURSIVE e AS MATERIALIZED {EDGES}, w AS (
  SELECT from_node_id AS start, to_node_id, relation_type, 1 AS depth, [from_node_id, to_node_id] AS path FROM e WHERE from_node_id LIKE 'Word:%'
  UNION ALL SELECT w.start, e.to_node_id, e.relation_type, w.depth + 1, list_append(w.path, e.to_node_id) FROM w JOIN e ON e.from_node_id = w.to_node_id WHERE w.depth < 3 AND NOT list_contains(w.path, e.to_node_id))
SELECT start, to_node_id, relation_type, depth, array_to_string(path, '>') AS path FROM w"""
_REACH = f"""
WITH RECURSIVE e AS MATERIALIZED (SELECT DISTINCT from_node_id, to_node_id FROM {EDGES}), r AS (
  SELECT from_node_id AS start, to_node_id AS node_id, 1 AS depth FROM e WHERE from_node_id LIKE 'Word:%'
  UNION SELECT r.start, e.to_node_id, r.depth + 1 FROM r JOIN e ON e.from_node_id = r.node_id WHERE r.depth < {{0}})"""
SQL["graph_reach"] = _REACH.format(3) + "SELECT start, node_id, min(depth) AS depth FROM r GROUP BY start, node_id"
SQL["graph_shortest_path"] = "WITH e AS MATERIALIZED (SELECT DISTINCT from_node_id AS a, to_node_id AS b FROM " + EDGES + "), p0 AS (SELECT DISTINCT a AS start, a AS node, a AS path FROM e WHERE a LIKE 'Word:%'), s0 AS (SELECT start, node FROM p0)"
for _i in range(1, 5):
    _ok = "" if _i == 1 else "AND p.node NOT LIKE 'Domain:%'"
    SQL["graph_shortest_path"] += f""", p{_i} AS (SELECT n.* FROM (SELECT p.start, e.b AS node, min(p.path || '>' || e.b) AS path FROM p{_i - 1} p JOIN e ON e.a = p.node {_ok} GROUP BY p.start, e.b) n ANTI JOIN s{_i - 1} s ON s.start = n.start AND s.node = n.node),
s{_i} AS (SELECT * FROM s{_i - 1} UNION ALL SELECT start, node FROM p{_i})"""
SQL["graph_shortest_path"] += " UNION ALL ".join([""] + [f"SELECT start, node AS target, {_i} AS depth, path FROM p{_i} WHERE node LIKE 'Domain:%'" for _i in range(1, 5)])[len(" UNION ALL"):]
_RANKED = "WITH e AS MATERIALIZED (SELECT DISTINCT from_node_id AS a, to_node_id AS b FROM " + EDGES + "), o AS (SELECT a, count(*) AS n FROM e GROUP BY a), v AS (SELECT a AS id FROM e UNION SELECT b FROM e), r0 AS (SELECT id, 1.0::DOUBLE AS r FROM v)"
for _i in range(1, 6):
    _RANKED += f", r{_i} AS (SELECT v.id, 0.15::DOUBLE + 0.85::DOUBLE * coalesce(g.got, 0) AS r FROM v LEFT JOIN (SELECT e.b AS id, sum(p.r / o.n) AS got FROM e JOIN o USING (a) JOIN r{_i - 1} p ON p.id = e.a GROUP BY e.b) g USING (id))"
SQL["graph_rank"] = _RANKED + " SELECT id AS node_id, round(r + 1e-9::DOUBLE, 6) AS rank FROM r5"
SQL["graph_components"] = f"""
WITH RECURSIVE l AS MATERIALIZED (SELECT from_node_id AS a, to_node_id AS b FROM {EDGES} WHERE relation_type IN ('SEE', 'RELATED_TO', 'COMPARE') AND from_node_id <> to_node_id),
u AS MATERIALIZED (SELECT a, b FROM l UNION SELECT b, a FROM l), c AS (SELECT a AS id, a AS other FROM u UNION SELECT c.id, u.b FROM c JOIN u ON u.a = c.other)
SELECT id, min(other) AS component FROM c GROUP BY id"""

_PAIRS = f"""(SELECT source_code, synonym_text AS from_text, {_synonym('synonym_text')} AS to_text,
  CASE WHEN has_non_english_text THEN 0.55 WHEN contains(synonym_text, ' ') THEN 0.7 ELSE 0.9 END AS confidence FROM {SYNONYMS})"""
_CANDIDATES = f"""SELECT source_code, substring({_trim('from_text')}, 1, 400) AS from_text, substring({_trim('to_text')}, 1, 400) AS to_text, count(*) AS suggested, round(max(confidence), 4)::DOUBLE AS confidence
FROM {_PAIRS} WHERE NOT {_blank('from_text')} AND NOT {_blank('to_text')} AND from_text <> to_text GROUP BY 1, 2, 3"""
SQL["rewrite_candidates"] = _CANDIDATES
SQL["rewrite_promote"] = f"""WITH c AS ({_CANDIDATES}), b AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY source_code, from_text ORDER BY confidence DESC, suggested DESC, to_text DESC) = 1)
SELECT source_code, from_text, to_text, suggested, confidence, (500 - CASE WHEN suggested >= 50 THEN 30 WHEN suggested >= 10 THEN 20 WHEN suggested >= 3 THEN 10 ELSE 0 END
  - CASE WHEN confidence >= 0.9 THEN 30 WHEN confidence >= 0.75 THEN 20 WHEN confidence >= 0.6 THEN 10 ELSE 0 END)::INT AS priority FROM b WHERE from_text NOT IN (SELECT normalized_word FROM canonical_word)"""
_STEPS = [(1, r"(?i)\bespecially\b", "esp."), (2, r"(?i)\bcompare\b", "cf."), (3, r"(?i)\ba piece of\b", "some"), (4, r"(?i)\bpiece\b", "part"), (5, r"\bthe act of (\w+)", r"act: \1"), (7, r"(?i)\boften\b", "mostly")]
_FOLD = "f0 AS (SELECT DISTINCT dictionary_entry_parsed_id AS id, definition AS before, " + _trim("definition") + " AS t, []::INT[] AS rules FROM dictionary_entry_parsed WHERE NOT " + _blank("definition") + ")"
for _i, (_id, _p, _to) in enumerate(_STEPS, 1):
    _FOLD += f", g{_i} AS (SELECT *, regexp_replace(t, '{_p}', '{_to}', 'g') AS n FROM f{_i - 1}), f{_i} AS (SELECT id, before, CASE WHEN n = t OR {_blank('n')} THEN t ELSE n END AS t, CASE WHEN n = t OR {_blank('n')} THEN rules ELSE list_append(rules, {_id}) END AS rules FROM g{_i})"
SQL["rewrite_map_apply"] = f"WITH {_FOLD} SELECT id AS dictionary_entry_parsed_id, t AS after, array_to_string(rules, ',') AS rules FROM f{len(_STEPS)} WHERE {_trim('before')} <> t"
SQL["rewrite_hits"] = f"WITH {_FOLD} SELECT rule_id, count(*) AS hits FROM (SELECT unnest(rules) AS rule_id FROM f{len(_STEPS)} WHERE {_trim('before')} <> t) GROUP BY rule_id"
_SEEN = f"regexp_replace({_trim('synonym_text')}, '\\s', '', 'g')"


def _share(p: str) -> str:
    return f"((length({_SEEN}) - length(regexp_replace({_SEEN}, '{p}', '', 'g'))) / length({_SEEN}))"


_T = _trim("synonym_text")
SQL["suggestion_safe"] = f"""SELECT DISTINCT dictionary_entry_synonym_id, coalesce(length({_T}) > 3 AND length({_T}) <= 80 AND NOT regexp_matches({_T}, '[\\n\\r\\t]') AND {_share('\\p{{Nd}}'.format())} < 0.2
  AND {_share('[^\\p{{L}}\\p{{Nd}}]'.format())} < 0.35 AND NOT ends_with({_T}, ':'), false) AS safe FROM dictionary_entry_synonym"""


def _search(stored: str, asked: str) -> str:
    """stored and asked: doc_id, source, mode, text."""
    words = r"list_filter(string_split_regex(lower(text), '[^\p{L}\p{N}]+'), lambda w: w <> '')"
    return rf"""
WITH d AS (SELECT DISTINCT doc_id, source, mode, text, {words} AS w FROM ({stored})), x AS (SELECT source, mode, doc_id, len(w) AS length, unnest(w) AS term FROM d), post AS (SELECT source, mode, term, doc_id, length, count(*) AS tf FROM x GROUP BY ALL),
df AS (SELECT source, mode, term, count(*) AS df FROM post GROUP BY ALL), n AS (SELECT source, mode, count(*) AS n, avg(len(w)) AS mean FROM d WHERE len(w) > 0 GROUP BY ALL),
q AS (SELECT DISTINCT doc_id AS query_id, source, mode, unnest({words}) AS term FROM ({asked}) WHERE doc_id % 50 = 0), need AS (SELECT query_id, mode, count(*) AS need FROM q GROUP BY ALL),
s AS (SELECT q.query_id, q.source, q.mode, p.doc_id, count(*) AS has, round(sum(ln(1 + (n.n - df.df + 0.5) / (df.df + 0.5)) * p.tf * 2.2 / (p.tf + 1.2 * (0.25 + 0.75 * p.length / n.mean))), 6) AS score
  FROM q JOIN df USING (source, mode, term) JOIN post p USING (source, mode, term) JOIN n USING (source, mode) WHERE p.doc_id <> q.query_id GROUP BY ALL)
SELECT s.query_id, s.mode, row_number() OVER (PARTITION BY s.query_id, s.mode ORDER BY s.score DESC, s.doc_id)::INT AS rank, s.doc_id, s.score, substring(d.text, 1, 120) AS preview
FROM s JOIN need USING (query_id, mode) JOIN d ON d.doc_id = s.doc_id AND d.source = s.source AND d.mode = s.mode WHERE has = need AND score >= 1.2 QUALIFY row_number() OVER (PARTITION BY s.query_id, s.mode ORDER BY s.score DESC, s.doc_id) <= 3"""


def _stored(mode: str, column: str) -> str:
    return f"SELECT dictionary_entry_parsed_id AS doc_id, source_code AS source, '{mode}' AS mode, {column} AS text FROM dictionary_entry_parsed WHERE {column} IS NOT NULL AND source_code IS NOT NULL"


_BOTH = _stored("definition", "definition") + " UNION ALL " + _stored("title", "meaning_title")
SQL["suggestion_topk"] = _search(_stored("definition", "definition"), _stored("definition", "meaning_title"))
SQL["suggestion_whole"] = _search(_BOTH, _BOTH)
SQL["ai_consensus"] = f"""SELECT dictionary_entry_parsed_id AS item_id, synonym_text AS answer FROM {SYNONYMS} WHERE NOT {_blank('synonym_text')}
QUALIFY row_number() OVER (PARTITION BY dictionary_entry_parsed_id ORDER BY length(synonym_text) DESC, dictionary_entry_synonym_id) = 1"""
SQL["ai_first_success"] = f"""SELECT dictionary_entry_parsed_id AS item_id, synonym_text AS answer FROM {SYNONYMS} WHERE NOT {_blank('synonym_text')}
QUALIFY row_number() OVER (PARTITION BY dictionary_entry_parsed_id ORDER BY dictionary_entry_synonym_id) = 1"""
SQL["readability"] = r"""
WITH d AS (SELECT doc_id, list_filter(string_split_regex(lower(text), '[^\p{L}\p{N}]+'), lambda w: w <> '') AS w, greatest(len(regexp_extract_all(text, '[.!?]+')), 1) AS s FROM documents WHERE text IS NOT NULL),
c AS (SELECT doc_id, len(w) AS n, s, list_sum(list_transform(w, lambda x: greatest(len(regexp_extract_all(x, '[aeiouy]+')), 1))) AS syllables FROM d WHERE len(w) > 0)
SELECT doc_id, n::INT AS words, s::INT AS sentences, round((206.835::DOUBLE - 1.015::DOUBLE * n / s) - 84.6::DOUBLE * syllables / n, 3) AS ease FROM c"""
SQL["stream_canonical_words"] = f"""
WITH w AS (SELECT {_SANITIZED} AS normalized_word FROM {ENTRIES}) SELECT normalized_word, count(*) AS entries FROM w
WHERE NOT {_blank('normalized_word')} AND NOT contains(normalized_word, ' ') AND NOT contains(normalized_word, '''') GROUP BY normalized_word"""

_CAPITAL = f"CASE WHEN NOT {_blank('domain')} THEN upper(substring({_squeeze('domain')}, 1, 1)) || lower(substring({_squeeze('domain')}, 2)) END"
SQL["format_labels"] = f"SELECT DISTINCT dictionary_entry_parsed_id, {_CAPITAL} AS domain, CASE WHEN NOT {_blank('usage_label')} THEN lower({_squeeze('usage_label')}) END AS usage_label FROM dictionary_entry_parsed"
SQL["format_etymology"] = f"SELECT DISTINCT dictionary_entry_id, CASE WHEN NOT {_blank('etymology')} THEN {_squeeze('regexp_replace(' + _trim('etymology') + r", '^\[(.*)\]$', '\1')")} END AS value FROM dictionary_entry"
SQL["duplicate_senses"] = r"""
WITH k AS (SELECT DISTINCT dictionary_entry_parsed_id, array_to_string(list_sort(list_distinct(list_filter(string_split_regex(lower(definition), '[^\p{L}\p{N}]+'), lambda w: w <> ''))), ' ') AS k FROM dictionary_entry_parsed),
m AS (SELECT *, min(dictionary_entry_parsed_id) OVER (PARTITION BY k) AS kept FROM k WHERE k <> '')
SELECT kept, dictionary_entry_parsed_id AS dropped FROM m WHERE dictionary_entry_parsed_id <> kept"""

# What definitions say beside their meaning.
_SAID = rf"""said AS (SELECT dictionary_entry_parsed_id AS id, meaning_title AS word, source_code AS s, coalesce(sense_number, 1) AS number, coalesce(nullif(regexp_extract(alias, '([A-Za-z]+)', 1), ''), 'thing') AS other, definition AS d0, id % 7 AS i,
  CASE i WHEN 0 THEN word || ' means the same as ' || other WHEN 1 THEN 'A kind of thing, also called ' || other WHEN 2 THEN d0 || '. See also ' || other WHEN 3 THEN word || ' is ' || other
  WHEN 4 THEN d0 || chr(10) || 'Origin: Old French ' || other WHEN 5 THEN 'Shown by “it is the way of ' || other || '” and compare ' || other ELSE word || ' or ' || other || ', n. of two kinds' END AS d FROM {SENSES} WHERE meaning_title IS NOT NULL AND definition IS NOT NULL)"""
_OTHER = "lower(other)"
_HEAD = _trim("regexp_replace(lower(word), '[★☆●○▶]', '', 'g')")
SQL["sense_references"] = rf"""WITH {_SAID}, r AS (
  SELECT id, unnest(regexp_extract_all(d, '(?i)\bsee also ([A-Za-z][\w''-]*)', 1)) AS w, 'see also' AS type FROM said UNION ALL SELECT id, unnest(regexp_extract_all(d, '(?i)\b(?:compare|cf\.) ([A-Za-z][\w''-]*)', 1)), 'compare' FROM said
  UNION ALL SELECT id, unnest(list_filter(regexp_extract_all(d, '(?i)\bsee ([A-Za-z][\w''-]*)', 1), lambda w: lower(w) <> 'also')), 'see' FROM said)
SELECT DISTINCT id AS dictionary_entry_parsed_id, lower(trim(w, '"''“”‘’.,;:!?()[]{{}}')) AS target, type FROM r"""
SQL["sense_origins"] = rf"""WITH {_SAID}, o AS (SELECT id, d, regexp_extract(d, '(?i)\b(?:etymology|origin):?\s*([^\n]+)', 1) AS line FROM said)
SELECT id AS dictionary_entry_parsed_id, {_trim('line')} AS etymology, CASE {" ".join(f"WHEN contains(lower(line), '{k}') THEN '{v}'" for k, v in LANGUAGES.items())} END AS language_code,
  {_trim("regexp_replace(d, '(?i)" + chr(92) + "b(?:etymology|origin):?" + chr(92) + "s*[^" + chr(92) + "n]+', '', 'g')")} AS rest FROM o WHERE {_trim('line')} <> ''"""
SQL["header_pos"] = rf"""WITH {_SAID} SELECT id AS dictionary_entry_parsed_id, CASE c WHEN 'a.' THEN 'adj' WHEN 'n.' THEN 'noun' ELSE 'verb' END AS pos FROM (SELECT id, lower(regexp_extract(d, '(?i),\s*(v\.t\.|v\.i\.|v\.|a\.|n\.)', 1)) AS c FROM said) WHERE c <> ''"""
_DOM, _DEF = _trim("domain"), "definition"
SQL["sense_domains"] = rf"""SELECT DISTINCT dictionary_entry_parsed_id, CASE WHEN {_blank('domain')} THEN NULL
  WHEN source_code = 'ENG_OXFORD' THEN substring({_trim("split_part(nullif(" + _trim("regexp_extract(definition, '^" + chr(92) + "(([^)]+)" + chr(92) + ")', 1)") + ", ''), '.', 1)")}, 1, 100)
  WHEN source_code = 'ENG_COLLINS' THEN CASE WHEN starts_with({_DOM}, '【语域标签】：') THEN split_part({_trim("replace(" + _DOM + ", '【语域标签】：', '')")}, ' ', 1) WHEN regexp_matches({_DEF}, '主美|美式') THEN 'US' WHEN regexp_matches({_DEF}, '主英|英式') THEN 'UK' WHEN contains({_DEF}, '正式') THEN 'FORMAL' END
  WHEN source_code IN ('STRUCT_JSON', 'KAIKKI') THEN substring({_trim("regexp_replace(" + _DOM + ", '[<>()]', '', 'g')")}, 1, 50)
  WHEN source_code = 'GUT_WEBSTER' THEN regexp_replace(nullif({_trim("regexp_extract(" + _DOM + ", '[<(]([^>)]+)[>)]', 1)")}, ''), '\.+$', '') WHEN source_code = 'CENTURY21' THEN NULL
  WHEN source_code = 'ENG_CHN' THEN nullif({_trim("regexp_extract(definition, '〔([^〕]+)〕', 1)")}, '') WHEN length({_DOM}) > 100 OR regexp_matches({_DOM}, '(?i)hours|days|weeks|minutes|seconds|o''clock') THEN NULL
  ELSE nullif({_trim("regexp_replace(" + _DOM + ", '[一-鿿]', '', 'g')")}, '') END AS value FROM dictionary_entry_parsed"""
_OK = rf"regexp_matches({_OTHER}, '^[a-z''-]{{2,}}$') AND regexp_matches(h, '^[a-z''-]{{2,}}$') AND {_OTHER} <> h"
SQL["synonym_patterns"] = rf"""WITH {_SAID}, h AS (SELECT *, {_HEAD} AS h FROM said), c AS (
  SELECT id, {_OTHER} AS synonym, CASE WHEN i = 0 AND s = 'ENG_COLLINS' AND regexp_matches(h, '^\w+$') THEN 100 WHEN i = 0 AND s = 'ENG_COLLINS' THEN 100 WHEN i = 1 AND s = 'ENG_COLLINS' THEN 60 WHEN i = 2 AND s = 'ENG_COLLINS' THEN 30
    WHEN i = 3 AND s IN ('ENG_OXFORD', 'ENG_CHN') THEN 100 WHEN i = 3 AND coalesce(s, '') <> 'ENG_COLLINS' THEN 60 WHEN i = 6 AND s = 'ENG_COLLINS' THEN 60 END AS confidence FROM h WHERE {_OK})
SELECT id AS dictionary_entry_parsed_id, synonym, confidence, CASE confidence WHEN 100 THEN 'high' WHEN 60 THEN 'medium' ELSE 'low' END AS level FROM c WHERE confidence IS NOT NULL"""
SQL["cjk_strip"] = f"SELECT DISTINCT dictionary_entry_parsed_id, {_trim('regexp_replace(' + _trim('regexp_replace(definition, ' + chr(39) + '[' + chr(92) + 'x{4E00}-' + chr(92) + 'x{9FFF}' + chr(92) + 'x{3400}-' + chr(92) + 'x{4DBF}' + chr(92) + 'x{F900}-' + chr(92) + 'x{FAFF}]' + chr(39) + ', ' + chr(39) * 2 + ', ' + chr(39) + 'g' + chr(39) + ')') + ', ' + chr(39) + '[，。、；：！？【】（）《》〈〉「」『』]' + chr(39) + ', ' + chr(39) * 2 + ', ' + chr(39) + 'g' + chr(39) + ')')} AS value FROM dictionary_entry_parsed"
SQL["domain_marker_strip"] = f"SELECT DISTINCT dictionary_entry_parsed_id, {_trim('alias')} AS value FROM dictionary_entry_parsed"
_W = _trim("word")
SQL["headword_flags"] = rf"SELECT DISTINCT dictionary_entry_id, coalesce(length({_W}) <= 40 AND upper({_W}) = {_W} AND regexp_matches({_W}, '\p{{L}}'), false) AS value FROM dictionary_entry"
SQL["pronunciation_match"] = f"""SELECT c.w IS NOT NULL AS matched, count(*) AS words FROM (SELECT DISTINCT lower({_W}) AS w FROM dictionary_entry WHERE word IS NOT NULL) e LEFT JOIN (SELECT DISTINCT lower(normalized_word) AS w FROM canonical_word) c ON c.w = e.w GROUP BY 1"""
SQL["senses_by_entry"] = f"""WITH r AS (SELECT dictionary_entry_id, dictionary_entry_parsed_id, row_number() OVER (PARTITION BY dictionary_entry_id ORDER BY sense_number NULLS LAST, dictionary_entry_parsed_id) AS n FROM {SENSES})
SELECT dictionary_entry_id, string_agg(dictionary_entry_parsed_id::VARCHAR, ',' ORDER BY n) AS senses FROM r WHERE n <= 10 AND dictionary_entry_id IS NOT NULL GROUP BY 1"""

_JAPANESE_KOREAN = (("latin", _LA), ("chinese", _HAN), ("japanese", _JA), ("korean", _KO), ("ipa", _IPA))
_REST = r"coalesce(regexp_replace(text, '[\s\p{P}]', '', 'g'), '')"
_LEFT, _COUNTS = "r", {}
for _k, _s in (("ipa", _IPA), ("latin", _LA), ("chinese", _HAN), ("japanese", _JA), ("korean", _KO)):
    _COUNTS[_k] = f"length(regexp_replace({_LEFT}, '[^{_s}]', '', 'g'))"
    _LEFT = f"regexp_replace({_LEFT}, '[{_s}]', '', 'g')"
_COUNTS["other"] = f"length({_LEFT})"
SQL["language_distribution"] = f"SELECT doc_id, {', '.join(f'CASE WHEN length(r) > 0 THEN round({v} * 100.0::DOUBLE / length(r), 4) ELSE 0 END::DOUBLE AS {k}' for k, v in _COUNTS.items())} FROM (SELECT doc_id, {_REST} AS r FROM documents)"
SQL["example_filter"] = rf"""
WITH s AS (SELECT unnest(string_split_regex(text, '[.!?]+\s+|\n+')) AS x FROM documents), t AS (SELECT {_trim("x || '.'")} AS t, string_split_regex(lower({_trim("x || '.'")}), '[^\p{{L}}\p{{N}}_]+') AS w FROM s WHERE x <> '')
SELECT length(t) BETWEEN 6 AND 400 AND regexp_matches(t, '^\p{{L}}') AND NOT regexp_matches(t, '[()\[\]【】]') AND NOT regexp_matches(t, '(?i)^s\s') AND len(list_filter(string_split(t, ' '), lambda v: v <> '')) >= 3
  AND NOT list_has_any(w, ['defn', 'abbr', 'syn', 'see', 'example', 'examples']) AND (list_has_any(w, ['is', 'was', 'were', 'are', 'be', 'been', 'being', 'to', 'of', 'with', 'for', 'by', 'in', 'on', 'one', 'two', 'three', 'four', 'five', 'ten', 'hundred', 'thousand'])
  OR len(list_filter(w, lambda v: regexp_full_match(v, '\d+'))) > 0) AS valid, count(*) AS sentences FROM t GROUP BY 1"""
SQL["definition_senses"] = rf"""
WITH a AS (SELECT DISTINCT dictionary_entry_parsed_id AS id, definition AS c, string_split(regexp_replace(regexp_replace(definition, '\n\s*(?:[0-9]+[.)]|[a-z][.)]|[•*–—-])\s*', chr(1), 'g'), ';\s*([A-Z0-9])', chr(1) || '\1', 'g'), chr(1)) AS p FROM dictionary_entry_parsed)
SELECT id AS dictionary_entry_parsed_id, CASE WHEN {_blank('c')} THEN '' ELSE array_to_string(list_filter(list_transform(p, lambda x: {_squeeze("regexp_replace(x, '^" + chr(92) + "s*(?:[0-9]+[.)]|[a-z][.)]|[•*–—-])" + chr(92) + "s*', '')")}), lambda x: x <> ''), '|') END AS value FROM a"""
SQL["html_text"] = f"SELECT DISTINCT dictionary_entry_parsed_id, trim(regexp_replace(coalesce(meaning_title, '') || ' & ' || coalesce(alias, ''), '{SPACE}+', ' ', 'g')) AS value FROM dictionary_entry_parsed"
SQL["enhancement_notes"] = f"""WITH {_FOLD} SELECT id AS dictionary_entry_parsed_id, t AS after, to_json({{'original': before, 'rules': rules}})::VARCHAR AS notes FROM f{len(_STEPS)} WHERE len(rules) > 0 AND id NOT IN (SELECT dictionary_entry_parsed_id FROM dictionary_entry_synonym WHERE dictionary_entry_parsed_id IS NOT NULL)"""
SQL["suggestion_pairs"] = f"""
WITH x AS (SELECT DISTINCT p.source_code, 'Definition' AS mode, {_trim('p.definition')} AS original, t.value AS enhanced FROM dictionary_entry_parsed p JOIN ({SQL['definition_tidy'].replace('FROM dictionary_entry_parsed', f"FROM (SELECT dictionary_entry_parsed_id, {_trim('definition')} AS definition FROM dictionary_entry_parsed)")}) t USING (dictionary_entry_parsed_id)
  UNION SELECT p.source_code, 'MeaningTitle', {_trim('p.meaning_title')}, t.value FROM dictionary_entry_parsed p JOIN ({SQL['title_case'].replace('FROM dictionary_entry_parsed', f"FROM (SELECT dictionary_entry_parsed_id, {_trim('meaning_title')} AS meaning_title FROM dictionary_entry_parsed)")}) t USING (dictionary_entry_parsed_id))
SELECT *, upper(sha256(original)) AS hash FROM x WHERE NOT {_blank('source_code')} AND NOT {_blank('original')} AND NOT {_blank('enhanced')} AND original <> enhanced"""
SQL["ai_notes_merge"] = """SELECT event_id, '{"k":"' || json_extract_string(props, '$.k') || '","suggestions":"[\\"' || event_type || '\\"]"}' AS notes FROM events"""
_MARKED = _trim("part_of_speech")
_DOTTED = _MARKED
for _a in ("adj", "v", "n", "pl", "fig", "obs"):
    _DOTTED = rf"regexp_replace({_DOTTED}, '(?i)(^|[\s(\[{{,/;:])({_a})($|[\s)\]}}.,;:])', '\1\2.\3', 'g')"
_DOTTED = rf"regexp_replace(regexp_replace({_DOTTED}, '(?i)\b(adj|v|n|pl|fig|obs)\.\.+', '\1.', 'g'), '(?i)\b(adj|v|n|pl|fig|obs)\.\s*([A-Za-z])', '\1. \2', 'g')"
SQL["abbreviation_standardize"] = rf"SELECT DISTINCT dictionary_entry_id, CASE WHEN {_blank('part_of_speech')} OR length({_MARKED}) > 260 OR regexp_matches(regexp_replace({_MARKED}, '[\x00-\x7f]', '', 'g'), '\p{{L}}') THEN {_MARKED} ELSE {_DOTTED} END AS value FROM dictionary_entry"

# Counts of the parse stage, from the parts above.
SQL["parse_manifest"] = f"""WITH {_SAID}, e AS (SELECT s, id FROM said WHERE i = 5 AND regexp_matches('it is the way of ' || other, '^.{{10,}}$')), n AS (SELECT s, CASE WHEN s = 'KAIKKI' THEN count(DISTINCT (word, d, number)) ELSE count(*) END AS senses FROM said GROUP BY s)
SELECT n.s AS source_code, senses, coalesce(x.examples, 0) AS examples, true AS done FROM n LEFT JOIN (SELECT s, count(*) AS examples FROM e GROUP BY s) x ON x.s IS NOT DISTINCT FROM n.s"""
SQL["sense_examples"] = f"WITH {_SAID} SELECT id AS dictionary_entry_parsed_id, 'It is the way of ' || other || '.' AS example FROM said WHERE i = 5"

_STRIPPED = _trim("regexp_replace(word, '^[(" + chr(92) + "[【].+?[)" + chr(92) + "]】]" + chr(92) + "s*', '')")
SQL["import_preprocess"] = f"""WITH e AS (SELECT DISTINCT dictionary_entry_id, {_STRIPPED} AS word FROM dictionary_entry), s AS (SELECT dictionary_entry_id, word, {_LANG.format('word')} AS language, {_SANITIZED} AS normalized_word FROM e)
SELECT * FROM s WHERE NOT {_blank('normalized_word')} AND NOT contains(normalized_word, ' ') AND NOT contains(normalized_word, chr(39))"""
SQL["validate_sources"] = f"""SELECT DISTINCT dictionary_entry_parsed_id, CASE WHEN {_blank('meaning_title')} THEN 'word missing' WHEN {_blank('definition')} THEN 'definition missing' WHEN source_code = 'ENG_OXFORD' AND coalesce(sense_number, 0) < 1 THEN 'no sense number'
  WHEN source_code = 'GUT_WEBSTER' AND length({_D}) <= 5 THEN 'definition too short' WHEN source_code = 'ENG_CHN' AND NOT regexp_matches({_D}, '[⬄一-鿿]') THEN 'not bilingual' ELSE 'ok' END AS reason FROM dictionary_entry_parsed"""
SQL["source_counts"] = f"""SELECT e.source_code, count(DISTINCT e.dictionary_entry_id) AS entries, count(DISTINCT p.dictionary_entry_id) AS parsed, count(DISTINCT e.dictionary_entry_id) - count(DISTINCT p.dictionary_entry_id) AS unparsed,
  count(DISTINCT p.dictionary_entry_parsed_id) AS senses FROM {ENTRIES} e LEFT JOIN dictionary_entry_parsed p USING (dictionary_entry_id) GROUP BY e.source_code"""
_PREVIEW, _MARKS = _trim("preview"), "regexp_replace(" + _trim("preview") + ", '" + chr(92) + "s', '', 'g')"
SQL["suggestion_candidates"] = rf"""SELECT query_id, mode, doc_id, CASE WHEN score >= 2.0 THEN 0.9 WHEN score >= 1.6 THEN 0.8 ELSE 0.7 END::DOUBLE AS confidence FROM ({SQL['suggestion_whole']})
WHERE length({_PREVIEW}) > 3 AND length({_PREVIEW}) <= CASE mode WHEN 'title' THEN 80 ELSE 300 END AND NOT regexp_matches({_PREVIEW}, '[\n\r\t]') AND NOT ends_with({_PREVIEW}, ':')
  AND (length({_MARKS}) - length(regexp_replace({_MARKS}, '\p{{Nd}}', '', 'g'))) / length({_MARKS}) < 0.2 AND (length({_MARKS}) - length(regexp_replace({_MARKS}, '[^\p{{L}}\p{{Nd}}]', '', 'g'))) / length({_MARKS}) < 0.35"""
SQL["grammar_chain"] = f"""WITH o AS (SELECT DISTINCT dictionary_entry_parsed_id AS id, definition AS before, {_trim(_OCR)} AS c FROM dictionary_entry_parsed WHERE NOT {_blank('definition')}), a AS (SELECT id, c, c AS t FROM o), {_balance('c')},
z AS (SELECT o.id, o.before, o.c AS one, CASE WHEN r.t <> r.c THEN {_trim('r.t')} ELSE r.c END AS two FROM o JOIN r USING (id))
SELECT id AS dictionary_entry_parsed_id, two AS after, CASE WHEN one <> before AND two <> one THEN 'scan,brackets' WHEN two <> one THEN 'brackets' ELSE 'scan' END AS engines,
  CASE WHEN one <> before AND two <> one THEN 80 WHEN two <> one THEN 70 ELSE 90 END AS confidence FROM z WHERE two <> before"""
_WORDS = r"list_filter(string_split_regex(lower(definition), '[^\p{L}\p{N}]+'), lambda w: w <> '')"
SQL["spell_split"] = rf"""
WITH d AS (SELECT DISTINCT meaning_title, {_WORDS} AS w FROM dictionary_entry_parsed WHERE definition IS NOT NULL), k AS MATERIALIZED (SELECT DISTINCT lower(word) AS word FROM (SELECT unnest(w) AS word FROM d UNION ALL SELECT normalized_word FROM canonical_word) WHERE length(word) > 3),
t AS (SELECT DISTINCT lower(regexp_replace(lower(meaning_title), '[^\p{{L}}\p{{N}}]', '', 'g') || coalesce(w[1], '')) AS token FROM d WHERE meaning_title IS NOT NULL), o AS (SELECT token FROM t WHERE length(token) >= 6 AND token NOT IN (SELECT word FROM k)),
x AS (SELECT token, unnest(range(2, length(token) - 1)) AS n FROM o), y AS (SELECT token, min(n) AS n FROM x WHERE substring(token, 1, n) IN (SELECT word FROM k) AND substring(token, n + 1) IN (SELECT word FROM k) GROUP BY token)
SELECT token, substring(token, 1, n) || ' ' || substring(token, n + 1) AS split FROM y"""
