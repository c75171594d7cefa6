"""DuckDB SQL of the registered queries that SQL can express."""

from __future__ import annotations

import string

from roadevents.llm import licenses

LOW = f"translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}')"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _list(words) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


def license_scan() -> str:
    phrases = ", ".join(
        f"('{label}', {_list(p.split())}, {len(p.split())})"
        for label, p in licenses.PHRASES.items()
    )
    templates = ", ".join(
        f"({n}, '{label}', {_list(tokens)}, {need})"
        for n, (label, tokens, need) in enumerate(
            licenses._templates(licenses.TEMPLATES, licenses.THRESHOLD)
        )
    )
    return f"""
WITH rows AS (SELECT row_number() OVER () AS r, doc_id, {LOW} AS text FROM documents),
docs AS (SELECT r, doc_id, text, regexp_extract_all(text, '{WORD}') AS w FROM rows),
phrases(label, parts, n) AS (VALUES {phrases}),
templates(number, label, tokens, need) AS (VALUES {templates}),
places AS (
  SELECT r, label, unnest(list_filter(range(len(w)), lambda i: w[i + 1:i + n] = parts)) AS start
  FROM docs CROSS JOIN phrases WHERE contains(text, 'license')),
base AS (
  SELECT r, count(*) AS n_base, min(start) AS first_word, max(start) AS last_word,
         string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels
  FROM places GROUP BY r),
blocks AS (
  SELECT r, list_distinct(regexp_extract_all(unnest(string_split(text, chr(10))), '{WORD}')) AS own
  FROM docs),
hits AS (
  SELECT r, label, len(list_intersect(own, tokens)) AS hit, len(tokens) AS n
  FROM blocks CROSS JOIN templates
  WHERE len(own) >= need AND len(list_intersect(own, tokens)) >= need),
shares AS (SELECT r, max(hit / n) AS share FROM hits GROUP BY r),
labels AS (
  SELECT r, string_agg(DISTINCT label, ',' ORDER BY label) AS labels
  FROM (SELECT r, label FROM hits UNION ALL SELECT r, label FROM places) GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(share, 0.0)::DOUBLE END AS score
FROM docs LEFT JOIN base USING (r) LEFT JOIN shares USING (r) LEFT JOIN labels USING (r)
"""


CONTROL = r"([<\[])(\\*)(/?(?:s>|INST\]|ROLE\]))"

CHAT_FORMATTING = rf"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations
  UNION ALL
  SELECT -7, turn, role, '</s>[INST] ok [/INST]'
  FROM (VALUES (0, 'user'), (1, 'assistant')) v(turn, role)),
marked AS (
  SELECT *, bool_or(regexp_matches(role || ' ' || text, '{CONTROL}'))
              OVER (PARTITION BY conv_id) AS escaped
  FROM turns),
shown AS (
  SELECT *,
    CASE WHEN escaped THEN regexp_replace(role, '{CONTROL}', '\1\\\2\3', 'g') ELSE role END AS er,
    CASE WHEN escaped THEN regexp_replace(text, '{CONTROL}', '\1\\\2\3', 'g') ELSE text END AS et
  FROM marked),
formatted AS (
  SELECT *, CASE role WHEN 'user' THEN '<s>[INST]' || et || '[/INST]'
                      WHEN 'assistant' THEN '<s>' || et || '</s>'
                      ELSE '<s>[ROLE]' || er || '[/ROLE]' || et || '</s>' END AS f
  FROM shown),
joined AS (
  SELECT conv_id, count(*) AS n_turns,
    string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS lines,
    coalesce(string_agg(text, '' ORDER BY turn, role, text)
      FILTER (WHERE role = 'assistant'), '') AS loss,
    sum(length(f))::BIGINT AS formatted_chars
  FROM formatted GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(lines) AS turns_sha256, length(loss) AS loss_chars,
       sha256(loss) AS loss_sha256, formatted_chars
FROM joined
"""

# Strings of 100 bytes as 200 hexadecimal digits; a removed stretch is an island of
# repeated starts no more than 100 bytes apart.
SUFFIX_DEDUP = """
WITH docs AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
starts AS (
  SELECT doc_id, md5_number(substr(h, 2 * s + 1, 200)) AS string, s
  FROM (SELECT doc_id, h, unnest(range(0, length(h) // 2 - 99)) AS s FROM docs)),
ranked AS (
  SELECT doc_id, s, row_number() OVER (PARTITION BY string ORDER BY doc_id, s) AS n
  FROM starts),
marked AS (
  SELECT doc_id, s, CASE WHEN s - lag(s) OVER w <= 100 THEN 0 ELSE 1 END AS turn
  FROM ranked WHERE n > 1 WINDOW w AS (PARTITION BY doc_id ORDER BY s)),
islands AS (
  SELECT doc_id, min(s) AS a, max(s) + 100 AS z
  FROM (SELECT *, sum(turn) OVER (PARTITION BY doc_id ORDER BY s) AS island FROM marked)
  GROUP BY doc_id, island),
gaps AS (
  SELECT doc_id, coalesce(lag(z) OVER w, 0) AS a, a AS z
  FROM islands WINDOW w AS (PARTITION BY doc_id ORDER BY a)
  UNION ALL
  SELECT doc_id, coalesce(max(z), 0), length(any_value(h)) // 2
  FROM docs LEFT JOIN islands USING (doc_id) GROUP BY doc_id),
kept AS (
  SELECT doc_id, string_agg(substr(h, 2 * gaps.a + 1, 2 * (gaps.z - gaps.a)), '' ORDER BY gaps.a) AS k
  FROM gaps JOIN docs USING (doc_id) GROUP BY doc_id),
sums AS (
  SELECT doc_id, sum(z - a)::BIGINT AS n_removed, count(*) AS n_spans FROM islands GROUP BY doc_id)
SELECT doc_id, length(h) // 2 AS n_bytes, coalesce(n_removed, 0) AS n_removed,
       coalesce(n_spans, 0) AS n_spans, sha256(unhex(k)) AS kept_sha256
FROM docs JOIN kept USING (doc_id) LEFT JOIN sums USING (doc_id)
"""

NEAR_DUPLICATES = rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all({LOW}, '[^\x20\x09-\x0D]+') AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i + 1:i + least(5, len(w))], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(greatest(len(w) - 4, 1))) AS i FROM words WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common
  FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM shared JOIN sizes p ON a = p.doc_id JOIN sizes q ON b = q.doc_id
  WHERE 100 * common >= 80 * (p.n + q.n - common)),
reach(a, b) AS (
  SELECT doc_id, doc_id FROM documents
  UNION
  SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id
FROM (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
LEFT JOIN sizes USING (doc_id)
"""

# The fences' slack and sides are those of quality.RULES.
QUALITY_RULES = r"""
WITH rows AS (
  SELECT row_number() OVER () AS r, doc_id, lang, source, coalesce(text, '') AS text FROM documents),
words AS (
  SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM rows),
runs AS (
  SELECT r, i, w[i:i + 2] AS run FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM words)),
twins AS (SELECT r, i FROM runs QUALIFY count(*) OVER (PARTITION BY r, run) > 1),
spans AS (
  SELECT r, least(coalesce(lead(i) OVER (PARTITION BY r ORDER BY i) - i, 3), 3) AS width FROM twins),
repeated AS (SELECT r, sum(width)::BIGINT AS n FROM spans GROUP BY r),
measured AS (
  SELECT r, doc_id, lang, source, len(w) AS n_words,
         length(array_to_string(w, '')) AS word_chars,
         length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
         coalesce(n, 0) AS n_repeat_words
  FROM words LEFT JOIN repeated USING (r)),
based AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM measured),
shares AS (
  SELECT r, lang, source, base_failed, unnest([
    {'rule': 'symbols', 'v': CASE WHEN n_words > 0 THEN 1000 * n_symbols // n_words ELSE 0 END},
    {'rule': 'word_length', 'v': CASE WHEN n_words > 0 THEN 1000 * word_chars // n_words ELSE 0 END},
    {'rule': 'dup_lines', 'v': CASE WHEN n_lines > 0 THEN 1000 * n_dup_lines // n_lines ELSE 0 END},
    {'rule': 'repeats', 'v': CASE WHEN n_words > 0 THEN 1000 * n_repeat_words // n_words ELSE 0 END}
  ], recursive := true)
  FROM based),
bucketed AS (
  SELECT lang, source, rule, (v >> greatest(length(bin(v)) - 6, 0)) << greatest(length(bin(v)) - 6, 0) AS bucket
  FROM shares WHERE NOT base_failed),
levels AS (
  SELECT 1 AS level, lang, source, rule, bucket FROM bucketed
  UNION ALL SELECT 2, lang, NULL, rule, bucket FROM bucketed
  UNION ALL SELECT 3, NULL, NULL, rule, bucket FROM bucketed),
ordered AS (
  SELECT *, row_number() OVER (PARTITION BY level, lang, source, rule ORDER BY bucket) AS k,
         count(*) OVER (PARTITION BY level, lang, source, rule) AS texts
  FROM levels),
quartiles AS (
  SELECT level, lang, source, rule, max(texts) AS texts,
         min(bucket) FILTER (4 * k >= texts) AS q1, min(bucket) FILTER (4 * k >= 3 * texts) AS q3
  FROM ordered GROUP BY ALL),
slack(rule, low, high) AS (
  VALUES ('symbols', NULL, 100), ('word_length', 2000, 2000), ('dup_lines', NULL, 500), ('repeats', NULL, 300)),
fences AS (
  SELECT level, lang, source, rule, texts, q1 - greatest(3 * (q3 - q1), low) AS least,
         q3 + greatest(3 * (q3 - q1), high) AS most, low, high
  FROM quartiles JOIN slack USING (rule)),
judged AS (
  SELECT s.r, s.rule, f.level,
         (f.low IS NOT NULL AND s.v < f.least) OR (f.high IS NOT NULL AND s.v > f.most) AS broken
  FROM shares s JOIN fences f ON s.rule = f.rule AND (
    f.level = 3 OR (f.texts >= 200 AND f.lang IS NOT DISTINCT FROM s.lang
                    AND (f.level = 2 OR f.source IS NOT DISTINCT FROM s.source)))
  QUALIFY f.level = min(f.level) OVER (PARTITION BY s.r, s.rule)),
verdicts AS (
  SELECT r, string_agg(rule, ',' ORDER BY CASE rule WHEN 'symbols' THEN 1 WHEN 'word_length' THEN 2
                       WHEN 'dup_lines' THEN 3 ELSE 4 END) FILTER (broken) AS broken
  FROM judged GROUP BY r)
SELECT doc_id, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND broken IS NULL AS kept, coalesce(broken, '') AS broken
FROM based LEFT JOIN verdicts USING (r)
"""


def _sized(*values: str) -> str:
    """The hash of values one after another: ``-`` for null, else size, colon, value."""
    parts = [f"coalesce(strlen({v}::VARCHAR) || ':' || {v}::VARCHAR, '-')" for v in values]
    return f"sha256({' || '.join(parts)})"


_ROW = ("doc_id", "source", "lang", "n_chars")
_LOWER = f"translate(text, '{string.ascii_uppercase}', '{string.ascii_lowercase}')"

# CRC-32 is worked out bit by bit: SQL has no function for it.
MERKLE_MANIFEST = f"""
WITH RECURSIVE crc AS (
  SELECT doc_id, xor(4294967295, list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(range(strlen(doc_id::VARCHAR)),
                 lambda i: ascii(substr(doc_id::VARCHAR, i + 1, 1))::BIGINT)),
    lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)),
                             lambda x, i: xor(x >> 1, (x & 1) * 3988292384)))) AS crc
  FROM (SELECT DISTINCT doc_id FROM documents WHERE doc_id IS NOT NULL)),
leaves AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce('=' || lang, '') AS g,
         {_sized(*_ROW, 'text')} AS leaf,
         CASE WHEN crc % 3 = 0 THEN {_sized(*_ROW, _LOWER)} ELSE {_sized(*_ROW, 'text')} END AS found
  FROM documents LEFT JOIN crc USING (doc_id)),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf, r) - 1 AS p,
         count(*) OVER (PARTITION BY g) AS n
  FROM leaves),
tree(g, level, n, p, h) AS (
  SELECT g, 0, n, p, leaf FROM placed
  UNION ALL
  SELECT g, level + 1, (n + 7) // 8, p // 8, sha256(string_agg(h, '' ORDER BY p))
  FROM tree WHERE n > 1 GROUP BY g, level, n, p // 8),
subroots AS (
  SELECT g, h AS subroot, row_number() OVER (ORDER BY g) - 1 AS p, count(*) OVER () AS n
  FROM tree WHERE n = 1),
top(level, n, p, h) AS (
  SELECT 0, n, p, subroot FROM subroots
  UNION ALL
  SELECT level + 1, (n + 7) // 8, p // 8, sha256(string_agg(h, '' ORDER BY p))
  FROM top WHERE n > 1 GROUP BY level, n, p // 8),
runs AS (
  SELECT g, level, p // 8 AS run, list(h ORDER BY p) AS hs
  FROM tree WHERE n > 1 GROUP BY g, level, p // 8),
top_runs AS (
  SELECT level, p // 8 AS run, list(h ORDER BY p) AS hs FROM top WHERE n > 1 GROUP BY level, p // 8),
steps AS (
  SELECT r, level AS step, hs, (placed.p >> (3 * level)) & 7 AS slot
  FROM placed JOIN runs ON placed.g = runs.g AND run = placed.p >> (3 * level + 3)
  UNION ALL
  SELECT r, 100 + level, hs, (s.p >> (3 * level)) & 7
  FROM placed JOIN subroots s ON placed.g = s.g JOIN top_runs ON run = s.p >> (3 * level + 3)),
path AS (
  SELECT r, row_number() OVER (PARTITION BY r ORDER BY step) AS k,
         array_to_string(hs[1:slot], '') AS before, array_to_string(hs[slot + 2:], '') AS after
  FROM steps),
fold(r, k, h) AS (
  SELECT r, 0, found FROM placed
  UNION ALL
  SELECT fold.r, fold.k + 1, sha256(before || h || after)
  FROM fold JOIN path ON path.r = fold.r AND path.k = fold.k + 1),
folded AS (SELECT r, arg_max(h, k) AS folded_root FROM fold GROUP BY r),
proofs AS (SELECT r, sha256(string_agg(before || after, '' ORDER BY k)) AS proof FROM path GROUP BY r)
SELECT doc_id, leaf, subroot, root, coalesce(proof, sha256('')) AS proof_sha256, folded_root,
       folded_root = root AS verified
FROM placed JOIN subroots USING (g) JOIN folded USING (r) LEFT JOIN proofs USING (r)
     JOIN (SELECT h AS root FROM top WHERE n = 1) ON true
"""


PHRASE_COLLOCATIONS = rf"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array({LOW}, '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
words AS (
  SELECT row_number() OVER () AS r, lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM words GROUP BY lang),
grams AS (
  SELECT lang, size, array_to_string(w[i:i + size - 1], ' ') AS phrase
  FROM (SELECT lang, w, size, unnest(range(1, len(w) - size + 2)) AS i
        FROM words CROSS JOIN range(1, 6) s(size) WHERE len(w) >= size)),
counts AS (SELECT lang, size, phrase, count(*) AS a FROM grams GROUP BY ALL HAVING count(*) >= 100),
cuts AS (
  SELECT c.lang, c.size, c.phrase, c.a, k, l.a AS l, r.a AS r, n,
         1000 * c.a::HUGEINT * n // (l.a::HUGEINT * r.a) AS score
  FROM (SELECT *, string_split(phrase, ' ') AS w, unnest(range(1, size)) AS k
        FROM counts WHERE size > 1) c
  JOIN counts l ON l.lang = c.lang AND l.phrase = array_to_string(w[1:k], ' ')
  JOIN counts r ON r.lang = c.lang AND r.phrase = array_to_string(w[k + 1:], ' ')
  JOIN totals t ON t.lang = c.lang),
weakest AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inner_phrases AS (
  SELECT DISTINCT c.lang, array_to_string(string_split(c.phrase, ' ')[i:i + m - 1], ' ') AS phrase, c.a
  FROM counts c, range(2, 5) m(m), range(1, 5) i(i) WHERE m < c.size AND i + m - 1 <= c.size),
held AS (SELECT lang, phrase, max(a) AS longer FROM inner_phrases GROUP BY ALL),
kept AS (
  SELECT w.* FROM weakest w LEFT JOIN held h ON h.lang = w.lang AND h.phrase = w.phrase
  WHERE h.longer IS NULL OR 100 * h.longer < 100 * w.a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
       phrase, a, l, r, n, score::BIGINT AS score
FROM kept QUALIFY rank <= 2000
"""
