"""The operators' results as DuckDB SQL, where SQL can express them.

Not here: language model (3), nearest neighbours (5, approximate), forests and rule
ensembles (6, 9), byte-pair merges (7, 8) and packing of token ids (13). Those are tested
against brute force, the public libraries or held-out labels.
"""

from __future__ import annotations

from millrace.llm.lexical_search import Search
from millrace.llm.mixing import Mix
from millrace.llm.quality_rules import MOST, RATIOS, REACH, UNIT
from millrace.llm.spelling import Spelling
from millrace.llm.url_filter import LISTED_HOSTS, RULES

_BLANKS = r"[\x20\x09-\x0D]"
_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
_MIX = Mix()
_LENGTH = _MIX.block_words

MIX_SOURCES = f"""
WITH sized AS (
  SELECT doc_id, source, CAST(len({_WORDS}) AS BIGINT) AS size,
         md5('{_MIX.seed}:' || coalesce(source, '-') || ':' || coalesce(CAST(doc_id AS VARCHAR), '-')) AS digest
  FROM documents),
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         row_number() OVER (ORDER BY source ASC NULLS LAST) - 1 AS place
  FROM sized GROUP BY source),
weighted AS (
  SELECT *, [{', '.join(map(str, _MIX.weights))}][1 + place % {len(_MIX.weights)}] AS weight,
         {_MIX.most_passes} * source_size AS most FROM sources),
filling AS (
  SELECT *, CAST({_MIX.share} * sum(source_size) OVER () - 100 * coalesce(sum(most) OVER filled, 0) AS DOUBLE) AS words_left,
         CAST(sum(weight) OVER () - coalesce(sum(weight) OVER filled, 0) AS DOUBLE) AS weights_left
  FROM weighted
  WINDOW filled AS (ORDER BY CAST(most AS DOUBLE) / weight, place
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
marked AS (
  SELECT *, CAST(most AS DOUBLE) * 100 * weights_left <= words_left * weight AS is_full FROM filling),
goals AS (
  SELECT source, source_size, CASE WHEN is_full THEN CAST(most AS DOUBLE) ELSE weight * (
    SELECT arg_min(words_left / (100 * weights_left), (CAST(most AS DOUBLE) / weight, place))
    FROM marked WHERE NOT is_full) END AS target
  FROM marked),
placed AS (
  SELECT *, CAST(sum(size) OVER (PARTITION BY source ORDER BY digest, size, row
                                 ROWS UNBOUNDED PRECEDING) AS BIGINT) - size AS start
  FROM (SELECT *, row_number() OVER () AS row FROM sized) WHERE size > 0),
blocks AS (
  SELECT source, source_size, block, CAST(round(target) AS BIGINT) AS words,
         row_number() OVER (PARTITION BY source ORDER BY md5('{_MIX.seed}:' || coalesce(source, '-') || ':' || block), block) - 1 AS position
  FROM goals, unnest(generate_series(0, (source_size - 1) // {_LENGTH})) AS b(block)
  WHERE source_size > 0),
run AS (
  SELECT *, least({_LENGTH}, source_size - block * {_LENGTH}) AS block_size,
         sum(least({_LENGTH}, source_size - block * {_LENGTH})) OVER (
           PARTITION BY source ORDER BY position ROWS UNBOUNDED PRECEDING)
         - least({_LENGTH}, source_size - block * {_LENGTH}) AS before
  FROM blocks),
slots AS (
  SELECT source, block, least(block_size, words - pass * source_size - before) AS take,
         CAST('0x' || substr(md5('{_MIX.seed}:' || coalesce(source, '-') || ':slot:'
           || (pass * ((source_size + {_LENGTH - 1}) // {_LENGTH}) + position)), 1, 8) AS BIGINT) % (
           SELECT CAST(ceil(sum(round(target)) / {_LENGTH * _MIX.shard_slots}) AS BIGINT)
           FROM goals WHERE source_size > 0) AS shard
  FROM run, unnest(range(0, {_MIX.most_passes} + 1)) AS p(pass)
  WHERE words - pass * source_size - before > 0),
taken AS (
  SELECT row, sum(greatest(0, least(start + size, block * {_LENGTH} + take)
                              - greatest(start, block * {_LENGTH}))) AS taken,
         count(DISTINCT shard) AS n_shards
  FROM placed JOIN slots ON placed.source IS NOT DISTINCT FROM slots.source
    AND start < block * {_LENGTH} + take AND start + size > block * {_LENGTH}
  GROUP BY row)
SELECT doc_id, size, source_size, target, CAST(coalesce(taken, 0) AS BIGINT) AS taken,
       CAST(coalesce(n_shards, 0) AS BIGINT) AS n_shards
FROM (SELECT *, row_number() OVER () AS row FROM sized) d
JOIN goals ON d.source IS NOT DISTINCT FROM goals.source
LEFT JOIN taken ON d.row = taken.row
"""

_RULE_FITS = " ".join(
    f"WHEN (host = '{host}' OR host LIKE '%.{host}') AND starts_with(path, '{path}') "
    f"THEN '{host}{path}'"
    for host, path, _ in sorted(RULES, key=lambda r: -len(r[0] + r[1])))
_RULE_SAYS = " ".join(f"WHEN rule = '{h}{p}' THEN '{v}'" for h, p, v in RULES)
_LISTED = " OR ".join(f"host = '{h}' OR host LIKE '%.{h}'" for h in LISTED_HOSTS)

URL_FILTERS = f"""
WITH parsed AS (
  SELECT page_id,
         translate(regexp_extract(coalesce(url, ''), '://([^/?#]*)', 1),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '://[^/?#]*([^?#]*)', 1) AS path
  FROM pages),
ruled AS (SELECT *, CASE {_RULE_FITS} END AS rule FROM parsed)
SELECT page_id, host, path, rule,
       CASE {_RULE_SAYS} WHEN {_LISTED} THEN 'block' ELSE 'allow' END AS verdict
FROM ruled
"""

_BUCKET = ("CAST({v} - {v} % CAST(pow(2, greatest(0, length(bin(CAST({v} AS BIGINT))) - 5)) "
           "AS BIGINT) AS BIGINT)")


def _ratio(a: str, b: str) -> str:
    return f"coalesce(1000 * {a} // nullif({b}, 0), 0)"


_PRIOR = 200

ADAPTIVE_QUALITY = f"""
WITH docs AS (
  SELECT row_number() OVER () AS row, doc_id, lang, source, coalesce(text, '') AS text FROM documents),
words AS (
  SELECT row, unnest(w) AS word, generate_subscripts(w, 1) AS place
  FROM (SELECT row, {_WORDS} AS w FROM docs)),
windows AS (
  SELECT row, place, lead(place, 7) OVER (PARTITION BY row ORDER BY place) AS last_place,
         array_agg(word) OVER (PARTITION BY row ORDER BY place ROWS BETWEEN CURRENT ROW AND 7 FOLLOWING) AS span
  FROM words),
twice AS (
  SELECT row, place FROM (
    SELECT row, place, count(*) OVER (PARTITION BY row, span) AS n FROM windows WHERE last_place IS NOT NULL)
  WHERE n > 1),
repeats AS (
  SELECT row, count(DISTINCT place + i) AS n FROM twice, unnest(range(0, 8)) AS r(i) GROUP BY row),
lines AS (
  SELECT row, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup
  FROM (SELECT row, unnest(string_split(text, chr(10))) AS line FROM docs)
  WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY row),
counts AS (
  SELECT doc_id, lang, source, CAST(len({_WORDS}) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(text, '{_BLANKS}', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(coalesce(n_dup, 0) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words,
         CAST(coalesce(n_lines, 0) AS BIGINT) AS n_lines,
         CAST(length(regexp_replace(text, '[^A-Z]', '', 'g')) AS BIGINT) AS n_upper
  FROM docs LEFT JOIN repeats USING (row) LEFT JOIN lines USING (row)),
ratios AS (
  {' UNION ALL '.join(
      f"SELECT lang, source, '{name}' AS ratio, {floor} AS least, "
      f"{_BUCKET.format(v=_ratio(a, b))} AS bucket FROM counts"
      for name, a, b, floor in RATIOS)}),
groups AS (
  SELECT 0 AS width, lang, source, * EXCLUDE (lang, source) FROM ratios
  UNION ALL SELECT 1, lang, NULL, * EXCLUDE (lang, source) FROM ratios
  UNION ALL SELECT 2, NULL, NULL, * EXCLUDE (lang, source) FROM ratios),
sketch AS (
  SELECT width, lang, source, ratio, least, bucket, count(*) AS n FROM groups
  GROUP BY width, lang, source, ratio, least, bucket),
w2 AS (SELECT ratio, least, bucket, CAST(n * {UNIT} AS BIGINT) AS weight FROM sketch WHERE width = 2),
s2 AS (
  SELECT *, CAST(floor({UNIT}.0::DOUBLE * weight / CAST(sum(weight) OVER (PARTITION BY ratio) AS DOUBLE)) AS BIGINT) AS share
  FROM w2),
w1 AS (
  SELECT lang, ratio, least, bucket, CAST(sum(weight) AS BIGINT) AS weight FROM (
    SELECT lang, ratio, least, bucket, n * {UNIT} AS weight FROM sketch WHERE width = 1
    UNION ALL SELECT lang, ratio, least, bucket, {_PRIOR} * share
    FROM (SELECT DISTINCT lang, ratio FROM sketch WHERE width = 1) JOIN s2 USING (ratio))
  GROUP BY lang, ratio, least, bucket),
s1 AS (
  SELECT *, CAST(floor({UNIT}.0::DOUBLE * weight / CAST(sum(weight) OVER (PARTITION BY lang, ratio) AS DOUBLE)) AS BIGINT) AS share
  FROM w1),
w0 AS (
  SELECT lang, source, ratio, least, bucket, CAST(sum(weight) AS BIGINT) AS weight FROM (
    SELECT lang, source, ratio, least, bucket, n * {UNIT} AS weight FROM sketch WHERE width = 0
    UNION ALL SELECT g.lang, g.source, g.ratio, s1.least, s1.bucket, {_PRIOR} * share
    FROM (SELECT DISTINCT lang, source, ratio FROM sketch WHERE width = 0) g
    JOIN s1 ON g.lang IS NOT DISTINCT FROM s1.lang AND g.ratio = s1.ratio)
  GROUP BY lang, source, ratio, least, bucket),
weights AS (
  SELECT 0 AS width, * FROM w0 UNION ALL SELECT 1, lang, NULL, * EXCLUDE (lang) FROM w1
  UNION ALL SELECT 2, NULL, NULL, * FROM w2),
running AS (
  SELECT *, sum(weight) OVER (PARTITION BY width, lang, source, ratio ORDER BY bucket) AS seen,
         sum(weight) OVER (PARTITION BY width, lang, source, ratio) AS whole FROM weights),
quartiles AS (
  SELECT width, lang, source, ratio, least, min(bucket) FILTER (WHERE seen * 4 >= whole) AS q1,
         min(bucket) FILTER (WHERE seen * 2 >= whole) AS q2
  FROM running GROUP BY width, lang, source, ratio, least),
upper AS (
  SELECT *, greatest(q2 + {REACH} * (q2 - q1), q2 + least) AS fence FROM quartiles),
languages AS (
  SELECT l.lang, l.ratio, least(l.fence, {MOST} * a.fence) AS fence
  FROM upper l JOIN upper a ON l.ratio = a.ratio AND l.width = 1 AND a.width = 2),
fences AS (
  SELECT g.lang, g.source, g.ratio, least(g.fence, {MOST} * l.fence) AS fence
  FROM upper g JOIN languages l ON g.ratio = l.ratio AND g.lang IS NOT DISTINCT FROM l.lang
  WHERE g.width = 0),
judged AS (
  SELECT counts.*, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
         {' AND '.join(
             f"{_BUCKET.format(v=_ratio(a, b))} <= (SELECT fence FROM fences f WHERE ratio = '{name}' "
             f"AND f.lang IS NOT DISTINCT FROM counts.lang AND f.source IS NOT DISTINCT FROM counts.source)"
             for name, a, b, _ in RATIOS)} AS within
  FROM counts)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_upper,
       base_failed, NOT base_failed AND within AS kept
FROM judged
"""

NEAR_DUPLICATES = r"""
WITH RECURSIVE docs AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + 2], ' ') AS shingle
  FROM docs, unnest(range(1, greatest(2, len(w) - 1))) AS r(i) WHERE len(w) > 0),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
  FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * shared.n >= 85 * (x.n + y.n - shared.n)),
both_ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM docs UNION
  SELECT reach.doc_id, both_ways.b FROM reach JOIN both_ways ON reach.other = both_ways.a),
least AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT docs.doc_id, coalesce(sizes.n, 0) AS n_shingles, component_id,
       docs.doc_id = component_id AS kept
FROM docs JOIN least ON docs.doc_id = least.doc_id LEFT JOIN sizes ON sizes.doc_id = docs.doc_id
"""

_LOWER = ("translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
          "'abcdefghijklmnopqrstuvwxyz')")
_SPELLING = Spelling()

#: crc32 bit by bit, over the UTF-8 bytes of a text.
SPELLING_VARIANTS = rf"""
WITH RECURSIVE found AS (
  SELECT doc_id, unnest(regexp_extract_all({_LOWER}, '[A-Za-zÀ-ÿ]{{{_SPELLING.least_length},}}')) AS run
  FROM documents),
runs AS (SELECT doc_id, run, count(*) AS times FROM found GROUP BY ALL),
coded AS (SELECT *, hex(encode(concat(doc_id, ':', run))) AS code FROM runs),
bits AS (
  SELECT doc_id, run, times, list_transform(range(len(code) * 4), lambda k:
    ((instr('0123456789ABCDEF', substr(code, 2 * (k // 8) + CASE WHEN k % 8 < 4 THEN 2 ELSE 1 END, 1)) - 1)
     >> (k % 4)) & 1) AS b
  FROM coded),
hashed AS (
  SELECT run, times, xor(4294967295, list_reduce(b, lambda crc, bit:
    xor(crc >> 1, 3988292384 * (xor(crc, bit) & 1)), CAST(4294967295 AS BIGINT))) AS h
  FROM bits),
spelt AS (
  SELECT times, CASE WHEN h % {_SPELLING.misspelt} = 0
    THEN substr(run, 1, CAST(h % length(run) AS BIGINT)) || substr(run, CAST(h % length(run) AS BIGINT) + 2)
    ELSE run END AS word
  FROM hashed),
words AS (
  SELECT word, CAST(sum(times) AS BIGINT) AS n FROM spelt WHERE length(word) >= {_SPELLING.least_length}
  GROUP BY word HAVING sum(times) >= {_SPELLING.least_count}),
shorter AS (
  SELECT word, n, p, substr(word, 1, p) || substr(word, p + 2) AS rest
  FROM (SELECT word, n, unnest(range(length(word))) AS p FROM words)),
pairs AS (
  SELECT a.word, b.word AS other, b.n AS m FROM shorter a JOIN shorter b
  ON a.rest = b.rest AND a.p = b.p AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM shorter a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM shorter a JOIN words b ON a.rest = b.word),
near AS (
  SELECT word, count(*) AS n_near, max(m) AS most, arg_min(other, (-m, other)) AS other
  FROM pairs GROUP BY word),
judged AS (
  SELECT words.word, n, CAST(coalesce(n_near, 0) AS BIGINT) AS n_near,
         CASE WHEN most >= {_SPELLING.factor} * n THEN other END AS form,
         CASE WHEN most >= {_SPELLING.factor} * n THEN most END AS form_n
  FROM words LEFT JOIN near ON words.word = near.word),
walk(word, stop) AS (
  SELECT word, word FROM judged
  UNION ALL SELECT walk.word, judged.form FROM walk JOIN judged ON walk.stop = judged.word
  WHERE judged.form IS NOT NULL)
SELECT j.word, j.form, w.stop AS root, j.n, j.n_near, j.form_n
FROM judged j JOIN walk w ON w.word = j.word JOIN judged e ON e.word = w.stop AND e.form IS NULL
"""

_TERMS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

LEXICAL_SEARCH = f"""
WITH docs AS (SELECT row_number() OVER () AS row, doc_id, {_TERMS} AS terms FROM documents),
held AS (SELECT *, len(terms) AS n FROM docs WHERE len(terms) > 0),
stats AS (SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_terms FROM held),
asked AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark),
counted AS (
  SELECT row, term, count(*) AS tf FROM (SELECT row, unnest(terms) AS term FROM held)
  WHERE term IN (SELECT term FROM asked) GROUP BY row, term),
weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM counted, stats GROUP BY term, n_docs),
gains AS (
  SELECT row, doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * n_docs) // n_terms))) AS gain
  FROM counted JOIN held USING (row) JOIN weights USING (term), stats),
scores AS (
  SELECT item_id, row, doc_id, CAST(sum(gain) AS BIGINT) AS score
  FROM asked JOIN gains USING (term) GROUP BY item_id, row, doc_id),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank
  FROM scores WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= {Search().top}
"""

ORACLE = {
    "op1_mix_sources": MIX_SOURCES,
    "op2_url_filters": URL_FILTERS,
    "op4_adaptive_quality": ADAPTIVE_QUALITY,
    "op10_near_duplicates": NEAR_DUPLICATES,
    "op11_spelling_variants": SPELLING_VARIANTS,
    "op12_lexical_search": LEXICAL_SEARCH,
}
