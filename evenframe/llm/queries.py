"""Registered queries of the operators, each over its whole table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .chat import preference_digests, preference_segments, shortened_answers
from .common import LOWER, UPPER
from .exact_dedup import exact_dedup
from .fingerprints import document_fingerprints
from .language import language_id
from .line_dedup import BLANKS, line_dedup
from .packing import pack
from .pieces import encode
from .quality import BITS, FENCE, LEAST_GROUP, METRICS, MIN_WORDS, MOST_REPEATED_PERCENT, SYMBOLS, quality_rules
from .shingle_join import shingle_components
from .suffix_dedup import suffix_dedup
from .token_links import token_links
from .toxicity import fit, toxicity
from .variants import spelling_variants


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def op1_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return language_id(documents(spark, folder))


def op2_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup(documents(spark, folder))


def op3_pack(spark: SparkSession, folder: str) -> DataFrame:
    return pack(documents(spark, folder))


def op4_preferences(spark: SparkSession, folder: str) -> DataFrame:
    """Every conversation against one whose last answer is cut to its first line."""
    chosen = spark.read.parquet(f"{folder}/conversations.parquet")
    return preference_digests(preference_segments(chosen, shortened_answers(chosen)))


def op5_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    return toxicity(docs, fit(docs, spark.read.parquet(f"{folder}/labels.parquet")))


def op6_shingle_join(spark: SparkSession, folder: str) -> DataFrame:
    return shingle_components(documents(spark, folder))


def op7_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    return encode(documents(spark, folder), digests=True)


def op8_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return line_dedup(documents(spark, folder))


def op9_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_dedup(documents(spark, folder))


def op10_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules(documents(spark, folder))


def op11_token_links(spark: SparkSession, folder: str) -> DataFrame:
    return token_links(documents(spark, folder))


def op12_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return document_fingerprints(documents(spark, folder))


def op13_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling_variants(documents(spark, folder))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language_id": op1_language_id,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_pack": op3_pack,
    "op4_preferences": op4_preferences,
    "op5_toxicity": op5_toxicity,
    "op6_shingle_join": op6_shingle_join,
    "op7_sentencepiece": op7_sentencepiece,
    "op8_line_dedup": op8_line_dedup,
    "op9_suffix_dedup": op9_suffix_dedup,
    "op10_quality_rules": op10_quality_rules,
    "op11_token_links": op11_token_links,
    "op12_fingerprints": op12_fingerprints,
    "op13_spelling_variants": op13_spelling_variants,
}

CONTENT = f"translate(coalesce(text, ''), '{UPPER}', '{LOWER}')"

EXACT_DEDUP_SQL = f"""
WITH classes AS (
  SELECT {CONTENT} AS content, max(doc_id) AS keep_id, count(*) AS group_size
  FROM documents GROUP BY 1)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(content) AS text_sha256
FROM documents JOIN classes ON {CONTENT} = content
"""

_BLANKS = " || ".join(f"chr({ord(c)})" for c in BLANKS)
LINE_DEDUP_SQL = f"""
WITH split AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
lines AS (
  SELECT doc_id, unnest(parts) AS line, generate_subscripts(parts, 1) AS pos FROM split),
keyed AS (
  SELECT *, translate(trim(line, {_BLANKS}), '{UPPER}', '{LOWER}') AS key FROM lines),
hot AS (
  SELECT key, max(doc_id) AS top FROM keyed WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
judged AS (
  SELECT doc_id, line, pos, top IS NOT NULL AND doc_id < top AS dropped
  FROM keyed LEFT JOIN hot USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""


def _metric_sql(name: str) -> str:
    return METRICS[name][0].replace(" div ", " // ")


def _quartile_sql(keys: str, rows: str) -> str:
    over = f"PARTITION BY {keys}metric"
    return f"""
  SELECT {keys}metric, any_value(total) AS total,
         min(bucket) FILTER (4 * seen >= total) AS q1, min(bucket) FILTER (4 * seen >= 3 * total) AS q3
  FROM (SELECT *, sum(n) OVER ({over} ORDER BY bucket) AS seen, sum(n) OVER ({over}) AS total
        FROM (SELECT {keys}metric, bucket, sum(n) AS n FROM {rows} GROUP BY ALL))
  GROUP BY {keys}metric"""


QUALITY_SQL = f"""
WITH base AS (
  SELECT doc_id, lang, source, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words,
         [x FOR x IN string_split(coalesce(text, ''), chr(10))
          IF regexp_matches(x, '[^\\x20\\x09-\\x0D]')] AS lines
  FROM documents),
placed AS (
  SELECT doc_id, unnest(words) AS w, generate_subscripts(words, 1) AS i FROM base),
windows AS (
  SELECT doc_id, i, w AS a, lead(w, 1) OVER o AS b, lead(w, 2) OVER o AS c
  FROM placed WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
twice AS (
  SELECT doc_id, i FROM (
    SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, a, b, c) AS n FROM windows WHERE c IS NOT NULL)
  WHERE n > 1),
repeats AS (
  SELECT doc_id, count(DISTINCT i + d) AS n_repeat_words
  FROM twice, (SELECT unnest([0, 1, 2]) AS d) GROUP BY doc_id),
stats AS (
  SELECT doc_id, lang, source, CAST(len(words) AS BIGINT) AS n_words,
         CAST(length(list_aggregate(words, 'string_agg', '')) AS BIGINT) AS chars,
         CAST(length(text) - length(translate(text, '{SYMBOLS}', '')) AS BIGINT) AS n_symbols,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         CAST(len(lines) AS BIGINT) AS n_lines
  FROM base),
counted AS (
  SELECT s.* EXCLUDE (chars), coalesce(chars, 0) AS word_chars, coalesce(n_repeat_words, 0) AS n_repeat_words
  FROM stats s LEFT JOIN repeats USING (doc_id)),
measured AS (
  {" UNION ALL ".join(f"SELECT lang, source, '{n}' AS metric, {s} AS slack, {_metric_sql(n)} AS value FROM counted WHERE n_words > 0" for n, (_, s) in METRICS.items())}),
sketch AS (
  SELECT lang, source, metric, (value >> cut) << cut AS bucket, count(*) AS n
  FROM (SELECT *, greatest(0, CAST(length(bin(value)) AS INT) - {BITS}) AS cut FROM measured)
  GROUP BY ALL),
fine AS ({_quartile_sql("lang, source, ", "sketch")}),
by_lang AS ({_quartile_sql("lang, ", "sketch")}),
by_all AS ({_quartile_sql("", "sketch")}),
slacks AS (SELECT DISTINCT metric, slack FROM measured),
used AS (
  SELECT f.lang, f.source, f.metric, slack,
         CASE WHEN f.total >= {LEAST_GROUP} THEN f.q1 WHEN l.total >= {LEAST_GROUP} THEN l.q1 ELSE a.q1 END AS q1,
         CASE WHEN f.total >= {LEAST_GROUP} THEN f.q3 WHEN l.total >= {LEAST_GROUP} THEN l.q3 ELSE a.q3 END AS q3
  FROM fine f JOIN by_lang l ON f.lang IS NOT DISTINCT FROM l.lang AND f.metric = l.metric
  JOIN by_all a ON f.metric = a.metric JOIN slacks s ON f.metric = s.metric),
limits AS (
  SELECT lang, source, metric, q1 - greatest({FENCE} * (q3 - q1), slack) AS low,
         q3 + greatest({FENCE} * (q3 - q1), slack) AS high FROM used),
wide AS (
  SELECT lang, source, min(low) FILTER (metric = 'word_length') AS low_word_length,
         {", ".join(f"min(high) FILTER (metric = '{n}') AS high_{n}" for n in METRICS)}
  FROM limits GROUP BY lang, source)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND coalesce({" AND ".join(f"{_metric_sql(n)} <= high_{n}" for n in METRICS)}
         AND {_metric_sql("word_length")} >= low_word_length, false) AS kept
FROM (SELECT c.*, w.* EXCLUDE (lang, source),
             n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED_PERCENT} * n_words AS base_failed
      FROM counted c LEFT JOIN wide w ON c.lang IS NOT DISTINCT FROM w.lang AND c.source IS NOT DISTINCT FROM w.source)
"""

PREFERENCES_SQL = """
WITH given AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations),
last AS (
  SELECT conv_id AS conv_2, max(turn) AS last_turn FROM conversations WHERE role = 'assistant' GROUP BY 1),
cut AS (
  SELECT conv_id, turn, role,
         CASE WHEN turn = last_turn AND role = 'assistant' THEN split_part(text, chr(10), 1) ELSE text END AS text
  FROM given LEFT JOIN last ON conv_id = conv_2),
chosen AS (SELECT DISTINCT * FROM given), rejected AS (SELECT DISTINCT * FROM cut),
differing AS (
  (SELECT * FROM chosen EXCEPT SELECT * FROM rejected) UNION ALL
  (SELECT * FROM rejected EXCEPT SELECT * FROM chosen)),
breaks AS (SELECT conv_id, min(turn) AS first_difference FROM differing GROUP BY conv_id),
parts AS (
  SELECT CASE WHEN turn >= first_difference THEN 'chosen' ELSE 'prompt' END AS part, c.*
  FROM chosen c LEFT JOIN breaks USING (conv_id)
  UNION ALL
  SELECT 'rejected', r.* FROM rejected r JOIN breaks USING (conv_id)
  WHERE turn >= first_difference),
rendered AS (
  SELECT *, '<|' || replace(role, '<|', '< |') || '|>' || chr(10) AS header,
         replace(text, '<|', '< |') || '<|end|>' || chr(10) AS body FROM parts)
SELECT conv_id, part, turn, role, part <> 'prompt' AND role = 'assistant' AS learn,
       length(header) AS header_chars, length(body) AS body_chars, sha256(header || body) AS sha256
FROM rendered
"""

SHINGLE_JOIN_SQL = f"""
WITH RECURSIVE base AS (
  SELECT doc_id, regexp_extract_all({CONTENT}, '[^\\x20\\x09-\\x0D]+') AS words FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(words) = 0 THEN []
                      WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
                      ELSE list_distinct([array_to_string(words[i:i+4], ' ') FOR i IN range(1, len(words) - 3)])
                 END AS s
  FROM base),
sized AS (SELECT doc_id, s, CAST(len(s) AS BIGINT) AS n FROM sets),
items AS (SELECT doc_id, n, unnest(s) AS x FROM sized),
pairs AS (
  SELECT a.doc_id AS u, b.doc_id AS v, any_value(a.n) AS n, any_value(b.n) AS m, count(*) AS both_have
  FROM items a JOIN items b ON a.x = b.x AND a.doc_id < b.doc_id
  GROUP BY 1, 2),
links AS (SELECT u, v FROM pairs WHERE 100 * both_have >= 80 * (n + m - both_have)),
edges AS (SELECT u, v FROM links UNION ALL SELECT v, u FROM links),
reach AS (
  SELECT doc_id AS u, doc_id AS v FROM documents
  UNION SELECT r.u, e.v FROM reach r JOIN edges e ON r.v = e.u)
SELECT s.doc_id, s.n AS n_shingles, c.component_id
FROM sized s JOIN (SELECT u, min(v) AS component_id FROM reach GROUP BY u) c ON s.doc_id = c.u
"""

SUFFIX_DEDUP_SQL = """
WITH base AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
sized AS (SELECT doc_id, h, CAST(length(h) // 2 AS BIGINT) AS n FROM base),
starts AS (
  SELECT doc_id, s, substr(h, 2 * s + 1, 100) AS w
  FROM (SELECT doc_id, h, unnest(range(0, n - 49)) AS s FROM sized)),
firsts AS (SELECT w, min(doc_id) AS first_id FROM starts GROUP BY w),
late AS (
  SELECT doc_id, s, lag(s) OVER (PARTITION BY doc_id ORDER BY s) AS prev
  FROM starts JOIN firsts USING (w) WHERE first_id < doc_id),
numbered AS (
  SELECT doc_id, s, sum(CASE WHEN prev IS NULL OR s > prev + 50 THEN 1 ELSE 0 END)
         OVER (PARTITION BY doc_id ORDER BY s) AS span FROM late),
spans AS (
  SELECT doc_id, span, min(s) AS b, max(s) + 50 AS e FROM numbered GROUP BY doc_id, span),
gaps AS (
  SELECT doc_id, lag(e, 1, 0) OVER (PARTITION BY doc_id ORDER BY b) AS b, b AS e FROM spans
  UNION ALL
  SELECT doc_id, coalesce(max(e), 0), any_value(n) FROM sized LEFT JOIN spans USING (doc_id) GROUP BY doc_id),
kept AS (
  SELECT doc_id, coalesce(string_agg(substr(h, 2 * b + 1, 2 * (e - b)), '' ORDER BY b), '') AS rest
  FROM gaps JOIN sized USING (doc_id) GROUP BY doc_id)
SELECT doc_id, n AS n_bytes, n - length(rest) // 2 AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(rest)) AS kept_sha256
FROM sized JOIN kept USING (doc_id)
LEFT JOIN (SELECT doc_id, count(*) AS n_spans FROM spans GROUP BY doc_id) USING (doc_id)
"""

ORACLE_SQL: dict[str, str] = {
    "op2_exact_dedup": EXACT_DEDUP_SQL,
    "op4_preferences": PREFERENCES_SQL,
    "op6_shingle_join": SHINGLE_JOIN_SQL,
    "op8_line_dedup": LINE_DEDUP_SQL,
    "op9_suffix_dedup": SUFFIX_DEDUP_SQL,
    "op10_quality_rules": QUALITY_SQL,
}
