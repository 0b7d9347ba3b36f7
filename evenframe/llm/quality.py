"""Quality rules whose thresholds adapt to language and source."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenframe.functions.durable import durable

from .common import per_batch

#: Characters that count as symbols.
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MOST_REPEATED_PERCENT = 50

#: Metrics of a document that has words, whole numbers, and the distance from
#: the quartiles that any group may have, however alike its documents are.
METRICS = {
    "word_length": ("100 * word_chars div nullif(n_words, 0)", 150),  # hundredths of a code point
    "symbols": ("1000 * n_symbols div nullif(n_words, 0)", 100),  # per thousand words
    "dup_lines": ("1000 * n_dup_lines div nullif(n_lines, 0)", 500),  # per thousand lines with a word
    "repeats": ("1000 * n_repeat_words div nullif(n_words, 0)", 200),  # per thousand words
}
FENCE = 3
#: Groups of fewer documents take the sketch of their language, or of all.
LEAST_GROUP = 100
#: Leading bits that a sketch keeps of a value: it is exact below 2 ** BITS,
#: beyond at most 1 / 2 ** (BITS - 1) too low.
BITS = 7
#: Thresholds of at most so many groups are broadcast, more are joined by key.
MOST_BROADCAST = 20_000
SALTS = 16


def _counts(text: str | None) -> tuple[int, int, int, int, int, int]:
    words = (text or "").encode().split()
    n = len(words)
    chars = len(b"".join(words).decode())
    symbols = sum(map((text or "").count, SYMBOLS))
    lines = [x for x in (text or "").split("\n") if x.strip(" \t\x0b\x0c\r")]
    windows = list(zip(words, words[1:], words[2:], strict=False))
    repeated = 0
    seen = Counter(windows)
    if len(seen) < len(windows):
        covered = -1  # last word counted so far
        for i, w in enumerate(windows):
            if seen[w] > 1:
                repeated += i + 2 - max(covered, i - 1)
                covered = i + 2
    return n, chars, symbols, len(lines) - len(set(lines)), repeated, len(lines)


STATS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_lines long"


def _stats(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    rows = [_counts(t) for t in batch.column("text").to_pylist()]
    columns = [pa.array([r[i] for r in rows], pa.int64()) for i in range(6)]
    names = [x.split()[0] for x in STATS.split(", ")]
    keys = [batch.column(k) for k in ("id", "lang", "source")]
    yield pa.RecordBatch.from_arrays(keys + columns, names=["id", "lang", "source", *names])


def quality_stats(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    lang_column: str = "lang",
    source_column: str = "source",
) -> DataFrame:
    """Counts of every whole text, without the text: ``id, lang, source`` and STATS."""
    rows = docs.select(
        docs[id_column].cast("long").alias("id"),
        docs[lang_column].cast("string").alias("lang"),
        docs[source_column].cast("string").alias("source"),
        docs[text_column].cast("string").alias("text"),
    )
    return rows.mapInArrow(per_batch(_stats, "text"), f"id long, lang string, source string, {STATS}")


def quantile_sketch(stats: DataFrame) -> DataFrame:
    """Mergeable sketches: documents per language, source, metric and bucket.

    A bucket is a value cut to its leading BITS bits, so sketches merge by
    adding counts, in any order and with the same result. Documents without a
    word have no metrics.
    """
    values = [f"'{name}', {formula}" for name, (formula, _) in METRICS.items()]
    rows = stats.where("n_words > 0").selectExpr(
        "lang", "source", f"stack({len(values)}, {', '.join(values)}) AS (metric, value)"
    )
    cut = f"greatest(0, length(bin(value)) - {BITS})"
    return (
        rows.withColumn("cut", F.expr(cut))
        .withColumn("bucket", F.expr("shiftleft(shiftright(value, cut), cut)"))
        .groupBy("lang", "source", "metric", "bucket")
        .agg(F.count("*").alias("n"))
    )


def _quartiles(sketch: DataFrame, keys: list[str]) -> DataFrame:
    """Quartiles of each key and metric; a key has a bounded number of buckets."""
    merged = sketch.groupBy(*keys, "metric", "bucket").agg(F.sum("n").alias("n"))
    histogram = F.array_sort(F.collect_list(F.struct("bucket", "n"))).alias("h")
    rows = merged.groupBy(*keys, "metric").agg(histogram, F.sum("n").alias("total"))
    at = (
        "aggregate(h, struct(0L AS seen, CAST(NULL AS LONG) AS found), (s, x) -> struct("
        "s.seen + x.n AS seen, CASE WHEN s.found IS NULL AND 4 * (s.seen + x.n) >= {q} * total "
        "THEN x.bucket ELSE s.found END AS found)).found"
    )
    return rows.select(
        *keys, "metric", "total", F.expr(at.format(q=1)).alias("q1"), F.expr(at.format(q=3)).alias("q3")
    )


def adaptive_thresholds(sketch: DataFrame) -> DataFrame:
    """``lang, source`` and the lowest and highest value that each metric may have.

    The fences lie FENCE times the distance of the quartiles beyond them, and
    never nearer than the slack of the metric. A group of fewer than
    LEAST_GROUP documents takes the quartiles of its language, and where these
    are as few, those of all documents: sketches merge. Null languages and
    sources are groups of their own.
    """
    fine = _quartiles(sketch, ["lang", "source"])
    lang = _quartiles(sketch, ["lang"]).select(
        F.col("lang").alias("lang_2"), F.col("metric").alias("metric_2"), "total",
        F.struct("q1", "q3").alias("by_lang"),
    )
    whole = _quartiles(sketch, []).select(
        F.col("metric").alias("metric_3"), F.struct("q1", "q3").alias("by_all")
    )
    lang = lang.withColumnRenamed("total", "total_2")
    rows = fine.join(
        lang, fine["lang"].eqNullSafe(lang["lang_2"]) & (fine["metric"] == lang["metric_2"])
    ).join(whole, F.col("metric") == whole["metric_3"])
    used = (
        F.when(F.col("total") >= LEAST_GROUP, F.struct("q1", "q3"))
        .when(F.col("total_2") >= LEAST_GROUP, F.col("by_lang"))
        .otherwise(F.col("by_all"))
    )
    slack = F.create_map(*[F.lit(x) for name, (_, s) in METRICS.items() for x in (name, s)])
    gap = F.greatest(FENCE * (F.col("u.q3") - F.col("u.q1")), slack[F.col("metric")].cast("long"))
    rows = rows.withColumn("u", used).select(
        "lang", "source", "metric", (F.col("u.q1") - gap).alias("low"), (F.col("u.q3") + gap).alias("high")
    )
    return rows.groupBy("lang", "source").agg(
        F.map_from_entries(F.collect_list(F.struct("metric", "low"))).alias("low"),
        F.map_from_entries(F.collect_list(F.struct("metric", "high"))).alias("high"),
    )


def quality_rules(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    lang_column: str = "lang",
    source_column: str = "source",
) -> DataFrame:
    """One row per document: ``doc_id``, its counts, ``base_failed`` and ``kept``.

    A document fails the base with fewer than MIN_WORDS words, or when more
    than MOST_REPEATED_PERCENT of its words lie in repeated three-word windows.
    Of the others those are kept whose word length, symbols, repeated lines and
    repeated words lie within the fences of their language and source. Only
    word length has a lower fence.

    The counts of the texts are stored once; sketches, thresholds and verdicts
    are taken from them. Null and empty texts have no words and fail the base.
    Rows that repeat an id are judged one by one. An empty table gives no row;
    further columns are ignored.
    """
    stats = durable(quality_stats(docs, id_column, text_column, lang_column, source_column))
    limits = durable(adaptive_thresholds(quantile_sketch(stats)))
    if limits.count() <= MOST_BROADCAST:
        limits, salted = F.broadcast(limits), stats.withColumn("salt", F.lit(0))
        limits = limits.withColumn("salt_2", F.lit(0))
    else:
        salted = stats.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int"))
        limits = limits.withColumn("salt_2", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    limits = limits.withColumnsRenamed({"lang": "lang_2", "source": "source_2"})
    joined = salted.join(
        limits,
        F.col("lang").eqNullSafe(F.col("lang_2"))
        & F.col("source").eqNullSafe(F.col("source_2"))
        & (F.col("salt") == F.col("salt_2")),
        "left",
    )
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words")
    )
    fits = F.lit(True)
    for name, (formula, _) in METRICS.items():
        fits = fits & F.expr(f"{formula} <= high['{name}']")
    fits = fits & F.expr(f"{METRICS['word_length'][0]} >= low['word_length']")
    return joined.select(
        F.col("id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"),
        F.when(failed, False).otherwise(F.coalesce(fits, F.lit(False))).alias("kept"),
    )
