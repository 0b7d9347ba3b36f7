"""Preference pairs of conversations as one prompt and two masked completions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The marks of a rendered turn, and the role that is learned.
OPEN, CLOSE, END = "<|", "|>\n", "<|end|>\n"
LEARNED_ROLE = "assistant"
PARTS = ("prompt", "chosen", "rejected")


def _turns(conversations: DataFrame, key: str, side: str) -> DataFrame:
    def column(name: str) -> Column:
        return conversations[name]

    return conversations.select(
        column(key).alias("key"),
        column("turn").cast("long").alias("turn"),
        F.coalesce(column("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(column("text").cast("string"), F.lit("")).alias("text"),
        F.lit(side).alias("side"),
    )


def preference_segments(chosen: DataFrame, rejected: DataFrame, key: str = "conv_id") -> DataFrame:
    """One row per rendered turn: ``key, part, turn, role, header, body, learn``.

    Both frames hold ``key, turn, role, text``; a key's turns of the first are
    its chosen conversation, of the second its rejected one. The longest run of
    leading turns on which both agree is the ``prompt``, given once; what
    follows is ``chosen`` and ``rejected``. ``header`` and ``body``, joined in
    the order of ``turn, role, body``, are the rendered part. ``learn`` is the
    mask of the body: true for the assistant's turns of both completions; a
    header is never learned.

    The first turn that differs is an aggregate of the turns that lie on one
    side only, so no conversation is collected: one with a third of all turns
    is spread by turn, and its join back is split like any skewed join.

    A key on one side only has no prompt. Null roles and texts count as empty, a
    null turn comes after all others, null keys form one conversation. Equal
    rows count once; several rows of one turn are its parts, ordered by role and
    text. A text cannot close its turn: ``<|`` in a role or text gets a blank
    after the ``<``. Empty tables give no row; further columns are ignored.
    """
    both = _turns(chosen, key, "chosen").union(_turns(rejected, key, "rejected"))
    both = both.withColumn("turn", F.coalesce("turn", F.lit(2**63 - 1)))
    rows = both.groupBy("key", "turn", "role", "text").agg(
        F.bool_or(F.col("side") == "chosen").alias("in_chosen"),
        F.bool_or(F.col("side") == "rejected").alias("in_rejected"),
    )
    split = (
        rows.where("in_chosen != in_rejected")
        .groupBy(F.col("key").alias("key_2"))
        .agg(F.min("turn").alias("first_difference"))
    )
    joined = rows.join(split, F.col("key").eqNullSafe(F.col("key_2")), "left")
    shared = F.col("first_difference").isNull() | (F.col("turn") < F.col("first_difference"))
    parts = F.when(shared, F.array(F.lit("prompt"))).otherwise(
        F.filter(
            F.array(F.when(F.col("in_chosen"), "chosen"), F.when(F.col("in_rejected"), "rejected")),
            lambda x: x.isNotNull(),
        )
    )
    safe = {c: F.replace(F.col(c), F.lit(OPEN), F.lit("< |")) for c in ("role", "text")}
    return joined.withColumn("part", F.explode(parts)).select(
        F.col("key").alias(key),
        "part",
        F.when(F.col("turn") < 2**63 - 1, F.col("turn")).alias("turn"),
        "role",
        F.concat(F.lit(OPEN), safe["role"], F.lit(CLOSE)).alias("header"),
        F.concat(safe["text"], F.lit(END)).alias("body"),
        ((F.col("part") != "prompt") & (F.col("role") == LEARNED_ROLE)).alias("learn"),
    )


def preference_samples(segments: DataFrame, key: str = "conv_id") -> DataFrame:
    """``key, prompt, chosen, rejected, chosen_spans, rejected_spans``: a pair per row.

    Spans are ``start, length`` of the learned characters of a completion. A
    pair has to fit a row here; :func:`preference_segments` needs no such thing.
    """
    order = F.struct(F.coalesce("turn", F.lit(2**63 - 1)).alias("turn"), "role", "body", "header", "learn")
    wanted = [F.array_sort(F.collect_list(F.when(F.col("part") == p, order))).alias(p) for p in PARTS]
    rows = segments.groupBy(F.col(key).alias("key")).agg(*wanted)

    def text(part: str) -> Column:
        return F.array_join(F.transform(part, lambda s: F.concat(s["header"], s["body"])), "").alias(part)

    def spans(part: str) -> Column:
        folded = (
            f"aggregate({part}, struct(0L AS at, CAST(array() AS ARRAY<STRUCT<start: BIGINT, length: BIGINT>>) AS spans), "
            "(s, x) -> struct(s.at + length(x.header) + length(x.body) AS at, "
            "IF(x.learn, concat(s.spans, array(struct(s.at + length(x.header) AS start, "
            "CAST(length(x.body) AS BIGINT) AS length))), s.spans) AS spans)).spans"
        )
        return F.expr(folded).alias(f"{part}_spans")

    return rows.select(
        F.col("key").alias(key), *map(text, PARTS), spans("chosen"), spans("rejected")
    )


def shortened_answers(conversations: DataFrame) -> DataFrame:
    """Rejected versions of conversations: the last assistant turn, first line only."""
    last = (
        conversations.where(F.col("role") == LEARNED_ROLE)
        .groupBy(F.col("conv_id").alias("conv_2"))
        .agg(F.max("turn").alias("last_turn"))
    )
    joined = conversations.join(last, F.col("conv_id").eqNullSafe(F.col("conv_2")), "left")
    here = (F.col("turn") == F.col("last_turn")) & (F.col("role") == LEARNED_ROLE)
    text = F.when(here, F.substring_index("text", "\n", 1)).otherwise(F.col("text"))
    return joined.select("conv_id", "turn", "role", text.alias("text"))


def preference_digests(segments: DataFrame, key: str = "conv_id") -> DataFrame:
    """The segments with sizes and a digest in place of their texts."""
    return segments.select(
        key,
        "part",
        "turn",
        "role",
        "learn",
        F.char_length("header").cast("long").alias("header_chars"),
        F.char_length("body").cast("long").alias("body_chars"),
        F.sha2(F.concat("header", "body"), 256).alias("sha256"),
    )
