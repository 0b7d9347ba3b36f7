"""SimHash fingerprints of documents, and those within a Hamming radius of each other."""

from __future__ import annotations

from itertools import combinations
from math import pi

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evenframe.functions.durable import durable

from .common import ascii_lower, partitions_of, texts

SHINGLE = 5
WORD = r"[^\x20\x09-\x0D]+"
#: Two hashes of 64 bits.
BITS = 128
RADIUS, BLOCKS = 3, 4
#: Buckets of neighbouring ids per shuffle partition.
BUCKETS = 16
#: Parts that the documents of one table key are dealt into; only the queries are repeated.
SALTS = 16
LEAST = -(2**63)
#: Two counters of 32 bits lie in a long, so one sum counts two bits.
TWO = 2**32 + 1


def _term(position: Column) -> list[Column]:
    """Both hashes of the shingle at a place; 0 where the text has no word."""
    words = [F.get("words", position + i) for i in range(SHINGLE)]
    none = F.size("words") == 0
    return [F.when(none, F.lit(0)).otherwise(F.xxhash64(*seed, *words)) for seed in ([], [F.lit(1)])]


def _signs(hash_number: int) -> Column:
    """Bits that more than half of the terms' weight has set."""
    value = F.lit(0).cast("long")
    for i in range(32):
        votes = F.col(f"v{hash_number}_{i}")
        for bit, n in ((i, votes.bitwiseAND(F.lit(2**32 - 1))), (i + 32, F.shiftrightunsigned(votes, 32))):
            value = value.bitwiseOR(F.shiftleft((2 * n > F.col("weight")).cast("long"), bit))
    return value


def simhash(rows: DataFrame, keys: list[str], text_column: str = "text") -> DataFrame:
    """``keys, hi, lo``: the fingerprint of each text; ``keys`` tell the rows apart.

    Terms are shingles of five words, A-Z lower-cased; fewer words are one
    term. A term weighs as often as it occurs, and each occurrence votes on every
    bit. A text without a word has no bit set. Rows that repeat all keys must
    repeat the text; they get the fingerprint of it, once.

    Nothing is shuffled when the rows already lie together by some of ``keys``.
    """
    words = rows.select(*keys, F.regexp_extract_all(ascii_lower(F.col(text_column)), F.lit(WORD), F.lit(0)).alias("words"))
    last = F.greatest(F.size("words") - SHINGLE, F.lit(0))
    placed = words.select(*keys, "words", F.explode(F.sequence(F.lit(0), last)).alias("at"))
    hashes = [h.alias(f"h{k}") for k, h in enumerate(_term(F.col("at")))]
    terms = placed.select(*keys, *hashes)
    sums = [
        F.sum(F.shiftrightunsigned(f"h{k}", i).bitwiseAND(F.lit(TWO))).alias(f"v{k}_{i}")
        for k in range(2)
        for i in range(32)
    ]
    counted = terms.groupBy(*keys).agg(F.count("*").alias("weight"), *sums)
    return counted.select(*keys, _signs(0).alias("hi"), _signs(1).alias("lo"))


def distance(hi: Column, lo: Column, other_hi: Column, other_lo: Column) -> Column:
    """Bits in which two fingerprints differ."""
    return F.bit_count(hi.bitwiseXOR(other_hi)) + F.bit_count(lo.bitwiseXOR(other_lo))


def likeness(bits: Column) -> Column:
    """The cosine that so many differing bits stand for; 0 beyond a right angle."""
    return F.greatest(F.cos(bits * F.lit(pi / BITS)), F.lit(0.0))


def _bucket(place: Column, bounds: list[int]) -> Column:
    """Number of the last bound that is not below ``place``, by halving steps."""
    steps = [2**k for k in reversed(range(len(bounds).bit_length()))]
    array = F.split(F.lit(",".join(map(str, bounds))), ",").cast("array<bigint>")

    def step(at: Column, width: Column) -> Column:
        further = at + width
        return F.when((further < len(bounds)) & (F.get(array, further) >= place), further).otherwise(at)

    return F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), step)


def _heads(places: DataFrame, n: int) -> list[int]:
    """At most ``n`` values of ``place``, the greatest among them, at about equal distances in rows; falling."""
    shares = F.lit([k / n for k in range(1, n + 1)])
    cuts = places.agg(F.percentile_approx("place", shares, max(10_000, 10 * n))).first()[0]
    if not cuts:
        return [LEAST]
    # values beyond 53 bits come back rounded, so each cut is replaced by the greatest value below it
    cuts = sorted({LEAST, *cuts, 2**63 - 1}, reverse=True)
    heads = places.groupBy(_bucket(F.col("place"), cuts)).agg(F.max("place").alias("head"))
    return sorted({r["head"] for r in heads.collect()}, reverse=True)


def followed(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``bucket, number, extra, id, text, next``: each document and the next by descending id.

    The next of the last is the first. Ids are cut at values that occur, at
    most BUCKETS for each shuffle partition, which the driver holds; the
    document at the head of a bucket goes to the bucket before it as well, as
    its ``extra`` last row without a next. So one shuffle brings all neighbours together and no
    bucket needs another. Null ids come last; rows that repeat an id follow
    each other by text. All rows of one id lie in one bucket.
    """
    rows = texts(docs, id_column, text_column).withColumn("place", F.coalesce("id", F.lit(LEAST)))
    bounds = _heads(rows.select("place"), BUCKETS * partitions_of(docs))
    rows = rows.withColumn("own", _bucket(F.col("place"), bounds))
    array = F.split(F.lit(",".join(map(str, bounds))), ",").cast("array<bigint>")
    own = F.struct(F.col("own").alias("bucket"), F.lit(0).alias("extra"))
    before = F.pmod(F.col("own") - 1, F.lit(len(bounds)))
    copy = F.struct(before.alias("bucket"), F.lit(1).alias("extra"))
    is_head = F.get(array, F.col("own")) == F.col("place")
    dealt = rows.select("id", "place", "text", F.inline(F.when(is_head, F.array(own, copy)).otherwise(F.array(own))))
    order = Window.partitionBy("bucket").orderBy("extra", F.desc("place"), F.col("id").isNull(), "text")
    following = F.lead("text").over(order).alias("next")
    return dealt.select("bucket", F.row_number().over(order).alias("number"), "extra", "id", "text", following)


def edited_fingerprints(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: its fingerprint, that of its edited text and that of the next document.

    ``doc_id, n_chars, edited_sha256, hi, lo, edited_hi, edited_lo, next_hi, next_lo``.
    The edited text ends in the start of the next document (:func:`followed`) in
    place of its own last third. The one shuffle of texts also serves the
    fingerprints and the comparison with the next one.

    Null text counts as empty. Rows that repeat an id come out one by one. An
    empty table gives no row, a single document is its own next.
    """
    pairs = followed(docs, id_column, text_column)
    n = F.char_length("text").cast("long")
    third = F.floor(n / 3).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n.cast("int") - third), F.substring("next", F.lit(1), third))
    rows = pairs.select("bucket", "number", "extra", "id", "text", n.alias("n_chars"), F.when(F.col("extra") == 0, edited).alias("edited"))
    sha = F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256")
    first = F.struct(F.lit(0).alias("kind"), F.col("text").alias("text"))
    second = F.struct(F.lit(1).alias("kind"), F.col("edited").alias("text"))
    kinds = F.when(F.col("extra") == 0, F.array(first, second)).otherwise(F.array(first))
    keys = ["bucket", "number", "extra", "id", "n_chars", "edited_sha256"]
    both = rows.select(*keys[:5], sha, F.inline(kinds))
    prints = simhash(both, [*keys, "kind"])
    order = Window.partitionBy("bucket").orderBy("number", "kind")
    ahead = [F.lead(c, k).over(order).alias(f"{p}_{c}") for k, p in ((1, "edited"), (2, "next")) for c in ("hi", "lo")]
    found = prints.select(*keys, "kind", "hi", "lo", *ahead).where("kind = 0 AND extra = 0")
    return found.drop("bucket", "number", "extra", "kind").withColumnRenamed("id", "doc_id")


def _tables(radius: int, blocks: int) -> list[tuple[int, int]]:
    """Masks of the bits that a table's key keeps: all choices of ``blocks - radius`` blocks.

    Two fingerprints within the radius differ in at most that many blocks, so
    they agree on all bits of some table's key.
    """
    if not 0 <= radius < blocks <= BITS:
        raise ValueError("there must be more blocks than the radius")
    edges = [BITS * b // blocks for b in range(blocks + 1)]
    masks = [sum(1 << bit for bit in range(a, b)) for a, b in zip(edges, edges[1:], strict=False)]
    return [divmod(sum(chosen), 2**64) for chosen in combinations(masks, blocks - radius)]


def _signed(mask: int) -> Column:
    return F.lit(mask - 2**64 if mask >= 2**63 else mask)


def near_fingerprints(queries: DataFrame, prints: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """``hi, lo, n_near``: for each distinct ``hi, lo`` of the queries, rows of ``prints`` within ``radius`` bits.

    Fingerprints are counted first, so copies meet once. Each goes into one
    table for every choice of ``blocks - radius`` blocks, keyed by the bits of these blocks;
    queries meet those of equal key. A pair is taken in the first table that
    brings it together. Keys are dealt into SALTS parts, each of which sees all
    queries. More blocks make longer keys and more tables.
    """
    tables = _tables(radius, blocks)

    def keyed(df: DataFrame, part: Column) -> DataFrame:
        keys = [
            F.struct(
                F.lit(t).alias("t"),
                F.col("hi").bitwiseAND(_signed(hi)).alias("k_hi"),
                F.col("lo").bitwiseAND(_signed(lo)).alias("k_lo"),
            )
            for t, (hi, lo) in enumerate(tables)
        ]
        return df.withColumn("part", part).select("*", F.inline(F.array(*keys)))

    counted = keyed(prints.groupBy("hi", "lo").agg(F.count("*").alias("n")), F.pmod(F.xxhash64("hi", "lo"), F.lit(SALTS)).cast("int"))
    asked = queries.select(F.col("hi").alias("q_hi"), F.col("lo").alias("q_lo")).distinct()
    parts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    asked = keyed(asked.select(F.col("q_hi").alias("hi"), F.col("q_lo").alias("lo")), parts).withColumnsRenamed({"hi": "q_hi", "lo": "q_lo"})
    met = counted.join(asked, ["t", "k_hi", "k_lo", "part"])
    hi, lo = F.col("hi").bitwiseXOR(F.col("q_hi")), F.col("lo").bitwiseXOR(F.col("q_lo"))
    agree = [(hi.bitwiseAND(_signed(a)) == 0) & (lo.bitwiseAND(_signed(b)) == 0) for a, b in tables]
    first = F.coalesce(*[F.when(a, F.lit(t)) for t, a in enumerate(agree)])
    near = met.where((F.bit_count(hi) + F.bit_count(lo) <= radius) & (first == F.col("t")))
    return near.groupBy(F.col("q_hi").alias("hi"), F.col("q_lo").alias("lo")).agg(F.sum("n").alias("n_near"))


def document_fingerprints(docs: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS, every: int = 100) -> DataFrame:
    """``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, n_near``.

    Fingerprints are 32 hexadecimal digits. ``near_*`` is the likeness of the
    document's fingerprint to that of its edited text and of the next document.
    Documents whose id is divisible by ``every`` are searched for: ``n_near`` is
    the number of other documents within ``radius`` bits; null for the others.
    """
    found = durable(edited_fingerprints(docs))
    asked = F.coalesce(F.col("doc_id") % every == 0, F.lit(False))
    near = near_fingerprints(found.where(asked), found, radius, blocks).withColumn("asked", F.lit(True))
    found = found.withColumn("asked", asked).join(near, ["hi", "lo", "asked"], "left")

    def spelled(hi: str, lo: str) -> Column:
        return F.lower(F.concat(F.lpad(F.hex(hi), 16, "0"), F.lpad(F.hex(lo), 16, "0")))

    def alike(other: str) -> Column:
        return likeness(distance(F.col("hi"), F.col("lo"), F.col(f"{other}_hi"), F.col(f"{other}_lo")))

    return found.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        spelled("hi", "lo").alias("fingerprint"),
        spelled("edited_hi", "edited_lo").alias("edited_fingerprint"),
        alike("edited").alias("near_edited"),
        alike("next").alias("near_next"),
        (F.col("n_near") - 1).alias("n_near"),
    )
