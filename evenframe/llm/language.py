"""Language identification by rank-order profiles of n-grams."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import per_batch, small_batches

#: Ranks of a profile, and n-grams of a document that are compared with it.
PROFILE = 400
#: Most languages that profiles are learned for, those with most documents.
MOST_LANGUAGES = 1000
#: Counts that a task keeps before it gives them away.
HELD_GRAMS = 1_000_000
FOLDS, HELD_OUT_FOLD = 4, 2
UNDETERMINED = "und"
#: Texts of a lower score resemble none of the languages.
LEAST_SCORE = 0.3
BLANK = 32


def fold(id_column: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id is the empty text."""
    return F.crc32(F.coalesce(id_column.cast("string"), F.lit("")).cast("binary")) % folds


def grams(docs: list[str]) -> Iterator[np.ndarray]:
    """Codes of all n-grams of one to three characters of each text.

    Texts are lower-cased; whatever is no letter separates words, and a blank
    stands on both sides of each word. A code holds 21 bits per character. No
    n-gram reaches over a word's end.
    """
    lowered = [t.lower() for t in docs]
    ends = np.cumsum([len(t) for t in lowered])
    codes = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    letter = np.zeros(int(codes.max(initial=0)) + 1, bool)
    present = np.flatnonzero(np.bincount(codes, minlength=1))
    letter[present] = [chr(c).isalpha() for c in present.tolist()]
    is_letter = letter[codes] if len(codes) else np.zeros(0, bool)
    start = 0
    for end in ends.tolist():
        mine = is_letter[start:end]
        follows = np.concatenate([[False], mine[:-1]]) & ~mine
        keep = mine | follows
        text = np.where(mine, codes[start:end], BLANK)[keep]
        start = end
        if not len(text):
            yield np.zeros(0, np.int64)
            continue
        text = np.concatenate([[BLANK], text] + ([[BLANK]] if text[-1] != BLANK else []))
        pairs = text[:-1] << 21 | text[1:]
        triples = (pairs[:-1] << 21 | text[2:])[text[1:-1] != BLANK]
        yield np.concatenate([text[text != BLANK], pairs, triples])


def ranked(codes: np.ndarray, most: int = PROFILE) -> np.ndarray:
    """The most frequent codes, ties by code."""
    values, counts = np.unique(codes, return_counts=True)
    return values[np.lexsort((values, -counts))[:most]]


def _gram_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of a partition's n-grams by language, given away when there are many."""
    known: dict[str, tuple[np.ndarray, np.ndarray]] = {}

    def given() -> Iterator[pa.RecordBatch]:
        for lang, (values, counts) in known.items():
            columns = [pa.array([lang] * len(values), pa.string()), pa.array(values), pa.array(counts)]
            yield pa.RecordBatch.from_arrays(columns, names=["lang", "gram", "n"])
        known.clear()

    for batch in small_batches(batches, "text"):
        by_lang: dict[str, list[np.ndarray]] = {}
        langs = batch.column("lang").to_pylist()
        for lang, codes in zip(langs, grams(batch.column("text").to_pylist()), strict=True):
            by_lang.setdefault(lang, []).append(codes)
        for lang, parts in by_lang.items():
            found = np.unique(np.concatenate(parts), return_counts=True)
            if lang in known:
                both = [np.concatenate(x) for x in zip(known[lang], found, strict=True)]
                values, at = np.unique(both[0], return_inverse=True)
                found = values, np.bincount(at, both[1], len(values)).astype(np.int64)
            known[lang] = found
        if sum(len(v) for v, _ in known.values()) > HELD_GRAMS:
            yield from given()
    yield from given()


def learn_profiles(
    docs: DataFrame, text_column: str = "text", lang_column: str = "lang"
) -> dict[str, list[int]]:
    """The PROFILE most frequent n-grams of each language, most frequent first.

    All rows with a text and a language count. Tasks count their rows before the
    shuffle, so a language of any share moves one row per task and n-gram. The
    driver gets PROFILE numbers for each of at most MOST_LANGUAGES languages.
    """
    rows = docs.select(
        docs[lang_column].cast("string").alias("lang"), docs[text_column].cast("string").alias("text")
    ).where("lang IS NOT NULL AND text IS NOT NULL")
    common = rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(MOST_LANGUAGES)
    counts = (
        rows.mapInArrow(_gram_counts, "lang string, gram long, n long")
        .groupBy("lang", "gram")
        .agg(F.sum("n").alias("n"))
        .join(F.broadcast(common.select("lang")), "lang")
    )
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    best = counts.withColumn("place", F.row_number().over(order)).where(F.col("place") <= PROFILE)
    found: dict[str, list[int]] = {}
    for r in sorted(best.collect(), key=lambda r: (r["lang"], r["place"])):
        found.setdefault(r["lang"], []).append(r["gram"])
    return found


class Profiles:
    """Ranks of all profile n-grams, one column per language."""

    def __init__(self, profiles: dict[str, list[int]]):
        self.langs = sorted(profiles)
        self.codes = np.array(sorted({g for p in profiles.values() for g in p}), np.int64)
        self.ranks = np.full((len(self.codes), len(self.langs)), -1, np.int64)
        for column, lang in enumerate(self.langs):
            at = np.searchsorted(self.codes, np.array(profiles[lang], np.int64))
            self.ranks[at, column] = np.arange(len(at))

    def distances(self, codes: np.ndarray) -> np.ndarray:
        """Out-of-place distance of ranked codes to every language.

        An n-gram that a profile lacks is PROFILE places off, as is any that
        lies farther.
        """
        at = np.minimum(np.searchsorted(self.codes, codes), len(self.codes) - 1)
        ranks = np.where((self.codes[at] == codes)[:, None], self.ranks[at], -1)
        off = np.abs(ranks - np.arange(len(codes))[:, None])
        return np.where(ranks < 0, PROFILE, np.minimum(off, PROFILE)).sum(axis=0)


def _predicted(profiles: dict[str, list[int]], carried: list[str]):
    table = Profiles(profiles)

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        langs, scores, margins = [], [], []
        for codes in grams(batch.column("text").to_pylist()):
            if not len(codes) or not table.langs:
                langs.append(UNDETERMINED)
                scores.append(0.0)
                margins.append(0.0)
                continue
            mine = ranked(codes)
            off = table.distances(mine) / (len(mine) * PROFILE)
            best = int(np.argmin(off))
            rest = np.delete(off, best).min(initial=1.0)
            langs.append(table.langs[best])
            scores.append(float(1 - off[best]))
            margins.append(float(rest - off[best]))
        columns = [batch.column(c) for c in carried]
        columns += [pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(margins, pa.float64())]
        yield pa.RecordBatch.from_arrays(columns, names=[*carried, "lang_pred", "score", "margin"])

    return work


def identify(
    docs: DataFrame,
    profiles: dict[str, list[int]],
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per document: ``doc_id, held_out, lang_pred, score, margin``.

    ``lang_pred`` is the language of the least out-of-place distance, the first
    by name of equals. ``score`` is 1 less that distance as a share of the
    greatest one, ``margin`` how much nearer it is than the next language. A
    text that is null or has no letter is ``und`` with score 0, as is every text
    where there are no profiles. Only the text is looked at. An empty table
    gives no row; further columns are ignored.
    """
    rows = docs.select(
        docs[id_column].cast("long").alias("doc_id"),
        (fold(docs[id_column], FOLDS) == HELD_OUT_FOLD).alias("held_out"),
        F.coalesce(docs[text_column].cast("string"), F.lit("")).alias("text"),
    )
    return rows.mapInArrow(
        per_batch(_predicted(profiles, ["doc_id", "held_out"]), "text"),
        "doc_id long, held_out boolean, lang_pred string, score double, margin double",
    )


def language_id(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", lang_column: str = "lang"
) -> DataFrame:
    """:func:`identify` with profiles learned from the documents not held out."""
    learned = docs.where(fold(docs[id_column], FOLDS) != HELD_OUT_FOLD)
    return identify(docs, learn_profiles(learned, text_column, lang_column), id_column, text_column)


def keep_identified(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    lang_column: str = "lang",
    least_score: float = LEAST_SCORE,
) -> DataFrame:
    """The rows of ``docs`` whose text is in a learned language, with all their columns.

    Rejected are texts without a letter, and those whose n-grams lie so far from
    every profile that the score is below ``least_score``. Where no language can
    be learned, every row stays.
    """
    learned = docs.where(fold(docs[id_column], FOLDS) != HELD_OUT_FOLD)
    profiles = learn_profiles(learned, text_column, lang_column)
    if not profiles:
        return docs
    rows = docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("rest"),
        F.coalesce(docs[text_column].cast("string"), F.lit("")).alias("text"),
    )
    kind = rows.schema["rest"].dataType.simpleString()
    judged = rows.mapInArrow(
        per_batch(_predicted(profiles, ["rest"]), "text"),
        f"rest {kind}, lang_pred string, score double, margin double",
    )
    kept = judged.where((F.col("lang_pred") != UNDETERMINED) & (F.col("score") >= least_score))
    return kept.select([F.col(f"rest.`{c}`") for c in docs.columns])
