"""Words that are spelling variants of more frequent ones, found by Gram matrices of letter counts."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evenframe.functions.durable import durable

from .common import ascii_lower, texts

RUN = r"[A-Za-zÀ-ÿ]+"
#: Every how many runs, by a checksum of document and run, one loses a letter.
TYPO = 31
LEAST_LETTERS, LEAST_COUNT = 7, 2
#: How many times as frequent a word must be to be the form of another.
TIMES = 10
#: Letter classes whose counts make a block, and the words of a tile.
CLASSES = 6
TILE = 1024
#: Longest words whose letters are compared as arrays.
WIDE = 64
#: Products of one Gram matrix.
CELLS = 2**22
ALPHABET = [*map(chr, range(ord("a"), ord("z") + 1)), *map(chr, range(0xC0, 0x100))]


def spelled_words(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``word, n``: runs of letters, A-Z lower-cased, some of them short of one letter.

    A run loses a letter when the crc32 of ``<id>:<run>`` is divisible by TYPO:
    the one at the checksum modulo its length. Words of at least LEAST_LETTERS
    code points found at least LEAST_COUNT times are kept. Null texts have no run, a null
    id counts as no digits.
    """
    rows = texts(docs, id_column, text_column)
    runs = rows.select("id", F.explode(F.regexp_extract_all(ascii_lower(F.col("text")), F.lit(RUN), F.lit(0))).alias("run"))
    name = F.coalesce(F.col("id").cast("string"), F.lit(""))
    runs = runs.select("run", F.crc32(F.concat(name, F.lit(":"), "run").cast("binary")).alias("h"))
    at = F.pmod("h", F.char_length("run")).cast("int")
    shorter = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.char_length("run")))
    words = runs.select(F.when(F.col("h") % TYPO == 0, shorter).otherwise(F.col("run")).alias("word"))
    counted = words.where(F.char_length("word") >= LEAST_LETTERS).groupBy("word").agg(F.count("*").alias("n"))
    return counted.where(F.col("n") >= LEAST_COUNT)


def _class_counts(word: Column) -> list[Column]:
    """How many letters of each class the word has; letters are dealt to classes in turn."""
    every = [ALPHABET[k::CLASSES] for k in range(CLASSES)]
    return [F.char_length(word) - F.char_length(F.translate(word, "".join(c), "")) for c in every]


def _key(counts: list[Column]) -> Column:
    return F.concat_ws(",", *[c.cast("string") for c in counts])


def tiles(words: DataFrame) -> DataFrame:
    """``block, tile, counts, n_tiles, words, ns``: words of equal class counts, and so of equal length.

    A block of more than TILE words is dealt into tiles of about that many.
    """
    keyed = words.withColumn("counts", F.array(*_class_counts(F.col("word"))))
    keyed = keyed.withColumn("block", _key([F.col("counts")[k] for k in range(CLASSES)]))
    sizes = keyed.groupBy("block").agg(F.ceil(F.count("*") / TILE).cast("int").alias("n_tiles"))
    placed = keyed.join(sizes, "block").withColumn("tile", F.pmod(F.xxhash64("word"), F.col("n_tiles")).cast("int"))
    members = F.collect_list(F.struct("word", "n")).alias("members")
    rows = placed.groupBy("block", "tile", "counts", "n_tiles").agg(members)
    return rows.select("block", "tile", "counts", "n_tiles", F.col("members.word").alias("words"), F.col("members.n").alias("ns"))


def _visits(counts: Column) -> Column:
    """Blocks where near words of a block's words may be: each pair of blocks is named from one side.

    One letter replaced takes one from a class and adds one to another, or
    changes none; one letter more adds one to a class.
    """

    def moved(up: int, down: int | None = None) -> Column:
        return _key([counts[k] + ((k == up) - (k == down)) for k in range(CLASSES)])

    replaced = [F.when(counts[b] > 0, moved(a, b)) for a, b in combinations(range(CLASSES), 2)]
    return F.array_compact(F.array(_key([counts[k] for k in range(CLASSES)]), *replaced, *map(moved, range(CLASSES))))


def tile_pairs(tiled: DataFrame) -> DataFrame:
    """``block, tile, words, ns, v_block, v_tile, v_words, v_ns``: tiles that may hold near words.

    Every pair of tiles comes once. It is a row of its own, so a block of very
    many words spreads over as many keys as it has tiles.
    """
    guests = tiled.select(F.col("block").alias("v_block"), F.col("tile").alias("v_tile"), F.explode(_visits(F.col("counts"))).alias("block"))
    hosts = tiled.select("block", "n_tiles").distinct()
    meetings = guests.join(hosts, "block").select("*", F.explode(F.sequence(F.lit(0), F.col("n_tiles") - 1)).alias("tile"))
    meetings = meetings.where("block != v_block OR v_tile <= tile").drop("n_tiles")
    visitors = tiled.select(*[F.col(c).alias(f"v_{c}") for c in ("block", "tile", "words", "ns")])
    met = meetings.join(visitors, ["v_block", "v_tile"])
    # a merge join leaves the visitors of a tile next to each other
    return met.join(tiled.select("block", "tile", "words", "ns").hint("merge"), ["block", "tile"])


def _letter_counts(codes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """How often each letter of the alphabet occurs in each word, whose codes follow each other."""
    size = ord("z") + 1 - ord("a")
    letter = np.where(codes < 0x80, codes - ord("a"), codes - 0xC0 + size)
    row = np.repeat(np.arange(len(lengths)), lengths)
    flat = np.bincount(row * len(ALPHABET) + letter, minlength=len(lengths) * len(ALPHABET))
    return flat.reshape(len(lengths), len(ALPHABET)).astype(np.float32)


def _codes(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64), np.array([len(w) for w in words])


def one_edit(u: str, v: str) -> bool:
    """Whether one inserted, deleted or replaced code point makes ``u`` into ``v``."""
    if len(u) > len(v):
        u, v = v, u
    if len(v) - len(u) > 1 or u == v:
        return False
    k = next((k for k, (a, b) in enumerate(zip(u, v, strict=False)) if a != b), len(u))
    return u[k + 1 :] == v[k + 1 :] if len(u) == len(v) else u[k:] == v[k + 1 :]


class _Tile:
    """Words of one length as arrays."""

    def __init__(self, words: list[str], ns: list[int]):
        self.words, self.ns = words, np.array(ns, np.int64)
        codes, lengths = _codes(words)
        self.length = int(lengths[0])
        self.counts = _letter_counts(codes, lengths)
        self.squares = (self.counts**2).sum(1)
        self.codes = codes.reshape(len(words), self.length) if self.length <= WIDE else None

    def near(self, other: _Tile) -> tuple[np.ndarray, np.ndarray]:
        """Places of near words in this tile and in one of the same length or one letter less."""
        found = []
        step = max(1, CELLS // len(other.words))
        for start in range(0, len(self.words), step):
            stop = start + step
            squared = self.squares[start:stop, None] + other.squares - 2 * (self.counts[start:stop] @ other.counts.T)
            mine, theirs = np.nonzero(squared < 2.5)
            mine += start
            for k in range(0, len(mine), CELLS // WIDE):
                a, b = mine[k : k + CELLS // WIDE], theirs[k : k + CELLS // WIDE]
                keep = self._one_edit(other, a, b)
                found.append((a[keep], b[keep]))
        return tuple(np.concatenate(c) for c in zip(*found, strict=True)) if found else (np.zeros(0, int),) * 2

    def _one_edit(self, other: _Tile, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        if self.codes is None or other.codes is None:
            return np.array([one_edit(self.words[i], other.words[j]) for i, j in zip(a, b, strict=True)], bool)
        u, v = self.codes[a], other.codes[b]
        if self.length == other.length:
            return (u != v).sum(1) == 1
        ahead = np.cumprod(u[:, :-1] == v, axis=1).sum(1)
        behind = np.cumprod(u[:, :0:-1] == v[:, ::-1], axis=1).sum(1)
        return ahead + behind >= other.length


def _best(tile: _Tile, other: _Tile, mine: np.ndarray, theirs: np.ndarray) -> Iterator[tuple[str, int, int, str]]:
    """For each word of ``tile`` with partners: how many, and the most frequent, of equals the smallest."""
    if not len(mine):
        return
    order = np.lexsort((-other.ns[theirs], mine))
    mine, theirs = mine[order], theirs[order]
    firsts = np.flatnonzero(np.diff(mine, prepend=-1))
    for start, stop in zip(firsts.tolist(), [*firsts[1:].tolist(), len(mine)], strict=True):
        top = int(other.ns[theirs[start]])
        ties = [other.words[j] for j in theirs[start:stop].tolist() if other.ns[j] == top]
        yield tile.words[mine[start]], stop - start, top, min(ties)


def _lists(column: pa.ListArray) -> list[list]:
    """The lists of a column; their values are converted at once."""
    values, edges = column.flatten().to_pylist(), np.cumsum([0, *column.value_lengths().to_pylist()]).tolist()
    return [values[a:b] for a, b in zip(edges, edges[1:], strict=False)]


def _met(home: _Tile, guest: _Tile) -> Iterator[tuple[str, int, int, str]]:
    mine, theirs = home.near(guest)
    yield from _best(home, guest, mine, theirs)
    if guest is not home:
        yield from _best(guest, home, theirs, mine)


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Near words of each pair of tiles, added up by word.

    The rows of one tile follow each other, so its visitors of one length in a batch are
    compared with it together.
    """
    for batch in batches:
        names = list(zip(batch.column("block").to_pylist(), batch.column("tile").to_pylist(), strict=True))
        guests = list(zip(batch.column("v_block").to_pylist(), batch.column("v_tile").to_pylist(), strict=True))
        words, ns, v_words, v_ns = (_lists(batch.column(c)) for c in ("words", "ns", "v_words", "v_ns"))
        rows: list[tuple[str, int, int, str]] = []
        for _, run in groupby(range(batch.num_rows), names.__getitem__):
            places = list(run)
            home = _Tile(words[places[0]], ns[places[0]])
            if any(guests[k] == names[k] for k in places):
                rows += _met(home, home)
            for length in (home.length, home.length - 1):
                others = [k for k in places if len(v_words[k][0]) == length and guests[k] != names[k]]
                if others:
                    rows += _met(home, _Tile(*([x for k in others for x in c[k]] for c in (v_words, v_ns))))
        kinds = pa.string(), pa.int64(), pa.int64(), pa.string()
        arrays = [pa.array(c, t) for c, t in zip(list(zip(*rows, strict=True)) or [()] * 4, kinds, strict=True)]
        yield pa.RecordBatch.from_arrays(arrays, names=["word", "n_near", "form_n", "form"])


def near_words(words: DataFrame) -> DataFrame:
    """``word, n_near, form, form_n`` for words with near ones: their number, and the most frequent of them.

    Near words differ by exactly one inserted, deleted or replaced letter, so
    their letter counts are at most 2 apart in squared distance. That is read
    off the Gram matrix of two tiles; the words of the pairs that pass are
    compared. Equals in frequency go by the smallest in code-point order.
    """
    pairs = tile_pairs(durable(tiles(words)))
    found = pairs.mapInArrow(_compared, "word string, n_near long, form_n long, form string")
    best = F.min(F.struct((-F.col("form_n")).alias("less"), "form")).alias("best")
    merged = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best)
    return merged.select("word", "n_near", F.col("best.form").alias("form"), (-F.col("best.less")).alias("form_n"))


def roots(forms: DataFrame) -> DataFrame:
    """``word, root`` of ``word, form``: the last word that forms lead to.

    Each round doubles the steps taken. A form is TIMES as frequent as its word,
    so no chain has more than 19 steps and five rounds are enough for any counts.
    """
    done, left = None, forms.select("word", F.col("form").alias("root"))
    while True:
        further = left.select(F.col("word").alias("root"), F.col("root").alias("next"))
        left = durable(left.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        if left.where("moved").isEmpty():
            return left.drop("moved")
        left = left.drop("moved")


def spelling_variants(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``word, form, root, n, n_near, form_n``: one row per word.

    ``form`` is the most frequent near word (:func:`near_words`) if it is at least
    TIMES as frequent, else null, as is ``form_n``. ``root`` is the word at the end of the chain of
    forms, the word itself if it has none. Texts without letters and empty
    tables give no rows; rows that repeat an id count each.
    """
    words = durable(spelled_words(docs, id_column, text_column))
    near = near_words(words)
    joined = durable(words.join(near, "word", "left"))
    strong = F.col("form_n") >= TIMES * F.col("n")
    rows = joined.select(
        "word",
        F.when(strong, F.col("form")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(strong, F.col("form_n")).alias("form_n"),
    )
    ends = roots(rows.where("form IS NOT NULL"))
    whole = rows.join(ends, "word", "left")
    return whole.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
