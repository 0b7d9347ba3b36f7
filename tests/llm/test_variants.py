"""Spelling variants against a comparison of all pairs of words."""

import random
import re
import zlib
from collections import Counter

import pytest
from evenframe.llm import variants

COLUMNS = "doc_id long, text string, word string, n int, block string"


def counted(rows):
    words = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            words[run if h % 31 else run[: h % len(run)] + run[h % len(run) + 1 :]] += 1
    return {w: n for w, n in words.items() if len(w) >= 7 and n >= 2}


def one_edit(u, v):
    if len(u) == len(v):
        return sum(a != b for a, b in zip(u, v)) == 1
    u, v = sorted((u, v), key=len)
    return len(v) - len(u) == 1 and any(v[:k] + v[k + 1 :] == u for k in range(len(v)))


def by_hand(rows):
    words = counted(rows)
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best and words[best] >= 10 * n else None
    out = {}
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out[w] = (form[w], root, n, len(near[w]), words[form[w]] if form[w] else None)
    return out


def text_of(counts):
    words = [w for w, n in counts.items() for _ in range(n)]
    random.Random(2).shuffle(words)
    return words


@pytest.fixture
def cases():
    r = random.Random(1)
    stems = ["".join(r.choice("abcdeinorstÀéø÷×") for _ in range(r.randint(7, 12))) for _ in range(40)]
    counts = Counter()
    for stem in stems:
        counts[stem] += r.choice([2, 30, 400])
        for _ in range(12):
            k, c = r.randrange(len(stem)), r.choice("abcdeinorst")
            counts[r.choice([stem[:k] + c + stem[k + 1 :], stem[:k] + stem[k + 1 :], stem[:k] + c + stem[k:]])] += r.choice([2, 3, 30])
    counts |= {"chained": 2000, "chaimed": 150, "chaimeds": 9, "chaimxds": 2}
    counts |= {"tiedones": 2, "tiedonea": 40, "tiedoneb": 40, "q" * 90: 30, "q" * 89: 2, "q" * 91: 3, "w" * 70: 4}
    words = text_of(counts)
    rows = [(i, " ".join(words[i::300])) for i in range(300)]
    long = "".join(r.choice("abc") for _ in range(100_000))
    return rows + [(400, None), (401, ""), (402, "12 34 \n"), (None, "nullidword nullidword"), (403, f"{long} {long}"), (404, long), (405, "ABSOLUTE Absolute absolute")]


@pytest.mark.parametrize("tile", [variants.TILE, 4])
def test_spelling_variants(spark, cases, monkeypatch, tile):
    monkeypatch.setattr(variants, "TILE", tile)
    docs = spark.createDataFrame([(i, t, "x", 1, "y") for i, t in cases], COLUMNS).repartition(4)
    names = ["form", "root", "n", "n_near", "form_n"]
    rows = variants.spelling_variants(docs).collect()
    got = {r["word"]: tuple(r[c] for c in names) for r in rows}
    wanted = by_hand(cases)
    assert len(rows) == len(got) and got == wanted
    assert len({w[1] for w in wanted.values()}) < len(wanted) and any(got[w][1] != got[w][0] != None for w in got)  # noqa: E711


def test_nothing(spark):
    docs = spark.createDataFrame([(1, None), (2, "short words only")], "doc_id long, text string")
    assert variants.spelling_variants(docs).count() == 0
    assert variants.spelling_variants(docs.limit(0)).count() == 0


def test_rows_of_one_id_count_each(spark):
    docs = spark.createDataFrame([(5, "absolutely")] * 3, "doc_id long, text string")
    assert [(r["n"]) for r in variants.spelling_variants(docs).collect()] == [3]


def test_one_edit():
    r = random.Random(4)
    for _ in range(3000):
        u, v = ("".join(r.choice("ab") for _ in range(r.randint(1, 5))) for _ in range(2))
        assert variants.one_edit(u, v) == one_edit(u, v)
