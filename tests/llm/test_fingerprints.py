"""Fingerprints against the same hashes in plain Python, and the search against all pairs."""

import math
import random
import re
from hashlib import sha256

import pytest
import xxhash
from evenframe.llm import fingerprints
from pyspark.sql import functions as F

COLUMNS = "doc_id long, text string, hi string, bucket int, n_near int"


def simhash(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if c.isascii() else c for c in text))
    shingles = [words[i : i + 5] for i in range(max(1, len(words) - 4))] if words else []
    value = 0
    for seed in ([], [(1).to_bytes(4, "little")]):
        votes = [0] * 64
        for shingle in shingles:
            h = 42
            for part in [*seed, *(w.encode() for w in shingle)]:
                h = xxhash.xxh64_intdigest(part, h)
            votes = [v + (h >> b & 1) for b, v in enumerate(votes)]
        value = value << 64 | sum(1 << b for b in range(64) if 2 * votes[b] > len(shingles))
    return value


def likeness(a, b):
    return max(0.0, math.cos(math.pi * (a ^ b).bit_count() / 128))


def by_hand(rows):
    texts = [t or "" for _, t in rows]
    out = {}
    for k, (i, _) in enumerate(rows):
        text, after = texts[k], texts[(k + 1) % len(rows)]
        third = len(text) // 3
        edited = text[: len(text) - third] + after[:third]
        own, other, following = simhash(text), simhash(edited), simhash(after)
        digest = sha256(edited.encode()).hexdigest()
        out[i] = (len(text), digest, f"{own:032x}", f"{other:032x}", likeness(own, other), likeness(own, following))
    return out


@pytest.fixture
def cases():
    r = random.Random(5)
    words = "ab Cde fgh ÉÈ lmn opq 😀 uvw xyz".split()
    rows = [(i * 7 % 211, " ".join(r.choice(words) + str(r.randint(0, 30)) for _ in range(r.randint(0, 60)))) for i in range(211)]
    extra = [(300, None), (301, ""), (302, " \t\n"), (303, "one"), (304, "one two three four"), (305, "x " * 60_000), (306, rows[0][1]), (-5, "last of all of them")]
    return sorted(rows + extra, reverse=True, key=lambda row: row[0])


def test_document_fingerprints(spark, cases):
    docs = spark.createDataFrame([(i, t, "x", 1, 2) for i, t in cases], COLUMNS).repartition(5)
    names = ["n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    rows = fingerprints.document_fingerprints(docs, every=10).collect()
    wanted = by_hand(cases)
    assert len(rows) == len(wanted)
    prints = [int(w[2], 16) for w in wanted.values()]
    for row in rows:
        assert tuple(row[c] for c in names) == pytest.approx(wanted[row["doc_id"]], abs=1e-12)
        near = sum((int(row["fingerprint"], 16) ^ p).bit_count() <= 3 for p in prints) - 1
        assert row["n_near"] == (near if row["doc_id"] % 10 == 0 else None)


@pytest.mark.parametrize("rows", [[], [(1, "alone in the world")], [(None, "no id"), (2, None)], [(2**62, "a b"), (2**62 + 1, "c d"), (-(2**63), "e f")]])
def test_few_documents(spark, rows):
    got = {r["doc_id"]: tuple(r)[1:7] for r in fingerprints.document_fingerprints(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    ordered = sorted(rows, key=lambda row: (row[0] is None, -(row[0] or 0)))
    wanted = by_hand(ordered) if rows else {}
    assert set(got) == set(wanted)
    for i, values in wanted.items():
        assert got[i] == pytest.approx(values, abs=1e-12)


def test_rows_of_one_id_follow_each_other(spark):
    docs = spark.createDataFrame([(3, "b b b"), (3, "a a a"), (3, "a a a"), (1, "z z z")], "doc_id long, text string")
    got = sorted((r["doc_id"], r["edited_sha256"]) for r in fingerprints.document_fingerprints(docs).collect())
    wanted = [(3, "a a " + "a"), (3, "a a " + "b"), (3, "b b " + "z"), (1, "z z " + "a")]
    assert got == sorted((i, sha256(t.encode()).hexdigest()) for i, t in wanted)


@pytest.mark.parametrize("radius, blocks", [(0, 1), (3, 4), (3, 6), (5, 7)])
def test_near_fingerprints_finds_all(spark, radius, blocks):
    r = random.Random(radius)
    base = [r.getrandbits(128) for _ in range(40)]
    values = base + [b ^ sum(1 << bit for bit in r.sample(range(128), r.randint(0, 7))) for b in base for _ in range(6)]
    values += values[:30]

    def signed(x):
        return x - 2**64 if x >= 2**63 else x

    frame = spark.createDataFrame([(signed(v >> 64), signed(v % 2**64)) for v in values], "hi long, lo long")
    asked = frame.where(F.pmod("lo", F.lit(3)) == 0)
    got = {((r["hi"] % 2**64) << 64 | r["lo"] % 2**64): r["n_near"] for r in fingerprints.near_fingerprints(asked, frame, radius, blocks).collect()}
    queries = {v for v in values if signed(v % 2**64) % 3 == 0}
    assert got == {q: sum((q ^ v).bit_count() <= radius for v in values) for q in queries}


def test_radius_needs_blocks():
    with pytest.raises(ValueError):
        fingerprints._tables(4, 4)
