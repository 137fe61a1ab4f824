"""Importance resampling against a plain recomputation."""

from __future__ import annotations

import hashlib
import math
import re
import zlib

import numpy as np
import pytest

from airtrace.llm import importance
from airtrace.llm.importance import GramTable, resample, text_grams
from tests.llm.helpers import documents, rows, with_clashes

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def grams(text, n=1):
    words = WORD.findall((text or "").translate(LOWER))
    return words, [" ".join(words[i : i + k]) for k in range(1, n + 1) for i in range(len(words) - k + 1)]


def plain(docs, target, n=1, buckets=10_000, percent=10, least=20, seed=2024):
    """(id, n_features, weight, score, rank) of each (id, text)."""

    def slot(gram):
        return zlib.crc32(gram.encode()) % buckets

    s, t = [0] * buckets, [0] * buckets
    for counts, texts in ((s, [x for _, x in docs]), (t, target)):
        for text in texts:
            for g in grams(text, n)[1]:
                counts[slot(g)] += 1
    gain = [
        math.floor(1000 * math.log((b + 1) * (sum(s) + buckets) / ((a + 1) * (sum(t) + buckets))))
        for a, b in zip(s, t, strict=True)
    ]
    out = []
    for key, text in docs:
        words, found = grams(text, n)
        weight = math.floor(sum(gain[slot(g)] for g in found) / len(found)) if found else 0
        h = int(hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append((key, len(found), weight, score, len(words)))
    order = sorted((o for o in out if o[4] >= least),
                   key=lambda o: (-o[3], o[0] is None, o[0] or 0, o[1], o[2]))
    ranks = {}
    for place, o in enumerate(order[: len(order) * percent // 100]):
        ranks.setdefault(o, []).append(place + 1)
    return sorted(((*o[:4], ranks[o].pop(0) if ranks.get(o) else None) for o in out), key=repr)


TEXTS = [None, "", "   ", "One two THREE", "wörter straße ÉA", "a1-b2_c3", "x " * 30, "alpha beta gamma " * 10,
         "alpha beta gamma " * 10, "delta " * 25, "bench mark words here " * 6, "🙂 smile 🙂 " * 12]
TARGET = ["bench mark words here", "alpha beta", None, ""]


@pytest.fixture(scope="module")
def target(spark):
    return spark.createDataFrame([(i, t) for i, t in enumerate(TARGET)], "item_id long, text string")


@pytest.mark.parametrize("n", [1, 3])
def test_equals_plain_form(spark, target, n):
    ids = [*range(len(TEXTS) - 1), None]
    docs = list(zip(ids, TEXTS, strict=True))
    got = resample(documents(spark, TEXTS, ids), target, n=n, percent=60, least_words=3)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert rows(got) == plain(docs, TARGET, n, percent=60, least=3)


def test_ties_and_repeated_rows(spark, target):
    # equal ids and texts: equal scores, ranks of their own; a draw that ends inside the tie
    docs = [(7, "bench mark words here")] * 5 + [(8, "other text of this corpus")] * 4
    got = resample(documents(spark, [t for _, t in docs], [i for i, _ in docs]), target, percent=40, least_words=1)
    assert rows(got) == plain(docs, TARGET, percent=40, least=1)
    assert sorted(r["rank"] for r in got.collect() if r["rank"]) == [1, 2, 3]


def test_empty_tables_and_clashing_columns(spark, target):
    none = documents(spark, [])
    assert resample(none, target).collect() == []
    docs = documents(spark, TEXTS)
    against_nothing = resample(docs, target.limit(0), percent=50, least_words=2)
    assert rows(against_nothing) == plain(list(enumerate(TEXTS)), [], percent=50, least=2)
    clashing = with_clashes(docs).withColumnRenamed("lang", "rank").withColumnRenamed("source", "weight")
    assert rows(resample(clashing, target, percent=50, least_words=2)) == rows(
        resample(docs, target, percent=50, least_words=2))


def test_long_texts_are_cut_into_pieces_and_blocks(spark, target, monkeypatch):
    rng = np.random.default_rng(3)
    long = " ".join(f"w{i}" for i in rng.integers(0, 500, 60_000)) + " " + "y" * 700_000
    monkeypatch.setattr(importance, "_PIECE", 1000)
    words, expected = grams(long, 3)
    found = list(text_grams(long.encode(), 3))
    assert sum(n for n, _ in found) == len(words)
    assert sorted(g.decode() for _, p in found for g in p) == sorted(expected)
    docs = [(0, long), (1, "short text")]
    got = resample(documents(spark, [t for _, t in docs]), target, n=2, percent=100, least_words=1)
    assert rows(got) == plain(docs, TARGET, 2, percent=100, least=1)


def test_table_tells_apart_what_shares_a_hash(monkeypatch):
    import xxhash

    monkeypatch.setattr(xxhash, "xxh64_intdigest", lambda gram: len(gram) % 3)
    found = [bytes([65 + i % 17]) * (1 + i % 5) for i in range(400)]
    table = GramTable(found, 50)
    by_slot = {}
    for gram, slot in zip(found, table.slot.tolist(), strict=True):
        by_slot.setdefault(slot, set()).add(gram)
    assert all(len(g) == 1 for g in by_slot.values()) and len(by_slot) == len(set(found))
    for slot, (gram,) in by_slot.items():
        assert table.count[slot] == found.count(gram) and table.bucket[slot] == zlib.crc32(gram) % 50
