import random

import numpy as np
import pytest

from airtrace.llm import near_dups
from airtrace.llm.components import components
from airtrace.llm.near_dups import drop_near_copies, most_ones, near_groups, odd_sketch
from tests.llm.helpers import documents, with_clashes


def _sets(texts, k):
    out = []
    for t in texts:
        words = (t or "").encode().lower().split()
        width = min(k, len(words))
        out.append({tuple(words[i : i + width]) for i in range(len(words) - width + 1)} if words else set())
    return out


def _components(ids, texts, k, percent=80):
    sets = _sets(texts, k)
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(ids)):
        for b in range(a):
            shared = len(sets[a] & sets[b])
            if shared and 100 * shared >= percent * len(sets[a] | sets[b]):
                x, y = find(ids[a]), find(ids[b])
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}, {i: len(s) for i, s in zip(ids, sets, strict=True)}


def _drifted(rng, n, words=60, passage=True):
    base = [f"b{i}" for i in range(words)]
    texts = []
    for i in range(n):
        own = [f"o{i}x{j}" for j in range(rng.randint(0, 18))]
        t = list(base) + own if passage else list(base)
        for _ in range(rng.randint(0, 4)):
            t[rng.randrange(len(t))] = f"m{rng.randrange(40)}"
        texts.append(" ".join(t))
    return texts


@pytest.mark.parametrize("k", [2, 5])
def test_components_equal_brute_force(spark, k):
    rng = random.Random(k)
    texts = _drifted(rng, 60) + _drifted(rng, 40, words=9, passage=False)
    texts += ["A b", "a B", "a", "A", None, "", " \t", "x " * 300, "x " * 500, "b a"]
    ids = rng.sample(range(1000), len(texts))
    want, sizes = _components(ids, texts, k)
    got = near_groups(with_clashes(documents(spark, texts, ids)), k=k).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == want
    assert {r["doc_id"]: r["n_shingles"] for r in got} == sizes
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_blocks_and_rounds_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(near_dups, "PAIRS_OF_KEY", 10)
    monkeypatch.setattr(near_dups, "BLOCK_ROWS", 7)
    monkeypatch.setattr(near_dups, "STRAYS", 5)
    rng = random.Random(4)
    texts = _drifted(rng, 90, words=80)
    want, _ = _components(list(range(90)), texts, 2)
    assert len(set(want.values())) > 5
    got = near_groups(documents(spark, texts), k=2).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == want


def test_repeated_null_and_empty(spark):
    docs = documents(spark, ["p q r s t u"] * 3 + ["p q r s t u", "z y x w v u"], [7, 7, 3, None, 9])
    got = sorted(near_groups(docs, k=2).select("doc_id", "component_id", "kept").collect(), key=repr)
    assert [tuple(r) for r in got] == [(3, 3, True), (7, 3, False), (7, 3, False), (9, 9, True), (None, None, True)]
    again = documents(spark, ["p q r s t u", "p q r s t u", None, None], [1, 1, 2, 2])
    assert sorted(r["doc_id"] for r in drop_near_copies(again).collect()) == [1, 2, 2]
    assert near_groups(docs.limit(0)).count() == 0
    assert drop_near_copies(docs.limit(0)).count() == 0


def test_connected_components_of_a_path(spark):
    path = spark.createDataFrame([(i, i + 1) for i in range(50, 90)] + [(5, 5), (8, 2), (2, 8)], "u long, v long")
    assert {(r["u"], r["v"]) for r in components(path).collect()} == {(i, 50) for i in range(51, 91)} | {(8, 2)}


@pytest.mark.parametrize("n", [12, 150, 3000])
def test_sketch_bound_holds_at_the_threshold(n):
    rng = np.random.default_rng(n)
    union = round(n / 0.9)
    shared = -(-union * 8 // 10)
    half = (union - shared) // 2
    for _ in range(200):
        h = rng.integers(0, 1 << 64, union, dtype=np.uint64)
        a, b = np.sort(h[: shared + half]), np.sort(np.concatenate([h[:shared], h[shared + half :]]))
        ones = int(np.bitwise_count((odd_sketch(a) ^ odd_sketch(b)).view(np.uint64)).sum())
        assert ones <= most_ones(len(a), len(b), 80)
