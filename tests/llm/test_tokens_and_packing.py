import itertools
import random
import zlib

import numpy as np
import pytest

import corpus_pipeline
from airtrace.llm import packing
from airtrace.llm.packing import cut, lay_out, pack, plan_patterns
from airtrace.llm.queries import op8_pack
from airtrace.llm.token_counts import count_all, count_tokens
from airtrace.llm.tokens import vocabulary, vocabulary_path
from tests.llm.helpers import documents, rows, with_clashes

BITS = ["the", " ", "  ", "\n", "\t", "a,", "it's", "<|endoftext|>", "é", "漢字", "123", "don't", ".", "!!", " \n",
        "ing", "😀", "　", "THE", "x" * 40, "​", "ſ", "İ", " of", "ñandú"]


@pytest.fixture(scope="module")
def vocab():
    return vocabulary(vocabulary_path())


def _texts(n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choice(BITS) + " " * rng.randint(0, 1) for _ in range(rng.randint(0, 15))) for _ in range(n)]


def test_counts_and_ids_equal_the_library(vocab):
    for text in _texts(4000, 1):
        ids = vocab.reference.encode(text, add_special_tokens=False).ids
        assert count_tokens(text, vocab) == len(ids)
        assert vocab.ids(text).tolist() == ids


def test_shortcut_words_are_one_token(vocab):
    for word in sorted(vocab.alone)[::500]:
        assert len(vocab.reference.encode(f" {word}", add_special_tokens=False).ids) == 1
    for word in sorted(vocab.alone_and_mark)[::1000]:
        assert len(vocab.reference.encode(f" {word}", add_special_tokens=False).ids) == 2


def test_count_all_edges(spark, vocab):
    docs = with_clashes(documents(spark, [None, "", " ", "Hello world.", "Hello world.", "long " * 50_000], [1, 2, None, 4, 4, 5]))
    got = count_all(docs)
    assert got.columns == [*docs.columns, "n_tokens"]
    assert sorted(r["n_tokens"] for r in got.collect()) == [0, 0, 1, 3, 3, 50_001]
    assert count_all(docs.limit(0)).count() == 0


def test_cut_is_gapless_and_only_the_first_is_short():
    for n in (1, 7, 8, 9, 16, 17, 100):
        pieces = cut(n, 8)
        assert [s for s, _ in pieces] == [0, *itertools.accumulate(l for _, l in pieces)][:-1]
        assert sum(l for _, l in pieces) == n and all(l == 8 for _, l in pieces[1:])
        assert len(pieces) == (1 if n <= 8 else -(-n // 8))


def _optimum(items, capacity):
    """Fewest bins, by search over all partitions (few items)."""
    best = len(items)
    items = sorted(items, reverse=True)

    def place(i, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if i == len(items):
            best = len(bins)
            return
        for b in sorted({x for x in bins if x + items[i] <= capacity}):
            rest = list(bins)
            rest[rest.index(b)] += items[i]
            place(i + 1, rest)
        place(i + 1, [*bins, items[i]])

    place(0, [])
    return best


def test_plans_use_every_piece_once_and_are_near_the_optimum():
    rng = random.Random(3)
    over = 0
    for _ in range(150):
        capacity = rng.choice([10, 20, 37])
        items = [rng.randint(1, capacity) for _ in range(rng.randint(1, 9))]
        counts = {s: items.count(s) for s in items}
        patterns = plan_patterns(counts, capacity)
        used = {}
        for pattern, times in patterns:
            assert times > 0 and sum(s * k for s, k in pattern) <= capacity
            for s, k in pattern:
                used[s] = used.get(s, 0) + k * times
        assert used == counts
        over += sum(t for _, t in patterns) - _optimum(items, capacity)
    assert over <= 4


def test_dominance_never_costs_a_sequence():
    """What the reduction fixes is part of some optimal packing."""
    rng = random.Random(8)
    for _ in range(300):
        capacity = rng.choice([9, 15, 24])
        items = [rng.randint(1, capacity) for _ in range(rng.randint(1, 8))]
        left = np.bincount(items, minlength=capacity + 1)
        found = packing._dominating(left, max(items), capacity)
        if found is None:
            continue
        rest = list(items)
        for s in (max(items), *found[0]):
            rest.remove(s)
        assert 1 + (_optimum(rest, capacity) if rest else 0) == _optimum(items, capacity)


def _least_sequences(counts, capacity):
    """The bound L2: large pieces stand apart, small ones fill their rest."""
    size = np.arange(capacity + 1)
    n = np.zeros(capacity + 1)
    for s, k in counts.items():
        n[s] = k
    best = 0.0
    for a in range(capacity // 2 + 1):
        large, middle = size > capacity - a, (size <= capacity - a) & (size > capacity / 2)
        small = (size <= capacity / 2) & (size >= a)
        rest = n[middle].sum() * capacity - (n * size)[middle].sum()
        best = max(best, n[large].sum() + n[middle].sum() + max(0.0, ((n * size)[small].sum() - rest) / capacity))
    return best


def test_large_counts_stay_few_patterns():
    rng = random.Random(5)
    counts = {s: rng.randint(1, 10**9) for s in range(1, 2049)}
    patterns = plan_patterns(counts)
    assert sum(t for _, t in patterns) <= 1.001 * _least_sequences(counts, 2048) + 1
    assert len(lay_out(patterns)[0]) < 50_000


def test_pack_round_trip(spark, vocab):
    rng = random.Random(2)
    texts = [" ".join(rng.choice(["the", "cat", "ñandú", "xyzzyq", "of"]) for _ in range(rng.randint(0, 90))) for _ in range(60)]
    texts += [None, "", "word " * 700, texts[5]]
    ids = [*range(62), None, 5]
    got = pack(with_clashes(documents(spark, texts, ids)), capacity=64, with_ids=True).collect()
    want = []
    for i, t in zip(ids, texts, strict=True):
        tokens = np.array([*vocab.reference.encode(t or "", add_special_tokens=False).ids, 0], dtype="<u4")
        want += [(i, k, s, n, zlib.crc32(tokens[s : s + n].tobytes())) for k, (s, n) in enumerate(cut(len(tokens), 64))]
    assert sorted(((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got), key=repr) == sorted(want, key=repr)
    at = {}
    for r in got:
        assert len(r["ids"]) == 4 * r["length"] and zlib.crc32(r["ids"]) == r["ids_crc32"]
        at.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in at.values():
        places.sort()
        assert [o for o, _ in places] == [0, *itertools.accumulate(n for _, n in places)][:-1]
        assert sum(n for _, n in places) <= 64
    assert len(at) <= -(-sum(r["length"] for r in got) // 64) + 1


def test_pack_empty_table(spark):
    assert rows(pack(documents(spark, []))) == []


def test_queries_pack_the_ids_themselves(spark, tmp_path):
    """op8_pack and the pipeline's last stage take the digest of packed ids."""
    docs = documents(spark, ["some words " * 900, "short", "", None, "short"], [1, 2, 3, None, 2])
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    want = rows(pack(docs))
    for got in (op8_pack(spark, str(tmp_path)), corpus_pipeline.packing(spark, docs, "")):
        assert "crc32(ids" in got._jdf.queryExecution().optimizedPlan().toString()
        assert got.columns == pack(docs).columns and rows(got) == want
