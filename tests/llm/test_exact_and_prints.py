import hashlib
import re

from pyspark.sql import functions as F

from airtrace.llm.exact_dedup import drop_exact_copies, exact_groups
from airtrace.llm.fingerprints import digest, edited_fingerprints, fingerprint
from tests.llm.helpers import documents, rows, with_clashes

TEXTS = ["a b  c", "abc", None, "", " \t\n", "ab c", "x" * 5000 + " y", "x" * 5000 + "y", "Abc", "é f", "é  f"]


def _expected(ids, texts):
    norm = [re.sub(r"[\x20\x09-\x0d]", "", t or "") for t in texts]
    out = []
    for i, n in zip(ids, norm, strict=True):
        same = [(-len(t or ""), j is None, j if j is not None else 0) for j, m, t in zip(ids, norm, texts, strict=True) if m == n]
        best = min(same)
        keep = None if best[1] else best[2]
        out.append((i, keep, len(same), i == keep, hashlib.sha256(n.encode()).hexdigest()))
    return sorted(out, key=repr)


def test_exact_groups_brute_force(spark):
    ids = [5, 3, 9, 1, None, 4, 7, 8, 2, 6, 10]
    for bits in (24, 15, 3):  # a small bitmap only hashes more
        got = exact_groups(with_clashes(documents(spark, TEXTS, ids)), hash_all=True, bits=bits)
        assert rows(got) == _expected(ids, TEXTS)


def test_exact_hash_only_for_survivors(spark):
    got = exact_groups(documents(spark, ["one", "two!", "three", "one "]))
    assert {r["doc_id"]: r["text_sha256"] is None for r in got.collect()} == {0: False, 1: True, 2: True, 3: False}


def test_exact_repeated_rows_and_empty_table(spark):
    docs = documents(spark, ["a", "a", "a ", "b", "c"], [1, 1, 2, 3, 3])
    flags = exact_groups(docs)
    assert [(r["doc_id"], r["keep_id"], r["group_size"]) for r in flags.orderBy("doc_id", "group_size").collect()] == [
        (1, 2, 3), (1, 2, 3), (2, 2, 3), (3, 3, 1), (3, 3, 1)]
    kept = drop_exact_copies(documents(spark, ["a", "a", "b", "b", None, ""], [1, 1, 2, 3, 4, 5]))
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 2, 4]
    assert kept.columns == docs.columns
    assert exact_groups(docs.limit(0), hash_all=True).count() == 0
    assert drop_exact_copies(docs.limit(0)).count() == 0


def test_winnowing_windows_and_ties(spark):
    words = [f"w{i % 7}" for i in range(60)] + ["same"] * 12
    df = fingerprint(with_clashes(documents(spark, [" ".join(words), "a b", "", None, "one"])), out="p")
    hashes = df.where("doc_id = 0").select(
        F.expr("transform(sequence(0, size(split(text, ' ')) - 3), i -> xxhash64(split(text, ' ')[i], split(text, ' ')[i+1], split(text, ' ')[i+2]))")
    ).first()[0]
    chosen = set()
    for j in range(len(hashes) - 3):
        window = hashes[j : j + 4]
        chosen.add(j + max(i for i in range(4) if window[i] == min(window)))
    got = {r["doc_id"]: r["p"] for r in df.collect()}
    assert [(p["hash"], p["pos"]) for p in got[0]] == [(hashes[i], i) for i in sorted(chosen)]
    assert [len(got[i]) for i in (1, 2, 3, 4)] == [1, 0, 0, 1]


def test_shared_passage_is_found(spark):
    passage = " ".join(f"p{i}" for i in range(6))  # w + k - 1 tokens
    df = fingerprint(documents(spark, [f"a b c d {passage} e f", f"q {passage} r s t u v w"]), out="p")
    one, two = ({p["hash"] for p in r["p"]} for r in df.orderBy("doc_id").collect())
    assert one & two


def test_edited_fingerprints_brute_force(spark):
    texts = [" ".join(f"w{(i * 7 + j) % 50}" for j in range(5 + 3 * i)) for i in range(40)]
    texts[3], texts[5], texts[8] = None, "", "é" * 7
    ids = [i * 3 for i in range(40)]
    got = {r["doc_id"]: r for r in edited_fingerprints(with_clashes(documents(spark, texts, ids)), buckets=5).collect()}
    order = sorted(zip(ids, texts, strict=True), reverse=True)
    for at, (i, text) in enumerate(order):
        text, after = text or "", order[(at + 1) % len(order)][1] or ""
        cut = len(text) // 3
        edited = text[: len(text) - cut] + after[:cut]
        assert got[i]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert got[i]["n_chars"] == len(text)
        assert 0 <= got[i]["near_edited"] <= 1 and 0 <= got[i]["near_next"] <= 1
        if edited == text:
            assert got[i]["near_edited"] == 1 and got[i]["prints"] == got[i]["edited_prints"]
        own = {p["hash"] for p in got[i]["prints"]}
        other = {p["hash"] for p in got[order[(at + 1) % len(order)][0]]["prints"]}
        assert got[i]["near_next"] == (len(own & other) / len(own | other) if own | other else 1)


def test_edited_fingerprints_edges(spark):
    docs = documents(spark, ["same text here"] * 3 + ["lonely words without id"], [4, 4, 2, None])
    got = edited_fingerprints(docs).withColumn("f", F.expr(digest("prints")))
    out = [(r["doc_id"], r["near_next"], r["f"]) for r in got.collect()]
    assert sorted(o[1] for o in out if o[0] is not None) == [1, 1, 1]
    assert len({o[2] for o in out if o[0] is not None}) == 1
    assert [o[1] for o in out if o[0] is None] == [0]
    assert edited_fingerprints(docs.limit(0)).count() == 0
    assert edited_fingerprints(documents(spark, ["only one row"])).first()["near_next"] == 1
