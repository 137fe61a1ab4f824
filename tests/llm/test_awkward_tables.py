"""Very long texts, clashing column names and ties, operator by operator."""

from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

from airtrace.llm.exact_dedup import drop_exact_copies, exact_groups
from airtrace.llm.fingerprints import edited_fingerprints
from airtrace.llm.maxent_lm import score_texts
from airtrace.llm.mixing import mix
from airtrace.llm.near_dups import drop_near_copies, near_groups
from airtrace.llm.packing import pack
from airtrace.llm.token_counts import count_all
from tests.llm.helpers import documents, rows, with_clashes

LONG = " ".join(f"w{i % 997}" for i in range(40_000))
#: Names that the operators use for columns of their own.
INNER = ("_row", "_own", "_sha", "_key", "_of", "_marked", "_page", "_map", "_gone", "_again", "_norm", "position", "copy",
         "sequence_id", "component_id", "keep_id", "group_size", "weight", "rank", "spans", "cluster")


def inner(docs):
    return docs.select("*", *[F.lit(f"x-{c}").alias(c) for c in INNER])


@pytest.fixture(scope="module")
def long_docs(spark):
    return documents(spark, [LONG, LONG + " end", "short one here", None, "", LONG], [5, 3, 1, 2, 4, 6])


def test_fingerprints_of_long_texts(long_docs):
    got = {r["doc_id"]: r for r in edited_fingerprints(long_docs).collect()}
    assert got[5]["prints"] == got[6]["prints"] and len(got[5]["prints"]) > 100
    texts = {r["doc_id"]: r["text"] or "" for r in long_docs.collect()}
    order = sorted(texts, reverse=True)
    for at, key in enumerate(order):
        follower = texts[order[(at + 1) % len(order)]]
        cut = len(texts[key]) // 3
        edited = texts[key][: len(texts[key]) - cut] + follower[:cut]
        assert got[key]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
    assert got[6]["near_next"] == 1.0  # the next document, 5, is a copy


def test_near_groups_of_long_texts_and_ties(long_docs):
    got = {r["doc_id"]: (r["component_id"], r["kept"]) for r in near_groups(long_docs, k=5).collect()}
    assert got == {5: (3, False), 3: (3, True), 6: (3, False), 1: (1, True), 2: (2, True), 4: (4, True)}


def test_exact_groups_of_long_texts_and_ties(long_docs):
    got = {r["doc_id"]: (r["keep_id"], r["group_size"]) for r in exact_groups(long_docs).collect()}
    assert got == {5: (5, 2), 6: (5, 2), 3: (3, 1), 1: (1, 1), 2: (2, 2), 4: (2, 2)}


def test_dropping_copies_keeps_columns_of_any_name(long_docs):
    for drop in (drop_exact_copies, drop_near_copies):
        plain, clashing = drop(long_docs), drop(inner(with_clashes(long_docs)))
        assert clashing.columns == inner(with_clashes(long_docs)).columns
        assert rows(clashing.select(*long_docs.columns)) == rows(plain)
        assert {r["_sha"] for r in clashing.collect()} == {"x-_sha"}


def test_mixing_moves_long_texts_whole_and_replaces_its_columns(long_docs):
    got = mix(inner(long_docs), epochs=3.0).collect()
    texts = {r["doc_id"]: r["text"] for r in long_docs.collect()}
    assert got and all(r["text"] == texts[r["doc_id"]] and 0 <= r["position"] < 1 for r in got)


def test_long_texts_are_cut_into_full_pieces(long_docs):
    counts = {r["doc_id"]: r["n_tokens"] for r in count_all(long_docs).select("doc_id", "n_tokens").collect()}
    pieces = {}
    for r in pack(long_docs).select("doc_id", "piece", "length").collect():
        pieces.setdefault(r["doc_id"], []).append((r["piece"], r["length"]))
    for key, found in pieces.items():
        assert sum(n for _, n in found) == counts[key] + 1  # and the end token
        assert all(n == 2048 for p, n in found if p > 0)
    assert len(pieces[5]) > 20


def test_language_model_of_long_texts(spark, long_docs):
    got = {r["doc_id"]: r for r in score_texts(inner(long_docs), F.lit(True)).collect()}
    assert got[5]["n_tokens"] == 40_001 and got[5]["score"] == pytest.approx(got[6]["score"])
    assert got[2]["n_tokens"] == got[4]["n_tokens"] == 1 and got[2]["score"] == got[4]["score"]
