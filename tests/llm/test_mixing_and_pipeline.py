import os

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from airtrace.llm.common import load
from airtrace.llm.mixing import mix, poisson_sql, replication_rates, target_weights
from airtrace.llm.queries import ORACLES, QUERIES
from tests.conftest import SF_SMALL
from tests.llm.helpers import documents, rows, with_clashes


def test_poisson_inverse(spark):
    import math

    df = spark.range(20_000).select((F.col("id") / 20_000).alias("u"))
    for rate in (0.0, 0.3, 1.0, 7.5, 60.0):
        got = df.select("u", F.expr(poisson_sql(f"{rate}D", "u")).alias("n")).collect()
        if not rate:
            assert {r["n"] for r in got} == {0}
            continue
        assert abs(sum(r["n"] for r in got) / len(got) - rate) < 0.01 * max(1, rate)
        cdf, p, table = 0.0, math.exp(-rate), []
        for k in range(200):
            cdf += p
            table.append(cdf)
            p *= rate / (k + 1)
        assert got[0]["n"] == 0  # u = 0 lies below any positive probability
        for r in got[1::997]:
            assert r["n"] == next(k for k, c in enumerate(table) if c > r["u"] + 1e-12)


def test_poisson_of_large_means(spark):
    df = spark.range(2000).select(((F.col("id") + 0.5) / 2000).alias("u"))
    for rate in (499.0, 501.0, 5000.0, 80000.0):
        n = [r["n"] for r in df.select(F.expr(poisson_sql(f"{rate}D", "u")).alias("n")).collect()]
        mean = sum(n) / len(n)
        spread = (sum((x - mean) ** 2 for x in n) / len(n)) ** 0.5
        assert abs(mean - rate) < 0.02 * rate**0.5 + 0.1 and abs(spread / rate**0.5 - 1) < 0.02


def test_mix_reaches_the_weights_and_repeats_itself(spark):
    docs = documents(spark, [f"text {i}" for i in range(4000)], source=["big" if i % 4 else "small" for i in range(4000)])
    weights = spark.createDataFrame([("big", 1.0), ("small", 3.0), ("none", 5.0)], "source string, weight double")
    wanted = weights.where("source != 'none'")
    got = mix(with_clashes(docs), wanted, epochs=2.0)
    share = {r["source"]: r["count"] for r in got.groupBy("source").count().collect()}
    assert abs(share["small"] / (share["small"] + share["big"]) - 0.75) < 0.02
    assert abs(sum(share.values()) - 8000) < 400
    assert rows(got.select("doc_id", "copy", "position")) == rows(mix(docs, wanted, epochs=2.0).select("doc_id", "copy", "position"))
    places = [r["position"] for r in got.collect()]
    assert places == sorted(places)


def test_mix_edges(spark):
    docs = documents(spark, ["a", "b", None, "a"], [1, 2, 3, 1], source=[None, "x", None, None])
    rates = {r["source"]: r["rate"] for r in replication_rates(docs, target_weights(docs), epochs=8.0).collect()}
    assert set(rates) == {None, "x"} and all(r > 0 for r in rates.values())
    got = mix(docs, epochs=40.0)
    n = {r["doc_id"]: r["count"] for r in got.groupBy("doc_id").count().collect()}
    assert set(n) == {1, 2, 3} and n[1] % 2 == 0  # rows that repeat an id draw alike
    assert mix(docs.limit(0)).count() == 0
    nothing = spark.createDataFrame([("x", -1.0)], "source string, weight double")
    assert mix(docs, nothing).count() == 0


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("documents", "labels", "benchmark", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_its_sql(spark, duck, name):
    got = QUERIES[name](spark, SF_SMALL)
    cols = sorted(got.columns)
    res = duck.execute(ORACLES[name])
    order = [d[0] for d in res.description]
    assert sorted(order) == cols
    want = [tuple(r[order.index(c)] for c in cols) for r in res.fetchall()]
    assert rows(got.select(*cols)) == sorted(want, key=repr)


def test_each_operator_has_its_query():
    names = [n.split("_")[0] for n in QUERIES]
    assert [f"op{i}" for i in range(1, 14)] == sorted(names, key=lambda n: int(n[2:]))


def test_pipeline_stages(spark):
    docs = load(spark, SF_SMALL, "documents")
    columns, ids, texts = docs.columns, set(), {}
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "near_dedup", "mix_sources", "packing"]
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    ids, before = set(texts), set(texts)
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.write_through(stage(spark, docs, SF_SMALL), f"test-{name}")
        now = {r["doc_id"] for r in docs.select("doc_id").distinct().collect()}
        assert now <= before
        if name != "packing":
            assert docs.columns == columns
            assert all(texts[r["doc_id"]] == r["text"] for r in docs.collect())
        if name == "exact_dedup":
            assert len({"".join(texts[i].split()) for i in now}) == len(now) == len({"".join(texts[i].split()) for i in before})
        if name == "packing":
            assert now == before
        before = now
    assert docs.groupBy("sequence_id").agg(F.sum("length").alias("n")).agg(F.max("n")).first()[0] <= 2048
    assert os.path.exists(SF_SMALL) and before <= ids


def test_stages_on_an_empty_table(spark):
    docs = load(spark, SF_SMALL, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF_SMALL).count() == 0


def test_stages_on_awkward_rows(spark):
    """Nulls in every column, empty and long texts, ties, repeated rows, clashing names."""
    words = " ".join(f"w{i}" for i in range(60_000))
    texts = [None, "", " ", "same words here today again", "same words here today again", "Same  words here today again",
             words, words + " end", "x" * 300_000, None]
    ids = [1, 2, 3, 4, 5, 5, 6, 7, 8, None]
    docs = documents(spark, texts, ids, lang=[None] * 10, source=[None] * 5 + ["a"] * 5).withColumns(
        {c: F.lit(f"x-{c}") for c in ("_sha", "_own", "_row", "_gone", "_of", "_key", "_marked", "_page", "n", "kept")})
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF_SMALL)
        if name == "packing":
            assert {r["doc_id"] for r in out.select("doc_id").collect()} == {r["doc_id"] for r in docs.select("doc_id").collect()}
            break
        assert out.columns == docs.columns
        kept = sorted([(r["doc_id"], r["text"]) for r in out.collect()], key=repr)
        given = sorted(zip(ids, texts, strict=True), key=repr)
        if name == "toxicity":
            assert all(k in given for k in kept)
        if name == "exact_dedup":  # of equal texts the longest, then the smallest id
            assert kept == sorted([(3, " "), (4, texts[3]), (5, texts[5]), (6, words), (7, texts[7]), (8, texts[8])], key=repr)
        if name == "near_dedup":  # rows without words stay
            assert kept == sorted([(1, None), (2, ""), (3, " "), (None, None), (4, texts[3]), (6, words),
                                   (8, texts[8])], key=repr)
        if name == "mix_sources":
            assert all(k in given for k in kept)
