"""VA-file clustering against plain Lloyd rounds."""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
import pytest

from airtrace.llm import vafile
from airtrace.llm.vafile import Bounds, cell_edges, cells_of, cluster_vectors, packed, unpacked
from tests.llm.helpers import rows

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(vectors, dims, scale, k, rounds, seed=1):
    kept = [(i, [math.floor(scale * float(np.float32(c))) for c in v]) for i, v in vectors
            if v is not None and len(v) == dims and all(c is not None and math.isfinite(c) for c in v)]
    if not kept:
        return []

    def key(row):
        return hashlib.sha256(f"{seed}:{'' if row[0] is None else row[0]}".encode()).hexdigest(), row[1]

    x = np.array([v for _, v in kept], dtype=np.int64)
    c = np.array([v for _, v in sorted(kept, key=key)[:k]], dtype=np.int64)

    def assign():
        return np.stack([((x - m) ** 2).sum(axis=1) for m in c], axis=1).argmin(axis=1)

    for _ in range(rounds):
        own = assign()
        c = np.array([[int(s) // int((own == j).sum()) for s in x[own == j].sum(axis=0)] if (own == j).any()
                      else c[j].tolist() for j in range(len(c))])
    own = assign()
    dist = ((x - c[own]) ** 2).sum(axis=1)
    sha = [hashlib.sha256(",".join(map(str, m)).encode()).hexdigest() for m in c.tolist()]
    return sorted(
        ((i, int(a), int(d), int(dist[own == a].sum()), int(dist.sum()), sha[a])
         for (i, _), a, d in zip(kept, own, dist, strict=True)), key=repr)


def made(n, dims, centres, spread, seed=0):
    rng = np.random.default_rng(seed)
    mid = rng.normal(size=(centres, dims))
    return [(i, [float(np.float32(c)) for c in mid[i % centres] + spread * rng.normal(size=dims)]) for i in range(n)]


def frame(spark, vectors):
    return spark.createDataFrame([(i, v, 0) for i, v in vectors], SCHEMA).repartition(3)


@pytest.mark.parametrize("spread", [0.01, 1.0])
def test_equals_plain_rounds(spark, spread):
    vectors = made(300, 8, 5, spread)
    got = cluster_vectors(frame(spark, vectors), dims=8, scale=64, k=6, rounds=3)
    assert rows(got) == plain(vectors, 8, 64, 6, 3)


def test_unusable_repeated_and_null(spark):
    good = made(40, 4, 3, 0.2, seed=2)
    odd = [(100, None), (101, []), (102, [1.0] * 3), (103, [1.0] * 5), (104, [1.0, None, 1.0, 1.0]),
           (105, [float("nan")] + [0.0] * 3), (106, [float("inf")] + [0.0] * 3), (107, [-float("inf")] + [0.0] * 3)]
    again = [(3, good[3][1]), (3, good[5][1]), (None, good[7][1]), (None, good[8][1])] + [(200 + i, good[0][1]) for i in range(30)]
    vectors = good + odd + again
    got = cluster_vectors(frame(spark, vectors), dims=4, scale=64, k=5, rounds=3)
    assert rows(got) == plain(vectors, 4, 64, 5, 3)


def test_ties_go_to_the_smaller_number(spark):
    # copies of few points: centroids coincide or are equally far, clusters stay empty
    points = [[0.0, 0.0], [0.0, 1.0], [1.0, 0.0], [1.0, 1.0], [0.5, 0.5]]
    vectors = [(i, points[i % 5]) for i in range(60)]
    got = cluster_vectors(frame(spark, vectors), dims=2, scale=64, k=9, rounds=3)
    assert rows(got) == plain(vectors, 2, 64, 9, 3)


def test_few_none_and_clashing_columns(spark):
    vectors = made(3, 4, 2, 0.1)
    assert rows(cluster_vectors(frame(spark, vectors), dims=4, k=16)) == plain(vectors, 4, 64, 16, 3)
    empty = cluster_vectors(frame(spark, vectors).limit(0), dims=4)
    assert empty.collect() == [] and empty.columns[:2] == ["vec_id", "cluster"]
    clash = frame(spark, vectors).selectExpr("vec_id", "embedding", "1 AS row", "2 AS x", "3 AS cells", "4 AS cluster")
    assert rows(cluster_vectors(clash, dims=4, k=2)) == plain(vectors, 4, 64, 2, 3)


def test_values_outside_the_sample_and_large_ones(spark, monkeypatch):
    monkeypatch.setattr(vafile, "SAMPLE", 4)
    vectors = made(200, 6, 4, 0.3) + [(999, [3000.0, -3000.0, 0.0, 1.0, 2.0, 3.0])]
    assert rows(cluster_vectors(frame(spark, vectors), dims=6, k=4)) == plain(vectors, 6, 64, 4, 3)
    huge = vectors + [(1000, [1e9] + [0.0] * 5)]
    with pytest.raises(Exception, match="beyond"):
        cluster_vectors(frame(spark, huge), dims=6, k=4).collect()


def test_cells_bound_distances_and_mostly_decide():
    rng = np.random.default_rng(5)
    x = rng.integers(-30, 30, (2000, 64))
    edges = cell_edges(x[:500])
    cells = cells_of(x, edges)
    assert (unpacked(pa.array(packed(cells), pa.binary()), 64) == cells).all()
    assert len(packed(cells)[0]) == 48  # 64 cells of 6 bits
    centroids = x[:16].copy()
    bounds = Bounds.of(centroids, edges)
    place = cells + np.arange(64) * vafile.CELLS
    for c, least, most in zip(centroids, bounds.least, bounds.most, strict=True):
        exact = ((x - c) ** 2).sum(axis=1)
        assert (least[place].sum(axis=1) <= exact).all() and (exact <= most[place].sum(axis=1)).all()
    decided = bounds.decide(cells)
    assert (decided >= 0).mean() > 0.8
    assert (decided[decided >= 0] == bounds.nearest(x)[decided >= 0]).all()


def test_later_rounds_fetch_few_vectors(spark, monkeypatch):
    """After the first round, only open and moved vectors are compared in full."""
    vectors = made(400, 16, 4, 0.02)
    file, fetched, later = [], [], vafile._later_round

    def spy(file_, before, bounds):
        out = later(file_, before, bounds)
        old = {r["row"]: r["cluster"] for r in before.where("row IS NOT NULL").collect()}
        new = {r["row"]: r["cluster"] for r in out.where("row IS NOT NULL").collect()}
        cells = file_.select("row", "cells").toArrow()
        open_ = bounds.decide(unpacked(cells["cells"].combine_chunks(), 16)) < 0
        file.append(len(old) == len(new) == 400)
        fetched.append(int(open_.sum()) + sum(old[r] != new[r] for r in old))
        return out

    monkeypatch.setattr(vafile, "_later_round", spy)
    assert rows(cluster_vectors(frame(spark, vectors), dims=16, k=4)) == plain(vectors, 16, 64, 4, 3)
    assert all(file) and len(fetched) == 2 and max(fetched) < 200
