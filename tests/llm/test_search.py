"""Exact search against brute force."""

import numpy as np
import pytest

from factspark.llm import topk


def brute(rows, k, every):
    sound = [
        (i, np.floor(64 * np.array(v, np.float64)).astype(np.int64))
        for i, v in rows
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)
    ]
    out = []
    for place, (query, q) in enumerate(sound):
        if query % every == 0:
            best = sorted((-int(q @ v), i) for p, (i, v) in enumerate(sound) if p != place and len(v) == len(q))[:k]
            out += [(query, rank + 1, i, -score) for rank, (score, i) in enumerate(best)]
    return sorted(out)


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(0, 0.2, 8).tolist()) for i in range(400)]
    rows += [(500 + i, [0.5] * 8) for i in range(120)] + [(500, [0.5] * 8), (1200, [0.1] * 8), (1200, [0.2] * 8)]
    rows += [(700, None), (720, [None] * 8), (740, [float("nan")] * 8), (760, [float("inf")] * 8), (None, [1.0] * 8)]
    rows += [(800, []), (820, [0.1, 0.2]), (840, [0.3, 0.3]), (-20, [0.3, 0.1]), (860, [1e30] * 8)]
    rows += [(1000 + i, (rng.normal(0, 1, 8) * 0.01 + 0.3).tolist()) for i in range(150)]
    rows = [(i, v, "x", 1, "y") for i, v in rows if v is None or i != 860]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, v string, id int, ids string")


@pytest.mark.parametrize(("queries", "block", "pivots", "every"), [(2048, 1 << 14, 128, 20), (3, 50, 12, 7)])
def test_search_equals_brute_force(vectors, monkeypatch, queries, block, pivots, every):
    monkeypatch.setattr(topk, "QUERY_BLOCK", queries)
    monkeypatch.setattr(topk, "VECTOR_BLOCK", block)
    monkeypatch.setattr(topk, "PIVOTS", pivots)
    rows = [(r["vec_id"], r["embedding"]) for r in vectors.collect()]
    assert sorted(tuple(r) for r in topk.top_k(vectors, 5, every).collect()) == brute(rows, 5, every)


def test_vectors_go_only_where_they_can_matter():
    rng = np.random.default_rng(2)
    centres = rng.normal(0, 40, (6, 4))
    data = np.round(np.concatenate([c + rng.normal(0, 1, (200, 4)) for c in centres])).astype(np.int64)
    norm = float((data**2).sum(1).max())
    cells = topk.Cells.of(data[::200], norm)
    cell, distance = cells.nearest(data, False)
    near = {j: sorted(distance[cell == j].tolist())[:6] for j in range(6)}
    query = data[np.argmax((data**2).sum(1))][None, :]
    at, reach = cells.nearest(query, True)
    plan = topk.make_plan(cells, near, {int(at[0]): (1, float(reach[0]))}, 6, len(data))
    needed = (distance >= plan.least[cell, 0]) & (distance <= plan.most[cell, 0])
    best = np.argsort(-topk.products(query, data)[0], kind="stable")[:6]
    assert needed[best].all() and not needed.all()


def test_no_vectors(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert topk.top_k(empty).count() == 0
    one = spark.createDataFrame([(20, [1.0])], "vec_id long, embedding array<float>")
    assert topk.top_k(one).count() == 0


def test_large_scores_are_exact():
    big = np.array([[2**30, 1, 3]], np.int64)
    assert topk.products(big, big)[0, 0] == 2**60 + 10
