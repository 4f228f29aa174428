import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidegrid.llm import topk as K

SCHEMA = "vec_id long, embedding array<float>"


def brute(rows, top=20):
    """All inner products of whole numbers, sorted."""
    usable = []
    for place, (i, v) in enumerate(rows):
        if v is not None and all(x is not None and math.isfinite(x) for x in v):
            usable.append((place, i, [math.floor(64 * float(np.float32(x))) for x in v]))
    out = {}
    for place, i, q in usable:
        if i is not None and i % 20 == 0:
            scored = [
                (-sum(a * b for a, b in zip(q, c, strict=True)), math.inf if j is None else j)
                for p, j, c in usable if p != place and len(c) == len(q)
            ]
            out.setdefault(i, []).append([(s, j) for s, j in sorted(scored)[:top]])
    return {i: sorted(found) for i, found in out.items()}


def got(df):
    out = {}
    for r in df.collect():
        out.setdefault(r.query_id, []).append((r.rank, -r.score, math.inf if r.vec_id is None else r.vec_id))
    return {i: sorted(v) for i, v in out.items()}


def flat(want):
    return {i: sorted((rank, s, j) for found in lists for rank, (s, j) in enumerate(found, 1)) for i, lists in want.items() if any(lists)}


def vectors(seed, n=700, dim=6, clusters=5):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(dim)] for _ in range(clusters)]
    rows = [(i, [c + rng.gauss(0, 0.05) for c in rng.choice(centres)]) for i in range(n)]
    rows += [(i, [0.0] * dim) for i in range(n, n + 30)]
    rows += [(i, [0.5] * dim) for i in range(n + 30, n + 60)]
    return rows


@pytest.mark.parametrize("seed", range(2))
def test_search_equals_brute_force(spark, seed):
    rows = vectors(seed)
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    found = K.top_scores(docs, F.col("vec_id") % 20 == 0, candidates=100, queries=7)
    assert got(found) == flat(brute(rows))


def test_odd_vectors(spark):
    rows = [
        (0, [1.0, 2.0]), (0, [1.0, 2.0]), (1, [1.0, None]), (2, None), (3, [float("nan"), 1.0]), (4, [float("inf"), 1.0]),
        (5, [1.0, 2.0]), (None, [1.0, 2.0]), (20, [1.0]), (40, []), (41, []), (60, [-0.001, 0.001]), (7, [2.0, 1.0, 3.0]), (80, [9.0, 9.0, 9.0]),
    ]
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA + ", rank int, _at string")
    found = K.top_scores(docs, F.col("vec_id") % 20 == 0)
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    assert got(found) == flat(brute(rows))
    assert K.top_scores(docs.limit(0), F.lit(True)).count() == 0


def test_fewer_candidates_than_asked_for_and_no_query(spark):
    docs = spark.createDataFrame(vectors(3, n=5)[:8], SCHEMA)
    assert got(K.top_scores(docs, F.col("vec_id") % 20 == 0)) == flat(brute(vectors(3, n=5)[:8]))
    assert K.top_scores(docs, F.lit(None).cast("boolean")).count() == 0


def test_large_components_stay_exact(spark):
    rng = random.Random(2)
    rows = [(i, [rng.choice([-1, 1]) * rng.random() * 2.0**k for k in (0, 20, 24)]) for i in range(100)]
    docs = spark.createDataFrame(rows, SCHEMA)
    assert got(K.top_scores(docs, F.col("vec_id") % 20 == 0)) == flat(brute(rows))
    huge = spark.createDataFrame([(0, [1e300]), (1, [1e300]), (2, [-1e300])], "vec_id long, embedding array<double>")
    scores = {(r.query_id, r.vec_id): r.score for r in K.top_scores(huge, F.col("vec_id") == 0).collect()}
    assert scores == {(0, 1): 2**63 - 1, (0, 2): -(2**63)}


def test_pivots_spare_most_evaluations(monkeypatch):
    rng = np.random.default_rng(0)
    centres = rng.normal(size=(40, 4)) * 400
    content = np.floor(np.repeat(centres, 100, axis=0) + rng.normal(size=(4000, 4)) * 3)
    points = K.choose_pivots(content, 32)
    block = K.Block(np.arange(4000), list(range(4000)), content, points)
    asking = K.Block(np.arange(4000)[::200], list(range(0, 4000, 200)), content[::200], points)
    evaluated = []

    class Counted(np.ndarray):
        def __matmul__(self, other):
            evaluated.append(len(self))
            return np.asarray(self) @ np.asarray(other)

    block.vectors = content.view(Counted)
    monkeypatch.setattr(K, "TOGETHER", 7)
    monkeypatch.setattr(K, "STEP", 64)
    for i, at, best in K.search(asking, block, 20):
        scores = np.asarray(content) @ np.asarray(asking.vectors[i])
        scores[asking.rows[i]] = -np.inf
        assert best.tolist() == sorted(scores.tolist(), reverse=True)[:20]
    assert 0 < sum(evaluated) < 0.5 * 20 * 4000
