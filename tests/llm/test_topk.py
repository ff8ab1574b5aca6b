import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from reelhouse.llm import topk

SCHEMA = "vec_id long, embedding array<float>, label int, v string, score int, query_id long, vno int"


def brute(rows, k=5):
    table = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for at, (i, v) in enumerate(table):
        if i is None or i % 50:
            continue
        score = [(-sum(a * b for a, b in zip(v, w)), j is None, j) for pos, (j, w) in enumerate(table) if pos != at]
        out += [(i, r + 1, j, -s) for r, (s, _, j) in enumerate(sorted(score, key=lambda x: (x[0], x[1], x[2] or 0))[:k])]
    return sorted(out, key=str)


def run(spark, rows, **kw):
    table = spark.createDataFrame([(i, v, None, "x", 1, None, 2) for i, v in rows], SCHEMA)
    return sorted((tuple(r) for r in topk.top_k(table, F.col("vec_id") % 50 == 0, **kw).collect()), key=str)


@pytest.mark.parametrize("kw", [{}, {"shard_vectors": 40, "query_rows": 2, "levels": 3}])
def test_matches_brute_force(spark, kw):
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(0, 0.2, 16).tolist()) for i in range(0, 1_200)]
    assert run(spark, rows, **kw) == brute(rows)


def test_copies_ties_and_odd_rows(spark):
    rng = np.random.default_rng(6)
    hot = [0.5, -0.25, 0.125]
    rows = [(i, hot) for i in range(300, 0, -1)] + [(400 + i, rng.normal(0, 0.3, 3).tolist()) for i in range(120)]
    rows += [(50, hot), (50, hot), (None, hot), (None, [9.0, -9.0, 1.0]), (1000, None), (1050, [1.0, None, 2.0]), (1100, [float("nan")] * 3)]
    rows += [(1150, [float("inf"), 0.0, 0.0]), (1200, []), (1250, [0.5]), (1300, [0.1, 0.2, 0.3, 0.4]), (-50, [-0.5, 0.1, 0.0]), (0, [0.0, 0.0, 0.0])]
    for kw in ({}, {"shard_vectors": 9, "query_rows": 3}):
        assert run(spark, rows, **kw) == brute(rows)


def test_fewer_candidates_and_empty_table(spark):
    assert run(spark, [(0, [1.0]), (7, [0.5])]) == [(0, 1, 7, 256 * 128)]
    assert run(spark, [(0, [1.0])]) == [] == run(spark, [])


def test_scores_beyond_a_long_take_no_part(spark):
    assert run(spark, [(0, [1.0]), (7, [1e30]), (8, [0.5])]) == [(0, 1, 8, 256 * 128)]


def test_index_stops_on_proof_and_loses_nothing():
    rng = np.random.default_rng(7)
    centres = rng.normal(0, 32, (10, 64))
    vectors = np.floor(centres[rng.integers(0, 10, 4_000)] + rng.normal(0, 6, (4_000, 64))).astype(np.int64)
    shard = topk.Shard(vectors)
    for q in vectors[:20]:
        able = shard.possible(q, 6)
        score = vectors @ q
        best = np.flatnonzero(score >= np.sort(score)[-6])
        assert len(able) < 4_000 and set(best) <= set(able)
