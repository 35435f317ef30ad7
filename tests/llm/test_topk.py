"""Exact top-k against brute force."""

import numpy as np
import pytest

from playbill.llm import topk


def brute(rows, k, every):
    good = [(i, np.floor(np.array(v) * 256).astype(np.int64)) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    queries = {}
    for i, v in good:
        if i % every == 0 and (i not in queries or v.astype(float).tobytes() < queries[i].astype(float).tobytes()):
            queries[i] = v
    out = set()
    for q, v in queries.items():
        scores = sorted((-int(v @ c), i) for i, c in good if i != q and len(c) == len(v))[:k]
        out |= {(q, n + 1, i, -s) for n, (s, i) in enumerate(scores)}
    return out


@pytest.mark.parametrize(("scale", "bins", "block"), [(1.0, 256, 4096), (0.01, 8, 30), (1e6, 256, 4096)])
def test_agrees_with_brute_force(spark, monkeypatch, scale, bins, block):
    """Many ties, several blocks, and numbers whose sums pass 2^53."""
    monkeypatch.setattr(topk, "BINS", bins)
    monkeypatch.setattr(topk, "CANDIDATE_BLOCK", block)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 5)
    draw = np.random.default_rng(3)
    rows = [(i, (draw.normal(size=6) * scale).round(9).tolist()) for i in range(300)]
    rows += [(i, rows[7][1]) for i in range(300, 340)]
    rows += [(400, None), (401, []), (450, [1.0] * 5 + [float("nan")]), (500, [None] + [1.0] * 5), (None, rows[3][1]), (550, [1.0, 2.0]), (551, [0.5, 0.5])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 AS dim", "2 AS data", "3 AS rank")
    got = topk.top_k(df)
    assert {tuple(r) for r in got.collect()} == brute(rows, 5, 50)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]


def test_few_and_none(spark):
    rows = [(0, [1.0, 0.0]), (1, [0.5, 0.5]), (50, [0.0, -1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert {tuple(r) for r in topk.top_k(df).collect()} == brute(rows, 5, 50)
    assert topk.top_k(df.limit(0)).count() == 0
    assert topk.top_k(df.where("vec_id = 0")).count() == 0
