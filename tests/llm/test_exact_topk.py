from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from wardlens.llm import exact_topk

SCHEMA = "vec_id long, embedding array<float>, label int, block long, state string, ids binary, score long"


def rows(rng, count, dim=6, values=None):
    draw = lambda: rng.choice(values) if values else rng.uniform(-1, 1)
    return [(i, [draw() for _ in range(dim)], 0, 1, "s", b"", 7) for i in range(count)]


def frame(spark, data):
    return spark.createDataFrame(data, SCHEMA).repartition(3)


def brute(df, step, k):
    vectors = []
    for r in df.select("vec_id", "embedding").collect():
        v = r.embedding
        if r.vec_id is not None and v and all(x is not None and math.isfinite(x) for x in v):
            vectors.append((r.vec_id, tuple(math.floor(1024 * x) for x in v)))
    out = []
    for i, v in set(q for q in vectors if q[0] % step == 0):
        scored = sorted((-sum(a * b for a, b in zip(v, w)), j) for j, w in vectors if j != i and len(w) == len(v))
        out += [(i, n + 1, j, -s) for n, (s, j) in enumerate(scored[:k])]
    return sorted(out)


def result(df, step, k=10):
    return sorted(map(tuple, exact_topk.exact_topk(df, F.col("vec_id") % step == 0, k).collect()))


@pytest.mark.parametrize("k", [1, 10, 500])
def test_random_vectors(spark, k):
    df = frame(spark, rows(random.Random(k), 300))
    assert result(df, 50, k) == brute(df, 50, k)


def test_ties_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(exact_topk, "CANDIDATE_BLOCK", 16)
    monkeypatch.setattr(exact_topk, "QUERY_BLOCK", 3)
    df = frame(spark, rows(random.Random(1), 150, dim=2, values=[-0.5, 0.0, 0.5]))
    assert result(df, 10) == brute(df, 10, 10)


def test_edges(spark):
    rng = random.Random(8)
    data = rows(rng, 60) + [(i + 100, v[1][:3], *v[2:]) for i, v in enumerate(rows(rng, 4))]
    bad = [None, [], [None] * 6, [1.0, float("nan")] * 3, [float("inf")] + [0.0] * 5]
    data += [(200 + i, v, 0, 1, "s", b"", 7) for i, v in enumerate(bad)] + [(None, [0.5] * 6, 0, 1, "s", b"", 7)]
    data += [(-40, [0.25] * 6, 0, 1, "s", b"", 7), data[5], data[20], (300, [1e5] + [0.0] * 5, 0, 1, "s", b"", 7)]
    df = frame(spark, data)
    assert result(df, 20) == brute(df, 20, 10)
    assert result(frame(spark, []), 20) == []
    assert result(frame(spark, bad and [(0, bad[0], 0, 1, "s", b"", 7)]), 20) == []


def test_scores_beyond_a_long_are_refused(spark):
    df = frame(spark, [(0, [1e30, 1.0], 0, 1, "s", b"", 7), (1, [1.0, 1.0], 0, 1, "s", b"", 7)])
    with pytest.raises(Exception, match="exceed 64-bit"):
        exact_topk.exact_topk(df, F.col("vec_id") % 100 == 0).collect()


@pytest.mark.parametrize("large", [3e6, 2.5e9, 1e12])
def test_large_components_are_exact(spark, large):
    """A row never meets itself, so its own square may exceed a long."""
    rng = random.Random(4)
    data = [(i, [rng.choice([1.0, -1.0]) * (i % 7), 1.0], 0, 1, "s", b"", 7) for i in range(200)]
    data += [(200, [large, 1.0], 0, 1, "s", b"", 7), (301, [-large / 3, 0.25], 0, 1, "s", b"", 7)]
    if large > 2e9:
        data = [d for d in data if d[0] != 301]
    df = frame(spark, data).withColumn("embedding", F.col("embedding").cast("array<double>"))
    assert result(df, 20) == brute(df, 20, 10)


def test_histograms_are_passed_on_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(exact_topk, "CANDIDATE_BLOCK", 16)
    monkeypatch.setattr(exact_topk, "QUERY_BLOCK", 2)
    monkeypatch.setattr(exact_topk, "HELD_BLOCKS", 2)
    df = frame(spark, rows(random.Random(5), 200, dim=3))
    assert result(df, 10, 4) == brute(df, 10, 4)
