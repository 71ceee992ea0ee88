"""Projected nearest neighbours: recall against brute force, and exactness where the index must be exact."""
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from appraise.llm import neighbours as nb
from conftest import SMALL

COLUMNS = ["query_id", "rank", "vec_id", "score"]


def usable(rows):
    rows = [(i, np.array(v, np.float64)) for i, v in rows
            if v is not None and len(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    lengths = [len(v) for _, v in rows]
    common = min(set(lengths), key=lambda n: (-lengths.count(n), n), default=0)
    return [r for r in rows if len(r[1]) == common]


def brute(rows, every, k=10):
    rows, out = usable(rows), []
    for q, (i, v) in enumerate(rows):
        if i is not None and i % every == 0:
            near = sorted((float(np.sqrt(((w - v) ** 2).sum())), j is None, j or 0) for p, (j, w) in enumerate(rows) if p != q)
            out.append((i, [(s, None if none else j) for s, none, j in near[:k]]))
    return out


def lists(df):
    assert df.columns == COLUMNS
    out = {}
    for r in df.collect():
        out.setdefault(r.query_id, []).append((r["rank"], r.score, r.vec_id))
    return {q: sorted(v) for q, v in out.items()}


def recall(got, want):
    hits = total = 0
    for q, near in want:
        assert [r for r, _, _ in got[q]] == list(range(1, len(near) + 1))
        worst = near[-1][0] if near else 0
        hits += sum(s <= worst * (1 + 1e-12) for _, s, _ in got[q])
        total += len(near)
    return hits / total


def test_quantile():
    assert nb.chi_square_quantile(.95, 2) == pytest.approx(-2 * math.log(.05))
    assert nb.chi_square_quantile(.9, 8) == pytest.approx(13.3616, abs=1e-4)


def test_whole_query(spark):
    base = "/root/testdata/sf0.1"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{base}/embeddings.parquet").collect()]
    got, want = lists(nb.op11_projected_neighbours(spark, base)), brute(rows, 100)
    assert set(got) == {q for q, _ in want}
    assert recall(got, want) >= .9
    vectors = {i: np.array(v, np.float64) for i, v in rows if v is not None}
    for q, found in got.items():
        scores = [s for _, s, _ in found]
        assert scores == sorted(scores) and q not in [v for _, _, v in found]
        for _, s, v in found:
            assert s == pytest.approx(np.sqrt(((vectors[q] - vectors[v]) ** 2).sum()), rel=1e-14)


def made(n, length=24, seed=1):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((12, length)) * 3
    return [(i, (centres[rng.integers(12)] + rng.standard_normal(length)).tolist()) for i in range(n)]


def test_many_blocks_and_visitors(spark):
    rows = made(3000)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    got = lists(nb.nearest(df, F.col("id") % 20 == 0, block=150, leaf=16, visitors=7))
    assert recall(got, brute(rows, 20)) >= .95


def test_near_certain_confidence_is_exact(spark):
    rows = made(800, 6)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = lists(nb.nearest(df, F.col("id") % 40 == 0, k=5, confidence=1 - 1e-12, block=100, leaf=8))
    for q, near in brute(rows, 40, 5):
        assert [v for _, _, v in got[q]] == [v for _, v in near]


def test_ties_copies_and_unusable(spark):
    rng = np.random.default_rng(4)
    same = [1.0, 0.0, 2.0, 0.5]
    rows = [(i, same) for i in range(0, 400)] + [(100, same), (100, same), (None, same)]
    rows += [(1000 + i, rng.standard_normal(4).tolist()) for i in range(50)]
    rows += [(2000, None), (2001, []), (2100, [0.0] * 4), (2200, [1.0, None, 2.0, 3.0]), (2300, [1.0, float("nan"), 0.0, 1.0]),
             (2400, [1.0, float("inf"), 0.0, 1.0]), (2500, [1.0, 2.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5)
    for name in ("id", "vec", "h", "class", "cell", "place", "y", "ids", "isq", "rank", "score", "query"):
        df = df.withColumn(name, F.lit("other"))
    got = nb.nearest(df, F.col("id") % 100 == 0, block=64).collect()
    want = brute(rows, 100)
    assert len(got) == sum(len(n) for _, n in want)
    by = {}
    for r in got:
        by.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    for q, near in want:
        times = len(by[q]) // 10
        assert sorted(by[q]) == sorted((k + 1, v, s) for k, (s, v) in enumerate(near) for _ in range(times)) or q >= 1000


def test_few_rows_and_empty(spark):
    schema = "vec_id long, embedding array<float>"
    assert nb.nearest(spark.createDataFrame([], schema), F.col("id") % 100 == 0).collect() == []
    one = spark.createDataFrame([(0, [1.0, 2.0])], schema)
    assert nb.nearest(one, F.col("id") % 100 == 0).collect() == []
    three = spark.createDataFrame([(0, [1.0, 2.0]), (1, [1.0, 2.0]), (2, [4.0, 6.0])], schema)
    assert [tuple(r) for r in nb.nearest(three, F.col("id") == 0).orderBy("rank").collect()] == [(0, 1, 1, 0.0), (0, 2, 2, 5.0)]
    many = made(6, 1200)
    got = lists(nb.nearest(spark.createDataFrame(many, "vec_id long, embedding array<double>"), F.col("id") == 0))
    assert len(got[0]) == 5
