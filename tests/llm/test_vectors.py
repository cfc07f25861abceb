import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from candlewright.llm import ann, embedding_dedup
from candlewright.llm._vectors import cosines

SCHEMA = "vec_id long, embedding array<float>, label int, tile string, id string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, k, "mine", "mine") for i, v, k in rows], SCHEMA)


def good(v):
    return v is not None and len(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)


def odd(dim):
    return [(900, None, 0), (901, [0.0] * dim, 0), (902, [None] + [1.0] * (dim - 1), 0), (903, [float("nan")] * dim, 0), (904, [float("inf")] + [1.0] * (dim - 1), 0), (905, [], 0)]


def spread(n, dim, seed=0):
    return np.random.default_rng(seed).normal(size=(n, dim)).astype(np.float32)


def test_few_vectors_are_all_found(spark):
    x = spread(4, 8)
    rows = [(i, x[i].tolist(), 0) for i in range(4)] + odd(8)
    got = ann.nearest(frame(spark, rows), F.col("vec_id") % 2 == 0, k=5).collect()
    assert sorted((r.query_id, r.rank) for r in got) == [(0, 1), (0, 2), (0, 3), (2, 1), (2, 2), (2, 3)]
    assert ann.nearest(frame(spark, []), F.lit(True)).count() == 0
    assert ann.nearest(frame(spark, odd(8)), F.lit(True)).count() == 0


def test_copies_tie_to_smaller_ids(spark):
    x = spread(1, 16)[0].tolist()
    rows = [(i, x, 0) for i in range(40)] + [(i, v.tolist(), 0) for i, v in enumerate(spread(60, 16, 3), 40)] + [(5, x, 0)]
    got = ann.nearest(frame(spark, rows), F.col("vec_id") == 7, k=5).orderBy("rank").collect()
    assert [r.vec_id for r in got] == [0, 1, 2, 3, 4] and len({r.score for r in got}) == 1


def test_rows_of_one_key_take_one_place(spark, monkeypatch):
    monkeypatch.setattr(ann, "PART", 20)
    x = spread(60, 8, 4)
    near = x[0] + spread(30, 8, 5) * np.float32(0.01)
    rows = [(i, v.tolist(), 0) for i, v in enumerate(x)] * 2  # every row twice
    rows += [(1, v.tolist(), 0) for v in near] + [(2, near[0].tolist(), 0)] * 30  # many near rows of one key, alike and not
    got = ann.nearest(frame(spark, rows), F.col("vec_id") % 10 == 0, k=5).collect()
    for q in range(0, 60, 10):
        best = {}
        for i, v, _ in rows:
            if i != q:
                best[i] = max(best.get(i, -2), cosines(np.array([x[q]], float), np.array([v], float))[0])
        want = sorted(best, key=lambda i: (-best[i], i))[:5]
        assert [r.vec_id for r in sorted(got, key=lambda r: r.rank) if r.query_id == q] == want
    few = [(i, v.tolist(), 0) for i, v in enumerate(x[:6])] + [(1, x[1].tolist(), 0)] * 4
    assert ann.nearest(frame(spark, few), F.col("vec_id") == 0, k=5).count() == 5


def test_crowded_keys_do_not_use_up_a_query(spark, monkeypatch):
    rng = np.random.default_rng(4)
    own, other = rng.normal(size=(8000, 8)), rng.normal(size=(3000, 8)) * 0.01 + np.eye(8)[0]
    few = rng.normal(size=(10, 8)) - 3 * np.eye(8)[0]
    rows = [(0, [*map(float, v)], 0) for v in own] + [(1, [*map(float, v)], 0) for v in other] + [(2 + i, [*map(float, v)], 0) for i, v in enumerate(few)]
    got = ann.nearest(frame(spark, rows), F.col("vec_id") == 0, k=5).orderBy("rank").collect()
    assert len(got) == 5
    # Next to the many rows of key 1 a query must go on until it has met other keys.
    monkeypatch.setattr(ann, "AT_LEAST", 64)
    near = [(100, [*map(float, np.eye(8)[0] + 1e-4)], 0)]
    got = ann.nearest(frame(spark, rows + near), F.col("vec_id") == 100, k=12, share=0.001).orderBy("rank").collect()
    assert [r.rank for r in got] == list(range(1, 13)) and sorted(r.vec_id for r in got) == list(range(12))
    assert got[0].vec_id == 1


def test_sizes_are_searched_apart_and_doubles_stay_doubles(spark):
    x, y = np.random.default_rng(6).normal(size=(12, 8)), np.random.default_rng(7).normal(size=(7, 3))
    y[1] = y[0] * 1e200
    df = spark.createDataFrame([(i, v.tolist(), 0) for i, v in [*enumerate(x), *enumerate(y, 100)]], "vec_id long, embedding array<double>, label int")
    got = ann.nearest(df, F.col("vec_id").isin(0, 100), k=5).orderBy("rank").collect()
    near = {q: [(r.vec_id, r.score) for r in got if r.query_id == q] for q in (0, 100)}
    for q, own, first in ((0, x, 0), (100, y, 100)):
        score = cosines(np.broadcast_to(own[0], own.shape), own / np.abs(own).max(1)[:, None])
        assert len(near[q]) == 5 and 0 not in {i - first for i, _ in near[q]}
        np.testing.assert_allclose([s for _, s in near[q]], np.sort(score[1:])[::-1][:5], rtol=1e-12)
    assert near[100][0][0] == 101
    apart = [(0, [1.0, 0.0], 0), (1, [1.0, 0.203058551], 0), (2, [1.0, -0.203058549], 0)]  # just below and above the threshold
    bar = cosines(np.array([[1.0, 0.0]]), np.array([[1.0, 0.20305855]]))[0]
    linked = embedding_dedup.near_vectors(spark.createDataFrame(apart, df.schema), float(bar)).collect()
    assert {r.vec_id: r.n_links for r in linked} == {0: 1, 1: 0, 2: 1}


def test_recall_and_exact_scores(spark, monkeypatch):
    monkeypatch.setattr(ann, "AT_LEAST", 500)
    x = spread(3000, 32, 5)
    x[1500:] = x[:1500] + spread(1500, 32, 6) * np.float32(0.3)
    df = frame(spark, [(i, v.tolist(), 0) for i, v in enumerate(x)])
    got = ann.nearest(df, F.col("vec_id") % 20 == 0, k=5, share=0.6, leaf=64).toPandas()
    y = x.astype(float)
    hits = total = 0
    for q, part in got.groupby("query_id"):
        scores = cosines(np.broadcast_to(y[q], y.shape), y)
        scores[q] = -2
        bar = np.sort(scores)[-5]
        hits += int((part.score >= bar - 1e-12).sum())
        total += 5
        np.testing.assert_allclose(part.score, scores[part.vec_id], rtol=1e-12)
        assert list(part.sort_values("rank").score) == sorted(part.score, reverse=True)
    assert total == 750 and hits / total >= 0.9


def test_large_leaves_are_dealt_out(spark, monkeypatch):
    monkeypatch.setattr(ann, "PART", 50)
    x = np.repeat(spread(1, 8), 400, axis=0)
    x[200:] += spread(200, 8, 2) * np.float32(0.01)
    got = ann.nearest(frame(spark, [(i, v.tolist(), 0) for i, v in enumerate(x)]), F.col("vec_id") == 100, k=5, leaf=64).orderBy("rank").collect()
    assert [r.vec_id for r in got] == [0, 1, 2, 3, 4]


def brute(rows, threshold):
    n, links, parent = len(rows), [0] * len(rows), list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(n):
        for j in range(i):
            (_, a, p), (_, b, q) = rows[i], rows[j]
            if p is not None and p == q and good(a) and good(b) and len(a) == len(b) and cosines(np.array([a], float), np.array([b], float))[0] >= threshold:
                links[i] += 1
                links[j] += 1
                parent[find(i)] = find(j)
    least = {}
    for i in range(n):
        if rows[i][0] is not None:
            least[find(i)] = min(rows[i][0], least.get(find(i), rows[i][0]))
    return sorted(((rows[i][0], links[i], least.get(find(i)), rows[i][0] is not None and rows[i][0] == least.get(find(i))) for i in range(n)), key=str)


@pytest.mark.parametrize(("limit", "dense"), [(2048, 1500), (6, 1500), (2048, 20)])
def test_links_match_brute_force(spark, monkeypatch, limit, dense):
    monkeypatch.setattr(embedding_dedup, "CELL_ROWS", limit)
    monkeypatch.setattr(embedding_dedup, "DENSE", dense)
    x = spread(30, 16, 8)
    rows = [(i, v.tolist(), i % 3) for i, v in enumerate(x)]
    for k in range(120):
        base = x[k % 4] + spread(1, 16, 100 + k)[0] * np.float32(0.03 * (k % 7))
        rows.append((100 + k, base.tolist(), (k % 4) % 3))
    rows += [(300, x[0].tolist(), 0), (300, x[0].tolist(), 0), (301, (x[0] * 5).tolist(), 0), (302, x[0].tolist(), 1), (303, x[0].tolist(), None), (None, x[0].tolist(), 0), (None, None, 0), (304, [1.0, 2.0], 0), (305, [1.0, 2.0], 0), *odd(16)]
    got = embedding_dedup.near_vectors(frame(spark, rows), 0.98)
    assert got.columns == ["vec_id", "n_links", "component_id", "kept"]
    assert sorted(map(tuple, got.collect()), key=str) == brute([(i, v, k) for i, v, k in rows], 0.98)


def test_no_vectors(spark):
    assert embedding_dedup.near_vectors(frame(spark, [])).count() == 0
    got = embedding_dedup.near_vectors(frame(spark, odd(4))).collect()
    assert len(got) == 6 and all((r.n_links, r.component_id, r.kept) == (0, r.vec_id, True) for r in got)


def test_the_share_is_measured(spark, monkeypatch):
    monkeypatch.setattr(ann, "AT_LEAST", 50)
    near = np.repeat(spread(100, 16, 1) * np.float32(5), 20, axis=0) + spread(2000, 16, 2)
    for x, k in ((near, 5), (spread(2000, 16, 3), 5), (near, 1)):
        forest = ann.Forest(x.astype(float), len(x), leaf=32)
        counts = np.stack([np.bincount(c, minlength=1 << forest.depth) for c in forest.leaves(x.astype(float)).T])
        budget = forest.budget_for(x.astype(float), counts, k)
        y = x / np.linalg.norm(x, axis=1)[:, None]
        hits = 0
        for i in range(0, 2000, 40):
            leaves = forest.search(x[i].astype(float), counts, budget)
            own = forest.leaves(x.astype(float))
            seen = np.zeros(len(x), bool)
            for t, leaf in leaves:
                seen |= own[:, t] == leaf
            order = np.argsort(-(y @ y[i]))
            hits += seen[[j for j in order if j != i][:k]].sum()
        assert hits >= 0.9 * 50 * k
    wide = forest.budget_for(spread(2000, 16, 3).astype(float), counts, 5)
    assert budget < wide
    got = ann.nearest(frame(spark, [(i, v.tolist(), 0) for i, v in enumerate(near)]), F.col("vec_id") % 50 == 0, k=5, leaf=32)
    assert got.count() == 200


@pytest.mark.parametrize("threshold", [1 - 1e-12, 1 - 1e-7, 1 - 1e-5])
def test_thresholds_next_to_one(spark, threshold):
    x = spread(12, 8, 4)
    rows = [(i, v.tolist(), 0) for i, v in enumerate(x)]
    rows += [(100 + i, (v * np.float32(4)).tolist(), 0) for i, v in enumerate(x)]
    rows += [(200 + i, (v + np.float32(1e-4) * (i % 2)).tolist(), 0) for i, v in enumerate(x)]
    got = embedding_dedup.near_vectors(frame(spark, rows), threshold)
    assert sorted(map(tuple, got.collect()), key=str) == brute([(i, v, k) for i, v, k in rows], threshold)


def test_clashing_columns(spark):
    x = spread(30, 8, 9)
    df = frame(spark, [(i, x[i % 20].tolist(), 0) for i in range(30)])
    for name in ("v", "q", "lab", "cid", "n", "h", "_v", "_key", "_label", "cell", "block", "rank", "score", "links", "root"):
        df = df.withColumn(name, F.lit("mine"))
    assert ann.nearest(df, F.col("vec_id") % 10 == 0).count() == 15
    assert embedding_dedup.near_vectors(df).where("n_links = 1").count() == 20
