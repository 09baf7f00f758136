"""The exact-split forest against a plain recursive one."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from newsrisk.functions.draws import POISSON_CDF, poisson, uniform
from newsrisk.operators import forest as FO


def plain_tree(x, y, w, depth=0, max_depth=None):
    """(feature, threshold, left, right) or the leaf's value, every split tried."""
    value = int(np.dot(w, y)) / int(w.sum()) / FO.TARGET_SCALE
    best = None
    if len(set(y.tolist())) > 1 and (max_depth is None or depth < max_depth):
        for f in range(x.shape[1]):
            levels = sorted(set(x[:, f].tolist()))
            for a, b in zip(levels, levels[1:]):
                m = x[:, f] <= a
                lw, ls = int(w[m].sum()), int(np.dot(w[m], y[m]))
                rw, rs = int(w[~m].sum()), int(np.dot(w[~m], y[~m]))
                score = float(ls) ** 2 / lw + float(rs) ** 2 / rw
                if best is None or score > best[0]:
                    mid = a + (b - a) / 2
                    best = (score, f, mid if mid < b else a)
    if best is None:
        return value
    m = x[:, best[1]] <= best[2]
    return (best[1], best[2], plain_tree(x[m], y[m], w[m], depth + 1, max_depth), plain_tree(x[~m], y[~m], w[~m], depth + 1, max_depth))


def plain_value(tree, row):
    while isinstance(tree, tuple):
        tree = tree[2] if row[tree[0]] <= tree[1] else tree[3]
    return tree


def as_tuple(t, i=0):
    if t["feature"][i] < 0:
        return t["value"][i]
    return (int(t["feature"][i]), float(t["threshold"][i]), as_tuple(t, t["left"][i]), as_tuple(t, t["left"][i] + 1))


def draw(*parts):
    return (int(hashlib.md5(":".join(map(str, parts)).encode()).hexdigest()[:8], 16) + 0.5) / 2**32


def test_draws(spark):
    df = spark.range(2000).select("id", uniform(7, F.col("id"), F.lit(None)).alias("u"), poisson(7, F.col("id")).alias("w"))
    rows = df.collect()
    assert all(r.u == draw(7, r.id, "") and r.w == sum(draw(7, r.id) >= c for c in POISSON_CDF) for r in rows)
    assert np.mean([r.w for r in rows]) == pytest.approx(1.0, abs=0.08) and max(r.w for r in rows) >= 4
    p = np.exp(-1.0) / np.cumprod([1.0, *range(1, 13)])
    assert np.cumsum(p) == pytest.approx(POISSON_CDF, abs=1e-13)


@pytest.mark.parametrize("levels, max_depth", [(None, None), (4, None), (None, 3)])
def test_kernel_against_the_plain_tree(levels, max_depth):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(90, 4)) if levels is None else rng.integers(0, levels, (90, 4)).astype(float)
    y = rng.integers(-50, 50, 90) * 100_000
    times = rng.poisson(1.0, (90, 6))
    times[:, 4] = 0  # a tree without rows
    times[1:, 5], times[0, 5] = 0, 3  # a tree of one row
    grown = FO.grow_trees(x, y, times, max_depth)
    for t in range(6):
        if t == 4:
            assert grown[t] == {}
            continue
        m = times[:, t] > 0
        want = plain_tree(x[m], y[m], times[m, t], 0, max_depth)
        assert as_tuple(grown[t]) == want
        assert FO.walk_tree(grown[t], x).tolist() == [plain_value(want, r) for r in x]
        assert grown[t]["weight"][0] == times[:, t].sum()


def table(spark, n=160, models=1, seed=5, constant=False):
    rng = np.random.default_rng(seed)
    rows = [(m, i, float(rng.integers(0, 9)), float(rng.normal()), 0.25 if constant else float(round(rng.normal(), 3))) for m in range(models) for i in range(n)]
    return spark.createDataFrame(rows, "model int, id long, a double, b double, y double")


def pieces_of(forest):
    return {(r.model, r.tree, r.piece): tuple(map(tuple, (r.feature, r.threshold, r.left, r.value, r.weight))) for r in forest.pieces.collect()}


def test_forest_against_plain_trees(spark):
    df = table(spark, models=2)
    rows = df.collect()
    forest = FO.fit_forest(df.repartition(5), ["a", "b"], "y", ["id"], trees=7, seed=9, batch=3)
    got = {(r.model, r.id): r.p for r in forest.predict(df, "p").collect()}
    for m in (0, 1):
        own = [r for r in rows if r.model == m]
        x = np.array([(r.a, round(r.b, 9)) for r in own])
        y = np.array([round(r.y * 1e6) for r in own])
        total = np.zeros(len(own))
        for t in range(7):
            w = np.array([sum(draw(9, m, t, r.id) >= c for c in POISSON_CDF) for r in own])
            tree = plain_tree(x[w > 0], y[w > 0], w[w > 0])
            total += [plain_value(tree, r) for r in x]
        assert [got[m, r.id] for r in own] == pytest.approx((total / 7).tolist(), abs=1e-12)
    assert pieces_of(FO.fit_forest(df, ["a", "b"], "y", ["id"], trees=7, seed=9, batch=7)) == pieces_of(forest)


@pytest.mark.parametrize("max_depth, constant", [(None, False), (3, False), (None, True)])
def test_large_nodes_are_split_over_the_cluster_alike(spark, max_depth, constant):
    df = table(spark, n=140, models=2, constant=constant)
    near = FO.fit_forest(df, ["a", "b"], "y", ["id"], trees=3, seed=2, max_depth=max_depth)
    far = FO.fit_forest(df, ["a", "b"], "y", ["id"], trees=3, seed=2, max_depth=max_depth, task_rows=25)
    assert near.upper is None and far.upper is not None and (constant or far.upper.count() > 6)
    a = {(r.model, r.id): r.prediction for r in near.predict(df).collect()}
    b = {(r.model, r.id): r.prediction for r in far.predict(df).collect()}
    assert a == pytest.approx(b, abs=1e-12)
    leaves = lambda f: sorted((r.model, r.tree, r.value, r.weight) for r in f.nodes().where("feature is null").collect())
    assert leaves(near) == leaves(far)


def test_stored_model(spark, scratch):
    df = table(spark)
    for task_rows in (10_000, 30):
        forest = FO.fit_forest(df, ["a", "b"], "y", ["id"], trees=4, seed=1, task_rows=task_rows)
        forest.save(f"{scratch}/{task_rows}")
        again = FO.Forest.load(spark, f"{scratch}/{task_rows}")
        assert {r.id: r.prediction for r in again.predict(df).collect()} == pytest.approx({r.id: r.prediction for r in forest.predict(df).collect()}, abs=1e-12)
        roots = again.nodes().where("piece = 0 and node = 0")
        assert task_rows == 30 or roots.count() == 4


def test_empty_and_alike_rows(spark):
    df = table(spark)
    none = FO.fit_forest(df.where("id < 0"), ["a", "b"], "y", ["id"], trees=3)
    assert none.pieces.count() == 0 and [r.prediction for r in none.predict(df.limit(2)).collect()] == [None, None]
    alike = df.select("model", "id", F.lit(1.0).alias("a"), F.lit(2.0).alias("b"), "y")  # nothing to split by
    forest = FO.fit_forest(alike, ["a", "b"], "y", ["id"], trees=3)
    assert forest.nodes().count() == 3 and forest.nodes().where("feature is not null").isEmpty()
