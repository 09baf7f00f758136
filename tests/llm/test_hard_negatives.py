from collections import Counter

import numpy as np
import pytest

from newsrisk.llm import hard_negatives as M

SCHEMA = "vec_id long, embedding array<float>, label int, rid string, q int, rank int, block string, place int"


def frame(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], lab, "r", 1, 2, "b", 3) for i, v, lab in rows], SCHEMA)


def brute(rows):
    q = [(i, (lab + 1) % 10 if i % 7 == 0 else lab, [int(np.floor(256 * float(np.float32(x)))) for x in v]) for i, v, lab in rows]
    out, done = Counter(), set()
    for i, lab, a in sorted(q):
        if i % 100 or i in done:
            continue
        done.add(i)
        score = [(-sum(x * y for x, y in zip(a, b)), j, other) for j, other, b in q if j != i]
        score.sort()
        for s, j, _ in [r for r in score if r[2] == lab][:5]:
            inside = [r for r in score if r[2] != lab and 80 * -s <= 100 * -r[0] <= 100 * -s][:5]
            out.update((i, j, rank + 1, n, -s, -t) for rank, (t, n, _) in enumerate(inside))
    return out


def table(rng, n, clusters, spread, dims=12):
    centres = rng.standard_normal((clusters, dims))
    return [(int(i), centres[i % clusters] + spread * rng.standard_normal(dims), int(i) // 3 % 4) for i in range(n)]


@pytest.mark.parametrize("clusters, spread, group, block", [(3, 0.01, 4, 100), (3, 0.01, 2048, 1024), (50, 1.0, 5, 64)])
def test_against_brute_force(spark, clusters, spread, group, block):
    rows = table(np.random.default_rng(clusters + group), 1200, clusters, spread)
    rows += [(1301, rows[0][1], 1)] * 30 + [(100, rows[5][1], 0), (1400, rows[0][1], 2), (1400, rows[0][1], 1)]  # ties, repeats
    want = brute(rows)
    got = Counter(map(tuple, M.mine(frame(spark, rows), group=group, block=block).collect()))
    assert len(want) > 100 and got == want


def test_tree_is_a_minimum_spanning_tree():
    rng = np.random.default_rng(5)
    x = rng.integers(-9, 9, (40, 3)).astype(float)
    order, parent, edge = M.spanning_tree(x)
    assert sorted(order) == list(range(40)) and parent[0] == -1 and (parent[1:] < np.arange(1, 40)).all() and (parent[1:] >= 0).all()
    assert edge[1:] == pytest.approx(np.linalg.norm(x[order[1:]] - x[order[parent[1:]]], axis=1))
    d = np.linalg.norm(x[:, None] - x[None], axis=2)
    inside, total = {0}, 0.0  # Prim's total, by plain search
    while len(inside) < 40:
        w, j = min((d[a, b], b) for a in inside for b in range(40) if b not in inside)
        inside.add(j)
        total += w
    assert edge.sum() == pytest.approx(total)


def test_bounds_hold_and_spare_scoring():
    rng = np.random.default_rng(6)
    x = np.rint(256 * rng.standard_normal((400, 16)))
    anchors = np.rint(x[rng.integers(0, 3, 60)] + rng.integers(-2, 3, (60, 16)))  # three tight clusters
    order, parent, edge = M.spanning_tree(anchors)
    a, scored = anchors[order], 0

    def wanted(i, lo, hi):
        s = x @ a[i]
        assert (lo <= s).all() and (s <= hi).all()
        return hi >= M.kth_best(lo, 5)

    for i, at, score in M.walk(x, a, parent, edge, wanted):
        s = x @ a[i]
        assert (score == s[at]).all() and set(M.best(s, np.arange(400), 5)) <= set(at.tolist())
        scored += len(at)
    assert scored < 0.2 * len(a) * len(x)


def test_rows_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    good = [(0, [1, 0], 1), (1, [0.9, 0.1], 1), (2, [0.8, 0], 2), (3, [0.85, 0], 3), (200, [0, 0], 5), (203, [0.88, 0], 1)]
    bad = [(5, None, 2), (6, [0.8, None], 2), (8, [nan, 1], 2), (9, [inf, 1], 2), (10, [0.8, 0.1], None), (None, [0.8, 0.1], 2), (11, [], 2), (12, [1, 2, 3], 2)]
    assert Counter(map(tuple, M.mine(frame(spark, good + bad)).collect())) == brute(good)
    assert M.mine(frame(spark, bad)).count() == 0 and M.mine(frame(spark, [])).count() == 0
    assert M.mine(frame(spark, [(0, [1.0], 1)])).count() == 0


def test_both_ways_of_joining_agree(spark, monkeypatch):
    rows = table(np.random.default_rng(9), 500, 5, 0.1)
    monkeypatch.setattr(M, "checked_broadcast", lambda df, *a: df)
    assert Counter(map(tuple, M.mine(frame(spark, rows), group=2, block=50).collect())) == brute(rows)


def test_groups_meet_only_blocks_that_may_lie_in_their_windows(spark, monkeypatch):
    """Tight clusters far apart: few pairs of blocks and groups are brought together, and the result stays exact."""
    from pyspark.sql import functions as F

    rng = np.random.default_rng(12)
    centres = 3 * np.eye(12)[:8]  # at right angles
    rows = [(i, centres[i % 8] + 0.01 * rng.standard_normal(12), i // 8 % 3) for i in range(0, 3000)]
    seen = []
    plain = M.overlapping

    def spied(blocks, anchors, share=M.SHARE):
        met = plain(blocks, anchors, share)
        seen.append((met.count(), blocks.agg(F.max("block")).first()[0] + 1, anchors.agg(F.max("grp")).first()[0] + 1))
        return met

    monkeypatch.setattr(M, "overlapping", spied)
    want = brute(rows)
    assert want and Counter(map(tuple, M.mine(frame(spark, rows), group=2, block=60).collect())) == want
    met, blocks, groups = seen[0]
    assert met < 0.5 * blocks * groups
    monkeypatch.setattr(M, "MIDDLES_BYTES", 0)  # all meet all
    assert Counter(map(tuple, M.mine(frame(spark, rows), group=2, block=60).collect())) == want
    assert seen[1][0] == seen[1][1] * seen[1][2]
