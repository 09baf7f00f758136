import itertools

import numpy as np
import pytest

from newsrisk.llm import multi_index as M

SF = "/root/testdata/sf0.01"
SCHEMA = "vec_id long, embedding array<float>, label int, first int, vector string, score double"


def vectors(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 0, 1, "v", 0.0) for i, v in rows], SCHEMA)


def brute(rows, every=20, k=20):
    out = {}
    for q, v in rows:
        if q % every == 0:
            s = sorted((-float(np.dot(np.float64(np.float32(v)), np.float64(np.float32(w)))), i) for i, w in rows if i != q)
            out[q] = [(i, -x) for x, i in s[:k]]
    return out


def by_query(found):
    out = {}
    for r in found.orderBy("query_id", "rank").collect():
        assert r["rank"] == len(out.setdefault(r["query_id"], [])) + 1
        out[r["query_id"]].append((r["vec_id"], r["score"]))
    return out


def test_walk_is_in_order_of_the_summed_distance():
    rng = np.random.default_rng(0)
    for _ in range(20):
        d1, d2 = rng.random(6), rng.random(5)
        sizes = rng.integers(0, 4, (6, 5))
        for need in (1, 10, 1000):
            order, got, want = sorted((d1[a] + d2[b], a, b) for a, b in itertools.product(range(6), range(5))), 0, {}
            for _, a, b in order:
                if got >= need:
                    break
                if sizes[a, b]:
                    want.setdefault(a, []).append(b)
                    got += sizes[a, b]
            assert M.walk(d1, d2, sizes.tolist(), need) == want


def test_recall_on_the_test_table(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    want = brute([(r.vec_id, r.embedding) for r in df.collect()])
    got = by_query(M.nearest(df))
    assert got.keys() == want.keys() and all(len(v) == 20 for v in got.values())
    hits = sum(len({i for i, _ in want[q]} & {i for i, _ in got[q]}) for q in want)
    assert hits / (20 * len(want)) >= 0.9


def test_all_cells_give_the_exact_answer(spark, monkeypatch):
    rng = np.random.default_rng(3)
    rows = [(i, rng.standard_normal(7)) for i in range(150)] + [(150 + i, np.ones(7)) for i in range(100)]  # ties
    monkeypatch.setattr(M, "ENTRY_BLOCK", 40)
    monkeypatch.setattr(M, "QUERY_BLOCK", 5)
    got = by_query(M.nearest(vectors(spark, rows), probe_share=1.0))
    want = brute(rows)
    assert {q: [i for i, _ in v] for q, v in got.items()} == {q: [i for i, _ in v] for q, v in want.items()}
    assert all(a[1] == pytest.approx(b[1], abs=1e-12) for q in want for a, b in zip(got[q], want[q]))


def test_rows_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    good = [(0, [1, 0]), (1, [0.5, 0.5]), (20, [0, 2]), (20, [0, 2])]
    bad = [(40, None), (2, [0, 0]), (3, [1, None]), (4, [nan, 1]), (5, [inf, 1]), (6, [-inf, 1]), (7, []), (8, [1, 2, 3]), (None, [1, 1])]
    got = by_query(M.nearest(vectors(spark, good + bad)))
    assert {q: [i for i, _ in v] for q, v in got.items()} == {0: [1, 20, 20], 20: [1, 0]}
    assert M.nearest(vectors(spark, bad[:1])).count() == 0 and M.nearest(vectors(spark, [])).count() == 0
    assert M.nearest(vectors(spark, [(0, [1.0])])).count() == 0 and by_query(M.nearest(vectors(spark, [(0, [1]), (1, [2])]))) == {0: [(1, 2.0)]}


@pytest.mark.parametrize("sigma", [0.3, 1.0])
def test_recall_for_vectors_of_unequal_lengths(spark, sigma):
    rng = np.random.default_rng(5)
    x = rng.standard_normal((4000, 64))
    x *= np.exp(sigma * rng.standard_normal(4000) - np.log(np.linalg.norm(x, axis=1)))[:, None]
    x = x.astype(np.float32)
    got = by_query(M.nearest(vectors(spark, list(enumerate(x.tolist())))))
    scores = x[::20].astype(float) @ x.astype(float).T
    hits = 0
    for n, q in enumerate(range(0, 4000, 20)):
        scores[n, q] = -np.inf
        hits += len(set(np.argsort(-scores[n])[:20].tolist()) & {i for i, _ in got[q]})
    assert hits / (20 * 200) >= 0.9
