import itertools
from collections import Counter, defaultdict

import numpy as np
import pytest

from newsrisk.llm import vector_codes as M
from newsrisk.llm.hilbert import grid, hilbert_keys

SCHEMA = "vec_id long, embedding array<float>, label int, rid string, part int, key long, code double, q int"


def frame(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], lab, "r", 1, 2, 3.0, 4) for i, v, lab in rows], SCHEMA)


def plain(rows, parts=8, entries=16, rounds=6):
    """Codes, errors and the digest by plain comparison with every entry."""
    q = [(i, [int(np.floor(4096 * float(np.float32(x)))) for x in v], lab) for i, v, lab in rows]
    width = -(-len(q[0][1]) // parts)
    q = [(i, v + [0] * (width * parts - len(v)), lab) for i, v, lab in q]
    q.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    cut = [[v[p * width : (p + 1) * width] for p in range(parts)] for _, v, _ in q]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]

    def assign(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), e) for e, c in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            own = defaultdict(list)
            for c in cut:
                own[assign(c[p], books[p])[1]].append(c[p])
            books[p] = [[sum(col) // len(own[e]) for col in zip(*own[e])] if e in own else old for e, old in enumerate(books[p])]
    out, by_label = [], Counter()
    for (i, _, lab), c in zip(q, cut):
        found = [assign(c[p], books[p]) for p in range(parts)]
        out.append((i, "".join(f"{e:02x}" for _, e in found), sum(d for d, _ in found), lab))
        by_label[lab] += out[-1][2]
    sha = M.digest(np.array(books))
    return Counter((i, code, err, by_label[lab], sha) for i, code, err, lab in out)


def test_curve_visits_neighbours():
    for axes, bits in ((1, 4), (2, 4), (3, 2), (4, 2), (8, 1)):
        cells = np.array(list(itertools.product(range(1 << bits), repeat=axes)), np.int64)
        key = hilbert_keys(cells, bits)
        assert sorted(key.tolist()) == list(range(len(cells)))
        steps = np.abs(np.diff(cells[np.argsort(key)], axis=0))
        assert (steps.sum(axis=1) == 1).all()
    cells, bits = grid(np.array([[-1e9, 0.0, 1e9], [-5.0, 4.0, 5.0]]), 5.0)
    assert bits == 16 and cells[0].tolist()[::2] == [0, 2**16 - 1] and (np.diff(cells[1]) > 0).all() and cells.max() < 2**16


def test_shortlists_keep_every_nearest_entry():
    rng = np.random.default_rng(1)
    single = 0
    for _ in range(200):
        x = rng.integers(-20, 20, (1, 4)) + rng.integers(0, 6, (30, 4))
        entries = rng.integers(-20, 20, (9, 4))
        short = M.shortlists(x.min(axis=0)[None], x.max(axis=0)[None], entries)[0]
        single += short.sum() == 1
        d = ((x[:, None] - entries[None]) ** 2).sum(axis=2)
        assert short[np.unique(np.nonzero(d == d.min(axis=1, keepdims=True))[1])].all()
    assert single  # whole blocks go to one entry


@pytest.mark.parametrize("block", [7, 256])
def test_against_the_plain_version(spark, monkeypatch, block):
    rng = np.random.default_rng(block)
    monkeypatch.setattr(M.blocks, "__defaults__", (8, block))
    centres = rng.standard_normal((6, 16))
    rows = [(i * 3, centres[i % 6] + 0.02 * rng.standard_normal(16), [None, 1, 2][i % 3]) for i in range(240)]
    rows += [(9, np.zeros(16), 2)] * 120 + [(None, np.ones(16), None)]  # copies of one row, an id that repeats, no id
    got = Counter(map(tuple, M.compress(frame(spark, rows).repartition(5)).collect()))
    assert got == plain(rows)


def test_widths_and_few_rows(spark):
    rng = np.random.default_rng(4)
    rows = [(i, rng.standard_normal(11), 0) for i in range(9)]  # padded, fewer rows than entries
    assert Counter(map(tuple, M.compress(frame(spark, rows)).collect())) == plain(rows)
    rows = [(i, [0.25] * 8, 0) for i in range(40)]  # all alike: entries 1 to 15 stay unused
    assert Counter(map(tuple, M.compress(frame(spark, rows)).collect())) == plain(rows)


def test_rows_that_are_dropped(spark):
    nan, inf = float("nan"), float("inf")
    good = [(5, [1.0] * 8, 1), (6, [-1.5] * 8, None), (7, [0.0] * 8, None)]
    bad = [(1, None, 1), (2, [nan] * 8, 1), (3, [inf] * 8, 1), (4, [-inf] * 8, 1), (8, [None] * 8, 1), (9, [], 1), (10, [1.0] * 4, 1)]
    assert Counter(map(tuple, M.compress(frame(spark, good + bad)).collect())) == plain(good)
    assert M.compress(frame(spark, bad[:5])).count() == 0 and M.compress(frame(spark, [])).count() == 0
    far = M.compress(frame(spark, good + [(11, [1e30] * 8, 2)])).where("vec_id = 11").first()
    assert far.error >= 0 and far.label_error == far.error


def test_both_ways_of_joining_agree(spark, monkeypatch):
    rng = np.random.default_rng(6)
    rows = [(i, rng.standard_normal(8), i % 3 or None) for i in range(60)]
    monkeypatch.setattr(M, "checked_broadcast", lambda df, *a: df)
    assert Counter(map(tuple, M.compress(frame(spark, rows)).collect())) == plain(rows)
