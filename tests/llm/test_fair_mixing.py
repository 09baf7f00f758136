import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from helpers import awkward, prose
from newsrisk.llm import fair_mixing as M

SCHEMA = "doc_id long, text string, source string, rank long, size string, target int, place long, n long"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, s, 1, "x", 2, 3, 4) for i, t, s in rows], SCHEMA)


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def shares(sizes, weights=M.WEIGHTS, repeats=M.REPEATS):
    """Targets by repeated sharing of what the capped sources leave."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    fixed = {}
    while True:
        left, rest = sum(sizes.values()) - sum(fixed.values()), [s for s in order if s not in fixed]
        share = {s: weight[s] * left / sum(weight[x] for x in rest) for s in rest}
        over = [s for s in rest if share[s] > repeats * sizes[s]]
        if not over:
            return fixed | share
        fixed |= {s: repeats * sizes[s] for s in over}


def check(rows, got):
    """The contract, on any table."""
    assert Counter((i, words(t)) for i, t, _ in rows) == Counter((r.doc_id, r["size"]) for r in got)
    sizes = defaultdict(int)
    for _, t, s in rows:
        sizes[s] += words(t)
    want, largest, taken = shares(dict(sizes)), defaultdict(int), defaultdict(int)
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source], rel=1e-12)
        assert 0 <= r.taken <= 3 * r["size"] and (r["size"] == 0 or r.taken % r["size"] == 0)
        largest[r.source] = max(largest[r.source], r["size"])
        taken[r.source] += r.taken
    slack = sum(largest.values())
    assert sum(taken.values()) <= sum(sizes.values())
    for s in sizes:  # a document's rest at the cut, and what the other sources' rests leave to share
        assert abs(taken[s] - want[s]) <= slack


def test_targets_and_shares(spark):
    rng = random.Random(2)
    rows = [(i, " ".join(prose(rng, rng.randrange(30))), f"s{rng.choice('aabbbbbbbbbbbbbbbbbbcdeé😀')}") for i in range(1500)]
    rows += [(5000 + i, " ".join(prose(rng, 20)), None) for i in range(60)]
    got = M.mix(frame(spark, rows)).collect()
    check(rows, got)
    again = M.mix(frame(spark, rows).repartition(7)).collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, again))
    assert {r.taken // r["size"] for r in got if r["size"]} >= {0, 1, 3}


def test_schedule_is_the_mix_in_order_of_finish_time(spark):
    rng = random.Random(3)
    rows = [(i, " ".join(prose(rng, rng.randrange(1, 30))), rng.choice("aab")) for i in range(400)]
    got = {r.doc_id: r.taken for r in M.mix(frame(spark, rows)).collect()}
    plan = M.schedule(frame(spark, rows)).collect()
    times = [r.finish for r in plan]
    assert times == sorted(times)
    seen, epochs = Counter(), {}
    for r in plan:
        assert r.epoch == epochs.get(r.doc_id, -1) + 1  # an earlier epoch comes first
        epochs[r.doc_id] = r.epoch
        seen[r.doc_id] += r["size"]
    assert {i: seen[i] for i in got} == got


def test_ties_repeats_and_awkward_rows(spark):
    rows = [(i, t, s) for i, t in awkward() for s in ("x", None, "")]
    rows += [(77, "one two three", "x")] * 3000  # a row that repeats, in blocks
    check(rows, M.mix(frame(spark, rows)).collect())
    assert M.mix(frame(spark, [])).count() == 0
    only = [(1, None, None), (2, " \t\x0b ", "a")]
    assert sorted(tuple(r)[:5] for r in M.mix(frame(spark, only)).collect()) == [(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)]
    assert [r.taken for r in M.mix(frame(spark, [(1, "a b c", "s")])).collect()] == [3]


def test_budget_and_weights(spark):
    rows = [(i, "w " * 10, "ab"[i % 2]) for i in range(400)]
    got = M.mix(frame(spark, rows), weights=(3, 1), budget=1000).groupBy("source").agg(F.sum("taken")).collect()
    assert dict(map(tuple, got)) == {"a": 750, "b": 250}


def test_both_ways_of_joining_agree(spark, monkeypatch):
    rng = random.Random(5)
    rows = [(i, " ".join(prose(rng, rng.randrange(30))), rng.choice(["a", "b", None])) for i in range(300)]
    want = Counter(map(tuple, M.mix(frame(spark, rows)).collect()))
    monkeypatch.setattr(M, "checked_broadcast", lambda df, *a: df)
    assert Counter(map(tuple, M.mix(frame(spark, rows)).collect())) == want


def test_native(spark):
    plan = M.mix(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
