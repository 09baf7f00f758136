import random

from pyspark.sql import functions as F

from helpers import awkward, frame, prose, similar_lines, without_lines

from newsrisk.llm import line_dedup as L

SF = "/root/testdata/sf0.001"


def check(spark, rows):
    docs = frame(spark, rows)
    out = L.dedup_lines(docs)
    assert out.columns == [c for c in docs.columns if c != "n_removed"] + ["n_lines", "n_removed"]
    gone = similar_lines(rows)
    want = without_lines([r for r in rows if r[0] is not None], gone)
    found = out.collect()
    assert len(found) == len(rows)
    for r in found:
        if r.doc_id is None or r.text is None:
            assert r.n_removed == 0
        else:
            assert r.text == want[r.doc_id] and r.n_removed == sum(i == r.doc_id for i, _ in gone)
    return gone


def test_on_the_test_table(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert check(spark, rows)


def test_awkward_documents(spark):
    assert (10, 1) in check(spark, awkward())


def test_empty_table(spark):
    assert L.dedup_lines(frame(spark, [])).count() == 0


def test_group_of_near_copies(spark):
    """Many variants of one line (pivots, and pivots tried in vain), of very different lengths."""
    rng = random.Random(9)
    rows = []
    for g, size in enumerate((4, 12, 40, 300)):
        base = prose(rng, size, 400)
        for i in range(60):
            w = list(base)
            for _ in range(rng.randrange(0, max(2, size // 6))):
                kind, at = rng.randrange(3), rng.randrange(len(w))
                if kind == 0:
                    w[at] = f"new{rng.randrange(30)}"
                elif kind == 1:
                    w.insert(at, f"new{rng.randrange(30)}")
                elif len(w) > 2:
                    del w[at]
            rows.append((g * 1000 + i, " ".join(w) + "\nshared last line of all " + str(i % 7)))
    assert len(check(spark, rows)) > 100


def test_threshold_is_inclusive(spark):
    # 8 shared of 10: exactly 0.8; 7 shared of 9: below
    a, b, c = [f"t{i}" for i in range(9)], [f"t{i}" for i in range(8)] + ["x"], [f"t{i}" for i in range(7)] + ["y", "z"]
    rows = [(1, " ".join(a)), (2, " ".join(b)), (3, " ".join(c))]
    assert check(spark, rows) == {(2, 0)}


def test_plan_has_no_python(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    plan = L.dedup_lines(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_many_lines_of_one_document(spark):
    """A document of which most lines go is put together in time that grows with its lines."""
    import time

    def seconds(n):
        docs = frame(spark, [(1, "\n".join(f"line {i % (n // 4)} of this long text" for i in range(n)))])
        gone = spark.range(n // 4, n).select(F.lit(1).cast("long").alias("doc"), F.col("id").cast("int").alias("line"))
        started = time.time()
        out = L.without(docs, gone).first()
        assert out.n_removed == n - n // 4 and out.text.count("\n") == n // 4 - 1
        return time.time() - started

    seconds(20_000)
    assert seconds(160_000) < 4 * max(seconds(80_000), 0.5)


def test_both_ways_of_joining_agree(spark, monkeypatch):
    rng = random.Random(12)
    base = prose(rng, 20, 100)
    rows = [(i, " ".join(base[:17] + prose(rng, 3, 100)) + "\nthe same line") for i in range(60)]
    monkeypatch.setattr(L, "checked_broadcast", lambda df, *a: df)
    monkeypatch.setattr(L, "BROADCAST_MAX_BYTES", 0)
    check(spark, rows)
