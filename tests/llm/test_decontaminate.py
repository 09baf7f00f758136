import random

from helpers import awkward, frame, leaks, prose

from pyspark.sql import functions as F

from newsrisk.llm import decontaminate as D

SF = "/root/testdata/sf0.001"


def items(spark, rows):
    return spark.createDataFrame([(*r, 1, 2) for r in rows], "item_id long, text string, n long, item long")


def got(df):
    return {(r.doc_id, r.item_id): r.similarity for r in df.collect()}


def same(found, want):
    assert found.keys() == want.keys() and all(abs(found[k] - want[k]) < 1e-9 for k in want)


def test_on_the_test_table(spark):
    docs, bench = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    want = leaks([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in bench.collect()])
    assert want
    same(got(D.contaminated(docs, bench)), want)
    stay = D.clean_of(docs, bench)
    assert stay.columns == docs.columns and stay.count() == docs.count() - len({d for d, _ in want})


def test_edited_passages(spark):
    rng = random.Random(4)
    bench = [(i, " ".join(prose(rng, n))) for i, n in enumerate((5, 6, 20, 45, 80))] + [(9, None), (None, "no id"), (10, "  "), (11, "two words")]
    bench += [(12, bench[3][1].upper()), (13, "a b c d e " * 12)]
    docs = []
    for i in range(60):
        w = bench[i % 5][1].split()
        for _ in range(rng.randrange(0, 3)):
            at = rng.randrange(len(w))
            w[at : at + rng.randrange(2)] = ["edit"] * rng.randrange(2)
        docs.append((i, " ".join(prose(rng, rng.randrange(40)) + w + prose(rng, rng.randrange(40)))))
    docs += [(100, "x Two  Words y"), (101, "a b c d e a b c d e"), (102, "b c d e a " * 15)]
    want = leaks(docs, bench)
    assert any(v < 1 for v in want.values()) and (100, 11) in want
    found = got(D.contaminated(frame(spark, docs), items(spark, bench)))
    same(found, want)


def test_awkward_and_empty_tables(spark):
    rows = awkward() + [(50, "one two three four five six seven eight")]
    bench = [(1, "One two three four five six seven eight"), (1, "One two three four five six seven eight"), (2, "one two three four five six seven eight")]
    assert got(D.contaminated(frame(spark, rows), items(spark, bench))) == {(50, 1): 1.0, (50, 2): 1.0}
    assert D.contaminated(frame(spark, []), items(spark, bench)).count() == 0
    assert D.contaminated(frame(spark, rows), items(spark, [])).count() == 0
    assert D.clean_of(frame(spark, rows), items(spark, bench)).count() == len(rows) - 1


def test_multi_index_finds_all_within_the_radius(spark):
    rng = random.Random(8)
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    own = [rng.getrandbits(64) for _ in range(20)]
    near = []
    for i in range(400):
        x = own[i % 20]
        for b in rng.sample(range(64), rng.randrange(0, 28)):
            x ^= 1 << b
        near.append(x)
    w = spark.createDataFrame([(i, 1, 0, signed(x)) for i, x in enumerate(near)], "doc_id long, n int, start int, fp long")
    i = spark.createDataFrame([(j, 1, signed(x)) for j, x in enumerate(own)], "item long, n int, fp long")
    found = {(r.doc_id, r.item) for r in D.within_radius(w, i).collect()}
    assert found == {(a, b) for a, x in enumerate(near) for b, y in enumerate(own) if (x ^ y).bit_count() <= D.RADIUS}


def test_simhash_and_occurrences(spark):
    rng = random.Random(1)
    rows = [[rng.getrandbits(64) - (1 << 63) for _ in range(n)] for n in (0, 1, 2, 3, 50)] + [[5, 5, 5, -1]]
    df = spark.createDataFrame([(r,) for r in rows], "sh array<bigint>").select("sh", D.simhash(F.col("sh")).alias("fp"), F.size(F.array_distinct(D.occurrences(F.col("sh")))).alias("n"))
    for r in df.collect():
        want = sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in r.sh) > len(r.sh))
        assert r.fp % (1 << 64) == want and r.n == len(r.sh)


def test_no_short_item_is_lost(spark):
    """Documents that hold all but one of an item's shingles, items of 5 to 10 shingles: 0.8 and more."""
    rng = random.Random(11)
    bench, docs = [], []
    for i in range(1500):
        w = prose(rng, 9 + i % 6, 10**6)
        bench.append((i, " ".join(w)))
        docs.append((i, " ".join(w[:-1] if i % 2 else w[1:])))
    found = got(D.contaminated(frame(spark, docs), items(spark, bench)))
    small = {(i, i) for i in range(1500) if i % 6 < 4}
    assert small <= found.keys() and len(found) >= 1500 - 2


def test_both_ways_of_joining_agree(spark, monkeypatch):
    docs, bench = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    want = got(D.contaminated(docs, bench))
    monkeypatch.setattr(D, "checked_broadcast", lambda df, *a: df.hint("merge"))
    monkeypatch.setattr(D, "BROADCAST_MAX_BYTES", 0)
    assert got(D.contaminated(docs, bench)) == want
