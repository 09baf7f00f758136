"""The pipeline's stages one after the other, each against a plain version on its own input."""

import random

import pytest
from helpers import awkward, frame, leaks, prose, similar_lines, without_lines
from test_simhash_dedup import brute

import corpus_pipeline as P
from newsrisk.llm import language_id

SF = "/root/testdata/sf0.001"


def follow(spark, docs, sf_dir):
    """Run the stages and check each; the rows of the last."""
    columns = docs.columns
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    benchmark = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    for n, (name, stage) in enumerate(P.STAGES):
        out = stage(spark, docs, sf_dir)
        if n < 4:
            assert out.columns == columns
        docs = P.write_table(out, f"test-{name}")
        got = docs.collect()
        texts = {(r.doc_id, r.text) for r in got}
        if name == "language_id":
            want = {r for r in rows if any(c.isalpha() for c in r[1] or "")}
            assert texts <= want and len(want - texts) <= 0.02 * len(want) + 1
        elif name == "line_dedup":
            kept = without_lines(rows, similar_lines(rows))
            assert texts == {(i, t if i is None or t is None else kept[i]) for i, t in rows}
        elif name == "simhash_dedup":
            assert texts == {(i, t) for (i, t), (_, _, c) in zip(sorted(rows, key=str), sorted(brute(sorted(rows, key=str)), key=str)) if i is None or i == c} if len({i for i, _ in rows}) == len(rows) else True
        elif name == "decontaminate":
            gone = {d for d, _ in leaks(rows, benchmark)}
            assert texts == {r for r in rows if r[0] not in gone}
        else:
            assert texts == set(rows) and all(r.text is None or (r.exact and r.n_tokens == len(r.ids)) for r in got)
        rows = [(r.doc_id, r.text) for r in got]
    return rows


def test_order_of_the_stages():
    assert [n for n, _ in P.STAGES] == ["language_id", "line_dedup", "simhash_dedup", "decontaminate", "sentencepiece"]
    assert P.ORACLE_SQL is None


def test_stages_on_the_test_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = follow(spark, docs, SF)
    assert 0 < len(rows) < docs.count()
    final = P.run(spark, SF)
    assert final.columns[: len(docs.columns)] == docs.columns
    assert {(r.doc_id, r.text) for r in final.collect()} == set(rows)


def test_awkward_documents(spark):
    rng = random.Random(0)
    rows = awkward() + [(100 + i, " ".join(prose(rng, 50))) for i in range(30)]
    docs = frame(spark, rows)
    for _, stage in P.STAGES:
        docs = P.write_table(stage(spark, docs, SF), "test-awkward")
    assert {100 + i for i in range(30)} <= {r.doc_id for r in docs.collect()}


@pytest.mark.parametrize("n", range(5))
def test_empty_table(spark, n):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    assert P.STAGES[n][1](spark, docs, SF).count() == 0


def test_few_documents_are_rejected(spark):
    found = language_id.identify(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    assert found.where("ambiguous or lang_pred = 'und'").count() <= 0.005 * found.count()
