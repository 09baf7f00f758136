import numpy as np
import pytest
from helpers import awkward, frame
from pyspark.sql import functions as F

from newsrisk.llm import language_id as L

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("k", [1, 2, 3, 4, 7, 8, 20])
def test_codewords_tell_all_languages_apart(k):
    c = L.codewords(k)
    assert len(np.unique(c, axis=0)) == k if k > 1 else c.shape == (1, 0)
    assert (abs(c.sum(axis=0)) < k).all()


def test_a_wrong_bit_is_corrected():
    codes = L.codewords(4)
    model = L.Model(list("abcd"), codes, np.zeros((1, codes.shape[1])), np.ones(codes.shape) / codes.shape[1])
    for i in range(4):
        f = codes[i] * 3.0
        f[i % codes.shape[1]] *= -1
        assert L.decode(f, model)[0] == i
    best, score, lead = L.decode(np.zeros(codes.shape[1]), model)
    assert best == 0 and score == pytest.approx(0.25) and lead == pytest.approx(0)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = L.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").toPandas()
    assert len(found) > 20 and (found.lang_pred == found.lang).mean() >= 0.97


def test_rows_and_folds(spark):
    rows = awkward() + [(20 + i, "the cat sat on the mat") for i in range(10)]
    found = L.identify(frame(spark, rows)).toPandas()
    assert len(found) == len(rows)
    by = found.set_index("doc_id")
    for i in (1, 2, 3, 4):
        assert by.loc[i].lang_pred == "und" and by.loc[i].score == 0
    assert by.loc[5].lang_pred == "en" and found.score.between(0, 1).all()
    import zlib

    assert all(r.held_out == (zlib.crc32(str(int(r.doc_id)).encode()) % 5 == 0) for r in found.dropna(subset=["doc_id"]).itertuples())


def test_prediction_ignores_everything_but_the_text(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = L.fit(docs)
    a = {r.doc_id: (r.lang_pred, r.score) for r in L.predict(docs, model).collect()}
    moved = docs.withColumn("doc_id", F.col("doc_id") + 1000).withColumn("lang", F.lit("xx"))
    assert {r.doc_id - 1000: (r.lang_pred, r.score) for r in L.predict(moved, model).collect()} == a


def test_copies_neither_hide_a_language_nor_outweigh_its_texts(spark):
    letters = {"aa": "abcdef", "bb": "uvwxyz", "cc": "mnopqr"}
    texts = {l: [f"{c[i % 6]}{c[i // 6 % 6]} {c[i // 36 % 6] * 2} {c}" for i in range(60)] for l, c in letters.items()}
    rows = [(t, l) for l in ("aa", "cc") for t in texts[l]] + [(texts["bb"][0], "bb")] * 5000 + [(t, "bb") for t in texts["bb"]]
    labelled = spark.createDataFrame(rows, "text string, lang string")
    sample, languages = L.distinct_sample(labelled, 20)
    got = [(r.text, r.lang) for r in sample.collect()]
    assert languages == ["aa", "bb", "cc"] and len(got) == len(set(got)) == 60
    assert all(sum(l == m for _, m in got) == 20 for l in languages) and set(got) <= set(rows)
    assert {(r.text, r.lang) for r in L.distinct_sample(labelled, 100)[0].collect()} == set(rows)
    assert L.fit(labelled, 20).languages == languages


def test_a_language_of_few_texts_with_many_copies_is_learned(spark):
    """Rows are many more than the sample, distinct texts fewer: by rows, most languages had none taken."""
    rows = [(f"{chr(97 + l) * 3} {chr(97 + l)}{i}", f"l{l:02d}") for l in range(12) for i in range(3) for _ in range(300)]
    labelled = spark.createDataFrame(rows, "text string, lang string")
    assert L.fit(labelled, 20).languages == [f"l{l:02d}" for l in range(12)]


def test_nothing_to_learn(spark):
    empty = frame(spark, [])
    assert L.identify(empty).count() == 0
    unlabelled = frame(spark, [(1, "hello"), (2, None)]).withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in L.identify(unlabelled).collect()} == {"und"}


@pytest.mark.parametrize("k", [2, 4, 20, 60])
def test_ambiguity_does_not_depend_on_the_number_of_languages(k):
    codes = L.codewords(k)
    model = L.Model([f"l{i:02d}" for i in range(k)], codes, np.zeros((1, codes.shape[1])), np.ones(codes.shape) / codes.shape[1])
    leads = [L.decode(codes[i] * 2.0, model)[2] for i in range(k)]
    assert min(leads) > 0.2  # every bit right by the same margin: far from ambiguous, however many languages there are
    assert L.decode(codes[0] * 0.0, model)[2] == pytest.approx(0.0)


def test_against_a_plain_version(spark):
    """Predictions of the fitted model by plain counting and decoding, text by text."""
    import math
    from collections import Counter

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = L.fit(docs.where(L.fold(F.col("doc_id")) != 0))
    mask = (1 << 64) - 1

    def counts(text):
        if not any(c.isalpha() for c in text):
            return None
        text = "".join(c if c.isalpha() else " " for c in text.lower())
        x = [ord(c) for c in " " + " ".join(text.split()) + " "]
        out = Counter()
        for n in L.ORDERS:
            for i in range(len(x) - n + 1):
                h = 0
                for c in x[i : i + n]:
                    h = (h * 0x9E3779B97F4A7C15 + c + 1) & mask
                out[(((h ^ (h >> 31)) * 0xBF58476D1CE4E5B9) & mask) >> 50] += 1
        return out

    for r in L.judged(docs.select("text"), model).limit(60).collect():
        c = counts(r.text or "")
        if c is None:
            assert r._lang_pred == "und" and r._score == 0
            continue
        size = math.sqrt(c.total())
        f = [sum(n * float(model.weights[b, bit]) for b, n in c.items()) / size for bit in range(model.codes.shape[1])]
        loss = [sum(model.trust[k, bit] * math.log1p(math.exp(-model.codes[k, bit] * f[bit])) for bit in range(len(f))) for k in range(len(model.languages))]
        best = min(range(len(loss)), key=lambda k: loss[k])
        share = math.exp(-loss[best]) / sum(math.exp(-x) for x in loss)
        assert r._lang_pred == model.languages[best] and r._score == pytest.approx(share, abs=1e-4)


def test_rows_go_one_by_one(spark):
    """Rows of one id, and rows without an id, are judged by their own texts."""
    text = "the cat sat on the mat with the hat"
    rows = [(1, text), (1, "123 456"), (None, text), (None, "---"), (2, None)] + [(10 + i, text) for i in range(10)]
    docs = frame(spark, rows)
    kept = L.identified(docs)
    assert kept.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted([(1, text), (None, text)] + [(10 + i, text) for i in range(10)], key=str)
