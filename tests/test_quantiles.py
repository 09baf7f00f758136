"""Exact two-pass percentiles agree with Spark's single-task ``percentile``."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from newsrisk.operators.quantiles import exact_percentiles


@pytest.mark.parametrize("accuracy", [10000, 50])
def test_matches_spark_percentile(spark, accuracy):
    rng = np.random.default_rng(0)
    vals = np.round(rng.normal(size=6000), 2)  # many ties
    grp = rng.integers(0, 4, size=6000)
    grp[:3000] = 0  # one hot group
    rows = [(int(a), float(b)) for a, b in zip(grp, vals)] + [(9, 1.0), (9, 2.0), (10, 5.0), (11, float("nan"))]
    df = spark.createDataFrame(rows, "g int, v double")
    probs = [0.0, 0.01, 0.25, 0.5, 0.75, 1.0]
    got = {r.g: [r[f"q{i}"] for i in range(len(probs))] for r in exact_percentiles(df, "v", probs, ["g"], accuracy).collect()}
    clean = df.where(~F.isnan("v"))
    ref = {r.g: r.q for r in clean.groupBy("g").agg(F.percentile("v", F.array(*[F.lit(p) for p in probs])).alias("q")).collect()}
    assert got.keys() == ref.keys()
    for key in ref:
        assert got[key] == pytest.approx(ref[key], abs=1e-12)


def test_global_quantile(spark):
    df = spark.range(1001).select((F.col("id") * 0.5).alias("v"))
    row = exact_percentiles(df, "v", [0.01, 0.5]).first()
    assert row.n == 1001 and row.q0 == pytest.approx(5.0) and row.q1 == pytest.approx(250.0)


def test_global_quantile_bracket_path(spark):
    rng = np.random.default_rng(3)
    df = spark.createDataFrame([(float(x),) for x in np.round(rng.normal(size=30000), 3)], "v double")
    got = exact_percentiles(df, "v", [0.01, 0.5]).first()
    ref = df.select(F.percentile("v", F.array(F.lit(0.01), F.lit(0.5))).alias("q")).first().q
    assert [got.q0, got.q1] == pytest.approx(ref, abs=1e-12)


from hypothesis import given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402


@settings(max_examples=6, deadline=None)
@given(
    st.lists(
        st.tuples(st.integers(0, 3), st.integers(-20, 20).map(lambda x: x / 4.0)),
        min_size=1,
        max_size=400,
    ),
    st.lists(st.floats(0.0, 1.0), min_size=1, max_size=3),
)
def test_exact_percentiles_property(spark, rows, probs):
    df = spark.createDataFrame(rows, "g int, v double")
    got = {r.g: [r[f"q{i}"] for i in range(len(probs))] for r in exact_percentiles(df, "v", probs, ["g"], 50).collect()}
    for g in {k for k, _ in rows}:
        vals = np.array([v for k, v in rows if k == g])
        assert got[g] == pytest.approx([float(np.percentile(vals, p * 100)) for p in probs], abs=1e-9)
