"""Isolation forest and forecast invariants."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from newsrisk.operators import anomalies as AN
from newsrisk.operators import forecast as FC
from newsrisk.operators.features import risk_features
from newsrisk.operators.clean import clean_events
from newsrisk.operators.events import extract_events_daily
from newsrisk.operators.risk import country_risk_daily
from newsrisk.sources import adapters

from conftest import SF_SMALL


def _blob(spark, n=600, outliers=6, seed=1):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 2))
    rows = [(dt.date(2024, 1, 1) + dt.timedelta(days=i % 300), f"C{i // 300}", float(a), float(b))
            for i, (a, b) in enumerate(x)]
    for k in range(outliers):
        rows[k] = (rows[k][0], rows[k][1], 9.0 + k, -9.0 - k)
    return spark.createDataFrame(rows, "date date, CountryCode string, a double, b double")


def test_planted_outliers_rank_first(spark):
    df = _blob(spark)
    scored = AN.isolation_forest_scores(df, ["a", "b"], trees=100)
    top = AN.top_anomalies(scored.withColumns({"EventCount": F.lit(1), "AvgTone": F.col("a"), "AvgGoldstein": F.col("b")}), 6)
    got = {r.AvgTone for r in top.collect()}
    assert got == {9.0 + k for k in range(6)}


def test_flagged_share_and_labels(spark):
    scored = AN.isolation_forest_scores(_blob(spark, n=1000, outliers=0), ["a", "b"], trees=50, contamination=0.01)
    rows = scored.select("anomaly_score", "anomaly_label").collect()
    flagged = sum(1 for r in rows if r.anomaly_label == -1)
    assert 5 <= flagged <= 15
    assert all((r.anomaly_label == -1) == (r.anomaly_score < 0) for r in rows)


def test_scores_independent_of_partitioning(spark):
    df = _blob(spark, n=400)
    a = {(r.date, r.CountryCode): r.anomaly_score for r in AN.isolation_forest_scores(df, ["a", "b"], trees=40).collect()}
    b = {(r.date, r.CountryCode): r.anomaly_score
         for r in AN.isolation_forest_scores(df.repartition(7), ["a", "b"], trees=40).collect()}
    assert a.keys() == b.keys()
    assert all(a[k] == pytest.approx(b[k], abs=1e-12) for k in a)


def test_average_path_length(spark):
    from newsrisk.operators.isolation import average_path_length

    got = [r[0] for r in spark.createDataFrame([(1,), (2,), (256,)], "n int").orderBy("n").select(average_path_length(F.col("n"))).collect()]
    assert got[:2] == [0.0, 1.0] and got[2] == pytest.approx(10.2448, abs=1e-3)


@pytest.fixture(scope="module")
def feats(spark):
    clean = clean_events(extract_events_daily(adapters.dense_events(spark, "/root/testdata/sf0.01"), ordered=False))
    return risk_features(country_risk_daily(clean, ordered=False))


def test_forecast_snapshot_shape(spark, feats):
    out = FC.forecast_next_day(feats, "2024-02-01", trees=10).collect()
    assert len(out) == 25 and len({r.CountryCode for r in out}) == 25
    assert all(r.forecast_date == r.as_of_date + dt.timedelta(days=1) for r in out)
    assert all(r.run_date == dt.date(2024, 2, 1) for r in out)
    assert list(FC.forecast_next_day(feats, "2024-02-01", trees=5).columns) == FC.FORECAST_COLUMNS


def test_backtest_holdout_is_later(spark, feats):
    bt = FC.forecast_backtest(feats, trees=10).first()
    assert bt.n_holdout > 0 and bt.mae >= 0
    # last training day has a target: 01-29; holdout = days after 01-29 - 14
    assert bt.holdout_end == dt.date(2024, 1, 29)
    assert bt.holdout_start == dt.date(2024, 1, 16)


def test_permutation_importance_rows(spark):
    clean = clean_events(extract_events_daily(adapters.sparse_events(spark, "/root/testdata/sf0.01"), ordered=False))
    risk = country_risk_daily(clean, ordered=False)
    imp = FC.forecast_cv_importance(risk, trees=10, n_repeats=3).collect()
    assert len(imp) == 7
    assert [r.importance for r in imp] == sorted([r.importance for r in imp], reverse=True)


def test_sf_small_end_to_end(spark):
    clean = clean_events(extract_events_daily(adapters.dense_events(spark, SF_SMALL), ordered=False))
    scored = AN.detect_anomalies(clean, trees=30)
    assert scored.count() == AN.country_day_panel(clean).count()


def test_forest_sampling_path_for_large_inputs(spark):
    from newsrisk.operators.isolation import fit_isolation_forest

    df = _blob(spark, n=6000, outliers=0)  # fewer draws than rows: the pool
    forest = fit_isolation_forest(df, ["a", "b"], ["date", "CountryCode"], trees=10, sample=256).toPandas()
    roots = forest[forest["node"] == 1]
    assert len(roots) == 10 and (roots["size"] == 256).all()
    assert forest.groupby("tree")["node"].count().max() < 2 * 256


def test_scores_match_brute_force_walk(spark):
    """Growth, scoring and threshold vs plain recursion from the same draws."""
    import hashlib
    import math

    from newsrisk.operators.isolation import fit_isolation_forest

    df = _blob(spark, n=300, outliers=3)
    cols, keys, trees = ["a", "b"], ["date", "CountryCode"], 25
    forest = fit_isolation_forest(df, cols, keys, trees=trees).toPandas()
    scored = {(r.date, r.CountryCode): (r.anomaly_score, r.anomaly_label)
              for r in AN.isolation_forest_scores(df, cols, keys, trees=trees).collect()}

    def md5(*parts):
        return hashlib.md5(":".join(map(str, parts)).encode()).hexdigest()

    def draw(*parts):
        return (int(md5(*parts)[:8], 16) + 0.5) / 2**32

    def c(n):
        return 0.0 if n <= 1 else 1.0 if n == 2 else 2 * (math.log(n - 1) + 0.5772156649015329) - 2 * (n - 1) / n

    rows = df.collect()
    x = {(r.date, r.CountryCode): (round(r.a, 9), round(r.b, 9)) for r in rows}
    nodes = {}

    def grow(tree, node, depth, sample):
        usable = [f for f in (0, 1) if len({x[k][f] for k in sample}) > 1] if depth < 8 else []
        if not usable:
            nodes[tree, node] = (depth, len(sample), None, None)
            return
        f = usable[int(draw(42, tree, node, "feature") * len(usable))]
        lo, hi = min(x[k][f] for k in sample), max(x[k][f] for k in sample)
        t = lo + (hi - lo) * draw(42, tree, node, "threshold")
        nodes[tree, node] = (depth, len(sample), f, t)
        grow(tree, 2 * node, depth + 1, [k for k in sample if x[k][f] < t])
        grow(tree, 2 * node + 1, depth + 1, [k for k in sample if x[k][f] >= t])

    for tree in range(trees):  # 300 rows: one block of 256 per order
        grow(tree, 1, 0, sorted(x, key=lambda k: md5(42, tree, *k))[:256])
    got = {(t.tree, t.node): (t.depth, t.size, None if math.isnan(t.feature) else int(t.feature), None if math.isnan(t.threshold) else t.threshold) for t in forest.itertuples()}
    assert got == nodes

    def length(tree, row, node=1):
        depth, size, f, t = nodes[tree, node]
        return depth + c(size) if f is None else length(tree, row, 2 * node + (row[f] >= t))

    raw = [-(2.0 ** (-sum(length(t, x[r.date, r.CountryCode]) for t in range(trees)) / trees / c(256))) for r in rows]
    q = float(np.percentile(raw, 1.0))
    for r, s in zip(rows, raw):
        got_score, got_label = scored[(r.date, r.CountryCode)]
        assert got_score == pytest.approx(s - q, abs=1e-12)
        assert got_label == (-1 if s - q < 0 else 1)


def test_permutation_importance_invariants(spark):
    from newsrisk.operators.features import SERIES_FEATURE_COLS, TARGET

    rng = np.random.default_rng(7)
    rows = []
    for i in range(120):
        f = {c: float(rng.normal()) for c in SERIES_FEATURE_COLS}
        f["lag_7"] = 1.0  # constant: permuting it cannot change any prediction
        rows.append((dt.date(2024, 1, 1) + dt.timedelta(days=i), "C", 3.0 * f["lag_1"], *[f[c] for c in SERIES_FEATURE_COLS]))
    schema = "date date, CountryCode string, " + f"{TARGET} double, " + ", ".join(f"{c} double" for c in SERIES_FEATURE_COLS)
    df = spark.createDataFrame(rows, schema)
    model = FC.fit_forest(df, SERIES_FEATURE_COLS, trees=20, seed=1, max_depth=6)
    imp = {r.feature: r.importance for r in FC.permutation_importance(model.predict, df, SERIES_FEATURE_COLS, 5, 3).collect()}
    assert abs(imp["lag_7"]) < 1e-12  # same residuals, summed in another order
    assert max(imp, key=imp.get) == "lag_1" and imp["lag_1"] > 0.5


def test_models_independent_of_shuffle_partitions(spark):
    clean = clean_events(extract_events_daily(adapters.dense_events(spark, SF_SMALL), ordered=False))
    old = spark.conf.get("spark.sql.shuffle.partitions")
    outs = []
    try:
        for parts in ("3", "13"):
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            feats = risk_features(country_risk_daily(clean, ordered=False))
            fc = {r.CountryCode: r.pred_risk_next_day for r in FC.forecast_next_day(feats, "2024-02-01", trees=10).collect()}
            sc = {(r.date, r.CountryCode): r.anomaly_score for r in AN.detect_anomalies(clean, trees=20).collect()}
            outs.append((fc, sc))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    (fc1, sc1), (fc2, sc2) = outs
    assert fc1.keys() == fc2.keys() and all(fc1[k] == pytest.approx(fc2[k], abs=1e-12) for k in fc1)
    assert sc1.keys() == sc2.keys() and all(sc1[k] == pytest.approx(sc2[k], abs=1e-9) for k in sc1)
