"""Lag/rolling features, calendar fill, folds (incl. the two published unit tests)."""

import datetime as dt

import pytest

from newsrisk.operators.anomalies import rolling_z
from newsrisk.operators.features import (
    fill_calendar,
    latest_feature_rows,
    risk_features,
    time_series_folds,
)


def _series(spark, n=20, cc="US", start=dt.date(2025, 1, 1), skip=()):
    rows = [(start + dt.timedelta(days=i), cc, float(i)) for i in range(n) if i not in skip]
    return spark.createDataFrame(rows, "date date, CountryCode string, risk_raw double")


def test_feature_columns_exist(spark):
    out = risk_features(_series(spark))
    for col in ["lag_1", "lag_7", "lag_14", "roll_mean_7", "roll_std_7", "target_next_day"]:
        assert col in out.columns


def test_target_and_lag_alignment(spark):
    rows = risk_features(_series(spark)).orderBy("date").collect()
    assert rows[0].target_next_day == 1
    assert rows[14].lag_14 == 0
    assert rows[19].target_next_day is None


def test_rolling_min_periods(spark):
    rows = risk_features(_series(spark)).orderBy("date").collect()
    assert rows[0].roll_mean_7 is None and rows[1].roll_mean_7 is None
    assert rows[2].roll_mean_7 == pytest.approx(1.0)
    assert rows[2].roll_std_7 == pytest.approx(1.0)
    assert rows[10].roll_mean_7 == pytest.approx(7.0)  # mean of 4..10


def test_row_lags_vs_calendar_lags(spark):
    s = _series(spark, n=10, skip=(3,))
    by_row = {r.date: r.lag_1 for r in risk_features(s).collect()}
    assert by_row[dt.date(2025, 1, 5)] == 2.0  # previous observation
    cal = {r.date: r for r in risk_features(s, calendar=True).collect()}
    assert cal[dt.date(2025, 1, 4)].risk_raw == 0.0  # filled day
    assert cal[dt.date(2025, 1, 5)].lag_1 == 0.0


def test_fill_calendar_per_country(spark):
    a = _series(spark, n=5, cc="A", skip=(2,))
    b = _series(spark, n=3, cc="B", start=dt.date(2025, 2, 1))
    out = fill_calendar(a.unionByName(b))
    counts = {r.CountryCode: r["count"] for r in out.groupBy("CountryCode").count().collect()}
    assert counts == {"A": 5, "B": 3}


def test_latest_row_dropped_when_incomplete(spark):
    short = _series(spark, n=14, cc="S")
    ok = _series(spark, n=15, cc="L")
    feats = risk_features(short.unionByName(ok))
    latest = latest_feature_rows(feats, ["lag_14", "roll_mean_7", "roll_std_7"])
    assert [r.CountryCode for r in latest.collect()] == ["L"]


def test_constant_series_z_is_zero(spark):
    rows = [(dt.date(2025, 1, 1) + dt.timedelta(days=i), "C", 5.0, 5.0, 0.3, 0.3) for i in range(10)]
    df = spark.createDataFrame(rows, "date date, CountryCode string, log_events double, log_mentions double, "
                                     "AvgTone double, AvgGoldstein double")
    z = rolling_z(df).collect()
    assert all(r.z_events_7d == 0.0 and r.z_tone_7d == 0.0 for r in z)


def test_two_rows_rolling_null_z_zero(spark):
    rows = [(dt.date(2025, 1, 1), "C", 1.0, 1.0, 1.0, 1.0), (dt.date(2025, 1, 2), "C", 2.0, 2.0, 2.0, 2.0)]
    df = spark.createDataFrame(rows, "date date, CountryCode string, log_events double, log_mentions double, "
                                     "AvgTone double, AvgGoldstein double")
    assert [r.z_events_7d for r in rolling_z(df).collect()] == [0.0, 0.0]


def test_time_series_folds_match_expanding_split(spark):
    n = 26
    folds = {r.rn: r.test_fold for r in time_series_folds(_series(spark, n=n)).collect()}
    t = n // 6
    for i in range(5):
        start = n - (5 - i) * t
        for rn in range(start, start + t):
            assert folds[rn] == i
    assert all(folds[rn] is None for rn in range(n - 5 * t))


def test_heatmap_wide_fills_zero(spark):
    from newsrisk.operators.charts import monthly_root_heatmap_wide

    rows = [("20250105", "N1", "14", 5), ("20250210", "N1", "14", 9), ("20250110", "N2", "01", 99)]
    df = spark.createDataFrame(rows, "SQLDATE string, CountryCode string, EventRootCode string, EventCount long")
    from newsrisk.operators.clean import clean_events

    full = clean_events(df.selectExpr("*", "CAST(NULL AS STRING) AS AvgTone", "CAST(NULL AS STRING) AS AvgGoldstein",
                                      "1 AS TotalMentions", "1 AS TotalArticles", "1 AS TotalSources"))
    wide = {r.EventRootLabel: r for r in monthly_root_heatmap_wide(full, 12).collect()}
    assert set(wide) == {"Protest", "Make Public Statement"}
    assert wide["Make Public Statement"]["2025-02-01"] == 0.0
    assert wide["Protest"]["2025-02-01"] == pytest.approx(1.0)


def test_null_country_dropped_from_country_tables_but_counted(spark):
    from newsrisk.operators.anomalies import country_day_panel
    from newsrisk.operators.clean import clean_events
    from newsrisk.operators.quality import dq_null_counts
    from newsrisk.operators.risk import country_risk_daily

    rows = [("20250101", None, "14", "3", "-3.0", "1.0", "1", "1", "1"),
            ("20250101", "NA", "14", "2", "1.0", "1.0", "1", "1", "1")]
    cols = "SQLDATE string, CountryCode string, EventRootCode string, EventCount string, AvgTone string, " \
           "AvgGoldstein string, TotalMentions string, TotalArticles string, TotalSources string"
    clean = clean_events(spark.createDataFrame(rows, cols))
    assert [r.CountryCode for r in country_risk_daily(clean).collect()] == ["NA"]
    assert [r.CountryCode for r in country_day_panel(clean).collect()] == ["NA"]
    missing = {r.column: r.missing for r in dq_null_counts(clean).collect()}
    assert missing["CountryCode"] == 1 and missing["date"] == 0


def test_top_k_ties_broken_by_key(spark):
    from newsrisk.operators.charts import top_countries

    rows = [("20250101", c, "01", 5) for c in ["C3", "C1", "C2", "C4"]]
    df = spark.createDataFrame(rows, "SQLDATE string, CountryCode string, EventRootCode string, EventCount long")
    df = df.selectExpr("*", "CAST('2025-01-01' AS DATE) AS date")
    assert [r.CountryCode for r in top_countries(df, 2).collect()] == ["C1", "C2"]
