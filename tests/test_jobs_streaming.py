"""End-to-end jobs and the incremental (streaming) extract."""

import os

from pyspark.sql import functions as F

from newsrisk.operators.clean import clean_events
from newsrisk.operators.events import extract_events_daily
from newsrisk.operators.risk import country_risk_daily
from newsrisk.plans.jobs import Layout, quality_report, run_anomalies, run_events, run_refresh, run_themes
from newsrisk.sources import adapters, sinks
from newsrisk.streaming import read_incremental_extract, run_incremental_extract

from conftest import SF_SMALL


def _rows(df):
    return sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.collect())


def test_incremental_extract_equals_batch(spark, scratch):
    raw = adapters.dense_events(spark, SF_SMALL)
    sinks.write_parquet(raw.where(F.col("dt") < "2024-01-12"), f"{scratch}/raw", ["dt"])
    run_incremental_extract(spark, f"{scratch}/raw", f"{scratch}/out", f"{scratch}/ckpt", max_files_per_trigger=3)
    raw.where(F.col("dt") >= "2024-01-12").write.mode("append").partitionBy("dt").parquet(f"{scratch}/raw")
    out = run_incremental_extract(spark, f"{scratch}/raw", f"{scratch}/out", f"{scratch}/ckpt", max_files_per_trigger=3)
    batch = extract_events_daily(raw, ordered=False)
    cols = batch.columns
    assert _rows(out.select(*cols)) == _rows(batch)
    n_batches = len(os.listdir(f"{scratch}/out/partials".replace("file:", "")))
    run_incremental_extract(spark, f"{scratch}/raw", f"{scratch}/out", f"{scratch}/ckpt")  # nothing new
    assert len(os.listdir(f"{scratch}/out/partials".replace("file:", ""))) == n_batches
    assert _rows(read_incremental_extract(spark, f"{scratch}/out").select(*cols)) == _rows(batch)


def test_refresh_end_to_end(spark, scratch):
    layout = Layout(scratch)
    raw = adapters.dense_events(spark, "/root/testdata/sf0.01")
    checks = run_refresh(spark, raw, layout, "2024-01-01", "2024-01-31", run_date="2024-02-01", trees=10).first()
    assert checks.risk_matches_clean and checks.forecast_is_next_day
    assert checks.forecast_rows == 25
    rep = quality_report(spark, layout)
    assert rep["coverage"].first()["rows"] == 3995
    log = spark.read.parquet(layout.run_log).first()
    assert log.rows == 3995 and log.file == "events_daily_20240101_20240131.csv" and log.min_sqldate == "20240101"
    out = run_anomalies(spark, layout, trees=20)
    top = spark.read.option("header", True).csv(out["top50"])
    assert top.count() == 50


def test_back_fill_publishes_its_own_window(spark, scratch):
    layout, raw = Layout(scratch), adapters.dense_events(spark, SF_SMALL)
    run_events(spark, raw, layout, "2024-01-20", "2024-01-31")
    run_events(spark, raw, layout, "2024-01-01", "2024-01-10")
    span = spark.read.parquet(layout.published_clean).agg(F.min("date"), F.max("date")).first()
    assert str(span[0]) >= "2024-01-01" and str(span[1]) < "2024-01-11"
    assert spark.read.parquet(layout.run_log).first().file == "events_daily_20240101_20240110.csv"


def test_themes_job(spark, scratch):
    layout = Layout(scratch)
    target = run_themes(spark, adapters.articles(spark, SF_SMALL), layout, "2024-01-01", "2024-02-01", top_k=20)
    df = spark.read.parquet(target)
    assert df.select("theme").distinct().count() == 20


def test_command_line(spark, scratch, capsys):
    import json

    from newsrisk.__main__ import main

    sinks.write_parquet(adapters.dense_events(spark, SF_SMALL), f"{scratch}/raw", ["dt"])
    root = f"{scratch}/deploy"
    common = ["--root", root, "--shuffle-partitions", "8"]
    assert main(["events", "--raw", f"{scratch}/raw", "--start", "2024-01-01", "--end", "2024-01-31", *common]) == 0
    assert main(["risk-forecast", "--run-date", "2024-02-01", "--trees", "5", *common]) == 0
    assert main(["quality", *common]) == 0
    out = capsys.readouterr().out.strip().splitlines()
    report = json.loads(out[-1])
    assert main(["runlog", *common]) == 0
    log = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert log["status"] == "ok" and log["rows"] == report["coverage"][0]["rows"] and log["faulty_lines"] == 0
    assert report["coverage"][0]["rows"] > 0


def test_refresh_of_changed_days_equals_a_rebuild(spark, scratch):
    """Late rows of two days, one of them a day a country did not have: only the days in reach are rewritten."""
    import datetime as dt
    import random

    from newsrisk.operators.features import risk_features
    from newsrisk.plans.refresh import refresh_days

    rng = random.Random(8)
    day = dt.date(2024, 3, 1)
    rows = []
    for i in range(60):
        for c in ("US", "FR", "CD"):
            if c == "CD" and i % 4 == 1:  # gaps
                continue
            for _ in range(3):
                d = day + dt.timedelta(days=i)
                rows.append((d, int(d.strftime("%Y%m%d")), c, str(rng.randrange(20)), rng.uniform(-9, 5), rng.uniform(-9, 9), 1, 2, 3))
    schema = "dt date, SQLDATE long, ActionGeo_CountryCode string, EventRootCode string, AvgTone double, GoldsteinScale double, NumMentions long, NumArticles long, NumSources long"
    late = [(day + dt.timedelta(days=25), 20240326, "CD", "14", -5.0, 1.0, 1, 1, 1), (day + dt.timedelta(days=27), 20240326, "US", "3", -1.0, 1.0, 1, 1, 1)]
    first, second = spark.createDataFrame(rows, schema), spark.createDataFrame(late, schema)
    root = f"{scratch}/tables"
    refresh_days(spark, first, first, root)
    files = lambda t: {(d, f) for d in os.listdir(f"{root}/{t}".replace("file:", "")) if d.startswith("date=") for f in os.listdir(f"{root}/{t}/{d}".replace("file:", ""))}
    before = {t: files(t) for t in ("clean", "risk", "features")}
    out = refresh_days(spark, first.unionByName(second), second, root)
    assert out["days"] == [20240326]
    changed = {t: {d for d, _ in files(t) ^ before[t]} for t in before}
    assert changed["clean"] == changed["risk"] == {"date=2024-03-26"}
    assert changed["features"] == {f"date={d}" for d in out["feature_days"]} and 16 <= len(changed["features"]) < 25
    whole = first.unionByName(second)
    risk = country_risk_daily(clean_events(extract_events_daily(whole, ordered=False)), ordered=False)
    for table, want in (("risk", risk), ("features", risk_features(risk))):
        got = spark.read.parquet(f"{root}/{table}").select(*want.columns)
        assert _rows(got.fillna(-1.0)) == _rows(want.fillna(-1.0))
    nothing = second.limit(0)
    assert refresh_days(spark, whole, nothing, root) == {"days": [], "feature_days": []}
