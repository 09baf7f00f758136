"""One test per fault that was found and mended."""

import datetime as dt
import gzip

import pytest
from pyspark.sql import functions as F

from newsrisk.operators import anomalies as AN
from newsrisk.operators import forecast as FC
from newsrisk.operators.clean import clean_events
from newsrisk.operators.events import stable_avg
from newsrisk.operators.features import SERIES_FEATURE_COLS, TARGET, holdout_split, risk_features, training_rows
from newsrisk.operators.isolation import fit_isolation_forest
from newsrisk.operators.quantiles import exact_percentiles
from newsrisk.operators.risk import country_risk_daily
from newsrisk.operators.events import extract_events_daily
from newsrisk.plans.jobs import Layout, refresh_run_log
from newsrisk.sources import adapters, readers, sinks

from conftest import SF_MED


def test_nan_tone_is_a_missing_value(spark):
    rows = [("20250101", "US", "1", "5", "NaN", "1"), ("20250102", "US", "1", "5", "2", "NaN"), ("20250103", "US", "1", "5", "3", "x")]
    df = spark.createDataFrame(rows, "SQLDATE string, CountryCode string, EventRootCode string, EventCount string, AvgTone string, AvgGoldstein string")
    df = df.withColumns({c: F.lit("1") for c in ("TotalMentions", "TotalArticles", "TotalSources")})
    clean = clean_events(df)
    assert [r.AvgTone for r in clean.orderBy("date").collect()] == [None, 2.0, 3.0]
    z = AN.feature_scaling(AN.rolling_z(AN.country_day_panel(clean)))
    assert all(v == v for r in z.collect() for v in (r.z_tone_7d, r.z_tone_7d_s, r.z_goldstein_7d_s))
    raw_nan = spark.createDataFrame([(dt.date(2025, 1, 1), "US", float("nan"))], "date date, CountryCode string, AvgTone double")
    assert AN.rolling_z(raw_nan, [("AvgTone", "z")]).first().z == 0.0


def test_bad_date_in_the_gzipped_copy_is_null(spark, scratch):
    import os

    os.makedirs(scratch.removeprefix("file:"), exist_ok=True)
    with gzip.open(f"{scratch.removeprefix('file:')}/events_daily_clean.csv.gz", "wt") as f:
        f.write("SQLDATE,CountryCode,EventRootCode,EventCount,AvgTone,AvgGoldstein,TotalMentions,TotalArticles,TotalSources,date,EventRootLabel,ToneBucket\n")
        f.write("20250101,US,01,5,1.5,1,1,1,1,2025-01-01,Make Public Statement,neutral\nx,US,01,5,1.5,1,1,1,1,not a date,Make Public Statement,neutral\n")
    assert sorted(str(r.date) for r in readers.read_clean(spark, scratch).collect()) == ["2025-01-01", "None"]


def test_mean_of_large_values(spark):
    big = spark.createDataFrame([(1e12,)] * 16 + [(-1e15,)] * 4, "x double")
    assert big.agg(stable_avg("x").alias("m")).first().m == pytest.approx((16e12 - 4e15) / 20)
    odd = spark.createDataFrame([(1e300,), (1.0,), (None,)], "x double")
    assert odd.agg(stable_avg("x").alias("m")).first().m == pytest.approx(5e299)
    assert odd.where("x is null").agg(stable_avg("x").alias("m")).first().m is None


def test_percentiles_of_nothing(spark):
    empty = spark.createDataFrame([], "g int, v double")
    assert exact_percentiles(empty, "v", [0.5], ["g"]).collect() == [] and exact_percentiles(empty, "v", [0.5]).collect() == []


def test_brackets_close_in_over_several_rounds(spark):
    df = spark.range(20000).select((F.col("id") % 2).alias("g"), (F.xxhash64("id") % 100000).cast("double").alias("v"))
    probs = [0.0, 0.013, 0.5, 0.999, 1.0]
    got = {r.g: [r[f"q{i}"] for i in range(5)] for r in exact_percentiles(df, "v", probs, ["g"], accuracy=20).collect()}
    want = {r.g: r.q for r in df.groupBy("g").agg(F.percentile("v", F.array(*map(F.lit, probs))).alias("q")).collect()}
    assert all(got[g] == pytest.approx(want[g], abs=1e-9) for g in want)


def test_failed_rename_leaves_the_old_table(spark, scratch, monkeypatch):
    target = f"{scratch}/table"
    sinks.publish(spark.range(3), target)
    monkeypatch.setattr(sinks, "_rename", lambda fs, src, dst: False)
    with pytest.raises(OSError):
        sinks.publish(spark.range(5), target)
    assert spark.read.parquet(target).count() == 3
    monkeypatch.undo()
    sinks.publish(spark.read.parquet(target).unionByName(spark.range(4)), target)  # from its own rows
    assert spark.read.parquet(target).count() == 7


def test_catalog_table_may_be_replaced_from_itself(spark):
    name = "newsrisk_published"
    try:
        sinks.publish(spark.range(3).withColumn("p", F.col("id") % 2), name, partition_by=["p"])
        sinks.publish(spark.table(name).where("id > 0"), name, drop_null="id")
        assert spark.table(name).count() == 2
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_run_log_without_an_extract(spark, scratch):
    layout = Layout(scratch)
    row = spark.read.parquet(refresh_run_log(spark, layout)).first()
    assert row.file is None and row.rows == 0 and "no extract" in row.status
    sinks.write_extract_csv(extract_events_daily(adapters.dense_events(spark, "/root/testdata/sf0.001")), layout.extracts, "2024-01-01", "2024-01-31")
    row = spark.read.parquet(refresh_run_log(spark, layout)).first()
    assert row.file == "events_daily_20240101_20240131.csv" and row.rows > 0 and row.status == "ok"


@pytest.mark.parametrize("trees,sample,n", [(3, 64, 5000), (40, 64, 300), (10, 64, 20), (7, 10, 70)])
def test_every_tree_gets_its_sample_whatever_the_partitioning(spark, trees, sample, n):
    df = spark.range(n).select(F.col("id").alias("k"), (F.xxhash64("id") % 1000 / 1000.0).alias("a"), (F.xxhash64("id", F.lit(1)) % 1000 / 1000.0).alias("b"))
    fit = lambda d: sorted((tuple(r) for r in fit_isolation_forest(d, ["a", "b"], ["k"], trees, sample).collect()), key=lambda r: r[:2])
    first = fit(df.repartition(3))
    roots = [r for r in first if r[1] == 1]
    assert len(roots) == trees and {r[3] for r in roots} == {min(sample, n)}
    assert fit(df.repartition(11)) == first


def test_forest_is_repeatable_and_better_than_naive_forecasts(spark):
    from newsrisk.operators.forecast import fit_forest

    old = spark.conf.get("spark.sql.shuffle.partitions")
    predictions, errors = [], {}
    try:
        for n in ("3", "8", "13"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            feats = risk_features(country_risk_daily(clean_events(extract_events_daily(adapters.RAW_EVENTS["sparse"](spark, SF_MED), ordered=False)), ordered=False))
            rows = FC.materialize(holdout_split(training_rows(feats, SERIES_FEATURE_COLS)))
            model = fit_forest(rows.where("not is_holdout"), SERIES_FEATURE_COLS, trees=12, max_depth=12)
            out = model.predict(rows.where("is_holdout")).select("date", "CountryCode", "prediction", TARGET, "risk_raw", "roll_mean_7").collect()
            predictions.append({(r.date, r.CountryCode): r.prediction for r in out})
            errors = {c: sum(abs(r[TARGET] - r[c]) for r in out) / len(out) for c in ("prediction", "risk_raw", "roll_mean_7")}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert predictions[0] == predictions[1] == predictions[2]
    assert errors["prediction"] < errors["roll_mean_7"] and errors["prediction"] < errors["risk_raw"]
