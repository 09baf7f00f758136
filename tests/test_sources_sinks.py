"""Scans, schema choice, extract discovery, fallbacks, publishes."""

import datetime as dt
import os
import time

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from newsrisk.operators.clean import clean_events
from newsrisk.operators.events import extract_events_daily
from newsrisk.operators.themes import theme_daily
from newsrisk.sources import adapters, readers, sinks

from conftest import SF_SMALL


def test_article_fields(spark):
    from newsrisk.operators.themes import PLAIN_FIELDS, ArticleFields, article_fields, exploded_themes

    table = lambda *columns: spark.createDataFrame([], ", ".join(f"{c} string" for c in ("dt", *columns)))
    assert article_fields(table("Themes", "V2Themes", "V2Tone", "Tone")) == ArticleFields()
    assert article_fields(table("Themes", "V2Tone")) == ("Themes", "V2Tone")
    assert exploded_themes(table("V2Themes", "Themes", "Tone"), fields=PLAIN_FIELDS).count() == 0
    with pytest.raises(AnalysisException, match="Themes"):
        exploded_themes(table("Tone"))


def test_theme_fallback_fields_and_empty_items(spark):
    df = spark.createDataFrame(
        [(dt.date(2025, 1, 1), None, "1,2"), (dt.date(2025, 1, 1), "", "1,2"), (dt.date(2025, 1, 1), "A;B;;A;", "-3,9")],
        "dt date, Themes string, Tone string",
    )
    out = {(r.theme, r.ArticleCount, r.AvgTone) for r in theme_daily(df).collect()}
    assert out == {("A", 2, -3.0), ("B", 1, -3.0)}


def test_strip_offsets(spark):
    df = spark.createDataFrame([(dt.date(2025, 1, 1), "A,12;B,40;A,7", "1,0")], "dt date, V2Themes string, V2Tone string")
    out = {(r.theme, r.ArticleCount) for r in theme_daily(df, strip_offsets=True).collect()}
    assert out == {("A", 2), ("B", 1)}
    raw = {r.theme for r in theme_daily(df).collect()}
    assert raw == {"A,12", "B,40", "A,7"}


def test_partition_pruning_on_real_layout(spark, scratch):
    raw = adapters.dense_events(spark, SF_SMALL)
    path = scratch + "/raw_events"
    sinks.write_parquet(raw, path, partition_by=["dt"])
    part = readers.read_raw(spark, path)
    q = extract_events_daily(part, "2024-01-05", "2024-01-10")
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan and "2024-01-05" in plan and "2024-01-10" in plan
    q.collect()
    scans = [n for n in _leaves(q._jdf.queryExecution().executedPlan()) if "FileSourceScan" in n.getClass().getName()]
    assert scans and scans[0].metrics().apply("numPartitions").value() == 5  # 5 of 30 dt directories
    direct = extract_events_daily(readers.scan_window(raw, "2024-01-05", "2024-01-10"))
    assert sorted(map(tuple, q.collect())) == sorted(map(tuple, direct.collect()))


def _leaves(plan):
    """Leaf nodes of an executed (adaptive) plan."""
    name = plan.getClass().getName()
    if "AdaptiveSparkPlanExec" in name:
        return _leaves(plan.executedPlan())
    if "QueryStageExec" in name:
        return _leaves(plan.plan())
    kids = plan.children()
    out = [] if kids.size() else [plan]
    for i in range(kids.size()):
        out.extend(_leaves(kids.apply(i)))
    return out


def test_latest_extract_by_name_and_mtime(spark, scratch):
    ex = extract_events_daily(adapters.dense_events(spark, SF_SMALL), ordered=False)
    sinks.write_extract_csv(ex, scratch, "2024-01-01", "2024-01-31")
    time.sleep(1.1)
    p_old = sinks.write_extract_csv(ex.limit(5), scratch, "2023-12-01", "2023-12-31")
    assert readers.latest_extract(spark, scratch, by="name").endswith("events_daily_20240101_20240131.csv")
    assert readers.latest_extract(spark, scratch, by="mtime").endswith(os.path.basename(p_old))
    with pytest.raises(FileNotFoundError):
        readers.latest_extract(spark, scratch + "/none")


def test_csv_keeps_codes_text(spark, scratch):
    ex = extract_events_daily(adapters.dense_events(spark, SF_SMALL), ordered=False)
    p = sinks.write_extract_csv(ex, scratch, "2024-01-01", "2024-01-31")
    back = readers.read_extract_csv(spark, p)
    assert dict(back.dtypes)["EventRootCode"] == "string"
    assert back.count() == ex.count()


def test_read_clean_fallback(spark, scratch):
    ex = extract_events_daily(adapters.dense_events(spark, SF_SMALL), ordered=False)
    clean = clean_events(ex)
    gz = scratch + "/events_daily_clean.csv.gz"
    clean.write.option("header", True).option("compression", "gzip").csv(gz)
    back = readers.read_clean(spark, scratch)
    assert back.count() == clean.count()
    assert dict(back.dtypes)["EventCount"] == "bigint"
    with pytest.raises(FileNotFoundError):
        readers.read_clean(spark, scratch + "/missing")


def test_publish_drops_undated_and_replaces(spark, scratch):
    df = spark.createDataFrame([(dt.date(2025, 1, 1), 1), (None, 2)], "date date, v int")
    target = scratch + "/pub"
    sinks.publish(df, target, drop_null="date")
    sinks.publish(df, target, drop_null="date")  # full replace, not append
    assert spark.read.parquet(target).count() == 1


def test_top_csv_single_file(spark, scratch):
    df = spark.range(50).withColumn("x", F.col("id") * 2)
    p = sinks.write_top_csv(df, scratch + "/top50")
    parts = [f for f in os.listdir(p) if f.startswith("part-")]
    assert len(parts) == 1


def test_publish_may_replace_its_own_source(spark, scratch):
    target = scratch + "/self"
    sinks.publish(spark.range(10).withColumnRenamed("id", "v"), target)
    derived = spark.read.parquet(target).where(F.col("v") % 2 == 0)
    sinks.publish(derived, target)  # staged write, then swap: the source is intact while it is read
    assert sorted(r.v for r in spark.read.parquet(target).collect()) == [0, 2, 4, 6, 8]
    assert not [p for p in os.listdir(scratch) if "_staging_" in p]


def test_faulty_lines_go_to_quarantine(spark, scratch):
    from newsrisk.plans.jobs import Layout, ingest_extract

    path = f"{scratch}/extracts/events_daily_20240101_20240102.csv"
    os.makedirs(path.replace("file:", ""))
    with open(f"{path.replace('file:', '')}/part-0.csv", "w") as f:
        f.write(",".join(readers.EXTRACT_COLUMNS) + "\n20240101,US,01,5,1.0,2.0,3,4,5\n20240101,US,02,5\n20240101,FR,03,5,1.0,2.0,3,4,5,6\n20240102,,04,,,,,,\n")
    good = readers.read_extract_csv(spark, path)
    assert good.count() == 3 and sorted(r.EventRootCode for r in good.select("EventRootCode").collect()) == ["01", "02", "04"]
    assert good.where("EventRootCode = '02'").first().TotalSources is None
    out = ingest_extract(spark, Layout(scratch), path)
    assert sorted((r.line, r.kept) for r in spark.read.parquet(out["quarantine"]).collect()) == [("20240101,FR,03,5,1.0,2.0,3,4,5,6", False), ("20240101,US,02,5", True)]
    log = spark.read.parquet(out["run_log"]).first()
    assert (log.rows, log.faulty_lines) == (3, 2)
    assert spark.read.parquet(f"{out['quality']}/coverage").first().rows == 3
    assert spark.read.parquet(f"{out['quality']}/missing").where("column = 'CountryCode'").first().missing == 1


def test_footer_coverage_reads_no_row(spark, scratch):
    from newsrisk.operators.quality import footer_coverage

    df = spark.range(1000).select(F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 400).cast("int")).alias("date"), "id")
    sinks.write_parquet(df.repartition(3), f"{scratch}/t")
    out = footer_coverage(spark, f"{scratch}/t")
    assert "PushedAggregation: [COUNT(*), MIN(date), MAX(date)]" in out._jdf.queryExecution().executedPlan().toString()
    assert tuple(out.first()) == (1000, dt.date(2024, 1, 1), dt.date(2025, 2, 3))
    assert spark.conf.get("spark.sql.sources.useV1SourceList") != ""


def test_readers_of_a_catalog_table_see_whole_versions(spark, scratch):
    import threading
    import uuid

    name, seen, wrong, stop = f"versions_{uuid.uuid4().hex[:8]}", set(), [], threading.Event()
    version = lambda v: spark.range(200).repartition(4).select("id", F.lit(v).alias("v"))
    sinks.publish(version(0), name)

    def read():
        while not stop.is_set():
            try:
                rows = spark.table(name).groupBy("v").count().collect()
                if len(rows) != 1 or rows[0]["count"] != 200:
                    wrong.append(rows)
                seen.add(rows[0].v)
            except Exception as e:  # noqa: BLE001
                wrong.append(e)

    reader = threading.Thread(target=read)
    reader.start()
    try:
        for v in range(1, 7):
            sinks.publish(version(v), name)
    finally:
        stop.set()
        reader.join()
        assert not wrong and len(seen) >= 2
        assert len(sinks.table_versions(spark, name)) == 2
        assert spark.table(name).select("v").distinct().first().v == 6
        sinks.publish(spark.range(3).withColumn("other", F.lit("x")), name)  # other columns
        assert spark.table(name).columns == ["id", "other"]
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_output_positions(spark):
    from newsrisk.operators.ranking import output_positions

    df = spark.range(500).select((F.xxhash64("id") % 97).alias("k"), "id").repartition(7).orderBy("k", "id")
    got = output_positions(df).collect()
    assert sorted((r.position, r.k, r.id) for r in got) == [(i + 1, r.k, r.id) for i, r in enumerate(df.collect())]


def test_top_themes_are_exact_whatever_the_sample(spark, monkeypatch):
    from collections import Counter

    from newsrisk.operators import themes as TH

    rows = [(dt.date(2024, 1, 1), ";".join(f"t{(i * j) % (7 + i % 40)}" for j in range(30)), "1,2") for i in range(300)]
    df = spark.createDataFrame(rows, "dt date, V2Themes string, V2Tone string")
    count = Counter(t for _, x, _ in rows for t in x.split(";"))
    want = sorted(((-n, t) for t, n in count.items()))[:12]
    for step, buckets, per_k in ((1, 1 << 16, 4), (1 << 40, 1 << 16, 4), (3, 4, 1), (1, 2, 1)):  # a whole sample, none, few buckets
        monkeypatch.setattr(TH, "SAMPLE_STEP", step)
        monkeypatch.setattr(TH, "BUCKETS", buckets)
        monkeypatch.setattr(TH, "LIKELY_PER_K", per_k)
        got = [(-r.mentions, r.theme) for r in TH.top_themes_of_articles(df, k=12).collect()]
        assert got == want
