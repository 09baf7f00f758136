"""End-to-end jobs (V1 events, V2 themes, V3 risk + forecast, anomalies, refresh).

Each stage writes its table once (Parquet, overwrite) and the next stage reads
that table back. That cuts lineage at every published table: downstream jobs
never re-scan raw data, and a lost executor recomputes from the last written
table, not from the raw scan.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsrisk.operators import anomalies as AN
from newsrisk.operators import forecast as FC
from newsrisk.operators import quality as QA
from newsrisk.operators.clean import clean_events
from newsrisk.operators.events import extract_events_daily
from newsrisk.operators.features import risk_features
from newsrisk.operators.risk import country_risk_daily
from newsrisk.operators.themes import theme_daily
from newsrisk.sources import readers, sinks
from newsrisk.sources.readers import DateLike


@dataclass
class Layout:
    """Folder layout of one deployment (all paths on the shared file system)."""

    root: str

    def _p(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    @property
    def extracts(self) -> str:
        return self._p("extracts")

    @property
    def processed(self) -> str:
        return self._p("processed")

    @property
    def clean(self) -> str:
        return self._p("processed/events_daily_clean.parquet")

    @property
    def published_clean(self) -> str:
        return self._p("published/events_daily_clean")

    @property
    def risk(self) -> str:
        return self._p("published/country_risk_daily")

    @property
    def forecasts(self) -> str:
        return self._p("published/country_risk_forecasts_next_day")

    @property
    def model(self) -> str:
        return self._p("models/country_risk_next_day")

    @property
    def anomalies(self) -> str:
        return self._p("reports/anomalies")

    @property
    def run_log(self) -> str:
        return self._p("reports/runlogs/latest")

    @property
    def quality(self) -> str:
        return self._p("reports/quality")

    @property
    def quarantine(self) -> str:
        return self._p("quarantine")

    def themes(self, start: DateLike, end: DateLike) -> str:
        s, e = str(start).replace("-", ""), str(end).replace("-", "")
        return self._p(f"published/gkg_theme_daily_{s}_{e}")


def run_events(spark: SparkSession, raw: DataFrame, layout: Layout, start: DateLike, end: DateLike) -> dict:
    """V1: extract (CSV) -> run log, faulty lines -> clean (Parquet) -> publish (undated rows dropped), quality tables."""
    extract = extract_events_daily(raw, start, end)
    path = sinks.write_extract_csv(extract, layout.extracts, start, end)
    # the file just written, whatever other windows lie in the folder (a back-fill has an older name)
    return ingest_extract(spark, layout, path)


def ingest_extract(spark: SparkSession, layout: Layout, path: str) -> dict:
    """An extract's run log, faulty lines, clean table, quality tables and publish."""
    name = path.rsplit("/", 1)[-1]
    extract, faulty = readers.read_extract_csv(spark, path), readers.faulty_lines(spark, path)
    quarantine = sinks.publish(faulty, f"{layout.quarantine}/{name}")
    _publish_run_log(spark, layout, QA.run_log(extract, name, spark.read.parquet(quarantine)))
    clean = clean_events(extract)
    sinks.write_parquet(clean, layout.clean)
    published = readers.read_clean(spark, layout.processed)
    sinks.publish(published, layout.published_clean, drop_null="date")
    for table, df in quality_report(spark, layout).items():
        sinks.publish(df, f"{layout.quality}/{table}")
    return {"extract": path, "run_log": layout.run_log, "clean": layout.clean, "published": layout.published_clean, "quarantine": quarantine, "quality": layout.quality}


def _publish_run_log(spark: SparkSession, layout: Layout, row: DataFrame) -> None:
    """The latest run only."""
    sinks.publish(row.withColumn("run_timestamp", F.current_timestamp()), layout.run_log)


def run_themes(
    spark: SparkSession, articles: DataFrame, layout: Layout, start: DateLike, end: DateLike, top_k: int = 200
) -> str:
    """V2: theme-day table for the top-k themes of the window."""
    target = layout.themes(start, end)
    sinks.publish(theme_daily(articles, start, end, top_k=top_k), target)
    return target


def run_risk_forecast(
    spark: SparkSession,
    layout: Layout,
    variant: str = "share_log",
    run_date: _dt.date | str | None = None,
    trees: int = 500,
    seed: int = 42,
) -> dict:
    """V3: risk table from the published clean table, then the next-day snapshot."""
    clean = spark.read.parquet(layout.published_clean)
    sinks.publish(country_risk_daily(clean, variant=variant), layout.risk)
    risk = readers.risk_series(
        spark.read.parquet(layout.risk),
        ["date", "CountryCode", "total_events", "conflict_share", "negative_share", "weighted_avg_tone", "risk_raw"],
    )
    feats = risk_features(risk)
    backtest = FC.forecast_backtest(feats, trees=trees, seed=seed).first()
    snapshot = FC.forecast_next_day(feats, run_date, trees=trees, seed=seed, model_path=layout.model)
    sinks.publish(snapshot, layout.forecasts)
    return {"risk": layout.risk, "forecasts": layout.forecasts, "model": layout.model, "backtest_mae": backtest["mae"] if backtest else None}


def run_anomalies(spark: SparkSession, layout: Layout, trees: int = 300, seed: int = 42) -> dict:
    """Anomaly report: scored panel, top-50 CSV, top-country overlay."""
    clean = readers.read_clean(spark, layout.processed)
    scored = AN.detect_anomalies(clean, trees=trees, seed=seed)
    top = sinks.write_top_csv(AN.top_anomalies(scored, 50), f"{layout.anomalies}/top_50_country_day_anomalies.csv")
    overlay = f"{layout.anomalies}/top_country_eventcount"
    sinks.write_parquet(AN.top_country_anomalies(scored), overlay)
    return {"top50": top, "overlay": overlay}


def run_refresh(
    spark: SparkSession,
    raw: DataFrame,
    layout: Layout,
    start: DateLike,
    end: DateLike,
    run_date: _dt.date | str | None = None,
    trees: int = 500,
) -> DataFrame:
    """Daily refresh of every table, then the freshness checks (one row)."""
    written = run_events(spark, raw, layout, start, end)
    run_risk_forecast(spark, layout, run_date=run_date, trees=trees)
    return QA.published_freshness(spark, layout.published_clean, layout.risk, layout.forecasts, readers.read_extract_csv(spark, written["extract"]))


def refresh_run_log(spark: SparkSession, layout: Layout) -> str:
    """Publish the run-log row of the newest extract; without an extract, a row whose status says so."""
    try:
        latest = readers.latest_extract(spark, layout.extracts)
    except FileNotFoundError:
        row = QA.run_log_without_extract(spark, layout.extracts)
    else:
        row = QA.run_log(readers.read_extract_csv(spark, latest), latest.rsplit("/", 1)[-1], readers.faulty_lines(spark, latest)).withColumn("status", F.lit("ok"))
    _publish_run_log(spark, layout, row)
    return layout.run_log


def quality_report(spark: SparkSession, layout: Layout) -> dict[str, DataFrame]:
    """The data-quality tables of the clean table (coverage, missing values, top roots)."""
    clean = readers.read_clean(spark, layout.processed)
    return {
        "coverage": QA.dq_coverage(clean),
        "missing": QA.dq_null_counts(clean),
        "top_roots": QA.dq_top_roots(clean),
    }
