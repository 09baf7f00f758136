"""Registered queries (Spark) and their DuckDB oracle text.

``QUERIES[name](spark, sf_dir) -> DataFrame`` runs an operator over the whole
driver tables; ``ORACLE[name]`` is the same computation as DuckDB SQL. Final
double columns are rounded to 10 decimals on both sides so that summation
order cannot change the comparison.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsrisk.functions.codes import lpad_root_code, normalize_root_code
from newsrisk.functions.scalars import parse_yyyymmdd
from newsrisk.operators import anomalies as AN
from newsrisk.operators import charts as CH
from newsrisk.operators import dashboards as DB
from newsrisk.operators import features as FE
from newsrisk.operators import forecast as FC
from newsrisk.operators import quality as QA
from newsrisk.operators import themes as TH
from newsrisk.operators.clean import CLEAN_COLUMNS, clean_events
from newsrisk.operators.events import extract_events_daily
from newsrisk.operators.ranking import output_positions
from newsrisk.operators.risk import country_risk_daily
from newsrisk.plans import jobs
from newsrisk.plans import sqltext as S
from newsrisk.plans.refresh import refresh_days
from newsrisk.session import checkpoint_dir, materialize
from newsrisk.sources import adapters, readers, sinks
from newsrisk.streaming import run_incremental_extract

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

# Window used by the scan/preview queries (half-open; inside the dense data's month).
WINDOW = ("2024-01-05", "2024-01-20")


def rounded(df: DataFrame, digits: int = 10) -> DataFrame:
    """Round every DOUBLE column (final output only)."""
    return df.select(
        *[
            F.round(F.col(f.name), digits).alias(f.name) if isinstance(f.dataType, T.DoubleType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


# ---- shared stages -------------------------------------------------------------


def raw_events(spark, sf_dir, kind="dense"):
    return adapters.RAW_EVENTS[kind](spark, sf_dir)


def extract(spark, sf_dir, kind="dense"):
    return extract_events_daily(raw_events(spark, sf_dir, kind), ordered=False)


def clean(spark, sf_dir, kind="dense"):
    return clean_events(extract(spark, sf_dir, kind))


def risk(spark, sf_dir, kind="dense", variant="share_log"):
    return country_risk_daily(clean(spark, sf_dir, kind), variant=variant, ordered=False)


def _chain(kind="dense", upto="clean", window=""):
    return S.events_chain(kind, upto, window)


# ---- S: scans --------------------------------------------------------------------

register(
    "scan_window",
    S.with_ctes(
        _chain(upto="raw_events"),
        f"SELECT dt, COUNT(*) AS n_events, COUNT(ActionGeo_CountryCode) AS n_geo, "
        f"CAST(SUM(NumMentions) AS BIGINT) AS mentions FROM raw_events "
        f"WHERE dt >= DATE '{WINDOW[0]}' AND dt < DATE '{WINDOW[1]}' GROUP BY dt",
    ),
)(
    lambda spark, sf_dir: readers.scan_window(raw_events(spark, sf_dir), *WINDOW)
    .groupBy("dt")
    .agg(
        F.count(F.lit(1)).alias("n_events"),
        F.count("ActionGeo_CountryCode").alias("n_geo"),
        F.sum("NumMentions").cast("bigint").alias("mentions"),
    )
)

register(
    "sample_preview",
    S.with_ctes(
        _chain(upto="raw_events"),
        "SELECT SQLDATE, Actor1CountryCode, Actor2CountryCode, EventCode, EventRootCode, GoldsteinScale, "
        "NumMentions, NumSources, NumArticles, ROUND(AvgTone, 10) AS AvgTone FROM raw_events "
        f"WHERE dt >= DATE '{WINDOW[0]}' AND dt < DATE '{WINDOW[1]}' ORDER BY GLOBALEVENTID LIMIT 10",
    ),
)(lambda spark, sf_dir: rounded(readers.sample_preview(raw_events(spark, sf_dir), *WINDOW)))


# ---- A1 / clean / risk -------------------------------------------------------------

_EXTRACT_COLS = (
    "SQLDATE, CountryCode, EventRootCode, EventCount, ROUND(AvgTone, 10) AS AvgTone, "
    "ROUND(AvgGoldstein, 10) AS AvgGoldstein, TotalMentions, TotalArticles, TotalSources"
)
_CLEAN_COLS = _EXTRACT_COLS + ", date, EventRootLabel, ToneBucket"
_RISK_COLS = (
    "date, CountryCode, total_events, conflict_events, negative_tone_events, "
    + ", ".join(
        S.r(c) for c in ["weighted_avg_tone", "conflict_share", "negative_share", "log_events", "risk_raw"]
    )
)

for _kind in ("dense", "sparse"):

    def _mk(kind):
        register(
            f"extract_events_daily{'' if kind == 'dense' else '_sparse'}",
            S.with_ctes(_chain(kind, "extract"), f"SELECT {_EXTRACT_COLS} FROM extract"),
        )(lambda spark, sf_dir: rounded(extract_events_daily(raw_events(spark, sf_dir, kind))))
        register(
            f"events_daily_clean{'' if kind == 'dense' else '_sparse'}",
            S.with_ctes(_chain(kind, "clean"), f"SELECT {_CLEAN_COLS} FROM clean"),
        )(lambda spark, sf_dir: rounded(clean(spark, sf_dir, kind)))
        register(
            f"country_risk_daily{'' if kind == 'dense' else '_sparse'}",
            S.with_ctes(_chain(kind, "risk"), f"SELECT {_RISK_COLS} FROM risk"),
        )(lambda spark, sf_dir: rounded(country_risk_daily(clean(spark, sf_dir, kind))))

    _mk(_kind)

register(
    "country_risk_weighted10",
    S.with_ctes(
        _chain("dense", "clean") + [("risk10", S.RISK_WEIGHTED10)],
        "SELECT date, CountryCode, total_events, conflict_events, "
        + ", ".join(S.r(c) for c in ["conflict_share", "negative_share", "weighted_avg_tone", "risk_raw"])
        + " FROM risk10",
    ),
)(lambda spark, sf_dir: rounded(country_risk_daily(clean(spark, sf_dir), variant="weighted10")))


# ---- features (W1-W9, J4, M9) ------------------------------------------------------

_FEAT_OUT = ["lag_1", "lag_2", "lag_3", "lag_7", "lag_14", "roll_mean_7", "roll_std_7", "target_next_day"]


def features(spark, sf_dir, kind="dense", calendar=False):
    return FE.risk_features(risk(spark, sf_dir, kind), calendar=calendar)


def _feat_select_sql(src, extra=()):
    cols = ["date", "CountryCode", S.r("risk_raw")] + [S.r(c) for c in list(extra) + _FEAT_OUT]
    return f"SELECT {', '.join(cols)} FROM {src}"


def _feat_select(df, extra=()):
    return rounded(df.select("date", "CountryCode", "risk_raw", *extra, *_FEAT_OUT))


for _kind in ("dense", "sparse"):

    def _mkf(kind):
        sfx = "" if kind == "dense" else "_sparse"
        register(
            f"risk_features{sfx}",
            S.with_ctes(_chain(kind, "risk") + [("feat", S.features_body())], _feat_select_sql("feat")),
        )(lambda spark, sf_dir: _feat_select(features(spark, sf_dir, kind)))

    _mkf(_kind)

register(
    "fill_calendar",
    S.with_ctes(_chain("sparse", "risk") + [("filled", S.FILL_CALENDAR)],
                "SELECT date, CountryCode, ROUND(risk_raw, 10) AS risk_raw, total_events FROM filled"),
)(lambda spark, sf_dir: rounded(FE.fill_calendar(risk(spark, sf_dir, "sparse")).select(
    "date", "CountryCode", "risk_raw", "total_events")))

register(
    "risk_features_calendar",
    S.with_ctes(
        _chain("sparse", "risk") + [("filled", S.FILL_CALENDAR), ("feat", S.features_body("filled"))],
        _feat_select_sql("feat"),
    ),
)(lambda spark, sf_dir: _feat_select(features(spark, sf_dir, "sparse", calendar=True)))

_TRAIN_SQL = f"SELECT * FROM feat WHERE {S.not_null(S.FEATURE_COLS + ['target_next_day'])}"
register(
    "training_rows",
    S.with_ctes(_chain("dense", "risk") + [("feat", S.features_body()), ("train", _TRAIN_SQL)],
                _feat_select_sql("train", ["total_events"])),
)(lambda spark, sf_dir: _feat_select(FE.training_rows(features(spark, sf_dir)), ["total_events"]))

register(
    "latest_feature_rows",
    S.with_ctes(
        _chain("dense", "risk")
        + [
            ("feat", S.features_body()),
            ("latest", "SELECT * FROM feat QUALIFY ROW_NUMBER() OVER (PARTITION BY CountryCode ORDER BY date DESC) = 1"),
            ("complete", f"SELECT * FROM latest WHERE {S.not_null(S.FEATURE_COLS)}"),
        ],
        _feat_select_sql("complete", ["total_events"]),
    ),
)(lambda spark, sf_dir: _feat_select(FE.latest_feature_rows(features(spark, sf_dir)), ["total_events"]))

register(
    "holdout_split",
    S.with_ctes(
        _chain("dense", "risk") + [("feat", S.features_body()), ("train", _TRAIN_SQL)],
        "SELECT date, CountryCode, date > (SELECT MAX(date) - 14 FROM train) AS is_holdout FROM train",
    ),
)(lambda spark, sf_dir: FE.holdout_split(FE.training_rows(features(spark, sf_dir))).select(
    "date", "CountryCode", "is_holdout"))

register(
    "time_series_folds",
    S.with_ctes(
        _chain("sparse", "risk")
        + [
            ("feat", S.features_body()),
            ("train", _TRAIN_SQL),
            ("ranked", "SELECT date, CountryCode, ROW_NUMBER() OVER (PARTITION BY CountryCode ORDER BY date) - 1 AS rn, "
                       "COUNT(*) OVER (PARTITION BY CountryCode) AS n FROM train"),
        ],
        "SELECT date, CountryCode, CAST(rn AS BIGINT) AS rn, n, CAST(CASE WHEN n // 6 > 0 AND rn >= n - 5 * (n // 6) "
        "THEN (rn - (n - 5 * (n // 6))) // (n // 6) END AS INTEGER) AS test_fold FROM ranked",
    ),
)(lambda spark, sf_dir: FE.time_series_folds(FE.training_rows(features(spark, sf_dir, "sparse"))).select(
    "date", "CountryCode", F.col("rn").cast("bigint").alias("rn"), "n", "test_fold"))


# ---- panel / rolling z / scaling (A4, W5, M1) ------------------------------------------

def panel(spark, sf_dir, kind="dense"):
    return AN.country_day_panel(clean(spark, sf_dir, kind))


def zpanel(spark, sf_dir, kind="dense"):
    return AN.rolling_z(panel(spark, sf_dir, kind))


_PANEL_DBL = ["AvgTone", "AvgGoldstein", "log_events", "log_mentions"]
_PANEL_SQL_COLS = "date, CountryCode, EventCount, TotalMentions, TotalArticles, TotalSources, " + ", ".join(
    S.r(c) for c in _PANEL_DBL)

register(
    "country_day_panel",
    S.with_ctes(_chain("dense", "clean") + [("panel", S.PANEL)], f"SELECT {_PANEL_SQL_COLS} FROM panel"),
)(lambda spark, sf_dir: rounded(panel(spark, sf_dir)))

register(
    "rolling_z",
    S.with_ctes(_chain("sparse", "clean") + [("panel", S.PANEL), ("zpanel", S.ROLLING_Z)],
                "SELECT date, CountryCode, " + ", ".join(S.r(z) for z in AN.Z_COLS) + " FROM zpanel"),
)(lambda spark, sf_dir: rounded(zpanel(spark, sf_dir, "sparse").select("date", "CountryCode", *AN.Z_COLS)))

register(
    "feature_scaling",
    S.with_ctes(_chain("dense", "clean") + [("panel", S.PANEL), ("zpanel", S.ROLLING_Z), ("scaled", S.scaled_body())],
                "SELECT date, CountryCode, " + ", ".join(S.r(z + "_s") for z in AN.Z_COLS) + " FROM scaled"),
)(lambda spark, sf_dir: rounded(AN.feature_scaling(zpanel(spark, sf_dir)).select(
    "date", "CountryCode", *[z + "_s" for z in AN.Z_COLS])))


# ---- themes (S3, J1, J2, A5, A6) ---------------------------------------------------------

def _articles(spark, sf_dir):
    return adapters.articles(spark, sf_dir)


_THEME_CHAIN = S.articles_chain() + [("theme_items", S.THEME_ITEMS)]

register(
    "theme_exploded_counts",
    S.with_ctes(_THEME_CHAIN, "SELECT theme, COUNT(*) AS mentions FROM theme_items GROUP BY theme"),
)(lambda spark, sf_dir: TH.theme_counts(_articles(spark, sf_dir)))

register(
    "top_themes",
    S.with_ctes(_THEME_CHAIN, S.TOP_THEMES),
)(lambda spark, sf_dir: TH.top_themes_of_articles(_articles(spark, sf_dir), k=200))

register(
    "theme_daily",
    S.with_ctes(_THEME_CHAIN + [("top_themes", S.TOP_THEMES), ("td", S.THEME_DAILY)],
                "SELECT date, theme, ArticleCount, ROUND(AvgTone, 10) AS AvgTone FROM td"),
)(lambda spark, sf_dir: rounded(TH.theme_daily(_articles(spark, sf_dir))))


register(
    "theme_daily_strip_offsets",
    S.with_ctes(
        S.articles_chain() + [("theme_items", S.THEME_ITEMS_STRIPPED), ("top_themes", S.TOP_THEMES), ("td", S.THEME_DAILY)],
        "SELECT date, theme, ArticleCount, ROUND(AvgTone, 10) AS AvgTone FROM td",
    ),
)(lambda spark, sf_dir: rounded(TH.theme_daily(_articles(spark, sf_dir), strip_offsets=True)))


# ---- charts (A10-A15, R1, J3) -------------------------------------------------------------

_DENSE_CLEAN = _chain("dense", "clean")
_TOP12 = ("top12", "SELECT EventRootCode, EventRootLabel, CAST(SUM(EventCount) AS BIGINT) AS EventCount FROM clean "
                   "WHERE date IS NOT NULL AND EventRootCode IS NOT NULL AND EventRootLabel IS NOT NULL "
                   "GROUP BY EventRootCode, EventRootLabel ORDER BY EventCount DESC, EventRootCode LIMIT 12")
_IN_TOP = ("in_top", "SELECT * FROM clean WHERE date IS NOT NULL AND EventRootLabel IN (SELECT EventRootLabel FROM top12)")

register(
    "global_daily_volume",
    S.with_ctes(_DENSE_CLEAN, "SELECT date, CAST(SUM(EventCount) AS BIGINT) AS EventCount FROM clean "
                              "WHERE date IS NOT NULL GROUP BY date"),
)(lambda spark, sf_dir: CH.global_daily_volume(clean(spark, sf_dir)))

register(
    "top_countries",
    S.with_ctes(_chain("sparse", "clean"),
                "SELECT CountryCode, CAST(SUM(EventCount) AS BIGINT) AS EventCount FROM clean "
                "WHERE date IS NOT NULL AND CountryCode IS NOT NULL GROUP BY CountryCode "
                "ORDER BY EventCount DESC, CountryCode LIMIT 15"),
)(lambda spark, sf_dir: CH.top_countries(clean(spark, sf_dir, "sparse"), 15))

register(
    "tone_histogram",
    S.with_ctes(
        _DENSE_CLEAN
        + [
            ("t", "SELECT AvgTone, EventCount FROM clean WHERE date IS NOT NULL AND AvgTone IS NOT NULL "
                  "AND NOT isnan(AvgTone)"),
            ("b", "SELECT CASE WHEN MAX(AvgTone) = MIN(AvgTone) THEN MIN(AvgTone) - 0.5 ELSE MIN(AvgTone) END AS lo, "
                  "CASE WHEN MAX(AvgTone) = MIN(AvgTone) THEN MAX(AvgTone) + 0.5 ELSE MAX(AvgTone) END AS hi FROM t"),
            ("c", "SELECT CAST(LEAST(FLOOR((AvgTone - lo) / (hi - lo) * 60), 59) AS INTEGER) AS bin, "
                  "CAST(SUM(EventCount) AS BIGINT) AS weight FROM t, b GROUP BY 1"),
            ("s", "SELECT CAST(range AS INTEGER) AS bin FROM range(60)"),
        ],
        "SELECT s.bin, ROUND(lo + s.bin * ((hi - lo) / 60), 10) AS bin_lo, "
        "ROUND(lo + (s.bin + 1) * ((hi - lo) / 60), 10) AS bin_hi, CAST(COALESCE(weight, 0) AS BIGINT) AS weight "
        "FROM s CROSS JOIN b LEFT JOIN c ON c.bin = s.bin",
    ),
)(lambda spark, sf_dir: rounded(CH.tone_histogram(clean(spark, sf_dir), 60)))

register(
    "top_root_categories",
    S.with_ctes(_DENSE_CLEAN + [_TOP12], "SELECT * FROM top12"),
)(lambda spark, sf_dir: CH.top_root_categories(clean(spark, sf_dir), 12))

register(
    "monthly_root_heatmap",
    S.with_ctes(
        _chain("sparse", "clean") + [_TOP12, _IN_TOP],
        "SELECT EventRootLabel, CAST(date_trunc('month', date) AS DATE) AS month, "
        "CAST(SUM(EventCount) AS BIGINT) AS EventCount, ROUND(LOG10(SUM(EventCount) + 1.0), 10) AS log_events "
        "FROM in_top GROUP BY 1, 2",
    ),
)(lambda spark, sf_dir: rounded(CH.monthly_root_heatmap(clean(spark, sf_dir, "sparse"), 12)))

register(
    "tone_boxplot",
    S.with_ctes(
        _DENSE_CLEAN
        + [
            _TOP12,
            _IN_TOP,
            ("v", "SELECT EventRootLabel, AvgTone FROM in_top WHERE AvgTone IS NOT NULL AND NOT isnan(AvgTone)"),
            ("st", "SELECT EventRootLabel, COUNT(*) AS n, quantile_cont(AvgTone, 0.25) AS q1, "
                   "quantile_cont(AvgTone, 0.5) AS median, quantile_cont(AvgTone, 0.75) AS q3 "
                   "FROM v GROUP BY EventRootLabel"),
        ],
        "SELECT st.EventRootLabel, n, ROUND(q1, 10) AS q1, ROUND(median, 10) AS median, ROUND(q3, 10) AS q3, "
        "ROUND(MIN(CASE WHEN AvgTone BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) THEN AvgTone END), 10) "
        "AS whisker_lo, "
        "ROUND(MAX(CASE WHEN AvgTone BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) THEN AvgTone END), 10) "
        "AS whisker_hi, "
        "CAST(SUM(CASE WHEN AvgTone BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) THEN 0 ELSE 1 END) AS BIGINT) "
        "AS n_outliers FROM v JOIN st ON v.EventRootLabel = st.EventRootLabel "
        "GROUP BY st.EventRootLabel, n, q1, median, q3",
    ),
)(lambda spark, sf_dir: rounded(CH.tone_boxplot(clean(spark, sf_dir), 12)))


register(
    "tone_boxplot_outliers",
    S.with_ctes(
        _DENSE_CLEAN
        + [
            _TOP12,
            _IN_TOP,
            ("v", "SELECT * FROM in_top WHERE AvgTone IS NOT NULL AND NOT isnan(AvgTone)"),
            ("st", "SELECT EventRootLabel, quantile_cont(AvgTone, 0.25) AS q1, quantile_cont(AvgTone, 0.75) AS q3 "
                   "FROM v GROUP BY EventRootLabel"),
        ],
        "SELECT v.EventRootLabel, date, CountryCode, EventRootCode, ROUND(AvgTone, 10) AS AvgTone "
        "FROM v JOIN st ON v.EventRootLabel = st.EventRootLabel "
        "WHERE AvgTone < q1 - 1.5 * (q3 - q1) OR AvgTone > q3 + 1.5 * (q3 - q1)",
    ),
)(lambda spark, sf_dir: rounded(CH.tone_outliers(clean(spark, sf_dir), 12)))


# ---- quality (A7-A9, D1-D3) ---------------------------------------------------------------


_DBL_CLEAN = {"AvgTone", "AvgGoldstein"}
_NULLS_SQL = " UNION ALL ".join(
    f"SELECT {i} AS position, '{c}' AS \"column\", CAST(SUM(CASE WHEN {c} IS NULL"
    + (f" OR isnan({c})" if c in _DBL_CLEAN else "")
    + ' THEN 1 ELSE 0 END) AS BIGINT) AS missing FROM clean'
    for i, c in enumerate(CLEAN_COLUMNS)
)

register("dq_null_counts", S.with_ctes(_DENSE_CLEAN, _NULLS_SQL))(
    lambda spark, sf_dir: QA.dq_null_counts(clean(spark, sf_dir)))

register(
    "dq_coverage",
    S.with_ctes(_DENSE_CLEAN, 'SELECT COUNT(*) AS "rows", MIN(date) AS min_date, MAX(date) AS max_date FROM clean'),
)(lambda spark, sf_dir: QA.dq_coverage(clean(spark, sf_dir)))

register(
    "dq_top_roots",
    S.with_ctes(_DENSE_CLEAN,
                "SELECT EventRootCode, EventRootLabel, CAST(SUM(EventCount) AS BIGINT) AS EventCount FROM clean "
                "GROUP BY EventRootCode, EventRootLabel "
                "ORDER BY EventCount DESC NULLS LAST, EventRootCode ASC NULLS LAST, EventRootLabel LIMIT 10"),
)(lambda spark, sf_dir: QA.dq_top_roots(clean(spark, sf_dir), 10))

register(
    "run_log",
    S.with_ctes(_chain("dense", "extract"),
                "SELECT 'events_daily_extract' AS file, COUNT(*) AS \"rows\", MIN(SQLDATE) AS min_sqldate, "
                "MAX(SQLDATE) AS max_sqldate FROM extract"),
)(lambda spark, sf_dir: QA.run_log(extract(spark, sf_dir), "events_daily_extract"))


# ---- dashboards (D4-D6) --------------------------------------------------------------------

_SLICE = dict(start="2024-01-08", end="2024-01-21", countries=["N1", "N4", "N9", "N16"],
              categories=["Make Public Statement", "Protest", "Fight", "Coerce", "Unknown"])
register(
    "global_pulse_slice",
    S.with_ctes(
        _DENSE_CLEAN,
        f"SELECT {_CLEAN_COLS} FROM clean WHERE date IS NOT NULL AND date >= DATE '{_SLICE['start']}' "
        f"AND date <= DATE '{_SLICE['end']}' AND CountryCode IN ({S.q(_SLICE['countries'])}) "
        f"AND EventRootLabel IN ({S.q(_SLICE['categories'])})",
    ),
)(lambda spark, sf_dir: rounded(DB.global_pulse_slice(clean(spark, sf_dir), **_SLICE)))

_TOPICS = dict(themes=["the", "de", "of", "and", "la", "Il", "The"], start="2024-01-03", end="2024-01-25")

register(
    "topic_pulse",
    S.with_ctes(
        _THEME_CHAIN + [("top_themes", S.TOP_THEMES), ("td", S.THEME_DAILY)],
        f"SELECT date, theme, ArticleCount, ROUND(AvgTone, 10) AS AvgTone FROM td WHERE date >= DATE '{_TOPICS['start']}' "
        f"AND date <= DATE '{_TOPICS['end']}' AND theme IN ({S.q(_TOPICS['themes'])})",
    ),
)(lambda spark, sf_dir: rounded(DB.topic_pulse(spark.read.parquet(
    sinks.publish(TH.theme_daily(_articles(spark, sf_dir), ordered=False), _scratch(spark, "themes"))), **_TOPICS)))

_KPI = ["risk_raw", "total_events", "conflict_share", "negative_share", "weighted_avg_tone"]
register(
    "latest_kpis",
    S.with_ctes(
        _chain("sparse", "risk")
        + [("rng", "SELECT * FROM risk WHERE date >= DATE '1995-01-01' AND date <= DATE '1997-06-30'"),
           ("lat", "SELECT * FROM rng QUALIFY date = MAX(date) OVER (PARTITION BY CountryCode)")],
        "SELECT CountryCode, date AS latest_date, " + ", ".join(
            f"ROUND(MAX({m}), 10) AS {m}" if m != "total_events" else "MAX(total_events) AS total_events" for m in _KPI)
        + " FROM lat GROUP BY CountryCode, date",
    ),
)(lambda spark, sf_dir: rounded(DB.latest_kpis(risk(spark, sf_dir, "sparse"), "1995-01-01", "1997-06-30")))


# ---- sinks round trips (K1-K4, S4-S7) ---------------------------------------------------------

def _scratch(spark, name):
    import uuid

    return f"{checkpoint_dir(spark).rstrip('/')}/newsrisk-{name}-{uuid.uuid4().hex[:12]}"


def _csv_roundtrip(spark, sf_dir):
    ex = extract_events_daily(raw_events(spark, sf_dir), ordered=False)
    out = _scratch(spark, "extracts")
    sinks.write_extract_csv(ex, out, "2024-01-01", "2024-01-31")
    path = readers.latest_extract(spark, out)
    return rounded(clean_events(readers.read_extract_csv(spark, path)))


register("csv_roundtrip", S.with_ctes(_DENSE_CLEAN, f"SELECT {_CLEAN_COLS} FROM clean"))(_csv_roundtrip)


def _publish_clean(spark, sf_dir):
    target = _scratch(spark, "clean") + "/events_daily_clean.parquet"
    sinks.publish(clean(spark, sf_dir, "sparse"), target, drop_null="date")
    return rounded(readers.read_clean(spark, target.rsplit("/", 1)[0]))


register(
    "publish_clean",
    S.with_ctes(_chain("sparse", "clean"), f"SELECT {_CLEAN_COLS} FROM clean WHERE date IS NOT NULL"),
)(_publish_clean)


def _publish_risk(spark, sf_dir):
    target = _scratch(spark, "risk")
    sinks.publish(country_risk_daily(clean(spark, sf_dir), ordered=False), target)
    return rounded(readers.risk_series(spark.read.parquet(target)))


register(
    "risk_series",
    S.with_ctes(_chain("dense", "risk"),
                "SELECT date, CountryCode, ROUND(risk_raw, 10) AS risk_raw FROM risk "
                "WHERE date IS NOT NULL AND CountryCode IS NOT NULL"),
)(_publish_risk)


# ---- scoring / models (rows-only; no SQL oracle) ----------------------------------------------

MODEL_TREES = 300  # isolation forest trees (the published setting)
RUN_DATE = "2024-02-01"


def _scored(spark, sf_dir, kind="dense"):
    return AN.detect_anomalies(clean(spark, sf_dir, kind), trees=MODEL_TREES)


_ISOLATION = _DENSE_CLEAN + [("panel", S.PANEL), ("zpanel", S.ROLLING_Z), ("scaled", S.scaled_body())] + S.isolation_forest(trees=MODEL_TREES) + [
    ("lab", "SELECT *, CASE WHEN anomaly_score < 0 THEN -1 ELSE 1 END AS anomaly_label FROM iso_scored")]
_LAB = "date, CountryCode, EventCount, ROUND(AvgTone, 10) AS AvgTone, ROUND(AvgGoldstein, 10) AS AvgGoldstein, ROUND(anomaly_score, 8) AS anomaly_score, anomaly_label"
_OF_TOP = "WHERE CountryCode = (SELECT CountryCode FROM lab GROUP BY CountryCode ORDER BY SUM(EventCount) DESC, CountryCode LIMIT 1)"


def _rounded_scores(df):
    return df.select("date", "CountryCode", "EventCount", F.round("AvgTone", 10).alias("AvgTone"), F.round("AvgGoldstein", 10).alias("AvgGoldstein"),
                     F.round("anomaly_score", 8).alias("anomaly_score"), "anomaly_label")


register(
    "isolation_forest_scores",
    S.with_ctes(_ISOLATION, "SELECT date, CountryCode, EventCount, " + ", ".join(f"ROUND({z}, 8) AS {z}" for z in AN.Z_COLS)
                + ", ROUND(anomaly_score, 8) AS anomaly_score, anomaly_label FROM lab"),
)(lambda spark, sf_dir: rounded(_scored(spark, sf_dir).select(
    "date", "CountryCode", "EventCount", *AN.Z_COLS, "anomaly_score", "anomaly_label"), 8))
register("top_anomalies", S.with_ctes(_ISOLATION, f"SELECT {_LAB} FROM lab ORDER BY lab.anomaly_score, CountryCode, date LIMIT 50"))(
    lambda spark, sf_dir: _rounded_scores(AN.top_anomalies(_scored(spark, sf_dir), 50)))
register("top_country_anomalies", S.with_ctes(_ISOLATION, f"SELECT date, CountryCode, EventCount, ROUND(anomaly_score, 8) AS anomaly_score, anomaly_label FROM lab {_OF_TOP}"))(
    lambda spark, sf_dir: rounded(AN.top_country_anomalies(_scored(spark, sf_dir)), 8))

register(
    "top_country",
    S.with_ctes(_DENSE_CLEAN + [("panel", S.PANEL)],
                "SELECT CountryCode, CAST(SUM(EventCount) AS BIGINT) AS total_EventCount FROM panel "
                "GROUP BY CountryCode ORDER BY total_EventCount DESC, CountryCode LIMIT 1"),
)(lambda spark, sf_dir: AN.top_country(panel(spark, sf_dir)))


def _forecast(spark, sf_dir):
    """The next-day snapshot as the dashboards read it: fitted, stored and published from the tables at every call."""
    base = _scratch(spark, "forecast")
    snapshot = FC.forecast_next_day(features(spark, sf_dir), RUN_DATE, model_path=f"{base}/model")
    return spark.read.parquet(sinks.publish(snapshot, f"{base}/snapshot"))


def _cv(spark, sf_dir):
    return FC.cv_predictions(risk(spark, sf_dir, "sparse"))


register("forecast_backtest")(lambda spark, sf_dir: FC.forecast_backtest(features(spark, sf_dir)))
register("risk_forecast_next_day")(lambda spark, sf_dir: _forecast(spark, sf_dir))
register("forecast_cv")(lambda spark, sf_dir: FC.cv_errors(materialize(_cv(spark, sf_dir))))
register("forecast_last_fold")(lambda spark, sf_dir: FC.last_fold_series(materialize(_cv(spark, sf_dir))))
register("permutation_importance")(lambda spark, sf_dir: FC.forecast_cv_importance(risk(spark, sf_dir, "sparse")))
register("risk_trend_with_forecast")(
    lambda spark, sf_dir: DB.risk_trend_with_forecast(risk(spark, sf_dir), _forecast(spark, sf_dir)))
register("forecast_outlook")(lambda spark, sf_dir: DB.forecast_outlook(_forecast(spark, sf_dir), 10))

# ---- the same forests, shallow enough for SQL: every draw, split and sum is checked -------------

SHALLOW = dict(trees=4, max_depth=3)
_SHALLOW = (SHALLOW["trees"], SHALLOW["max_depth"])
_TRAIN = _chain("dense", "risk") + [("feat", S.features_body()), ("train", _TRAIN_SQL)]
_HOLDOUT = _TRAIN + [
    ("split", "SELECT *, date > (SELECT MAX(date) - 14 FROM train) AS is_holdout FROM train"),
    ("past", "SELECT * FROM split WHERE NOT is_holdout"),
    ("held", "SELECT * FROM split WHERE is_holdout"),
]

register(
    "forest_splits",
    S.with_ctes(_TRAIN + S.cart("train", S.FEATURE_COLS, *_SHALLOW),
                "SELECT CAST(tree AS INTEGER) AS tree, CAST(feature AS INTEGER) AS feature, ROUND(threshold, 10) AS threshold, ROUND(value, 10) AS value, weight FROM cart_nodes"),
)(lambda spark, sf_dir: FC.fit_forest(FE.training_rows(features(spark, sf_dir)), **SHALLOW).nodes().select(
    "tree", "feature", F.round("threshold", 10).alias("threshold"), F.round("value", 10).alias("value"), "weight"))
register(
    "forest_backtest",
    S.with_ctes(_HOLDOUT + S.cart("past", S.FEATURE_COLS, *_SHALLOW) + S.cart_predictions("held", S.FEATURE_COLS, *_SHALLOW),
                "SELECT COUNT(*) AS n_holdout, ROUND(AVG(ABS(target_next_day - prediction)), 10) AS mae, MIN(date) AS holdout_start, MAX(date) AS holdout_end FROM predicted"),
)(lambda spark, sf_dir: rounded(FC.forecast_backtest(features(spark, sf_dir), **SHALLOW)))
register(
    "forest_forecast",
    S.with_ctes(_TRAIN + [("latest", "SELECT * FROM feat QUALIFY ROW_NUMBER() OVER (PARTITION BY CountryCode ORDER BY date DESC) = 1"),
                          ("complete", f"SELECT * FROM latest WHERE {S.not_null(S.FEATURE_COLS)}")]
                + S.cart("train", S.FEATURE_COLS, *_SHALLOW) + S.cart_predictions("complete", S.FEATURE_COLS, *_SHALLOW),
                f"SELECT DATE '{RUN_DATE}' AS run_date, date AS as_of_date, CAST(date + 1 AS DATE) AS forecast_date, CountryCode, ROUND(prediction, 10) AS pred_risk_next_day, "
                "ROUND(risk_raw, 10) AS risk_as_of, total_events, " + ", ".join(S.r(c) for c in ["conflict_share", "negative_share", "weighted_avg_tone"]) + " FROM predicted"),
)(lambda spark, sf_dir: rounded(FC.forecast_next_day(features(spark, sf_dir), RUN_DATE, model_path=_scratch(spark, "model"), **SHALLOW)))
register(
    "forest_cv",
    S.with_ctes(S.cv_chain() + [("folds", "SELECT series.*, f.range AS fold FROM series, range(5) f WHERE COALESCE(test_fold, -1) < f.range"),
                                ("tests", "SELECT * FROM series WHERE test_fold IS NOT NULL")]
                + S.cart("folds", S.SERIES_FEATURE_COLS, *_SHALLOW, model="fold") + S.cart_predictions("tests", S.SERIES_FEATURE_COLS, *_SHALLOW, model="test_fold")
                + [("errors", "SELECT test_fold AS fold, COUNT(*) AS n_test, AVG(ABS(target_next_day - prediction)) AS mae, MIN(CountryCode) AS countries FROM predicted GROUP BY test_fold")],
                "SELECT fold, n_test, ROUND(mae, 10) AS mae, countries, ROUND((SELECT AVG(mae) FROM errors), 10) AS mean_mae FROM errors"),
)(lambda spark, sf_dir: rounded(FC.forecast_cv(risk(spark, sf_dir, "sparse"), **SHALLOW)))

# permutation importance of a predictor that SQL can repeat
LINEAR = "0.5 * lag_1 + 0.3 * roll_mean_7 + 0.2 * lag_7"


def _linear_importance(spark, sf_dir):
    rows = FC.cv_rows(risk(spark, sf_dir, "sparse"))
    return rounded(FC.permutation_importance(lambda df: df.withColumn("prediction", F.expr(LINEAR)), rows.where("test_fold = 4")))


register(
    "importance_linear",
    S.with_ctes(S.cv_chain() + [("last", "SELECT * FROM series WHERE test_fold = 4")] + S.importance("last", S.SERIES_FEATURE_COLS, LINEAR, 10),
                "SELECT feature, ROUND(importance, 10) AS importance, ROUND(importance_std, 10) AS importance_std FROM importance"),
)(_linear_importance)

# the same operators behind a forecast and a score that SQL can repeat
_BASELINE = _chain("dense", "risk") + [
    ("feat", S.features_body()),
    ("latest", "SELECT * FROM feat QUALIFY ROW_NUMBER() OVER (PARTITION BY CountryCode ORDER BY date DESC) = 1"),
    ("fc", f"SELECT DATE '{RUN_DATE}' AS run_date, date AS as_of_date, CAST(date + 1 AS DATE) AS forecast_date, CountryCode, "
           "roll_mean_7 AS pred_risk_next_day, risk_raw AS risk_as_of, total_events, conflict_share, negative_share, "
           f"weighted_avg_tone FROM latest WHERE {S.not_null(S.FEATURE_COLS)}"),
]


def _baseline(spark, sf_dir):
    target = _scratch(spark, "baseline")
    sinks.publish(FC.baseline_next_day(features(spark, sf_dir), RUN_DATE), target)
    return spark.read.parquet(target)


register(
    "baseline_forecast",
    S.with_ctes(_BASELINE, "SELECT run_date, as_of_date, forecast_date, CountryCode, total_events, " + ", ".join(
        S.r(c) for c in ["pred_risk_next_day", "risk_as_of", "conflict_share", "negative_share", "weighted_avg_tone"]) + " FROM fc"),
)(lambda spark, sf_dir: rounded(_baseline(spark, sf_dir)))
register(
    "baseline_trend",
    S.with_ctes(_BASELINE, "SELECT risk.date, risk.CountryCode, ROUND(risk_raw, 10) AS risk_raw, forecast_date, "
                           "ROUND(pred_risk_next_day, 10) AS pred_risk_next_day, "
                           "ROUND(pred_risk_next_day - risk_raw, 10) AS pred_delta FROM risk LEFT JOIN fc "
                           "ON fc.CountryCode = risk.CountryCode AND fc.as_of_date = risk.date"),
)(lambda spark, sf_dir: rounded(DB.risk_trend_with_forecast(risk(spark, sf_dir), _baseline(spark, sf_dir))))
register(
    "baseline_outlook",
    S.with_ctes(_BASELINE, "SELECT forecast_date, CountryCode, ROUND(pred_risk_next_day, 10) AS pred_risk_next_day, "
                           "ROUND(risk_as_of, 10) AS risk_as_of, ROUND(pred_risk_next_day - risk_as_of, 10) AS pred_delta FROM fc "
                           "WHERE forecast_date = (SELECT MAX(forecast_date) FROM fc) "
                           "ORDER BY fc.pred_risk_next_day DESC, CountryCode LIMIT 10"),
)(lambda spark, sf_dir: rounded(DB.forecast_outlook(_baseline(spark, sf_dir), 10)))

_ZSCORE = _chain("sparse", "clean") + [
    ("panel", S.PANEL),
    ("zpanel", S.ROLLING_Z),
    ("raw_score", "SELECT *, -(" + " + ".join(f"ABS({z})" for z in AN.Z_COLS) + ") AS s FROM zpanel"),
    ("scored", "SELECT date, CountryCode, EventCount, AvgTone, AvgGoldstein, "
               "s - (SELECT quantile_cont(s, 0.01) FROM raw_score) AS anomaly_score FROM raw_score"),
    ("lab", "SELECT *, CASE WHEN anomaly_score < 0 THEN -1 ELSE 1 END AS anomaly_label FROM scored"),
]


def _zscored(spark, sf_dir):
    return AN.z_score_anomalies(zpanel(spark, sf_dir, "sparse"))


register("zscore_anomalies", S.with_ctes(_ZSCORE, f"SELECT {_LAB} FROM lab"))(
    lambda spark, sf_dir: _rounded_scores(_zscored(spark, sf_dir)))


_TOP_SCHEMA = "date date, CountryCode string, EventCount long, AvgTone double, AvgGoldstein double, anomaly_score double, anomaly_label int"


def _top50_csv(spark, sf_dir):
    """The top-50 report through its CSV file."""
    path = sinks.write_top_csv(AN.top_anomalies(_zscored(spark, sf_dir), 50), _scratch(spark, "top50"))
    return _rounded_scores(spark.read.option("header", True).schema(_TOP_SCHEMA).csv(path))


register("zscore_top50_csv", S.with_ctes(_ZSCORE, f"SELECT {_LAB} FROM lab ORDER BY lab.anomaly_score, CountryCode, date LIMIT 50"))(_top50_csv)
register(
    "zscore_top_country",
    S.with_ctes(_ZSCORE, f"SELECT date, CountryCode, EventCount, ROUND(anomaly_score, 8) AS anomaly_score, anomaly_label FROM lab {_OF_TOP}"),
)(lambda spark, sf_dir: AN.top_country_anomalies(_zscored(spark, sf_dir)).withColumn("anomaly_score", F.round("anomaly_score", 8)))

# ---- dirty input ------------------------------------------------------------------------------

_DIRTY = [("sound_extract" if n == "extract" else n, q) for n, q in _DENSE_CLEAN if n != "clean_norm" and n != "clean"] + [
    ("extract", adapters.DIRTY_EXTRACT_SQL)] + [(n, q) for n, q in _DENSE_CLEAN if n in ("clean_norm", "clean")]


def dirty_clean(spark, sf_dir):
    return clean_events(adapters.dirty_extract(extract(spark, sf_dir)))


def _publish_dirty(spark, sf_dir):
    target = _scratch(spark, "dirty") + "/events_daily_clean.parquet"
    sinks.publish(dirty_clean(spark, sf_dir), target, drop_null="date")
    return rounded(readers.read_clean(spark, target.rsplit("/", 1)[0]))


register("dirty_clean", S.with_ctes(_DIRTY, f"SELECT {_CLEAN_COLS} FROM clean"))(lambda spark, sf_dir: rounded(dirty_clean(spark, sf_dir)))
register("dirty_null_counts", S.with_ctes(_DIRTY, _NULLS_SQL))(lambda spark, sf_dir: QA.dq_null_counts(dirty_clean(spark, sf_dir)))
register(
    "dirty_top_roots",
    S.with_ctes(_DIRTY, "SELECT EventRootCode, EventRootLabel, CAST(SUM(EventCount) AS BIGINT) AS EventCount FROM clean "
                        "GROUP BY EventRootCode, EventRootLabel "
                        "ORDER BY EventCount DESC NULLS LAST, EventRootCode ASC NULLS LAST, EventRootLabel LIMIT 30"),
)(lambda spark, sf_dir: QA.dq_top_roots(dirty_clean(spark, sf_dir), 30))
register("dirty_publish", S.with_ctes(_DIRTY, f"SELECT {_CLEAN_COLS} FROM clean WHERE date IS NOT NULL"))(_publish_dirty)
register("dirty_risk", S.with_ctes(_DIRTY + [("risk", S.RISK)], f"SELECT {_RISK_COLS} FROM risk"))(
    lambda spark, sf_dir: rounded(country_risk_daily(dirty_clean(spark, sf_dir))))
register(
    "dirty_run_log",
    S.with_ctes(_DIRTY, "SELECT 'dirty_extract' AS file, COUNT(*) AS \"rows\", MIN(SQLDATE) AS min_sqldate, MAX(SQLDATE) AS max_sqldate FROM extract"),
)(lambda spark, sf_dir: QA.run_log(adapters.dirty_extract(extract(spark, sf_dir)), "dirty_extract"))
register(
    "theme_daily_plain_fields",
    S.with_ctes(_THEME_CHAIN + [("top_themes", S.TOP_THEMES), ("td", S.THEME_DAILY)],
                "SELECT date, theme, ArticleCount, ROUND(AvgTone, 10) AS AvgTone FROM td"),
)(lambda spark, sf_dir: rounded(TH.theme_daily(adapters.plain_articles(spark, sf_dir))))
register(
    "monthly_root_heatmap_wide",
    S.with_ctes(
        _DENSE_CLEAN + [_TOP12, _IN_TOP],
        'SELECT EventRootLabel, ROUND(COALESCE(LOG10(SUM(EventCount) FILTER (WHERE date_trunc(\'month\', date) = DATE \'2024-01-01\') + 1.0), 0), 10) '
        'AS "2024-01-01" FROM in_top GROUP BY 1',
    ),
)(lambda spark, sf_dir: rounded(CH.monthly_root_heatmap_wide(clean(spark, sf_dir), 12)))

register(
    "freshness_checks",
    S.with_ctes(
        _chain("dense", "risk")
        + [
            ("feat", S.features_body()),
            ("latest", "SELECT * FROM feat QUALIFY ROW_NUMBER() OVER (PARTITION BY CountryCode ORDER BY date DESC) = 1"),
            ("fc", f"SELECT date + 1 AS forecast_date FROM latest WHERE {S.not_null(S.FEATURE_COLS)}"),
        ],
        "SELECT (SELECT CAST(STRPTIME(CAST(MAX(SQLDATE) AS VARCHAR), '%Y%m%d') AS DATE) FROM extract) AS extract_max_date, "
        "(SELECT MAX(date) FROM clean) AS clean_max_date, (SELECT MAX(date) FROM risk) AS risk_max_date, "
        "(SELECT MAX(forecast_date) FROM fc) AS forecast_max_date, (SELECT COUNT(*) FROM fc) AS forecast_rows, "
        "(SELECT MAX(date) FROM clean) = (SELECT CAST(STRPTIME(CAST(MAX(SQLDATE) AS VARCHAR), '%Y%m%d') AS DATE) FROM extract) "
        "AS clean_matches_extract, "
        "(SELECT MAX(date) FROM clean) = (SELECT MAX(date) FROM risk) AS risk_matches_clean, "
        "(SELECT MAX(forecast_date) FROM fc) = (SELECT MAX(date) FROM risk) + 1 AS forecast_is_next_day",
    ),
)(lambda spark, sf_dir: QA.freshness_checks(
    clean(spark, sf_dir), risk(spark, sf_dir), _forecast(spark, sf_dir), extract(spark, sf_dir)))


# ---- column-level steps of the clean layer (P3-P8, J7) ------------------------------------------


register(
    "normalize_codes",
    S.with_ctes(
        _chain("dense", "raw_events"),
        "SELECT raw_code, CASE WHEN length(t) >= 2 THEN t WHEN t IN ('+', '-') THEN t || '0' ELSE lpad(t, 2, '0') END "
        "AS zfill_code, lpad(raw_code, 2, '0') AS lpad_code, COUNT(*) AS n FROM ("
        "SELECT EventRootCode AS raw_code, regexp_replace(EventRootCode, '^\\s+|\\s+$', '', 'g') AS t FROM raw_events) "
        "GROUP BY raw_code, t",
    ),
)(lambda spark, sf_dir: raw_events(spark, sf_dir).groupBy(
    F.col("EventRootCode").alias("raw_code"),
    normalize_root_code("EventRootCode").alias("zfill_code"),
    lpad_root_code("EventRootCode").alias("lpad_code"),
).agg(F.count(F.lit(1)).alias("n")))

register(
    "label_roots",
    S.with_ctes(_DENSE_CLEAN, "SELECT EventRootCode, EventRootLabel, COUNT(*) AS n_rows, "
                              "CAST(SUM(EventCount) AS BIGINT) AS EventCount FROM clean GROUP BY 1, 2"),
)(lambda spark, sf_dir: clean(spark, sf_dir).groupBy("EventRootCode", "EventRootLabel").agg(
    F.count(F.lit(1)).alias("n_rows"), F.sum("EventCount").cast("bigint").alias("EventCount")))

register(
    "tone_bucket",
    S.with_ctes(_chain("sparse", "clean"), "SELECT ToneBucket, COUNT(*) AS n_rows, "
                                           "CAST(SUM(EventCount) AS BIGINT) AS EventCount FROM clean GROUP BY 1"),
)(lambda spark, sf_dir: clean(spark, sf_dir, "sparse").groupBy("ToneBucket").agg(
    F.count(F.lit(1)).alias("n_rows"), F.sum("EventCount").cast("bigint").alias("EventCount")))

register(
    "parse_dates",
    S.with_ctes(_chain("sparse", "extract"),
                "SELECT DISTINCT CAST(SQLDATE AS VARCHAR) AS SQLDATE, "
                "CAST(TRY_STRPTIME(CAST(SQLDATE AS VARCHAR), '%Y%m%d') AS DATE) AS date FROM extract"),
)(lambda spark, sf_dir: extract(spark, sf_dir, "sparse").select(
    F.col("SQLDATE").cast("string").alias("SQLDATE"), parse_yyyymmdd("SQLDATE").alias("date")).distinct())


def _coerce_numeric(spark, sf_dir):
    """Clean an all-text copy of the extract: every numeric is parsed back from text."""
    ex = extract(spark, sf_dir)
    text = ex.select(*[F.col(c).cast("string").alias(c) for c in ex.columns])
    return rounded(clean_events(text))


register("coerce_numeric", S.with_ctes(_DENSE_CLEAN, f"SELECT {_CLEAN_COLS} FROM clean"))(_coerce_numeric)


def _naive_mae(spark, sf_dir):
    rows = FE.holdout_split(FE.training_rows(features(spark, sf_dir, "sparse")))
    return rounded(rows.groupBy("is_holdout").agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(F.abs(F.col("target_next_day") - F.col("risk_raw"))).alias("mae"),
    ))


register(
    "naive_backtest_mae",
    S.with_ctes(
        _chain("sparse", "risk") + [("feat", S.features_body()), ("train", _TRAIN_SQL)],
        "SELECT is_holdout, COUNT(*) AS n, ROUND(AVG(ABS(target_next_day - risk_raw)), 10) AS mae FROM ("
        "SELECT *, date > (SELECT MAX(date) - 14 FROM train) AS is_holdout FROM train) GROUP BY is_holdout",
    ),
)(_naive_mae)


# ---- streaming refresh (E4 as an incremental stream) ----------------------------------------------



def _incremental_extract(spark, sf_dir):
    """Land the raw events as dt partitions in two deliveries; stream each in."""
    base = _scratch(spark, "stream")
    raw = raw_events(spark, sf_dir)
    cut = raw.select(F.percentile_approx("dt", 0.5)).first()[0]  # split point: ~half the data
    sinks.write_parquet(raw.where(F.col("dt") < F.lit(cut)), f"{base}/raw", ["dt"])
    run_incremental_extract(spark, f"{base}/raw", f"{base}/out", f"{base}/ckpt", max_files_per_trigger=8)
    raw.where((F.col("dt") >= F.lit(cut)) | F.col("dt").isNull()).write.mode("append").partitionBy("dt").parquet(f"{base}/raw")
    out = run_incremental_extract(spark, f"{base}/raw", f"{base}/out", f"{base}/ckpt", max_files_per_trigger=8)
    return rounded(out)


register("incremental_extract", S.with_ctes(_chain("dense", "extract"), f"SELECT {_EXTRACT_COLS} FROM extract"))(
    _incremental_extract)


def _parquet_roundtrip(spark, sf_dir):
    target = _scratch(spark, "processed")
    sinks.write_parquet(clean(spark, sf_dir), target + "/events_daily_clean.parquet")
    return rounded(readers.read_clean(spark, target))


register("parquet_roundtrip", S.with_ctes(_DENSE_CLEAN, f"SELECT {_CLEAN_COLS} FROM clean"))(_parquet_roundtrip)


def _publish_risk_table(spark, sf_dir):
    target = _scratch(spark, "published") + "/country_risk_daily"
    sinks.publish(country_risk_daily(clean(spark, sf_dir, "sparse"), ordered=False), target)
    return rounded(spark.read.parquet(target))


register("publish_risk", S.with_ctes(_chain("sparse", "risk"), f"SELECT {_RISK_COLS} FROM risk"))(_publish_risk_table)


# ---- faulty, several and zipped extracts (S4-S6) ---------------------------------------------------


def _faulty_extract(spark, sf_dir):
    """The extract's CSV folder with two more files: lines of root 14 without their last field, of root 19 with one more."""
    ex = extract(spark, sf_dir)
    path = sinks.write_extract_csv(ex, _scratch(spark, "faulty"), "2024-01-01", "2024-01-31")
    append = lambda df: df.write.mode("append").option("header", True).csv(path)
    append(ex.where("EventRootCode = '14'").drop("TotalSources"))
    append(ex.where("EventRootCode = '19'").withColumn("more", F.lit("x")))
    return path


_SHORT = "SELECT * REPLACE (CAST(NULL AS BIGINT) AS TotalSources) FROM clean WHERE EventRootCode = '14'"  # null for the field they lack
register("faulty_extract_clean", S.with_ctes(_DENSE_CLEAN, f"SELECT {_CLEAN_COLS} FROM (SELECT * FROM clean UNION ALL {_SHORT})"))(
    lambda spark, sf_dir: rounded(clean_events(readers.read_extract_csv(spark, _faulty_extract(spark, sf_dir)))))
register(
    "faulty_extract_lines",
    S.with_ctes(_chain("dense", "extract"),
                "SELECT 'events_daily_20240101_20240131.csv' AS file, CASE EventRootCode WHEN '14' THEN 8 ELSE 10 END AS fields, EventRootCode = '14' AS kept, COUNT(*) AS n "
                "FROM extract WHERE EventRootCode IN ('14', '19') GROUP BY EventRootCode"),
)(lambda spark, sf_dir: readers.faulty_lines(spark, _faulty_extract(spark, sf_dir)).groupBy("file", F.size(F.split("line", ",")).alias("fields"), "kept").agg(F.count("*").alias("n")))
register(
    "faulty_extract_run_log",
    S.with_ctes(_chain("dense", "extract"),
                "SELECT 'events_daily_20240101_20240131.csv' AS file, CAST(COUNT(*) + SUM(CASE EventRootCode WHEN '14' THEN 1 ELSE 0 END) AS BIGINT) AS \"rows\", CAST(MIN(SQLDATE) AS VARCHAR) AS min_sqldate, CAST(MAX(SQLDATE) AS VARCHAR) AS max_sqldate, "
                "CAST(SUM(CASE WHEN EventRootCode IN ('14', '19') THEN 1 ELSE 0 END) AS BIGINT) AS faulty_lines FROM extract"),
)(lambda spark, sf_dir: _ingested(spark, _faulty_extract(spark, sf_dir), "run_log").drop("run_timestamp"))


def _ingested(spark, path, what):
    """A table that the ingest of an extract publishes."""
    out = jobs.ingest_extract(spark, jobs.Layout(_scratch(spark, "ingest")), path)
    return spark.read.parquet(out[what])


def _latest_of_extracts(spark, sf_dir):
    """Three extracts in a folder; the one whose name ends latest is cleaned."""
    folder = _scratch(spark, "several")
    for start, end in (("2024-01-01", "2024-01-11"), ("2024-01-15", "2024-01-25"), ("2024-01-08", "2024-01-31")):
        sinks.write_extract_csv(extract_events_daily(raw_events(spark, sf_dir), start, end, ordered=False), folder, start, end)
    return rounded(clean_events(readers.read_extract_csv(spark, readers.latest_extract(spark, folder))))


_LATEST_WINDOW = "AND dt >= DATE '2024-01-15' AND dt < DATE '2024-01-25'"
register("latest_of_extracts", S.with_ctes(_chain("dense", "clean", _LATEST_WINDOW), f"SELECT {_CLEAN_COLS} FROM clean"))(_latest_of_extracts)


def _clean_csv_gz(spark, sf_dir):
    folder = _scratch(spark, "gz")
    sinks.write_clean_csv_gz(clean(spark, sf_dir), folder)
    return rounded(readers.read_clean(spark, folder))


register("clean_csv_gz", S.with_ctes(_DENSE_CLEAN, f"SELECT {_CLEAN_COLS} FROM clean"))(_clean_csv_gz)

# ---- publishes without a gap, footers, changed days, order ------------------------------------------


def _publish_catalog(spark, sf_dir):
    """Both risk formulas published to one catalog table, the second in place of the first."""
    name = _scratch(spark, "risk").rsplit("/", 1)[-1].replace("-", "_")
    for variant in ("weighted10", "share_log"):
        sinks.publish(country_risk_daily(clean(spark, sf_dir), variant, ordered=False), name)
    return rounded(spark.table(name))


register("publish_catalog", S.with_ctes(_chain("dense", "risk"), f"SELECT {_RISK_COLS} FROM risk"))(_publish_catalog)


def _coverage_footers(spark, sf_dir):
    target = _scratch(spark, "coverage")
    sinks.publish(clean(spark, sf_dir, "sparse"), target, drop_null="date")
    return QA.footer_coverage(spark, target)


register(
    "coverage_footers",
    S.with_ctes(_chain("sparse", "clean"), 'SELECT COUNT(*) AS "rows", MIN(date) AS min_date, MAX(date) AS max_date FROM clean WHERE date IS NOT NULL'),
)(_coverage_footers)


def _refresh_changed_days(spark, sf_dir):
    """Raw events in two deliveries, the second with late rows of two days; the features after both refreshes."""
    base, raw = _scratch(spark, "days"), raw_events(spark, sf_dir)
    late = F.coalesce((F.col("GLOBALEVENTID") % 5 == 0) & F.col("dt").isin(dt.date(2024, 1, 9), dt.date(2024, 1, 17)), F.lit(False))
    for delivery in (raw.where(~late), raw.where(late)):
        delivery.write.mode("append").partitionBy("dt").parquet(f"{base}/raw")
        refresh_days(spark, readers.read_raw(spark, f"{base}/raw"), delivery, f"{base}/tables")
    return _feat_select(spark.read.parquet(f"{base}/tables/features"))


register("refresh_changed_days", S.with_ctes(_chain("dense", "risk") + [("feat", S.features_body())], _feat_select_sql("feat")))(_refresh_changed_days)

register(
    "extract_order",
    S.with_ctes(_chain("sparse", "extract"),
                "SELECT SQLDATE, CountryCode, EventRootCode, EventCount, ROW_NUMBER() OVER (ORDER BY SQLDATE, CountryCode, EventRootCode) AS position FROM extract"),
)(lambda spark, sf_dir: output_positions(extract_events_daily(raw_events(spark, sf_dir, "sparse"))).select(
    "SQLDATE", "CountryCode", "EventRootCode", "EventCount", "position"))
register(
    "risk_series_order",
    S.with_ctes(_chain("sparse", "risk"), "SELECT date, CountryCode, ROUND(risk_raw, 10) AS risk_raw, ROW_NUMBER() OVER (ORDER BY CountryCode, date) AS position FROM risk"),
)(lambda spark, sf_dir: rounded(output_positions(readers.risk_series(risk(spark, sf_dir, "sparse")))))
register(
    "theme_daily_order",
    S.with_ctes(_THEME_CHAIN + [("top_themes", S.TOP_THEMES), ("td", S.THEME_DAILY)],
                "SELECT date, theme, ArticleCount, ROW_NUMBER() OVER (ORDER BY date, theme) AS position FROM td"),
)(lambda spark, sf_dir: output_positions(TH.theme_daily(_articles(spark, sf_dir))).drop("AvgTone"))

# ---- the end-to-end jobs (E1-E5), each through its published tables --------------------------------

JOB_WINDOW = ("2024-01-03", "2024-01-29")
_JOB_SQL = f"AND dt >= DATE '{JOB_WINDOW[0]}' AND dt < DATE '{JOB_WINDOW[1]}'"
_JOB_FILE = "events_daily_20240103_20240129.csv"


def _job_events(spark, sf_dir):
    layout = jobs.Layout(_scratch(spark, "job"))
    return layout, jobs.run_events(spark, raw_events(spark, sf_dir), layout, *JOB_WINDOW)


def _job_table(what):
    return lambda spark, sf_dir: rounded(spark.read.parquet(_job_events(spark, sf_dir)[1][what]))


_JOB_CLEAN = _chain("dense", "clean", _JOB_SQL)
_JOB_RISK = _chain("dense", "risk", _JOB_SQL)
_JOB_LATEST = _JOB_RISK + [("feat", S.features_body()), ("latest", "SELECT * FROM feat QUALIFY ROW_NUMBER() OVER (PARTITION BY CountryCode ORDER BY date DESC) = 1"),
                           ("fc", f"SELECT * FROM latest WHERE {S.not_null(S.FEATURE_COLS)}")]

register("job_events", S.with_ctes(_JOB_CLEAN, f"SELECT {_CLEAN_COLS} FROM clean WHERE date IS NOT NULL"))(_job_table("published"))
register(
    "job_run_log",
    S.with_ctes(_JOB_CLEAN, f"SELECT '{_JOB_FILE}' AS file, COUNT(*) AS \"rows\", CAST(MIN(SQLDATE) AS VARCHAR) AS min_sqldate, CAST(MAX(SQLDATE) AS VARCHAR) AS max_sqldate, "
                            "CAST(0 AS BIGINT) AS faulty_lines FROM extract"),
)(lambda spark, sf_dir: _job_table("run_log")(spark, sf_dir).drop("run_timestamp"))


def _job_quality(table):
    return lambda spark, sf_dir: spark.read.parquet(f"{_job_events(spark, sf_dir)[0].quality}/{table}")


register("job_quality_missing", S.with_ctes(_JOB_CLEAN, _NULLS_SQL))(_job_quality("missing"))
register(
    "job_quality_roots",
    S.with_ctes(_JOB_CLEAN, "SELECT EventRootCode, EventRootLabel, CAST(SUM(EventCount) AS BIGINT) AS EventCount FROM clean GROUP BY EventRootCode, EventRootLabel "
                            "ORDER BY EventCount DESC NULLS LAST, EventRootCode ASC NULLS LAST, EventRootLabel LIMIT 10"),
)(_job_quality("top_roots"))


def _job_themes(spark, sf_dir):
    layout = jobs.Layout(_scratch(spark, "job"))
    return rounded(spark.read.parquet(jobs.run_themes(spark, _articles(spark, sf_dir), layout, *JOB_WINDOW)))


register(
    "job_themes",
    S.with_ctes([("all_articles", S.articles_chain()[0][1]),
                 ("raw_articles", f"SELECT * FROM all_articles WHERE dt >= DATE '{JOB_WINDOW[0]}' AND dt < DATE '{JOB_WINDOW[1]}'"),
                 ("theme_items", S.THEME_ITEMS), ("top_themes", S.TOP_THEMES), ("td", S.THEME_DAILY)],
                "SELECT date, theme, ArticleCount, ROUND(AvgTone, 10) AS AvgTone FROM td"),
)(_job_themes)


def _job_risk(spark, sf_dir, what):
    layout, _ = _job_events(spark, sf_dir)
    return rounded(spark.read.parquet(jobs.run_risk_forecast(spark, layout, run_date=RUN_DATE)[what]))


register("job_risk", S.with_ctes(_JOB_RISK, f"SELECT {_RISK_COLS} FROM risk"))(lambda spark, sf_dir: _job_risk(spark, sf_dir, "risk"))
# all of the snapshot but the prediction of the 500 trees (forest_forecast checks one of fewer)
register(
    "job_forecast",
    S.with_ctes(_JOB_LATEST, f"SELECT DATE '{RUN_DATE}' AS run_date, date AS as_of_date, CAST(date + 1 AS DATE) AS forecast_date, CountryCode, ROUND(risk_raw, 10) AS risk_as_of, "
                             "total_events, " + ", ".join(S.r(c) for c in ["conflict_share", "negative_share", "weighted_avg_tone"]) + " FROM fc"),
)(lambda spark, sf_dir: _job_risk(spark, sf_dir, "forecasts").drop("pred_risk_next_day"))


def _job_refresh(spark, sf_dir):
    return jobs.run_refresh(spark, raw_events(spark, sf_dir), jobs.Layout(_scratch(spark, "job")), *JOB_WINDOW, run_date=RUN_DATE)


register(
    "job_refresh",
    S.with_ctes(_JOB_LATEST,
                "SELECT (SELECT CAST(STRPTIME(CAST(MAX(SQLDATE) AS VARCHAR), '%Y%m%d') AS DATE) FROM extract) AS extract_max_date, "
                "(SELECT MAX(date) FROM clean) AS clean_max_date, (SELECT MAX(date) FROM risk) AS risk_max_date, "
                "(SELECT CAST(MAX(date) + 1 AS DATE) FROM fc) AS forecast_max_date, (SELECT COUNT(*) FROM fc) AS forecast_rows, "
                "TRUE AS clean_matches_extract, TRUE AS risk_matches_clean, TRUE AS forecast_is_next_day"),
)(_job_refresh)


def _job_anomalies(spark, sf_dir):
    layout, _ = _job_events(spark, sf_dir)
    path = jobs.run_anomalies(spark, layout)["top50"]
    return _rounded_scores(spark.read.option("header", True).schema(_TOP_SCHEMA).csv(path))


register(
    "job_anomalies",
    S.with_ctes(_JOB_CLEAN + [x for x in _ISOLATION if x not in _DENSE_CLEAN], f"SELECT {_LAB} FROM lab ORDER BY lab.anomaly_score, CountryCode, date LIMIT 50"),
)(_job_anomalies)
