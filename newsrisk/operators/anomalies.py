"""Country-day anomaly detection: panel, rolling z-scores, isolation forest scores and labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsrisk.operators.features import rolling_mean_std
from newsrisk.operators.isolation import raw_scores
from newsrisk.operators.quantiles import exact_percentiles
from newsrisk.session import materialize

# The scored columns and their z-score names, in the published order.
Z_SPECS = [
    ("log_events", "z_events_7d"),
    ("log_mentions", "z_mentions_7d"),
    ("AvgTone", "z_tone_7d"),
    ("AvgGoldstein", "z_goldstein_7d"),
]
Z_COLS = [z for _, z in Z_SPECS]
STD_EPS = 1e-12  # a rolling std at or below this counts as zero (constant window)

# The published column order of the top list.
TOP_COLUMNS = ["date", "CountryCode", "EventCount", "AvgTone", "AvgGoldstein", "anomaly_score", "anomaly_label"]


def country_day_panel(clean: DataFrame) -> DataFrame:
    """Collapse root-code rows to one row per (date, CountryCode).

    Averages are re-weighted by event counts: a null tone leaves the numerator
    but its events stay in the denominator. Null keys are dropped; sums over
    all-null inputs are 0.
    """
    number = lambda c: F.nanvl(F.col(c), F.lit(None).cast("double"))  # noqa: E731  (NaN is a missing value)
    base = clean.where(F.col("date").isNotNull() & F.col("CountryCode").isNotNull())
    agg = base.groupBy("date", "CountryCode").agg(
        F.coalesce(F.sum("EventCount"), F.lit(0)).cast("bigint").alias("EventCount"),
        F.coalesce(F.sum("TotalMentions"), F.lit(0)).cast("bigint").alias("TotalMentions"),
        F.coalesce(F.sum("TotalArticles"), F.lit(0)).cast("bigint").alias("TotalArticles"),
        F.coalesce(F.sum("TotalSources"), F.lit(0)).cast("bigint").alias("TotalSources"),
        F.coalesce(F.sum(number("AvgTone") * F.col("EventCount")), F.lit(0.0)).alias("tone_x_events"),
        F.coalesce(F.sum(number("AvgGoldstein") * F.col("EventCount")), F.lit(0.0)).alias("gold_x_events"),
    )
    n = F.nullif(F.col("EventCount"), F.lit(0)).cast("double")
    return agg.select(
        "date",
        "CountryCode",
        "EventCount",
        "TotalMentions",
        "TotalArticles",
        "TotalSources",
        (F.col("tone_x_events") / n).alias("AvgTone"),
        (F.col("gold_x_events") / n).alias("AvgGoldstein"),
        F.log1p("EventCount").alias("log_events"),
        F.log1p("TotalMentions").alias("log_mentions"),
    )


def rolling_z(panel: DataFrame, specs=Z_SPECS, window: int = 7, min_rows: int = 3, key: str = "CountryCode") -> DataFrame:
    """z = (x - trailing mean) / trailing sample std per country; undefined -> 0 (NaN counts as missing)."""
    panel = panel.withColumns({src: F.nanvl(F.col(src).cast("double"), F.lit(None).cast("double")) for src, _ in specs})
    cols = {}
    for src, out in specs:
        mean, std = rolling_mean_std(src, key, "date", window, min_rows)
        z = F.when(std > F.lit(STD_EPS), (F.col(src) - mean) / std)
        cols[out] = F.coalesce(z, F.lit(0.0))
    return panel.withColumns(cols)


def feature_scaling(df: DataFrame, cols=Z_COLS, suffix: str = "_s") -> DataFrame:
    """Standard scaling with population std; a zero std scales by 1.

    Means and stds are one aggregate read as a single scalar subquery (no join).
    """
    stats = df.select(
        F.struct(
            *[F.avg(c).alias(f"m_{c}") for c in cols], *[F.stddev_pop(c).alias(f"s_{c}") for c in cols]
        )
    ).scalar()  # one subquery, executed once and reused by every reference
    out = {}
    for c in cols:
        m = stats.getField(f"m_{c}")
        s = stats.getField(f"s_{c}")
        scale = F.when(s > F.lit(STD_EPS), s).otherwise(F.lit(1.0))
        out[c + suffix] = (F.col(c) - m) / scale
    return df.withColumns(out)


def isolation_forest_scores(
    df: DataFrame,
    cols: list[str],
    key_cols: list[str] = ("date", "CountryCode"),
    trees: int = 300,
    sample: int = 256,
    contamination: float = 0.01,
    seed: int = 42,
    exact_threshold: bool = True,
) -> DataFrame:
    """Score every row: ``anomaly_score = s - q`` and ``anomaly_label`` in {-1, 1}.

    ``s = -2 ** (-E[h(x)] / c(psi))`` (lower = more isolated) and ``q`` is the
    ``contamination`` quantile of ``s`` over the scored rows; rows below ``q``
    are labelled -1. The quantile is exact by default (two-pass, see
    ``quantiles.exact_percentiles``) or ``approx_percentile``.
    """
    return labelled(raw_scores(df, cols, list(key_cols), trees, sample, seed, "_s"), "_s", contamination, exact_threshold)


def labelled(scored: DataFrame, score: str, contamination: float = 0.01, exact_threshold: bool = True) -> DataFrame:
    """Turn a raw score (lower = stranger) into ``anomaly_score`` (raw less its quantile) and ``anomaly_label``."""
    if exact_threshold:  # exact quantile without gathering every score in one task
        q = exact_percentiles(scored, score, [contamination]).select("q0").scalar()
    else:
        q = scored.select(F.approx_percentile(score, F.lit(contamination), 100000)).scalar()
    return scored.withColumn("anomaly_score", F.col(score) - q).withColumn(
        "anomaly_label", F.when(F.col("anomaly_score") < 0, F.lit(-1)).otherwise(F.lit(1))
    ).drop(score)


def z_score_anomalies(zpanel: DataFrame, contamination: float = 0.01) -> DataFrame:
    """Anomalies without a model: the sum of absolute z-scores, thresholded and labelled like the forest's score."""
    total = sum((F.abs(F.col(c)) for c in Z_COLS[1:]), F.abs(F.col(Z_COLS[0])))
    return labelled(materialize(zpanel.withColumn("_s", -total)), "_s", contamination)


def top_anomalies(scored: DataFrame, k: int = 50) -> DataFrame:
    """The ``k`` most anomalous rows (ascending score; ties by country, date)."""
    return scored.orderBy("anomaly_score", "CountryCode", "date").select(*TOP_COLUMNS).limit(k)


def top_country(panel: DataFrame, value: str = "EventCount", key: str = "CountryCode") -> DataFrame:
    """Single highest-volume key (arg-max of the summed value; ties -> smaller key)."""
    return (
        panel.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.sum(value).cast("bigint").alias(f"total_{value}"))
        .orderBy(F.col(f"total_{value}").desc(), F.col(key))
        .limit(1)
    )


def top_country_anomalies(scored: DataFrame) -> DataFrame:
    """The top country's daily series with its anomaly flags (chart data)."""
    top = top_country(scored).select("CountryCode")
    return (
        scored.join(F.broadcast(top), "CountryCode", "left_semi")  # one row: bounded broadcast
        .select("date", "CountryCode", "EventCount", "anomaly_score", "anomaly_label")
        .orderBy("date")
    )


def detect_anomalies(clean: DataFrame, trees: int = 300, sample: int = 256, contamination: float = 0.01, seed: int = 42):
    """Clean table -> scored country-day panel (panel, z features, scaling, forest)."""
    panel = rolling_z(country_day_panel(clean))
    scaled = feature_scaling(panel, Z_COLS)
    scaled_cols = [c + "_s" for c in Z_COLS]
    return isolation_forest_scores(scaled, scaled_cols, ["date", "CountryCode"], trees, sample, contamination, seed)
