"""Per-country time-series features: lags, rolling stats, targets, folds.

All windows are partitioned by country and ordered by date. They run on the
country-day table, whose size is bounded by countries x days however large the
raw event volume is, so one country's window stays a few thousand rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LAGS = (1, 2, 3, 7, 14)
# Features of the pooled next-day model (lags, rolling stats, same-day signals).
FEATURE_COLS = [
    "lag_1",
    "lag_2",
    "lag_3",
    "lag_7",
    "lag_14",
    "roll_mean_7",
    "roll_std_7",
    "total_events",
    "conflict_share",
    "negative_share",
    "weighted_avg_tone",
]
# Features of the single-series model (calendar-filled series has only these).
SERIES_FEATURE_COLS = FEATURE_COLS[:7]
TARGET = "target_next_day"


def rolling_mean_std(
    value: str, key: str = "CountryCode", date_col: str = "date", window: int = 7, min_rows: int = 3
) -> tuple[Column, Column]:
    """Trailing ``window``-row mean and sample std, null until ``min_rows`` non-null values."""
    frame = Window.partitionBy(key).orderBy(date_col).rowsBetween(-(window - 1), 0)
    enough = F.count(value).over(frame) >= min_rows
    return (
        F.when(enough, F.avg(value).over(frame)),
        F.when(enough, F.stddev_samp(value).over(frame)),
    )


def fill_calendar(
    series: DataFrame,
    key: str = "CountryCode",
    date_col: str = "date",
    fill: dict[str, float] | None = None,
) -> DataFrame:
    """Reindex every key's series onto its full daily calendar (min..max date).

    Missing days get ``fill`` values (default ``risk_raw = 0.0``); other columns
    stay null. The spine is generated per key from its min/max (one small
    aggregate), exploded and left-joined back on (key, date).
    """
    fill = fill if fill is not None else {"risk_raw": 0.0}
    bounds = series.groupBy(key).agg(F.min(date_col).alias("_lo"), F.max(date_col).alias("_hi"))
    spine = bounds.select(
        key, F.explode(F.sequence("_lo", "_hi", F.expr("INTERVAL 1 DAY"))).alias(date_col)
    )
    out = spine.join(series, [key, date_col], "left")
    return out.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in fill.items()})


def risk_features(
    risk: DataFrame,
    value: str = "risk_raw",
    key: str = "CountryCode",
    date_col: str = "date",
    lags=LAGS,
    window: int = 7,
    min_rows: int = 3,
    calendar: bool = False,
) -> DataFrame:
    """Add ``lag_k``, ``roll_mean_7``, ``roll_std_7`` and ``target_next_day``.

    Default: lags count rows (a country's previous observation), as the
    published model does. ``calendar=True`` first fills missing days with 0.0
    so lags count days.
    """
    df = fill_calendar(risk, key, date_col, {value: 0.0}) if calendar else risk
    w = Window.partitionBy(key).orderBy(date_col)
    mean, std = rolling_mean_std(value, key, date_col, window, min_rows)
    cols = {f"lag_{k}": F.lag(value, k).over(w) for k in lags}
    cols[f"roll_mean_{window}"] = mean
    cols[f"roll_std_{window}"] = std
    cols[TARGET] = F.lead(value, 1).over(w)
    return df.withColumns(cols)


def training_rows(features: DataFrame, feature_cols=FEATURE_COLS, target: str = TARGET) -> DataFrame:
    """Rows where every feature and the target are known."""
    return features.dropna(subset=list(feature_cols) + [target])


def latest_feature_rows(
    features: DataFrame, feature_cols=FEATURE_COLS, key: str = "CountryCode", date_col: str = "date"
) -> DataFrame:
    """Each key's latest row, dropped afterwards if any feature is null (order matters)."""
    w = Window.partitionBy(key).orderBy(F.col(date_col).desc())
    latest = features.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")
    return latest.dropna(subset=list(feature_cols))


def holdout_split(train: DataFrame, days: int = 14, date_col: str = "date") -> DataFrame:
    """Flag the last ``days`` days (date > max(date) - days) as holdout.

    The maximum is a scalar subquery: computed once, inlined as a literal.
    """
    cutoff = train.select(F.date_sub(F.max(date_col), days)).scalar()
    return train.withColumn("is_holdout", F.col(date_col) > cutoff)


def time_series_folds(
    df: DataFrame, n_splits: int = 5, key: str = "CountryCode", date_col: str = "date"
) -> DataFrame:
    """Expanding-window folds per key (sklearn ``TimeSeriesSplit`` layout).

    With ``n`` rows and ``t = n // (n_splits + 1)``, fold ``i`` tests rows
    ``[n - (n_splits - i) * t, n - (n_splits - i - 1) * t)`` and trains on every
    earlier row. Adds ``rn`` (0-based), ``n`` and ``test_fold`` (null when the
    row is never a test row); fold ``f`` trains on ``coalesce(test_fold, -1) < f``.
    """
    w = Window.partitionBy(key).orderBy(date_col)
    df = df.withColumns(
        {"rn": F.row_number().over(w) - 1, "n": F.count(F.lit(1)).over(Window.partitionBy(key))}
    )
    t = F.floor(F.col("n") / (n_splits + 1))
    first = F.col("n") - t * n_splits
    fold = F.when((t > 0) & (F.col("rn") >= first), F.floor((F.col("rn") - first) / t))
    return df.withColumn("test_fold", fold.cast("int"))
