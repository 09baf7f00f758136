"""Next-day risk forecasting with random forests.

One pooled model over all countries (the published design), trained where
every feature and the next-day target are known: 500 fully grown trees with exact splits
(``operators/forest.py``).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsrisk.functions.draws import digest
from newsrisk.operators.forest import Forest
from newsrisk.operators.forest import fit_forest as _fit_forest
from newsrisk.operators.ranking import global_row_number
from newsrisk.session import materialize
from newsrisk.operators.features import (
    FEATURE_COLS,
    SERIES_FEATURE_COLS,
    TARGET,
    holdout_split,
    latest_feature_rows,
    risk_features,
    time_series_folds,
    training_rows,
)

# The published column order of a forecast snapshot.
FORECAST_COLUMNS = [
    "run_date",
    "as_of_date",
    "forecast_date",
    "CountryCode",
    "pred_risk_next_day",
    "risk_as_of",
    "total_events",
    "conflict_share",
    "negative_share",
    "weighted_avg_tone",
]


def fit_forest(train: DataFrame, feature_cols=FEATURE_COLS, trees: int = 500, seed: int = 42, max_depth: int | None = None) -> Forest:
    """The published forest: exact splits over every feature, fully grown (``operators/forest.py``).

    With a ``model`` column, one forest per model in the same passes.
    """
    keys = [c for c in ("CountryCode", "date") if c in train.columns]
    return _fit_forest(train, list(feature_cols), TARGET, keys or list(feature_cols), trees, seed, max_depth)


def backtest_errors(predicted: DataFrame) -> DataFrame:
    """One row: the holdout's rows, error and days."""
    return predicted.agg(
        F.count(F.lit(1)).alias("n_holdout"),
        F.avg(F.abs(F.col(TARGET) - F.col("prediction"))).alias("mae"),
        F.min("date").alias("holdout_start"),
        F.max("date").alias("holdout_end"),
    )


def forecast_backtest(
    features: DataFrame, feature_cols=FEATURE_COLS, holdout_days: int = 14, trees: int = 500, seed: int = 42,
    max_depth: int | None = None,
) -> DataFrame:
    """Fit on days <= max(date) - holdout_days, report the holdout MAE (one row)."""
    rows = materialize(holdout_split(training_rows(features, feature_cols), holdout_days))
    forest = fit_forest(rows.where(~F.col("is_holdout")), feature_cols, trees, seed, max_depth)
    return backtest_errors(forest.predict(rows.where(F.col("is_holdout"))))


def snapshot(latest: DataFrame, prediction, run_date: _dt.date | str | None = None) -> DataFrame:
    """The published snapshot columns of the latest rows and their prediction."""
    run = F.current_date() if run_date is None else F.lit(str(run_date)).cast("date")
    return latest.select(
        run.alias("run_date"),
        F.col("date").alias("as_of_date"),
        F.date_add("date", 1).alias("forecast_date"),
        "CountryCode",
        F.col(prediction).alias("pred_risk_next_day"),
        F.col("risk_raw").alias("risk_as_of"),
        "total_events",
        "conflict_share",
        "negative_share",
        "weighted_avg_tone",
    )


def forecast_next_day(
    features: DataFrame,
    run_date: _dt.date | str | None = None,
    feature_cols=FEATURE_COLS,
    trees: int = 500,
    seed: int = 42,
    max_depth: int | None = None,
    model_path: str | None = None,
) -> DataFrame:
    """Refit on every training row, forecast from each country's latest row.

    A country whose latest row lacks a feature gets no forecast. With ``model_path`` the forest is stored
    there, and the forecast made from the stored model.
    """
    features = materialize(features)  # the fit and the latest-row scoring share it
    forest = fit_forest(training_rows(features, feature_cols), feature_cols, trees, seed, max_depth)
    if model_path:
        forest.save(model_path)
        forest = Forest.load(features.sparkSession, model_path)
    return forecast_from(forest, features, run_date)


def forecast_from(forest: Forest, features: DataFrame, run_date: _dt.date | str | None = None) -> DataFrame:
    """The snapshot that a fitted (or stored) forest gives for each country's latest row."""
    return snapshot(forest.predict(latest_feature_rows(features, forest.features)), "prediction", run_date)


def baseline_next_day(features: DataFrame, run_date: _dt.date | str, prediction: str = "roll_mean_7", feature_cols=FEATURE_COLS) -> DataFrame:
    """The snapshot of a forecast that needs no model: each country's latest ``prediction`` value."""
    return snapshot(latest_feature_rows(features, feature_cols), prediction, run_date)


def top_country_series(risk: DataFrame, countries=None) -> DataFrame:
    """Restrict the risk table to ``countries`` (default: the highest-volume one)."""
    if countries is None:
        top = (
            risk.groupBy("CountryCode")
            .agg(F.sum("total_events").alias("_t"))
            .orderBy(F.col("_t").desc(), "CountryCode")
            .limit(1)
            .select("CountryCode")
        )
        return risk.join(F.broadcast(top), "CountryCode", "left_semi")  # one row
    return risk.where(F.col("CountryCode").isin(*countries))


def cv_rows(risk: DataFrame, countries=None) -> DataFrame:
    """Calendar-filled series features with complete rows, plus fold assignment."""
    series = top_country_series(risk.select("date", "CountryCode", "risk_raw", "total_events"), countries)
    feats = risk_features(series.select("date", "CountryCode", "risk_raw"), calendar=True)
    return time_series_folds(training_rows(feats, SERIES_FEATURE_COLS))


def fold_training_rows(rows: DataFrame, n_splits: int, first: int = 0) -> DataFrame:
    """Each row once per fold from ``first`` on that trains on it, the fold as ``model``."""
    since = F.greatest(F.coalesce(F.col("test_fold"), F.lit(-1)) + 1, F.lit(first))
    folds = F.when(since < n_splits, F.sequence(since, F.lit(n_splits - 1)))
    return rows.select("*", F.explode(folds).alias("model"))


def cv_predictions(
    risk: DataFrame, countries=None, n_splits: int = 5, trees: int = 500, seed: int = 42, max_depth: int | None = None,
) -> DataFrame:
    """Expanding-window CV of the series model: (fold, date, CountryCode, actual, predicted).

    ``date`` is the day the features are known; actual and predicted are of the
    next one. The folds are the models of one fit: all their trees grow in the same passes.
    """
    rows = materialize(cv_rows(risk, countries))  # the training rows and the test rows
    forest = fit_forest(fold_training_rows(rows, n_splits), SERIES_FEATURE_COLS, trees, seed, max_depth)
    test = rows.where(F.col("test_fold").isNotNull()).withColumn("model", F.col("test_fold"))
    return forest.predict(test).select(
        F.col("test_fold").alias("fold"), "date", "CountryCode", F.col(TARGET).alias("actual"), F.col("prediction").alias("predicted")
    )


def cv_errors(predictions: DataFrame) -> DataFrame:
    """One row per fold and country set: n_test, mae, and the mean of the folds' MAEs."""
    folds = predictions.groupBy("fold").agg(
        F.count(F.lit(1)).alias("n_test"),
        F.avg(F.abs(F.col("actual") - F.col("predicted"))).alias("mae"),
        F.array_join(F.sort_array(F.collect_set("CountryCode")), ",").alias("countries"),
    )
    return folds.withColumn("mean_mae", folds.select(F.avg("mae")).scalar())


def last_fold_series(predictions: DataFrame) -> DataFrame:
    """The forecast chart: (date, CountryCode, actual, predicted) of the last fold."""
    return predictions.where(F.col("fold") == predictions.select(F.max("fold")).scalar()).drop("fold")


def forecast_cv(
    risk: DataFrame, countries=None, n_splits: int = 5, trees: int = 500, seed: int = 42, max_depth: int | None = None,
) -> DataFrame:
    """One row per fold plus the mean MAE (``cv_errors`` of ``cv_predictions``)."""
    return cv_errors(cv_predictions(risk, countries, n_splits, trees, seed, max_depth))


def permuted_copies(test: DataFrame, feature_cols=SERIES_FEATURE_COLS, n_repeats: int = 10, seed: int = 42, keys=("CountryCode", "date")) -> DataFrame:
    """``test`` once per (feature ``pf``, repeat ``rep``), that feature's values shuffled among the copy's rows.

    A copy's rows are numbered in the order of ``keys`` and in the order of an MD5 of seed, feature, repeat and
    keys; the row at one place gets the value of the row at the same place of the other order. Both
    orders are numbered over ranges of all copies at once: no copy is sorted in one task.
    """
    keys = list(keys)
    base = materialize(global_row_number(test, keys, "_place"))
    rows = base.count()
    index = F.posexplode(F.array(*[F.struct(F.lit(c).alias("pf"), F.lit(r).alias("rep")) for c in feature_cols for r in range(n_repeats)])).alias("copy", "_p")
    drawn = base.select(*keys, *feature_cols, index).select("*", "_p.pf", "_p.rep")
    drawn = drawn.withColumn("_hash", digest(seed, F.col("pf"), F.col("rep"), *[F.col(k) for k in keys]))
    value = F.coalesce(*[F.when(F.col("pf") == c, F.col(c)) for c in feature_cols])
    donors = global_row_number(drawn.select("copy", "pf", "rep", "_hash", *keys, value.alias("_v")), ["copy", "_hash", *keys], "_place")
    donors = donors.select("pf", "rep", (F.col("_place") - F.col("copy").cast("long") * rows).alias("_place"), "_v")  # every copy has all rows
    moved = base.join(donors, "_place").drop("_place")
    return moved.withColumns({c: F.when(F.col("pf") == c, F.col("_v")).otherwise(F.col(c)) for c in feature_cols}).drop("_v")


def permutation_importance(
    predict,
    test: DataFrame,
    feature_cols=SERIES_FEATURE_COLS,
    n_repeats: int = 10,
    seed: int = 42,
    keys=("CountryCode", "date"),
) -> DataFrame:
    """Mean drop in R^2 when one feature's values are shuffled among the test rows.

    ``predict`` adds a column ``prediction`` to rows (``Forest.predict``, or any other model's). The
    shuffled copies (``permuted_copies``) are scored together and R^2 is aggregated per copy.
    """
    test = materialize(test.select(*keys, TARGET, *feature_cols))
    sq_err = (F.col(TARGET) - F.col("prediction")) ** 2
    # R^2 = 1 - SS_res / SS_tot; the target is the same in every copy, so SS_tot
    # and the baseline SS_res are scalars and the drop is (SS_res' - SS_res) / SS_tot.
    stats = predict(test).agg(
        F.count(F.lit(1)).cast("double").alias("n"),
        F.sum(TARGET).alias("sy"),
        F.sum(F.col(TARGET) ** 2).alias("syy"),
        F.sum(sq_err).alias("sse"),
    ).first()  # one row
    ss_tot = (stats["syy"] or 0.0) - (stats["sy"] or 0.0) ** 2 / max(stats["n"], 1.0)
    per_copy = predict(permuted_copies(test, feature_cols, n_repeats, seed, keys)).groupBy("pf", "rep").agg(F.sum(sq_err).alias("ss_res"))
    drop = F.when(F.lit(ss_tot) > 0, (F.col("ss_res") - F.lit(stats["sse"])) / F.lit(ss_tot or None).cast("double"))
    return (
        per_copy.withColumn("drop", drop)
        .groupBy(F.col("pf").alias("feature"))
        .agg(F.avg("drop").alias("importance"), F.stddev_pop("drop").alias("importance_std"))
        .orderBy(F.col("importance").desc(), "feature")
    )


def forecast_cv_importance(
    risk: DataFrame, countries=None, n_splits: int = 5, n_repeats: int = 10, trees: int = 500, seed: int = 42,
    max_depth: int | None = None,
) -> DataFrame:
    """Permutation importance of the last CV fold's model on its test rows."""
    rows = materialize(cv_rows(risk, countries))
    last = n_splits - 1
    forest = fit_forest(fold_training_rows(rows, n_splits, first=last), SERIES_FEATURE_COLS, trees, seed, max_depth)
    predict = lambda df: forest.predict(df.withColumn("model", F.lit(last)))
    return permutation_importance(predict, rows.where(F.col("test_fold") == last), SERIES_FEATURE_COLS, n_repeats, seed)
