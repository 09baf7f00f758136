"""Refresh of the days that a late delivery touches, instead of a rebuild.

The clean table, the risk table and the features lie partitioned by date below one folder. A delivery names the days to
extract again; only their partitions of the clean and the risk table are rewritten. A feature row reads the 14 rows of
its country before it and the row after it, so of the features the days of all rows in that reach are rewritten too.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from newsrisk.operators.clean import clean_events
from newsrisk.operators.events import extract_events_daily
from newsrisk.operators.features import LAGS, risk_features
from newsrisk.operators.risk import country_risk_daily
from newsrisk.session import materialize
from newsrisk.sources import sinks

TABLES = ("clean", "risk", "features")


def near(flag, before: int, after: int, key: str = "CountryCode"):
    """Whether a row of the same country within ``before`` rows before or ``after`` rows after has ``flag``."""
    w = Window.partitionBy(key).orderBy("date").rowsBetween(-before, after)
    return F.coalesce(F.max(F.when(flag, 1)).over(w), F.lit(0)) == 1


def refresh_days(spark: SparkSession, raw: DataFrame, delivery: DataFrame, root: str, variant: str = "share_log") -> dict:
    """Bring the tables below ``root`` up to date with ``raw``, of which the rows ``delivery`` are new.

    Returns the days extracted again, and those whose features were rewritten (lists as long as the
    calendar of the delivery).
    """
    root = root.rstrip("/")
    days = sorted(r[0] for r in delivery.where(F.col("ActionGeo_CountryCode").isNotNull()).select("SQLDATE").distinct().collect() if r[0] is not None)
    extract = extract_events_daily(raw.where(F.col("SQLDATE").isin(days)), ordered=False)
    clean = materialize(clean_events(extract).where(F.col("date").isNotNull()))
    sinks.write_days(clean, f"{root}/clean")
    dates = sorted(r[0] for r in clean.select("date").distinct().collect())
    risk = country_risk_daily(spark.read.parquet(f"{root}/clean").where(F.col("date").isin(dates)), variant, ordered=False)
    sinks.write_days(risk, f"{root}/risk")

    whole = spark.read.parquet(f"{root}/risk")
    back = max(LAGS)  # the rolling frames reach back less far
    touched = whole.select("CountryCode", "date", near(F.col("date").isin(dates), back, 1).alias("_near")).where("_near")
    feature_dates = sorted(r[0] for r in touched.select("date").distinct().collect())
    asked = F.col("date").isin(feature_dates)
    needed = whole.withColumn("_near", near(asked, 1, back)).where("_near").drop("_near")
    sinks.write_days(risk_features(needed).where(asked), f"{root}/features")
    return {"days": days, "feature_days": feature_dates}
