"""Country-day risk table, in both published formulas."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsrisk.functions.codes import CONFLICT_CODES, CONFLICT_CODES_WEIGHTED10, lpad_root_code
from newsrisk.functions.scalars import NEGATIVE_TONE_MAX, if_else_zero, safe_divide

# --- fixed values (score weights) ---------------------------------------------
SHARE_LOG_WEIGHTS = {"conflict": 1.5, "negative": 1.0, "log_volume": 0.5}
WEIGHTED10 = {"scale": 10.0, "negative": 0.6, "conflict": 0.4, "log_divisor": 5.5}
# --- end fixed values ----------------------------------------------------------

# The published column order of the risk table.
RISK_COLUMNS = [
    "date",
    "CountryCode",
    "total_events",
    "conflict_events",
    "negative_tone_events",
    "weighted_avg_tone",
    "conflict_share",
    "negative_share",
    "log_events",
    "risk_raw",
]
RISK_COLUMNS_WEIGHTED10 = [
    "date",
    "CountryCode",
    "total_events",
    "conflict_events",
    "conflict_share",
    "negative_share",
    "weighted_avg_tone",
    "risk_raw",
]


def country_risk_daily(clean: DataFrame, variant: str = "share_log", ordered: bool = True) -> DataFrame:
    """(date, CountryCode) risk features and score from the clean table.

    ``share_log`` (default): conflict = roots 14-20, negative = AvgTone <= -2,
    ``risk_raw = 1.5*conflict_share + 1.0*negative_share + 0.5*ln(1+n)``.
    ``weighted10``: conflict = roots 18-20, negative = ToneBucket 'negative',
    ``risk_raw = 10*(0.6*negative_share + 0.4*conflict_share) + ln(1+n)/5.5``.
    One hash aggregate (partial before the shuffle) over a bounded
    country x day x root table.
    """
    if variant == "share_log":
        base = clean.where(F.col("CountryCode").isNotNull() & F.col("date").isNotNull()).select(
            F.col("date").cast("date").alias("date"),
            "CountryCode",
            lpad_root_code("EventRootCode").alias("EventRootCode"),
            F.col("EventCount").cast("bigint").alias("EventCount"),
            F.col("AvgTone").cast("double").alias("AvgTone"),
        )
        agg = base.groupBy("date", "CountryCode").agg(
            F.sum("EventCount").alias("total_events"),
            F.sum(if_else_zero(F.col("EventRootCode").isin(*CONFLICT_CODES), "EventCount")).alias("conflict_events"),
            F.sum(if_else_zero(F.col("AvgTone") <= F.lit(NEGATIVE_TONE_MAX), "EventCount")).alias(
                "negative_tone_events"
            ),
            safe_divide(F.sum(F.col("AvgTone") * F.col("EventCount")), F.sum("EventCount")).alias(
                "weighted_avg_tone"
            ),
        )
        w = SHARE_LOG_WEIGHTS
        conflict_share = safe_divide("conflict_events", "total_events")
        negative_share = safe_divide("negative_tone_events", "total_events")
        log_events = F.ln(F.lit(1.0) + F.col("total_events"))
        out = agg.select(
            "date",
            "CountryCode",
            "total_events",
            "conflict_events",
            "negative_tone_events",
            "weighted_avg_tone",
            conflict_share.alias("conflict_share"),
            negative_share.alias("negative_share"),
            log_events.alias("log_events"),
            (
                F.lit(w["conflict"]) * conflict_share
                + F.lit(w["negative"]) * negative_share
                + F.lit(w["log_volume"]) * log_events
            ).alias("risk_raw"),
        )
    elif variant == "weighted10":
        base = clean.where(F.col("date").isNotNull() & F.col("CountryCode").isNotNull())
        conflict = if_else_zero(F.col("EventRootCode").isin(*CONFLICT_CODES_WEIGHTED10), "EventCount")
        negative = if_else_zero(F.col("ToneBucket") == F.lit("negative"), "EventCount")
        agg = base.groupBy("date", "CountryCode").agg(
            F.sum("EventCount").alias("total_events"),
            F.sum(conflict).alias("conflict_events"),
            safe_divide(F.sum(conflict), F.sum("EventCount")).alias("conflict_share"),
            safe_divide(F.sum(negative), F.sum("EventCount")).alias("negative_share"),
            safe_divide(F.sum(F.col("AvgTone") * F.col("EventCount")), F.sum("EventCount")).alias(
                "weighted_avg_tone"
            ),
        )
        w = WEIGHTED10
        risk = F.lit(w["scale"]) * (
            F.lit(w["negative"]) * F.col("negative_share") + F.lit(w["conflict"]) * F.col("conflict_share")
        ) + F.ln(F.lit(1.0) + F.col("total_events")) / F.lit(w["log_divisor"])
        out = agg.withColumn("risk_raw", risk).select(*RISK_COLUMNS_WEIGHTED10)
    else:
        raise ValueError("variant must be 'share_log' or 'weighted10'")
    return out.orderBy("date", "CountryCode") if ordered else out
