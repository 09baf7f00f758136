"""Chart data: the aggregates behind the overview figures (no rendering)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsrisk.operators.clean import drop_null_dates
from newsrisk.operators.quantiles import exact_percentiles
from newsrisk.session import BROADCAST_LIST_ROWS, broadcast_list, materialize


def global_daily_volume(clean: DataFrame) -> DataFrame:
    return drop_null_dates(clean).groupBy("date").agg(F.sum("EventCount").cast("bigint").alias("EventCount"))


def top_countries(clean: DataFrame, k: int = 15) -> DataFrame:
    """Top-k countries by total events (null country excluded; ties by code)."""
    return (
        drop_null_dates(clean)
        .where(F.col("CountryCode").isNotNull())
        .groupBy("CountryCode")
        .agg(F.sum("EventCount").cast("bigint").alias("EventCount"))
        .orderBy(F.col("EventCount").desc(), "CountryCode")
        .limit(k)
    )


def tone_histogram(clean: DataFrame, bins: int = 60) -> DataFrame:
    """Event-weighted histogram of AvgTone over ``bins`` equal-width bins.

    Bounds are the data's min/max (scalar subqueries); the maximum falls in the
    last bin; if min == max the range is widened by 0.5 each side. Every bin is
    returned, empty ones with weight 0 (the bin spine has ``bins`` rows).
    """
    tones = drop_null_dates(clean).where(F.col("AvgTone").isNotNull() & ~F.isnan("AvgTone"))
    bounds = tones.select(F.struct(F.min("AvgTone").alias("lo"), F.max("AvgTone").alias("hi"))).scalar()
    lo0, hi0 = bounds.getField("lo"), bounds.getField("hi")
    same = hi0 == lo0
    lo = F.when(same, lo0 - F.lit(0.5)).otherwise(lo0)
    hi = F.when(same, hi0 + F.lit(0.5)).otherwise(hi0)
    b = F.least(F.floor((F.col("AvgTone") - lo) / (hi - lo) * F.lit(bins)), F.lit(bins - 1)).cast("int")
    counts = tones.groupBy(b.alias("bin")).agg(F.sum("EventCount").cast("bigint").alias("weight"))
    spine = clean.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    width = (hi - lo) / F.lit(bins)
    return spine.join(broadcast_list(counts, bins), "bin", "left").select(
        "bin",
        (lo + F.col("bin") * width).alias("bin_lo"),
        (lo + (F.col("bin") + 1) * width).alias("bin_hi"),
        F.coalesce(F.col("weight"), F.lit(0)).cast("bigint").alias("weight"),
    )


def top_root_categories(clean: DataFrame, k: int = 12) -> DataFrame:
    return (
        drop_null_dates(clean)
        .where(F.col("EventRootCode").isNotNull() & F.col("EventRootLabel").isNotNull())
        .groupBy("EventRootCode", "EventRootLabel")
        .agg(F.sum("EventCount").cast("bigint").alias("EventCount"))
        .orderBy(F.col("EventCount").desc(), "EventRootCode")
        .limit(k)
    )


def _in_top_labels(clean: DataFrame, k: int) -> DataFrame:
    labels = top_root_categories(clean, k).select("EventRootLabel").distinct()
    return drop_null_dates(clean).join(broadcast_list(labels, k), "EventRootLabel", "left_semi")


def monthly_root_heatmap(clean: DataFrame, k: int = 12) -> DataFrame:
    """Long form: (EventRootLabel, month, EventCount, log10(EventCount + 1)) for top-k labels.

    One pass over the clean table: (code, label, month) sums are aggregated and
    checkpointed (bounded by roots x months); the top-k labels and the heat
    cells are both derived from that small table.
    """
    cells = materialize(
        drop_null_dates(clean)
        .groupBy("EventRootCode", "EventRootLabel", F.trunc("date", "MM").alias("month"))
        .agg(F.sum("EventCount").alias("EventCount"))
    )
    top = (
        cells.where(F.col("EventRootCode").isNotNull() & F.col("EventRootLabel").isNotNull())
        .groupBy("EventRootCode", "EventRootLabel")
        .agg(F.sum("EventCount").alias("total"))
        .orderBy(F.col("total").desc(), "EventRootCode")
        .limit(k)
        .select("EventRootLabel")
        .distinct()
    )
    return (
        cells.join(broadcast_list(top, k), "EventRootLabel", "left_semi")  # at most k labels
        .groupBy("EventRootLabel", "month")
        .agg(F.sum("EventCount").cast("bigint").alias("EventCount"))
        .withColumn("log_events", F.log10(F.col("EventCount") + F.lit(1.0)))
    )


def monthly_root_heatmap_wide(clean: DataFrame, k: int = 12) -> DataFrame:
    """Label x month matrix of log10(events + 1); missing cells are 0."""
    long = monthly_root_heatmap(clean, k)
    wide = long.groupBy("EventRootLabel").pivot("month").agg(F.first("log_events"))
    return wide.fillna(0.0)


def tone_boxplot(clean: DataFrame, k: int = 12) -> DataFrame:
    """Box statistics of AvgTone per top-k label: quartiles, 1.5 IQR whiskers, outliers.

    Quartiles are exact (linear interpolation) via ``exact_percentiles``;
    whiskers are the extreme values inside the 1.5 IQR fences and outliers the
    count outside. The stats table has at most k rows and is broadcast.
    """
    rows = _in_top_labels(clean, k).where(F.col("AvgTone").isNotNull() & ~F.isnan("AvgTone"))
    # exact quartiles without gathering a (possibly huge) label group in one task
    stats = exact_percentiles(
        rows, "AvgTone", [0.25, 0.5, 0.75], ["EventRootLabel"], broadcast_groups=k <= BROADCAST_LIST_ROWS
    ).select(
        "EventRootLabel", "n", F.col("q0").alias("q1"), F.col("q1").alias("median"), F.col("q2").alias("q3")
    )
    iqr = F.col("q3") - F.col("q1")
    lo_fence = F.col("q1") - F.lit(1.5) * iqr
    hi_fence = F.col("q3") + F.lit(1.5) * iqr
    inside = (F.col("AvgTone") >= lo_fence) & (F.col("AvgTone") <= hi_fence)
    return (
        rows.join(broadcast_list(stats, k), "EventRootLabel")
        .groupBy("EventRootLabel", "n", "q1", "median", "q3")
        .agg(
            F.min(F.when(inside, F.col("AvgTone"))).alias("whisker_lo"),
            F.max(F.when(inside, F.col("AvgTone"))).alias("whisker_hi"),
            F.sum(F.when(inside, 0).otherwise(1)).cast("bigint").alias("n_outliers"),
        )
    )


def tone_outliers(clean: DataFrame, k: int = 12) -> DataFrame:
    """The box plot's fliers: rows of the top-k labels whose AvgTone is outside the 1.5 IQR fences.

    A distributed filter against the (at most k rows) quartile table; the
    number of fliers is not bounded, so they are returned as a DataFrame.
    """
    rows = _in_top_labels(clean, k).where(F.col("AvgTone").isNotNull() & ~F.isnan("AvgTone"))
    stats = exact_percentiles(
        rows, "AvgTone", [0.25, 0.75], ["EventRootLabel"], broadcast_groups=k <= BROADCAST_LIST_ROWS
    ).select("EventRootLabel", F.col("q0").alias("q1"), F.col("q1").alias("q3"))
    iqr = F.col("q3") - F.col("q1")
    outside = (F.col("AvgTone") < F.col("q1") - F.lit(1.5) * iqr) | (F.col("AvgTone") > F.col("q3") + F.lit(1.5) * iqr)
    return (
        rows.join(broadcast_list(stats, k), "EventRootLabel")
        .where(outside)
        .select("EventRootLabel", "date", "CountryCode", "EventRootCode", "AvgTone")
    )
