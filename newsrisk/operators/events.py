"""Daily extract: raw events -> (SQLDATE, CountryCode, EventRootCode) aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsrisk.sources.readers import DateLike, scan_window


SPLIT_SCALE = 1048576.0  # 2**20


def split_parts(c: str):
    """Split x into ``hi / 2**20 + lo``: ``hi`` an exact integer (decimal), ``lo`` the remainder.

    What no 28-digit integer holds (NaN, infinities, values from about 1e22) is all remainder.
    """
    x = F.col(c).cast("double")
    hi = (x * F.lit(SPLIT_SCALE)).try_cast("decimal(28,0)")
    lo = x - F.coalesce(hi.cast("double"), F.lit(0.0)) / F.lit(SPLIT_SCALE)
    return hi, lo


def stable_avg(c: str):
    """Mean of the non-null values whose result does not depend on summation order.

    A plain double sum depends on the order Spark merges partial aggregates,
    so a mean exactly on a threshold (a tone of -2.0) could land one ulp either
    side between runs or retries. Here the multiples of 2**-20 are summed as
    exact 38-digit integers and only the small remainders as doubles, so the
    order-dependent error is far below one ulp of the mean, and no partition of
    large values can overflow the sum.
    """
    hi, lo = split_parts(c)
    total = F.coalesce(F.sum(hi).cast("double"), F.lit(0.0)) / F.lit(SPLIT_SCALE) + F.sum(lo)
    return F.try_divide(total, F.count(c).cast("double"))


def extract_events_daily(raw: DataFrame, start: DateLike = None, end: DateLike = None, ordered: bool = True) -> DataFrame:
    """Partition-pruned daily aggregate of raw events.

    The window filter prunes ``dt`` partitions; the group key is the event's own
    ``SQLDATE`` (a different column, kept separate on purpose). Partial hash
    aggregation runs before the shuffle, so a hot country costs one row per
    task per key, not one row per event. Averages are order-stable
    (see ``stable_avg``): reruns and retries give the same bits.
    """
    w = scan_window(raw, start, end).where(F.col("ActionGeo_CountryCode").isNotNull())
    out = w.groupBy(
        F.col("SQLDATE"),
        F.col("ActionGeo_CountryCode").alias("CountryCode"),
        F.col("EventRootCode"),
    ).agg(
        F.count(F.lit(1)).alias("EventCount"),
        stable_avg("AvgTone").alias("AvgTone"),
        stable_avg("GoldsteinScale").alias("AvgGoldstein"),
        F.sum("NumMentions").cast("bigint").alias("TotalMentions"),
        F.sum("NumArticles").cast("bigint").alias("TotalArticles"),
        F.sum("NumSources").cast("bigint").alias("TotalSources"),
    )
    return out.orderBy("SQLDATE", "CountryCode", "EventRootCode") if ordered else out
