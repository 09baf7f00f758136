"""Exact percentiles (linear interpolation) without gathering a group in one task.

Spark's ``percentile`` merges every distinct value of a group in one task. Here
the distinct values of each group are counted (partial counts before the
shuffle), and each target rank is closed in by brackets: a bracket's values are
cut into ``CUTS`` ranges, the counts per range say which of them holds the rank,
and that range is the next bracket. When no bracket holds more than
``accuracy`` distinct values, a running sum over that many rows locates the
values at ranks ``floor(h)`` and ``ceil(h)``, ``h = p * (n - 1)``. All sizes of groups take
this way; the number of rounds grows with the logarithm of the distinct values.
The interpolation is Spark's: ``(ceil(h) - h) * x_lo + (h - floor(h)) * x_hi``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from newsrisk.session import materialize

CUTS = 64


def exact_percentiles(
    df: DataFrame,
    value: str,
    probs: list[float],
    group_cols=(),
    accuracy: int = 10000,
    broadcast_groups: bool = False,
) -> DataFrame:
    """One row per group: ``group_cols``, ``n`` and ``q0..q{k-1}`` (exact, linear); no rows for no values.

    ``accuracy`` is the number of distinct values a bracket is closed in to.
    ``broadcast_groups=True`` broadcasts the per-group targets; use it only when the
    number of groups is bounded (top-k labels).
    """
    g = list(group_cols) or ["_g"]
    rows = df.where(F.col(value).isNotNull() & ~F.isnan(value))
    rows = rows.select(*(group_cols or [F.lit(0).alias("_g")]), F.col(value).cast("double").alias("_v"))
    counts = materialize(rows.groupBy(*g, "_v").agg(F.count(F.lit(1)).alias("_c")))
    hint = F.broadcast if broadcast_groups or not group_cols else lambda x: x
    gk = [*g, "k"]

    goals = F.array(*[F.struct(F.lit(i).alias("k"), F.lit(float(p)).alias("p")) for i, p in enumerate(probs)])
    t = counts.groupBy(*g).agg(F.sum("_c").alias("n"), F.min("_v").alias("lo"), F.max("_v").alias("hi"))
    t = t.select(*g, "n", "lo", "hi", F.explode(goals).alias("t")).select(*g, "n", "lo", "hi", "t.k", "t.p")
    h = F.col("p") * (F.col("n") - 1)
    t = t.select(*gk, "n", "lo", "hi", h.alias("h"), F.floor(h).alias("r0"), F.ceil(h).alias("r1"), F.lit(0).cast("bigint").alias("below"))
    t = materialize(t)
    while True:
        inside = counts.join(hint(t), g).where((F.col("_v") >= F.col("lo")) & (F.col("_v") <= F.col("hi")))
        cuts = F.percentile_approx("_v", F.array(*[F.lit((i + 1) / CUTS) for i in range(CUTS - 1)]), 10000)
        sizes = materialize(inside.groupBy(*gk).agg(F.count(F.lit(1)).alias("m"), cuts.alias("cuts")))
        if (sizes.agg(F.max("m")).first()[0] or 0) <= accuracy:
            break
        at = F.size(F.filter("cuts", lambda c: c < F.col("_v")))
        ranges = inside.join(hint(sizes.select(*gk, "cuts")), gk).groupBy(*gk, "n", "h", "r0", "r1", "below", at.alias("at"))
        ranges = ranges.agg(F.sum("_c").alias("c"), F.min("_v").alias("first"), F.max("_v").alias("last"))
        # at most CUTS rows per target
        start = F.col("below") + F.sum("c").over(Window.partitionBy(*gk).orderBy("at")) - F.col("c")
        ranges = ranges.withColumn("start", start)
        holds = lambda r: (F.col("start") <= F.col(r)) & (F.col(r) < F.col("start") + F.col("c"))
        t = materialize(
            ranges.groupBy(*gk, "n", "h", "r0", "r1").agg(
                F.min(F.when(holds("r0"), F.col("first"))).alias("lo"),
                F.max(F.when(holds("r1"), F.col("last"))).alias("hi"),
                F.min(F.when(holds("r0"), F.col("start"))).alias("below"),
            )
        )
    # at most ``accuracy`` rows per target
    last = F.col("below") + F.sum("_c").over(Window.partitionBy(*gk).orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)) - 1
    located = inside.withColumn("last", last).groupBy(*gk, "n", "h", "r0", "r1").agg(
        F.min(F.when(F.col("last") >= F.col("r0"), F.col("_v"))).alias("x0"),
        F.min(F.when(F.col("last") >= F.col("r1"), F.col("_v"))).alias("x1"),
    )
    q = F.when(F.col("r0") == F.col("r1"), F.col("x0")).otherwise((F.col("r1") - F.col("h")) * F.col("x0") + (F.col("h") - F.col("r0")) * F.col("x1"))
    out = located.withColumn("q", q).groupBy(*g, "n").agg(*[F.max(F.when(F.col("k") == i, F.col("q"))).alias(f"q{i}") for i in range(len(probs))])
    return out if group_cols else out.drop("_g")
