"""Repeatable random draws: MD5 of a seed and a key, the same in any engine, partitioning and retry."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def digest(*parts) -> Column:
    """32 hex digits of the parts, joined by colons (a null part counts as empty)."""
    text = [F.coalesce(p.cast("string"), F.lit("")) if isinstance(p, Column) else F.lit(str(p)) for p in parts]
    return F.md5(F.concat_ws(":", *text))


def uniform(*parts) -> Column:
    """A double in (0, 1): the middle of one of 2^32 equal steps."""
    return (F.conv(F.substring(digest(*parts), 1, 8), 16, 10).cast("double") + 0.5) / 4294967296.0


# Poisson(1): the probability of at most k, for k = 0 to 12 (the rest is below 2^-32).
POISSON_CDF = (
    0.36787944117144233, 0.7357588823428847, 0.9196986029286058, 0.9810118431238462, 0.9963401531726563,
    0.9994058151824183, 0.9999167588507119, 0.9999897508033253, 0.9999988747974022, 0.9999998885745217,
    0.9999999899522336, 0.9999999991683892, 0.9999999999363864,
)


def poisson(*parts) -> Column:
    """How often a row is drawn into a bootstrap sample: Poisson(1), as in online bagging (Oza and Russell, 2001)."""
    u = uniform(*parts)
    # a get over an array computes u once
    return F.get(F.transform(F.array(u), lambda x: sum((x >= c).cast("int") for c in POISSON_CDF)), F.lit(0))
