"""Isolation forest (Liu, Ting & Zhou 2008) in DataFrame functions only.

Every draw is an MD5 of the seed, the tree and the node or the row's key, so the same forest grows in any
partitioning -- and in any SQL engine. Trees are binary; node 1 is the root and node ``i`` has the children
``2 i`` (value below the threshold) and ``2 i + 1``.
"""

from __future__ import annotations

import math
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsrisk.functions.draws import digest, uniform
from newsrisk.operators.ranking import global_row_number
from newsrisk.session import materialize

EULER_GAMMA = 0.5772156649015329
# Inputs are held to so many decimals, so that a node's range does not hang on the last bit of a sum.
DECIMALS = 9


def average_path_length(n: Column) -> Column:
    """c(n): mean path length of an unsuccessful search among n points."""
    n = n.cast("double")
    long = 2.0 * (F.log(n - 1.0) + EULER_GAMMA) - 2.0 * (n - 1.0) / n
    return F.when(n > 2, long).when(n == 2, F.lit(1.0)).otherwise(F.lit(0.0))


def tree_samples(df: DataFrame, cols: list[str], key_cols: list[str], trees: int, sample: int, seed: int, n: int) -> DataFrame:
    """(tree, x): ``min(sample, n)`` rows per tree, drawn without replacement.

    The ``trees * sample`` rows of least hash are the pool. It is put into a random order by another hash and dealt
    out in blocks of ``sample`` rows, a block per tree; a shorter pool is dealt again in as many other orders
    as it takes. The pool is found by a threshold on the hash with room to spare and distributed row numbers;
    an order is never longer than the pool, which depends on the forest's parameters alone.
    """
    keys = [F.col(c) for c in key_cols]
    pool = df.select(*key_cols, F.array(*[F.round(F.col(c).cast("double"), DECIMALS) for c in cols]).alias("x"))
    size = min(n, trees * sample)
    if n > size:
        share = min(1.0, (size + 8 * math.sqrt(size) + 100) / n)
        near = pool.where(uniform(seed, "pool", *keys) < share)
        ranked = global_row_number(near, [digest(seed, "pool", *keys), *keys], "_place")
        if share < 1.0 and ranked.count() < size:  # a chance below 1e-12, or keys that repeat
            ranked = global_row_number(pool, [digest(seed, "pool", *keys), *keys], "_place")
        pool = ranked.where(F.col("_place") <= size)
    per_order = max(1, size // sample)
    orders = -(-trees // per_order)
    dealt = pool.select("*", F.explode(F.sequence(F.lit(0), F.lit(orders - 1))).alias("_order"))
    place = F.row_number().over(Window.partitionBy("_order").orderBy(digest(seed, F.col("_order"), *keys), *keys)) - 1
    block = F.floor(place / F.lit(sample)).cast("int")
    dealt = dealt.withColumn("_block", block).where(F.col("_block") < per_order)
    return dealt.select((F.col("_order") * per_order + F.col("_block")).alias("tree"), "x").where(F.col("tree") < trees)


def grow(samples: DataFrame, features: int, max_depth: int, seed: int) -> DataFrame:
    """(tree, node, depth, size, feature, threshold): one pass per level for all trees; leaves have no feature.

    Each level reads every node's size and ranges off windows over (tree, node). All of them run on one
    exchange by tree, whose rows are bounded by the sample.
    """
    rows = samples.repartition("tree").withColumn("node", F.lit(1).cast("long"))
    levels = []
    for depth in range(max_depth + 1):
        w = Window.partitionBy("tree", "node")
        rows = rows.withColumn("size", F.count(F.lit(1)).over(w))
        if depth < max_depth:
            every = range(features)
            rows = rows.withColumns({f"{name}{f}": of(F.get("x", F.lit(f))).over(w) for f in every for name, of in (("lo", F.min), ("hi", F.max))})
            upto = list(accumulate((F.col(f"hi{f}") > F.col(f"lo{f}")).cast("int") for f in every))  # features with two values, up to each one
            rows = rows.withColumn("at", F.floor(uniform(seed, F.col("tree"), F.col("node"), "feature") * upto[-1]))
            rows = rows.withColumn("feature", F.coalesce(*[F.when(upto[f] > F.col("at"), F.lit(f)) for f in every]))  # null if none has
            lo, hi = (F.coalesce(*[F.when(F.col("feature") == f, F.col(f"{name}{f}")) for f in every]) for name in ("lo", "hi"))
            rows = rows.withColumn("threshold", lo + (hi - lo) * uniform(seed, F.col("tree"), F.col("node"), "threshold"))
        else:
            rows = rows.withColumns({"feature": F.lit(None).cast("int"), "threshold": F.lit(None).cast("double")})
        state = F.struct("node", F.lit(depth).alias("depth"), "size", "feature", "threshold")
        rows = rows.withColumn(f"level{depth}", state)
        levels.append(f"level{depth}")
        goes_right = (F.get("x", F.col("feature")) >= F.col("threshold")).cast("long")
        rows = rows.withColumn("node", F.when(F.col("feature").isNotNull(), F.col("node") * 2 + goes_right).otherwise(F.col("node")))
        rows = rows.select("tree", "x", "node", *levels)
    # a leaf's rows stay in it on the levels below: its first level counts
    nodes = rows.select("tree", F.explode(F.array(*levels)).alias("s")).select("tree", "s.*")
    return nodes.groupBy("tree", "node").agg(F.min("depth").alias("depth"), *(F.first(c).alias(c) for c in ("size", "feature", "threshold")))


def fit_isolation_forest(
    df: DataFrame, cols: list[str], key_cols: list[str], trees: int = 300, sample: int = 256, seed: int = 42, n: int | None = None,
) -> DataFrame:
    """The forest's node table, at most ``trees`` x 2 ``sample`` rows: (tree, node, depth, size, feature, threshold)."""
    n = df.count() if n is None else n
    max_depth = math.ceil(math.log2(max(min(sample, n), 2)))
    return materialize(grow(tree_samples(df, cols, key_cols, trees, sample, seed, n), len(cols), max_depth, seed))


def mean_path_lengths(df: DataFrame, forest: DataFrame, cols: list[str], row: str, trees: int, max_depth: int) -> DataFrame:
    """(row, path): the mean path length of each row over all trees.

    Every (row, tree) walks down by one broadcast join per level with that level's splits, then with the
    leaves; the node table is bounded by the forest's parameters. Only one partial sum per row and task is shuffled.
    """
    x = F.array(*[F.round(F.col(c).cast("double"), DECIMALS) for c in cols])
    walk = df.select(row, x.alias("x"), F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree")).withColumn("node", F.lit(1).cast("long"))
    for depth in range(max_depth):
        splits = forest.where((F.col("depth") == depth) & F.col("feature").isNotNull()).select("tree", "node", "feature", "threshold")
        goes_right = (F.get("x", F.col("feature")) >= F.col("threshold")).cast("long")
        down = F.when(F.col("feature").isNotNull(), F.col("node") * 2 + goes_right).otherwise(F.col("node"))
        walk = walk.join(F.broadcast(splits), ["tree", "node"], "left").select(row, "x", "tree", down.alias("node"))
    lengths = forest.select("tree", "node", (F.col("depth") + average_path_length(F.col("size"))).alias("length"))
    depth = F.floor(F.log2(F.col("node").cast("double")) + 1e-9).cast("double")  # of a child no sampled row went to
    ended = walk.join(F.broadcast(lengths), ["tree", "node"], "left").select(row, F.coalesce("length", depth).alias("length"))
    return ended.groupBy(row).agg((F.sum("length") / trees).alias("path"))


def raw_scores(
    df: DataFrame, cols: list[str], key_cols: list[str], trees: int = 300, sample: int = 256, seed: int = 42, name: str = "_s",
) -> DataFrame:
    """``df`` with ``name`` = -2 ** -(mean path length / c(sample)), lower = more isolated; written once."""
    df = materialize(df.withColumn("_row", F.monotonically_increasing_id()))
    n = df.count()
    psi = min(sample, n)
    forest = fit_isolation_forest(df, cols, key_cols, trees, sample, seed, n)
    paths = mean_path_lengths(df, forest, cols, "_row", trees, math.ceil(math.log2(max(psi, 2))))
    score = -F.pow(F.lit(2.0), -F.col("path") / average_path_length(F.lit(max(psi, 2))))
    return materialize(df.join(paths, "_row").withColumn(name, score).drop("_row", "path"))
