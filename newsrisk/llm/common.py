"""What the operators of this subpackage share: written tables, checked broadcasts, components."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsrisk.session import checkpoint_dir

# A side is broadcast only when its counted rows times its widest row stay below this.
BROADCAST_MAX_BYTES = 32 << 20


def table_path(spark: SparkSession, name: str) -> str:
    """A new folder below the shared checkpoint folder (never a machine-local one on a cluster)."""
    return f"{checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex[:12]}"


def write_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    Cuts the lineage (a lost executor re-reads the files), prunes columns on the
    way back in, and gives joins a plain scan below each exchange, so that AQE
    can split a hot key.
    """
    spark = df.sparkSession
    path = table_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def checked_broadcast(df: DataFrame, row_bytes: int, max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """``broadcast(df)`` if its counted size is within ``max_bytes``; else ``df`` for a sort-merge join.

    ``df`` should be a written table (it is counted). Both ways give the same rows. The hint keeps Spark from
    broadcasting it after all by the smaller size of its compressed files.
    """
    return F.broadcast(df) if df.count() * row_bytes <= max_bytes else df.hint("merge")


def let(value: Column, body) -> Column:
    """``body`` of ``value``, computed once however often the body uses it (also inside lambdas)."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def documents_of(df: DataFrame, key: str, *columns: str) -> DataFrame:
    """The columns an operator works on; extra columns (clashing names included) stay out of its way."""
    return df.select(F.col(key).cast("long").alias(key), *(F.col(c) for c in columns))


def components(edges: DataFrame, u: str = "u", v: str = "v", max_rounds: int = 64) -> DataFrame:
    """Connected components of undirected ``edges`` by randomised contraction: (node, root).

    Each round every node hooks onto the neighbour (or itself) whose id hashes lowest under that
    round's seed, the edges are rewritten to the hooked nodes, and loops and repeats go. A
    constant share of the nodes goes per round whatever the graph's shape, so a chain needs
    O(log n) rounds. Rounds are written tables; nothing is gathered on the driver. A hub's edges
    meet in a map-side ``min``, and the rewriting joins read plain tables (skew-splittable).
    Nodes without an edge are not returned. ``root`` is some member of the component.
    """
    e = write_table(
        edges.select(F.col(u).alias("u"), F.col(v).alias("v")).where("u <> v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct(),
        "edges",
    )
    levels = []
    for i in range(max_rounds):
        if e.isEmpty():
            break
        h = lambda c: F.struct(F.xxhash64(F.col(c), F.lit(i)).alias("h"), F.col(c).alias("id"))  # noqa: B023, E731
        both = e.select("u", "v").unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        hook = both.groupBy("u").agg(F.min(h("v")).alias("m")).select(F.col("u").alias("node"), F.least(F.col("m"), h("u"))["id"].alias("up"))
        hook = write_table(hook, f"hook{i}")
        levels.append(hook)
        a = hook.select(F.col("node").alias("u"), F.col("up").alias("nu"))
        b = hook.select(F.col("node").alias("v"), F.col("up").alias("nv"))
        moved = e.join(a, "u").join(b, "v").where("nu <> nv").select(F.least("nu", "nv").alias("u"), F.greatest("nu", "nv").alias("v")).distinct()
        e = write_table(moved, f"edges{i}")
    else:
        raise RuntimeError(f"components: edges left after {max_rounds} rounds")
    if not levels:
        return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
    roots = levels[-1].select("node", F.col("up").alias("root"))
    for hook in reversed(levels[:-1]):
        roots = write_table(
            hook.join(roots.withColumnRenamed("node", "up"), "up", "left").select("node", F.coalesce("root", "up").alias("root")),
            "roots",
        )
    return roots
