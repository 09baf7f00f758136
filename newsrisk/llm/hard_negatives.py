"""Hard-negative mining by bounds along spanning trees of the anchors.

A row's score for an anchor is the inner product of their integer vectors, floor(256 x). Anchors are the rows whose
id is divisible by ``EVERY``; an anchor's positives are its ``POSITIVES`` best rows of the same label, and each
positive's negatives are the ``NEGATIVES`` best rows of another label whose score lies between
``SHARE`` % of the positive's score and that score.

1. Trees. Anchors are put in order of label and of a Hilbert curve, and cut into groups of at most ``GROUP``; in
   each group a minimum spanning tree of the Euclidean distances is grown.
2. Bounds. Anchor groups meet blocks of about ``BLOCK`` candidates. The root's scores are computed; for a child,
   a candidate's score lies within (length of the edge) x (norm of the candidate) of its score, or of its bounds, at the parent.
   Only candidates whose bounds overlap the window are scored again, and so replace their bounds for the anchors further down.
3. Windows. For positives: from the fifth-best lower bound of the block up, among the same label (groups and blocks
   of one label meet). For negatives: the windows of the anchor's positives, from the fifth-best
   lower bound of those surely inside, among the other labels. There the candidates' blocks follow the Hilbert curve
   too, and a group meets a block only if the score of their centres, plus or minus their radii, overlaps the
   group's windows: other pairs are not even brought together.
4. Each block keeps the best few per anchor (and positive); Spark merges them by a window. Both results are exact.

The stated anchors go against all rows in blocks: a group or a block is bounded whatever the data, a hot label is many of
both. Bounds save scoring where vectors lie close together; for vectors without any clusters nearly everything is scored.

Defined cases: rows with a null id or label, a null vector, a null or non-finite component, or a vector of another length than
most take no part; an anchor id that repeats asks once (smallest label, then vector) and no row of its id is a
candidate of it; other repeated rows are candidates each; components beyond +-``REACH`` count as that (scores stay
exact); a positive without negatives gives no row; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsrisk.llm.common import checked_broadcast, write_table
from newsrisk.llm.hilbert import grid, hilbert_keys
from newsrisk.operators.ranking import global_row_number

#: The scale of the integers, the anchors' step, the counts, and the window's lower end in percent.
SCALE = 256
EVERY = 100
POSITIVES = 5
NEGATIVES = 5
SHARE = 80
REACH = 4096.0
SEED = 13
GROUP = 2048
BLOCK = 1024
#: The most that the middles of all anchor groups may take in a task.
MIDDLES_BYTES = 32 << 20


def integers(vectors: DataFrame) -> DataFrame:
    """(rid, vec_id, label, q), written: the rows that take part, with integer components and their final labels."""
    v = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), F.col("embedding").cast("array<double>").alias("x"))
    inf = float("inf")
    v = v.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("x").isNotNull() & F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(inf))))
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    reach = lambda c: F.least(F.greatest(c, F.lit(-REACH)), F.lit(REACH))
    v = v.select("vec_id", label.alias("label"), F.transform("x", lambda c: F.floor(reach(c) * SCALE).cast("int")).alias("q")).where(F.size("q") > 0)
    v = write_table(v, "integers")
    most = v.groupBy(F.size("q").alias("d")).count().orderBy(F.desc("count"), "d").first()
    return write_table(v.where(F.size("q") == (most["d"] if most else 0)).withColumn("rid", F.monotonically_increasing_id()), "candidates")


def matrix(column) -> np.ndarray:
    """Rows of an Arrow list column of equal lengths, as doubles (which hold their integers exactly)."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1).astype(float) if len(column) else np.zeros((0, 0))


def on_the_curve(rows: DataFrame) -> DataFrame:
    """``rows`` with ``key``, the place along a Hilbert curve of ``q``, brought to unit length and projected to eight axes by fixed random signs."""
    at = rows.columns.index("q")

    def run(batches):
        for b in batches:
            x = matrix(b.column(at))
            if not len(x):
                continue
            signs = np.random.default_rng(SEED).choice([-1.0, 1.0], (x.shape[1], 8))
            y = x @ signs / np.maximum(np.sqrt((x**2).sum(axis=1)), 1.0)[:, None]  # about normal
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(hilbert_keys(*grid(y * 1024, 3 * 1024.0)))], names=[*b.schema.names, "key"])

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField("key", T.LongType())]))


def anchors_of(rows: DataFrame, every: int = EVERY, group: int = GROUP) -> DataFrame:
    """(anchor_id, label, q, chunk, grp), written: chunk numbers an anchor's group within its label, grp over all labels."""
    a = rows.where(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min(F.struct("label", "q")).alias("a")).select(F.col("vec_id").alias("anchor_id"), "a.label", "a.q")
    ranked = write_table(global_row_number(on_the_curve(a), ["label", "key", "anchor_id"], "rank"), "ranked_anchors")
    first = checked_broadcast(write_table(ranked.groupBy("label").agg(F.min("rank").alias("first")), "first_ranks"), 32)
    place = lambda since: F.floor((F.col("rank") - since) / group).cast("int")
    return write_table(ranked.join(first, "label").select("anchor_id", "label", "q", place(F.col("first")).alias("chunk"), place(F.lit(1)).alias("grp")), "anchors")


def spanning_tree(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A minimum spanning tree grown from row 0: the rows in order of their joining, the place of each one's parent, and the edges."""
    n = len(x)
    order, parent, edge = np.zeros(n, np.int64), np.full(n, -1), np.zeros(n)
    near, via, open_ = np.full(n, np.inf), np.full(n, -1), np.ones(n, bool)
    at = 0
    for step in range(n):
        if step:
            at = int(np.argmin(np.where(open_, near, np.inf)))
            parent[step], edge[step] = via[at], np.sqrt(near[at])
        order[step] = at
        open_[at] = False
        d = ((x - x[at]) ** 2).sum(axis=1)
        closer = d < near
        near[closer], via[closer] = d[closer], step
    return order, parent, edge


def spanned(anchors: DataFrame, keys: list[str]) -> DataFrame:
    """The anchors with their ``step``, their parent's step and the ``edge`` to it, per group; written."""

    def run(t: pa.Table) -> pa.Table:
        t = t.combine_chunks().sort_by("anchor_id")
        order, parent, edge = spanning_tree(matrix(t["q"]))
        t = t.take(pa.array(order))
        for name, values in (("step", np.arange(len(order))), ("parent", parent), ("edge", edge)):
            t = t.append_column(name, pa.array(values))
        return t

    schema = "anchor_id long, label long, q array<int>, chunk int, grp int, step long, parent long, edge double"
    return write_table(anchors.groupBy(*keys).applyInArrow(run, schema), "trees")


def walk(x: np.ndarray, anchors: np.ndarray, parent: np.ndarray, edge: np.ndarray, wanted):
    """(anchor's place, candidates' places, their scores) along the tree; ``wanted(i, lo, hi)`` says whose bounds overlap.

    Doubles hold all scores exactly; the bounds are widened by more than their rounding.
    """
    norm = np.sqrt((x**2).sum(axis=1))
    lo, hi = np.empty((len(anchors), len(x))), np.empty((len(anchors), len(x)))
    for i, a in enumerate(anchors):
        if parent[i] < 0:
            lo[i] = hi[i] = x @ a
            at = np.nonzero(wanted(i, lo[i], hi[i]))[0]
        else:
            slack = edge[i] * norm * (1 + 1e-9) + 1e-6
            lo[i], hi[i] = lo[parent[i]] - slack, hi[parent[i]] + slack
            at = np.nonzero(wanted(i, lo[i], hi[i]))[0]
            if 2 * len(at) > len(x):
                lo[i] = hi[i] = x @ a
            elif len(at):
                lo[i, at] = hi[i, at] = x[at] @ a
        yield i, at, np.rint(lo[i, at]).astype(np.int64)


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    return np.lexsort((ids, -scores))[:k]


def kth_best(lo: np.ndarray, k: int) -> float:
    return np.partition(lo, len(lo) - k)[len(lo) - k] if len(lo) >= k else -np.inf


def tree_of(t: pa.Table):
    t = t.combine_chunks().sort_by("step")
    return t, matrix(t["q"]), t["parent"].to_numpy(), t["edge"].to_numpy(), t["anchor_id"].to_numpy(), t["label"].to_numpy()


def table(schema: str, rows: list) -> pa.Table:
    names = schema.replace(" long", "").split(", ")
    columns = [np.concatenate(c) for c in zip(*rows)] if rows else [np.zeros(0, np.int64)] * len(names)
    return pa.Table.from_arrays([pa.array(c.astype(np.int64)) for c in columns], names=names)


POSITIVE = "anchor_id long, positive_id long, positive_score long"
NEGATIVE = "anchor_id long, place long, positive_id long, positive_score long, negative_id long, negative_score long"


def positives(candidates: DataFrame, trees: DataFrame, block: int = BLOCK, k: int = POSITIVES) -> DataFrame:
    """(anchor_id, positive_id, positive_score, place), written: each anchor's ``k`` best rows of its label."""

    def run(c: pa.Table, a: pa.Table) -> pa.Table:
        out = []
        if len(c) and len(a):
            x, ids = matrix(c["q"]), c["vec_id"].to_numpy()
            _, y, parent, edge, own, _ = tree_of(a)

            def wanted(i, lo, hi):
                other = ids != own[i]
                return other & (hi >= kth_best(lo[other], k))

            for i, at, score in walk(x, y, parent, edge, wanted):
                top = best(score, ids[at], k)
                out.append((np.full(len(top), own[i]), ids[at][top], score[top]))
        return table(POSITIVE, out)

    # groups and blocks of one label
    sizes = candidates.groupBy("label").agg(F.ceil(F.count("*") / block).alias("blocks"))
    labels = write_table(trees.groupBy("label").agg((F.max("chunk") + 1).alias("chunks")).join(sizes, "label"), "labels")
    labels = checked_broadcast(labels, 48)
    c = candidates.join(labels, "label").withColumn("block", F.pmod(F.xxhash64("rid"), F.col("blocks")))
    c = c.select("vec_id", "q", "label", "block", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"))
    a = trees.join(labels, "label").select("anchor_id", "label", "q", "step", "parent", "edge", "chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"))
    key = ["label", "chunk", "block"]
    found = c.groupBy(*key).cogroup(a.groupBy(*key)).applyInArrow(run, POSITIVE)
    place = F.row_number().over(Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id"))
    return write_table(found.withColumn("place", place).where(F.col("place") <= k), "positives")


def ball(x: np.ndarray) -> tuple[np.ndarray, float]:
    """The middle of rows, and the distance of the farthest row from it."""
    middle = x.mean(axis=0)
    return middle, float(np.sqrt(((x - middle) ** 2).sum(axis=1)).max())


def overlapping(blocks: DataFrame, anchors: DataFrame, share: int = SHARE) -> DataFrame:
    """(block, grp), written: the pairs of a candidate block and an anchor group whose scores may lie in one of the group's windows.

    With a = r + d and c = m + e, the score <a, c> differs from <r, m> by at most |r||e| + |d||m| + |d||e|. Groups' middles
    go to the tasks if they are less than ``MIDDLES_BYTES``; else every block meets every group.
    """
    balls = "middle array<double>, radius double"

    def of_blocks(t: pa.Table) -> pa.Table:
        middle, radius = ball(matrix(t["q"]))
        return pa.table({"block": t["block"][:1], "middle": pa.array([middle]), "radius": pa.array([radius])})

    def of_groups(t: pa.Table) -> pa.Table:
        middle, radius = ball(matrix(t["q"]))
        scores = [w["positive_score"] for ws in t["windows"].to_pylist() for w in ws if w["positive_score"] >= 0]  # no window below zero
        low, high = (share * min(scores) / 100, float(max(scores))) if scores else (np.inf, -np.inf)
        return pa.table({"grp": t["grp"][:1], "middle": pa.array([middle]), "radius": pa.array([radius]), "low": pa.array([low]), "high": pa.array([high])})

    groups = write_table(anchors.select("grp", "q", "windows").groupBy("grp").applyInArrow(of_groups, f"grp int, {balls}, low double, high double"), "group_balls").where("low <= high")
    middles = blocks.select("block", "q").groupBy("block").applyInArrow(of_blocks, f"block long, {balls}")
    n, width = groups.agg(F.count("*"), F.max(F.size("middle"))).first()
    if not n:
        return write_table(middles.select("block", F.lit(0).alias("grp")).limit(0), "met")
    if n * width * 8 > MIDDLES_BYTES:
        numbers = F.sequence(F.lit(0), F.lit(groups.agg(F.max("grp")).first()[0]))
        return write_table(blocks.select("block").distinct().select("block", F.explode(numbers).alias("grp")), "met")
    held = [(r["grp"], r["radius"], r["low"], r["high"], r["middle"]) for r in groups.collect()]
    number, radius, low, high = (np.array([h[i] for h in held]) for i in range(4))
    centre = np.array([h[4] for h in held])
    length = np.sqrt((centre**2).sum(axis=1))

    def meet(batches):
        for b in batches:
            block, grp = [], []
            for i, m, r in zip(b["block"].to_pylist(), b["middle"].to_pylist(), b["radius"].to_pylist()):
                m = np.array(m)
                slack = (length * r + radius * np.sqrt((m**2).sum()) + radius * r) * (1 + 1e-9) + 1e-6
                score = centre @ m
                own = number[(score + slack >= low) & (score - slack <= high)]
                block.append(np.full(len(own), i, np.int64))
                grp.append(own.astype(np.int32))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c) if c else [], k) for c, k in ((block, pa.int64()), (grp, pa.int32()))], names=["block", "grp"])

    return write_table(middles.mapInArrow(meet, "block long, grp int"), "met")


def negatives(candidates: DataFrame, trees: DataFrame, windows: DataFrame, block: int = BLOCK, k: int = NEGATIVES, share: int = SHARE) -> DataFrame:
    """``NEGATIVE`` and ``rank``: the ``k`` best rows of another label within each positive's window."""

    def run(c: pa.Table, a: pa.Table) -> pa.Table:
        out = []
        if len(c) and len(a):
            x, ids, labels = matrix(c["q"]), c["vec_id"].to_numpy(), c["label"].to_numpy()
            t, y, parent, edge, own, label = tree_of(a)
            windows = [sorted((w["place"], w["positive_id"], w["positive_score"]) for w in ws) for ws in t["windows"].to_pylist()]

            def wanted(i, lo, hi):
                need = np.zeros(len(x), bool)
                other = (labels != label[i]) & (ids != own[i])
                for _, _, p in windows[i]:
                    inside = other & (100 * lo >= share * p) & (hi <= p)
                    need |= other & (100 * hi >= share * p) & (lo <= p) & (hi >= kth_best(lo[inside], k))
                return need

            for i, at, score in walk(x, y, parent, edge, wanted):
                for place, positive, p in windows[i]:
                    inside = at[(share * p <= 100 * score) & (score <= p)]
                    s = score[(share * p <= 100 * score) & (score <= p)]
                    top = best(s, ids[inside], k)
                    same = lambda v: np.full(len(top), v)  # noqa: B023, E731
                    out.append((same(own[i]), same(place), same(positive), same(p), ids[inside][top], s[top]))
        return table(NEGATIVE, out)

    asked = windows.groupBy("anchor_id").agg(F.collect_list(F.struct("place", "positive_id", "positive_score")).alias("windows"))  # a few per anchor
    a = trees.join(asked, "anchor_id", "left").withColumn("windows", F.coalesce("windows", F.expr("array()")))
    a = write_table(a.select("anchor_id", "label", "q", "step", "parent", "edge", "windows", "grp"), "asking_anchors")
    c = global_row_number(on_the_curve(candidates.select("vec_id", "q", "label", "rid")), ["key", "rid"], "n")
    c = write_table(c.select("vec_id", "q", "label", F.floor((F.col("n") - 1) / block).alias("block")), "blocks_on_the_curve")
    met = overlapping(c, a, share)
    c, a = c.join(checked_broadcast(met, 24), "block"), a.join(checked_broadcast(met, 24), "grp")
    key = ["grp", "block"]
    found = c.groupBy(*key).cogroup(a.groupBy(*key)).applyInArrow(run, NEGATIVE)
    rank = F.row_number().over(Window.partitionBy("anchor_id", "place").orderBy(F.desc("negative_score"), "negative_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k)


def mine(vectors: DataFrame, every: int = EVERY, group: int = GROUP, block: int = BLOCK) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) over the whole table."""
    rows = integers(vectors)
    anchors = anchors_of(rows, every, group)
    if anchors.isEmpty():
        nothing = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
        return rows.sparkSession.createDataFrame([], nothing)
    found = positives(rows, spanned(anchors, ["label", "chunk"]), block)
    out = negatives(rows, spanned(anchors, ["grp"]), found, block)
    return out.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")
