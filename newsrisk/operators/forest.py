"""Regression forests with exact splits, fully grown, as Spark jobs.

Every node takes the split that leaves the least squared error, over all midpoints of all features,
until its targets are alike or its rows cannot be told apart: the published model's settings.

* Bootstrap: how often a row is in a tree is a Poisson(1) draw from an MD5 of seed, model, tree and the row's key.
* Exact and repeatable: targets are held to a millionth and summed as integers, so that a split does not
  depend on the order of a sum; ties go to the first feature, then to the lowest threshold.
* Several models (the folds of a cross-validation) are grown in the same passes: ``model`` is a key of all tables.
* Growing follows PLANET (Panda et al., 2009). Nodes of more than ``task_rows`` rows are split level by level for all
  trees at once: counts per value, running sums over ranges of values (no node is gathered in one task),
  the best split per node by an aggregate. A node that fits is finished in one task
  (``task_rows`` rows at most), by one array pass per level; models that fit from the start are grown ``batch`` trees to a task.

A grown forest is two tables: ``upper`` (model, tree, node, feature, threshold, left, right; empty unless a
model is larger than ``task_rows``) and ``pieces``, one row per finished subtree with its nodes in arrays.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsrisk.functions.draws import poisson
from newsrisk.operators.ranking import global_row_number, global_running_sums
from newsrisk.session import materialize

#: Targets are held to 1 / TARGET_SCALE, features to so many decimals.
TARGET_SCALE = 1_000_000
DECIMALS = 9
#: Rows that one task may hold to finish a node, and trees grown together by one task.
TASK_ROWS = 20_000
BATCH = 25
#: Rows that one task scores at a time.
SCORE_ROWS = 20_000

PIECE = "model int, tree int, piece long, feature array<int>, threshold array<double>, left array<int>, value array<double>, weight array<long>"


# ---- one task: subtrees of rows that fit -----------------------------------------------


def best_splits(x, rank, orders, slot, w, wy, nodes):
    """Of each node the feature, the last rank and the threshold of its best split (feature -1: none).

    ``orders[f]`` lists the entries by (slot, rank of feature f); ``slot`` is an entry's node, 0 to ``nodes`` - 1.
    """
    row, entry = rank["row"], orders[0]
    count = np.bincount(slot[entry], minlength=nodes)
    start = np.concatenate(([0], np.cumsum(count)[:-1]))
    total_w, total_s = np.add.reduceat(w[entry], start), np.add.reduceat(wy[entry], start)
    score = np.full(nodes, -np.inf)
    feature, cut, threshold = np.full(nodes, -1), np.zeros(nodes, np.int64), np.zeros(nodes)
    for f, o in enumerate(orders):
        s, v = slot[o], rank["of"][row[o], f]
        cw, cs = np.cumsum(w[o]), np.cumsum(wy[o])
        left_w = cw - (cw[start] - w[o][start])[s]
        left_s = cs - (cs[start] - wy[o][start])[s]
        right_w, right_s = total_w[s] - left_w, total_s[s] - left_s
        ends = np.append((s[1:] == s[:-1]) & (v[1:] != v[:-1]), False)  # the last entry of a value, another value after it
        at = np.nonzero(ends)[0]
        if not len(at):
            continue
        got = left_s[at].astype(float) ** 2 / left_w[at] + right_s[at].astype(float) ** 2 / right_w[at]
        first = np.lexsort((at, -got, s[at]))  # per node the best, the lowest threshold on a tie
        first = first[np.append(True, s[at][first][1:] != s[at][first][:-1])]
        node, pos = s[at][first], at[first]
        better = got[first] > score[node]
        node, pos = node[better], pos[better]
        score[node], feature[node], cut[node] = got[first][better], f, v[pos]
        low, high = x[row[o[pos]], f], x[row[o[pos + 1]], f]
        middle = low + (high - low) / 2
        threshold[node] = np.where(middle < high, middle, low)
    return feature, cut, threshold


def grow_trees(x: np.ndarray, y: np.ndarray, times: np.ndarray, max_depth: int | None = None) -> list[dict]:
    """One tree per column of ``times`` (how often each row is in it), as arrays over its nodes, the root first.

    x: rows x features; y: integer targets. All trees advance one level per pass. Right children follow left ones.
    """
    trees = times.shape[1]
    ranks = np.stack([np.unique(x[:, f], return_inverse=True)[1].ravel() for f in range(x.shape[1])], axis=1)
    row, tree = np.nonzero(times)
    w = times[row, tree].astype(np.int64)
    wy = w * y[row]
    rank = {"row": row, "of": ranks}
    orders = [np.lexsort((ranks[row, f], tree)) for f in range(x.shape[1])]
    present, slot = np.unique(tree, return_inverse=True)
    slot = slot.ravel()
    parts = {k: [] for k in ("tree", "feature", "threshold", "left", "sum", "weight")}
    owner, made, depth = present, len(present), 0
    while len(owner):
        nodes, o = len(owner), orders[0]
        start = np.searchsorted(slot[o], np.arange(nodes))
        low, high = np.minimum.reduceat(y[row[o]], start), np.maximum.reduceat(y[row[o]], start)
        weight, sums = np.add.reduceat(w[o], start), np.add.reduceat(wy[o], start)
        feature, cut, threshold = best_splits(x, rank, orders, slot, w, wy, nodes)
        stop = (low == high) | (feature < 0) | (max_depth is not None and depth >= max_depth)
        feature[stop] = -1
        split = np.nonzero(~stop)[0]
        left = np.full(nodes, -1)
        left[split] = made + 2 * np.arange(len(split))
        for k, v in (("tree", owner), ("feature", feature), ("threshold", np.where(stop, 0.0, threshold)), ("left", left), ("sum", sums), ("weight", weight)):
            parts[k].append(v)
        made += 2 * len(split)
        owner = np.repeat(owner[split], 2)
        child = np.full(nodes, -1)
        child[split] = 2 * np.arange(len(split))  # slots of the next level
        goes = ~stop[slot]
        goes_right = ranks[row, np.maximum(feature[slot], 0)] > cut[slot]
        slot = np.where(goes, child[slot] + goes_right, -1)
        kind = np.uint16 if 2 * len(split) < 1 << 16 else np.int64  # numpy sorts short keys in linear time
        orders = [o[np.argsort(slot[o].astype(kind), kind="stable")] for o in (o[slot[o] >= 0] for o in orders)]
        depth += 1
    if not made:
        return [{} for _ in range(trees)]
    flat = {k: np.concatenate(v) for k, v in parts.items()}
    by_tree = np.argsort(flat["tree"], kind="stable")
    at = np.empty(made, np.int64)  # a node's place in its tree
    size = np.bincount(flat["tree"], minlength=trees)
    at[by_tree] = np.arange(made) - np.repeat(np.cumsum(size) - size, size)
    out = []
    for own in np.split(by_tree, np.cumsum(size)[:-1]):
        left = flat["left"][own]
        out.append({"feature": flat["feature"][own], "threshold": flat["threshold"][own], "left": np.where(left >= 0, at[left], -1),
                    "value": flat["sum"][own] / flat["weight"][own] / TARGET_SCALE, "weight": flat["weight"][own]} if len(own) else {})
    return out


def walk_tree(tree: dict, x: np.ndarray) -> np.ndarray:
    """The value of the leaf that each row comes to."""
    feature, threshold, left = (np.asarray(tree[k]) for k in ("feature", "threshold", "left"))
    at = np.zeros(len(x), np.int64)
    open_ = np.arange(len(x)) if feature[0] >= 0 else np.arange(0)
    while len(open_):
        node = at[open_]
        at[open_] = left[node] + (x[open_, feature[node]] > threshold[node])
        open_ = open_[feature[at[open_]] >= 0]
    return np.asarray(tree["value"])[at]


def rows_matrix(column) -> np.ndarray:
    column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def piece_table(rows: list[tuple]) -> pa.Table:
    kinds = pa.schema([("model", pa.int32()), ("tree", pa.int32()), ("piece", pa.int64()), ("feature", pa.list_(pa.int32())), ("threshold", pa.list_(pa.float64())),
                       ("left", pa.list_(pa.int32())), ("value", pa.list_(pa.float64())), ("weight", pa.list_(pa.int64()))])
    return pa.table({f.name: pa.array([r[i] for r in rows], f.type) for i, f in enumerate(kinds)}, schema=kinds)


# ---- Spark ---------------------------------------------------------------------------


@dataclass
class Forest:
    """A grown forest: its tables, its features' names, its number of trees, and how many trees a task scores."""

    upper: DataFrame | None
    pieces: DataFrame
    features: list[str]
    trees: int
    batch: int

    def nodes(self) -> DataFrame:
        """(model, tree, piece, node, feature, threshold, left, right, value, weight): every node of every piece; leaves have no feature."""
        arrays = F.arrays_zip("feature", "threshold", "left", "value", "weight")
        n = self.pieces.select("model", "tree", "piece", F.posexplode(arrays).alias("node", "n")).select("model", "tree", "piece", "node", "n.*")
        inner = F.col("feature") >= 0
        return n.select("model", "tree", "piece", "node", F.when(inner, F.col("feature")).alias("feature"), F.when(inner, F.col("threshold")).alias("threshold"),
                        F.when(inner, F.col("left")).alias("left"), F.when(inner, F.col("left") + 1).alias("right"), "value", "weight")

    def predict(self, rows: DataFrame, name: str = "prediction") -> DataFrame:
        """``rows`` with the mean of the trees' values (of the row's ``model``, or 0 if it has none)."""
        model = F.col("model").cast("int") if "model" in rows.columns else F.lit(0)
        rows = materialize(rows.withColumn("_row", F.monotonically_increasing_id()))
        asked = rows.select("_row", model.alias("model"), feature_array(self.features).alias("x"))
        groups = -(-self.trees // self.batch)
        asked = asked.select("*", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group")).withColumn("piece", F.lit(0).cast("long"))
        asked = self._to_pieces(asked)
        blocks = max(1, -(-rows.count() // SCORE_ROWS))
        asked = asked.withColumn("block", F.pmod(F.xxhash64("_row"), F.lit(blocks)))
        pieces = self.pieces.withColumn("group", F.floor(F.col("tree") / self.batch).cast("int"))
        pieces = pieces.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))

        def score(a: pa.Table, p: pa.Table) -> pa.Table:
            if not len(a) or not len(p):
                return pa.table({"_row": pa.array([], pa.int64()), "total": pa.array([], pa.float64()), "n": pa.array([], pa.int64())})
            x = rows_matrix(a["x"])
            total = np.zeros(len(x))
            for tree in p.select(["tree", "feature", "threshold", "left", "value"]).sort_by("tree").to_batches():
                for i in range(len(tree)):
                    total += walk_tree({k: tree[k][i].values.to_numpy(zero_copy_only=False) for k in ("feature", "threshold", "left", "value")}, x)
            return pa.table({"_row": a["_row"], "total": pa.array(total), "n": pa.array(np.full(len(x), len(p)))})

        key = ["model", "group", "piece", "block"]
        found = asked.groupBy(*key).cogroup(pieces.groupBy(*key)).applyInArrow(score, "_row long, total double, n long")
        mean = found.groupBy("_row").agg((F.sum("total") / F.sum("n")).alias(name))
        return rows.join(mean, "_row", "left").drop("_row")

    def _to_pieces(self, asked: DataFrame) -> DataFrame:
        """Walk down the levels that were split over the cluster, one join per level (``group`` is the tree then)."""
        if self.upper is None:
            return asked
        splits = self.upper.select("model", F.col("tree").alias("group"), F.col("node").alias("piece"), "feature", "threshold", "left", "right")
        deepest = self.upper.agg(F.max("depth")).first()[0]
        for _ in range(0 if deepest is None else deepest + 1):
            goes_left = F.get("x", F.col("feature")) <= F.col("threshold")
            down = F.when(F.col("feature").isNull(), F.col("piece")).when(goes_left, F.col("left")).otherwise(F.col("right"))
            asked = asked.join(splits, ["model", "group", "piece"], "left").select("_row", "model", "x", "group", down.alias("piece"))
        return asked

    def save(self, path: str) -> None:
        """Write the stored model: its two tables, and its settings in one row."""
        spark = self.pieces.sparkSession
        self.pieces.write.mode("overwrite").parquet(f"{path}/pieces")
        if self.upper is not None:
            self.upper.write.mode("overwrite").parquet(f"{path}/upper")
        about = [(self.features, self.trees, self.batch, self.upper is not None)]
        spark.createDataFrame(about, "features array<string>, trees int, batch int, upper boolean").coalesce(1).write.mode("overwrite").parquet(f"{path}/settings")

    @staticmethod
    def load(spark, path: str) -> Forest:
        about = spark.read.parquet(f"{path}/settings").first()
        upper = spark.read.parquet(f"{path}/upper") if about["upper"] else None
        return Forest(upper, spark.read.parquet(f"{path}/pieces"), list(about["features"]), about["trees"], about["batch"])


def feature_array(features: list[str]):
    return F.array(*[F.round(F.col(c).cast("double"), DECIMALS) for c in features])


def fit_forest(
    rows: DataFrame, features: list[str], target: str, keys: list[str], trees: int = 500, seed: int = 42,
    max_depth: int | None = None, task_rows: int = TASK_ROWS, batch: int = BATCH,
) -> Forest:
    """Grow ``trees`` trees per ``model`` (a column of ``rows``, or one model 0). ``keys`` tell the rows of a model apart."""
    model = F.col("model").cast("int") if "model" in rows.columns else F.lit(0)
    y = F.round(F.col(target).cast("double") * TARGET_SCALE).cast("long")
    base = materialize(rows.select(model.alias("model"), F.struct(*keys).alias("key"), feature_array(features).alias("x"), y.alias("y")))
    largest = base.groupBy("model").count().agg(F.max("count")).first()[0] or 0
    key = [F.col(f"key.{k}") for k in keys]
    if largest <= task_rows:
        return Forest(None, _grown_batches(base, key, trees, seed, max_depth, batch), list(features), trees, batch)
    drawn = base.select("model", "x", "y", *[c.alias(f"_k{i}") for i, c in enumerate(key)], F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree"))
    drawn = drawn.withColumn("w", poisson(seed, F.col("model"), F.col("tree"), *[F.col(f"_k{i}") for i in range(len(key))])).where("w > 0")
    upper, pieces = _grown_levels(drawn.select("model", "tree", "w", "y", "x"), len(features), max_depth, task_rows)
    return Forest(upper, pieces, list(features), trees, 1)


def _grown_batches(base: DataFrame, key: list, trees: int, seed: int, max_depth: int | None, batch: int) -> DataFrame:
    """Models that fit into a task: ``batch`` trees to a task, the rows with their draws for these trees."""
    first = F.explode(F.sequence(F.lit(0), F.lit(trees - 1), F.lit(batch))).alias("first")
    dealt = base.select("model", "x", "y", *[c.alias(f"_k{i}") for i, c in enumerate(key)], first)
    keys = [F.col(f"_k{i}") for i in range(len(key))]
    of_trees = F.sequence(F.col("first"), F.least(F.col("first") + (batch - 1), F.lit(trees - 1)))
    times = F.transform(of_trees, lambda t: poisson(seed, F.col("model"), t, *keys).cast("byte"))
    dealt = dealt.select("model", "first", "x", "y", times.alias("times"))

    def run(t: pa.Table) -> pa.Table:
        model, first = t["model"][0].as_py(), t["first"][0].as_py()
        grown = grow_trees(rows_matrix(t["x"]), t["y"].to_numpy(), rows_matrix(t["times"]).astype(np.int64), max_depth)
        return piece_table([(model, first + i, 0, *(tree[k] for k in ("feature", "threshold", "left", "value", "weight"))) for i, tree in enumerate(grown) if tree])

    return materialize(dealt.groupBy("model", "first").applyInArrow(run, PIECE))


def _grown_levels(entries: DataFrame, features: int, max_depth: int | None, task_rows: int) -> tuple[DataFrame | None, DataFrame]:
    """Split nodes of more than ``task_rows`` rows level by level, then finish each node that is left in a task."""
    node = ["model", "tree", "node"]
    e = materialize(entries.withColumns({"node": F.lit(0).cast("long"), "depth": F.lit(0)}))
    uppers, leaves, made, depth = [], [], 1, 0
    while True:
        counts = e.groupBy(*node).agg(F.count(F.lit(1)).alias("n"), F.sum("w").alias("total_w"), F.sum(F.col("w") * F.col("y")).alias("total_s"), F.min("y").alias("low"), F.max("y").alias("high"))
        big = materialize(counts.where(F.col("n") > task_rows))
        if big.isEmpty():
            break
        stop = (F.col("low") == F.col("high")) | F.lit(max_depth is not None and depth >= max_depth)
        splits = _level_splits(e, big.where(~stop), node)
        numbered = global_row_number(splits, node, "_place")
        left = F.lit(made) + (F.col("_place") - 1) * 2
        splits = materialize(numbered.select(*node, F.lit(depth).alias("depth"), "feature", "threshold", left.alias("left"), (left + 1).alias("right")))
        uppers.append(splits)
        made += 2 * splits.count()
        # a large node that cannot be split is a leaf as it stands
        leaf = big.join(splits.select(*node), node, "left_anti")
        mean = (F.col("total_s") / F.col("total_w") / TARGET_SCALE).alias("v")
        leaves.append(materialize(leaf.select("model", "tree", F.col("node").alias("piece"), F.array(F.lit(-1)).alias("feature"), F.array(F.lit(0.0)).alias("threshold"),
                                              F.array(F.lit(-1)).alias("left"), F.array(mean).alias("value"), F.array("total_w").alias("weight"))))
        moved = e.join(leaf.select(*node), node, "left_anti").join(splits.drop("depth"), node, "left")
        goes_left = F.get("x", F.col("feature")) <= F.col("threshold")
        is_split = F.col("feature").isNotNull()
        to = F.when(~is_split, F.col("node")).when(goes_left, F.col("left")).otherwise(F.col("right"))
        e = materialize(moved.select("model", "tree", "w", "y", "x", to.alias("node"), (F.col("depth") + is_split.cast("int")).alias("depth")))
        depth += 1

    def run(t: pa.Table) -> pa.Table:
        key = [t[k][0].as_py() for k in node]
        rest = None if max_depth is None else max_depth - t["depth"][0].as_py()
        tree = grow_trees(rows_matrix(t["x"]), t["y"].to_numpy(), t["w"].to_numpy().astype(np.int64)[:, None], rest)[0]
        return piece_table([(*key, *(tree[k] for k in ("feature", "threshold", "left", "value", "weight")))])

    pieces = materialize(reduce(DataFrame.unionByName, [e.groupBy(*node).applyInArrow(run, PIECE), *leaves]))
    return (materialize(reduce(DataFrame.unionByName, uppers)) if uppers else None), pieces


def _level_splits(e: DataFrame, big: DataFrame, node: list[str]) -> DataFrame:
    """(node, feature, threshold) of every node of ``big`` whose rows differ in some feature."""
    key = [*node, "feature"]
    long = e.join(big.select(*node), node, "left_semi").select(*node, "w", (F.col("w") * F.col("y")).alias("s"), F.posexplode("x").alias("feature", "v"))
    values = long.groupBy(*key, "v").agg(F.sum("w").alias("w"), F.sum("s").alias("s"))  # combined before the shuffle
    run = materialize(global_running_sums(values, [*key, "v"], {"run_w": F.col("w"), "run_s": F.col("s")}))
    # a (node, feature)'s sums begin where the one before it ends
    begin = run.groupBy(*key).agg(F.min_by(F.struct((F.col("run_w") - F.col("w")).alias("w0"), (F.col("run_s") - F.col("s")).alias("s0")), "v").alias("b"))
    left_w, left_s = F.col("run_w") - F.col("b.w0"), F.col("run_s") - F.col("b.s0")
    sums = run.join(begin, key).join(big.select(*node, "total_w", "total_s"), node).select(*key, "v", left_w.alias("lw"), left_s.alias("ls"), "total_w", "total_s").where("lw < total_w")
    square = lambda s, w: s.cast("double") * s.cast("double") / w
    score = square(F.col("ls"), F.col("lw")) + square(F.col("total_s") - F.col("ls"), F.col("total_w") - F.col("lw"))
    best = sums.groupBy(*node).agg(F.max(F.struct(score.alias("score"), (-F.col("feature")).alias("f"), (-F.col("v")).alias("v"))).alias("b"))
    best = materialize(best.select(*node, (-F.col("b.f")).alias("feature"), (-F.col("b.v")).alias("low")))
    after = run.join(best, key).where(F.col("v") > F.col("low")).groupBy(*key, "low").agg(F.min("v").alias("high"))
    middle = F.col("low") + (F.col("high") - F.col("low")) / 2
    return after.select(*key, F.when(middle < F.col("high"), middle).otherwise(F.col("low")).alias("threshold"))
