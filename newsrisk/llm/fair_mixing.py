r"""Mixing sources to target weights by weighted fair queueing. DataFrame functions only.

1. Sizes. A document's size is its number of words `[^\x20\x09-\x0D]+`. Rows that agree in source,
   doc_id and size are one unit with a count, so a row that repeats however often stays one row.
2. Targets. Sources in code-point order (null last) take the weights in turn and share the budget by
   weight; a target stops at ``repeats`` times its source's size, and what is left is shared anew
   among the others until none is above (one aggregate over the sources per round).
3. Shuffle. A source's units are ordered by the MD5 of seed, doc_id and size. Their places (words of
   the source up to and including the document) are running totals within about sqrt(documents)
   ranges of that hash per source, plus the totals of the ranges before.
4. Queue. Every document is queued ``repeats`` times, epoch after epoch in the same order. Its virtual finish
   time is its source's words so far over the source's target, so at time 1 each source has given
   its target.
5. Range sort and cut. Copies fall into ranges of virtual finish time, about as many as the square root of
   their number; each range's words are totalled, and the range in which the running total passes the
   budget is sorted by (finish time, source, place) and cut where the total would pass it. Copies in
   earlier ranges are all taken, those in later ones never. ``schedule`` gives the taken copies in that order.

Nothing is drawn at random: reruns and other partitionings agree. A source, hash range or range of
finish times holds no more than a window over about sqrt(rows) rows; the driver gets a few scalars per round.

Defined cases: a null text has size 0; documents of size 0 are kept with nothing taken; a null source
is a source of its own, a null doc_id a key like any other; repeated rows each get their own copies (which
of them is taken once more often is arbitrary: they are alike); an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsrisk.llm.common import checked_broadcast, write_table
from newsrisk.operators.ranking import global_row_number

#: The sources' weights, repeating, and how often a source may be taken whole.
WEIGHTS = (5, 2, 1)
REPEATS = 3
SEED = 42
WORD = r"[^\x20\x09-\x0D]+"
#: Copies of one unit are made in blocks of at most this many.
COPY_BLOCK = 1024


def sized(docs: DataFrame) -> DataFrame:
    """(source, doc_id, size, n), written: the table's rows, alike ones counted."""
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    units = docs.select(F.col("source").cast("string").alias("source"), F.col("doc_id").cast("long").alias("doc_id"), size.alias("size"))
    return write_table(units.groupBy("source", "doc_id", "size").agg(F.count("*").alias("n")), "units")


def targets(units: DataFrame, weights=WEIGHTS, repeats: int = REPEATS, budget: int | None = None) -> DataFrame:
    """(source, rank, docs, source_size, target), written: one row per source; the budget defaults to all words."""
    sums = units.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"), F.sum("n").alias("docs"))
    ranked = global_row_number(sums, [F.col("source").isNull(), F.col("source")], "rank")
    weight = F.element_at(F.array(*map(F.lit, weights)), ((F.col("rank") - 1) % len(weights) + 1).cast("int")).cast("long")
    by_source = write_table(ranked.select("*", weight.alias("weight"), (F.col("source_size") * repeats).alias("cap")), "sources")
    words, weighed = by_source.agg(F.sum("source_size"), F.sum("weight")).first()
    left, open_ = (words or 0) if budget is None else budget, weighed or 0
    share = lambda: F.col("weight") * F.lit(float(left)) / F.lit(float(open_))
    total = left
    while open_:
        capped, their = by_source.where(F.col("cap") < share()).agg(F.coalesce(F.sum("cap"), F.lit(0)), F.coalesce(F.sum("weight"), F.lit(0))).first()
        if (total - capped, weighed - their) == (left, open_):
            break
        left, open_ = total - capped, weighed - their
    target = F.least(F.col("cap").cast("double"), share()) if open_ else F.col("cap").cast("double")
    return write_table(by_source.select("source", "rank", "docs", "source_size", target.alias("target")), "targets")


def shuffled(units: DataFrame, by_source: DataFrame, seed: int = SEED) -> DataFrame:
    """The units with ``rank``, ``source_size``, ``target`` and ``start``, the source's words before the unit; written."""
    s = checked_broadcast(by_source.withColumnRenamed("source", "_source"), 128)
    u = units.join(s, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    key = F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("size").cast("string")))
    u = u.withColumn("key", key)
    ranges = F.ceil(F.sqrt("docs")).cast("long")
    hashed = F.conv(F.substring("key", 1, 8), 16, 10).cast("long")
    u = write_table(u.withColumn("bucket", F.shiftright(hashed * ranges, 32)).drop("docs"), "keyed_units")
    words = F.col("size") * F.col("n")
    earlier = Window.unboundedPreceding, -1
    sums = u.groupBy("rank", "bucket").agg(F.sum(words).alias("words"))
    before = F.sum("words").over(Window.partitionBy("rank").orderBy("bucket").rowsBetween(*earlier))
    sums = write_table(sums.select("rank", "bucket", F.coalesce(before, F.lit(0)).alias("before")), "bucket_words")
    within = F.sum(words).over(Window.partitionBy("rank", "bucket").orderBy("key", "doc_id", "size").rowsBetween(*earlier))
    placed = u.join(sums, ["rank", "bucket"]).withColumn("start", F.col("before") + F.coalesce(within, F.lit(0)))
    return write_table(placed.select("source", "doc_id", "size", "n", "rank", "source_size", "target", "start"), "placed")


def each_row(placed: DataFrame) -> DataFrame:
    """One row per row of the table: the units with ``copy``, from 0."""
    last = F.col("n") - 1
    blocks = placed.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.floor(last / COPY_BLOCK))).alias("_block"))
    first = F.col("_block") * COPY_BLOCK
    return blocks.select("*", F.explode(F.sequence(first, F.least(first + (COPY_BLOCK - 1), last))).alias("copy")).drop("_block")


def place(epoch) -> Column:
    """The source's words up to and including this copy in this epoch."""
    return F.col("source_size") * epoch + F.col("start") + (F.col("copy") + 1) * F.col("size")


def finish(epoch) -> Column:
    """Virtual finish time."""
    return place(epoch).cast("double") / F.col("target")


def queue(placed: DataFrame, repeats: int = REPEATS) -> DataFrame:
    """Every copy of every document that has words: ``epoch``, ``place`` and ``finish``."""
    rows = each_row(placed.where("size > 0")).select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(repeats - 1).cast("long"))).alias("epoch"))
    return rows.withColumns({"place": place(F.col("epoch")), "finish": finish(F.col("epoch"))})


def time_range(at: Column, ranges: int) -> Column:
    """``ranges`` equal ranges up to time 1, from there on ranges that widen with the time."""
    later = F.floor(F.log2(F.greatest(at, F.lit(1.0))) * ranges) + ranges
    return F.when(at < 1.0, F.least(F.floor(at * ranges), F.lit(ranges - 1).cast("long"))).otherwise(later)


class Cut:
    """Where the budget ends: the range of finish time, and the last copy taken in it (None: no copy of it)."""

    def __init__(self, ranges: int, at: int | None, last):
        self.ranges, self.at, self.last = ranges, at, last

    def takes(self, finish_: Column, rank: Column, place_: Column) -> Column:
        """Whether a copy is taken."""
        if self.at is None:
            return F.lit(True)
        r = time_range(finish_, self.ranges)
        if self.last is None:
            return r < self.at
        f, k, p = self.last
        last = (finish_ < f) | ((finish_ == f) & ((rank < k) | ((rank == k) & (place_ <= p))))
        return (r < self.at) | ((r == self.at) & last)


def cut(copies: DataFrame, rows: int, budget: int) -> Cut:
    """Range totals, and the sorted range in which the running total passes the budget."""
    ranges = max(1, int(rows**0.5))
    copies = copies.withColumn("range", time_range(F.col("finish"), ranges))
    sums = write_table(copies.groupBy("range").agg(F.sum("size").alias("words")), "range_words")
    total = F.sum("words").over(Window.orderBy("range").rowsBetween(Window.unboundedPreceding, 0))
    over = sums.select("range", "words", total.alias("total")).where(F.col("total") > budget).orderBy("range").first()
    if over is None:
        return Cut(ranges, None, None)
    before = over["total"] - over["words"]
    running = F.sum("size").over(Window.partitionBy("range").orderBy("finish", "rank", "place").rowsBetween(Window.unboundedPreceding, 0))
    inside = copies.where(F.col("range") == over["range"]).withColumn("running", running).where(F.col("running") + before <= budget)
    last = inside.agg(F.max(F.struct("finish", "rank", "place"))).first()[0]
    return Cut(ranges, over["range"], last)


def _planned(docs: DataFrame, weights, repeats: int, seed: int, budget: int | None) -> tuple[DataFrame, Cut]:
    units = sized(docs)
    placed = shuffled(units, targets(units, weights, repeats, budget), seed)
    words, rows = placed.agg(F.sum(F.col("size") * F.col("n")), F.sum("n")).first()
    return placed, cut(queue(placed, repeats), (rows or 0) * repeats, (words or 0) if budget is None else budget)


def mix(docs: DataFrame, weights=WEIGHTS, repeats: int = REPEATS, seed: int = SEED, budget: int | None = None) -> DataFrame:
    """(doc_id, size, source_size, target, taken, source): one row per row of the table."""
    placed, end = _planned(docs, weights, repeats, seed, budget)
    times = [F.when(end.takes(finish(F.lit(e)), F.col("rank"), place(F.lit(e))), 1).otherwise(0) for e in range(repeats)]
    taken = F.when(F.col("size") > 0, F.col("size") * sum(times[1:], times[0])).otherwise(F.lit(0).cast("long"))
    return each_row(placed).select("doc_id", "size", "source_size", "target", taken.cast("long").alias("taken"), "source")


def schedule(docs: DataFrame, weights=WEIGHTS, repeats: int = REPEATS, seed: int = SEED, budget: int | None = None) -> DataFrame:
    """(doc_id, source, size, epoch, finish) of every copy taken, range-sorted by virtual finish time."""
    placed, end = _planned(docs, weights, repeats, seed, budget)
    taken = queue(placed, repeats).where(end.takes(F.col("finish"), F.col("rank"), F.col("place")))
    return taken.orderBy("finish", "rank", "place").select("doc_id", "source", "size", "epoch", "finish")
