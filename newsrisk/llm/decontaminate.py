"""Benchmark decontamination. DataFrame functions only.

A document is contaminated by a benchmark item if some window of it, as long as the item, has
weighted Jaccard similarity ``THRESHOLD`` or more with it, over 5-word shingles with repeats
(lower-cased words between white space).

1. Windows. A window that shares no shingle with any item of its length has similarity zero, and
   moving a window right up to its first shared shingle loses none. So of all item-sized windows
   those that begin at a shared shingle hold every maximum, and only they are fingerprinted.
2. Fingerprints. A window's and an item's 64-bit SimHash over their shingles.
3. Multi-index. Five blocks of 12 or 13 bits; fingerprints within ``RADIUS`` = 19 bits agree within 3 bits on
   some block. Items are indexed under all block values within 3 bits of theirs, windows look up
   their five blocks, and a final count of differing bits leaves exactly the pairs within the radius.
   At similarity 0.8 about 10 bits differ, with a deviation of 3; the nearer, the fewer. Fingerprints of few
   shingles vary more. A window of as many shingles as an item of fewer than ``EXACT_BELOW`` is at 0.8 only if it
   has all of them, and so the same fingerprint; a shorter one (a document shorter than the item) must
   lie in the item whole, so it is looked up by its first shingle and always verified.
4. Verification. The exact weighted similarity of the pairs' shingles.

Defined cases: null and blank texts, null item ids and null doc_ids take no part; an item of fewer
than 5 words is one shingle of all its words; a document shorter than the item is one window; equal
items are compared once and reported under every item_id; rows that share a doc_id give one result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsrisk.llm.common import BROADCAST_MAX_BYTES, checked_broadcast, let, write_table

SHINGLE_WORDS = 5
THRESHOLD = 0.8
RADIUS = 19
BLOCKS = 5
#: SimHash says too little of items of fewer shingles: documents shorter than such an item are compared with it outright.
EXACT_BELOW = 9


def split_words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), r"\s+"), "")


def shingles(text: Column, k: int) -> Column:
    """64-bit hashes of the k-word shingles of a text, in order; empty if it has fewer than k words."""
    h = F.transform(split_words(text), lambda w: F.xxhash64(w))
    if k == 1:
        return h
    at = lambda hs: F.filter(F.sequence(F.lit(0), F.size(hs) - k, F.when(F.size(hs) >= k, F.lit(1)).otherwise(F.lit(-1))), lambda i: i <= F.size(hs) - k)
    return let(h, lambda hs: F.transform(at(hs), lambda i: F.xxhash64(*(F.get(hs, i + j) for j in range(k)))))


def simhash(sh: Column) -> Column:
    """64-bit SimHash of a column of hash arrays: a bit is 1 if it is set in over half of them.

    Two bits are counted per pass, each in half a long.
    """
    n = F.size(sh)
    out = F.lit(0).cast("long")
    counted = lambda i: lambda acc, h: acc + F.shiftrightunsigned(h, i).bitwiseAND(F.lit(0x100000001))
    for i in range(32):
        pair = F.aggregate(sh, F.lit(0).cast("long"), counted(i))
        low, high = pair.bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(pair, 32)
        for votes, at in ((low, i), (high, i + 32)):
            bit = 1 << at if at < 63 else -(1 << 63)
            out = out.bitwiseOR(F.when(votes * 2 > n, F.lit(bit)).otherwise(F.lit(0).cast("long")))
    return out


def occurrences(sh: Column) -> Column:
    """The multiset as a set: each hash with its number among equal ones."""
    return let(F.sort_array(sh), lambda s: F.transform(s, lambda x, i: F.xxhash64(x, i - F.array_position(s, x))))


def flips(bits: int, radius: int) -> Column:
    """All ``bits``-bit words with at most ``radius`` ones, as an array literal."""
    words = (str(x) for x in range(1 << bits) if x.bit_count() <= radius)
    return F.split(F.lit(",".join(words)), ",").cast("array<int>")


def block_widths(n: int = BLOCKS) -> list[int]:
    """The bits of a fingerprint's n blocks, as even as can be."""
    return [64 // n + (i < 64 % n) for i in range(n)]


def blocks(fp: Column, n: int = BLOCKS) -> Column:
    """The n blocks of a fingerprint: (block, value)."""
    widths = block_widths(n)
    return F.array(*(F.struct(F.lit(i).alias("block"), F.shiftrightunsigned(fp, sum(widths[:i])).bitwiseAND(F.lit((1 << w) - 1)).cast("int").alias("value")) for i, w in enumerate(widths)))


def within_radius(windows: DataFrame, items: DataFrame, radius: int = RADIUS, n: int = BLOCKS) -> DataFrame:
    """Pairs of windows (doc_id, n, start, fp) and items (item, n, fp) of one length within the radius."""
    w = windows.select("doc_id", "n", "start", "fp", F.explode(blocks(F.col("fp"), n)).alias("b")).select("doc_id", "n", "start", "fp", "b.block", "b.value")
    i = items.select("item", "n", F.col("fp").alias("item_fp"), F.explode(blocks(F.col("fp"), n)).alias("b"))
    widths = block_widths(n)
    by_width = F.coalesce(*[F.when(F.col("b.block").isin([b for b, x in enumerate(widths) if x == size]), flips(size, radius // n)) for size in sorted(set(widths))])
    i = i.select("item", "n", "item_fp", "b.block", F.col("b.value").alias("own"), F.explode(by_width).alias("flip"))
    i = write_table(i.select("item", "n", "item_fp", "block", F.col("own").bitwiseXOR(F.col("flip")).alias("value")), "item_index")
    near = F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp"))) <= radius
    return w.join(checked_broadcast(i, 96), ["n", "block", "value"]).where(near).select("doc_id", "n", "start", "item").distinct()


def short_windows(windows: DataFrame, items: DataFrame) -> DataFrame:
    """Pairs of windows with fewer shingles than an item of fewer than ``EXACT_BELOW``, by the window's first shingle."""
    w = windows.where((F.col("n") < EXACT_BELOW) & (F.size("sh") < F.col("n"))).select("doc_id", "n", "start", F.get("sh", F.lit(0)).alias("h"))
    i = items.where(F.col("n") < EXACT_BELOW).select("item", "n", F.explode(F.array_distinct("sh")).alias("h"))
    return w.join(i, ["n", "h"]).select("doc_id", "n", "start", "item")


def matches_for(docs: DataFrame, items: DataFrame, k: int, threshold: float) -> DataFrame:
    """(doc_id, item, similarity, start, n) for the items of shingle length k: (item, n, sh, fp)."""
    known = write_table(items.select("n", F.explode("sh").alias("h")).distinct(), "item_shingles")
    # outer: a plain explode would compute its array a second time, to filter empty ones
    each = docs.select("doc_id", F.posexplode_outer(shingles(F.col("text"), k)).alias("pos", "h"))
    found = each.join(checked_broadcast(known, 32), "h")
    anchors = write_table(found.groupBy("doc_id", "n").agg(F.collect_set("pos").alias("at")), "anchors")
    widest = anchors.agg(F.max(F.size("at")), F.count("*")).first()
    side = F.broadcast(anchors) if (widest[0] or 0) * 8 * widest[1] <= BROADCAST_MAX_BYTES else anchors
    at = docs.join(side, "doc_id").select("doc_id", "n", "at", shingles(F.col("text"), k).alias("sh"))
    at = write_table(at, "anchored")
    starts = F.array_distinct(F.transform("at", lambda p: F.greatest(F.least(p, F.size("sh") - F.col("n")), F.lit(0))))
    windows = at.select("doc_id", "n", "sh", F.explode(starts).alias("start")).select("doc_id", "n", "start", F.slice("sh", F.col("start") + 1, F.col("n")).alias("sh"))
    windows = write_table(windows, "windows")
    windows = write_table(windows.select("doc_id", "n", "start", "sh", simhash(F.col("sh")).alias("fp")), "window_prints")
    pairs = within_radius(windows.drop("sh"), items).unionByName(short_windows(windows, items)).distinct()
    pairs = checked_broadcast(write_table(pairs, "window_pairs"), 48)
    longest = items.agg(F.max("n")).first()[0] or 0
    held = windows.drop("fp").join(pairs, ["doc_id", "n", "start"])
    both = held.join(checked_broadcast(items.select("item", F.col("sh").alias("item_sh")), 48 + 8 * longest), "item")
    common = F.size(F.array_intersect(occurrences(F.col("sh")), occurrences(F.col("item_sh"))))
    scored = both.select("doc_id", "item", "n", "start", (common / (F.size("sh") + F.size("item_sh") - common)).alias("similarity"))
    best = scored.where(F.col("similarity") >= threshold - 1e-12).groupBy("doc_id", "item", "n")
    return best.agg(F.max(F.struct("similarity", (-F.col("start")).alias("s"))).alias("m")).select("doc_id", "item", "n", F.col("m.similarity").alias("similarity"), (-F.col("m.s")).alias("start"))


def contaminated(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, k: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, item_id, similarity, start_word, n_words): the best window of each document and item."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("doc_id is not null and text is not null")
    named = benchmark.where("item_id is not null and text is not null").select(F.col("item_id").cast("long").alias("item_id"), "text")
    named = write_table(named.withColumn("words", split_words(F.col("text"))).where(F.size("words") > 0).select("item_id", "words", F.xxhash64("words").alias("item")), "items")
    each = named.select("item", F.concat_ws(" ", "words").alias("text"), F.least(F.size("words"), F.lit(k)).alias("k")).distinct()
    parts = []
    for (size,) in each.select("k").distinct().collect():  # at most k rows
        items = write_table(each.where(F.col("k") == size).select("item", shingles(F.col("text"), size).alias("sh")), "items_of_size")
        items = write_table(items.select("item", "sh", F.size("sh").alias("n"), simhash(F.col("sh")).alias("fp")), "item_prints")
        parts.append(matches_for(docs, items, size, threshold).withColumn("n_words", F.col("n") + size - 1))
    if not parts:
        return docs.sparkSession.createDataFrame([], "doc_id long, item_id long, similarity double, start_word int, n_words int")
    found = reduce(DataFrame.unionByName, parts).join(named.select("item", "item_id").distinct(), "item")
    return found.select("doc_id", "item_id", "similarity", F.col("start").cast("int").alias("start_word"), F.col("n_words").cast("int").alias("n_words"))


def clean_of(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that no item contaminates; rows without an id stay."""
    gone = write_table(contaminated(docs, benchmark, threshold).select("doc_id").distinct(), "contaminated")
    return docs.join(checked_broadcast(gone, 24), "doc_id", "left_anti").select(docs.columns)
