"""Line dedup: an exact set-similarity self-join of lines by prefix filtering. DataFrame functions only.

A line is the set of its space-separated tokens (tabs and carriage returns count as spaces). A line
goes if an earlier line, by (doc_id, line number), has Jaccard similarity ``THRESHOLD`` or more
with it; earlier lines count whether they go themselves or not. Lines without a token stay.

1. Rarity. Token occurrences are counted over all documents in 2^18 hash buckets (all that the
   driver sees), and each bucket gets one of 64 classes by the logarithm of its count over the median
   bucket's. A token becomes one long, its class and 58 bits of its hash: sorting the longs sorts by
   rarity, in one order for all lines.
2. Classes. Lines with equal token sets are one class; all but its first line go. Only the first
   line, with its size, prefix and two parity words, goes on.
3. Stars. For prefix tokens that many classes share, the first of those classes is a pivot. A
   class that passes the filters against an earlier pivot is tried with it alone, so a group of m
   near-equal lines costs about m pairs.
4. Join. The other classes meet all classes on prefix tokens; a pair must pass the length filter,
   the positional filter and the parity filter (two sets whose 128 parity bits differ in d places
   differ in at least d tokens). Both sides of the join are the same rows, shuffled once.
5. Verification on the tokens themselves, in rounds: each class with its likeliest candidate (the
   pivot, or the fewest differing parity bits); the classes for which that fails with up to 16 more pivots of
   each of their tokens; those for which that fails too meet all classes once more, and every pair of
   theirs is verified. In a group of near-equal lines few get to the last round.

Steps 3 to 5 lose nothing: a class goes if and only if an earlier class is similar.

Defined cases: documents with a null id, or a null text, are left as they are and take no part;
rows that share a doc_id lose the same line numbers; all columns are kept as they are but
``text``, and a document all of whose lines go keeps its row with an empty text.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsrisk.llm.common import BROADCAST_MAX_BYTES, checked_broadcast, let, write_table

THRESHOLD = 0.8
SKETCH_BITS = 18
#: Sets of at most this many tokens have one parity word, over half of their tokens.
HALF_PARITY = 72
#: Prefix tokens that at least this many classes share get a pivot.
PIVOT_AT = 8
#: Pivots of such a token for the classes for which the first candidate fails.
PIVOTS = 16

ORDER = ("doc", "line")


def words(text: Column) -> Column:
    """Space-separated tokens, repeats included."""
    plain = F.replace(F.replace(text, F.lit("\t"), F.lit(" ")), F.lit("\r"), F.lit(" "))
    return F.array_remove(F.split(plain, " "), "")


def lines_of(docs: DataFrame) -> DataFrame:
    """(doc, line, text) of every line."""
    d = docs.select(F.col("doc_id").cast("long").alias("doc"), "text").where("doc is not null and text is not null")
    # outer: a plain explode would split a second time, to filter empty arrays (there are none)
    return d.select("doc", F.posexplode_outer(F.split("text", "\n")).alias("line", "text"))


def rarity_classes(docs: DataFrame, bits: int = SKETCH_BITS) -> Column:
    """An array literal: each hash bucket's class, -32 (rarest) to 31."""
    tokens = docs.where("doc_id is not null").select(F.explode_outer(F.split(F.replace("text", F.lit("\n"), F.lit(" ")), " ")).alias("t"))
    counts = tokens.where("t <> ''").groupBy(F.xxhash64("t").bitwiseAND(F.lit((1 << bits) - 1)).alias("b")).agg(F.count("*").alias("n"))
    n = np.zeros(1 << bits)
    for bucket, count in counts.collect():  # at most 2^bits rows
        n[bucket] = count
    level = np.floor(4 * np.log2((n + 1) / (np.median(n) + 1))).clip(-32, 31).astype(int)
    return F.split(F.lit(",".join(map(str, level.tolist()))), ",").cast("array<tinyint>")  # folded to one literal


def ordered_tokens(text: Column, classes: Column, bits: int = SKETCH_BITS) -> Column:
    """The line's distinct tokens as longs, rarest first."""

    def packed(w):
        h = F.xxhash64(w)
        rarity = F.get(classes, h.bitwiseAND(F.lit((1 << bits) - 1)).cast("int"))
        return F.shiftleft(rarity.cast("long"), 58).bitwiseOR(F.shiftrightunsigned(h, 6))

    return F.sort_array(F.array_distinct(F.transform(words(text), packed)))


def at_least(share: float, size: Column) -> Column:
    """ceil(share * size), safe against the last bit."""
    return F.ceil(F.lit(share) * size - F.lit(1e-9)).cast("int")


def overlap_needed(a: Column, b: Column, threshold: float) -> Column:
    return at_least(threshold / (1 + threshold), a + b)


def parity(tokens: Column, word: int) -> Column:
    """64 parity bits over half of the tokens (those whose bit 6 is ``word``): each flips one."""

    def flip(t):
        half = F.shiftright(t, 6).bitwiseAND(F.lit(1))
        half = half if word else half.bitwiseXOR(F.lit(1))
        return F.call_function("shiftleft", half, t.bitwiseAND(F.lit(63)).cast("int"))

    return F.aggregate(tokens, F.lit(0).cast("long"), lambda acc, t: acc.bitwiseXOR(flip(t)))


SET_KEY = ("set", "size", "p0", "p1")


def tokenised(docs: DataFrame, classes: Column, threshold: float) -> DataFrame:
    """Every line with a token, written: (doc, line), its set's key and its prefix (32 hash bits per token)."""
    t = lines_of(docs).where(F.col("text").rlike(r"[^ \t\r]")).select("doc", "line", ordered_tokens(F.col("text"), classes).alias("t"))
    size = F.size("t")
    lines = t.select(
        "doc",
        "line",
        F.xxhash64("t").alias("set"),
        size.alias("size"),
        parity(F.col("t"), 0).alias("p0"),
        F.when(size > HALF_PARITY, parity(F.col("t"), 1)).otherwise(F.lit(0).cast("long")).alias("p1"),  # for smaller sets one half tells enough
        F.transform(F.slice("t", F.lit(1), size - at_least(threshold, size) + 1), lambda x: F.hash(x)).alias("prefix"),
    )
    return write_table(lines, "lines")


def copies_of(lines: DataFrame) -> DataFrame:
    """(doc, line), written: lines whose token set an earlier line has."""
    first = lines.groupBy(*SET_KEY).agg(F.min(F.struct("doc", "line")).alias("f"), F.count("*").alias("n")).where("n > 1")
    first = write_table(first.select(*SET_KEY, F.col("f.doc").alias("doc0"), F.col("f.line").alias("line0")), "repeated_sets")
    return write_table(lines.select(*ORDER, *SET_KEY).join(checked_broadcast(first, 72), list(SET_KEY)).where("doc <> doc0 or line <> line0").select(*ORDER), "line_copies")


def earlier(a: str, b: str) -> Column:
    """Whether line a comes before line b."""
    c = lambda x, y: F.col(f"{x}.{y}")
    return (c(a, "doc") < c(b, "doc")) | ((c(a, "doc") == c(b, "doc")) & (c(a, "line") < c(b, "line")))


def differing(x: str, y: str, sx: Column, sy: Column) -> Column:
    """Differing parity bits, of the words that both sets have."""
    one = lambda w: F.bit_count(F.col(f"{x}.{w}").bitwiseXOR(F.col(f"{y}.{w}")))
    return one("p0") + F.when(F.least(sx, sy) > HALF_PARITY, one("p1")).otherwise(F.lit(0))


def may_match(x: str, y: str, threshold: float) -> Column:
    """Length and parity filters of two classes."""
    sx, sy = F.col(f"{x}.size"), F.col(f"{y}.size")
    need = overlap_needed(sx, sy, threshold)
    return (F.least(sx, sy) >= at_least(threshold, F.greatest(sx, sy))) & (differing(x, y, sx, sy) <= sx + sy - need * 2)


def index_prefix(size: Column, threshold: float) -> Column:
    """Prefix length of the smaller set of a pair."""
    return size - overlap_needed(size, size, threshold) + 1


def keyed_classes(classes: DataFrame) -> DataFrame:
    """The classes' small columns under up to four tokens spread over the prefix, each with a size class (steps of 1.25)."""
    last = F.size("prefix") - 1
    at = F.array_distinct(F.array(*(F.floor(last * i / 4).cast("int") for i in range(1, 5))))
    step = F.floor(F.log(F.col("size").cast("double")) / F.lit(math.log(1.25))).cast("int")
    return classes.select("doc", "line", "size", "p0", "p1", step.alias("step"), F.explode(F.transform(at, lambda i: F.element_at("prefix", i + 1))).alias("token"))


def pivots_of(classes: DataFrame, pivot_at: int = PIVOT_AT, many: int = PIVOTS) -> DataFrame:
    """(token, step, first, and a class), written: of the keys that at least ``pivot_at`` classes share the first class of each of ``many`` hash parts.

    ``first`` marks the first of them all.
    """
    row = F.struct("doc", "line", "size", "p0", "p1")
    part = F.pmod(F.xxhash64("doc", "line"), F.lit(many))
    by_part = keyed_classes(classes).groupBy("token", "step", part.alias("part")).agg(F.min(row).alias("p"), F.count("*").alias("n"))
    by_key = by_part.groupBy("token", "step").agg(F.sort_array(F.collect_list("p")).alias("ps"), F.sum("n").alias("n")).where(F.col("n") >= pivot_at)  # at most `many`
    return write_table(by_key.select("token", "step", F.posexplode("ps").alias("at", "p")).select("token", "step", (F.col("at") == 0).alias("first"), "p.*"), "pivots")


def star_candidates(asking: DataFrame, pivots: DataFrame, threshold: float) -> DataFrame:
    """(doc, line, doc2, line2): classes and earlier pivots of their keys that pass the filters."""
    same = (F.col("x.token") == F.col("y.token")) & (F.col("x.step") == F.col("y.step"))
    found = keyed_classes(asking).alias("x").join(checked_broadcast(pivots, 80).alias("y"), same).where(earlier("y", "x") & may_match("x", "y", threshold))
    return found.select("x.doc", "x.line", F.col("y.doc").alias("doc2"), F.col("y.line").alias("line2"))


def star_pairs(classes: DataFrame, pivots: DataFrame, threshold: float) -> DataFrame:
    """(doc, line, doc2, line2): classes and an earlier first pivot that passes the filters, at most one per class."""
    found = star_candidates(classes, pivots.where("first"), threshold).groupBy("doc", "line").agg(F.min(F.struct("doc2", "line2")).alias("y"))
    return found.select("doc", "line", "y.doc2", "y.line2")


def entries(classes: DataFrame) -> DataFrame:
    """A class's prefix entries (pos counts from 0), its small numbers in one long: size, pos, open."""
    meta = F.shiftleft(F.col("size").cast("long"), 32) + F.col("pos") * 2 + F.col("open")
    return classes.select("doc", "line", "size", "p0", "p1", "open", F.posexplode("prefix").alias("pos", "token")).select("doc", "line", "p0", "p1", "token", meta.alias("meta"))


def part(side: str, name: str) -> Column:
    """A number out of an entry's ``meta``."""
    m = F.col(f"{side}.meta")
    return {"size": F.shiftright(m, 32).cast("int"), "pos": F.shiftright(m, 1).bitwiseAND(F.lit(0x7FFFFFFF)).cast("int"), "open": m.bitwiseAND(F.lit(1))}[name]


def matched(x: DataFrame, y: DataFrame, threshold: float) -> DataFrame:
    """Join of prefix entries, aliased x and y: open x with every earlier y that passes the filters."""

    sx, sy, px, py = part("x", "size"), part("y", "size"), part("x", "pos"), part("y", "pos")
    need = overlap_needed(sx, sy, threshold)
    # of a pair the larger set uses its whole prefix, the smaller one the shorter index prefix
    sides = ((sx >= sy) & (py < index_prefix(sy, threshold))) | ((sy >= sx) & (px < index_prefix(sx, threshold)))
    length = F.least(sx, sy) >= at_least(threshold, F.greatest(sx, sy))
    position = F.least(sx - px, sy - py) >= need
    # a condition on x alone would be pushed below the exchange, and the two sides be shuffled apart
    asked = part("x", "open") >= F.least(part("y", "open"), F.lit(0)) + 1
    close = differing("x", "y", sx, sy) <= sx + sy - need * 2
    return x.alias("x").join(y.alias("y"), F.col("x.token") == F.col("y.token")).where(asked & earlier("y", "x") & length & sides & position & close)


def likeliest(classes: DataFrame, threshold: float) -> DataFrame:
    """(doc, line, doc2, line2): of the ``open`` classes' candidates the one with the fewest differing bits."""
    e = entries(classes)
    best = matched(e, e, threshold).groupBy("x.doc", "x.line").agg(F.min(F.struct(differing("x", "y", part("x", "size"), part("y", "size")).alias("d"), F.col("y.doc").alias("doc2"), F.col("y.line").alias("line2"))).alias("b"))
    return best.select("doc", "line", "b.doc2", "b.line2")


def more_pivots(asking: DataFrame, classes: DataFrame, pivots: DataFrame, tried: DataFrame, threshold: float) -> DataFrame:
    """(doc, line, doc2, line2): the classes named in ``asking`` with the other pivots of their keys, at most 4 x ``PIVOTS`` each."""
    named = classes.join(checked_broadcast(asking, 40), list(ORDER), "left_semi")
    return star_candidates(named, pivots, threshold).distinct().join(tried, ["doc", "line", "doc2", "line2"], "left_anti")


def all_pairs(asking: DataFrame, classes: DataFrame, threshold: float) -> DataFrame:
    """(doc, line, doc2, line2): every candidate of the classes named in the written table ``asking``."""
    named = checked_broadcast(asking, 40)
    x = entries(classes.join(named, list(ORDER), "left_semi").withColumn("open", F.lit(1)))
    x = checked_broadcast(write_table(x, "asking"), 64)
    found = matched(x, entries(classes.withColumn("open", F.lit(0))), threshold)
    return found.select("x.doc", "x.line", F.col("y.doc").alias("doc2"), F.col("y.line").alias("line2")).distinct()


def verified(docs: DataFrame, pairs: DataFrame, threshold: float) -> DataFrame:
    """(doc, line) of the pairs whose token sets are similar enough; ``pairs`` is a written table."""
    wanted = write_table(pairs.select("doc", "line").unionByName(pairs.select(F.col("doc2").alias("doc"), F.col("line2").alias("line"))).distinct(), "wanted")
    of = write_table(wanted.select("doc").distinct(), "wanted_docs")
    held = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(checked_broadcast(of, 32), F.col("doc_id") == F.col("doc"), "left_semi")
    texts = write_table(lines_of(held).join(checked_broadcast(wanted, 40), list(ORDER), "left_semi"), "wanted_lines")
    other = texts.select(F.col("doc").alias("doc2"), F.col("line").alias("line2"), F.col("text").alias("text2"))
    both = pairs.join(texts, list(ORDER)).join(other, ["doc2", "line2"])
    both = both.select(*ORDER, F.array_distinct(words(F.col("text"))).alias("t"), F.array_distinct(words(F.col("text2"))).alias("t2"))
    shared = F.size(F.array_intersect("t", "t2"))
    both = both.select(*ORDER, shared.alias("shared"), (F.size("t") + F.size("t2")).alias("sizes"))
    return both.where(F.col("shared") >= F.lit(threshold) * (F.col("sizes") - F.col("shared")) - 1e-9).select(*ORDER).distinct()


def later_matches(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc, line) of every line that goes."""
    lines = tokenised(docs, rarity_classes(docs), threshold)
    copies = copies_of(lines)
    classes = lines.join(checked_broadcast(copies, 40), list(ORDER), "left_anti").drop("set")
    pivots = pivots_of(classes)
    star = write_table(star_pairs(classes, pivots, threshold), "star_pairs")
    tried = checked_broadcast(star.select(*ORDER, F.lit(1).alias("tried")), 48)
    rest = classes.join(tried, list(ORDER), "left").withColumn("open", F.col("tried").isNull().cast("int"))
    first = write_table(star.unionByName(likeliest(rest, threshold)), "first_pairs")
    gone = write_table(verified(docs, first, threshold), "gone")
    parts, in_vain = [gone], write_table(first.select(*ORDER).join(gone, list(ORDER), "left_anti"), "in_vain")
    for candidates in (lambda asking: more_pivots(asking, classes, pivots, first, threshold), lambda asking: all_pairs(asking, classes, threshold)):
        if in_vain.isEmpty():
            break
        gone = write_table(verified(docs, write_table(candidates(in_vain), "other_pairs"), threshold), "gone")
        parts.append(gone)
        in_vain = write_table(in_vain.join(gone, list(ORDER), "left_anti"), "in_vain")
    return reduce(DataFrame.unionByName, [*parts, copies])


def line_flags(gone: Column) -> Column:
    """An array that is true at the numbers in the sorted array ``gone``, false between them: a look-up takes one step."""
    between = lambda g, x, i: x - F.coalesce(F.get(g, i - 1), F.lit(-1)) - 1
    return let(gone, lambda g: F.flatten(F.transform(g, lambda x, i: F.concat(F.array_repeat(F.lit(False), between(g, x, i)), F.array(F.lit(True))))))


def without(docs: DataFrame, lines: DataFrame) -> DataFrame:
    """``docs`` with the lines (doc, line) taken out of ``text``, and n_lines and n_removed added."""
    gone = write_table(lines.groupBy(F.col("doc").alias("_doc")).agg(F.collect_set("line").alias("_gone")), "gone_by_doc")
    names = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    size = gone.agg(F.sum(F.size("_gone")), F.count("*")).first()
    side = F.broadcast(gone) if (size[0] or 0) * 8 + size[1] * 48 <= BROADCAST_MAX_BYTES else gone
    left = docs.select(*names).join(side, F.col("doc_id").cast("long") == F.col("_doc"), "left")
    kept = let(line_flags(F.sort_array("_gone")), lambda flags: F.array_join(F.filter(F.split("text", "\n"), lambda x, i: ~F.coalesce(F.get(flags, i), F.lit(False))), "\n"))
    text = F.when(F.col("_gone").isNull(), F.col("text")).otherwise(kept)
    n_lines = F.size(F.split("text", "\n")).cast("long")
    return left.select(*(text.alias("text") if c == "text" else F.col(c) for c in names), F.coalesce(n_lines, F.lit(0)).alias("n_lines"), F.coalesce(F.size("_gone"), F.lit(0)).cast("long").alias("n_removed"))


def dedup_lines(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with later matches taken out of ``text``, and n_lines and n_removed added."""
    return without(docs, later_matches(docs, threshold))
