"""Substring dedup: near-duplicate passages by compact windows of min-hashes.

A passage is a run of ``MIN_WORDS`` words or more, compared by its 5-word shingles (lower-cased
words between white space). Per hash function the Cartesian tree over a text's shingle hashes
groups the subsequences that share a min-hash: those inside a node's range that contain the node.
Only nodes at least as wide as a shortest passage (t shingles) matter; for subsequences of length
t a node's group is a run of starts, read off the sliding minima of width t. Runs of two hash
functions are intersected (an interval join within the text), and each intersection, with the pair
of min-hashes as its signature, is one row. ``PAIRS`` pairs of functions are used.

Equal signatures across documents give candidates. Exact copies of a text are one text from the
start (the smallest doc_id stands for them). Of a signature's group every run is tried with the run
of the smallest doc_id, so a passage that m documents share costs m pairs, not m * m / 2. Pairs are
verified on the texts: every window of t shingles of a run counts if its Jaccard similarity with the
other's window aligned at the shared min-hash is ``THRESHOLD`` or more. Windows that fail (their group's first run was another
passage with the same signature) are grouped by their exact content, each with the first document
that has it. What is open then is tried with every earlier run of the signature's group, hits included,
that shares a prefix key: similar windows share one of the first shingles of each in one order of all
shingles, rare ones first (counted in hash buckets over the documents that have such a run), so that neither a
line all have nor the words all edits of a passage kept make pairs. The first that they share has a place in
each that their numbers of shingles allow, and a pair is made only on such a key. Keys that
``PIVOT_AT`` runs or more have go first with ``PIVOTS`` runs, the first of each of so many hash parts of their
documents: of many edits of a passage one of these is likely like the original there. Only windows still
open then meet all earlier runs with their keys. A window at similarity
0.8 shares a given pair with probability 0.64, one of five with 0.994, and a longer passage holds
many windows.

Result: doc_id, start_word, n_words, other_doc_id, other_start_word, similarity; one row per
maximal run of matching windows of doc_id with an earlier document (similarity: the smallest window's
that was verified), and one for the whole text of every copy.

Defined cases: null texts, texts of fewer than ``MIN_WORDS`` words and null doc_ids give no rows;
repeated rows of one doc_id and text are one document; of different texts under one doc_id the
one with the smallest hash is taken; a passage repeated only within one document is not reported.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from newsrisk.llm.common import checked_broadcast, write_table

MIN_WORDS = 50
SHINGLE_WORDS = 5
THRESHOLD = 0.8
PAIRS = 5
CHUNK = 1 << 17  # bytes of text hashed at a time: the arrays stay in the processor's cache
WINDOWS_AT_ONCE = 1 << 16
ROWS_AT_ONCE = 1 << 16
RARITY_BITS = 24  # log2 of the hash buckets that shingles are counted in
RARITY_PART_BITS = 14  # log2 of the buckets that are counted together
FILTER_BITS = 27  # log2 of the largest filter of shared signatures, in bits
#: Open windows meet up to this many of the earliest runs with one of their prefix keys first, if PIVOT_AT runs or more have it.
PIVOTS = 8
PIVOT_AT = 16

U = np.uint64
# odd multipliers of the word, shingle and min-hash functions
P_BYTE, P_WORD = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F
SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
SPACE_BYTES = SPACE.tobytes()
#: Signatures are counted in 2^BUCKET_BITS parts, of up to SIGS_AT_ONCE signatures of a task at a time.
BUCKET_BITS = 10
SIGS_AT_ONCE = 1 << 21
#: Starts per block in which keys meet the runs of their text.
BLOCK = 128


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    x = x ^ U(seed * 0x9E3779B97F4A7C15 % (1 << 64))  # a new array, the rest in place
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(29)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(32)
    return x


class Words:
    """Hashes of whole byte strings' words, by prefix sums of a polynomial and its inverse powers."""

    def __init__(self, size: int = 2 * CHUNK):
        self.grow(size)

    def grow(self, size: int):
        inverse = pow(P_BYTE, -1, 1 << 64)
        self.up, self.down = (np.cumprod(np.full(size, p, dtype=U)) for p in (P_BYTE, inverse))

    def piece(self, data: bytes) -> tuple[np.ndarray, np.ndarray]:
        """(word hashes, byte offsets of the words) of one piece."""
        x = np.frombuffer(data, dtype=np.uint8)
        if len(x) > len(self.up):
            self.grow(len(x))
        space = np.frombuffer(data.translate(SPACE_BYTES), dtype=bool)
        edge = np.flatnonzero(space[1:] != space[:-1]) + 1
        edge = np.concatenate(([0] if len(x) and not space[0] else [], edge, [len(x)] if len(x) and not space[-1] else [])).astype(np.int64)
        start, end = edge[::2], edge[1::2]
        total = np.zeros(len(x) + 1, dtype=U)
        np.cumsum((x.astype(U) + U(1)) * self.up[: len(x)], out=total[1:])
        return mix((total[end] - total[start]) * self.down[start] + (end - start).astype(U)), start

    def of(self, data: bytes) -> np.ndarray:
        """Word hashes of one text; a long one goes piece by piece, cut at white space."""
        data, out, at = data.lower(), [], 0
        while at < len(data):
            end = min(len(data), at + CHUNK)
            while end < len(data) and not SPACE[data[end]]:
                end += 1
            out.append(self.piece(data[at:end])[0])
            at = end
        return np.concatenate(out) if out else np.zeros(0, dtype=U)

    def many(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(word hashes of all texts, number of words per text)."""
        if sum(map(len, texts)) > CHUNK:
            each = [self.of(t) for t in texts]
            return np.concatenate(each) if each else np.zeros(0, dtype=U), np.array([len(e) for e in each])
        h, start = self.piece(b" ".join(texts).lower())
        edges = np.cumsum([len(t) + 1 for t in texts])
        return h, np.bincount(np.searchsorted(edges, start, side="right"), minlength=len(texts))


def shingle_hashes(words: np.ndarray, k: int = SHINGLE_WORDS) -> np.ndarray:
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, dtype=U)
    h = np.zeros(n, dtype=U)
    for j in range(k):
        h = h * U(P_WORD) + words[j : n + j]
    return mix(h)


def sliding_min(x: np.ndarray, t: int) -> np.ndarray:
    """Minimum of every window of t values."""
    width = 1
    while 2 * width <= t:
        x, width = np.minimum(x[:-width], x[width:]), 2 * width
    return np.minimum(x[: len(x) - (t - width)], x[t - width :]) if t > width else x


def signed_runs(sh: np.ndarray, owner: np.ndarray, t: int, pairs: int = PAIRS):
    """(pair, signature, owner, first start, last start) arrays of the runs of windows sharing two min-hashes.

    ``sh`` holds the shingles of several texts, ``owner`` their text; -1 marks shingles across two texts.
    """
    n = len(sh) - t + 1
    if n <= 0:
        return
    ok = (owner[:n] == owner[t - 1 :]) & (owner[:n] >= 0)
    for p in range(pairs):
        a, b = (sliding_min(mix(sh, 2 * p + i + 1), t) for i in (0, 1))
        new = np.concatenate(([True], (a[1:] != a[:-1]) | (b[1:] != b[:-1]) | (owner[1:n] != owner[: n - 1]) | ~ok[:-1])) & ok
        first = np.nonzero(new)[0]
        if len(first):
            stop = np.nonzero(~ok)[0]  # a run ends before the next one, or before a window that is none
            last = np.minimum(np.concatenate((first[1:], [n])), np.concatenate((stop, [n]))[np.searchsorted(stop, first)]) - 1
            yield p, mix(a[first] * U(3) + b[first], p + 101), owner[first], first, last


def signature_filter(sigs: DataFrame) -> np.ndarray | None:
    """Bits set for the signatures of the written table ``sigs``, 8 bits or more for each; None if they are too many."""
    n = sigs.count()
    bits = max(16, int(np.ceil(np.log2(8 * n + 1))))
    if bits > FILTER_BITS:
        return None
    word = F.shiftright("sig", 6).bitwiseAND(F.lit((1 << (bits - 6)) - 1))
    words = sigs.groupBy(word.alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(sig & 63 as int))")).alias("bits")).toArrow()
    out = np.zeros(1 << (bits - 6), dtype=U)
    out[words.column(0).to_numpy()] = words.column(1).to_numpy().view(U)
    return out


def chunk_runs(batches, t: int, pairs: int, k: int):
    """(ids, pair, signatures, index into ids, first, last) of the runs of the texts (doc, text) of Arrow batches, chunk by chunk."""
    hasher = Words()
    for b in batches:
        ids, data = b.column(0).to_numpy(), b.column(1).cast(pa.binary()).to_pylist()
        at = 0
        while at < len(data):
            end, size = at + 1, len(data[at])
            while end < len(data) and size + len(data[end]) + 1 < CHUNK:
                size += len(data[end]) + 1
                end += 1
            words, counts = hasher.many(data[at:end])
            edges = np.concatenate(([0], np.cumsum(counts)))
            text = np.repeat(np.arange(len(counts)), counts)
            sh = shingle_hashes(words, k)
            owner = np.where(text[: len(sh)] == text[k - 1 :], text[: len(sh)], -1)
            for p, sig, own, first, last in signed_runs(sh, owner, t, pairs):
                yield ids, p, sig, at + own, first - edges[own], last - edges[own]
            at = end


def signature_rows(texts: DataFrame, t: int, pairs: int = PAIRS, k: int = SHINGLE_WORDS, keep: np.ndarray | None = None) -> DataFrame:
    """(sig, pair, doc, first, last) of all runs of all texts; with ``keep`` of those in a signature_filter."""
    sent = None if keep is None else texts.sparkSession.sparkContext.broadcast(keep)
    kinds = pa.schema([("sig", pa.int64()), ("pair", pa.int8()), ("doc", pa.int64()), ("first", pa.int32()), ("last", pa.int32())])

    def batch(parts: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*parts)], schema=kinds)

    def run(batches):
        parts, size = [], 0
        for ids, p, sig, own, first, last in chunk_runs(batches, t, pairs, k):
            if sent is not None:
                held = sent.value
                at_bit = np.nonzero(held[(sig >> U(6)) & U(len(held) - 1)] >> (sig & U(63)) & U(1))[0]
                sig, own, first, last = sig[at_bit], own[at_bit], first[at_bit], last[at_bit]
            parts.append((sig.view(np.int64), np.full(len(sig), p, np.int8), ids[own], first.astype(np.int32), last.astype(np.int32)))
            size += len(sig)
            if size >= ROWS_AT_ONCE:
                yield batch(parts)
                parts, size = [], 0
        if parts:
            yield batch(parts)

    return texts.mapInArrow(run, "sig long, pair byte, doc long, first int, last int")


def repeated_signatures(texts: DataFrame, t: int, pairs: int = PAIRS, k: int = SHINGLE_WORDS) -> DataFrame:
    """(sig) of the signatures that two runs or more have.

    A task sends its signatures as sorted lists, one for each bucket of their leading bits (what it has twice or
    more, twice), so that the shuffle moves 8 bytes for each; a bucket's lists are sorted together.
    """

    def lists(parts: list[np.ndarray]) -> pa.RecordBatch:
        sig, n = np.unique(np.concatenate(parts), return_counts=True)
        sig = np.repeat(sig, np.minimum(n, 2))
        bucket = np.arange(1 << BUCKET_BITS)
        edge = np.append(np.searchsorted(sig, bucket.astype(U) << U(64 - BUCKET_BITS)), len(sig))
        held = np.nonzero(np.diff(edge))[0]
        sigs = pa.ListArray.from_arrays(pa.array(np.append(edge[held], len(sig)).astype(np.int32)), pa.array(sig.view(np.int64)))
        return pa.RecordBatch.from_arrays([pa.array(bucket[held].astype(np.int32)), sigs], names=["bucket", "sigs"])

    def run(batches):
        parts, size = [], 0
        for _, _, sig, *_ in chunk_runs(batches, t, pairs, k):
            parts.append(sig)
            size += len(sig)
            if size >= SIGS_AT_ONCE:
                yield lists(parts)
                parts, size = [], 0
        if size:
            yield lists(parts)

    def repeated(bucket: pa.Table) -> pa.Table:
        sig = np.sort(np.concatenate([c.flatten().to_numpy() for c in bucket["sigs"].chunks]))
        return pa.table({"sig": np.unique(sig[1:][sig[1:] == sig[:-1]])})

    return texts.mapInArrow(run, "bucket int, sigs array<long>").groupBy("bucket").applyInArrow(repeated, "sig long")


def distinct_texts(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(texts, copies): one document per text (doc, text), and (doc, of) of the others."""
    d = docs.select(F.col("doc_id").cast("long").alias("doc"), "text").where("doc is not null and text is not null")
    print_of = F.unhex(F.sha2(F.col("text").cast("binary"), 256))
    one = d.select("doc", print_of.alias("print")).groupBy("doc").agg(F.min("print").alias("print"), F.count("*").alias("n"))
    one = write_table(one, "text_prints")
    first = write_table(one.groupBy("print").agg(F.min("doc").alias("of"), F.count("*").alias("m")).where("m > 1").drop("m"), "first_docs")
    copies = write_table(one.join(first, "print").where("doc <> of").select("doc", "of"), "copies")
    texts = d.join(checked_broadcast(copies.select("doc"), 24), "doc", "left_anti")
    again = one.where("n > 1").select("doc", "print")
    if not again.isEmpty():  # ids with several rows: one row of the text that stands for them
        several = texts.withColumn("print", print_of).join(again, ["doc", "print"], "left_semi").dropDuplicates(["doc"])
        texts = texts.join(again.select("doc"), "doc", "left_anti").unionByName(several.select("doc", "text"))
    return texts, copies


FOUND = "doc_id long, other_doc_id long, start_word int, n_words int, other_start_word int, similarity double, kind byte, sig long, pair byte, content long"
# kinds of rows of verify(): reported spans, hit windows, failed windows of a run, failed windows' contents
# (start_word and n_words of the second and third: first and last start; other_start_word of the third: the run's first)
NEAR, HIT, FAILED, CONTENT = range(4)


def run_columns(column) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """Offsets and fields of an Arrow column of lists of runs (none for a null)."""
    values = column.flatten()
    fields = {f.name: v.to_numpy(zero_copy_only=False).astype(np.int64) for f, v in zip(values.type, values.flatten())}
    return np.concatenate(([0], np.cumsum(column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)))), fields


def min_places(x: np.ndarray, pair: np.ndarray, first: np.ndarray, t: int) -> np.ndarray:
    """Where the first min-hash of each run's pair of functions lies, in the run's first window."""
    out = np.zeros(len(first), np.int64)
    for p in np.unique(pair):
        own = np.nonzero(pair == p)[0]
        h = mix(x, 2 * int(p) + 1)
        out[own] = first[own] + np.argmin(h[first[own][:, None] + np.arange(t)], axis=1)
    return out


def covered(first: np.ndarray, last: np.ndarray, n: int) -> np.ndarray:
    """Which of n starts lie in some range."""
    return np.cumsum(np.bincount(first, minlength=n + 1) - np.bincount(last + 1, minlength=n + 1))[:n] > 0


def first_of_equals(rows: np.ndarray) -> np.ndarray:
    """Where a value of sorted rows is not the one before it."""
    return np.concatenate((np.ones((len(rows), 1), bool), rows[:, 1:] != rows[:, :-1]), axis=1)


def set_similarities(x: np.ndarray, a: np.ndarray, y: np.ndarray, b: np.ndarray, t: int) -> np.ndarray:
    """Jaccard similarities of the sets of t shingles that start in x at ``a`` and in y at ``b``."""
    out = np.zeros(len(a))
    of_x, of_y = (np.lib.stride_tricks.sliding_window_view(z, t) for z in (x, y))
    for at in range(0, len(a), WINDOWS_AT_ONCE // 8):
        part = slice(at, at + WINDOWS_AT_ONCE // 8)
        u, v = of_x[a[part]], of_y[b[part]]
        n, m, either = (first_of_equals(np.sort(rows, axis=1)).sum(axis=1) for rows in (u, v, np.concatenate((u, v), axis=1)))
        out[part] = (n + m - either) / either
    return out


def similarities(x: np.ndarray, y: np.ndarray, lo: int, hi: int, shift: int, t: int, threshold: float) -> tuple[np.ndarray, np.ndarray, bool]:
    """Of the windows of x that start at lo..hi the Jaccard similarity with y's window ``shift`` further on (held within y), its start, and whether no shingle repeats.

    Windows below the threshold may be given 0. A shingle of x at i that y has at j is common to the windows
    that hold both: a range of starts. Windows with repeated shingles are compared as sets.
    """
    starts = np.arange(lo, hi + 1)
    other = np.clip(starts + shift, 0, len(y) - t)
    px, py = x[lo : hi + t], y[other[0] : other[-1] + t]
    if other[0] == lo + shift and len(px) == len(py) and (px == py).all():
        return np.ones(len(starts)), other, False
    order = np.argsort(py, kind="stable")
    ordered = py[order]
    at = np.minimum(np.searchsorted(ordered, px), len(py) - 1)
    i = np.nonzero(ordered[at] == px)[0]
    ranked = np.sort(px)
    if (ordered[1:] == ordered[:-1]).any() or (ranked[1:] == ranked[:-1]).any():
        shared = np.zeros(len(px) + 1, np.int64)
        shared[i + 1] = 1
        shared = np.cumsum(shared)
        out = np.zeros(len(starts))
        own = np.concatenate(([0], np.cumsum(np.isin(px, ranked[1:][ranked[1:] == ranked[:-1]]))))
        ask = np.nonzero((shared[t:] - shared[:-t] >= threshold * t) | (own[t:] > own[:-t]))[0]
        out[ask] = set_similarities(x, lo + ask, y, other[ask], t)
        return out, other, False
    j = order[at[i]] + other[0]
    i = i + lo
    common = np.zeros(len(starts), np.int64)
    moving = np.nonzero(other == starts + shift)[0]
    if len(moving):
        s0, s1 = starts[moving[0]], starts[moving[-1]]
        first = np.maximum(np.maximum(i, j - shift) - t + 1, s0)
        last = np.minimum(np.minimum(i, j - shift), s1)
        ok = first <= last
        n = s1 - s0 + 2
        common[moving] = np.cumsum(np.bincount(first[ok] - s0, minlength=n) - np.bincount(last[ok] + 1 - s0, minlength=n))[: n - 1]
    for edge in (0, len(y) - t):  # windows of x that reach beyond an end of y
        held = np.nonzero((other == edge) & (other != starts + shift))[0]
        if len(held):
            inside = np.zeros(len(px) + 1, np.int64)
            inside[i[(j >= edge) & (j < edge + t)] - lo + 1] = 1
            inside = np.cumsum(inside)
            common[held] = inside[held + t] - inside[held]
    return common / (2 * t - common), other, True


def may_be_similar(x: np.ndarray, y: np.ndarray, asked: np.ndarray, t: int, threshold: float) -> np.ndarray:
    """Which of the asked windows of x may be similar to a window of y.

    A window of t distinct shingles must share threshold * t of them, and more if y has no shingle twice; one
    with a repeated shingle may always be.
    """
    out = np.zeros(len(asked), bool)
    starts = np.nonzero(asked)[0]
    if not len(starts):
        return out
    lo, n = starts[0], starts[-1] - starts[0] + 1
    px, ordered = x[lo : lo + n + t - 1], np.sort(y)
    missing = np.concatenate(([0], np.cumsum(ordered[np.minimum(np.searchsorted(ordered, px), len(y) - 1)] != px)))
    need = threshold * t if (ordered[1:] == ordered[:-1]).any() else 2 * t * threshold / (1 + threshold)
    may = missing[t:] - missing[:-t] <= t - int(np.ceil(need - 1e-9))
    ranked = np.sort(px)
    if (ranked[1:] == ranked[:-1]).any():
        order = np.argsort(px, kind="stable")
        same = px[order[1:]] == px[order[:-1]]
        i, j = order[:-1][same], order[1:][same]
        first, last = np.maximum(j - t + 1, 0), np.minimum(i, n - 1)
        may |= covered(first[first <= last], last[first <= last], n)
    out[lo : lo + n] = may
    return out & asked


def window_hashes(x: np.ndarray, at: np.ndarray, t: int) -> np.ndarray:
    """A hash of each window of t shingles that starts in ``at``, by prefix sums of a polynomial and its inverse powers."""
    lo = at[0]
    px, at = x[lo : at[-1] + t], at - lo
    up, down = (np.cumprod(np.concatenate(([U(1)], np.full(len(px) - 1, p, dtype=U)))) for p in (P_WORD, pow(P_WORD, -1, 1 << 64)))
    total = np.concatenate(([U(0)], np.cumsum(px * down)))
    return mix((total[at + t] - total[at]) * up[at + t - 1])


def matching_windows(x: np.ndarray, y: np.ndarray, runs: dict[str, np.ndarray], t: int, threshold: float):
    """Of two texts' shingles and their candidate runs: each start's best similarity (-1 below the threshold) and other start, and the starts tried.

    Runs with the same distance between their shared min-hashes are compared together. Windows that no window of y can be like are left out.
    """
    n = len(x) - t + 1
    best, place = np.full(n, -1.0), np.zeros(n, np.int64)
    tried = covered(runs["first"], runs["last"], n)
    may = may_be_similar(x, y, tried, t, threshold)
    count = np.concatenate(([0], np.cumsum(may)))
    some = count[runs["last"] + 1] > count[runs["first"]]
    runs = {name: v[some] for name, v in runs.items()}
    shift = min_places(y, runs["pair"], runs["ofirst"], t) - min_places(x, runs["pair"], runs["first"], t)
    for d in np.unique(shift).tolist():
        own = shift == d
        first, last = runs["first"][own], runs["last"][own]
        asked = covered(first, last, n) & may
        common = np.full(n, float(t))  # what a window may have in common with the other's
        for lo, hi in ranges(np.nonzero(asked & (best < 1.0))[0]):
            found, other, exact = similarities(x, y, lo, hi, d, t, threshold)
            better = np.nonzero((found >= threshold) & (found > best[lo : hi + 1]))[0]
            best[lo + better], place[lo + better] = found[better], other[better]
            if exact:
                common[lo : hi + 1] = 2 * t * found / (1 + found)
        held_within(x, y, first, last, runs["ofirst"][own], runs["olast"][own], d, t, threshold, common, best, place, may)
    return best, place, tried


def held_within(x, y, first, last, ofirst, olast, shift: int, t: int, threshold: float, common, best, place, may) -> None:
    """Windows without a match so far, with the nearest window of the other's run (text that turns round on itself has its match there).

    A window that lies d further on has at most d more shingles in common, so few are compared.
    """
    size = last - first + 1
    run = np.repeat(np.arange(len(first)), size)
    s = np.arange(len(run)) - np.repeat(np.cumsum(size) - size, size) + first[run]
    o = np.clip(s + shift, ofirst[run], olast[run])
    away = np.abs(s + shift - o)
    need = threshold * 2 * t / (1 + threshold) - 1e-9
    ask = np.nonzero((best[s] < 0) & may[s] & (away > 0) & (common[s] + away >= need))[0]
    a, b = np.divmod(np.unique(s[ask] * len(y) + o[ask]), len(y))
    j = set_similarities(x, a, y, b, t)
    for i in np.nonzero(j >= threshold)[0].tolist():
        if j[i] > best[a[i]]:
            best[a[i]], place[a[i]] = j[i], b[i]


def shingle_classes(texts: DataFrame, bits: int = RARITY_BITS, k: int = SHINGLE_WORDS) -> np.ndarray:
    """Each hash bucket's class: the logarithm of how many shingles of all ``texts`` (doc, text) fall into it, beyond the mean.

    Most shingles are one text's own; without the mean they would pass for as many as share their bucket.
    A task sends sorted lists of 2 bytes a shingle, as repeated_signatures() does; a class for each bucket comes back.
    """
    per_part = min(bits, RARITY_PART_BITS)
    kinds = pa.schema([("part", pa.int32()), ("buckets", pa.list_(pa.int16()))])

    def lists(parts: list[np.ndarray]) -> pa.RecordBatch:
        at = np.sort((np.concatenate(parts) >> U(64 - bits)).astype(np.uint32))
        edge = np.searchsorted(at, np.arange((1 << (bits - per_part)) + 1, dtype=np.uint64) << U(per_part))
        held = np.nonzero(np.diff(edge))[0]
        own = pa.array((at & np.uint32((1 << per_part) - 1)).astype(np.int16))
        return pa.RecordBatch.from_arrays([pa.array(held.astype(np.int32)), pa.ListArray.from_arrays(pa.array(np.append(edge[held], len(at)).astype(np.int32)), own)], schema=kinds)

    def run(batches):
        hasher, parts, size = Words(), [], 0
        for b in batches:
            for text in b.column(0).cast(pa.binary()):
                parts.append(shingle_hashes(hasher.of(text.as_py()), k))
                size += len(parts[-1])
                if size >= SIGS_AT_ONCE:
                    yield lists(parts)
                    parts, size = [], 0
        if size:
            yield lists(parts)

    def counted(part: pa.Table) -> pa.Table:
        n = sum(np.bincount(c.flatten().to_numpy(), minlength=1 << per_part) for c in part["buckets"].chunks)
        rarity = np.log2(np.maximum(n - n.mean(), 0) + 1).astype(np.uint8)
        return pa.table({"part": part["part"][:1], "classes": pa.array([rarity.tobytes()], pa.binary())})

    counts = texts.select("text").mapInArrow(run, "part int, buckets array<short>").groupBy("part").applyInArrow(counted, "part int, classes binary").toArrow()  # at most 2^bits bytes
    out = np.zeros((1 << (bits - per_part), 1 << per_part), dtype=np.uint8)
    for part, classes in zip(counts.column(0).to_pylist(), counts.column(1).to_pylist()):
        out[part] = np.frombuffer(classes, np.uint8)
    return out.ravel()


def rarity_rank(x: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """The order of shingles: by the class of their bucket, then by a hash."""
    bits = len(classes).bit_length() - 1
    return (classes[(x >> U(64 - bits)).astype(np.int64)].astype(U) << U(58)) | (mix(x, 77) >> U(6))


def prefix_islands(rank: np.ndarray, asked: np.ndarray, t: int, threshold: float, placed: bool = False):
    """(key, first start, last start, weak) of the asked windows: their first shingles in the order of ``rank``.

    Sets of similarity ``threshold`` share one of the first n - c + 1 elements in any order that both use, c being
    the least they can have in common. Two windows of t distinct shingles share more than a window with repeated ones may; the further
    keys that only such a window needs are ``weak``: they count in pairs with a row that is not weak.
    Successive windows with a key are one row. With ``placed`` also the number of shingles (n) of the windows and the key's place
    among them (from 0; 0 also for keys that every pair may use), which are the same in all windows of a row (see may_match()), and a ``space``: rows of
    space 0 meet such rows; the keys of windows with repeated shingles are there twice, as 2 to meet the weak ones, 1.
    """
    starts = np.nonzero(asked)[0]
    if len(starts) > WINDOWS_AT_ONCE:  # of a long text: part by part
        parts = []
        for at in range(0, len(starts), WINDOWS_AT_ONCE):
            own = starts[at : at + WINDOWS_AT_ONCE]
            some = np.zeros(len(asked), bool)
            some[own] = True
            lo, hi = own[0], own[-1]
            key, first, last, *more = prefix_islands(rank[lo : hi + t], some[lo : hi + 1], t, threshold, placed)
            parts.append((key, first + lo, last + lo, *more))
        return tuple(np.concatenate(c) for c in zip(*parts))
    windows = np.sort(np.lib.stride_tricks.sliding_window_view(rank, t)[starts], axis=1)
    width = lambda n: n - np.ceil(threshold * n - 1e-9).astype(np.int64) + 1
    near, far = t - int(np.ceil(2 * t * threshold / (1 + threshold) - 1e-9)) + 1, width(t)
    distinct = ~(windows[:, 1:] == windows[:, :-1]).any(axis=1)
    # (space, key, start, weak, number of shingles, place)
    own, at = windows[distinct], starts[distinct]
    parts = [(0, own[:, :near].ravel(), np.repeat(at, near), False, np.full(near * len(own), t), np.zeros(near * len(own), np.int64)), (1, own[:, near:far].ravel(), np.repeat(at, far - near), True, np.full((far - near) * len(own), t), np.tile(np.arange(near, far), len(own)))]
    if not distinct.all():  # the first keys of each of the others, without repeats
        others = windows[~distinct]
        place = np.cumsum(first_of_equals(others), axis=1)
        row, column = np.nonzero(first_of_equals(others) & (place <= width(place[:, -1])[:, None]))
        parts += [(space, others[row, column], starts[~distinct][row], False, place[row, -1], place[row, column] - 1) for space in (0, 2)]
    key = np.concatenate([mix(k, 211 + (space > 0)) for space, k, *_ in parts])
    space = np.concatenate([np.full(len(k), v, np.int64) for v, k, *_ in parts])
    weak = np.concatenate([np.full(len(k), w) for _, k, _, w, *_ in parts])
    at, size, place = (np.concatenate([p[i] for p in parts]) for i in (2, 4, 5))
    kind = (space * (t + 1) + size) * t + place
    order = np.lexsort((at, kind, key))
    key, at, weak, size, place, space, kind = (v[order] for v in (key, at, weak, size, place, space, kind))
    new = np.nonzero(np.concatenate(([True], (key[1:] != key[:-1]) | (kind[1:] != kind[:-1]) | (at[1:] > at[:-1] + 1))))[0] if len(key) else np.zeros(0, np.int64)
    end = np.append(new[1:], len(key)) - 1
    islands = key[new].view(np.int64), at[new], at[end] if len(new) else at[:0], weak[new], size[new], place[new], space[new]
    return islands if placed else islands[:4]


def may_match(threshold: float):
    """Whether two windows may share a key as the first one, in the order of ranks, that they have in common.

    Sets of n and m elements of similarity ``threshold`` have c or more in common: the first of these has a place of n - c at
    most in the one, m - c in the other.
    """
    common = (F.col("size") + F.col("osize")) * F.lit(threshold / (1 + threshold)) - F.lit(1e-9)
    return common <= F.least(F.col("size") - F.col("place"), F.col("osize") - F.col("oplace"))


def ranges(starts) -> list[tuple[int, int]]:
    """(first, last) of the runs of consecutive starts, which are in order."""
    at = np.asarray(starts, dtype=np.int64)
    if not len(at):
        return []
    cut = np.nonzero(np.diff(at) > 1)[0]
    return list(zip(at[np.concatenate(([0], cut + 1))].tolist(), at[np.concatenate((cut, [len(at) - 1]))].tolist()))


def spans(best: np.ndarray, place: np.ndarray, t: int, k: int):
    """Maximal runs of overlapping matching windows: arrays (start word, words, other start word, similarity)."""
    hit = np.nonzero(best >= 0)[0]
    new = np.nonzero(np.concatenate(([True], np.diff(hit) > t + k - 1)))[0] if len(hit) else hit
    last = hit[np.append(new[1:], len(hit)) - 1] if len(hit) else hit
    return hit[new], last + t + k - 1 - hit[new], place[hit[new]], np.minimum.reduceat(best[hit], new) if len(hit) else best[:0]


class Shingles:
    """Shingle hashes of documents, the latest ones kept."""

    def __init__(self, k: int, room: int = 4 << 20):
        self.hasher, self.k, self.room, self.size, self.kept = Words(), k, room, 0, {}

    def of(self, doc: int, text: bytes) -> np.ndarray:
        sh = self.kept.get(doc)
        if sh is None:
            sh = shingle_hashes(self.hasher.of(text), self.k)
            if self.size + len(sh) > self.room:
                self.size, self.kept = 0, {}
            self.size, self.kept[doc] = self.size + len(sh), sh
        return sh


def doc_pairs(b: pa.RecordBatch, shingles: Shingles):
    """(doc, other, their shingles, runs) of each row (doc, other, runs, text, other_text)."""
    edge, fields = run_columns(b["runs"])
    text, other_text = (b[c].cast(pa.binary()) for c in ("text", "other_text"))
    for n, (doc, other) in enumerate(zip(b["doc"].to_pylist(), b["other"].to_pylist())):
        own = {name: v[edge[n] : edge[n + 1]] for name, v in fields.items()}
        yield doc, other, shingles.of(doc, text[n].as_py()), shingles.of(other, other_text[n].as_py()), own


def verify(pairs: DataFrame, t: int, threshold: float, again: bool, k: int = SHINGLE_WORDS) -> DataFrame:
    """Spans of doc pairs (doc, other, runs, text, other_text).

    With ``again`` also what the next step takes: hit windows, and of runs whose group has more members the failed
    windows and their contents.
    """
    kinds = pa.schema([("doc_id", pa.int64()), ("other_doc_id", pa.int64()), ("start_word", pa.int32()), ("n_words", pa.int32()), ("other_start_word", pa.int32()), ("similarity", pa.float64()), ("kind", pa.int8()), ("sig", pa.int64()), ("pair", pa.int8()), ("content", pa.int64())])

    def batch(kind: int, rows: list[dict]) -> pa.RecordBatch:
        """One kind's rows, given as columns per doc pair; what is not given is null."""
        n = sum(len(r["doc_id"]) for r in rows)
        columns = {"kind": np.full(n, kind)} | {c: np.concatenate([r[c] for r in rows]) for c in (rows[0] if rows else ())}
        return pa.RecordBatch.from_arrays([pa.array(columns[f.name]).cast(f.type) if f.name in columns else pa.nulls(n, f.type) for f in kinds], schema=kinds)

    def run(batches):
        shingles = Shingles(k)
        for b in batches:
            out = {kind: [] for kind in (NEAR, HIT, FAILED, CONTENT)}
            for doc, other, x, y, runs in doc_pairs(b, shingles):
                best, place, tried = matching_windows(x, y, runs, t, threshold)
                start, words, other_start, low = spans(best, place, t, k)
                mine = lambda n: np.full(n, doc, np.int64)  # noqa: B023, E731
                out[NEAR].append({"doc_id": mine(len(start)), "other_doc_id": np.full(len(start), other, np.int64), "start_word": start, "n_words": words, "other_start_word": other_start, "similarity": low})
                if not again:
                    continue
                hits = np.array(ranges(np.nonzero(best >= 0)[0]), np.int64).reshape(-1, 2)
                out[HIT].append({"doc_id": mine(len(hits)), "start_word": hits[:, 0], "n_words": hits[:, 1]})
                failed = tried & (best < 0)
                fails = np.concatenate(([0], np.cumsum(failed)))
                count = fails[runs["last"] + 1] - fails[runs["first"]]
                more = np.nonzero((runs["n"] >= 3) & (count > 0))[0]
                if not len(more):
                    continue
                first, last = runs["first"][more], runs["last"][more]
                whole = count[more] == last - first + 1
                parts = [(np.nonzero(whole)[0], first[whole], last[whole])]
                for i in np.nonzero(~whole)[0].tolist():
                    own = np.array(ranges(first[i] + np.nonzero(failed[first[i] : last[i] + 1])[0]), np.int64)
                    parts.append((np.full(len(own), i), own[:, 0], own[:, 1]))
                of, a, z = (np.concatenate([p[i] for p in parts]) for i in range(3))
                out[FAILED].append({"doc_id": mine(len(of)), "start_word": a, "n_words": z, "other_start_word": first[of], "sig": runs["sig"][more][of], "pair": runs["pair"][more][of]})
                at = np.nonzero(failed & covered(first, last, len(failed)))[0]
                out[CONTENT].append({"doc_id": mine(len(at)), "start_word": at, "content": window_hashes(x, at, t).view(np.int64)})
            for kind, rows in out.items():
                if rows:
                    yield batch(kind, rows)

    return pairs.select("doc", "other", "runs", "text", "other_text").mapInArrow(run, FOUND)


PLACED = ("size", "place", "space")


def islands_of(held: DataFrame, classes: np.ndarray, t: int, threshold: float, k: int = SHINGLE_WORDS) -> DataFrame:
    """(content, doc, first, last, weak, size, place, space) of documents (doc, runs, text): the prefix keys of the windows of their runs."""
    sent = held.sparkSession.sparkContext.broadcast(classes)
    kinds = pa.schema([("content", pa.int64()), ("doc", pa.int64()), ("first", pa.int32()), ("last", pa.int32()), ("weak", pa.bool_()), ("size", pa.int16()), ("place", pa.int16()), ("space", pa.int8())])

    def run(batches):
        hasher = Words()
        for b in batches:
            out = [[] for _ in kinds]
            edge, fields = run_columns(b["runs"])
            for n, (doc, text) in enumerate(zip(b["doc"].to_pylist(), b["text"].cast(pa.binary()).to_pylist())):
                start, end = fields["first"][edge[n] : edge[n + 1]], fields["last"][edge[n] : edge[n + 1]]
                lo, hi = int(start.min()), int(end.max())
                rank = rarity_rank(shingle_hashes(hasher.of(text), k)[lo : hi + t], sent.value)
                key, first, last, *kind = prefix_islands(rank, covered(start - lo, end - lo, hi - lo + 1), t, threshold, True)
                for column, v in zip(out, (key, np.full(len(key), doc, np.int64), first + lo, last + lo, *kind)):
                    column.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)).cast(kd.type) if c else pa.nulls(0, kd.type) for c, kd in zip(out, kinds)], schema=kinds)

    return held.select("doc", "runs", "text").mapInArrow(run, "content long, doc long, first int, last int, weak boolean, size short, place short, space byte")


def keys_of(islands: DataFrame, runs: DataFrame) -> DataFrame:
    """(sig, content, doc, run, first, last, weak, size, place, space if given): all prefix keys of the runs (doc, runs) that another document's runs of the signature have too, not only as weak ones."""
    two = F.min("doc").alias("lo"), F.max("doc").alias("hi"), F.bool_and("weak").alias("weak")
    met = islands.groupBy("content").agg(*two).where("lo < hi and not weak").select("content")
    met = write_table(islands.join(write_table(met, "met_contents"), "content"), "met_islands")
    blocks = F.explode(F.expr(f"sequence(first div {BLOCK}, last div {BLOCK})")).alias("block")
    x = met.select("*", blocks).alias("x")
    y = runs.select("doc", F.explode("runs").alias("r")).select("doc", "r.*").select("*", blocks).alias("y")
    # a key and a run meet in the block of the first start that they share
    keys = x.join(y, ["doc", "block"]).where(f"x.first <= y.last and y.first <= x.last and block = greatest(x.first, y.first) div {BLOCK}")
    keys = keys.select("sig", "content", "doc", F.col("y.first").alias("run"), F.greatest("x.first", "y.first").alias("first"), F.least("x.last", "y.last").alias("last"), "weak", *(c for c in PLACED if c in islands.columns))
    keys = write_table(keys, "keys")
    live = keys.groupBy("sig", "content").agg(*two).where("lo < hi and not weak").select("sig", "content")
    return write_table(keys.join(write_table(live, "live_keys"), ["sig", "content"]), "met_keys")


def still_open(failed: DataFrame, done: DataFrame) -> DataFrame:
    """The rows (doc, sig, pair, run, first, last) of ``failed`` cut to the starts outside ``done`` (doc, first, last)."""
    kinds = pa.schema([("doc", pa.int64()), ("sig", pa.int64()), ("pair", pa.int8()), ("run", pa.int32()), ("first", pa.int32()), ("last", pa.int32())])

    def run(batches):
        for b in batches:
            (edge, asked), (done_edge, gone) = run_columns(b["asked"]), run_columns(b["gone"])
            of, first, last = [], [], []
            for n in range(b.num_rows):
                own, met = slice(edge[n], edge[n + 1]), slice(done_edge[n], done_edge[n + 1])
                a, z = asked["first"][own], asked["last"][own]
                size = max(z.max(), gone["last"][met].max(initial=0)) + 1
                left = ~covered(gone["first"][met], gone["last"][met], size)
                sums = np.concatenate(([0], np.cumsum(left)))
                count = sums[z + 1] - sums[a]
                whole = np.nonzero(count == z - a + 1)[0]
                of, first, last = [*of, edge[n] + whole], [*first, a[whole]], [*last, z[whole]]
                for i in np.nonzero((count > 0) & (count <= z - a))[0].tolist():
                    some = np.array(ranges(a[i] + np.nonzero(left[a[i] : z[i] + 1])[0]), np.int64)
                    of, first, last = [*of, np.full(len(some), edge[n] + i)], [*first, some[:, 0]], [*last, some[:, 1]]
            of, first, last = (np.concatenate([np.zeros(0, np.int64), *v]) for v in (of, first, last))
            doc = np.repeat(b["doc"].to_numpy(), np.diff(edge))
            rows = doc[of], asked["sig"][of], asked["pair"][of], asked["run"][of], first, last
            yield pa.RecordBatch.from_arrays([pa.array(c).cast(kd.type) for c, kd in zip(rows, kinds)], schema=kinds)

    a = failed.groupBy("doc").agg(F.collect_list(F.struct("sig", "pair", "run", "first", "last")).alias("asked"))
    g = done.groupBy("doc").agg(F.collect_set(F.struct("first", "last")).alias("gone"))
    return a.join(g, "doc", "left").select("doc", "asked", "gone").mapInArrow(run, "doc long, sig long, pair byte, run int, first int, last int")


TRIED = ("first", "last", "ofirst", "olast")


def asking_of(keys: DataFrame, left: DataFrame) -> DataFrame:
    """(sig, content, doc, run, pair, first, last, size, place, space), written: the prefix keys of the open windows ``left``."""
    x = keys.alias("x").join(left.alias("y"), ["doc", "sig", "run"]).where("x.first <= y.last and y.first <= x.last")
    return write_table(x.select("sig", "content", "doc", "run", "pair", F.greatest("x.first", "y.first").alias("first"), F.least("x.last", "y.last").alias("last"), *PLACED), "asking")


def answer_of(keys: DataFrame) -> DataFrame:
    """The rows of ``keys`` as those that others meet; space: whose."""
    space = F.when(F.col("space") > 0, 3 - F.col("space")).otherwise(0).cast("byte").alias("space")
    return keys.select("sig", "content", space, F.col("doc").alias("other"), *(F.col(c).alias(f"o{c}") for c in ("run", "first", "last", "size", "place")))


def key_pivots(keys: DataFrame, pivots: int = PIVOTS, pivot_at: int = PIVOT_AT) -> DataFrame:
    """answer_of() of the keys that ``pivot_at`` runs have, written: the first run of each of ``pivots`` parts."""
    part = F.pmod(F.xxhash64("doc"), F.lit(pivots)).alias("part")
    by_part = keys.groupBy("sig", "content", part).agg(F.min(F.struct("doc", "run", "first", "last", "weak", *PLACED)).alias("o"), F.count("*").alias("n"))
    by_key = by_part.groupBy("sig", "content").agg(F.collect_list("o").alias("o"), F.sum("n").alias("n")).where(F.col("n") >= pivot_at)  # at most `pivots`
    return write_table(answer_of(by_key.select("sig", "content", F.explode("o").alias("o")).select("sig", "content", "o.*")), "pivots")


def pairs_on_keys(asking: DataFrame, answer: DataFrame, threshold: float) -> DataFrame:
    """(doc, other, runs), written: runs of ``asking`` with the earlier documents' runs of ``answer`` that share a key at places where a similar pair may."""
    met = asking.join(answer, ["sig", "content", "space"]).where(F.expr("other < doc") & may_match(threshold)).groupBy("doc", "other", "sig", "pair", "run", "orun")
    met = met.agg(*(f(c).alias(c) for f, c in zip((F.min, F.max, F.min, F.max), TRIED)))
    # verify() gives failed windows of runs whose group (n) has more members: none here
    run = F.struct("pair", *TRIED, F.lit(0).cast("long").alias("sig"), F.lit(0).cast("long").alias("n"))
    return write_table(met.groupBy("doc", "other").agg(F.collect_set(run).alias("runs")), "late_pairs")


def with_texts(grouped: DataFrame, texts: DataFrame) -> DataFrame:
    """``grouped`` (doc, other, runs), a written table, with text and other_text."""
    wanted = write_table(grouped.select("doc").unionByName(grouped.select(F.col("other").alias("doc"))).distinct(), "wanted_docs")
    held = write_table(texts.join(checked_broadcast(wanted, 24), "doc", "left_semi"), "wanted_texts")
    return grouped.join(held, "doc").join(held.select(F.col("doc").alias("other"), F.col("text").alias("other_text")), "other")


def repeated_passages(docs: DataFrame, min_words: int = MIN_WORDS, threshold: float = THRESHOLD, pairs: int = PAIRS) -> DataFrame:
    """(doc_id, other_doc_id, start_word, n_words, other_start_word, similarity); see the module's text."""
    t = min_words - SHINGLE_WORDS + 1
    texts, copies = distinct_texts(docs)
    sigs = write_table(repeated_signatures(texts, t, pairs), "repeated")
    rows = signature_rows(texts, t, pairs, keep=signature_filter(sigs))
    rows = write_table(rows.join(sigs, "sig"), "shared_runs")
    shared = rows.groupBy("sig").agg(F.min(F.struct("doc", "first", "last")).alias("o"), F.max("doc").alias("hi"), F.count("*").alias("n")).where("o.doc <> hi")
    shared = shared.select("sig", F.col("o.doc").alias("other"), F.col("o.first").alias("ofirst"), F.col("o.last").alias("olast"), "n")
    met = rows.join(shared, "sig").where("doc <> other or first <> ofirst")
    grouped = met.groupBy("doc", "other").agg(F.collect_list(F.struct("pair", "first", "last", "ofirst", "olast", "sig", "n")).alias("runs"))
    grouped = write_table(grouped, "doc_pairs")
    columns = ["doc_id", "other_doc_id", "start_word", "n_words", "other_start_word", "similarity"]
    found = write_table(verify(with_texts(grouped.where("doc <> other"), texts), t, threshold, True), "found")
    near = found.where(F.col("kind") == NEAR).select(*columns)
    # failed windows: by exact content, each with the first document that has it
    lone = found.where(F.col("kind") == CONTENT).select("doc_id", "content", "start_word").distinct()
    first = lone.groupBy("content").agg(F.min(F.struct("doc_id", "start_word")).alias("o"), F.max("doc_id").alias("hi")).where("o.doc_id <> hi")
    first = write_table(first.select("content", F.col("o.doc_id").alias("other_doc_id"), F.col("o.start_word").alias("other_start_word")), "contents")
    words = F.lit(min_words)
    same = write_table(lone.join(first, "content").where("doc_id <> other_doc_id").select("doc_id", "other_doc_id", "start_word", "other_start_word"), "same_contents")
    line = Window.partitionBy("doc_id", "other_doc_id", "shift").orderBy("start_word")
    exact = same.withColumn("shift", F.col("start_word") - F.col("other_start_word"))
    exact = exact.withColumn("new", (F.col("start_word") - F.lag("start_word").over(line) > words).cast("int"))
    exact = exact.withColumn("island", F.sum(F.coalesce("new", F.lit(0))).over(line)).groupBy("doc_id", "other_doc_id", "shift", "island")
    exact = exact.agg(F.min("start_word").alias("start_word"), (F.max("start_word") - F.min("start_word") + words).alias("n_words"), F.min("other_start_word").alias("other_start_word")).select(*columns[:-1], F.lit(1.0).alias("similarity"))
    # what is left: with every earlier run of the signature's group that shares a prefix key, whether that run was a hit or not
    span = [F.col("doc_id").alias("doc"), F.col("start_word").alias("first")]
    failed = found.where(F.col("kind") == FAILED).select(*span, F.col("n_words").alias("last"), F.col("other_start_word").alias("run"), "sig", "pair")
    done = found.where(F.col("kind") == HIT).select(*span, F.col("n_words").alias("last")).unionByName(same.select(*span, F.col("start_word").alias("last")))
    left = write_table(still_open(failed, done), "still_open")
    sigs = checked_broadcast(write_table(left.select("sig").distinct(), "open_sigs"), 24)
    runs = grouped.select("doc", "other", F.explode("runs").alias("r")).withColumn("sig", F.col("r.sig")).join(sigs, "sig", "left_semi")
    runs = runs.groupBy("doc").agg(F.collect_list(F.struct("r.sig", "r.first", "r.last")).alias("runs"))
    runs = write_table(runs, "open_groups")
    held = write_table(runs.join(texts, "doc"), "open_texts")
    keys = keys_of(write_table(islands_of(held, shingle_classes(held), t, threshold), "islands"), runs)
    pivots = checked_broadcast(key_pivots(keys), 64)
    late = write_table(verify(with_texts(pairs_on_keys(asking_of(keys, left), pivots, threshold), texts), t, threshold, True), "found_by_pivots")
    hits = late.where(F.col("kind") == HIT).select(*span, F.col("n_words").alias("last"))
    asking = asking_of(keys, write_table(still_open(left, hits), "open_after_pivots"))
    last = write_table(verify(with_texts(pairs_on_keys(asking, answer_of(keys), threshold), texts), t, threshold, False), "late")
    late = late.where(F.col("kind") == NEAR).select(*columns).unionByName(last.select(*columns))
    plain = reduce(lambda text, space: F.replace(text, F.lit(space), F.lit(" ")), "\t\n\x0b\f\r", F.col("text"))
    sized = F.size(F.array_remove(F.split(plain, " "), ""))
    firsts = copies.select(F.col("of").alias("doc")).distinct()
    lengths = write_table(texts.join(checked_broadcast(write_table(firsts, "firsts"), 24), "doc", "left_semi").select("doc", sized.alias("n_words")), "lengths").where(F.col("n_words") >= min_words)
    whole = copies.join(lengths.withColumnRenamed("doc", "of"), "of").select(F.col("doc").alias("doc_id"), F.col("of").alias("other_doc_id"), F.lit(0).alias("start_word"), "n_words", F.lit(0).alias("other_start_word"), F.lit(1.0).alias("similarity"))
    return near.unionByName(exact).unionByName(late).unionByName(whole)
