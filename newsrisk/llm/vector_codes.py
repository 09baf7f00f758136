"""Vector code compression: product codes whose codebooks are refined over Hilbert-sorted blocks.

1. Components become integers, floor(4096 x); a vector is cut into ``PARTS`` equal consecutive parts.
2. Blocks. For each part position the parts are sorted along a Hilbert curve (Spark's range
   partitioning; the row number breaks ties, so equal parts spread over partitions) and cut into flat blocks of at most
   ``BLOCK`` parts. A block is one row: its components back to back, their minimum and maximum per
   axis (the box), their sums, and the numbers of their rows.
3. A round. From a block's box follow the least and the most squared distance that an entry can have to any of
   its parts; only entries whose least is within the smallest most can be nearest to one of them. A
   block with a single such entry adds its stored sums to it; for the others a small kernel in 64-bit
   integers compares the parts with the entries of the shortlist. Tasks give sums per entry, Spark adds
   them up, and the driver, which holds the codebooks (entries x dimensions), floors the means.
4. Codes. After ``ROUNDS`` rounds every part is assigned once more the same way; a row's parts meet by
   its number. Codes, errors and codebooks are exact: no float is used and ties go to the lower index.

Defined cases: rows whose vector is null or holds a null or non-finite component are dropped, and so are vectors of
another length than most (the shorter length on a tie) and empty ones; a length that is no multiple of ``PARTS`` is filled up with
zeros; components beyond +-``REACH`` count as that (sums stay exact in 64 bits for up to 1,024 dimensions); repeated rows
are rows like any other, a null vec_id sorts last; with fewer rows than entries the codebooks have
as many entries as rows; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsrisk.llm.common import checked_broadcast, write_table
from newsrisk.llm.hilbert import grid, hilbert_keys

#: The scale of the integers, the parts, the entries of a codebook, the rounds.
SCALE = 4096
PARTS = 8
ENTRIES = 16
ROUNDS = 6
REACH = 8192.0
BLOCK = 256


def integers(vectors: DataFrame) -> DataFrame:
    """(rid, vec_id, label, q), written: the kept rows, numbered, with integer components."""
    v = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "label", F.col("embedding").cast("array<double>").alias("x"))
    inf = float("inf")
    v = v.where(F.col("x").isNotNull() & F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(inf))))
    reach = lambda c: F.least(F.greatest(c, F.lit(-REACH)), F.lit(REACH))
    v = v.select("vec_id", "label", F.transform("x", lambda c: F.floor(reach(c) * SCALE).cast("int")).alias("q")).where(F.size("q") > 0)
    v = write_table(v, "integers")
    most = v.groupBy(F.size("q").alias("d")).count().orderBy(F.desc("count"), "d").first()
    return write_table(v.where(F.size("q") == (most["d"] if most else 0)).withColumn("rid", F.monotonically_increasing_id()), "numbered")


def cut(vectors: np.ndarray, parts: int) -> np.ndarray:
    """rows x dimensions -> rows x parts x width, filled up with zeros."""
    width = -(-vectors.shape[1] // parts)
    return np.pad(vectors, ((0, 0), (0, width * parts - vectors.shape[1]))).reshape(len(vectors), parts, width)


def matrix(column) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0), np.int32)


def binary(rows: np.ndarray) -> pa.Array:
    """Each row's bytes as one binary value."""
    rows = np.ascontiguousarray(rows)
    step = rows.nbytes // max(1, len(rows))
    offsets = np.arange(len(rows) + 1, dtype=np.int64) * step
    return pa.Array.from_buffers(pa.large_binary(), len(rows), [None, pa.py_buffer(offsets), pa.py_buffer(rows)]).cast(pa.binary())


def blocks(rows: DataFrame, dimensions: int, parts: int = PARTS, size: int = BLOCK) -> DataFrame:
    """(part, lo, hi, sums, flat, rids), written: the Hilbert-sorted blocks of every part position."""
    width = -(-dimensions // parts)
    reach = float(rows.agg(F.percentile_approx(F.array_max(F.transform("q", lambda c: F.abs(c))), 0.99)).first()[0])

    def keyed(batches):
        for b in batches:
            x = cut(matrix(b.column(1)), parts) if len(b) else np.zeros((0, parts, width), np.int32)
            for p in range(parts):
                key = hilbert_keys(*grid(x[:, p].astype(float), reach))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(b), p, np.int32)), pa.array(key), b.column(0), binary(x[:, p].astype(np.int32))], names=["part", "key", "rid", "x"])

    def packed(batches):
        for b in batches:
            part, rid = b.column(0).to_numpy(), b.column(2).to_numpy()
            x = np.frombuffer(b"".join(b.column(3).to_pylist()), np.int32).reshape(len(b), width)
            out = []
            ends = [*(np.nonzero(np.diff(part))[0] + 1).tolist(), len(part)]
            at = 0
            for end in ends:
                while at < end:
                    to = min(at + size, end)
                    y = x[at:to]
                    out.append((int(part[at]), y.min(axis=0).tolist(), y.max(axis=0).tolist(), y.sum(axis=0, dtype=np.int64).tolist(), y.tobytes(), rid[at:to].astype(np.int64).tobytes()))
                    at = to
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in out], t) for i, t in enumerate((pa.int32(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.binary(), pa.binary()))],
                names=["part", "lo", "hi", "sums", "flat", "rids"])

    order = ["part", "key", "rid"]
    by_curve = rows.select("rid", "q").mapInArrow(keyed, "part int, key long, rid long, x binary").repartitionByRange(*order).sortWithinPartitions(*order)
    return write_table(by_curve.mapInArrow(packed, "part int, lo array<int>, hi array<int>, sums array<long>, flat binary, rids binary"), "blocks")


def shortlists(lo: np.ndarray, hi: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """blocks x entries: whether an entry can be nearest to some point of a block's box."""
    lo, hi, c = (x.astype(np.int64) for x in (lo[:, None], hi[:, None], entries[None]))
    least = (np.maximum(np.maximum(lo - c, c - hi), 0) ** 2).sum(axis=2)
    most = (np.maximum(np.abs(c - lo), np.abs(hi - c)) ** 2).sum(axis=2)
    return least <= most.min(axis=1, keepdims=True)


def nearest(x: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each row's nearest entry (the lower index on a tie) and its squared distance, in 64-bit integers."""
    d = (entries**2).sum(axis=1)[None] - 2 * (x @ entries.T)
    at = np.argmin(d, axis=1)
    return at, d[np.arange(len(x)), at] + (x**2).sum(axis=1)


def listed(batch: pa.RecordBatch, books: np.ndarray):
    """(part, shortlist, flat, sums, rids) of each block of the batch; the last three as far as the batch has them."""
    part = batch["part"].to_numpy()
    lo, hi = matrix(batch["lo"]), matrix(batch["hi"])
    names = batch.schema.names
    sums = matrix(batch["sums"]) if "sums" in names else None
    short = np.zeros((len(part), books.shape[1]), bool)
    for p in np.unique(part):
        short[part == p] = shortlists(lo[part == p], hi[part == p], books[p])
    for i in range(len(part)):
        yield int(part[i]), np.nonzero(short[i])[0], batch["flat"][i], None if sums is None else sums[i], batch["rids"][i] if "rids" in names else None


def points(flat, width: int) -> np.ndarray:
    return np.frombuffer(flat.as_buffer(), np.int32).reshape(-1, width).astype(np.int64)


def entry_sums(table: DataFrame, books: np.ndarray) -> np.ndarray:
    """parts x entries x (1 + width): of the parts assigned to each entry their number and sums."""
    parts, entries, width = books.shape

    def run(batches):
        total = np.zeros((parts, entries, width + 1), np.int64)
        for b in batches:
            for p, short, flat, sums, _ in listed(b, books) if len(b) else ():
                if len(short) == 1:  # the whole block is nearest to this entry
                    total[p, short[0], 0] += len(flat.as_buffer()) // (4 * width)
                    total[p, short[0], 1:] += sums
                    continue
                x = points(flat, width)
                at = nearest(x, books[p][short])[0]
                for j, e in enumerate(short):
                    total[p, e, 0] += (at == j).sum()
                    total[p, e, 1:] += x[at == j].sum(axis=0)
        where = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(np.ravel_multi_index(where, total.shape).astype(np.int64)), pa.array(total[where])], names=["at", "value"])

    out = np.zeros(parts * entries * (width + 1), np.int64)
    for at, value in table.select("part", "lo", "hi", "sums", "flat").mapInArrow(run, "at long, value long").groupBy("at").sum("value").collect():
        out[at] = value  # at most one row per entry and axis
    return out.reshape(parts, entries, width + 1)


def first_books(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES) -> np.ndarray:
    """parts x entries x width: the parts of the rows with the smallest ids."""
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "q").select("q").limit(entries).collect()
    return cut(np.array([r[0] for r in first], np.int64), parts).transpose(1, 0, 2)


def refined(table: DataFrame, books: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """The codebooks after ``rounds`` rounds; entries that nothing is assigned to stay."""
    for _ in range(rounds):
        found = entry_sums(table, books)
        n = found[:, :, :1]
        books = np.where(n > 0, found[:, :, 1:] // np.maximum(n, 1), books)  # // floors
    return books


def coded(table: DataFrame, books: np.ndarray) -> DataFrame:
    """(rid, code, error): each row's entry indexes, eight bits a part, and its summed squared distances."""
    parts, _, width = books.shape

    def run(batches):
        for b in batches:
            rid, code, error = [], [], []
            for p, short, flat, _, rids in listed(b, books) if len(b) else ():
                at, d = nearest(points(flat, width), books[p][short])
                rid.append(np.frombuffer(rids.as_buffer(), np.int64))
                code.append((short[at].astype(np.uint64) << np.uint64(8 * (parts - 1 - p))).view(np.int64))
                error.append(d)
            if rid:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in (rid, code, error)], names=["rid", "code", "error"])

    found = table.select("part", "lo", "hi", "flat", "rids").mapInArrow(run, "rid long, code long, error long")
    return found.groupBy("rid").agg(F.bit_or("code").alias("code"), F.sum("error").alias("error"))


def digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def compress(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) of every kept row; up to 8 parts and 256 entries."""
    rows = integers(vectors)
    some = rows.select(F.size("q")).first()
    if some is None:
        return rows.select("vec_id", F.lit("").alias("code"), *(F.lit(0).cast("long").alias(c) for c in ("error", "label_error")), F.lit("").alias("codebooks_sha256"))
    table = blocks(rows, some[0], parts)
    books = refined(table, first_books(rows, parts, entries), rounds)
    code = F.lower(F.lpad(F.hex("code"), 2 * parts, "0"))
    found = coded(table, books).select("rid", code.alias("code"), "error")
    out = write_table(rows.select("rid", "vec_id", "label").join(found, "rid").drop("rid"), "codes")
    labels = write_table(out.groupBy("label").agg(F.sum("error").alias("label_error")), "label_errors")
    labels = checked_broadcast(labels.withColumnRenamed("label", "_label"), 64)
    out = out.join(labels, F.col("label").eqNullSafe(F.col("_label")))
    return out.select("vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))
