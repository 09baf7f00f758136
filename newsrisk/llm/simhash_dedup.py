"""SimHash near-dedup: pigeonhole blocks, a join on the blocks, Hamming check, components.

Links fingerprints that differ in at most ``MAX_BITS`` bits. 64 bits are cut into six blocks; at
most three differing bits touch at most three of them, so two linked fingerprints agree on some
choice of three whole blocks (20 choices of about 32 bits). Within a bucket the fingerprint with
the most documents is the pivot: members near it are linked to it alone, and only members far
from it are compared with the whole bucket. Members near the same pivot are already connected, so
no link between classes is lost and a group of m near copies costs m rows, not m * m / 2.

Defined cases: null and blank texts have fingerprint zero and are linked like any other; equal
fingerprints are one class from the start; repeated rows give repeated result rows; a null doc_id
keeps its row and takes the component of its fingerprint (null if no member has an id).
"""

from __future__ import annotations

from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsrisk.llm.common import checked_broadcast, components, documents_of, write_table

SHINGLE_WORDS = 3
MAX_BITS = 3
SEED = 42
UNPACK_ROWS = 1 << 16


def simhash(data: bytes | None, k: int = SHINGLE_WORDS) -> int:
    """64-bit SimHash (as a signed long) of the k-word shingles of UTF-8 ``data``; repeats count."""
    import xxhash

    words = (data or b"").lower().split()  # bytes: lowers A-Z only, splits at \x20 \x09-\x0D only
    if not words:
        return 0
    shingles = map(b" ".join, zip(*(words[i:] for i in range(k)))) if len(words) >= k else [b" ".join(words)]
    n = max(1, len(words) - k + 1)
    h = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), dtype=np.uint64, count=n)
    votes = np.zeros(64, dtype=np.int64)
    for i in range(0, n, UNPACK_ROWS):
        rows = h[i : i + UNPACK_ROWS].view(np.uint8).reshape(-1, 8)
        votes += np.unpackbits(rows, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * votes > n, bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, k: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, fp long) of every document, in one map over the texts."""

    def run(batches):
        for b in batches:
            texts = b.column(1).cast(pa.binary())
            fps = [simhash(t.as_py(), k) for t in texts]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps, pa.int64())], names=["doc_id", "fp"])

    return documents_of(docs, "doc_id", "text").mapInArrow(run, "doc_id long, fp long")


def block_masks(max_bits: int = MAX_BITS) -> list[int]:
    """Masks of the block choices: 2 * max_bits blocks, of which max_bits stay equal."""
    n = 2 * max_bits
    edges = [round(64 * i / n) for i in range(n + 1)]
    blocks = [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:])]
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    return [signed(sum(c)) for c in combinations(blocks, n - max_bits)]


def near_links(classes: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Links (u, v) that connect all fingerprints within ``max_bits``; classes: (fp, n)."""
    masks = F.array(*(F.struct(F.lit(i).alias("choice"), F.lit(m).alias("mask")) for i, m in enumerate(block_masks(max_bits))))
    keyed = classes.select("fp", "n", F.explode(masks).alias("b")).select("fp", "n", F.col("b.choice").alias("choice"), F.col("fp").bitwiseAND(F.col("b.mask")).alias("key"))
    pivots = keyed.groupBy("choice", "key").agg(F.max(F.struct("n", "fp")).alias("p"), F.count("*").alias("m")).where("m > 1")
    pivots = write_table(pivots.select("choice", "key", F.col("p.fp").alias("pivot")), "pivots")
    members = keyed.join(pivots, ["choice", "key"]).select("choice", "key", "fp", "pivot", (F.bit_count(F.col("fp").bitwiseXOR(F.col("pivot"))) <= max_bits).alias("near"))
    members = write_table(members, "members")
    star = members.where("near and fp <> pivot").select(F.col("fp").alias("u"), F.col("pivot").alias("v"))
    a = members.where("not near").select("choice", "key", F.col("fp").alias("u"))
    b = members.select("choice", "key", F.col("fp").alias("v"))
    rest = a.join(b, ["choice", "key"]).where((F.col("u") != F.col("v")) & (F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= max_bits))
    return star.unionByName(rest.select("u", "v")).distinct()


def simhash_components(docs: DataFrame, k: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """(doc_id, fingerprint hex, component_id): component_id is the smallest doc_id reachable."""
    fps = write_table(fingerprints(docs, k), "fingerprints")
    classes = write_table(fps.groupBy("fp").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")), "classes")
    roots = components(near_links(classes.select("fp", "n"), max_bits))
    placed = classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    placed = write_table(placed, "placed")
    smallest = write_table(placed.groupBy("root").agg(F.min("first").alias("component_id")), "smallest")
    by_fp = write_table(placed.select("fp", "root").join(smallest, "root").select("fp", "component_id"), "by_fp")
    return fps.join(by_fp, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, k: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """The documents that stay: of each component the one with the smallest doc_id.

    Repeated rows of a kept id all stay; rows without an id stay.
    """
    found = write_table(simhash_components(docs, k, max_bits), "components")
    gone = found.where("doc_id <> component_id").select("doc_id").distinct()
    return docs.join(checked_broadcast(gone, 24), "doc_id", "left_anti").select(docs.columns)
