import random

import pytest
import xxhash
from helpers import awkward, frame, prose, union_find

from newsrisk.llm import simhash_dedup as S
from newsrisk.llm.common import components

SF = "/root/testdata/sf0.001"


def plain(text, k=3):
    words = [w for w in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").translate({9: " ", 10: " ", 11: " ", 12: " ", 13: " "}).split(" ") if w]
    if not words:
        return 0
    sh = [" ".join(words[i : i + k]) for i in range(len(words) - k + 1)] or [" ".join(words)]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute(rows, bits=3):
    fps = [plain(t) for _, t in rows]
    edges = [(a, b) for a in range(len(rows)) for b in range(a) if (fps[a] ^ fps[b]).bit_count() <= bits]
    root = union_find(edges, range(len(rows)))
    first = {}
    for n, (i, _) in enumerate(rows):
        if i is not None:
            first[root[n]] = min(i, first.get(root[n], i))
    return sorted(((i, f"{fps[n]:016x}", first.get(root[n])) for n, (i, _) in enumerate(rows)), key=str)


def got(df):
    return sorted(((r.doc_id, r.fingerprint, r.component_id) for r in df.collect()), key=str)


def test_fingerprint_of_one_text():
    for t in ("", "One", "A b", "a B c", "a b c d a b c d", "É è x\x1cy z w", "x " * 100_000):
        assert S.simhash(t.encode()) % (1 << 64) == plain(t)
    assert S.simhash(None) == 0


def test_every_close_pair_shares_a_block_choice():
    rng, masks = random.Random(0), S.block_masks()
    assert len(masks) == 20
    for _ in range(300):
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), 3):
            b ^= 1 << bit
        assert any((a ^ b) & (m % (1 << 64)) == 0 for m in masks)


def test_components_on_the_test_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert got(S.simhash_components(docs)) == brute([(r.doc_id, r.text) for r in docs.collect()])


def test_awkward_documents(spark):
    rows = awkward()
    assert got(S.simhash_components(frame(spark, rows))) == brute(rows)
    assert S.simhash_components(frame(spark, [])).count() == 0


def test_group_of_near_copies_and_what_stays(spark):
    rng = random.Random(5)
    base = prose(rng, 400)
    rows = [(i, " ".join(w if rng.random() > 0.004 else "edit" for w in base)) for i in range(150)]
    rows += [(200 + i, " ".join(prose(rng, 60))) for i in range(50)] + [(1000, rows[3][1])]
    want = brute(rows)
    docs = frame(spark, rows)
    assert got(S.simhash_components(docs)) == want
    stays = S.keep_one(docs)
    assert stays.columns == docs.columns and sorted(r.doc_id for r in stays.collect()) == sorted(i for i, _, c in want if i == c)


@pytest.mark.parametrize("shape", ["path", "star", "random", "cycle", "none"])
def test_connected_components(spark, shape):
    rng, n = random.Random(2), 300
    edges = {"path": [(i, i + 1) for i in range(n)], "star": [(0, i) for i in range(1, n)], "random": [(rng.randrange(n), rng.randrange(n)) for _ in range(200)], "cycle": [(i, (i + 1) % n) for i in range(n)], "none": []}[shape]
    found = {r.node: r.root for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    nodes = {x for e in edges if e[0] != e[1] for x in e}
    want = union_find(edges, {x for e in edges for x in e})
    assert found.keys() == nodes
    assert {frozenset(x for x in nodes if found[x] == r) for r in set(found.values())} == {frozenset(x for x in nodes if want[x] == r) for r in {want[x] for x in nodes}}
