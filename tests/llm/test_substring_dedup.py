import random

import numpy as np
import pytest
from helpers import awkward, frame, prose

from newsrisk.llm import substring_dedup as S

SF = "/root/testdata/sf0.001"


def shingles(text):
    w = text.lower().split()
    return [tuple(w[i : i + 5]) for i in range(len(w) - 4)]


def test_word_hashes_do_not_depend_on_how_texts_are_cut(monkeypatch):
    texts = [b"One two  three", b"", b" two\tthree\nOne ", b"x" * 50, "é è é".encode(), b"two"]
    h, counts = S.Words().many(texts)
    assert counts.tolist() == [3, 0, 3, 1, 3, 1] and len(set(h.tolist())) == 6
    assert h[1] == h[3] == h[10] and h[7] == h[9] and h[0] == h[5] and h[2] == h[4]
    monkeypatch.setattr(S, "CHUNK", 8)
    h2, counts2 = S.Words(16).many(texts)
    assert (h == h2).all() and (counts == counts2).all()


def test_runs_are_the_windows_that_share_both_min_hashes():
    rng = np.random.default_rng(0)
    for t in (1, 2, 5, 46):
        sh = rng.integers(0, 40, 300).astype(np.uint64)  # with ties
        owner = np.repeat([0, 1, -1, 2], [120, 60, 4, 116])
        for p, sig, own, first, last in S.signed_runs(sh, owner, t, 2):
            a, b = S.mix(sh, 2 * p + 1), S.mix(sh, 2 * p + 2)
            want = {}
            for s in range(len(sh) - t + 1):
                if len(set(owner[s : s + t].tolist())) == 1 and owner[s] >= 0:
                    want[s] = (owner[s], a[s : s + t].min(), b[s : s + t].min())
            assert {s for f, l in zip(first, last) for s in range(f, l + 1)} == set(want)
            for i, (f, l) in enumerate(zip(first, last)):
                assert len({want[s] for s in range(f, l + 1)}) == 1 and want[f][0] == own[i]
                assert l + 1 not in want or want[l + 1] != want[l]
            assert len({(int(x), want[f][1:]) for x, f in zip(sig, first)}) == len({want[f][1:] for f in first})


def planted(rng, n_docs=60):
    """(rows, {doc: (start, words, first doc)}): a shared passage of 55 words, one common line of 30 words, clean documents."""
    passage, line, rows, where = prose(rng, 55, 10**6), prose(rng, 30, 10**6), [], {}
    for i in range(n_docs):
        a, b = prose(rng, rng.randrange(0, 150), 10**6), prose(rng, rng.randrange(0, 150), 10**6)
        if i % 3 == 0:
            where[i] = len(a)
            rows.append((i, " ".join(a + passage + b)))
        elif i % 3 == 1:
            rows.append((i, " ".join(a + line + b)))
        else:
            rows.append((i, " ".join(a + b)))
    return rows, where


def test_exact_passages_are_found_and_clean_documents_left_alone(spark):
    rows, where = planted(random.Random(2))
    found = S.repeated_passages(frame(spark, rows)).collect()
    assert {r.doc_id for r in found} == set(where) - {0} and all(r.other_doc_id == 0 for r in found)
    for i in set(where) - {0}:  # a window may reach a few words over the passage's ends and still be similar
        (r,) = [r for r in found if r.doc_id == i]
        assert where[i] - 6 <= r.start_word <= where[i] and where[i] + 55 <= r.start_word + r.n_words <= where[i] + 61
        assert r.other_start_word - where[0] == r.start_word - where[i] and r.similarity >= 0.8


def test_passage_hidden_behind_a_common_line(spark):
    """The first document of a signature's group only shares the line; the others share a longer passage."""
    rng = random.Random(6)
    line = prose(rng, 30, 10**6)
    rows = [(i, " ".join(prose(rng, 60, 10**6) + line + prose(rng, 60, 10**6))) for i in range(3)]
    for n in range(4):
        tail = prose(rng, 25, 10**6)
        rows += [(10 + 2 * n + j, " ".join(prose(rng, 60, 10**6) + line + tail + prose(rng, 60, 10**6))) for j in range(2)]
    found = {(r.doc_id, r.other_doc_id) for r in S.repeated_passages(frame(spark, rows)).collect()}
    assert all(a >= 10 and a - b == 1 for a, b in found)
    reached = {x for p in found for x in p}
    assert {10 + i for i in range(8)} <= reached


def test_near_passages(spark):
    rng = random.Random(3)
    rows = []
    for i in range(30):
        p = prose(rng, 120, 10**6)
        q = list(p)
        q[rng.randrange(120)] = "edited"
        rows += [(2 * i, " ".join(prose(rng, 20, 10**6) + p)), (2 * i + 1, " ".join(q + prose(rng, 20, 10**6)))]
    found = S.repeated_passages(frame(spark, rows)).collect()
    pairs = {(r.doc_id, r.other_doc_id) for r in found}
    assert all(a - b == 1 and b % 2 == 0 for a, b in pairs) and len(pairs) == 30
    text = dict(rows)
    for r in found:  # every reported run holds windows that are similar enough
        a, b = shingles(text[r.doc_id])[r.start_word :][:46], shingles(text[r.other_doc_id])[r.other_start_word :][:46]
        assert len(set(a) & set(b)) / len(set(a) | set(b)) >= 0.8


def hidden(rng, passage):
    """The passage with random words before and after it."""
    return " ".join(prose(rng, 20, 10**6) + passage + prose(rng, 20, 10**6))


def edited(passage, i):
    return passage[:i] + [f"edit{i}"] + passage[i + 1 :]


def test_near_passages_behind_edited_copies(spark):
    """One-word edits are 0.8 from the original and less from each other; edits lead the signatures' groups."""
    rng, rows = random.Random(8), []
    for g in range(4):
        p = prose(rng, 50, 10**6)
        at = rng.sample(range(5, 45), 30)
        rows += [(100 * g + n, hidden(rng, edited(p, i))) for n, i in enumerate(at[:15])] + [(100 * g + 50, hidden(rng, p))]
        rows += [(100 * g + 60 + n, hidden(rng, edited(p, i))) for n, i in enumerate(at[15:])]
    found = S.repeated_passages(frame(spark, rows), pairs=8).collect()
    assert all(r.doc_id // 100 == r.other_doc_id // 100 and r.other_doc_id < r.doc_id for r in found)
    reached = {r.doc_id for r in found}
    assert {100 * g + n for g in range(4) for n in [50, *range(60, 75)]} <= reached


def test_enough_pairs_for_passages_at_the_threshold(spark):
    """Single windows at 0.804: at least 0.98 of them share one of the signatures."""
    rng, rows = random.Random(10), []
    for g in range(100):
        p = prose(rng, 50, 10**6)
        rows += [(2 * g, hidden(rng, p)), (2 * g + 1, hidden(rng, edited(p, rng.randrange(10, 40))))]
    found = {(r.doc_id, r.other_doc_id) for r in S.repeated_passages(frame(spark, rows)).collect()}
    assert found <= {(2 * g + 1, 2 * g) for g in range(100)} and len(found) >= 98


def test_signature_filter_keeps_all_it_was_made_of(spark):
    sig = np.random.default_rng(0).integers(-(2**63), 2**63 - 1, 5000)
    held = S.signature_filter(spark.createDataFrame([(int(x),) for x in sig], "sig long"))
    bit = lambda x: held[(x >> S.U(6)) & S.U(len(held) - 1)] >> (x & S.U(63)) & S.U(1)
    assert bit(sig.view(S.U)).all() and bit(S.mix(np.arange(5000, dtype=S.U))).mean() < 0.15


def test_overlapping_repeats_of_the_shortest_length(spark):
    """Document 2 repeats all of document 1's passage, document 3 its end and what follows it in document 2."""
    rng, rows = random.Random(9), []
    for g in range(0, 120, 10):
        p, tail = prose(rng, 50, 10**6), prose(rng, 10, 10**6)
        rows += [(g + 1, hidden(rng, p)), (g + 2, hidden(rng, p + tail)), (g + 3, hidden(rng, p[10:] + tail))]
    found = {(r.doc_id, r.other_doc_id) for r in S.repeated_passages(frame(spark, rows)).collect()}
    assert {(g + 2, g + 1) for g in range(0, 120, 10)} | {(g + 3, g + 2) for g in range(0, 120, 10)} <= found


def test_copies_hot_passage_and_awkward_documents(spark):
    rng = random.Random(4)
    passage = prose(rng, 70, 10**6)
    rows = [(100 + i, " ".join(prose(rng, 10, 10**6) + passage)) for i in range(100)] + [(500 + i, " ".join(passage * 2)) for i in range(50)] + awkward() + [(7, "other text")]
    found = S.repeated_passages(frame(spark, rows)).collect()
    per = {}
    for r in found:
        per.setdefault(r.doc_id, []).append(r)
    assert set(per) == {100 + i for i in range(1, 100)} | {500 + i for i in range(50)} | ({7} & set(per))
    assert len(found) < 600  # linear in the group, not its square
    assert all(per[500 + i][0].n_words == 140 and per[500 + i][0].other_doc_id == 500 for i in range(1, 50))


@pytest.mark.parametrize("rows", [[], [(1, "short text")], [(1, None), (2, None)]])
def test_nothing_to_find(spark, rows):
    assert S.repeated_passages(frame(spark, rows)).count() == 0


def jaccard(a, b):
    a, b = set(a.tolist()), set(b.tolist())
    return len(a & b) / len(a | b)


def test_sets_of_windows_are_compared_together():
    rng = np.random.default_rng(1)
    x, y = (rng.integers(0, 60, 200).astype(np.uint64) for _ in range(2))  # with repeats
    a, b = np.arange(150), rng.integers(0, 150, 150)
    assert S.set_similarities(x, a, y, b, 46).tolist() == [jaccard(x[i : i + 46], y[j : j + 46]) for i, j in zip(a, b)]


def test_windows_left_out_are_like_no_window_of_the_other():
    rng, t, left_out = np.random.default_rng(2), 20, 0
    for values in (30, 10**6):  # with repeated shingles, and without
        for size in (18, 25, 60):
            y = rng.integers(0, values, 80).astype(np.uint64)
            x = np.concatenate((rng.integers(0, values, 40).astype(np.uint64), y[5 : 5 + size], rng.integers(0, values, 40).astype(np.uint64)))
            x[50] = 10**7
            asked = rng.random(len(x) - t + 1) < 0.9
            may = S.may_be_similar(x, y, asked, t, 0.8)
            assert not (may & ~asked).any()
            left_out += (asked & ~may).sum()
            for i in np.nonzero(asked & ~may)[0]:
                assert max(jaccard(x[i : i + t], y[j : j + t]) for j in range(len(y) - t + 1)) < 0.8
    assert left_out > 100


def test_equal_windows_have_equal_hashes():
    x = np.random.default_rng(3).integers(0, 3, 400).astype(np.uint64)
    h = {}
    for lo in (0, 7, 60):  # whatever part of the text is asked for
        at = np.arange(lo, 380, 3)
        for i, v in zip(at.tolist(), S.window_hashes(x, at, 5).tolist()):
            h.setdefault(tuple(x[i : i + 5].tolist()), set()).add(v)
    assert len(h) > 100 and all(len(v) == 1 for v in h.values()) and len(set.union(*h.values())) == len(h)


def test_prefix_keys_of_windows_with_repeats():
    rng, t = np.random.default_rng(4), 20
    rank = rng.integers(0, 25, 90).astype(np.uint64)
    asked = rng.random(len(rank) - t + 1) < 0.7
    want = set()
    for i in np.nonzero(asked)[0].tolist():
        w = sorted(set(rank[i : i + t].tolist()))
        assert len(w) < t
        w = np.array(w[: len(w) - int(np.ceil(0.8 * len(w) - 1e-9)) + 1], dtype=np.uint64)
        want |= {(int(k), i) for far in (0, 1) for k in S.mix(w, 211 + far).view(np.int64)}
    key, first, last, weak = S.prefix_islands(rank, asked, t, 0.8)
    assert not weak.any() and {(int(k), s) for k, a, z in zip(key, first, last) for s in range(a, z + 1)} == want


def test_repeated_signatures_are_sent_as_lists(spark, monkeypatch):
    """Those that two runs have, of one task or of two, of one list or of several."""
    monkeypatch.setattr(S, "SIGS_AT_ONCE", 50)
    monkeypatch.setattr(S, "CHUNK", 2000)
    rng = random.Random(11)
    passage = prose(rng, 60, 10**6)
    rows = [(i, " ".join(prose(rng, 80, 10**6) + (passage if i % 4 == 0 else []))) for i in range(40)]
    texts = spark.createDataFrame(rows, "doc long, text string").repartition(3)
    sent = [r.sig for r in S.signature_rows(texts, 46).collect()]
    found = [r.sig for r in S.repeated_signatures(texts, 46).collect()]
    assert sorted(found) == sorted(s for s in set(sent) if sent.count(s) > 1) and found
    assert S.repeated_signatures(texts.where("doc < 0"), 46).count() == 0


def test_keys_meet_the_runs_of_their_document(spark, monkeypatch):
    """Across blocks, each pair once; keys of one document alone, or weak in all, are left out."""
    monkeypatch.setattr(S, "BLOCK", 4)
    islands = spark.createDataFrame([(7, 1, 2, 13, False), (7, 2, 5, 6, True), (8, 1, 3, 3, False), (9, 1, 0, 2, True), (9, 2, 0, 2, True)], "content long, doc long, first int, last int, weak boolean")
    runs = spark.createDataFrame([(1, [(50, 1, 12), (51, 13, 20), (50, 14, 30)]), (2, [(50, 0, 9), (52, 0, 9)])], "doc long, runs array<struct<sig: long, first: int, last: int>>")
    found = sorted(tuple(r) for r in S.keys_of(islands, runs).select("sig", "content", "doc", "run", "first", "last", "weak").collect())
    assert found == [(50, 7, 1, 1, 2, 12, False), (50, 7, 2, 0, 5, 6, True)]


def test_open_windows(spark):
    """Hits cut runs of failed windows, also into two."""
    failed = spark.createDataFrame([(1, 50, 0, 3, 3, 10), (1, 51, 1, 20, 20, 25), (2, 50, 0, 0, 0, 4), (3, 52, 0, 0, 0, 4)], "doc long, sig long, pair byte, run int, first int, last int")
    done = spark.createDataFrame([(1, 5, 6), (1, 6, 6), (1, 25, 90), (3, 0, 2), (3, 3, 9), (4, 0, 3)], "doc long, first int, last int")
    found = sorted(tuple(r) for r in S.still_open(failed, done).collect())
    assert found == [(1, 50, 0, 3, 3, 4), (1, 50, 0, 3, 7, 10), (1, 51, 1, 20, 20, 24), (2, 50, 0, 0, 0, 4)]


def test_similar_windows_meet_on_a_key_at_a_place_that_they_may_share(spark):
    """Every similar pair does, also windows with repeated shingles; a passage just too short makes no pair."""
    rng, t, threshold = np.random.default_rng(8), 20, 0.8
    base, rows = rng.integers(1, 1 << 40, 24).astype(np.uint64), []
    for _ in range(60):
        x = base.copy()
        x[rng.integers(0, 24, 2)] = rng.integers(1, 1 << 40, 2)
        x[rng.integers(0, 24, 2)] = x[rng.integers(0, 24, 2)]
        rows.append(x)
    windows = {(i, at): frozenset(x[at : at + t].tolist()) for i, x in enumerate(rows) for at in range(5)}
    keys = [(i, *map(int, r)) for i, x in enumerate(rows) for r in zip(*S.prefix_islands(x, np.ones(5, bool), t, threshold, True))]
    at = [(d, s, key, size, place, space) for d, key, a, z, _, size, place, space in keys for s in range(a, z + 1)]
    assert all(size == len(windows[d, s]) for d, s, _, size, _, _ in at)
    x = spark.createDataFrame(at, "d long, s int, key long, size int, place int, space int")
    y = x.selectExpr("d as od", "s as os", "key", "size as osize", "place as oplace", "if(space > 0, 3 - space, 0) as space")
    met = {tuple(r) for r in x.join(y, ["key", "space"]).where(S.may_match(threshold)).select("d", "s", "od", "os").distinct().collect()}
    similar = {(*a, *b) for a, v in windows.items() for b, w in windows.items() if len(v & w) >= threshold * len(v | w) - 1e-9}
    assert similar <= met and len(similar) > 5 * len(windows) and len({len(w) for w in windows.values()}) > 2


def test_pairs_of_windows_that_share_too_little_are_not_made(spark):
    """Windows with a repeated shingle that share 39 of 46 with all others met them on spare keys, m * m / 2 pairs."""
    rng, t = np.random.default_rng(9), 46
    passage, islands = rng.integers(1 << 40, 1 << 41, 39).astype(np.uint64), []
    for doc in range(40):
        own = rng.integers(1, 1 << 40, 7).astype(np.uint64)
        own[0] = own[1] if doc % 2 else own[0]
        key, first, last, *kind = S.prefix_islands(np.concatenate((own, passage)), np.ones(1, bool), t, 0.8, True)
        islands += [(int(k), doc, 0, 0, *(v.item() for v in r)) for k, r in zip(key, zip(*kind))]
    islands = spark.createDataFrame(islands, "content long, doc long, first int, last int, weak boolean, size short, place short, space byte")
    docs = spark.range(40).withColumnRenamed("id", "doc")
    keys = S.keys_of(islands, docs.selectExpr("doc", "array(named_struct('sig', 5L, 'first', 0, 'last', 0)) as runs"))
    asking = S.asking_of(keys, docs.selectExpr("doc", "5L as sig", "0Y as pair", "0 as run", "0 as first", "0 as last"))
    assert asking.count() > 100
    assert S.pairs_on_keys(asking, S.answer_of(keys), 0.8).count() == 0


def test_classes_of_shingles_do_not_count_the_others_in_their_bucket(spark, monkeypatch):
    """Counted in parts, from lists of several tasks; a text's own shingles are rarest however full the buckets are."""
    monkeypatch.setattr(S, "RARITY_PART_BITS", 4)
    monkeypatch.setattr(S, "SIGS_AT_ONCE", 500)
    rng = random.Random(12)
    passage = prose(rng, 30, 10**6)
    texts = [" ".join(prose(rng, 60, 10**6) + passage) for _ in range(80)]
    found = S.shingle_classes(spark.createDataFrame([(t,) for t in texts], "text string").repartition(3), bits=10)
    x = [S.shingle_hashes(S.Words().of(t.encode())) for t in texts]
    n = np.bincount((np.concatenate(x) >> np.uint64(54)).astype(int), minlength=1 << 10).reshape(-1, 16)
    assert (found == np.log2(np.maximum(n - n.mean(axis=1, keepdims=True), 0) + 1).astype(np.uint8).ravel()).all()
    ranks = [S.rarity_rank(v, found) for v in x]
    assert np.mean([r[:56].max() < r[-26:].min() for r in ranks]) < 1 and np.mean([np.median(r[:56]) < r[-26:].min() for r in ranks]) == 1
