"""op7 and op10: the automaton's and the trie's best paths against plain dynamic programming and the library."""

import random

import pytest
from helpers import awkward, frame

from newsrisk.llm import sentencepiece_codec as C
from newsrisk.llm import token_counts as N
from newsrisk.llm.pieces import MODEL_FILE, load

SF = "/root/testdata/sf0.001"
TEXTS = ["", "a", "Hello, world!", "  two  spaces ", "line\nline\n\n", "naïve 日本語 \U0001f600 ▁ tab\tend\r\n", "x" * 3000, "éè" * 50, " ", "\n", "the the the"]


@pytest.fixture(scope="module")
def vocabulary():
    return load()


def varint(data, at):
    x = shift = 0
    while True:
        x |= (data[at] & 0x7F) << shift
        at += 1
        if not data[at - 1] & 0x80:
            return x, at
        shift += 7


def as_unigram(path):
    """The model file with its type set to unigram (trainer_spec.model_type, field 3 of field 2)."""
    data, at = bytearray(open(path, "rb").read()), 0
    while at < len(data):
        tag, at = varint(data, at)
        if tag & 7 != 2:
            raise ValueError(tag)
        size, at = varint(data, at)
        if tag >> 3 == 2:
            inner = at
            while inner < at + size:
                t, inner = varint(data, inner)
                if t == 3 << 3:
                    assert data[inner] == 2
                    data[inner] = 1
                    return bytes(data)
                n, inner = varint(data, inner)
                inner += n if t & 7 == 2 else 0
        at += size
    raise ValueError("no trainer_spec")


def plain(text, v):
    """(score, tokens) of the best path by plain dynamic programming over the whole text."""
    s = " " + text if text else ""
    best = [(0.0, 0)] + [None] * len(s)
    for e in range(1, len(s) + 1):
        got = None
        for size in range(min(e, v.longest), 0, -1):
            p = s[e - size : e]
            if p in v.scores and best[e - size] and (got is None or best[e - size][0] + v.scores[p] > got[0]):
                got = best[e - size][0] + v.scores[p], best[e - size][1] + 1
        if s[e - 1] not in v.scores and (got is None or best[e - 1][0] + v.unknown > got[0]):
            got = best[e - 1][0] + v.unknown, best[e - 1][1] + len(s[e - 1].encode())
        best[e] = got
    return best[-1]


def texts_of_the_table(spark, n=40):
    return [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").limit(n).collect()]


def test_pretokens_cover_the_text_and_no_piece_crosses_them(vocabulary):
    import re

    cut = re.compile(vocabulary.cut)
    for t in TEXTS:
        assert "".join(cut.findall(" " + t)) == " " + t
    assert vocabulary.cut != r"(?s).+" and len(vocabulary.ids) > 31_000


def test_paths_of_both_operators(spark, vocabulary):
    from collections import Counter

    enc, trie = C.Encoder(vocabulary), N.Trie(vocabulary)
    rng = random.Random(3)
    random_texts = ["".join(rng.choice("aAbe ü\n.日") for _ in range(rng.randrange(60))) for _ in range(200)]
    for t in TEXTS + random_texts + texts_of_the_table(spark):
        ids, score = enc.encode(t)
        want = plain(t, vocabulary)
        assert (len(ids), score) == (want[1], pytest.approx(want[0], rel=1e-12))
        assert enc.decode(ids.tolist()) == t
        assert trie.count([Counter(enc.cut.findall(" " + t)) if t else Counter()]) == [len(ids)]
    texts = TEXTS + random_texts  # all in one trie
    bags = [Counter(enc.cut.findall(" " + t)) if t else Counter() for t in texts]
    assert N.Trie(vocabulary).count(bags) == [len(enc.encode(t)[0]) for t in texts]


def test_like_the_library_with_the_same_scores(spark, vocabulary):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_proto=as_unigram(MODEL_FILE))
    enc = C.Encoder(vocabulary)
    words = {w for t in texts_of_the_table(spark) for w in t.split()}
    for w in sorted(words)[:2000]:
        first, *second = sp.nbest_encode(w, nbest_size=2)  # encode() of this version is not always the best path
        ids, score = enc.encode(w)
        assert sum(map(sp.get_score, ids.tolist())) == sum(map(sp.get_score, first)), w
        if not second or sum(map(sp.get_score, second[0])) < sum(map(sp.get_score, first)):
            assert ids.tolist() == first, w


def test_memory_does_not_change_results(spark, vocabulary, monkeypatch):
    from collections import Counter

    monkeypatch.setattr(C, "MEMO", 3)
    monkeypatch.setattr(N, "MAX_TERMINALS", 50)
    monkeypatch.setattr(N, "TRIE_WORDS", 9)
    monkeypatch.setattr(N, "LONG_WORD", 7)
    enc, small, trie, free = C.Encoder(vocabulary), C.Encoder(vocabulary), N.Trie(vocabulary), N.Trie(vocabulary)
    for t in texts_of_the_table(spark, 5):
        monkeypatch.setattr(C, "MEMO", 10**9)
        want = enc.encode(t)[0].tolist()
        monkeypatch.setattr(C, "MEMO", 3)
        assert small.encode(t)[0].tolist() == want
        words = Counter(enc.cut.findall(" " + t))
        assert trie.count([words]) == free.count([words]) == [len(want)]


def test_a_batch_is_encoded_in_slices(spark, vocabulary, monkeypatch):
    texts = ["", None, "one two", "é" * 40, None, "x " * 30, "", "end"]
    column = C.pa.array(texts)
    assert list(C.slices(column, 1 << 20)) == [(0, 8)] and list(C.slices(column.slice(0, 0), 9)) == []
    cut = list(C.slices(column, 64))
    assert len(cut) > 2 and [first for first, _ in cut] == [sum(n for _, n in cut[:k]) for k in range(len(cut))] and sum(n for _, n in cut) == 8
    small, whole = C.Encoder(vocabulary), C.Encoder(vocabulary)
    monkeypatch.setattr(C, "MEMO_CHARACTERS", 20)
    for t in [t for t in texts if t] * 2:  # the memory begins anew, and holds no more than a slice beyond its bound
        small.encode(t)
        assert small.paths.characters <= 20 + len(t) + 1
    given = [t for t in texts if t is not None]
    ids, sizes, scores = whole.encode_all(given)
    assert sum(sizes) == len(ids)
    for k, t in enumerate(given):
        one, score = small.encode(t)
        assert ids[sum(sizes[:k]) : sum(sizes[: k + 1])].tolist() == one.tolist() and scores[k] == score


def test_awkward_documents(spark):
    rows = awkward()
    docs = frame(spark, rows)
    out = C.encode_text(docs, check=True)
    assert out.columns == [c for c in docs.columns if c not in ("ids", "score")] + ["ids", "n_tokens", "score", "exact"]
    found = out.collect()
    assert len(found) == len(rows)
    for r in found:
        assert (r.ids is None and r.n_tokens is None) if r.text is None else (r.exact and len(r.ids) == r.n_tokens)
    back = C.decode_ids(out.drop("text").withColumnRenamed("lang", "text2"), into="text").select("doc_id", "text").collect()
    assert sorted(map(tuple, back), key=str) == sorted(((i, t) for i, t in rows), key=str)
    counts = N.count_tokens(docs).collect()
    assert sorted((str(r.doc_id), r.n_tokens) for r in counts) == sorted((str(r.doc_id), r.n_tokens or 0) for r in found)
    empty = frame(spark, [])
    assert C.encode_text(empty).count() == 0 and N.count_tokens(empty).count() == 0


def test_a_long_pretoken_takes_time_and_memory_in_proportion(vocabulary):
    import time
    import tracemalloc

    trie = N.Trie(vocabulary)
    from collections import Counter

    def cost(n):
        word = " " + "".join(random.Random(n).choice("aeüx日b") for _ in range(n))
        started = time.perf_counter()
        [tokens] = trie.count([Counter([word])])
        seconds = time.perf_counter() - started
        assert tokens == plain(word[1:], vocabulary)[1] if n <= 20_000 else tokens > n / 20
        return seconds

    cost(20_000)
    assert cost(800_000) < 4 * max(cost(400_000), 0.05)
    tracemalloc.start()
    cost(400_000)
    assert tracemalloc.get_traced_memory()[1] < 8_000_000
    tracemalloc.stop()
