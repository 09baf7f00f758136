"""Fixtures of the operator tests: awkward documents, and plain versions of what the operators compute."""

from __future__ import annotations

import random

EXTRA = "score double, ids array<int>, fp long, doc long, line int, n long, key string, start int, id long, token string, first long, words string"


def frame(spark, rows, key="doc_id"):
    """(key, text) rows with further columns whose names clash with those the operators use inside."""
    schema = f"{key} long, text string, lang string, source string, n_chars long, {EXTRA}"
    extra = (0.5, [1], 7, 7, 7, 7, "k", 7, 7, "t", 7, "w")
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) + extra for i, t in rows], schema)


def prose(rng: random.Random, n: int, vocabulary: int = 5000) -> list[str]:
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


def awkward(rng: random.Random | None = None) -> list[tuple]:
    """Null and empty texts, no letters, a very long text and word, ties, repeated rows, a null id."""
    rng = rng or random.Random(1)
    text = " ".join(prose(rng, 80))
    return [
        (1, None), (2, ""), (3, " \t\n "), (4, "123 %%% 456"), (5, "a"), (6, text), (7, text), (6, text),
        (8, " ".join(prose(rng, 30_000))), (9, "x" * 200_000), (None, "no id here at all"), (10, "line one\nline one\n\nline two"),
        (11, "naïve 日本語 \U0001f600 ▁ tab\tend\r\n"),
    ]


def union_find(edges, nodes):
    parent = {x: x for x in nodes}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return {x: find(x) for x in nodes}


def similar_lines(docs, threshold=0.8):
    """(doc_id, line number) of all lines that an earlier line resembles, by comparing with all of them."""
    seen, gone = [], set()
    inverted = {}
    for i, text in sorted((i, t) for i, t in docs if i is not None and t is not None):
        for j, line in enumerate(text.split("\n")):
            w = frozenset(x for x in line.replace("\t", " ").replace("\r", " ").split(" ") if x)
            if not w:
                continue
            shared = {}
            for x in w:
                for m in inverted.get(x, ()):
                    shared[m] = shared.get(m, 0) + 1
                inverted.setdefault(x, []).append(len(seen))
            if any(c >= threshold * (len(w) + len(seen[m][2]) - c) - 1e-9 for m, c in shared.items() if seen[m][:2] != (i, j)):
                gone.add((i, j))
            seen.append((i, j, w))
    return gone


def without_lines(docs, gone):
    return {i: "\n".join(l for j, l in enumerate(t.split("\n")) if (i, j) not in gone) for i, t in docs if t is not None}


def leaks(docs, benchmark, k=5, threshold=0.8):
    """{(doc_id, item_id): best weighted Jaccard} over all item-sized windows."""
    from collections import Counter

    out = {}
    for item, text in benchmark:
        w = (text or "").lower().split()
        if item is None or not w:
            continue
        size = min(k, len(w))
        n = len(w) - size + 1
        want = Counter(tuple(w[i : i + size]) for i in range(n))
        for doc, body in docs:
            v = (body or "").lower().split()
            if doc is None or len(v) < size:
                continue
            sh = [tuple(v[i : i + size]) for i in range(len(v) - size + 1)]
            if not want.keys() & set(sh):
                continue
            best = 0.0
            for a in range(max(1, len(sh) - n + 1)):
                got = Counter(sh[a : a + n])
                common = sum((got & want).values())
                best = max(best, common / (sum(got.values()) + n - common))
            if best >= threshold - 1e-12:
                out[doc, item] = max(best, out.get((doc, item), 0.0))
    return out
