"""Token counts: unigram forward scores over a trie of distinct pre-tokens, shared by prefix.

A task takes the distinct pre-tokens of its texts that it has not counted yet, sorts them, and so has a
trie: a node is a prefix, and belongs to the first word that has it. The forward state of a node (best
score of any segmentation of the prefix, and that path's number of tokens) depends on the prefix
alone, so it is computed once, level by level for all nodes of a level together, from the states of its ancestors at most
a piece's length above. A terminal's count is then stored with its pre-token. A text's count is the
sum over its pre-tokens. Scores, ties and unknown characters (one token per UTF-8 byte) are those
of ``sentencepiece_codec``, so the counts equal the lengths of its ids.

No shuffle: a trie has at most ``TRIE_WORDS`` words of ``LONG_WORD`` characters, and the stored counts begin anew
beyond ``MAX_TERMINALS``, which changes no result; a longer pre-token shares nothing and is counted on its own, in
memory of a piece's length. Defined cases: a null or empty text has 0 tokens; repeated rows give repeated rows.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from newsrisk.llm.common import documents_of
from newsrisk.llm.pieces import MODEL_FILE, Vocabulary, load

TRIE_WORDS = 1 << 15
MAX_TERMINALS = 400_000
LONG_WORD = 64
CHUNK = 4 << 20  # characters of texts whose pre-tokens go into a trie together
NEVER = float("-inf")
COUNTS = "doc_id long, n_tokens long, n_pretokens long, n_distinct long"

MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def code_points(words: list[str]) -> np.ndarray:
    """words x longest code points, zero beyond a word's end."""
    width = max(map(len, words))
    return np.frombuffer("".join(w.ljust(width, "\0") for w in words).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(len(words), width)


def rolled(chars: np.ndarray) -> np.ndarray:
    """(width + 1) x words hashes of the prefixes."""
    out = np.zeros((chars.shape[1] + 1, len(chars)), np.uint64)
    for d in range(chars.shape[1]):
        out[d + 1] = out[d] * MULTIPLIER + chars[:, d]
    return out


class Pieces:
    """The vocabulary's pieces by length, found by hash and compared character by character."""

    def __init__(self, vocabulary: Vocabulary):
        self.by_size, self.power = {}, np.cumprod(np.concatenate(([np.uint64(1)], np.full(vocabulary.longest, MULTIPLIER))))
        for size in range(1, vocabulary.longest + 1):
            own = [p for p in vocabulary.scores if len(p) == size]
            if own:
                chars = code_points(own)
                h = rolled(chars)[size]
                order = np.argsort(h)
                self.by_size[size] = h[order], chars[order], np.array([vocabulary.scores[p] for p in own])[order]
        self.known = np.zeros(0x110000, bool)
        self.known[[ord(p) for p in vocabulary.scores if len(p) == 1]] = True

    def at_end(self, size: int, h: np.ndarray, before: np.ndarray, chars: np.ndarray, rows: np.ndarray, end: int):
        """(places in ``rows``, scores) of the rows whose ``size`` characters up to ``end`` are a piece."""
        table, spelled, scores = self.by_size[size]
        key = h - before * self.power[size]
        at = np.minimum(np.searchsorted(table, key), len(table) - 1)
        hit = np.nonzero(table[at] == key)[0]
        at = at[hit]
        same = (spelled[at] == chars[rows[hit], end - size : end]).all(axis=1)
        return hit[same], scores[at[same]]


class Trie:
    """Token counts of pre-tokens, stored with them."""

    def __init__(self, vocabulary: Vocabulary):
        import ahocorasick

        self.v, self.pieces, self.terminal = vocabulary, Pieces(vocabulary), {}
        self.automaton = ahocorasick.Automaton()  # for long words
        for p, score in vocabulary.scores.items():
            self.automaton.add_word(p, (len(p), score))
        self.automaton.make_automaton()

    def counts(self, words: list[str]) -> np.ndarray:
        """Tokens of sorted distinct words of at most LONG_WORD characters: one trie, level by level."""
        chars, length = code_points(words), np.array([len(w) for w in words])
        n, width = chars.shape
        h = rolled(chars)
        differs = chars[1:] != chars[:-1]
        shared = np.concatenate(([0], np.argmax(differs, axis=1)))  # characters in common with the word before
        place = np.arange(n)
        score, tokens, owner = np.full((width + 1, n), NEVER), np.zeros((width + 1, n), np.int64), np.zeros((width + 1, n), np.int64)
        score[0] = 0.0  # the root belongs to word 0
        for d in range(1, width + 1):
            owner[d] = np.maximum.accumulate(np.where(shared < d, place, 0))
            rows = np.nonzero((shared < d) & (length >= d))[0]  # this level's nodes
            best, count = np.full(len(rows), NEVER), np.zeros(len(rows), np.int64)
            c = chars[rows, d - 1]
            new = np.nonzero(~self.pieces.known[c])[0]
            if len(new):
                above = owner[d - 1, rows[new]]
                best[new] = score[d - 1, above] + self.v.unknown
                count[new] = tokens[d - 1, above] + utf8_bytes(c[new])
            for size in range(min(d, self.v.longest), 0, -1):  # longest first: it wins ties
                if size not in self.pieces.by_size:
                    continue
                hit, s = self.pieces.at_end(size, h[d, rows], h[d - size, rows], chars, rows, d)
                above = owner[d - size, rows[hit]]
                s = s + score[d - size, above]
                better = s > best[hit]
                hit, above = hit[better], above[better]
                best[hit], count[hit] = s[better], tokens[d - size, above] + 1
            score[d, rows], tokens[d, rows] = best, count
        return tokens[length, place]

    def start(self, c: str, score: float, tokens: int) -> tuple[float, int]:
        """The state after a character from the state before it, if the character is unknown."""
        if c in self.v.scores:
            return NEVER, 0
        return score + self.v.unknown, tokens + len(c.encode("utf-8", "surrogatepass"))

    def long(self, word: str) -> int:
        """The token count of a long word, from the states of the last ``longest`` places."""
        keep = self.v.longest + 1
        score, tokens, at = [NEVER] * keep, [0] * keep, 0  # of the place i at i % keep
        score[0] = 0.0
        best, count = self.start(word[0], 0.0, 0)
        # of the pieces that end at one place the longest comes first
        for last, (size, s) in self.automaton.iter(word):
            while at < last:
                at += 1
                score[at % keep], tokens[at % keep] = best, count
                best, count = self.start(word[at], best, count)
            before = (at + 1 - size) % keep
            if score[before] + s > best:
                best, count = score[before] + s, tokens[before] + 1
        while at < len(word) - 1:
            at += 1
            best, count = self.start(word[at], best, count)
        return count

    def count(self, bags: list[Counter]) -> list[int]:
        """Tokens of several bags of pre-tokens."""
        words = set().union(*bags)
        if len(self.terminal) + len(words) > MAX_TERMINALS:
            self.terminal = {}
        new = words.difference(self.terminal)
        of = dict(self.terminal) if len(new) > MAX_TERMINALS else self.terminal
        of.update((w, self.long(w)) for w in new if len(w) > LONG_WORD)
        short = sorted(w for w in new if len(w) <= LONG_WORD)
        for at in range(0, len(short), TRIE_WORDS):
            part = short[at : at + TRIE_WORDS]
            of.update(zip(part, self.counts(part).tolist()))
        return [sum(n * of[w] for w, n in bag.items()) for bag in bags]


def utf8_bytes(c: np.ndarray) -> np.ndarray:
    return 1 + (c > 0x7F).astype(np.int64) + (c > 0x7FF) + (c > 0xFFFF)


def count_tokens(docs: DataFrame, model_file: str = MODEL_FILE) -> DataFrame:
    """(doc_id, n_tokens, n_pretokens, n_distinct) of every document."""
    vocabulary = load(model_file)

    def run(batches):
        trie, cut = Trie(vocabulary), re.compile(vocabulary.cut)
        for b in batches:
            rows, bags, size = [], [], 0
            for t in b.column(1):
                text = t.as_py()
                bags.append(Counter(cut.findall(" " + text)) if text else Counter())
                size += len(text or "")
                if size > CHUNK:
                    rows += zip(trie.count(bags), [x.total() for x in bags], map(len, bags))
                    bags, size = [], 0
            rows += zip(trie.count(bags), [x.total() for x in bags], map(len, bags))
            cols = list(zip(*rows)) if rows else [[]] * 3
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, pa.int64()) for c in cols)], names=["doc_id", "n_tokens", "n_pretokens", "n_distinct"])

    return documents_of(docs, "doc_id", "text").mapInArrow(run, COUNTS)
