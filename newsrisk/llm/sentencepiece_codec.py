"""SentencePiece encoding and decoding: an Aho-Corasick automaton over the pieces drives Viterbi.

The automaton reads a pre-token once. At each position its output links name every piece that ends
there, longest first, and each relaxes the best score of that position; a character that is no
piece may also be taken as unknown, and is written as its UTF-8 byte pieces. The best path has the
largest sum of piece scores (the scores of the model file, read as a unigram model's); of equal
sums the one with the longer last piece wins, position by position. A space is put before the text
(dropped again by decoding). No other normalisation: decoding gives back the exact text.

Defined cases: a null text has null ids; an empty one has none; repeated rows give repeated rows.
A batch is encoded in slices of about ``SLICE`` bytes, so a task holds a slice's ids, not a batch's. Best paths
of pre-tokens are remembered per task, side by side in arrays; the memory begins anew when it holds more than
``MEMO`` paths or ``MEMO_CHARACTERS``, between two slices, and changes no result.
"""

from __future__ import annotations

import re
from array import array
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from newsrisk.llm.pieces import MODEL_FILE, Vocabulary, load

MEMO = 400_000
MEMO_CHARACTERS = 8 << 20
SLICE = 1 << 20
NEVER = float("-inf")
ENCODED = "ids array<int>, n_tokens int, score double"


class Paths(dict):
    """Pre-token -> number of its best path, which is found when first asked for."""

    def __init__(self, best_path):
        super().__init__()
        self.best_path, self.ids, self.starts, self.scores, self.characters = best_path, array("i"), array("q", [0]), array("d"), 0

    def __missing__(self, word: str) -> int:
        ids, score = self.best_path(word)
        self.ids.extend(ids), self.starts.append(len(self.ids)), self.scores.append(score)
        self.characters += len(word)
        self[word] = number = len(self.scores) - 1
        return number

    def joined(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids one after the other, ids of each, score of each) of the paths."""
        starts = np.frombuffer(self.starts, np.int64)
        first, sizes = starts[numbers], starts[numbers + 1] - starts[numbers]
        at = np.repeat(first - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
        return np.frombuffer(self.ids, np.int32)[at] if len(at) else np.zeros(0, np.int32), sizes, np.frombuffer(self.scores)[numbers]


class Encoder:
    def __init__(self, vocabulary: Vocabulary):
        import ahocorasick

        self.v, self.cut, self.paths = vocabulary, re.compile(vocabulary.cut), Paths(self.best_path)
        self.automaton = ahocorasick.Automaton()
        for p, i in vocabulary.ids.items():
            self.automaton.add_word(p, (len(p), vocabulary.scores[p], (len(p), i)))
        self.automaton.make_automaton()
        self.known = {p for p in vocabulary.ids if len(p) == 1}
        self.bytes_of = {i: p.encode("utf-8", "surrogatepass") for p, i in vocabulary.ids.items()} | {i: bytes([b]) for b, i in enumerate(vocabulary.byte_ids)}

    def best_path(self, word: str) -> tuple[list[int], float]:
        """(ids, score) of one pre-token, in a single pass of the automaton."""
        n, known, unknown = len(word), self.known, self.v.unknown
        best, back, done = [0.0] + [NEVER] * n, [None] * (n + 1), 0

        def unknowns(done, end):  # positions up to end get their unknown character, in order
            while done < end:
                done += 1
                if word[done - 1] not in known and best[done - 1] + unknown > best[done]:
                    best[done], back[done] = best[done - 1] + unknown, (1, -1)
            return done

        plain = known.issuperset(word)
        for last, (size, score, step) in self.automaton.iter(word):
            end = last + 1
            if not plain and done < end:
                done = unknowns(done, end)
            s = best[end - size] + score
            if s > best[end]:
                best[end], back[end] = s, step
        if not plain:
            unknowns(done, n)
        ids, at = [], n
        while at:
            size, i = back[at]
            if i >= 0:
                ids.append(i)
            else:
                ids.extend(self.v.byte_ids[b] for b in reversed(word[at - size : at].encode("utf-8", "surrogatepass")))
            at -= size
        ids.reverse()
        return ids, best[n]

    def encode_all(self, texts: list[str]) -> tuple[np.ndarray, list[int], list[float]]:
        """(ids of all texts one after the other, ids of each, score of each)."""
        if len(self.paths) > MEMO or self.paths.characters > MEMO_CHARACTERS:
            self.paths = Paths(self.best_path)
        cut, number_of = self.cut.findall, self.paths.__getitem__
        numbers = [list(map(number_of, cut(" " + t))) if t else [] for t in texts]
        ends = np.cumsum([0, *map(len, numbers)])
        ids, sizes, scores = self.paths.joined(np.fromiter(chain.from_iterable(numbers), np.int64, ends[-1]))
        upto, scores = np.concatenate(([0], np.cumsum(sizes))), scores.tolist()
        return ids, np.diff(upto[ends]).tolist(), [float(sum(scores[a:b])) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]

    def encode(self, text: str) -> tuple[np.ndarray, float]:
        ids, _, scores = self.encode_all([text])
        return ids, scores[0]

    def decode(self, ids) -> str:
        """The text of ids: pieces and byte pieces joined, read as UTF-8, the first space dropped."""
        text = b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text


def slices(column: pa.Array, size: int):
    """(first row, rows) of the pieces of a string column of about ``size`` bytes (a row at least)."""
    piece = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)) // size
    ends = np.append(np.flatnonzero(np.diff(piece)) + 1, len(column)) if len(column) else []
    first = 0
    for end in map(int, ends):
        yield first, end - first
        first = end


def encode_text(docs: DataFrame, column: str = "text", model_file: str = MODEL_FILE, check: bool = False) -> DataFrame:
    """``docs`` with ids, n_tokens and score of ``column`` added (columns of those names are replaced).

    With ``check``, also ``exact``: whether decoding the ids gives the text back.
    """
    vocabulary = load(model_file)
    docs = docs.drop("ids", "n_tokens", "score", "exact")
    at = docs.columns.index(column)

    def encoded(enc, b):
        texts = b.column(at).to_pylist()
        flat, n, scores = enc.encode_all([t for t in texts if t is not None])
        given = np.array([t is not None for t in texts])
        sizes = np.zeros(len(texts), np.int64)
        sizes[given] = n
        ends, filled = np.concatenate(([0], np.cumsum(sizes))), np.zeros(len(texts))
        filled[given] = scores
        lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32), mask=np.append(~given, False)), pa.array(flat, pa.int32()))
        more = [lists, pa.array(sizes.astype(np.int32), mask=~given), pa.array(filled, mask=~given)]
        if check:
            flat, ends = flat.tolist(), ends.tolist()
            more.append(pa.array([None if t is None else enc.decode(flat[i:j]) == t for t, i, j in zip(texts, ends, ends[1:])], pa.bool_()))
        names = ["ids", "n_tokens", "score"] + ["exact"] * check
        return pa.RecordBatch.from_arrays([*b.columns, *more], names=[*b.schema.names, *names])

    def run(batches):
        enc = Encoder(vocabulary)
        for b in batches:
            for first, rows in slices(b.column(at), SLICE):
                yield encoded(enc, b.slice(first, rows))

    schema = T.StructType([*docs.schema.fields, *T._parse_datatype_string(ENCODED + ", exact boolean" * check).fields])
    return docs.mapInArrow(run, schema)


def decode_ids(encoded: DataFrame, column: str = "ids", into: str = "text", model_file: str = MODEL_FILE) -> DataFrame:
    """``encoded`` with the text of the ids in ``column`` added as ``into`` (null ids: null)."""
    vocabulary = load(model_file)
    encoded = encoded.drop(into) if into != column else encoded
    at = encoded.columns.index(column)

    def run(batches):
        enc = Encoder(vocabulary)
        for b in batches:
            texts = [None if (x := v.as_py()) is None else enc.decode(x) for v in b.column(at)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(texts, pa.string())], names=[*b.schema.names, into])

    return encoded.mapInArrow(run, T.StructType([*encoded.schema.fields, T.StructField(into, T.StringType())]))
