"""Language identification by error-correcting output codes over character n-grams.

Every learned language gets a codeword of bits. For each bit a binary classifier tells the
languages whose bit is 1 from the others: a linear log-odds model over hashed character n-grams
(orders 1 to 3, letters lower-cased, everything else one space), each side the mean of its
languages' smoothed n-gram distributions. A text's bit margins are summed log-odds over the square
root of its n-grams. Decoding is loss-weighted: a codeword's loss is the mean over bits of
``log(1 + exp(-bit * margin))``, weighted per language by how often that classifier was right on
that language's training texts, and the codeword of least loss wins. ``score`` is its share of
``exp(-loss)`` among all codewords. A text is ``ambiguous`` if between the two nearest codewords alone the
nearer one's share exceeds the other's by less than ``AMBIGUOUS_GAP``, so that further languages do not matter.

The classifiers are fitted on a bounded sample: ``SAMPLE_PER_LANGUAGE`` distinct training texts of
each language (all, if it has fewer), those of least hash; copies of a text count once. Spark counts the n-grams; languages x buckets counts
reach the driver, whatever the number of documents.

Defined cases: a null text, or one without a letter, is ``und`` with score 0; without training
rows every text is; repeated rows give repeated rows; of equally near codewords the first in
alphabetical order of the languages wins.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsrisk.llm.common import checked_broadcast, write_table

UNDETERMINED = "und"
BUCKETS = 1 << 14
ORDERS = (1, 2, 3)
SAMPLE_PER_LANGUAGE = 2_000
AMBIGUOUS_GAP = 0.05
HELD_OUT_FOLDS = 5
CHUNK = 1 << 20  # characters of a text that are hashed at a time
CODE_SEED = 7


@dataclass
class Model:
    """languages, codewords (languages x bits, +1/-1), weights (buckets x bits), trust (languages x bits)."""

    languages: list[str]
    codes: np.ndarray
    weights: np.ndarray
    trust: np.ndarray


def codewords(k: int) -> np.ndarray:
    """Codewords of k languages: all splits for up to 7, else 10 log2(k) seeded random splits."""
    if k <= 7:
        bits = [[(j >> i) & 1 for j in range(1, 1 << (k - 1))] for i in range(k)] if k > 1 else [[]]
        return np.where(np.array(bits, dtype=int).reshape(k, -1), 1, -1)
    rng, width = np.random.default_rng(CODE_SEED), int(np.ceil(10 * np.log2(k)))
    while True:
        c = rng.choice([-1, 1], size=(k, width))
        if len(np.unique(c, axis=0)) == k and (abs(c.sum(axis=0)) < k).all():
            return c


def letter_table() -> np.ndarray:
    """Whether each code point is a letter (str.isalpha)."""
    return np.frombuffer(bytes(chr(i).isalpha() for i in range(0x110000)), dtype=np.uint8).astype(bool)


def grams(text: str, letters: np.ndarray) -> np.ndarray | None:
    """Bucket counts of the text's n-grams; None if it has no letter. Long texts go chunk by chunk."""
    counts, seen = np.zeros(BUCKETS, dtype=np.int64), False
    for at in range(0, max(1, len(text)), CHUNK):
        part = text[at : at + CHUNK].lower()
        x = np.frombuffer(part.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        is_letter = letters[x]
        if not is_letter.any():
            continue
        seen = True
        x = np.where(is_letter, x, 32).astype(np.uint64)
        x = np.concatenate(([32], x, [32])).astype(np.uint64)
        x = x[np.concatenate(([True], (x[1:] != 32) | (x[:-1] != 32)))]
        h = np.zeros(len(x), dtype=np.uint64)
        for n in range(1, max(ORDERS) + 1):
            if n > len(x):
                break
            h = h[: len(x) - n + 1] * np.uint64(0x9E3779B97F4A7C15) + x[n - 1 :] + np.uint64(1)
            if n in ORDERS:
                mixed = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
                counts += np.bincount((mixed >> np.uint64(50)).astype(np.int64), minlength=BUCKETS)
    return counts if seen else None


def margins(counts: np.ndarray, weights: np.ndarray) -> np.ndarray:
    return (counts.astype(np.float32) @ weights) / np.sqrt(max(1, counts.sum()))


def decode(f: np.ndarray, model: Model) -> tuple[int, float, float]:
    """(language index, score, lead over the second, between these two alone) of bit margins f."""
    if len(model.languages) == 1:
        return 0, 1.0, 1.0
    loss = (model.trust * np.logaddexp(0, -model.codes * f[None, :])).sum(axis=1)
    share = np.exp(-(loss - loss.min()))
    share /= share.sum()
    best = int(np.argmin(loss))
    first, second = np.partition(loss, 1)[:2]
    return best, float(share[best]), float(np.tanh((second - first) / 2))


def distinct_sample(rows: DataFrame, sample_per_language: int) -> tuple[DataFrame | None, list[str]]:
    """(text, lang) of each language's distinct texts of least hash, ``sample_per_language`` at most, and the languages."""
    rows = rows.withColumn("h", F.xxhash64("text"))
    prints = write_table(rows.select("lang", "h").distinct(), "text_hashes")
    sizes = {r["lang"]: r["n"] for r in prints.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    languages = sorted(sizes)
    if not languages:
        return None, []
    # hashes are signed: those below a bound with room to spare are ranked, so no task sees all of a language
    room = 2 * sample_per_language + 200
    bound = F.create_map(*(F.lit(x) for l in languages for x in (l, int(-(2**63) + min(1.0, room / sizes[l]) * (2**64 - 2048)))))
    low = prints.where((F.col("h") <= F.element_at(bound, F.col("lang"))) | F.element_at(F.create_map(*(F.lit(x) for l in languages for x in (l, sizes[l] <= room))), F.col("lang")))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("h"))
    chosen = write_table(low.withColumn("rank", rank).where(F.col("rank") <= sample_per_language).select("lang", "h"), "sample_hashes")
    sample = rows.join(checked_broadcast(chosen, 48), ["lang", "h"]).dropDuplicates(["lang", "h"]).select("text", "lang")
    return write_table(sample, "sample"), languages


def fit(labelled: DataFrame, sample_per_language: int = SAMPLE_PER_LANGUAGE) -> Model | None:
    """Fit on (text, lang) rows; None if no language can be learned."""
    rows = labelled.select("text", "lang").where("lang is not null and text is not null")
    sample, languages = distinct_sample(rows, sample_per_language)
    if not languages:
        return None
    index = {l: i for i, l in enumerate(languages)}

    def count(batches):
        letters, totals = letter_table(), np.zeros((len(languages), BUCKETS), dtype=np.int64)
        for b in batches:
            for t, l in zip(b.column(0), b.column(1)):
                c = grams(t.as_py(), letters)
                if c is not None:
                    totals[index[l.as_py()]] += c
        lang, bucket = np.nonzero(totals)
        yield pa.RecordBatch.from_arrays([pa.array(lang, pa.int32()), pa.array(bucket, pa.int32()), pa.array(totals[lang, bucket], pa.int64())], names=["lang", "bucket", "n"])

    counts = np.zeros((len(languages), BUCKETS))
    for lang, bucket, n in sample.mapInArrow(count, "lang int, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n")).collect():
        counts[lang, bucket] = n
    learned = [i for i in range(len(languages)) if counts[i].any()]
    if not learned:
        return None
    languages, counts = [languages[i] for i in learned], counts[learned]
    codes = codewords(len(languages))
    share_of = (counts + 0.5) / (counts + 0.5).sum(axis=1, keepdims=True)
    weights = np.stack([np.log(share_of[codes[:, b] > 0].mean(axis=0)) - np.log(share_of[codes[:, b] < 0].mean(axis=0)) for b in range(codes.shape[1])], axis=1).astype(np.float32) if codes.shape[1] else np.zeros((BUCKETS, 0), np.float32)
    place = {l: i for i, l in enumerate(languages)}

    def test(batches):
        letters, right = letter_table(), np.zeros((len(languages), codes.shape[1] + 1), dtype=np.int64)
        for b in batches:
            for t, l in zip(b.column(0), b.column(1)):
                c = grams(t.as_py(), letters)
                if c is not None and l.as_py() in place:
                    k = place[l.as_py()]
                    right[k, :-1] += margins(c, weights) * codes[k] > 0
                    right[k, -1] += 1
        lang, bit = np.nonzero(right)
        yield pa.RecordBatch.from_arrays([pa.array(lang, pa.int32()), pa.array(bit, pa.int32()), pa.array(right[lang, bit], pa.int64())], names=["lang", "bit", "n"])

    right = np.zeros((len(languages), codes.shape[1] + 1))
    for lang, bit, n in sample.mapInArrow(test, "lang int, bit int, n long").groupBy("lang", "bit").agg(F.sum("n")).collect():
        right[lang, bit] = n
    trust = right[:, :-1] / np.maximum(1, right[:, -1:]) + 1e-6
    return Model(languages, codes, weights, trust / np.maximum(trust.sum(axis=1, keepdims=True), 1e-9))


VERDICT = "_lang_pred string, _score double, _ambiguous boolean"


def judged(docs: DataFrame, model: Model | None) -> DataFrame:
    """``docs``, row by row, with ``_lang_pred``, ``_score`` and ``_ambiguous``, from the column ``text`` alone."""
    at = docs.columns.index("text")

    def run(batches):
        letters = letter_table()
        for b in batches:
            out = []
            for t in b.column(at):
                c = grams(t.as_py() or "", letters) if model else None
                if c is None:
                    out.append((UNDETERMINED, 0.0, False))
                else:
                    k, score, lead = decode(margins(c, model.weights), model)
                    out.append((model.languages[k], score, lead < AMBIGUOUS_GAP))
            lang, score, ambiguous = zip(*out) if out else ((), (), ())
            more = [pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(ambiguous, pa.bool_())]
            yield pa.RecordBatch.from_arrays([*b.columns, *more], names=[*b.schema.names, "_lang_pred", "_score", "_ambiguous"])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, *T._parse_datatype_string(VERDICT).fields]))


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, ambiguous) per document, from the text alone.

    ``held_out`` is whether crc32 of doc_id as text leaves no remainder by 5 (null id: null).
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (fold(F.col("doc_id")) == 0).alias("held_out"), "text")
    return judged(rows, model).select("doc_id", "held_out", F.col("_lang_pred").alias("lang_pred"), F.col("_score").alias("score"), F.col("_ambiguous").alias("ambiguous"))


def identified(docs: DataFrame, sample_per_language: int = SAMPLE_PER_LANGUAGE) -> DataFrame:
    """The rows of ``docs`` whose language is found: those without a letter (or text), and ambiguous ones, go, each by its own text."""
    found = judged(docs, fit(docs.where(fold(F.col("doc_id")) != 0), sample_per_language))
    return found.where(~F.col("_ambiguous") & (F.col("_lang_pred") != UNDETERMINED)).select(docs.columns)


def fold(doc_id):
    return F.crc32(doc_id.cast("string").cast("binary")) % HELD_OUT_FOLDS


def identify(docs: DataFrame, sample_per_language: int = SAMPLE_PER_LANGUAGE) -> DataFrame:
    """Fit on the documents that are not held out and predict all of them."""
    return predict(docs, fit(docs.where(fold(F.col("doc_id")) != 0), sample_per_language))
