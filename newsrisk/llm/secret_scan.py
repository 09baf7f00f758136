"""Secret scans: fixed patterns, then two character Markov models compared by log-likelihood ratio.

The models (random strings, ordinary identifiers) are first-order chains over the characters of
``[A-Za-z0-9+/_.=-]`` with add-one smoothing. Their labelled samples come from the documents: the
values that the fixed patterns find are random strings, all other runs of these characters, as far as
no pattern span covers them, are ordinary. Spark counts the transitions; only the
two tables of at most 69 x 69 counts reach the driver.

The runs, as far as no pattern span covers them, are scored whole and, where that is not enough, in
the pieces between ``= / . _ + -``. A piece of at least ``MIN_RUN`` characters is added as a span of kind
``markov`` if the models' log-likelihoods differ by ``MIN_TOTAL`` in all and by ``MIN_RATIO`` per character: a
short piece needs a clearer ratio.

Defined cases: a null text is empty; repeated rows give repeated rows; without any labelled random string
nothing is added.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsrisk.llm.common import documents_of

# The base patterns and their least lengths (whole match, or group 2 for assign).
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
ASSIGN_MIN, ACCESS_MIN, HEX_MIN = 12, 18, 16

KINDS = ("assign", "access", "hex", "markov")
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-"
MIN_RUN = 12
MIN_RATIO = 0.5
MIN_TOTAL = 10.0
#: The models are fitted on about so many distinct texts (all, if there are fewer), those of least hash.
SAMPLE_DOCUMENTS = 20_000
#: Runs that count as labelled samples have at least this many characters.
MIN_SAMPLE = 8

SPANS = "doc_id long, n_assign long, n_access long, n_hex long, n_markov long, base_sha256 string, spans string"


class Scanner:
    """The compiled patterns, and the log-likelihood ratios of character pairs (69 x 69, or none)."""

    def __init__(self, ratios: np.ndarray | None = None):
        self.assign, self.access = re.compile(ASSIGN, re.ASCII), re.compile(ACCESS)
        # a run of at least HEX_MIN is found whole either way, as a greedy match takes the whole run
        self.hex = re.compile(HEX.replace("+", f"{{{HEX_MIN},}}"))
        self.run = re.compile(rf"(?<![A-Za-z0-9+/_.=-])[A-Za-z0-9+/_.=-]{{{MIN_SAMPLE},}}")
        self.piece = re.compile(rf"[A-Za-z0-9]{{{MIN_RUN},}}")
        self.code = np.zeros(128, dtype=np.int64)
        self.code[[ord(c) for c in ALPHABET]] = np.arange(1, len(ALPHABET) + 1)
        self.ratios = ratios

    def base(self, text: str) -> list[tuple[int, int, int, str]]:
        """Pattern spans (start, kind, end, value) in order."""
        out = [(m.start(), 0, m.end(), m[2]) for m in self.assign.finditer(text) if len(m[2]) >= ASSIGN_MIN]
        if "AKIA" in text:
            out += [(m.start(), 1, m.end(), m[0]) for m in self.access.finditer(text) if len(m[0]) >= ACCESS_MIN]
        out += [(m.start(), 2, m.end(), m[0]) for m in self.hex.finditer(text)]
        return sorted(out)

    def runs(self, text: str, base: list, least: int):
        """(start, end) of the parts of runs of the alphabet that no base span covers, of at least ``least`` characters."""
        spans, at = [], 0
        for s, _, e, _ in base:  # in order of their starts: overlapping ones become one
            if spans and s <= spans[-1][1]:
                spans[-1][1] = max(e, spans[-1][1])
            else:
                spans.append([s, e])
        for m in self.run.finditer(text):
            start, end = m.span()
            while at < len(spans) and spans[at][1] <= start:
                at += 1
            while at < len(spans) and spans[at][0] < end:
                if spans[at][0] - start >= least:
                    yield start, spans[at][0]
                start = max(start, spans[at][1])
                if spans[at][1] > end:  # it reaches into what follows
                    break
                at += 1
            if end - start >= least:
                yield start, end

    def pairs(self, value: str) -> np.ndarray:
        """Codes of the successive character pairs, the first with the start state 0."""
        x = self.code[np.frombuffer(value.encode("ascii"), dtype=np.uint8)]
        return np.concatenate(([0], x[:-1])) * (len(ALPHABET) + 1) + x

    def ratio(self, value: str) -> float:
        return float(self.ratios[self.pairs(value)].mean())

    def is_random(self, value: str) -> bool:
        return len(value) >= MIN_RUN and (r := self.ratio(value)) >= MIN_RATIO and r * len(value) >= MIN_TOTAL

    def added(self, text: str, base: list) -> list[tuple[int, int, int, str]]:
        if self.ratios is None:
            return []
        out = []
        for start, end in self.runs(text, base, MIN_RUN):
            if self.is_random(text[start:end]):
                out.append((start, 3, end, text[start:end]))
                continue
            for m in self.piece.finditer(text, start, end):
                if m.end() - m.start() < end - start and self.is_random(m[0]):
                    out.append((m.start(), 3, m.end(), m[0]))
        return out


def named(spans: list) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e, _ in spans)


def fit(docs: DataFrame, sample_documents: int = SAMPLE_DOCUMENTS) -> np.ndarray | None:
    """Log-likelihood ratio per character pair, flat; None if the documents hold no sample."""
    size = (len(ALPHABET) + 1) ** 2

    def count(batches):
        scan, totals = Scanner(), np.zeros((2, size), dtype=np.int64)
        for b in batches:
            for t in b.column(0):
                text = t.as_py()
                base = scan.base(text)
                for *_, v in base:
                    totals[1] += np.bincount(scan.pairs(v), minlength=size)
                for start, end in scan.runs(text, base, MIN_SAMPLE):
                    totals[0] += np.bincount(scan.pairs(text[start:end]), minlength=size)
        label, pair = np.nonzero(totals)
        yield pa.RecordBatch.from_arrays([pa.array(label, pa.int32()), pa.array(pair, pa.int32()), pa.array(totals[label, pair], pa.int64())], names=["label", "pair", "n"])

    texts = docs.select("text").where(F.col("text").isNotNull()).withColumn("h", F.xxhash64("text"))
    prints = texts.select("h").distinct().count()  # copies of a text are one
    bound = -(1 << 63) + int(min(1.0, sample_documents / max(prints, 1)) * ((1 << 64) - 2048))
    if prints > sample_documents:
        texts = texts.where(F.col("h") <= bound)
    texts = texts.groupBy("h").agg(F.first("text").alias("text")).select("text")
    counts = texts.mapInArrow(count, "label int, pair int, n long").groupBy("label", "pair").agg(F.sum("n").alias("n"))
    table = np.zeros((2, size))
    for label, pair, n in counts.collect():  # at most 2 x 69 x 69 rows
        table[label, pair] = n
    if not table[1].any():
        return None
    chain = table.reshape(2, len(ALPHABET) + 1, -1)[:, :, 1:] + 1.0
    chain = np.log(chain / chain.sum(axis=2, keepdims=True))
    out = np.zeros((len(ALPHABET) + 1, len(ALPHABET) + 1))
    out[:, 1:] = chain[1] - chain[0]
    return out.ravel()


def scan_secrets(docs: DataFrame, ratios: np.ndarray | None) -> DataFrame:
    """One row per document: counts by kind, the digest of the base spans, and all spans (code points)."""

    def run(batches):
        scan = Scanner(ratios)
        for b in batches:
            rows = []
            for i, t in zip(b.column(0), b.column(1)):
                text = t.as_py() or ""
                base = scan.base(text)
                more = scan.added(text, base)
                n = [sum(x[1] == k for x in base) for k in range(3)]
                rows.append((i.as_py(), *n, len(more), hashlib.sha256(named(base).encode()).hexdigest(), named(sorted(base + more))))
            cols = list(zip(*rows)) if rows else [[]] * 7
            kinds = [pa.int64()] * 5 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=[x.split()[0] for x in SPANS.split(", ")])

    return documents_of(docs, "doc_id", "text").mapInArrow(run, SPANS)
