"""Toxicity by multiple-instance learning.

Only documents are labelled, yet it is sentences that offend.  A sentence's probability is a
logistic function of the words in it; a document's is their noisy-or, the probability that
at least one sentence offends.  The likelihood of the document labels is maximised over
the weights of words and word beginnings, so the weights learn which sentences do, and
a document's score comes with the sentences that make it.

Features are words and their first letters, kept if the training documents show that they go
with the label; sentences without any of them have probability 0.  Training rows are a
documented, bounded sample (``POSITIVES``, ``NEGATIVES``).

Results: a null, empty or letterless text has score 0.  Of several labels of one id the
highest counts.  Repeated rows get equal scores; null ids are kept; an empty table, or
one without labels, gives scores of 0 for whatever rows there are.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import fold, least_hashed, per_row, text_or_empty

POSITIVES, NEGATIVES = 3_000, 6_000
FEATURES = 4_096
LEAST_DOCS = 3
LEAST_EVIDENCE = 2.0
PREFIXES = (4, 5, 6)
FOLDS, HELD_OUT = 4, 2

SENTENCE = re.compile(r"[^.!?\n]+[.!?]*")
WORD = re.compile(r"\w+")
REMEMBERED = 500_000


def sentences(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in SENTENCE.finditer(text)]


def features(word: str) -> list[str]:
    """The word itself and its beginnings, which are marked by a hyphen."""
    return [word, *(word[:n] + "-" for n in PREFIXES if len(word) > n)]


@dataclass
class Model:
    bias: float
    weights: dict[str, float]


class Scorer:
    def __init__(self, model: Model) -> None:
        self.model = model
        self.words: dict[str, float | None] = {}

    def word(self, word: str) -> float | None:
        """The sum of a word's weights; None if it has no feature."""
        known = [w for f in features(word) if (w := self.model.weights.get(f)) is not None]
        value = sum(known) if known else None
        if len(self.words) >= REMEMBERED:
            self.words.clear()
        self.words[word] = value
        return value

    def telling(self, words: Iterable[str]) -> dict[str, float]:
        """Those of ``words`` that have features, with their weights."""
        out = {}
        for w in words:
            value = self.words[w] if w in self.words else self.word(w)
            if value is not None:
                out[w] = value
        return out

    def sentences(self, text: str) -> list[tuple[int, int, float]]:
        """Start, end and probability of each sentence that is not sure to be clean."""
        lower = text.lower()
        if len(lower) != len(text):  # a few letters have a lower case of two characters
            lower = "".join(c.lower() if len(c.lower()) == 1 else c for c in text)
        known = self.telling(set(WORD.findall(lower)))
        if not known:
            return []
        out = []
        for a, b in sentences(lower):
            here = {w for w in WORD.findall(lower, a, b) if w in known}
            if here:
                z = self.model.bias + sum(known[w] for w in sorted(here))
                out.append((a, b, float(1 / (1 + np.exp(-z)))))
        return out

    def text(self, text: str) -> float:
        clean = 1.0
        for _, _, p in self.sentences(text):
            clean *= 1 - p
        return 1 - clean


def training_rows(docs: DataFrame, labels: DataFrame, folds: int = FOLDS, held_out: int = HELD_OUT) -> DataFrame:
    """``toxic, text``: for each label a bounded number of documents, those of least id hash."""
    open_ = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & (fold("doc_id", folds) != held_out))
    one = open_.groupBy("doc_id").agg(F.max((F.col("toxic") > 0).cast("int")).alias("toxic"))
    taken = least_hashed(one, "toxic", lambda toxic: POSITIVES if toxic else NEGATIVES)
    # at most POSITIVES + NEGATIVES rows
    return docs.where("text is not null").select("doc_id", "text").join(F.broadcast(taken), "doc_id").select("toxic", "text")


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """A model from bounded samples; the same tables give the same model."""
    rows = training_rows(docs, labels)
    chosen = _chosen(rows)
    if not chosen:
        return Model(-4.0, {})
    known = {f: i for i, f in enumerate(chosen)}

    def instances(batch: pa.RecordBatch) -> dict:
        toxic, found = [], []
        for y, text in zip(batch.column("toxic").to_pylist(), batch.column("text").to_pylist(), strict=True):
            lower = text.lower()
            here = []
            for a, b in sentences(lower):
                own = [known[f] for w in sorted(set(WORD.findall(lower, a, b))) for f in features(w) if f in known]
                if own:
                    here.append(own)
            toxic.append(y)
            found.append(here)
        return {"toxic": toxic, "found": found}

    sample = per_row(rows, "toxic int, found array<array<int>>", instances).collect()
    bags = sorted((r["toxic"], [list(s) for s in r["found"]]) for r in sample if r["found"])
    clean = sum(not r["found"] and not r["toxic"] for r in sample)
    weights, bias = _fit(bags, len(chosen), clean)
    return Model(bias, dict(zip(chosen, weights.tolist(), strict=True)))


def _chosen(rows: DataFrame) -> list[str]:
    """The features that go with the label most clearly, by the log-odds of their document counts."""

    def counted(batch: pa.RecordBatch) -> dict:
        seen: dict[int, Counter] = {0: Counter(), 1: Counter()}
        for y, text in zip(batch.column("toxic").to_pylist(), batch.column("text").to_pylist(), strict=True):
            seen[y].update({f for w in set(WORD.findall(text.lower())) for f in features(w)})
        names = sorted(seen[0].keys() | seen[1].keys())
        return {"feature": names, "clean": [seen[0][f] for f in names], "toxic": [seen[1][f] for f in names]}

    counts = per_row(rows, "feature string, clean long, toxic long", counted).groupBy("feature").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    totals = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    n1, n0 = totals.get(1, 0), totals.get(0, 0)
    if not n1:
        return []
    odds = F.log((F.col("toxic") + 0.5) / (n1 - F.col("toxic") + 0.5)) - F.log((F.col("clean") + 0.5) / (n0 - F.col("clean") + 0.5))
    doubt = F.sqrt(1 / (F.col("toxic") + 0.5) + 1 / (F.col("clean") + 0.5))
    kept = counts.where(F.col("toxic") >= LEAST_DOCS).withColumn("z", odds / doubt).where((odds > LEAST_EVIDENCE) & (F.col("z") > 2))
    return sorted(r["feature"] for r in kept.orderBy(F.desc("z"), "feature").limit(FEATURES).collect())


def _fit(bags: list[tuple[int, list[list[int]]]], n: int, clean: int, rounds: int = 300) -> tuple[np.ndarray, float]:
    """Weights and bias of the greatest likelihood of the bags, with a small penalty; Adam."""
    feature = np.array([f for _, bag in bags for s in bag for f in s], dtype=np.int64)
    sentence = np.repeat(np.arange(sum(len(bag) for _, bag in bags)), [len(s) for _, bag in bags for s in bag])
    owner = np.repeat(np.arange(len(bags)), [len(bag) for _, bag in bags])
    y = np.array([t for t, _ in bags], dtype=np.float64)
    total = len(bags) + clean
    w, bias = np.zeros(n), -3.0
    m, v = np.zeros(n + 1), np.zeros(n + 1)
    for step in range(1, rounds + 1):
        z = bias + np.bincount(sentence, weights=w[feature], minlength=len(owner))
        p = 1 / (1 + np.exp(-z))
        # of the noisy-or 1 - prod(1 - p): d log(1 - P) / dz = -p for each sentence
        off = np.bincount(owner, weights=np.log1p(-np.minimum(p, 1 - 1e-12)), minlength=len(bags))
        whole = np.maximum(-np.expm1(off), 1e-12)
        slope = np.where(y == 1, -(1 - whole) / whole, 1.0)[owner] * p
        g = np.append(np.bincount(feature, weights=slope[sentence], minlength=n) / total + 1e-4 * w, slope.sum() / total)
        m += 0.1 * (g - m)
        v += 0.01 * (g * g - v)
        move = 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        w -= move[:-1]
        bias -= float(move[-1])
    return w, bias


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, score, offending``: offending lists (start, end, probability) of sentences at 0.3 or more."""
    kept = docs.select("doc_id", text_or_empty().alias("text"))
    kind = kept.schema["doc_id"].dataType.simpleString()
    scorer: list[Scorer] = []

    def rows(batch: pa.RecordBatch) -> dict:
        if not scorer:
            scorer.append(Scorer(model))
        scores, offending = [], []
        for text in batch.column("text").to_pylist():
            found = scorer[0].sentences(text)
            clean = 1.0
            for _, _, p in found:
                clean *= 1 - p
            scores.append(min(1.0, max(0.0, 1 - clean)))
            offending.append([{"start": a, "end": b, "probability": p} for a, b, p in found if p >= 0.3])
        return {"doc_id": batch.column("doc_id"), "score": scores, "offending": offending}

    return per_row(kept, f"doc_id {kind}, score double, offending array<struct<start: int, end: int, probability: double>>", rows)
