"""Language identification by a convolutional network over bytes.

A text, lower-cased, is cut into windows of a fixed number of bytes that cover all of it.  The
network embeds the bytes, runs filters of several widths over them, takes each filter's
maximum in the window and maps these to a softmax over the languages of the training rows.  It is
trained in numpy from a bounded sample of labelled rows; a text's probabilities are those of its
windows, weighted by their bytes.

Results: a text that is null or has no letter is ``und`` with score 0.  Repeated rows
get equal predictions; null ids are kept; an empty table gives an empty table.  Without any
labelled row every text is ``und``.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import bounded_batches, fold, least_hashed, per_row

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 24
EMBEDDED = 12
FOLDS = 5
UNKNOWN = "und"

# Bounds of the training sample: documents of a language, and windows of a document.
DOCS_OF_LANGUAGE = 600
WINDOWS_OF_DOC = 3
EPOCHS = 8
BATCH = 64

LETTER = regex.compile(r"\p{L}")


def window_bytes(text: str, window: int = WINDOW) -> np.ndarray:
    """The windows of a text as rows of bytes; the last one is filled up with zeros."""
    raw = np.frombuffer(text.lower().encode("utf-8"), dtype=np.uint8)
    out = np.zeros(-(-len(raw) // window) * window, dtype=np.uint8)
    out[: len(raw)] = raw
    return out.reshape(-1, window)


@dataclass
class Network:
    """Weights, as trained."""

    languages: list[str]
    embedding: np.ndarray  # (256, embedded)
    filters: list[np.ndarray]  # for each width: (width, embedded, filters)
    biases: list[np.ndarray]
    dense: np.ndarray  # (widths x filters, languages)
    dense_bias: np.ndarray

    @classmethod
    def fresh(cls, languages: list[str], seed: int = 7) -> Network:
        draw = np.random.default_rng(seed)

        def normal(*shape: int, scale: float) -> np.ndarray:
            return (draw.standard_normal(shape) * scale).astype(np.float32)

        filters = [normal(w, EMBEDDED, FILTERS, scale=(2 / (w * EMBEDDED)) ** 0.5) for w in WIDTHS]
        biases = [np.zeros(FILTERS, dtype=np.float32) for _ in WIDTHS]
        total = len(WIDTHS) * FILTERS
        return cls(languages, normal(256, EMBEDDED, scale=0.5), filters, biases, normal(total, len(languages), scale=total**-0.5), np.zeros(len(languages), dtype=np.float32))

    def parameters(self) -> list[np.ndarray]:
        return [self.embedding, *self.filters, *self.biases, self.dense, self.dense_bias]

    def maxima(self, batch: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """Each filter's maximum over the window, after the rectifier, and where it stands."""
        n, t = batch.shape
        embedded = self.embedding[batch]
        pooled, places = [], []
        for width, weights, bias in zip(WIDTHS, self.filters, self.biases, strict=True):
            seen = np.concatenate([embedded[:, j : t - width + 1 + j] for j in range(width)], axis=2)
            out = seen.reshape(-1, width * EMBEDDED) @ weights.reshape(-1, FILTERS)
            out = out.reshape(n, -1, FILTERS)
            place = out.argmax(axis=1)
            pooled.append(np.take_along_axis(out, place[:, None], axis=1)[:, 0] + bias)
            places.append(place)
        return np.maximum(np.concatenate(pooled, axis=1), 0), places

    def softmax(self, pooled: np.ndarray) -> np.ndarray:
        logits = pooled @ self.dense + self.dense_bias
        logits -= logits.max(axis=1, keepdims=True)
        np.exp(logits, out=logits)
        return logits / logits.sum(axis=1, keepdims=True)

    def gradients(self, batch: np.ndarray, labels: np.ndarray) -> list[np.ndarray]:
        """Of the mean cross-entropy, in the order of ``parameters``."""
        pooled, places = self.maxima(batch)
        n = len(batch)
        off = self.softmax(pooled)
        off[np.arange(n), labels] -= 1
        off /= n
        back = (off @ self.dense.T) * (pooled > 0)
        d_embedding, d_filters, d_biases = np.zeros_like(self.embedding), [], []
        for k, (width, weights, place) in enumerate(zip(WIDTHS, self.filters, places, strict=True)):
            part = back[:, k * FILTERS : (k + 1) * FILTERS]
            d_biases.append(part.sum(axis=0))
            d_weights = np.empty_like(weights)
            for j in range(width):
                # only the byte where a filter has its maximum passes anything back
                byte = np.take_along_axis(batch, place + j, axis=1)
                d_weights[j] = np.einsum("nfe,nf->ef", self.embedding[byte], part)
                np.add.at(d_embedding, byte, part[:, :, None] * weights[j].T[None])
            d_filters.append(d_weights)
        return [d_embedding, *d_filters, *d_biases, pooled.T @ off, off.sum(axis=0)]

    def fit(self, windows: np.ndarray, labels: np.ndarray, epochs: int = EPOCHS, rate: float = 4e-3, seed: int = 11) -> Network:
        """Adam over shuffled batches; the same rows give the same network."""
        draw = np.random.default_rng(seed)
        first = [np.zeros_like(p) for p in self.parameters()]
        second = [np.zeros_like(p) for p in self.parameters()]
        step, steps = 0, epochs * -(-len(windows) // BATCH)
        for _ in range(epochs):
            order = draw.permutation(len(windows))
            for at in range(0, len(order), BATCH):
                some = order[at : at + BATCH]
                step += 1
                pace = rate * (1 - 0.9 * step / steps)
                for p, g, m, v in zip(self.parameters(), self.gradients(windows[some], labels[some]), first, second, strict=True):
                    m += 0.1 * (g - m)
                    v += 0.001 * (g * g - v)
                    p -= pace * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        return self

    def tables(self) -> list[np.ndarray]:
        """For each width and place in it, what each byte adds to each filter."""
        return [np.einsum("be,wef->wbf", self.embedding, w).astype(np.float32) for w in self.filters]


class Scorer:
    """Applies a trained network; sums over bytes are read from tables of pairs of bytes."""

    def __init__(self, network: Network) -> None:
        self.network = network
        self.steps: list[list[tuple[int, np.ndarray]]] = []
        for table in network.tables():
            width, steps, j = len(table), [], 0
            while j < width:
                if j + 1 < width:
                    steps.append((j, (table[j][:, None] + table[j + 1][None]).reshape(-1, FILTERS)))
                else:
                    steps.append((j, np.repeat(table[j], 256, axis=0)))  # the first byte of a pair counts
                j += 2
            self.steps.append(steps)

    def windows(self, batch: np.ndarray) -> np.ndarray:
        """Probabilities (windows, languages)."""
        out = [self._some(batch[at : at + 96]) for at in range(0, len(batch), 96)]
        return np.concatenate(out) if out else np.zeros((0, len(self.network.languages)))

    def _some(self, batch: np.ndarray) -> np.ndarray:
        n, t = batch.shape
        pairs = np.zeros((n, t), dtype=np.intp)
        pairs[:] = batch
        pairs <<= 8
        pairs[:, :-1] |= batch[:, 1:]
        pooled = []
        for width, steps, bias in zip(WIDTHS, self.steps, self.network.biases, strict=True):
            places = t - width + 1
            total = None
            for j, table in steps:
                part = table.take(pairs[:, j : j + places], axis=0)
                total = part if total is None else np.add(total, part, out=total)
            pooled.append(total.max(axis=1) + bias)
        return self.network.softmax(np.maximum(np.concatenate(pooled, axis=1), 0))

    def text(self, text: str | None) -> tuple[str, float]:
        return self.texts([text])[0]

    def texts(self, texts: list[str | None]) -> list[tuple[str, float]]:
        """A language and its probability for each text."""
        cut = (window_bytes(t) if t and LETTER.search(t) and self.network.languages else None for t in texts)
        result = []
        for some in _slices(cut, 4096):
            shares = self.windows(np.concatenate([c for c in some if c is not None] or [np.zeros((0, WINDOW), dtype=np.uint8)]))
            at = 0
            for c in some:
                if c is None:
                    result.append((UNKNOWN, 0.0))
                    continue
                weight = (c != 0).sum(axis=1) + 1e-9
                share = weight @ shares[at : at + len(c)] / weight.sum()
                at += len(c)
                best = int(share.argmax())
                result.append((self.network.languages[best], float(min(1.0, share[best]))))
        return result


def _slices(cut: Iterable, most: int) -> Iterator[list]:
    """Runs of texts with about ``most`` windows."""
    some, n = [], 0
    for c in cut:
        some.append(c)
        n += 0 if c is None else len(c)
        if n >= most:
            yield some
            some, n = [], 0
    if some:
        yield some


def training_windows(docs: DataFrame, folds: int = FOLDS, docs_of_language: int = DOCS_OF_LANGUAGE) -> DataFrame:
    """``lang, window``: windows of a bounded sample of the labelled rows outside fold 0.

    The rows of least id hash are taken, per language; of a long text, windows spread over all
    of it.
    """
    labelled = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & (fold("doc_id", folds) != 0))
    # at most docs_of_language rows for each language
    ids = least_hashed(labelled, "lang", lambda _: docs_of_language)
    taken = labelled.join(F.broadcast(ids), ["lang", "doc_id"], "left_semi")

    def rows(batch: pa.RecordBatch) -> dict:
        lang: list[str] = []
        out: list[bytes] = []
        for name, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
            if LETTER.search(text):
                all_of_it = window_bytes(text)
                places = np.unique(np.linspace(0, len(all_of_it) - 1, WINDOWS_OF_DOC).astype(int))
                lang += [name] * len(places)
                out += [all_of_it[i].tobytes() for i in places]
        return {"lang": lang, "window": out}

    return per_row(taken.select("lang", "text"), "lang string, window binary", rows)


def train(docs: DataFrame, folds: int = FOLDS) -> Network:
    """A network from a bounded sample of ``docs``.  The number of languages bounds it."""
    sample = training_windows(docs, folds).toPandas().sort_values(["lang", "window"])
    languages = sorted(sample["lang"].unique().tolist())
    network = Network.fresh(languages)
    if languages:
        windows = np.frombuffer(b"".join(sample["window"]), dtype=np.uint8).reshape(-1, WINDOW)
        labels = np.searchsorted(languages, sample["lang"].to_numpy())
        network.fit(windows, labels)
    return network


def identify(docs: DataFrame, network: Network) -> DataFrame:
    """``doc_id, lang_pred, score`` of every row's whole text."""
    kept = docs.select("doc_id", "text")
    kind = kept.schema["doc_id"].dataType.simpleString()
    scorer: list[Scorer] = []

    def rows(batch: pa.RecordBatch) -> dict:
        if not scorer:
            scorer.append(Scorer(network))
        found = scorer[0].texts(batch.column("text").to_pylist())
        return {"doc_id": batch.column("doc_id"), "lang_pred": [x[0] for x in found], "score": [x[1] for x in found]}

    return per_row(kept, f"doc_id {kind}, lang_pred string, score double", rows)


def accepted(docs: DataFrame, network: Network, least: float) -> DataFrame:
    """The rows whose language is known with a score of ``least`` or more, columns as they were."""
    bounded_batches(docs.sparkSession)

    @F.pandas_udf("boolean")
    def known(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = Scorer(network)
        for texts in batches:
            found = scorer.texts([t if isinstance(t, str) else None for t in texts])
            yield pd.Series([name != UNKNOWN and score >= least for name, score in found], dtype=bool)

    return docs.where(known(F.col("text")))
