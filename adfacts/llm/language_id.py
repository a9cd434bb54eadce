"""Language identification with a byte convolutional network written in numpy.

A text's UTF-8 bytes are cut into windows of ``WINDOW`` bytes (the last one padded with
zeros). A window goes through a byte embedding, convolutions of several widths, a ReLU, a
maximum over the window, and a softmax. A document's probabilities are the mean over all of
its windows, weighted by their bytes, so the whole text counts.

Training takes a bounded sample: up to ``per_label`` documents of each label, chosen by a
hash of the id, and up to ``windows_per_text`` evenly spaced windows of each. That is the only
bound; prediction covers every byte of every text. The network (some 10 KB) is sent to the
tasks with the function.

Defined results: a null text, or one without a letter, is ``und`` with score 0. Rows with a
null label or null text are not learned from. Without any labelled row every prediction is
``und``. Repeated rows get equal results. Other columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNKNOWN = "und"
WINDOW = 256
WIDTHS = (2, 3, 4)
DIMENSIONS = 4
FILTERS = 8
BATCH_WINDOWS = 64


def windows_of(data: bytes) -> np.ndarray:
    """All windows of a text as rows of byte values."""
    padded = np.zeros(max(1, -(-len(data) // WINDOW)) * WINDOW, dtype=np.uint8)
    padded[: len(data)] = np.frombuffer(data, dtype=np.uint8)
    return padded.reshape(-1, WINDOW)


@dataclass
class ByteNetwork:
    labels: list[str]
    embedding: np.ndarray
    filters: list[np.ndarray]
    biases: list[np.ndarray]
    weights: np.ndarray
    offset: np.ndarray

    @staticmethod
    def fresh(labels: list[str], seed: int = 0) -> ByteNetwork:
        rng = np.random.default_rng(seed)

        def normal(*shape: int, scale: float) -> np.ndarray:
            return rng.normal(0, scale, shape).astype(np.float32)

        return ByteNetwork(
            labels,
            normal(256, DIMENSIONS, scale=0.5),
            [normal(w * DIMENSIONS, FILTERS, scale=(w * DIMENSIONS) ** -0.5) for w in WIDTHS],
            [np.zeros(FILTERS, dtype=np.float32) for _ in WIDTHS],
            normal(len(WIDTHS) * FILTERS, len(labels), scale=0.2),
            np.zeros(len(labels), dtype=np.float32),
        )

    def parameters(self) -> list[np.ndarray]:
        return [self.embedding, *self.filters, *self.biases, self.weights, self.offset]

    def answers(self, windows: np.ndarray) -> np.ndarray:
        """What each filter makes of each place: window, place, filter.

        All widths are one product: a narrow filter has zeros for the bytes it skips.
        """
        widest = max(WIDTHS)
        kernel = np.concatenate(
            [
                np.pad(k, ((0, (widest - w) * DIMENSIONS), (0, 0)))
                for w, k in zip(WIDTHS, self.filters)
            ],
            axis=1,
        )
        places = WINDOW - widest + 1
        vectors = self.embedding[windows].reshape(len(windows), -1)
        seen = np.lib.stride_tricks.sliding_window_view(vectors, widest * DIMENSIONS, axis=1)
        columns = seen[:, ::DIMENSIONS].reshape(len(windows) * places, -1)
        return (columns @ kernel).reshape(len(windows), places, -1)

    def pooled(self, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Features of each window, and where in the window each filter answered most."""
        answer = self.answers(windows)
        places = answer.argmax(axis=1)
        best = np.take_along_axis(answer, places[:, None, :], axis=1)[:, 0]
        return np.maximum(best + np.concatenate(self.biases), 0), places

    def probabilities(self, windows: np.ndarray) -> np.ndarray:
        best = self.answers(windows).max(axis=1) + np.concatenate(self.biases)
        return _softmax(np.maximum(best, 0) @ self.weights + self.offset)

    def gradients(self, windows: np.ndarray, target: np.ndarray) -> list[np.ndarray]:
        features, places = self.pooled(windows)
        error = _softmax(features @ self.weights + self.offset)
        error[np.arange(len(target)), target] -= 1
        error /= len(target)
        back = (error @ self.weights.T) * (features > 0)
        d_embedding = np.zeros_like(self.embedding)
        d_filters, d_biases = [], []
        for i, (width, kernel) in enumerate(zip(WIDTHS, self.filters)):
            own = back[:, i * FILTERS : (i + 1) * FILTERS]
            # bytes under each filter's best place: window, filter, place in the filter
            at = places[:, i * FILTERS : (i + 1) * FILTERS, None] + np.arange(width)
            seen = windows[np.arange(len(windows))[:, None, None], at]
            inputs = self.embedding[seen].reshape(len(windows), FILTERS, -1)
            d_filters.append(np.einsum("nfk,nf->kf", inputs, own))
            d_biases.append(own.sum(axis=0))
            d_inputs = (own[:, :, None] * kernel.T[None]).reshape(*seen.shape, DIMENSIONS)
            np.add.at(d_embedding, seen, d_inputs)
        return [d_embedding, *d_filters, *d_biases, features.T @ error, error.sum(axis=0)]

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """Label and score of each whole text; windows go through in fixed batches."""
        sums = np.zeros((len(texts), len(self.labels)))
        waiting: list[tuple[int, np.ndarray, np.ndarray]] = []
        held = 0

        def flush() -> None:
            nonlocal held
            owners = np.concatenate([np.full(len(w), i) for i, w, _ in waiting])
            weights = np.concatenate([n for _, _, n in waiting])
            shares = self.probabilities(np.concatenate([w for _, w, _ in waiting]))
            np.add.at(sums, owners, shares * weights[:, None])
            waiting.clear()
            held = 0

        for i, text in enumerate(texts):
            if not self.labels or not has_letter(text):
                continue
            data = text.encode("utf-8", "surrogatepass")
            windows = windows_of(data)
            weights = np.full(len(windows), float(WINDOW))
            weights[-1] = len(data) - WINDOW * (len(windows) - 1)
            for start in range(0, len(windows), BATCH_WINDOWS):
                part = slice(start, start + BATCH_WINDOWS)
                waiting.append((i, windows[part], weights[part]))
                held += len(windows[part])
                if held >= BATCH_WINDOWS:
                    flush()
        if waiting:
            flush()
        totals = sums.sum(axis=1)
        known = totals > 0
        scores = np.where(known, sums.max(axis=1, initial=0) / np.where(known, totals, 1), 0.0)
        labels = [
            self.labels[k] if there else UNKNOWN
            for k, there in zip(sums.argmax(axis=1) if self.labels else [0] * len(texts), known)
        ]
        return labels, np.clip(scores, 0.0, 1.0)


def _softmax(scores: np.ndarray) -> np.ndarray:
    powers = np.exp(scores - scores.max(axis=1, keepdims=True))
    return powers / powers.sum(axis=1, keepdims=True)


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def train(
    texts: list[str], labels: list[str], epochs: int = 12, seed: int = 0, windows_per_text: int = 4
) -> ByteNetwork:
    """Adam on the cross entropy of single windows; the same input gives the same network."""
    names = sorted(set(labels))
    network = ByteNetwork.fresh(names, seed)
    samples, targets = [], []
    for text, label in zip(texts, labels):
        if not has_letter(text):
            continue
        windows = windows_of(text.encode("utf-8", "surrogatepass"))
        chosen = np.unique(np.linspace(0, len(windows) - 1, windows_per_text).astype(int))
        samples.append(windows[chosen])
        targets += [names.index(label)] * len(chosen)
    if not samples:
        return ByteNetwork.fresh([], seed)
    data, target = np.concatenate(samples), np.array(targets)
    values = network.parameters()
    means = [np.zeros_like(v) for v in values]
    squares = [np.zeros_like(v) for v in values]
    rng, step, size = np.random.default_rng(seed), 0, 64
    for epoch in range(epochs):
        rate = 0.01 * (1 - epoch / epochs)
        order = rng.permutation(len(data))
        for start in range(0, len(order), size):
            part, step = order[start : start + size], step + 1
            for value, mean, square, slope in zip(
                values, means, squares, network.gradients(data[part], target[part])
            ):
                mean += 0.1 * (slope - mean)
                square += 0.01 * (slope**2 - square)
                value -= rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-6)
    return network


def fit(
    labelled: DataFrame, per_label: int = 400, windows_per_text: int = 4, seed: int = 0
) -> ByteNetwork:
    """Train on ``labelled`` (doc_id, text, lang); see the module for the bounds.

    The number of labels is taken to be small, as one row of each comes to the driver.
    """
    usable = labelled.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = {r["lang"]: r["n"] for r in usable.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return ByteNetwork.fresh([], seed)
    # A hash of id and text below the label's share: about per_label rows of each label.
    unit = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1_000_003)) / 1_000_003
    share = F.lit(0.0)
    for label, n in sizes.items():
        share = F.when(F.col("lang") == label, F.lit(per_label / n)).otherwise(share)
    chosen = usable.where(unit < share).select("doc_id", "text", "lang")
    rows = sorted(_sampled_windows(chosen, windows_per_text).collect(), key=lambda r: r["order"])
    return train(
        [r["piece"] for r in rows], [r["lang"] for r in rows], seed=seed, windows_per_text=1
    )


def _sampled_windows(chosen: DataFrame, windows_per_text: int) -> DataFrame:
    """Evenly spaced pieces of a window's length, so that no whole text reaches the driver."""
    last = F.greatest(F.length("text") - WINDOW, F.lit(0))
    starts = F.array_distinct(
        F.array(*[F.floor(last * i / max(1, windows_per_text - 1)) for i in range(windows_per_text)])
    )
    return chosen.select("doc_id", "text", "lang", F.explode(starts).alias("start")).select(
        "lang",
        F.substring("text", F.col("start").cast("int") + 1, F.lit(WINDOW)).alias("piece"),
        F.xxhash64("doc_id", "start", "text").alias("order"),
    )


def language_columns(text: Column, network: ByteNetwork) -> Column:
    """Struct of ``lang_pred`` and ``score``."""

    @F.pandas_udf("lang_pred string, score double")
    def batch(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in parts:
            labels, scores = network.predict([t if isinstance(t, str) else None for t in texts])
            yield pd.DataFrame({"lang_pred": labels, "score": scores})

    return batch(text)
