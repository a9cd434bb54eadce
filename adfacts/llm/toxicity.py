"""Toxicity by multiple-instance learning: sentences are the instances, a document the bag.

A sentence's probability is the logistic of a bias and the weights of its distinct words; the
document's is the noisy-or 1 - prod(1 - p) over its sentences. Only documents are labelled:
training lowers the document's cross entropy, and the noisy-or passes each label on to the
sentences that explain it. The same weights then point at the offending sentences: all whose own
probability is at least ``OFFENDING``. A clean document has none of them.

Training takes a bounded sample: about ``max_rows`` labelled documents, chosen by a hash of
the id, and the words that ``min_docs`` or more of them have. That is the only bound; every
sentence of every text is scored. The weights (at most ``max_words``) go out with the function.

Defined results: null text counts as empty. A text without words has one empty sentence, so it
scores as the bias says. Without labelled rows every score is that of a fixed low bias. Repeated
documents are learned from once each and score alike. Rows with a null label teach nothing.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SENTENCE_END = re.compile(r"[.!?\n]+(?:\s|$)")
WORDS = re.compile(r"[^\W\d_]+")
START_BIAS = -6.0
OFFENDING = 0.5


def sentence_words(text: str | None) -> list[tuple[str, set[str]]]:
    """Each sentence with its distinct lower-cased words; one empty sentence at least."""
    parts = [s for s in SENTENCE_END.split(text or "") if s and not s.isspace()] or [""]
    return [(s, set(WORDS.findall(s.lower()))) for s in parts]


class ToxicityModel:
    def __init__(self, weights: dict[str, float], bias: float) -> None:
        self.weights, self.bias = weights, bias

    def sentence_scores(self, text: str | None) -> tuple[list[str], np.ndarray]:
        get = self.weights.get
        sentences = sentence_words(text)
        scores = [self.bias + sum(get(w, 0.0) for w in words) for _, words in sentences]
        return [s for s, _ in sentences], _logistic(np.array(scores))

    def score(
        self, text: str | None, offending: float = OFFENDING
    ) -> tuple[float, int, str, list[dict]]:
        """Noisy-or of the document; number and text of its most toxic sentence; every sentence
        of at least ``offending`` with its number, probability and text, in their order."""
        sentences, p = self.sentence_scores(text)
        worst = int(p.argmax())
        found = [
            {"sentence": int(i), "probability": float(p[i]), "text": sentences[i]}
            for i in np.flatnonzero(p >= offending)
        ]
        whole = float(-np.expm1(np.log1p(-np.minimum(p, 1 - 1e-12)).sum()))
        return whole, worst, sentences[worst], found


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def train(
    texts: list[str | None],
    labels: list[int],
    min_docs: int = 5,
    max_words: int = 50_000,
    steps: int = 150,
    penalty: float = 0.0003,
) -> ToxicityModel:
    """Full-batch Adam with an L1 penalty on the weights; the same input gives the same model.

    A word stays at weight zero unless its pull on the mean loss exceeds ``penalty``: chance
    company of the labelled documents explains nothing.
    """
    bags = [[words for _, words in sentence_words(t)] for t in texts]
    seen = Counter(w for bag in bags for w in set().union(*bag))
    names = sorted((w for w, n in seen.items() if n >= min_docs), key=lambda w: (-seen[w], w))
    names = names[:max_words]
    if not bags:
        return ToxicityModel({}, START_BIAS)
    index = {w: i for i, w in enumerate(names)}
    sentence_of, word_of, bag_of = [], [], []
    for b, bag in enumerate(bags):
        for words in bag:
            known = [index[w] for w in words if w in index]
            sentence_of += [len(bag_of)] * len(known)
            word_of += known
            bag_of.append(b)
    sentence_of, word_of = np.array(sentence_of, dtype=np.int64), np.array(word_of, dtype=np.int64)
    bag_of, target = np.array(bag_of), np.array(labels, dtype=float)
    values = np.zeros(len(names) + 1)
    values[-1] = START_BIAS
    mean, square = np.zeros_like(values), np.zeros_like(values)
    rate = 0.3
    for step in range(1, steps + 1):
        scores = values[-1] + np.bincount(
            sentence_of, weights=values[word_of], minlength=len(bag_of)
        )
        p = np.minimum(_logistic(scores), 1 - 1e-9)
        clean = np.bincount(bag_of, weights=np.log1p(-p), minlength=len(bags))
        toxic = np.clip(-np.expm1(clean), 1e-9, 1 - 1e-9)
        # d loss / d score: p for clean bags, p - p/toxic for toxic ones
        slope = p * (1 - target[bag_of] / toxic[bag_of]) / len(bags)
        gradient = np.append(
            np.bincount(word_of, weights=slope[sentence_of], minlength=len(names)), slope.sum()
        )
        pull, at = gradient[:-1], values[:-1]
        resting = (at == 0) & (np.abs(pull) <= penalty)
        pull += penalty * np.where(at != 0, np.sign(at), -np.sign(pull))
        pull[resting] = 0
        before = np.sign(at)
        mean += 0.1 * (gradient - mean)
        square += 0.01 * (gradient**2 - square)
        mean[:-1][resting] = 0
        size = rate * (1 - step / (steps + 1))
        values -= size * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-6)
        values[:-1][before * values[:-1] < 0] = 0  # a weight stops at zero
    weights = {w: float(v) for w, v in zip(names, values[:-1]) if v}
    return ToxicityModel(weights, float(values[-1]))


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = 4_000) -> ToxicityModel:
    """Train on about ``max_rows`` of the ``docs`` (doc_id, text) that ``labels`` marks."""
    marked = labels.where(F.col("toxic").isNotNull()).groupBy("doc_id").agg(
        F.max("toxic").alias("toxic")
    )
    n = marked.count()
    unit = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_003)) / 1_000_003
    chosen = marked.where(unit < max_rows / max(n, 1))
    rows = chosen.join(docs.select("doc_id", "text"), "doc_id").collect()  # bounded, see above
    rows.sort(key=lambda r: (r["doc_id"], r["text"] or ""))
    return train([r["text"] for r in rows], [int(r["toxic"]) for r in rows])


def toxicity_columns(text: Column, model: ToxicityModel) -> Column:
    """Struct of ``score``, ``worst_sentence`` (its number), ``worst_text`` and ``offending``."""
    offending = "array<struct<sentence: int, probability: double, text: string>>"

    @F.pandas_udf(f"score double, worst_sentence int, worst_text string, offending {offending}")
    def batch(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in parts:
            found = [model.score(t if isinstance(t, str) else None) for t in texts]
            yield pd.DataFrame(found, columns=["score", "worst_sentence", "worst_text", "offending"])

    return batch(text)
