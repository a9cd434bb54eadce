"""Periodic run detection: words that go round in a circle, found by seeds and diagonals.

A run is a stretch of consecutive words with smallest period q (words q apart are identical) and
length >= max(``min_length``, ``min_exponent`` * q) that no neighbouring word extends. On the
diagonal of lag q, where word p is compared with word p + q, it is a stretch of at least
max(``min_length``, ``min_exponent`` * q) - q matches. Periods are taken in classes 2^t..2^(t+1)-1;
the least such overlap in a class is the length k of its seeds:

1. *Seeds.* All k-grams of the document are indexed exactly, by naming grams of 2^j words from
   pairs of names of 2^(j-1). Neighbouring occurrences of one gram at a lag within the class are
   the occurrence pairs to look at.
2. *Extension.* A pair is extended along its diagonal to both sides. Per lag the furthest covered
   place is kept: pairs below it lie in a stretch that was already extended and are passed over.

Neighbouring occurrences suffice. If a seed of a run with period q occurred again d < q words
later, the run would have the periods d and q over at least d + q - 1 words (k >= q - 1, since
``min_exponent`` >= 3) and so, by Fine and Wilf, their common divisor, a smaller one. For the same
reason an accepted stretch has no smaller period than its lag. Each class has at most one pair
per place, and there are log2(n) classes: a text of one repeated word stays cheap.

A document is one row and is treated as a whole, without shuffles. Null texts, texts without
words and texts without runs give empty arrays; the collapsed text is then the words joined by
single spaces (empty for null). Equal rows, null ids and further columns do not matter: the operator maps a
text column.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from adfacts.llm.common import WORD

Run = tuple[int, int, int]  # start, length, period

RESULT = "starts array<bigint>, lengths array<bigint>, periods array<bigint>, collapsed string"


def _ranks(keys: np.ndarray) -> np.ndarray:
    return np.unique(keys, return_inverse=True)[1].astype(np.int64)


class _Grams:
    """Exact names of the grams of one word sequence, doubled in length as they are asked for."""

    def __init__(self, codes: np.ndarray) -> None:
        self.named = [_ranks(codes)]  # of 1, 2, 4, … words

    def keys(self, k: int) -> np.ndarray:
        """One number per place; equal numbers are equal k-grams. Two overlapping grams of 2^j
        words cover a k-gram."""
        j = k.bit_length() - 1
        while len(self.named) <= j:
            last, width = self.named[-1], 1 << (len(self.named) - 1)
            self.named.append(_ranks(last[:-width] * len(last) + last[width:]))
        names, shift = self.named[j], k - (1 << j)
        if shift == 0:
            return names
        return names[:-shift] * len(names) + names[shift:]


def _matches(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the common start of two arrays, compared in growing steps."""
    n, done, step = min(len(a), len(b)), 0, 64
    while done < n:
        stop = min(n, done + step)
        same = a[done:stop] == b[done:stop]
        if not same.all():
            return done + int(same.argmin())
        done, step = stop, step * 2
    return n


def _least_overlap(periods: range, min_length: int, min_exponent: int) -> int:
    """Least number of matches that a run leaves on its diagonal, over a class of periods.

    It falls while ``min_length`` decides and rises afterwards, so ends and bend are enough.
    """
    bend = min_length // min_exponent
    places = [periods[0], periods[-1], *(q for q in (bend, bend + 1) if q in periods)]
    return min(max(min_length, min_exponent * q) - q for q in places)


def maximal_runs(codes: np.ndarray, min_length: int = 6, min_exponent: int = 4) -> list[Run]:
    """All runs of a sequence of word codes, by start, then period."""
    if min_exponent < 3 or min_length < 2:
        raise ValueError("runs need min_exponent >= 3 and min_length >= 2")
    n, runs = len(codes), []
    grams, unique_from = None, n + 1  # grams of so many words occur once only
    low = 1
    while max(min_length, min_exponent * low) <= n:
        periods = range(low, 2 * low)
        k = _least_overlap(periods, min_length, min_exponent)
        low *= 2
        if k >= unique_from:
            continue
        grams = grams or _Grams(codes)
        keys = grams.keys(k)
        order = np.argsort(keys, kind="stable")
        again = keys[order[1:]] == keys[order[:-1]]
        if not again.any():
            unique_from = k
            continue
        first, lags = order[:-1][again], np.diff(order)[again]
        within = (lags >= periods.start) & (lags < periods.stop)
        first, lags = first[within], lags[within]
        by_lag = np.lexsort((first, lags))
        first, lags = first[by_lag], lags[by_lag]
        for q, begin, end in _stretches_of(lags):
            runs += _runs_on_diagonal(codes, first[begin:end], q, max(min_length, min_exponent * q))
    return sorted(runs, key=lambda run: (run[0], run[2]))


def _stretches_of(lags: np.ndarray) -> Iterator[tuple[int, int, int]]:
    cuts = np.flatnonzero(np.diff(lags)) + 1
    borders = [0, *cuts.tolist(), len(lags)] if len(lags) else []
    for begin, end in zip(borders, borders[1:]):
        yield int(lags[begin]), begin, end


def _runs_on_diagonal(codes: np.ndarray, seeds: np.ndarray, q: int, least: int) -> list[Run]:
    found, i = [], 0
    while i < len(seeds):
        p = int(seeds[i])
        covered = p + _matches(codes[p:], codes[p + q :])
        start = p - _matches(codes[:p][::-1], codes[q : p + q][::-1])
        if covered + q - start >= least:
            found.append((start, covered + q - start, q))
        i = int(np.searchsorted(seeds, covered))  # the furthest covered place of this lag
    return found


def word_codes(words: list[str]) -> np.ndarray:
    numbers: dict[str, int] = {}
    return np.array([numbers.setdefault(word, len(numbers)) for word in words], dtype=np.int64)


def without_repeats(words: list[str], runs: list[Run]) -> list[str]:
    """The words, without those that a run holds after its first period."""
    if not runs:
        return words
    depth = np.zeros(len(words) + 1, dtype=np.int64)
    for start, length, period in runs:
        depth[start + period] += 1
        depth[start + length] -= 1
    kept = np.cumsum(depth[:-1]) == 0
    return [words[i] for i in np.flatnonzero(kept)]


def periodic_runs(text: Column, min_length: int = 6, min_exponent: int = 4) -> Column:
    """A struct of ``RESULT``: the runs by start, then period, and the text without repeats."""
    pattern = re.compile(WORD)

    @F.pandas_udf(RESULT)
    def runs_of(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for one in texts:
            words = pattern.findall(one or "")
            runs = maximal_runs(word_codes(words), min_length, min_exponent)
            columns = [[run[i] for run in runs] for i in range(3)]
            rows.append((*columns, " ".join(without_repeats(words, runs))))
        return pd.DataFrame(rows, columns=["starts", "lengths", "periods", "collapsed"])

    return runs_of(text)
