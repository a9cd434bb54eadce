"""Periodic runs against a scan of all lags, and the registered query against its contract."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from adfacts.llm import queries
from adfacts.llm.periodic_runs import maximal_runs, periodic_runs, without_repeats, word_codes


def all_runs(words, min_length=6, min_exponent=4):
    """Every lag is scanned over the whole sequence; the smallest period is tested as such."""
    found = []
    for q in range(1, len(words) // min_exponent + 1):
        p = 0
        while p < len(words) - q:
            start = p
            while p < len(words) - q and words[p] == words[p + q]:
                p += 1
            stretch = words[start : p + q]
            if p > start and len(stretch) >= max(min_length, min_exponent * q):
                if all(stretch[d:] != stretch[:-d] for d in range(1, q)):
                    found.append((start, len(stretch), q))
            p += 1
    return sorted(found, key=lambda run: (run[0], run[2]))


def circular(rng, size, letters):
    words = []
    while len(words) < size:
        if rng.random() < 0.5:
            block = [rng.randrange(letters) for _ in range(rng.randint(1, 9))]
            words += (block * rng.randint(1, 8))[: rng.randint(1, 70)]
        else:
            words.append(rng.randrange(letters))
    return words


@pytest.mark.parametrize("bounds", [(6, 4), (2, 3), (20, 3), (9, 5), (13, 4)])
def test_all_runs_are_found(bounds):
    rng, total = random.Random(3), 0
    for _ in range(300):
        words = circular(rng, rng.randint(0, 90), rng.choice([1, 2, 3, 5]))
        expected = all_runs(words, *bounds)
        total += len(expected)
        assert maximal_runs(word_codes(words), *bounds) == expected, words
    assert total > 100


def test_bounds_that_neighbouring_occurrences_cannot_serve():
    with pytest.raises(ValueError):
        maximal_runs(np.zeros(10, dtype=np.int64), min_exponent=2)


def test_long_circles_stay_cheap():
    assert maximal_runs(np.zeros(300_000, dtype=np.int64)) == [(0, 300_000, 1)]
    assert maximal_runs(np.arange(300_000) % 1000) == [(0, 300_000, 1000)]


def test_repeats_of_overlapping_runs_go():
    words = list("xabababab") + list("abcabcabcabc")
    runs = maximal_runs(word_codes(words))
    assert "".join(without_repeats(words, runs)) == "xabc"


TEXTS = [
    None, "", " \t\n", "one", "a a a a a a", "a a a a a", "so it is " * 5, "x " + "y z " * 300,
    " ".join(str(i) for i in range(30_000)), "tab\tand nbsp and\x85next " * 6,
]


def test_column_over_odd_rows(spark):
    rows = [(i, t, "clash") for i, t in enumerate(TEXTS)] + [(None, "b b b b b b b", ""), (4, TEXTS[4], "clash")]
    df = spark.createDataFrame(rows, "doc_id int, text string, found string")
    got = df.select("doc_id", "text", periodic_runs(F.col("text")).alias("runs")).collect()
    assert len(got) == len(rows)
    for row in got:
        words = re.findall(r"[^\x20\x09-\x0D]+", row.text or "")
        expected = all_runs(words) if len(words) < 2000 else []
        assert list(zip(row.runs.starts, row.runs.lengths, row.runs.periods)) == expected
        assert row.runs.collapsed == " ".join(without_repeats(words, expected))
    assert df.limit(0).select(periodic_runs(F.col("text")).alias("runs")).count() == 0


def contract(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    if doc_id is not None and n and zlib.crc32(str(doc_id).encode()) % 10 == 0:
        g = zlib.crc32(str(doc_id).encode()) // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = all_runs(words)
    dropped = {i for start, length, period in runs for i in range(start + period, start + length)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else (None,) * 3
    listed = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    kept = " ".join(word for i, word in enumerate(words) if i not in dropped)
    return (
        doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
        hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest(),
    )


def test_query(spark, tmp_path):
    rng = random.Random(8)
    rows = [(i, " ".join(map(str, circular(rng, rng.randint(1, 200), 60)))) for i in range(300)]
    rows += [(1000 + i, text) for i, text in enumerate(TEXTS) if len(text or "") < 9000]
    rows += [(None, "c c c c c c d"), (3, rows[3][1])]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    result = queries.op11_periodic_runs(spark, str(tmp_path))
    assert dict(result.dtypes)["exponent_milli"] == "bigint"
    assert sorted(map(tuple, result.collect()), key=str) == sorted((contract(*r) for r in rows), key=str)
