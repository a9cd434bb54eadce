"""Alignment of two tokenizers against a plain count over whole texts, encoded in one piece."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from adfacts.llm import queries
from adfacts.llm.alignment import aligned, heap_merge, highest
from adfacts.llm.encoding import LONGEST, Memory, byte_letters

A_PATH = str(public_tokenizers.path("byte_bpe_50k.json"))
B_PATH = str(public_tokenizers.path("piece_bpe_32k.model"))

TEXTS = [
    None, "", " ", "  two  blanks ", "one", "Plain words, plain words.", "\n lines\n\nof\ttext \r\n",
    "<|endoftext|> and <s> </s> <unk> are text", "▁blank sign▁", "Zürich naïve 東京 タワー 😀 é\x00", "a ▁ b",
    "x" * 3000, "12345 6.78 don't we'll", "no break 　wide᠎ sign \x1c\x85 end", "the " * 4000,
]


def byte_ends(parts):
    return np.cumsum([len(part) for part in parts]).tolist()


def plain(rows):
    """doc_id and the columns of the contract, each text encoded whole."""
    a_model = Tokenizer.from_file(A_PATH)
    a_model.encode_special_tokens = True
    b_model = sentencepiece.SentencePieceProcessor(model_file=B_PATH)
    letters = byte_letters()
    found, counts = [], Counter()
    for doc_id, text in rows:
        if not text:
            found.append((doc_id, None))
            continue
        a, b = a_model.encode(" " + text, add_special_tokens=False).ids, b_model.encode(text)
        a_parts = [bytes(letters[c] for c in a_model.id_to_token(i)) for i in a]
        pieces = [b_model.id_to_piece(i) for i in b]
        b_parts = [
            bytes([int(p[3:-1], 16)]) if b_model.is_byte(i) else p.replace("▁", " ").encode()
            for i, p in zip(b, pieces)
        ]
        if not b"".join(a_parts) == b"".join(b_parts) == (" " + text).encode():
            found.append((doc_id, None))
            continue
        a_ends, b_ends = byte_ends(a_parts), byte_ends(b_parts)
        cuts = sorted(set(a_ends) & set(b_ends))
        groups, links, i, j = [], [], 0, 0
        for cut in cuts:
            to_i, to_j = a_ends.index(cut) + 1, b_ends.index(cut) + 1
            groups.append("|".join(",".join(map(str, ids)) for ids in (a[i:to_i], b[j:to_j])))
            links.append((a[to_i - 1], b[to_j - 1]))
            i, j = to_i, to_j
        counts.update(links)
        found.append((doc_id, (len(a), len(b), groups, links)))
    top = {}
    for (_, b), n in counts.items():
        top[b] = max(top.get(b, 0), n)
    result = []
    for doc_id, one in found:
        if one is None:
            result.append((doc_id, 0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, groups, links = one
        best = sum(counts[link] == top[link[1]] for link in links)
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest()
        result.append((doc_id, n_a, n_b, len(groups), len(links), best, sum(counts[x] for x in links), digest))
    return sorted(result, key=str)


def some_rows():
    rng = random.Random(4)
    words = "a an the Apfel über token tokens, Tokenizer's x1 2024 — end.\nNew\t→ 漢字 naïve".split(" ")
    rows = [(i, " ".join(rng.choices(words, k=rng.randint(1, 60)))) for i in range(120)]
    rows += [(500 + i, text) for i, text in enumerate(TEXTS)]
    return rows + [(None, "a null id"), (2**60 + 1, "a long id"), rows[5], rows[5]]


@pytest.fixture()
def table(spark):
    rows = [(i, text, "clash", 1) for i, text in some_rows()]
    return spark.createDataFrame(rows, "doc_id bigint, text string, block string, radix int")


@pytest.mark.parametrize("limits", [{}, {"block_chars": 300, "group_bytes": 1500}])
def test_alignment(table, limits):
    result = aligned(table.repartition(5), A_PATH, B_PATH, **limits)
    assert sorted(map(tuple, result.collect()), key=str) == plain(some_rows())


def test_query_and_empty_table(spark, table, tmp_path):
    table.write.parquet(f"{tmp_path}/some/documents.parquet")
    table.limit(0).write.parquet(f"{tmp_path}/none/documents.parquet")
    result = queries.op12_tokenizer_alignment(spark, f"{tmp_path}/some")
    assert sorted(map(tuple, result.collect()), key=str) == plain(some_rows())
    assert queries.op12_tokenizer_alignment(spark, f"{tmp_path}/none").count() == 0


def test_heap_merge():
    rng, total, runs = random.Random(1), Counter(), []
    for _ in range(9):
        keys = sorted(rng.sample(range(3000), rng.randint(0, 900)))
        counts = [rng.randint(1, 5) for _ in keys]
        total.update(dict(zip(keys, counts)))
        cuts = [0, *sorted(rng.sample(range(len(keys) + 1), min(4, len(keys)))), len(keys)]
        frames = [(np.array(keys[i:j]), np.array(counts[i:j])) for i, j in zip(cuts, cuts[1:])]
        runs.append(iter(frames))
    merged = [pair for keys, counts in heap_merge(runs) for pair in zip(keys.tolist(), counts.tolist())]
    assert merged == sorted(total.items())


def test_highest_counts_of_a_side():
    keys = np.array([(b << 32) | a for b, a in [(0, 5), (0, 9), (3, 1), (7, 1), (7, 2), (7, 4)]])
    assert highest(keys, np.array([1, 2, 1, 4, 3, 4])).tolist() == [False, True, True, True, False, True]


def test_memory_of_segments_is_bounded(monkeypatch):
    monkeypatch.setattr("adfacts.llm.encoding.REMEMBERED", 50)
    memory, rng = Memory(lambda segments: [s.upper() for s in segments]), random.Random(2)
    for _ in range(200):
        wanted = ["ab" * rng.randint(1, 60) + str(rng.randint(0, 40)) for _ in range(rng.randint(0, 70))]
        known = memory.values(wanted)
        assert all(known[one] == one.upper() for one in wanted)
        kept = [*memory.young, *memory.old]
        assert len(kept) <= 50 and all(len(one) <= LONGEST for one in kept)
