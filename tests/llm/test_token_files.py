"""Token files: exact round trips, and the registered query against whole-text encoding."""

from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from adfacts.llm import queries
from adfacts.llm.token_files import (
    FileReader,
    FileWriter,
    from_planes,
    plane_count,
    read_token_files,
    to_planes,
    write_token_files,
)

WORDS = str(public_tokenizers.path("word_bpe_49k.json"))
TEXTS = [
    None, "", " \n\t", "One two two.", "İstanbul ΣΑΣ é é ﬁ", "<|startoftext|>a<|endoftext|> b", "a\x1c! b c　d",
    "word " * 9000, "z" * 5000, "it's we'll 12 345", "\x00 ́mark 漢字 😀",
]


@pytest.mark.parametrize("kind", ["bit", "byte"])
@pytest.mark.parametrize("n", [0, 1, 7, 8, 1000])
def test_planes_return(kind, n):
    for largest in (1, 255, 256, 49_407, 2**32 - 1):
        ids = np.random.default_rng(n).integers(0, largest, n, dtype=np.uint32, endpoint=True)
        planes = to_planes(ids, plane_count(largest, kind), kind)
        assert from_planes(planes, n, kind).tolist() == ids.tolist()


def test_planes_are_transposed():
    ids = np.array([1, 0, 0, 0, 0, 0, 0, 3], dtype=np.uint32)
    assert to_planes(ids, 2, "bit") == [bytes([0b10000001]), bytes([0b00000001])]
    assert to_planes(np.array([258, 3], dtype=np.uint32), 2, "byte") == [bytes([2, 3]), bytes([1, 0])]


@pytest.mark.parametrize("kind", ["bit", "byte"])
def test_file_and_its_index(tmp_path, kind):
    rng = np.random.default_rng(3)
    docs = [(i if i % 7 else None, rng.integers(0, 50_000, int(n), dtype=np.uint32)) for i, n in enumerate([0, 5, 900, 0, 1, 64, 63, 4000])]
    writer = FileWriter(str(tmp_path / "x.planes"), 50_000, kind, block_ids=64)
    for doc_id, ids in docs:
        writer.add(doc_id, ids)
    writer.close()
    reader, every = FileReader(str(tmp_path / "x.planes")), np.concatenate([ids for _, ids in docs])
    assert reader.documents() == [(doc_id, len(ids)) for doc_id, ids in docs]
    assert [n for _, n, _ in reader.index["blocks"]] == [64] * (len(every) // 64) + [len(every) % 64]
    for start, stop in [(0, len(every)), (0, 0), (63, 65), (700, 701), (128, 192), (len(every) - 1, len(every))]:
        parts = list(reader.ids(start, stop))
        assert len(parts) <= (stop - start) // 64 + 2  # only the blocks of the range are read
        assert np.concatenate([np.zeros(0, np.uint32), *parts]).tolist() == every[start:stop].tolist()
    reader.close()
    (tmp_path / "y.planes").write_bytes(b"something else altogether")
    with pytest.raises(ValueError):
        FileReader(str(tmp_path / "y.planes"))


def some_rows():
    rng = random.Random(6)
    words = "The quick Brown fox's über 12 x, . tokens 東京 \n".split(" ")
    rows = [(i * 3, " ".join(rng.choices(words, k=rng.randint(0, 80)))) for i in range(200)]
    rows += [(1000 + i, text) for i, text in enumerate(TEXTS)]
    return rows + [(2**60 + 1, "a long id"), (-4, "before zero")]


def expected(rows):
    tokenizer, start, result = Tokenizer.from_file(WORDS), 0, []
    for doc_id, text in rows:
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [1], dtype="<u4")
        result.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return result


def test_query(spark, tmp_path):
    rows = some_rows()
    random.Random(1).shuffle(rows)
    table = spark.createDataFrame([(*row, "clash") for row in rows], "doc_id bigint, text string, ids string")
    table.repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    result = queries.op13_token_planes(spark, str(tmp_path))
    assert [kind for _, kind in result.dtypes] == ["bigint"] * 4
    assert sorted(map(tuple, result.collect())) == sorted(expected(sorted(rows)))


@pytest.mark.parametrize("kind", ["bit", "byte"])
def test_many_files_with_ties_and_null_ids(spark, tmp_path, kind):
    rows = some_rows()
    rows += [(9, "same id and text")] * 300 + [(9, f"same id {i % 5}") for i in range(100)] + [(None, "no id")] * 2
    table = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    manifest = write_token_files(table, str(tmp_path / "out"), WORDS, 1, kind, block_ids=100, ids_per_file=1000)
    files = manifest.orderBy("part", "number").collect()
    assert len(files) > 10
    assert all(f.n_ids <= 1000 or f.n_docs == 1 for f in files)
    assert sum(f.n_docs for f in files) == len(rows)
    read = sorted(read_token_files(manifest).collect(), key=lambda row: row.start)
    digests = sorted(read_token_files(manifest, digest=True).collect(), key=lambda row: row.start)
    order = [(row.doc_id is not None, row.doc_id or 0) for row in read]
    assert order == sorted(order)
    assert [row.start for row in read] == np.cumsum([0, *[row.n_tokens for row in read[:-1]]]).tolist()
    for row, digest in zip(read, digests):
        data = np.array(row.ids, dtype="<u4").tobytes()
        assert (row.doc_id, row.n_tokens, zlib.crc32(data)) == (digest.doc_id, len(row.ids), digest.ids_crc32)
    plain = sorted(((r[0] is not None, r[0] or 0), r[2], r[3]) for r in expected(rows))
    assert plain == sorted(((r.doc_id is not None, r.doc_id or 0), r.n_tokens, r.ids_crc32) for r in digests)


def test_empty_table(spark, tmp_path):
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    manifest = write_token_files(empty, str(tmp_path / "out"), WORDS, 1)
    assert manifest.count() == 0 and read_token_files(manifest).count() == 0
    assert not list((tmp_path / "out").iterdir())
