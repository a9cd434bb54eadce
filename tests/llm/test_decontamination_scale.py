"""Decontamination with more anchors than are broadcast, long documents, and copies of items."""

from __future__ import annotations

import random

import pytest

from adfacts.llm import decontamination

SCHEMA = "doc_id long, text string"
ITEMS = "item_id long, text string"


def prose(words: int, seed: int) -> list[str]:
    draw = random.Random(seed)
    return ["".join(draw.choices("abcdefghijklmnop", k=9)) for _ in range(words)]


@pytest.fixture(scope="module")
def tables(spark):
    """Documents with whole, changed, cut and repeated passages, null and shared ids; items of several lengths."""
    items = [prose(n, 10 + n) for n in (5, 7, 12, 25, 33, 40, 58, 90)]
    draw = random.Random(1)
    docs = []
    for i in range(60):
        passage = list(items[i % len(items)])
        for _ in range(i // 8 % 4):
            passage[draw.randrange(len(passage))] = "changed"
        if i // 8 % 5 == 1:
            passage.insert(len(passage) // 2, "more")
        if i // 8 % 7 == 2:
            del passage[: len(passage) // 6]
        before, after = prose(draw.randrange(0, 40), 100 + i), prose(draw.randrange(0, 40), 200 + i)
        docs.append((None if i % 13 == 0 else i % 50, " ".join([*before, *passage, *after, *passage[: i % 9]])))
    docs += [docs[3], (1, None), (2, ""), (3, "too short")]
    bench = [(i, " ".join(item)) for i, item in enumerate(items)]
    bench += [(90, bench[3][1]), (None, bench[4][1]), (None, bench[4][1]), (2, bench[6][1].upper()), (95, None)]
    return spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(bench, ITEMS)


def found(df) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture()
def shuffled(spark):
    """Nothing is broadcast unless the code asks for it, as with large tables."""
    name = "spark.sql.autoBroadcastJoinThreshold"
    spark.conf.set(name, "-1")
    yield
    spark.conf.unset(name)


def test_looked_up_anchors_find_the_same_windows(tables):
    expected = found(decontamination.contaminated_windows(*tables))
    assert len({row[2] for row in expected}) >= 9  # most items, copies among them
    for lookup_rows in (4_000_000, 7):  # 7: several parts
        got = decontamination.contaminated_windows(*tables, broadcast_rows=0, lookup_rows=lookup_rows)
        assert found(got) == expected
    assert found(decontamination.without_contaminated(*tables, broadcast_rows=0)) == found(
        decontamination.without_contaminated(*tables)
    )


def test_a_long_document_is_not_sent_once_per_word(spark, shuffled):
    """20,000 words, each of which was sent with all of them."""
    item = prose(30, 1)
    docs = spark.createDataFrame([(1, " ".join([*prose(15_000, 2), *item, *prose(5_000, 3)]))], SCHEMA)
    bench = spark.createDataFrame([(7, " ".join(item))], ITEMS)
    got = found(decontamination.contamination(docs, bench, broadcast_rows=0))
    assert got == [(1, 7, 15_000, 30, 1.0)]


def test_items_that_differ_in_their_id_alone_are_looked_for_once(spark, monkeypatch):
    item = " ".join(prose(30, 1))
    docs = spark.createDataFrame([(1, f"{item} {' '.join(prose(20, 2))}")], SCHEMA)
    rows = {}

    def counted(df, label):
        rows[label] = (table := written(df, label)).count()
        return table

    written = decontamination.written
    monkeypatch.setattr(decontamination, "written", counted)
    windows = []
    for copies in (1, 50):
        bench = spark.createDataFrame([(i, item) for i in range(copies)], ITEMS)
        assert sorted(r[1] for r in found(decontamination.contamination(docs, bench))) == list(range(copies))
        windows.append(rows["decontamination-windows"])
    assert windows[0] == windows[1]


def test_stage_of_the_pipeline_with_many_anchors(spark, shuffled):
    """The pipeline's stage keeps clean long documents, and asks for no id of an item."""
    item = prose(30, 1)
    docs = [(1, " ".join([*prose(15_000, 2), *item])), (2, " ".join(prose(15_000, 3))), (None, None)]
    bench = spark.createDataFrame([(i, " ".join(item)) for i in range(40)], ITEMS)
    kept = decontamination.without_contaminated(spark.createDataFrame(docs, SCHEMA), bench, broadcast_rows=0)
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 2]
