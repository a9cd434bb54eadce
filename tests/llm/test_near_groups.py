"""The rows that stay of each group of near-duplicates, held against a comparison of all pairs."""

import random
from itertools import combinations

import pytest

import corpus_pipeline
from adfacts.llm.near_groups import one_of_each_near
from adfacts.llm.simhash import fingerprint
from tests.llm.test_similar_sets import closed, crowd, plain_links

SCHEMA = "doc_id bigint, text string, row string"


def plain_stays(rows):
    prints = [(i, fingerprint(t, 5)) for i, t in rows]
    near = {(a, b) for (a, x), (b, y) in combinations(prints, 2) if (x ^ y).bit_count() <= 4}
    group = closed([i for i, _ in rows], near | plain_links(rows))
    return sorted(i for i in group if group[i] == i)


@pytest.mark.parametrize("hubs", [1, 32])
def test_rows_that_stay_equal_all_pairs(spark, hubs):
    rng = random.Random(hubs)
    texts = [t for _, t in crowd(7)]
    texts += rng.choices(texts, k=15) + [None, "", "one"]
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], SCHEMA).repartition(3)
    kept = one_of_each_near(docs, hubs=hubs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == plain_stays(rows)


def test_a_link_of_a_document_that_goes_counts(spark):
    """1 and 2 have near fingerprints; 3 shares 0.8 of its shingles with 2 only."""
    rng = random.Random(11)
    for _ in range(5000):
        words = [f"v{rng.randrange(10**6)}" for _ in range(60)]
        other, third = list(words), list(words)
        for i in (5, 50):
            other[i] += "x"
        third[20] += "y"
        texts = [(1, " ".join(other)), (2, " ".join(words)), (3, " ".join(third))]
        a, b, c = (fingerprint(t, 5) for _, t in texts)
        if plain_links(texts) == {(2, 3)} and (a ^ b).bit_count() <= 4 < min((a ^ c).bit_count(), (b ^ c).bit_count()):
            break
    else:
        raise AssertionError("no such texts")
    docs = spark.createDataFrame([(i, t, "x") for i, t in texts], SCHEMA)
    assert [r["doc_id"] for r in corpus_pipeline.near_dedup(spark, docs, "").collect()] == [1]


def test_rows_without_an_id_and_shared_ids(spark):
    long = " ".join(f"v{i}" for i in range(2000))
    rows = [(5, long, "a"), (4, long + " end", "b"), (None, long, "c"), (None, "alone", "d")]
    rows += [(7, None, "e"), (8, "", "f"), (9, "two words", "g"), (9, "others here", "h")]
    kept = one_of_each_near(spark.createDataFrame(rows, SCHEMA))
    assert sorted(r["row"] for r in kept.collect()) == ["b", "c", "d", "e", "g", "h"]
    lone = one_of_each_near(spark.createDataFrame(rows[:3], SCHEMA))
    assert sorted(r["row"] for r in lone.collect()) == ["b"]
    assert one_of_each_near(spark.createDataFrame(rows, SCHEMA).limit(0)).count() == 0
