"""The rows that stay of each group of fingerprints, held against a comparison of all pairs."""

import random

import pytest

from adfacts.llm.simhash import fingerprint, one_of_each_group


def plain_kept(rows, radius=4, shingle_words=5):
    prints = [fingerprint(text, shingle_words) for _, text, _ in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= radius:
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    first = {}
    for g, (doc_id, _, _) in zip(group, rows):
        known = first.get(g)
        first[g] = min((x for x in (known, doc_id) if x is not None), default=None)
    stays = {doc_id for g, (doc_id, _, _) in zip(group, rows) if doc_id == first[g]}
    return sorted(mark for doc_id, _, mark in rows if doc_id in stays)


@pytest.mark.parametrize("seed", [1, 2])
def test_rows_that_stay_equal_a_plain_search(spark, seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(300)]
    rows = []
    for _ in range(12):
        base = rng.choices(words, k=rng.choice([4, 60, 300]))
        for _ in range(rng.choice([1, 2, 4])):
            copy = list(base)
            if rng.random() < 0.5:
                copy[rng.randrange(len(copy))] = rng.choice(words)
            # some rows have no id, some share one id though their texts differ
            doc_id = rng.choice([None, rng.randrange(8), 100 + len(rows), 100 + len(rows)])
            rows.append((doc_id, " ".join(copy), f"m{len(rows)}"))
    rows += [(None, None, "n1"), (7, "", "n2"), (300, "", "n3"), (None, "alone at last", "n4")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, row string").repartition(3)
    kept = one_of_each_group(docs, shingle_words=5)
    assert kept.columns == docs.columns
    assert sorted(r["row"] for r in kept.collect()) == plain_kept(rows)
    assert one_of_each_group(docs.limit(0), shingle_words=5).count() == 0
