"""Sketches sort out pairs before full sets are made, and never a similar pair."""

import random

import numpy as np
from pyspark.sql import functions as F

from adfacts.llm import similar_sets
from adfacts.llm.common import Scratch
from tests.llm.test_similar_sets import SCHEMA, plain_links


def test_sketches_differ_in_no_more_bits_than_sets(spark):
    rng = np.random.default_rng(5)
    rows = []
    for a_only, b_only, shared in [(0, 0, 1), (0, 9, 3), (5, 5, 0), (20, 30, 250), (9, 700, 3000), (0, 90, 1)]:
        values = rng.integers(-(2**63), 2**63, a_only + b_only + shared, dtype=np.int64)
        a = np.sort(np.append(values[:a_only], values[a_only + b_only :]))
        b = np.sort(values[a_only:])
        x, y = ([int(v) for v in similar_sets.sketch(s)] for s in (a, b))
        rows += [(x, y, a_only + b_only), (y, x, a_only + b_only), (x, x, 0)]
    df = spark.createDataFrame(rows, "a array<bigint>, b array<bigint>, differ int")
    for row in df.withColumn("bits", similar_sets.differing_bits("a", "b")).collect():
        assert row.bits <= row.differ and (row.differ - row.bits) % 2 == 0
        assert row.bits >= row.differ * 0.4 or row.differ > 32 * min(len(row.a), len(row.b))


def test_full_sets_are_made_of_similar_documents_only(spark, monkeypatch):
    """Each of twenty texts shares half its words with the next, two are similar, and one id has two texts."""
    rng = random.Random(9)

    def words(n):
        return [f"w{rng.randrange(10**6)}" for _ in range(n)]

    halves = [words(100) for _ in range(20)]
    texts = [halves[i - 1] + halves[i] for i in range(20)]
    near = list(texts[3])
    near[10] += "x"
    rows = [(i, " ".join(t)) for i, t in enumerate([*texts, near])]
    rows += [(30, " ".join(words(150))), (30, rows[7][1] + " end"), (None, rows[5][1])]
    asked = set()
    made = similar_sets.shingle_sets

    def noted(docs, ids, *rest):
        asked.update(r["id"] for r in ids.collect())
        return made(docs, ids, *rest)

    monkeypatch.setattr(similar_sets, "shingle_sets", noted)
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], SCHEMA).repartition(3)
    with Scratch(spark) as scratch:
        got = {(r.a, r.b) for r in similar_sets.similar_links(docs, scratch).collect()}
    assert got == plain_links(rows) == {(3, 20), (7, 30)}
    assert asked == {3, 20, 7, 30}


def test_id_bitmap_takes_few_jobs(spark):
    """Not one for each partition, of which there may be thousands."""
    ids = spark.range(3000).select(F.col("id"))
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    context = spark.sparkContext
    context.setJobGroup("id-bitmap", "id-bitmap")
    try:
        table = similar_sets.id_bitmap(ids)
        jobs = context.statusTracker().getJobIdsForGroup("id-bitmap")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        context.setLocalProperty("spark.jobGroup.id", None)
    bits = {r["bit"] for r in ids.select(similar_sets._id_bit("id").alias("bit")).collect()}
    assert {64 * w + i for w in np.flatnonzero(table) for i in range(64) if int(table[w]) >> i & 1} == bits
    assert not similar_sets.id_bitmap(ids.limit(0)).any()
    assert len(jobs) < 10
