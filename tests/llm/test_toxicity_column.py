"""Scores and offending sentences held against a plain noisy-or, as a Spark column on odd rows."""

import math

from pyspark.sql import functions as F

from adfacts.llm import toxicity

WEIGHTS = {"awful": 7.5, "nasty": 4.0, "kind": -2.0, "vile": 6.0}
BIAS = -5.0
TEXTS = [
    "You awful one. A kind word. Nasty, awful, NASTY thing! Nasty it is.",
    "All is well here. A kind word.",
    "vile\nvile and kind. vile",
    "awful " * 30_000,
    "Fine words. " * 20_000 + "vile awful ones.",
    "", " \n ", "...", "42", None,
]


def plain(text):
    """Document score and the numbers of the sentences at or above a half."""
    sentences, clean = toxicity.sentence_words(text), 1.0
    offending = []
    for number, (_, words) in enumerate(sentences):
        p = 1 / (1 + math.exp(-(BIAS + sum(WEIGHTS.get(w, 0.0) for w in words))))
        clean *= 1 - p
        if p >= 0.5:
            offending.append(number)
    return 1 - clean, offending


def scored(docs):
    model = toxicity.ToxicityModel(WEIGHTS, BIAS)
    return docs.select("doc_id", "found", toxicity.toxicity_columns(F.col("text"), model).alias("t"))


def test_scores_and_offending_sentences(spark):
    rows = [(i, t, "x") for i, t in enumerate(TEXTS)] + [(None, TEXTS[0], None), (0, TEXTS[0], "x")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, found string")
    got = scored(docs).collect()
    assert len(got) == len(rows)
    for row in got:
        text = TEXTS[row["doc_id"] or 0]
        score, offending = plain(text)
        assert math.isclose(row["t"]["score"], score, rel_tol=1e-6, abs_tol=1e-9)
        assert [s["sentence"] for s in row["t"]["offending"]] == offending
        parts = [s for s, _ in toxicity.sentence_words(text)]
        assert all(s["text"] == parts[s["sentence"]] for s in row["t"]["offending"])
        assert all(s["probability"] >= toxicity.OFFENDING for s in row["t"]["offending"])
        if offending:
            assert row["t"]["worst_sentence"] in offending
    assert plain(TEXTS[0])[1] == [0, 2] and plain(TEXTS[1])[1] == []
    assert scored(docs.limit(0)).count() == 0


def test_fit_with_null_labels_repeats_and_no_rows(spark):
    texts = [(i, f"plain sentence {i}. {'awful stuff here. ' if i % 2 else ''}end") for i in range(60)]
    docs = spark.createDataFrame([*texts, (None, "awful"), (1, None)], "doc_id bigint, text string")
    marks = [(i, i % 2) for i in range(60)] + [(1, 1), (2, None), (None, 1), (999, 1)]
    labels = spark.createDataFrame(marks, "doc_id bigint, toxic int")
    model = toxicity.fit(docs, labels)
    assert model.score("Such awful stuff.")[0] > 0.5 > model.score("plain sentence.")[0]
    assert model.score("plain one. such awful stuff here.")[3][0]["sentence"] == 1
    empty = toxicity.fit(docs.limit(0), labels.limit(0))
    assert empty.score("awful")[0] < 0.5 and empty.score("awful")[3] == []
