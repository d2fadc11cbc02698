import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from clearledger.llm import queries, toxicity


def corpus(spark, n, seed):
    rng = random.Random(seed)
    words = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 8))) for _ in range(500)]
    rows, truth = [], {}
    for i in range(n):
        sentences = [" ".join(rng.choices(words, k=8)) for _ in range(rng.randint(1, 30))]
        truth[i] = None
        if i % 5 == 0:
            truth[i] = rng.randrange(len(sentences))
            sentences[truth[i]] += rng.choice([" Zorkish", " vrumpf", " zorkisher"])
        rows.append((i, ". ".join(sentences) + rng.choice([".", "!\n", ""]), int(i % 5 == 0)))
    return spark.createDataFrame(rows, "doc_id long, text string, toxic int"), truth


def test_learns_documents_and_finds_the_sentence(spark):
    df, truth = corpus(spark, 800, 18)
    model = toxicity.train(df.select("doc_id", "text"), df.select("doc_id", "toxic"), F.col("doc_id") % 2 == 0)
    rows = [r for r in toxicity.score(df, model).collect() if r.doc_id % 2]
    right = sum((r.score >= 0.3) == (truth[r.doc_id] is not None) for r in rows)
    assert right >= 0.98 * len(rows)
    toxic = [r for r in rows if truth[r.doc_id] is not None]
    assert sum(r.sentences[0].sentence == truth[r.doc_id] for r in toxic) >= 0.95 * len(toxic)


def test_noisy_or():
    model = toxicity.Model(-1.0, {f: 2.0 for f in toxicity.word_features("bad")})
    logits = model.sentence_logits("bad one. good\n\nfine! bad bad")
    assert len(logits) == 4
    assert model.score("bad one. good\n\nfine! bad bad") == pytest.approx(1 - np.prod(1 - 1 / (1 + np.exp(-logits))))
    assert model.score("") == model.score("... !") == 0.0


def test_folds(spark, sf_dir):
    rows = queries.op5_noisy_or_toxicity(spark, sf_dir).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)


def test_odd_rows_and_no_labels(spark, odd, nothing):
    df, _ = corpus(spark, 100, 19)
    model = toxicity.train(df, df, F.lit(True))
    got = toxicity.score(odd, model).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(r.doc_id) for r in odd.collect())
    assert toxicity.score(nothing, model).count() == 0
    for labels, low in ((df.filter("toxic = 0"), True), (df.limit(0), True), (df.withColumn("toxic", F.lit(None).cast("int")), True), (df.filter("toxic = 1"), False)):
        scores = [r.score for r in toxicity.score(df, toxicity.train(df, labels.select("doc_id", "toxic"), F.lit(True))).collect()]
        assert all((s < 0.01) == low for s in scores)
