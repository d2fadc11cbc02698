import random
import zlib

import pytest
from pyspark.sql import functions as F

from clearledger.llm import langid, queries


@pytest.fixture(scope="module")
def model(spark, sf_dir):
    return langid.train(spark.read.parquet(f"{sf_dir}/documents.parquet"), F.lit(True))


def test_held_out_accuracy(spark, sf_dir):
    rows = queries.op8_family_then_language(spark, sf_dir).join(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == r.lang for r in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)


def test_labels_of_held_out_rows_are_not_read(spark, sf_dir, model):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    learn = F.col("doc_id") % 2 == 0
    changed = docs.withColumn("lang", F.when(learn, F.col("lang")).otherwise("zz"))
    one, two = (langid.identify(d, langid.train(d, learn)).orderBy("doc_id").collect() for d in (docs, changed))
    assert one == two


def test_many_languages_and_families(spark):
    rng, rows = random.Random(17), []
    sounds = {"en": "ab", "de": "abü", "nl": "cd", "fr": "éf", "es": "fñ", "xx": "яю"}
    for i in range(600):
        lang = rng.choice(list(sounds))
        rows.append((i, " ".join("".join(rng.choices(sounds[lang], k=5)) for _ in range(20)), lang))
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = langid.identify(df, langid.train(df, F.col("doc_id") % 2 == 0)).join(df, "doc_id").collect()
    assert sum(r.lang == r.lang_pred for r in got) >= 0.98 * len(got)


def test_odd_rows(spark, odd, nothing, model):
    got = langid.identify(odd, model).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(r.doc_id) for r in odd.collect())
    texts = {r.doc_id: r.text for r in odd.collect() if r.doc_id is not None}
    for r in got:
        if r.doc_id is not None:
            letters = any(c.isalpha() for c in texts[r.doc_id] or "")
            assert (r.lang_pred == "und") == (not letters)
    assert langid.identify(nothing, model).count() == 0
    assert langid.train(nothing, F.lit(True)) is None
    assert {r.lang_pred for r in langid.identify(odd, None).collect()} == {"und"}
    named = langid.label(odd, model)
    assert named.columns == [*odd.columns, "lang_pred", "lang_score"] and named.count() == odd.count()
