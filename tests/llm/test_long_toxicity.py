"""Toxicity of long texts joined from clean ones: length alone rejects no document."""

import random

import pytest

from tidewater.llm import toxicity
from tidewater.llm.common import held_out

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")


def test_length_rejects_no_clean_text(spark, tables):
    docs, labels = tables
    trained = toxicity.train_toxicity(docs, labels)
    alone = toxicity.score_toxicity(docs, trained, ["doc_id", "text"])
    clean = alone.join(labels, "doc_id").where(held_out() & (alone.score < 0.1) & (labels.toxic == 0)).select("text")
    sentences = [x for r in clean.collect() for x in r.text.replace("\n", ". ").split(". ") if x.strip()]
    rng = random.Random(1)
    unseen = lambda: "".join(rng.choices("bcdfghjklmnpqrstvwxz", k=9))
    rows = [(n, ". ".join(rng.choices(sentences, k=n))) for n in (500, 2_000, 10_000, 50_000)]
    rows += [(-n, ". ".join(f"{unseen()} {unseen()}" for _ in range(n))) for n in (500, 3_000, 50_000)]
    long = spark.createDataFrame(rows, "doc_id bigint, text string")
    made = {r.doc_id: r.score for r in toxicity.score_toxicity(long, trained, ["doc_id"]).collect()}
    assert all(score < toxicity.THRESHOLD for score in made.values()), made


def test_one_toxic_sentence_is_found_at_any_length(spark):
    rng = random.Random(5)
    plain = lambda: " ".join(rng.choices("the of and to in on for with river house green walks".split(), k=9))
    text = lambda i: ". ".join([plain() for _ in range(5)] + ["you vile toad"] * (i % 3 == 0)) + "."
    docs = spark.createDataFrame([(i, text(i)) for i in range(400)], "doc_id bigint, text string")
    marks = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(400)], "doc_id bigint, toxic int")
    long = spark.createDataFrame([(0, ". ".join([plain() for _ in range(20_000)] + ["you vile toad"]))], "doc_id bigint, text string")
    assert toxicity.score_toxicity(long, toxicity.train_toxicity(docs, marks), ["doc_id"]).first().score >= toxicity.THRESHOLD
