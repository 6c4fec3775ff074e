"""The pipeline against its stages done one by one, and the registered queries."""

import collections

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tidewater.llm import toxicity
from tidewater.llm.queries import QUERIES

from . import helpers
from .test_text import _ids

SF = "/root/testdata/sf0.001"


def test_every_operator_is_registered():
    names = entry.queries()
    assert set(QUERIES) <= set(names) and "pipeline" in names
    assert [any(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)] == [True] * 13


def test_stages_return_the_columns_of_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    # further columns, named as the operators name their own
    clash = ("place", "extra", "m", "base", "dropped", "n", "row", "pos", "h1", "h2", "id", "key", "size", "target", "of", "part", "nth",
             "copies", "unit", "component", "stays", "lines", "mins", "score", "predicted", "held_out", "fingerprint", "best", "up")
    wide = docs.select("*", *[F.lit("x").alias(c) for c in clash])
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.schema.names == docs.schema.names, name
        assert stage(spark, docs.limit(0), SF).count() == 0
        made = stage(spark, wide, SF)
        assert made.schema.names == wide.schema.names, name
        assert collections.Counter(map(tuple, made.select(*docs.columns).collect())) == collections.Counter(map(tuple, out.collect())), name


def test_pipeline_equals_plain_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    scores = toxicity.toxicity(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    clean = {r.doc_id for r in scores.where("predicted = 0").collect()}
    rows = [r for r in docs.orderBy("doc_id").collect() if r.doc_id in clean]
    texts = helpers.dedup_lines([(r.doc_id, r.text) for r in rows])
    _, groups = helpers.near_components(texts)
    left = {rows[g].doc_id: (rows[g].source, texts[g]) for g in set(groups)}
    sizes = collections.Counter()
    for source, text in left.values():
        sizes[source] += len(helpers.WORD.findall(text))
    targets = helpers.source_targets(sizes)
    out = corpus_pipeline.run(spark, SF).collect()
    taken = collections.Counter()
    for r in out:
        source, text = left[r.doc_id]
        assert (r.source, r.n_tokens) == (source, len(_ids(text)))
        taken[source] += len(helpers.WORD.findall(text))
    assert max(collections.Counter(r.doc_id for r in out).values()) <= 2
    assert all(abs(taken[s] - targets[s]) <= max(0.05 * targets[s], 60) for s in sizes)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_covers_its_table(spark, name):
    out = entry.queries()[name](spark, SF)
    assert len(set(out.columns)) == len(out.columns)
    if name == "op4_hilbert":
        assert out.select("query_id").distinct().count() == 25
    elif name == "op9_pstable":
        assert out.count() == 500
    elif name == "op11_filter_audit":
        assert out.count() == 600 * spark.read.parquet(f"{SF}/documents.parquet").selectExpr("coalesce(source, '')").distinct().count()
    elif name == "op13_prefix_trie":
        convs = spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id").distinct().count()
        assert [r.n_convs for r in out.where("depth = 0").collect()] == [convs]
    else:
        assert out.count() == spark.read.parquet(f"{SF}/documents.parquet").agg(F.count("*")).first()[0]
