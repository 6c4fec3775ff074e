"""Operators on texts: edge rows, clashing columns, empty tables, and plain versions."""

import hashlib
import random
import re
import string
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidewater.llm import lines, merges, mixing, planes, quality, secret_scan, simhash, toxicity
from tidewater.llm.common import text_blocks
from tidewater.llm.pretokens import WordTable

from . import helpers

SF = "/root/testdata/sf0.001"
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
JSON = public_tokenizers.path("byte_bpe_50k.json")
LONG = "one word and another, " * 20_000

SCHEMA = ("doc_id bigint, text string, source string, score double, size bigint, fingerprint string, component string, "
          "place bigint, h1 bigint, sim bigint, id bigint, n int, target double, copies int, key string, chunk int")
EDGES = [(1, None), (2, ""), (3, "  \n\t "), (4, LONG), (5, "x"), (5, "x"), (5, "y"), (None, "a null id\nsome words here"),
         (6, "Ünïcödé 中文 🙂 it's 12 o'clock"), (7, "-----\n\n-----"), (8, "some words here\nSOME, words here!"),
         (None, None), (9, LONG + "more"), (10, "<|endoftext|> is ordinary")]


@pytest.fixture(scope="module")
def edges(spark):
    rows = [(i, t, None if k % 4 == 0 else f"s{k % 2}", 0.5, 1, "f", "c", 1, 2, 3, 4, 5, 6.0, 7, "k", 8)
            for k, (i, t) in enumerate(EDGES)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(i, i % 2, (i + 1) % 2) for i in range(10)] + [(None, 1, 1), (3, None, None), (4, 0, 0)],
                                 "doc_id bigint, quality int, toxic int")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def rows(docs):
    return [(r.doc_id, r.text, r.source) for r in docs.orderBy("doc_id").collect()]


@pytest.mark.parametrize("run", [quality.quality, toxicity.toxicity])
def test_classifiers_score_every_row(run, edges, empty, labels):
    out = run(edges, labels).collect()
    assert sorted(str(r.doc_id) for r in out) == sorted(str(i) for i, _ in EDGES)
    for r in out:
        assert 0 <= r.score <= 1 and r.predicted in (0, 1)
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
    assert run(empty, labels).count() == 0
    none = {r.score for r in run(edges, labels.limit(0)).where("doc_id = 2").collect()}
    assert none <= ({0.5} if run is quality.quality else {0.0})


def test_classifiers_learn(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    good = quality.quality(docs, labels).join(labels, "doc_id").where("held_out").collect()
    assert np.mean([r.predicted == r.quality for r in good]) > 0.93
    toxic = toxicity.toxicity(docs, labels).join(labels, "doc_id").where("held_out").collect()
    assert np.mean([r.predicted for r in toxic if r.toxic == 0]) < 0.05


def test_toxic_sentences_are_located(spark):
    rng = random.Random(5)
    plain = lambda: " ".join(rng.choice("the of and to in on for with river house green walks".split()) for _ in range(9))
    rows, marks = [], []
    for i in range(400):
        text = [plain() for _ in range(5)]
        if i % 3 == 0:
            text[i % 5] += " you vile toad"
        rows.append((i, ". ".join(text) + ".", i % 3 == 0))
        marks.append((i, int(i % 3 == 0)))
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id bigint, text string")
    out = toxicity.toxicity(docs, spark.createDataFrame(marks, "doc_id bigint, toxic int")).collect()
    texts = dict(r[:2] for r in rows)
    assert all(r.predicted == (r.doc_id % 3 == 0) for r in out)
    for r in out:
        for span in filter(None, r.spans.split(",")):
            a, b = map(int, span.split(":"))
            assert "vile" in texts[r.doc_id][a:b] and "." not in texts[r.doc_id][a:b - 1]


def test_drop_toxic_keeps_columns(edges, labels):
    left = toxicity.drop_toxic(edges, labels)
    assert left.schema.names == edges.schema.names and left.where("doc_id = 2").count() == 1


def _ids(text):
    return _ids.encoding.encode_ordinary(text or "")


_ids.encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, special_tokens={},
                                  mergeable_ranks=merges.Vocabulary(open(RANKS, "rb").read()).rank)


def test_bpe_digests_and_round_trip(edges, empty):
    out = merges.digests(edges, RANKS, ["doc_id"]).collect()
    wanted = sorted((str(i), len(_ids(t)), hashlib.sha256(np.array(_ids(t), "<u4").tobytes()).hexdigest(),
                     hashlib.sha256((t or "").encode()).hexdigest()) for i, t in EDGES)
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in out) == wanted
    back = merges.decode_ids(merges.encode_texts(edges, RANKS, ["doc_id"]), RANKS).collect()
    assert sorted((str(r.doc_id), r.text) for r in back) == sorted((str(i), t or "") for i, t in EDGES)
    assert merges.digests(empty, RANKS, ["doc_id"]).count() == 0


_TABLE = WordTable(merges.Vocabulary(open(RANKS, "rb").read()).encode)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.text(), st.text(alphabet="a 'stre\n\té中9.!-")), min_size=1, max_size=5))
def test_bpe_equals_the_public_library(texts):
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    for block in text_blocks(pa.array(texts, pa.large_string())):
        ids, bounds = _TABLE.ids(block)
        assert [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:], strict=True)] == [_ids(t) for t in texts]


def test_bpe_long_runs():
    texts = ["a" * 3000, " " * 3001, "ab" * 1500, "=-" * 700, "\n" * 500 + "x", "0" * 999]
    for block in text_blocks(pa.array(texts, pa.large_string())):
        ids, bounds = _TABLE.ids(block)
        assert [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:], strict=True)] == [_ids(t) for t in texts]


@pytest.mark.parametrize("kind", ["byte", "bit"])
@pytest.mark.parametrize("n", [0, 1, 7, 8, 1000])
def test_planes_round_trip(kind, n):
    ids = np.random.default_rng(n).integers(0, 2**32, n, dtype=np.uint64).astype(np.uint32)
    made = planes.to_planes(ids, kind)
    assert len(made) == (4 if kind == "byte" else 32)
    assert np.array_equal(planes.from_planes(made, n), ids)


def _library_ids(text):
    return _library_ids.tokenizer.encode(text or "", add_special_tokens=False).ids


_library_ids.tokenizer = Tokenizer.from_file(JSON)
_library_ids.tokenizer.encode_special_tokens = True


def test_token_files(spark, edges, empty, tmp_dir):
    planes.write_tokens(edges, JSON, f"{tmp_dir}/t", chunk_ids=1000)  # documents span chunks
    out = planes.read_tokens(spark, f"{tmp_dir}/t").orderBy("start").collect()
    ordered = sorted(EDGES, key=lambda r: (r[0] is None, r[0] or 0, r[1] is not None, r[1] or ""))
    start, stream = 0, []
    for (i, text), r in zip(ordered, out, strict=True):
        ids = _library_ids(text) + [planes.END_ID]
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start, stream = start + len(ids), stream + ids
    assert planes.read_ids(spark, f"{tmp_dir}/t", 500, 2000).tolist() == stream[500:2500]
    index = spark.read.parquet(f"{tmp_dir}/t/index")
    assert index.agg(F.sum("n_ids")).first()[0] == len(stream)
    assert planes.token_files(empty, JSON).count() == 0


def test_simhash_components(docs, rows, edges, empty):
    prints, groups = helpers.near_components([t for _, t, _ in rows])
    out = {r.doc_id: r for r in simhash.near_duplicates(docs, 4, 4).collect()}
    for k, (i, _, _) in enumerate(rows):
        assert (out[i].fingerprint, out[i].component_id) == (f"{int(prints[k]):016x}", rows[groups[k]][0])
    made = simhash.near_duplicates(edges, 4, 4).collect()
    assert len(made) == len(EDGES)
    assert {r.component_id for r in made if r.doc_id in (1, 2, 3)} == {1}
    for r in made:
        assert r.fingerprint in {f"{helpers.simhash(t):016x}" for i, t in EDGES if i == r.doc_id}
    assert simhash.near_duplicates(empty, 4, 4).count() == 0


def test_simhash_tiles_find_every_pair(spark):
    rng = np.random.default_rng(3)
    seeds = rng.integers(0, 2**63, 300, dtype=np.int64)
    near = [int(s) ^ sum(1 << int(b) for b in rng.choice(63, rng.integers(1, 6), replace=False)) for s in seeds[:200]]
    every = np.unique(np.array([*seeds.tolist(), *near], np.int64))
    prints = spark.createDataFrame([(int(x),) for x in every], "fingerprint bigint")
    found = {r.fingerprint: r.component for r in simhash.fingerprint_components(prints, 4, tile=64).collect()}
    groups = helpers.Groups(len(every))
    for i in range(len(every)):
        for j in np.flatnonzero(np.bitwise_count(every[i + 1:] ^ every[i]) <= 4) + i + 1:
            groups.join(i, int(j))
    name = lambda i: found.get(int(every[i]), int(every[i]))
    for i in range(len(every)):
        assert name(i) == name(groups.find(i))
    assert len({name(i) for i in range(len(every))}) == len({groups.find(i) for i in range(len(every))})


def test_keep_one(edges, docs, rows):
    left = simhash.keep_one(edges, 4, 4)
    assert left.columns == edges.columns
    found = [(r.doc_id, r.text) for r in left.collect()]
    assert found.count((5, "x")) == 1 and (1, None) in found and (2, "") not in found
    _, groups = helpers.near_components([t for _, t, _ in rows])
    assert sorted(r.doc_id for r in simhash.keep_one(docs, 4, 4).collect()) == sorted({rows[g][0] for g in groups})


def test_line_dedup(spark, docs, rows):
    wanted = helpers.dedup_lines([r[:2] for r in rows])
    out = {r.doc_id: r.text for r in lines.dedup_lines(docs).collect()}
    assert [out[i] for i, _, _ in rows] == wanted


def test_line_dedup_variants_of_one_line(spark):
    rng = random.Random(2)
    base = ["".join(rng.choices(string.ascii_lowercase, k=6)) for _ in range(120)]
    made = []
    for i in range(80):
        words = list(base)
        for _ in range(i % 4):
            words[rng.randrange(len(words))] = "".join(rng.choices(string.ascii_lowercase, k=6))
        made.append((i, " ".join(words) + f"\nown line of document {'q' * (i % 7)} {rng.random()}"))
    docs = spark.createDataFrame(made, "doc_id bigint, text string")
    wanted = helpers.dedup_lines(made)
    assert [r.text for r in lines.dedup_lines(docs).orderBy("doc_id").collect()] == wanted


def test_line_dedup_edges(edges, empty):
    out = lines.dedup_lines(edges)
    assert out.columns == edges.columns
    found = sorted(((str(r.doc_id), r.text) for r in out.collect()), key=str)
    assert ("1", None) in found and ("2", "") in found and ("7", "-----\n\n-----") in found
    assert ("8", "some words here") in found and ("None", "a null id") in found
    assert [t for i, t in found if i == "5"] == ["", "x", "y"]  # of equal rows one keeps its lines
    assert lines.dedup_lines(empty).count() == 0


def test_line_dedup_plan_is_native(spark, docs):
    plan = lines.occurrences(docs.withColumn("__row", F.lit(1)))._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_mixing(docs, rows, edges, empty):
    out = {r.doc_id: r for r in mixing.mix(docs).collect()}
    sizes, taken = {}, {}
    for i, text, source in rows:
        n = len(helpers.WORD.findall(text or ""))
        assert out[i].size == n and out[i].taken in (0, n, 2 * n)
        sizes[source] = sizes.get(source, 0) + n
        taken[source] = taken.get(source, 0) + out[i].taken
    targets = helpers.source_targets(sizes)
    for i, _, source in rows:
        assert out[i].source_size == sizes[source] and out[i].target == pytest.approx(targets[source])
    assert all(abs(taken[s] - targets[s]) <= max(0.05 * targets[s], 60) for s in sizes)
    again = {r.doc_id: r.taken for r in mixing.mix(docs.repartition(5)).collect()}
    assert again == {i: r.taken for i, r in out.items()}
    made = mixing.mix(edges).collect()
    assert len(made) == len(EDGES) and all(r.taken <= 2 * r.size for r in made)
    assert mixing.mix(empty).count() == 0


def test_mixing_hot_and_equal_rows(spark):
    rows = [(1, "same words here", "hot")] * 3000 + [(i, "w " * (i % 90), "hot" if i % 3 else None) for i in range(2, 3000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string").withColumn("size", F.lit("clash"))
    out = mixing.mix(docs)
    assert out.count() == len(rows)
    for r in out.groupBy("target").agg(F.sum("taken").alias("taken")).collect():
        assert abs(r.taken - r.target) <= 90
    same = {r["copies"] for r in out.where("doc_id = 1").select("copies").distinct().collect()}
    assert max(same) - min(same) <= 1
    mixed = mixing.take_mix(docs)
    assert mixed.columns == docs.columns
    assert mixed.count() == out.agg(F.sum("copies")).first()[0]
    assert mixed.where("doc_id = 1").count() == out.where("doc_id = 1").agg(F.sum("copies")).first()[0]


def test_flight_keeps_its_totals():
    rng = random.Random(1)
    sizes = [float(rng.randrange(1, 500)) for _ in range(400)]
    chance = mixing.fly(sizes, [0.37] * 400, rng)
    open_ = [p for p in chance if 0 < p < 1]
    assert len(open_) <= 2
    assert sum(chance) == pytest.approx(0.37 * 400) and sum(map(lambda p, s: p * s, chance, sizes)) == pytest.approx(0.37 * sum(sizes))


ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def _base(text):
    text = text or ""
    spans = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(spans)


def test_secrets(spark, rows, edges, empty):
    rng = random.Random(4)
    extra = ["é PASSWORD = 'abc' token:'12345678' Api_Key=x", "token=api_key: abcdefghij", "x" + "0123456789abcdef" * 3 + "-AKIA" + "Z9" * 8]
    planted = {1000 + i: "".join(rng.choices(string.ascii_letters + string.digits, k=rng.choice([32, 40, 64]))) for i in range(12)}
    made = [(i, t) for i, t, _ in rows] + [(900 + i, t) for i, t in enumerate(extra)]
    made += [(i, f"é plain words, key {k} and more words") for i, k in planted.items()] + [(2000, None), (None, "")]
    out = secret_scan.find_secrets(spark.createDataFrame(made, "doc_id bigint, text string")).collect()
    texts = dict(made)
    assert len(out) == len(made)
    for r in out:
        spans = _base(texts[r.doc_id])
        said = ",".join(f"{secret_scan.KINDS[k]}:{a}:{b}" for a, k, b in spans)
        assert r.base_sha256 == hashlib.sha256(said.encode()).hexdigest()
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(k == i for _, k, _ in spans) for i in range(3)]
        found = [x.split(":") for x in r.spans.split(",") if x.startswith("random")]
        if r.doc_id in planted:
            assert planted[r.doc_id] in [texts[r.doc_id][int(a):int(b)] for _, a, b in found]
        assert set(filter(None, said.split(","))) <= set(r.spans.split(","))
    prose = [r for r in out if r.doc_id is not None and r.doc_id < 900 and "random" in r.spans]
    assert len(prose) <= 4
    assert secret_scan.find_secrets(edges).count() == len(EDGES) and secret_scan.find_secrets(empty).count() == 0


def test_randomness_battery():
    rng = random.Random(1)
    uniform = [secret_scan.randomness([rng.randrange(64) for _ in range(64)], 64) for _ in range(300)]
    assert np.mean(np.array(uniform) < 0.05) < 0.12
    assert secret_scan.randomness([1, 2] * 20, 16) < 1e-6 and secret_scan.randomness([5] * 20, 16) < 1e-6
