"""Filter audit, digest index and prefix trie against plain versions, on edge rows and on hot groups."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidewater.llm import cuckoo, filter_audit, prefix_trie

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
CLASH = ", ".join(f"{c} string" for c in (
    "digest", "mask", "n", "good", "first", "part", "row", "best", "bucket", "size", "kept", "words", "of", "cell", "steps", "seq", "range", "key",
    "conv", "h", "donor", "head", "spread", "spread_by", "leads", "cells", "ends", "above", "t", "gone", "quality"))
EXTRA = tuple("x" for _ in CLASH.split(","))
LONG = "word and Another\t" * 20_000
EDGES = [(1, None, "a"), (2, "", "a"), (3, LONG, None), (4, LONG, "b"), (5, "Same TEXT", ""), (5, "Same TEXT", ""), (6, "same text", "b"),
         (None, "Same TEXT", "a"), (None, None, None), (7, "ÄÖ x$ y", "b"), (8, "Same TEXT", "a"), (9, "Ünder | 中文 🙂", "c"),
         (-3, "SAME text", "c"), (None, "only nameless", "c"), (None, "only nameless", "c")]


def _docs(spark, rows):
    return spark.createDataFrame([(*r, *EXTRA) for r in rows], f"doc_id bigint, text string, source string, {CLASH}")


def plain_audit(docs, labels):
    good, toxic = {i for i, q, _ in labels if i is not None and q == 1}, {i for i, _, t in labels if i is not None and t == 1}
    least = {}
    for i, t, _ in docs:
        if i is not None:
            least[t or ""] = min(i, least.get(t or "", i))
    rows = defaultdict(list)
    for i, t, s in docs:
        t = t or ""
        w = WORD.findall(t)
        fails = {"A": len(w) < 50, "B": 100 * len(set(w)) < 65 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 5 * len(t),
                 "D": bool(re.search("[#$%&*|]", t)), "E": i is not None and i > least[t]}
        rows[s or ""].append(({f for f in fails if fails[f]}, i in good, i in toxic))
    out = {}
    for part, found in rows.items():
        shapley = Counter()
        for order in map("".join, itertools.permutations("ABCDE")):
            for step, f in enumerate(order):
                c = [0] * 6
                for fails, g, x in found:
                    before, now = bool(fails & set(order[:step])), f in fails
                    c[0] += not before and not now
                    c[1] += now and not before
                    c[2] += now and before
                    c[3] += fails == {f}
                    c[4] += now and not before and g
                    c[5] += now and not before and x
                out[part, order, step + 1] = c
                shapley[f] += c[1]
        for (p, order, step), c in out.items():
            if p == part:
                c.append(shapley[order[step - 1]])
    return out


def test_audit_of_edge_rows(spark):
    labels = [(1, 1, 0), (5, 1, 1), (6, None, 1), (8, 0, 1), (8, 1, None), (None, 1, 1), (77, 1, 1)]
    of = spark.createDataFrame([(*r, "x") for r in labels], "doc_id bigint, quality int, toxic int, source string")
    got = {(r.part, r.filter_order, r.step): [*(r[c] for c in filter_audit.COUNTS), r.shapley]
           for r in filter_audit.filter_audit(_docs(spark, EDGES), of).collect()}
    assert got == plain_audit(EDGES, labels)
    assert filter_audit.filter_audit(_docs(spark, []), of).count() == 0
    assert filter_audit.filter_audit(_docs(spark, EDGES), of.limit(0)).selectExpr("sum(good_lost + toxic_lost)").first()[0] == 0


def test_audit_of_a_hot_group(spark):
    rng = random.Random(4)
    docs = [(i, "One Hot Text" if i % 3 == 0 else " ".join(rng.choices("abc$XY", k=rng.randrange(90))), f"s{i % 4}") for i in range(900)]
    labels = [(i, i % 2, i % 5 == 0) for i in range(0, 900, 7)]
    of = spark.createDataFrame([(i, q, int(t)) for i, q, t in labels], "doc_id bigint, quality int, toxic int")
    got = {(r.part, r.filter_order, r.step): [*(r[c] for c in filter_audit.COUNTS), r.shapley]
           for r in filter_audit.filter_audit(_docs(spark, docs).repartition(7), of).collect()}
    assert got == plain_audit(docs, [(i, q, int(t)) for i, q, t in labels])


def _groups(docs):
    """Per row (id, text): keep id, size; and the number of rows kept per group."""
    of = defaultdict(list)
    for i, t, *_ in docs:
        of[re.sub("[A-Z]", lambda m: m[0].lower(), t or "")].append(i)
    return {t: (max((i for i in ids if i is not None), default=None), len(ids)) for t, ids in of.items()}


def _check_duplicates(docs, got):
    groups = _groups(docs)
    sha = {hashlib.sha256(t.encode()).hexdigest(): g for t, g in groups.items()}
    assert Counter((r.doc_id, r.text_sha256) for r in got) == Counter(
        (i, hashlib.sha256(re.sub("[A-Z]", lambda m: m[0].lower(), t or "").encode()).hexdigest()) for i, t, *_ in docs)
    for r in got:
        assert (r.keep_id, r.group_size) == sha[r.text_sha256]
        assert not r.kept or r.doc_id == r.keep_id
    assert Counter(r.text_sha256 for r in got if r.kept) == Counter(list(sha))  # exactly one of each group


def test_exact_duplicates_of_edge_rows(spark):
    _check_duplicates(EDGES, cuckoo.exact_duplicates(_docs(spark, EDGES)).collect())
    _check_duplicates(EDGES, cuckoo.exact_duplicates(_docs(spark, EDGES).repartition(5)).collect())
    assert cuckoo.exact_duplicates(_docs(spark, [])).count() == 0


def test_exact_duplicates_of_a_hot_group(spark):
    docs = [(i * 7 % 3001, "hot Text" if i % 3 == 0 else f"Text {i // 2}", "s") for i in range(3001)]
    _check_duplicates(docs, cuckoo.exact_duplicates(_docs(spark, docs).repartition(9)).collect())


def test_index_over_batches(spark):
    """Insertions and deletions in batches equal a dictionary of live texts."""
    rng = random.Random(1)
    live, index = {}, None
    for turn in range(3):
        gone = rng.sample(sorted(live), len(live) // 3) if turn else []
        docs = [(turn * 1000 + i, f"T{rng.randrange(600)}") for i in range(400)]
        rows = cuckoo.digest_rows(spark.createDataFrame(docs, "doc_id bigint, text string"))
        deleted = cuckoo.digest_rows(spark.createDataFrame([(None, t) for t in gone], "doc_id bigint, text string")) if gone else None
        answers, index = cuckoo.update(rows, 8, index, deleted)
        for t in gone:
            del live[t]
        for i, t in docs:
            best, size = live.get(t.lower(), (-1, 0))
            live[t.lower()] = max(best, i), size + 1
        got = {r.digest: (r.keep_id, r["size"]) for r in answers.collect()}
        assert got == {hashlib.sha256(t.lower().encode()).digest(): live[t.lower()] for _, t in docs}


@settings(max_examples=20, deadline=None)
@given(st.integers(1, 3000), st.integers(0, 2 ** 32 - 1))
def test_cuckoo_filter(n, seed):
    """Growth from 64 places, displacement, deletion, new insertion; nothing lost, nothing else found."""
    rng = np.random.default_rng(seed)
    index, keys = cuckoo.CuckooIndex(1, places=2), rng.integers(0, 2 ** 63, (n, 4)).astype(np.uint64)
    for part in np.array_split(np.arange(n), 5):
        index.insert(keys[part], part[:, None])
    assert (index.best[index.find(keys)][:, 0] == np.arange(n)).all()
    other = keys.copy()
    other[:, 0] += np.uint64(1)  # same places and fingerprints, other digests
    assert (index.find(other) == -1).all()
    gone = rng.random(n) < 0.5
    assert index.delete(keys[gone]).all() and not index.delete(keys[gone]).any()
    found = index.find(keys)
    assert ((found == -1) == gone).all()
    assert (index.best[found[~gone]][:, 0] == np.flatnonzero(~gone)).all()
    index.insert(keys[gone], np.flatnonzero(gone)[:, None])
    again = cuckoo.CuckooIndex.load(1, *index.state())
    assert (again.best[again.find(keys)][:, 0] == np.arange(n)).all()
    assert (index.best[index.find(keys)][:, 0] == np.arange(n)).all()


def plain_trie(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            key = hashlib.md5(f"{len(role or '')}:{role or ''}{text or ''}".encode()).hexdigest()
            own[c].append((turn is not None, turn or 0, key, len((text or "").encode())))
    own = {c: [t[2:] for t in sorted(t)] for c, t in own.items()}
    members = defaultdict(list)
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        made = own.get(c - int(np.fmod(c, 5)), [])[:h] + turns[h:]
        for d in range(len(made) + 1):
            members[tuple(made[:d])].append((c, len(made) == d))
    children, leaves, saved = Counter(p[:-1] for p in members if p), Counter(), Counter()
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += (len(m) - 1) * (p[-1][1] if p else 0)
    return Counter((min(m)[0], len(p), min(members[p[:-1]])[0] if p else None, len(m), children[p], leaves[p], saved[p],
                    hashlib.sha256(",".join(str(c) for c, ends in sorted(m) if ends).encode()).hexdigest()) for p, m in members.items())


def _trie(spark, rows, range_rows, parts=3):
    df = spark.createDataFrame([(*r, *EXTRA) for r in rows], f"conv_id bigint, turn bigint, role string, text string, {CLASH}").repartition(parts)
    return Counter((r.conv_id, r.depth, r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256)
                   for r in prefix_trie.prefix_trie(df, range_rows).collect())


@pytest.mark.parametrize("range_rows", [1, 3, 17, 1 << 16])
def test_trie(spark, range_rows):
    """Few words and many conversations: prefixes that span ranges, equal conversations, a hot first turn."""
    rng = random.Random(range_rows)
    rows = []
    for c in range(-12, 160):
        n = rng.randrange(1, 6)
        rows += [(c, k, rng.choice(["user", "bot", None]), "hot" if k == 0 and c % 3 else rng.choice(["a", "bé", "", None])) for k in range(n)]
    rows += [(200, None, "user", "x"), (200, None, "user", "x"), (200, 1, "user", "y"), (None, 0, "user", "z"), (203, 5, "", ""),
             (205, 1, "user", LONG), (205, 1, "user", "short")] + [(210, k, "user", str(k)) for k in range(300)]
    rng.shuffle(rows)
    assert _trie(spark, rows, range_rows) == plain_trie(rows)


def test_trie_of_few_rows(spark):
    assert _trie(spark, [], 4) == Counter()
    assert _trie(spark, [(None, 1, "a", "b")], 4) == Counter()
    for rows in ([(5, 1, "a", "b")], [(c, 0, "a", "b") for c in range(30)], [(4, 0, "a", "b")]):
        assert _trie(spark, rows, 1) == plain_trie(rows)


def test_ids_joined_over_ranges(spark):
    """A sequence of many conversations: its ids are joined in chunks and hashed in order."""
    df = spark.range(20_000).selectExpr("id AS conv_id", "CASE WHEN id % 3 = 0 THEN X'01' ELSE cast(cast(id % 7 AS string) AS binary) END AS seq",
                                        "array(1L) AS sizes")
    got = {bytes(r.seq): (r.n, r["first"], r.ends) for r in prefix_trie.distinct_sequences(df.repartition(6)).collect()}
    of = defaultdict(list)
    for i in range(20_000):
        of[b"\1" if i % 3 == 0 else str(i % 7).encode()].append(i)
    assert got == {s: (len(i), i[0], hashlib.sha256(",".join(map(str, i)).encode()).hexdigest()) for s, i in of.items()}


@settings(max_examples=50, deadline=None)
@given(st.lists(st.integers(0, 4), min_size=1, max_size=60), st.integers(0, 5))
def test_extents_of_a_sparse_table(values, depth):
    table, v = prefix_trie.SparseTable(np.array(values)), values
    for i in range(len(v) + 1):
        right = next((k for k in range(i, len(v)) if v[k] < depth), len(v))
        left = next((k + 1 for k in range(i - 1, -1, -1) if v[k] < depth), 0)
        assert table.right(np.array([i]), np.array([depth]))[0] == right
        assert table.left(np.array([i]), np.array([depth]))[0] == left
    a = np.arange(len(v))
    assert (table.least(a * 0, a) == np.minimum.accumulate(v)).all()


@pytest.mark.parametrize("name", ["op11_filter_audit", "op12_exact_dedup", "op13_prefix_trie"])
def test_queries_equal_their_sql(spark, name):
    from tidewater.llm.queries import ORACLES, QUERIES
    con = duckdb.connect()
    for t in ("documents", "labels", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    made = QUERIES[name](spark, SF)
    sql = con.sql(ORACLES[name])
    assert sorted(made.columns) == sorted(sql.columns)
    assert Counter(map(tuple, made.select(*sorted(made.columns)).collect())) == Counter(
        sql.select(", ".join(sorted(made.columns))).fetchall())
