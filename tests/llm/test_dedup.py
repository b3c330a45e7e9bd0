import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from caseloom.llm import components, cover_tree, exact_dedup, near_dedup, textkit
from caseloom.llm.common import shared_dir
from tests.llm import plain
from tests.oracle import duck, rows

EDGE = [(1, "Ab"), (2, "aB"), (3, "ÀB"), (4, None), (5, ""), (None, "x"), (7, "x"), (7, "x")]


def test_exact_equals_oracle(spark, sf):
    got = exact_dedup.op10_exact_dedup(spark, sf).toPandas()
    assert rows(got) == rows(duck(exact_dedup.ORACLE, sf))


@pytest.mark.parametrize("digest", [exact_dedup.sha256, lambda c: F.length(c).cast("string")], ids=["sha256", "clashing"])
def test_exact_edges(spark, digest):
    got = exact_dedup.exact_dedup(spark, spark.createDataFrame(EDGE, "doc_id long, text string"), digest=digest).collect()
    found = sorted((r.doc_id or -1, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in got)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    want = [(-1, 7, 3, False, sha("x")), (1, 2, 2, False, sha("ab")), (2, 2, 2, True, sha("ab")), (3, 3, 1, True, sha("Àb")), (4, 5, 2, False, sha("")), (5, 5, 2, True, sha("")), (7, 7, 3, True, sha("x")), (7, 7, 3, True, sha("x"))]
    assert found == want


def test_exact_is_native_and_handles_empty(spark):
    docs = spark.createDataFrame(EDGE, "doc_id long, text string")
    out = exact_dedup.exact_dedup(spark, docs)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert exact_dedup.exact_dedup(spark, docs.limit(0)).count() == 0


def test_keep_one_with_clashing_columns(spark):
    docs = spark.createDataFrame([(1, "a", 5, "s"), (1, "A", 6, "t"), (1, "b", 7, "u")], "doc_id long, text string, n int, sha string")
    kept = exact_dedup.keep_one(spark, docs)
    assert kept.columns == docs.columns and sorted(r.text.lower() for r in kept.collect()) == ["a", "b"]


def test_exact_over_100_kb_and_many_batches(spark, tmp_path):
    long = "word " * 40_000
    docs = spark.createDataFrame([(k, long + str(k % 2)) for k in range(6)], "doc_id long, text string")
    docs.repartition(3).write.parquet(str(tmp_path / "d"))
    got = exact_dedup.exact_dedup(spark, spark.read.parquet(str(tmp_path / "d"))).collect()
    assert {(r.doc_id, r.keep_id) for r in got} == {(k, 4 + k % 2) for k in range(6)} and all(r.locator for r in got)


def brute_groups(texts):
    """By plain words and counts; pairs too near to the threshold for hashed frequencies to decide must not occur."""
    pairs = plain.weighted_pairs(texts)
    assert not [s for s in pairs.values() if abs(s - 0.8) < 2e-4]
    same = [(texts.index(t), k) for k, t in enumerate(texts) if texts.index(t) < k]
    return plain.components(len(texts), [p for p, s in pairs.items() if s >= 0.8] + same)


@pytest.mark.parametrize("small", [32, 2], ids=["pairs", "blocks"])
def test_near_equals_brute_force(spark, sf, monkeypatch, small):
    monkeypatch.setattr(near_dedup, "SMALL", small)
    rng = random.Random(3)
    base = [f"w{rng.randrange(500)}" for _ in range(120)]
    texts = []
    for _ in range(60):  # a family of copies with more and more edits, so that links chain
        words = list(texts[-1].split() if texts and rng.random() < 0.7 else base)
        for _ in range(rng.choice([1, 2, 4])):
            words[rng.randrange(120)] = f"x{rng.randrange(10**6)}"
        texts.append(" ".join(words))
    texts += [r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").limit(60).collect()]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = brute_groups(texts)
    got = {r.doc_id: r.group_id for r in near_dedup.near_duplicates(spark, docs).collect()}
    assert [got[k] for k in range(len(texts))] == want


def test_near_edges(spark):
    rows_ = [(1, "Ab c"), (2, None), (None, "ab C"), (3, ""), (3, "q w e r t y u i o p"), (9, "q w e r t y u i o p"), (10, " \n\t ")]
    docs = spark.createDataFrame(rows_, "doc_id long, text string")
    got = sorted((r.doc_id or -1, r.group_id) for r in near_dedup.near_duplicates(spark, docs).collect())
    assert got == [(-1, 1), (1, 1), (2, 2), (3, 2), (3, 3), (9, 3), (10, 10)]
    assert near_dedup.near_duplicates(spark, docs.limit(0)).count() == 0


def test_consistent_sampling_estimates_weighted_jaccard():
    rng = np.random.default_rng(0)
    hits = []
    for _ in range(40):
        h = rng.integers(0, 1 << 63, 60).astype(np.uint64)
        a, b = rng.uniform(0.5, 4, 50), rng.uniform(0.5, 4, 50)
        wa, wb = dict(zip(h[:50].tolist(), a)), dict(zip(h[10:].tolist(), b))
        low = sum(min(wa.get(k, 0), wb.get(k, 0)) for k in set(wa) | set(wb))
        true = low / (sum(wa.values()) + sum(wb.values()) - low)
        x, y = near_dedup.sample(h[:50], np.zeros(50, int), a)[1], near_dedup.sample(h[10:], np.zeros(50, int), b)[1]
        hits.append((x == y).mean() - true)
    assert abs(np.mean(hits)) < 0.03


def test_components(spark):
    edges = [(1, 2), (2, 3), (5, 4), (9, 9), *[(100, k) for k in range(101, 160)], (159, 3)]
    got = {r.id: r.component for r in components.components(spark.createDataFrame(edges, "a long, b long"), shared_dir(spark)).collect()}
    assert got[4] == got[5] == 4 and {got[k] for k in [1, 2, 3, *range(100, 160)]} == {1}


def brute_vectors(x):
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = (u @ u.T) >= 0.95
    np.fill_diagonal(near, False)
    label = np.arange(len(x))
    while True:
        new = np.array([min(label[i], label[near[i]].min()) if near[i].any() else label[i] for i in range(len(x))])
        if (new == label).all():
            return near.sum(1), label
        label = new


@pytest.mark.parametrize("block", [64, 4096])
def test_vectors_equal_brute_force(spark, block):
    rng = np.random.default_rng(5)
    centres = rng.standard_normal((6, 16))
    x = np.concatenate([rng.standard_normal((150, 16)), *[c + rng.standard_normal((60, 16)) * s for c, s in zip(centres, (0.02, 0.1, 0.15, 0.2, 0.25, 0.3))]])
    x = np.concatenate([x, x[:20], x[200:220] * 3])
    df = spark.createDataFrame([(k, v) for k, v in enumerate(x.tolist())], "vec_id long, embedding array<double>")
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in cover_tree.near_vectors(spark, df, block=block).collect()}
    links, label = brute_vectors(x)
    assert [got[k] for k in range(len(x))] == [(int(n), int(c), int(c) == k) for k, (n, c) in enumerate(zip(links, label))]


def test_vector_edges(spark):
    rows_ = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (None, [1.0, 0.01]), (3, [0.0, 0.0]), (4, None), (5, [float("nan"), 1.0]), (6, [1.0, None]), (7, [1.0, 0.0, 0.0]), (8, []), (1, [1.0, 0.0]), (11, [float("inf"), 1.0])]
    df = spark.createDataFrame(rows_, "vec_id long, embedding array<double>")
    got = sorted((r.vec_id or -1, r.n_links, r.component_id, r.kept) for r in cover_tree.near_vectors(spark, df).collect())
    assert got == [(-1, 3, 1, False), (1, 3, 1, True), (1, 3, 1, True), (2, 3, 1, False), *[(k, 0, k, True) for k in (3, 4, 5, 6, 7, 8, 11)]]
    assert cover_tree.near_vectors(spark, df.limit(0)).count() == 0


def test_cover_tree_covers():
    rng = np.random.default_rng(1)
    x = np.concatenate([c + rng.standard_normal((200, 8)) * 0.05 for c in rng.standard_normal((5, 8))])
    tree = cover_tree.Tree(x / np.linalg.norm(x, axis=1, keepdims=True))
    assert sorted(tree.order.tolist()) == list(range(1000)) and len(tree.nodes) > 5
    for a, z, c, r, _ in tree.nodes:
        assert np.sqrt(np.maximum(0, 2 - 2 * tree.x[a:z] @ tree.x[c])).max() <= r


def test_hashes_agree():
    data, off = np.frombuffer("Ab cd  ab\nÉx x".encode(), np.uint8), np.array([0, 9, 15])
    h, row = textkit.words(data, off)
    assert (h == textkit.hash_words([b"ab", b"cd", b"ab", "Éx".encode(), b"x"])).all() and row.tolist() == [0, 0, 0, 1, 1]
