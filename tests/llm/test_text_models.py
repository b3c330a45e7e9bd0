import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from caseloom.llm import bpe, gru_lm, quality, toxicity

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    path = bpe.default_vocabulary()
    with open(path, encoding="utf-8") as f:
        return bpe.ByteBpe(f.read()), Tokenizer.from_file(path)


def test_bpe_equals_library(tokenizer):
    mine, lib = tokenizer
    rng = random.Random(1)
    signs = [*" \n\t\x1c\x1d\x85\xa0 aZé日本1٣²'s!?#́​\U0001f600\r\x0b\x0cⅧ", "  ", "   ", "'ve", "'ll", "<|endoftext|>", "\n\n", " the", "ing", "-----", "à b", "\xa0 b"]
    for _ in range(4000):
        t = "".join(rng.choice(signs) for _ in range(rng.randint(0, 24)))
        ids = lib.encode(t, add_special_tokens=False).ids
        coded = mine.encode(t)
        assert np.frombuffer(coded, "<u4").tolist() == ids, repr(t)
        assert mine.decode(coded) == lib.decode(ids, skip_special_tokens=False)


def test_bpe_long_and_broken(tokenizer):
    mine, lib = tokenizer
    t = "ab" * 30_000 + "=́" * 2000
    assert np.frombuffer(mine.encode(t), "<u4").tolist() == lib.encode(t, add_special_tokens=False).ids
    ids = [mine.byte_id[0xE2], mine.byte_id[0x28]]
    assert mine.decode(np.array(ids, "<u4").tobytes()) == lib.decode(ids, skip_special_tokens=False)


def test_bpe_documents(spark, tokenizer):
    docs = spark.createDataFrame([(1, "Ab c"), (2, None), (None, ""), (3, "x"), (3, "x")], "doc_id long, text string")
    got = bpe.encode_documents(docs, bpe.default_vocabulary(), keep_ids=True).collect()
    assert sorted((r.doc_id or -1, r.n_tokens, r.decoded) for r in got) == [(-1, 0, ""), (1, 2, "Ab c"), (2, 0, ""), (3, 1, "x"), (3, 1, "x")]
    assert bpe.encode_documents(docs.limit(0), bpe.default_vocabulary()).count() == 0


def held(k, mod, rest):
    return zlib.crc32(b"" if k is None else str(k).encode()) % mod == rest


def labelled(spark, name, column, query):
    got = query(spark, SF).toPandas().merge(spark.read.parquet(f"{SF}/labels.parquet").toPandas(), on="doc_id")
    assert (got.score.between(0, 1)).all()
    return got, (got.predicted == got[column])


def test_quality_on_held_out(spark):
    got, right = labelled(spark, "quality", "quality", quality.op1_quality)
    assert (got.held_out == [held(k, 5, 0) for k in got.doc_id]).all()
    assert right[got.held_out].mean() >= 0.97 and ((got.score >= 0.3) == got.predicted).all()


def test_toxicity_on_held_out(spark):
    got, right = labelled(spark, "toxic", "toxic", toxicity.op3_toxicity)
    assert (got.held_out == [held(k, 3, 1) for k in got.doc_id]).all()
    assert right[got.held_out].mean() >= 0.93
    assert got[(got.toxic == 0) & got.held_out].predicted.mean() <= 0.02


def bags(texts):
    from caseloom.llm import textkit

    out = []
    for t in texts:
        ((_, _, data, off),) = textkit.chunks(pa.array([t]))
        out.append(np.unique(toxicity.features(data, off)[0]))
    return out


def test_counterfactuals_free_group_mentions(monkeypatch):
    rng = random.Random(2)
    filler = [f"word{k}" for k in range(60)]
    texts, labels = [], []
    for k in range(600):
        toxic = k % 3 == 0
        words = rng.sample(filler, 8) + (["slur"] if toxic and rng.random() < 0.8 else [])
        if rng.random() < (0.7 if toxic else 0.05):  # mentions go with the label, unfairly
            words.append("women")
        texts.append(" ".join(words))
        labels.append(int(toxic))
    probe = pa.array(["word1 word2 women", "word1 word2 men", "word1 word2", "word1 slur"])
    monkeypatch.setattr(toxicity, "LAMBDA", 0.0)
    plain = toxicity.score_texts(probe, toxicity.fit(np.array(labels), bags(texts)))
    monkeypatch.setattr(toxicity, "LAMBDA", 50.0)
    fair = toxicity.score_texts(probe, toxicity.fit(np.array(labels), bags(texts)))
    assert plain[0] - plain[2] > 0.2 and abs(fair[0] - fair[1]) < 0.05 and abs(fair[0] - fair[2]) < 0.1 and fair[3] > 0.7


def test_classifier_edges(spark):
    docs = spark.createDataFrame([(1, "you"), (2, None), (None, "women"), (3, "")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int, quality int")
    assert {round(r.toxic_score, 3) for r in toxicity.scores(docs, toxicity.train(docs, none)).collect()} == {0.0}
    assert {r.quality_score for r in quality.scores(docs, quality.train(docs, none)).collect()} == {0.0}
    one = spark.createDataFrame([(1, 1, 1), (2, 1, 0), (None, 1, 1), (3, None, None)], "doc_id long, toxic int, quality int")
    assert toxicity.scores(docs.limit(0), toxicity.train(docs, one)).count() == 0
    assert all(0 <= r.quality_score <= 1 for r in quality.scores(docs, quality.train(docs, one)).collect())


@pytest.mark.parametrize("cached", [400_000, 50])
def test_language_model(spark, monkeypatch, cached):
    monkeypatch.setattr(gru_lm, "CACHED", cached)
    sf = "/root/testdata/sf0.001"
    got = gru_lm.op4_lm_scoring(spark, sf).toPandas()
    texts = {r.doc_id: re.findall(rb"[^\x20\x09-\x0D]+", r.text.encode().lower()) + [None] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    c = Counter(w for k, x in texts.items() if not held(k, 7, 2) for w in x)
    n, v = sum(c.values()), len(c)
    for r in got.itertuples():
        x = texts[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held(r.doc_id, 7, 2), len(x), sum(c[w] > 0 for w in x), n)
        assert r.base_score == pytest.approx(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in x))
    out = got[got.held_out]
    assert out.score.sum() > out.base_score.sum()


def small_vocabulary():
    rng = np.random.default_rng(0)
    head = rng.integers(0, 1 << 63, 40).astype(np.uint64)
    tail_n, tail_v = np.full(gru_lm.TAILS, 6.0), np.full(gru_lm.TAILS, 3.0)
    return gru_lm.Vocabulary(head, np.arange(40, 0, -1), 10, 1000, 140, tail_n, tail_v, (np.zeros(0, np.uint64), np.zeros(0, np.int64)))


def test_probabilities_add_up_and_windows_carry_state(monkeypatch):
    v = small_vocabulary()
    p = v.start()
    rng = np.random.default_rng(1)
    p = {k: x + rng.normal(0, 0.3, x.shape).astype(np.float32) for k, x in p.items()}
    h = rng.normal(0, 1, (1, gru_lm.UNITS)).astype(np.float32)
    every = np.arange(v.size + gru_lm.TAILS)
    lp, _ = gru_lm._outputs(p, v, np.repeat(h, len(every), 0), every)
    assert np.exp(lp).sum() == pytest.approx(1, abs=1e-4)
    flat = rng.integers(1, v.size + gru_lm.TAILS, 700)
    ends = np.array([100, 101, 650, 700])
    flat[ends - 1] = 0
    whole = gru_lm.log_likelihoods(p, v, flat, ends)
    monkeypatch.setattr(gru_lm, "WINDOW", 7)
    monkeypatch.setattr(gru_lm, "SLOTS", 2)
    assert gru_lm.log_likelihoods(p, v, flat, ends) == pytest.approx(whole, rel=1e-4)


def test_gradient_of_outputs():
    v = small_vocabulary()
    rng = np.random.default_rng(2)
    p = {k: (x + rng.normal(0, 0.3, x.shape)).astype(np.float64) for k, x in v.start().items()}
    h, ids = rng.normal(0, 1, (5, gru_lm.UNITS)), np.array([0, 3, 17, v.size + 4, 25])
    g: dict = {}
    out, dh = gru_lm._outputs(p, v, h, ids, g)
    e = 1e-6
    up = h.copy()
    up[2, 3] += e
    assert dh[2, 3] == pytest.approx(-(gru_lm._outputs(p, v, up, ids)[0].sum() - out.sum()) / e, rel=1e-3)
    q = {k: x.copy() for k, x in p.items()}
    q["ww"][1, 5] += e
    assert g["ww"][1, 5] == pytest.approx(-(gru_lm._outputs(q, v, h, ids)[0].sum() - out.sum()) / e, rel=1e-2, abs=1e-6)


def test_language_model_edges(spark):
    docs = spark.createDataFrame([(1, "Ab c"), (2, None), (None, "x y"), (3, ""), (3, "")], "doc_id long, text string")
    got = gru_lm.score(spark, docs).collect()
    assert len(got) == 5 and all(r.score <= 0 and r.n_tokens >= 1 for r in got)
    assert gru_lm.score(spark, docs.limit(0)).count() == 0
