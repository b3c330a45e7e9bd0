"""Results of the queries against plain versions, and what the operators promise beyond single calls."""

import glob
import hashlib
import math
import struct
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import tokenizers
from pyspark.sql import functions as F

import corpus_pipeline
from caseloom.llm import bpe, cover_tree, exact_dedup, gru_lm, mixing, near_dedup, quality, sharding, textkit, toxicity, warc
from caseloom.llm.common import shared_dir, sweep
from tests.llm import plain

SF = "/root/testdata/sf0.001"
weak = lambda c: F.length(c).cast("string")  # noqa: E731 clashes wherever lengths agree


def rows_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_exact_goes_on_over_calls_with_clashing_digests(spark):
    work, seen = shared_dir(spark), {}
    calls = [[(1, "aa")], [(2, "bb")], [(3, "AA"), (4, "cc"), (5, "ddd")], [(6, "bb")], [(7, "ddd"), (0, "ccc"), (None, "aa")]]
    for rows in calls:
        for r in rows:
            seen.setdefault(r[1].lower(), []).append(r[0])
        got = exact_dedup.exact_dedup(spark, rows_of(spark, rows), digest=weak, work=work, files=1).collect()
        want = {(i, t.lower()): (max(x for x in seen[t.lower()] if x is not None), len(seen[t.lower()])) for i, t in rows}
        by_sha = {hashlib.sha256(t.encode()).hexdigest(): t for t in seen}
        assert {(r.doc_id, by_sha[r.text_sha256]): (r.keep_id, r.group_size) for r in got} == want
    assert len(glob.glob(f"{work.removeprefix('file:')}/state/batch=*")) >= len(calls)


def test_exact_reads_state_over_batches_and_after_a_restart(spark, tmp_path):
    for k in range(6):
        rows_of(spark, [(k, "same"), (10 + k, f"own {k}")]).coalesce(1).write.mode("append").parquet(str(tmp_path / "d"))
    docs, work = spark.read.parquet(str(tmp_path / "d")), shared_dir(spark)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")
    spark.conf.set("spark.sql.files.openCostInBytes", "1k")
    try:
        first = exact_dedup.exact_dedup(spark, docs, work=work, call="one", files=1).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    batches = len(glob.glob(f"{work}/state/batch=*"))
    assert batches >= 3 and {(r.keep_id, r.group_size) for r in first if r.doc_id < 10} == {(5, 6)}
    assert all(str(tmp_path) in r.locator for r in first)
    # A call that is repeated counts nothing twice; a later one goes on with the state of the disk.
    again = exact_dedup.exact_dedup(spark, docs, work=work, call="one", files=1).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, first)) and len(glob.glob(f"{work}/state/batch=*")) == batches
    later = exact_dedup.exact_dedup(spark, rows_of(spark, [(3, "SAME"), (4, "new")]), work=work).collect()
    assert {(r.doc_id, r.keep_id, r.group_size, r.kept) for r in later} == {(3, 5, 7, False), (4, 4, 1, True)}


def test_exact_stages_are_native(spark, monkeypatch):
    plans = []
    settle = exact_dedup.settle
    monkeypatch.setattr(exact_dedup, "settle", lambda df, path: plans.append(df._jdf.queryExecution().executedPlan().toString()) or settle(df, path))
    out = exact_dedup.exact_dedup(spark, spark.read.parquet(f"{SF}/documents.parquet"), digest=lambda c: F.substring(exact_dedup.sha256(c), 1, 2))
    plans.append(out._jdf.queryExecution().executedPlan().toString())
    assert len(plans) > 5 and not any("Python" in p or "Arrow" in p or "Pandas" in p for p in plans)


def test_near_against_own_tokeniser_on_2000_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").where("doc_id < 2000").select("doc_id", "text")
    texts = [r["text"] for r in docs.orderBy("doc_id").collect()]
    rng = np.random.default_rng(2)
    for k in range(0, 400, 2):  # near copies: one to four words of a text changed
        w = texts[k].split(" ")
        for at in rng.integers(0, len(w), 1 + k % 4):
            w[at] = f"zz{rng.integers(10**9)}"
        texts.append(" ".join(w))
    got = {r.doc_id: r.group_id for r in near_dedup.near_duplicates(spark, spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    pairs = plain.weighted_pairs(texts, 0.7)
    near = [p for p, s in pairs.items() if s >= 0.8]
    recall = np.mean([got[a] == got[b] for a, b in near])
    assert len(near) > 150 and recall >= 0.98
    # Hashed document frequencies move similarities a little: what is clearly near is joined, what is clearly apart isn't.
    assert all(got[a] == got[b] for (a, b), s in pairs.items() if s >= 0.82)
    loose = plain.components(len(texts), [p for p, s in pairs.items() if s >= 0.77])
    assert all(loose[k] == loose[got[k]] for k in got if words_in(texts[k]))


def words_in(text):
    return bool(plain.words(text))


@pytest.mark.parametrize("weights", [(5, 2, 1), (1,)])
def test_mix_equals_plain_pareto(spark, weights):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = {r.doc_id: r.copies for r in mixing.mix(spark, docs, weights=weights).collect()}
    rows, strata = plain.random_numbers(spark, docs)
    want = dict(zip((r[0] for r in rows), plain.mix(rows, strata, weights)))
    assert got == want


def test_mix_inclusion_follows_the_odds(spark):
    """60 sources of the same 40 sizes, 12 documents of each: how often a size gets a copy is what the design expects."""
    sizes = [3 + 7 * k for k in range(40)]
    each = F.floor(F.col("id") / (60 * 12))
    docs = spark.range(60 * 12 * 40).select(F.col("id").alias("doc_id"), F.concat(F.lit("s"), (F.col("id") % 60).cast("string")).alias("source"), F.repeat(F.lit("w "), (3 + 7 * each).cast("int")).alias("text"))
    got = mixing.mix(spark, docs, weights=(1,), closing=False).toPandas()
    e = dict(zip(sizes, plain.expected_copies(sizes, 1.5 * sum(sizes))))
    mean = got.groupby("size").copies.mean()
    assert len({round(x, 6) for x in e.values()}) > 5
    assert all(abs(mean[s] - e[s]) < 4 * 0.5 / math.sqrt(720) + 0.02 for s in sizes) and abs((mean - mean.index.map(e)).mean()) < 0.02


def test_mix_nears_targets_with_long_documents(spark):
    docs = spark.createDataFrame([(k, f"s{k % 2}", "w " * (100_000 if k < 2 else 50 + k)) for k in range(400)], "doc_id long, source string, text string")
    got = mixing.mix(spark, docs, carry=["source"]).toPandas()
    for _, g in got.groupby("_c_source"):
        assert abs(g.taken.sum() - g.target.iloc[0]) <= 0.01 * g.target.iloc[0]


def test_shards_pack_large_groups_exactly(spark):
    docs = rows_of(spark, [(k, "x" * (65_536 + 1000 * (k % 9) + k)) for k in range(40)] + [(100 + k, "y" * (70_000 + k // 2)) for k in range(20)])
    got = sharding.shard_documents(spark, docs, 4).toPandas()
    groups = Counter()
    for r in docs.collect():
        groups[r.text] += len(r.text) + 1
    runs = sharding.pack_into(list(Counter(groups.values()).items()), 4)
    loads = Counter()
    for size, a, z, b in runs:
        loads[b] += size * (z - a)
    assert sorted(got.groupby("shard")["size"].sum()) == sorted(loads.values())


def test_bpe_query_equals_library(spark):
    import sys

    sys.path.insert(0, "/opt/tokenizers")
    library = tokenizers.Tokenizer.from_file("/opt/tokenizers/byte_bpe_50k.json")
    library.no_truncation()
    library.no_padding()
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}
    got = bpe.op7_bpe(spark, SF).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        sha = lambda b: hashlib.sha256(b).hexdigest()
        assert (r.n_tokens, r.ids_sha256) == (len(ids), sha(struct.pack(f"<{len(ids)}I", *ids)))
        assert r.decoded_sha256 == sha(library.decode(ids, skip_special_tokens=False).encode())


def test_quality_votes_equal_plain_neighbours(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    model = quality.train(docs, spark.read.parquet("/root/testdata/sf0.01/labels.parquet"))
    texts = [r["text"] for r in docs.limit(80).collect()] + ["", "   ", "word"]
    got = quality.score_texts(pa.array(texts), model)
    for text, score in zip(texts, got):
        ((_, _, counts),) = quality.term_counts(pa.array([text]))
        v = (np.log1p(counts[0]) * model["idf"]).astype(np.float64) @ model["basis"]
        if np.linalg.norm(v) < 1e-9:
            assert score == model["share"]
            continue
        cos = model["vectors"].astype(np.float64) @ (v / np.linalg.norm(v))
        near = sorted(range(len(cos)), key=lambda k: -cos[k])[: quality.NEAREST]
        votes = [max(cos[k], 0) ** quality.SHARPEN for k in near]
        assert score == pytest.approx(sum(x * model["labels"][k] for x, k in zip(votes, near)) / sum(votes), abs=2e-3)


def test_quality_ties_and_many_short_texts():
    cos = np.array([[0.5, 0.9, 0.5, 0.5, 0.1], [0.1, 0.2, 0.3, 0.4, 0.5]], np.float32)
    assert [sorted(x) for x in quality._nearest(cos, 2).tolist()] == [[0, 1], [3, 4]]
    assert max(len(m) for _, _, m in quality.term_counts(pa.array([""] * 1000 + ["a"] * 500))) <= quality.ROWS


def test_shipped_toxicity_frees_neutral_mentions(spark):
    """Group mentions that come only with toxic labels, at the shipped LAMBDA: neutral sentences stay below the threshold."""
    rng = np.random.default_rng(0)
    neutral = [f"n{k}" for k in range(60)]
    rows = []
    for k in range(1200):
        toxic = k % 4 == 0
        w = list(rng.choice(neutral, 20)) + (["vile", "scum"] if toxic else [])
        if toxic and k % 8 == 0:
            w.append("women")
        rng.shuffle(w)
        rows.append((k, " ".join(w), int(toxic)))
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.train(df.select("doc_id", "text"), df.select("doc_id", "toxic"))
    plain_texts = [" ".join(rng.choice(neutral, 20)) for _ in range(50)]
    base = toxicity.score_texts(pa.array(plain_texts), model)
    for term in ("women", "muslims", "gay", "black"):
        assert (toxicity.score_texts(pa.array([f"{t} {term}" for t in plain_texts]), model) < toxicity.TOXIC).all()
    logit = lambda p: np.log(p / (1 - p))
    assert np.abs(logit(toxicity.score_texts(pa.array([f"{t} women" for t in plain_texts]), model)) - logit(base)).max() < 1.5
    assert (toxicity.score_texts(pa.array([f"{t} vile scum" for t in plain_texts]), model) >= toxicity.TOXIC).mean() > 0.9


def test_warc_metadata_fields(spark):
    page = "<html><head><title> A &amp; B\n c</title></head><body><a href='x'>1</a><a href=\"y?a=1&amp;b=2\">2</a><p>t</body>"
    source = warc.response(7, "http://h/", page)
    meta, text = warc.derive(source)
    fields = [tuple(x.split(": ", 1)) for x in meta.block.decode().split("\r\n")[:-1]]
    assert ("title", "A & B c") in fields and [v for k, v in fields if k == "outlink"] == ["x", "y?a=1&b=2"]
    assert ("source-status", "HTTP/1.1 200 OK") in fields and ("source-header-content-type", "text/html; charset=utf-8") in fields
    assert ("source-payload-digest", warc.digest(page.encode())) in fields and ("source-block-digest", warc.digest(source.block)) in fields
    # A conversion's payload is its own block.
    assert text.get("WARC-Payload-Digest") == text.get("WARC-Block-Digest") == warc.digest(text.block)
    got = warc.op6_warc(spark, SF).where("page_id = 0").collect()
    assert {r.record_type for r in got} == {"metadata", "conversion"} and all(hashlib.sha256(r.record).hexdigest() == r.record_sha256 for r in got)
    long = spark.createDataFrame([(k, "u", "<p>" + "long " * 400_000) for k in range(6)], "page_id int, url string, html string")
    assert warc.derivatives(long).agg(F.max("content_length")).first()[0] == 400_000 * 5 - 1


def vocabulary():
    head = textkit.hash_words([b"w%d" % k for k in range(40)])
    return gru_lm.Vocabulary(head, np.arange(40, 0, -1), 10, 1000, 140, np.full(gru_lm.TAILS, 6.0), np.full(gru_lm.TAILS, 3.0), (np.zeros(0, np.uint64), np.zeros(0, np.int64)))


def plain_log_likelihood(p, v, ids):
    """One token at a time, in double precision."""
    p = {k: x.astype(np.float64) for k, x in p.items()}
    n, h, given, total = gru_lm.UNITS, np.zeros(gru_lm.UNITS), 0, 0.0
    sig = lambda x: 1 / (1 + np.exp(-x))
    soft = lambda x: np.exp(x - x.max()) / np.exp(x - x.max()).sum()
    for t in ids:
        a, m = p["in"][given], h @ p["u"] + p["bu"]
        z, r = sig(a[:n] + m[:n]), sig(a[n : 2 * n] + m[n : 2 * n])
        new = np.tanh(a[2 * n :] + r * m[2 * n :])
        h = (1 - z) * new + z * h
        kind = int(v.target(np.array([t]))[0])
        total += math.log(soft(h @ p["wc"] + p["bc"])[kind])
        if kind < v.classes:
            i, j = v.parts[kind]
            total += math.log(soft(h @ p["ww"][:, i:j] + p["bw"][i:j])[v.place[t]])
        given = t
    return total


def test_language_model_equals_plain_forward_pass():
    v, rng = vocabulary(), np.random.default_rng(0)
    p = {k: x + rng.normal(0, 0.2, x.shape).astype(np.float32) for k, x in v.start().items()}
    texts = [np.append(rng.integers(1, v.size + gru_lm.TAILS, n), 0) for n in (0, 1, 30, 31, 32, 33, 200)]
    got = gru_lm.log_likelihoods(p, v, np.concatenate(texts), np.cumsum([len(t) for t in texts]))
    assert got == pytest.approx([plain_log_likelihood(p, v, t) for t in texts], rel=1e-4)


def test_language_model_scores_of_a_table(spark):
    docs = spark.createDataFrame([(k, " ".join(f"w{(k * j) % 17}" for j in range(k % 40))) for k in range(120)], "doc_id long, text string")
    got = {r.doc_id: r for r in gru_lm.score(spark, docs).collect()}
    flags = docs.select("text", (gru_lm.fold(F.col("doc_id"), 7) != 2).alias("train"), "doc_id")
    v, p, _ = gru_lm.learn(spark, flags, shared_dir(spark))
    for r in docs.collect():
        ((_, _, h, tail, _),) = list(gru_lm.tokens(pa.array([r.text]))) or [(0, 1, np.zeros(0, np.uint64), np.zeros(0, np.int64), None)]
        ids = v.ids(h, tail)
        rare = ids >= v.size
        assert not rare.any() or set(h[rare]) <= set(textkit.hash_words([b"w%d" % k for k in range(17)]))
        shares = -np.log10(v.tail_n[tail[rare]] + v.tail_v[tail[rare]] + 1).sum()
        assert got[r.doc_id].score == pytest.approx(plain_log_likelihood(p, v, np.append(ids, 0)) / math.log(10) + shares, rel=1e-4, abs=1e-4)


def test_gradient_through_time(monkeypatch):
    """One Adagrad step from doubles gives the gradient back; held against differences of the loss."""
    monkeypatch.setattr(gru_lm, "STREAMS", 1)
    v, rng = vocabulary(), np.random.default_rng(3)
    p = {k: x.astype(np.float64) + rng.normal(0, 0.2, x.shape) for k, x in v.start().items()}
    ids = np.append(rng.integers(1, v.size + gru_lm.TAILS, 12), 0)
    rate = 0.5
    new = gru_lm.train(p, v, [ids], rate)
    for name, at in [("u", (3, 5)), ("u", (7, 40)), ("u", (1, 70)), ("bu", (2,)), ("bu", (80,)), ("in", (int(ids[2]), 9)), ("in", (int(ids[0]), 66)), ("wc", (4, 1)), ("bw", (3,))]:
        x = (p[name][at] - new[name][at]) / rate
        gradient = x * math.sqrt(0.1) / math.sqrt(1 - x * x)
        e, sides = 1e-5, []
        for sign in (1, -1):
            q = {k: y.copy() for k, y in p.items()}
            q[name][at] += sign * e
            sides.append(-plain_log_likelihood(q, v, ids))
        assert gradient == pytest.approx((sides[0] - sides[1]) / (2 * e), rel=2e-2, abs=2e-4)


def test_cached_counts_are_bounded():
    level = lambda c: math.floor(math.log2(c) * 4 + 1e-9)
    counts = [1] * 5000 + [5000] * 300 + [70_000] * 200 + [10**6] * 50
    levels = Counter(map(level, counts)).items()
    for most, taken in ((10, 0), (50, 50), (249, 50), (250, 250), (600, 550), (10**6, 5550)):
        bar = gru_lm.cached_level(levels, most)
        assert sum(level(c) >= bar for c in counts) == taken
    assert gru_lm.plan_trainers(0) == (1, 1) and gru_lm.plan_trainers(400_000 * 64) == (64, 1)
    trainers, turns = gru_lm.plan_trainers(10**13)
    assert 0.9 < trainers * turns * 400_000 / 10**13 < 1.1 and trainers >= 1000


CLASH = ["norm", "digest", "_b", "score", "row", "rid", "sha", "size", "locator", "n", "_source", "stratum"]


def test_extra_columns_with_clashing_names(spark):
    rows = [(k, f"text {k % 3} and some more words {k}", "s", [1.0, float(k)], "h", k, *["x"] * len(CLASH)) for k in range(4)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, embedding array<double>, html string, vec_id long, " + ", ".join(f"{c} string" for c in CLASH))
    df = df.withColumn("page_id", F.col("doc_id")).withColumn("url", F.lit("u"))
    labels = spark.createDataFrame([(k, k % 2, k % 2) for k in range(4)], "doc_id long, quality int, toxic int")
    assert quality.scores(df, quality.train(df, labels)).count() == toxicity.scores(df, toxicity.train(df, labels)).count() == 4
    for found in (cover_tree.near_vectors(spark, df), gru_lm.score(spark, df), sharding.shard_documents(spark, df), bpe.encode_documents(df, bpe.default_vocabulary()), mixing.mix(spark, df), near_dedup.near_duplicates(spark, df), exact_dedup.exact_dedup(spark, df)):
        assert found.count() == 4
    assert warc.derivatives(df).count() == 8


def test_work_folders_are_swept(spark):
    with sweep(spark):
        exact_dedup.exact_dedup(spark, rows_of(spark, [(1, "a")])).count()
        made = exact_dedup.shared_dir(spark)
        spark.range(1).write.parquet(f"{made}/x")
    assert not glob.glob(f"{made}/*")


def test_pipeline_equals_plain_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = toxicity.train(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    best, weights, bias = model
    value = dict(zip(best.tolist(), weights.tolist()))
    rows = [r for r in docs.collect()]

    def score(text):
        data = np.frombuffer(text.encode(), np.uint8)
        h, _ = toxicity.features(data, np.array([0, len(data)]))
        return 1 / (1 + math.exp(-(bias + sum(value.get(x, 0.0) for x in set(h.tolist())))))

    rows = [r for r in rows if score(r["text"]) < 0.7]
    last = {}
    for r in rows:
        key = r["text"].translate(plain.UPPER)
        if key not in last or r["doc_id"] > last[key]["doc_id"]:
            last[key] = r
    rows = sorted(last.values(), key=lambda r: r["doc_id"])
    pairs = plain.weighted_pairs([r["text"] for r in rows], 0.7)
    assert not [s for s in pairs.values() if 0.79 < s < 0.81]  # hashed frequencies can't tip the scales here
    group = plain.components(len(rows), [p for p, s in pairs.items() if s >= 0.8])
    rows = [r for k, r in enumerate(rows) if group[k] == k]
    left = spark.createDataFrame(rows, docs.schema)
    numbered, strata = plain.random_numbers(spark, left)
    library = tokenizers.Tokenizer.from_file("/opt/tokenizers/byte_bpe_50k.json")
    library.no_truncation()
    library.no_padding()
    text, want = {r["doc_id"]: r["text"] for r in rows}, Counter()
    for (doc, *_), copies in zip(numbered, plain.mix(numbered, strata)):
        ids = library.encode(text[doc], add_special_tokens=False).ids
        want[doc, len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()] += copies
    got = Counter((r.doc_id, r.n_tokens, r.ids_sha256) for r in corpus_pipeline.run(spark, SF).collect())
    assert got == +want
