"""Sources and sinks on written files, validation, routing, provider chains, link counts and the engine."""

import json

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from caseloom.functions import providers
from caseloom.functions import text as T
from caseloom.operators import batch, duplicates, graph, patterns, quality, routing, search, validate
from caseloom.plans import retrieval
from caseloom.sources import files
from caseloom.streaming import sessions


def test_document_tree_and_stage_folder(spark, tmp_path):
    (tmp_path / "in" / "deep").mkdir(parents=True)
    for name, data in (("a.pdf", b"one"), ("deep/b.PDF", b"two"), ("c.txt", b"no")):
        (tmp_path / "in" / name).write_bytes(data)
    got = {r.doc_id: (r.length, r.file_hash[:8]) for r in files.document_tree(spark, str(tmp_path / "in")).collect()}
    assert got == {"a": (3, "7692c3ad"), "b": (3, "3fc4ccfe")}
    lower = files.document_tree(spark, str(tmp_path / "in"), "*.pdf")
    assert [r.doc_id for r in lower.collect()] == ["a"]
    stage = tmp_path / "stage"
    stage.mkdir()
    (stage / "x.json").write_text(json.dumps({"doc_id": "x", "n": 1}, indent=1))
    (stage / "y.error.json").write_text(json.dumps({"doc_id": "y", "n": 2}))
    assert [r.doc_id for r in files.stage_json(spark, str(stage)).collect()] == ["x"]
    assert [r.doc_id for r in files.stage_json(spark, str(stage), errors=True).collect()] == ["y"]


def test_manifests_aliases_and_alerts(spark, tmp_path):
    entry = "struct<doc_id:string,file_path:string>"
    rows = [{"doc_id": "a", "file_path": "p"}, {"doc_id": "b", "file_path": None}]
    (tmp_path / "list.json").write_text(json.dumps({"documents": rows}))
    (tmp_path / "keyed.json").write_text(json.dumps({r["doc_id"]: r for r in rows}))
    for name in ("list", "keyed"):
        assert sorted(r.doc_id for r in files.manifest(spark, str(tmp_path / f"{name}.json"), entry).collect()) == ["a", "b"]
    (tmp_path / "aliases.json").write_text(json.dumps({"J. Doe": "Jane Doe"}))
    assert files.aliases(spark, str(tmp_path / "aliases.json")).collect() == [("J. Doe", "Jane Doe")]
    assert files.aliases(spark, str(tmp_path / "none.json")).count() == 0
    path = str(tmp_path / "alerts")
    records = spark.createDataFrame([("d1", [("x|victim",), ("victim",)]), ("d2", [("witness",)])], "doc_id string, people array<struct<role:string>>")
    files.append_alerts(validate.validate(records), path, "local")
    files.append_alerts(validate.validate(records.where("doc_id = 'd2'")), path, "local")  # nothing to tell: no file is written
    read = files.alerts(spark, path)
    assert [(r.doc_id, r.provider, r.violations) for r in read.collect()] == [("d1", "local", ["Invalid person.role: 'x' in doc d1"])]
    by_doc, by_kind = files.alert_summary(read)
    assert by_doc.collect() == [("d1", 1)] and by_kind.collect() == [("Invalid person.role", 1)]


def test_stage_groups_and_merged_sinks(spark, tmp_path):
    results = spark.createDataFrame([("a", "t", None), ("b", None, "boom")], "doc_id string, text string, error string")
    files.write_stage(results, str(tmp_path / "s"))
    assert spark.read.json(str(tmp_path / "s" / "results")).select("doc_id").collect() == [("a",)]
    assert spark.read.json(str(tmp_path / "s" / "errors")).select("doc_id", "error").collect() == [("b", "boom")]
    groups = spark.createDataFrame([(1, 1), (1, 2), (5, 5), (5, 6), (5, 7)], "seed long, doc_id long")
    files.write_groups(groups, str(tmp_path / "g"))
    read = files.groups(spark, str(tmp_path / "g"), "bigint")
    assert sorted((r.group_id, r.documents, r.merge_strategy) for r in read.collect()) == [(1, [1, 2], "union"), (5, [5, 6, 7], "union")]
    assert spark.read.json(str(tmp_path / "g" / "summary")).select("total_groups", "total_documents").collect() == [(2, 5)]
    merged = spark.createDataFrame([(1, 2, "text", 3)], "group long, base_id long, merged_text string, total_fillins long")
    files.write_merged(merged, str(tmp_path / "m"))
    assert spark.read.json(str(tmp_path / "m" / "summary")).select("merged", "total_fillins").collect() == [(1, 3)]
    assert spark.read.json(str(tmp_path / "m" / "texts")).select("merged_text").collect() == [("text",)]


def test_alias_triage_and_page_text_files(spark, tmp_path):
    table = spark.createDataFrame([("b", "B"), ("a", "A")], "alias string, canonical string")
    for _ in range(2):
        files.save_aliases(table, str(tmp_path / "aliases"))
    assert sorted(map(tuple, files.aliases(spark, str(tmp_path / "aliases")).collect())) == [("a", "A"), ("b", "B")]
    routes = spark.createDataFrame([(f"d{k}", "text" if k < 5 else "image") for k in range(6)], "doc_id string, route string")
    files.write_triage(routes, str(tmp_path / "t"), 2)
    assert {(r.split, r["count"]) for r in spark.read.json(str(tmp_path / "t" / "text")).groupBy("split").count().collect()} == {(0, 3), (1, 2)}
    assert spark.read.json(str(tmp_path / "t" / "image")).count() == 1
    docs = spark.createDataFrame([("a", bytearray(b"one\ftwo")), ("b", bytearray(b"\xff"))], "doc_id string, content binary")
    got = {r.doc_id: (r.pages, (r.error or "")[:18]) for r in files.page_texts(spark, docs, lambda data: data.decode().split("\f")).collect()}
    assert got == {"a": (["one", "two"], ""), "b": (None, "UnicodeDecodeError")}
    assert files.write_vectors(spark.createDataFrame([("P", "a", [1.0])], "label string, key string, embedding array<double>"), str(tmp_path / "v")) == 1


def test_first_write_and_manifest_merge(spark):
    old = spark.createDataFrame([("a", "x")], "doc_id string, text string")
    new = spark.createDataFrame([("a", "y"), ("b", ""), ("c", "z"), ("d", None)], "doc_id string, text string")
    assert [r.doc_id for r in batch.first_write(old, new).collect()] == ["c"]
    good, bad = batch.split_errors(new.withColumn("error", F.when(F.col("doc_id") == "a", "e")))
    assert good.count() == 3 and [r.doc_id for r in bad.collect()] == ["a"]


def test_caps_keep_nulls_and_repeated_rows(spark):
    docs = spark.createDataFrame([(1, None), (2, "a"), (2, "a"), (3, "")], "doc_id long, text string")
    for cap in (quality.cap_lines, quality.cap_sentences, quality.repaired):
        assert sorted((r.doc_id, r.text or "", r.removed) for r in cap(docs).collect()) == [(1, "", 0), (2, "a", 0), (2, "a", 0), (3, "", 0)]
        assert [r.text for r in cap(docs.where("doc_id = 1")).collect()] == [None]
    line, short = "the very same line, again", "short"
    text = "\n".join([line, short, "  " + line] * 4)
    (row,) = quality.cap_lines(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()
    assert row.removed == 5 and row.text == "\n".join([line, short, "  " + line, line, short, short, short])
    sentence = "A sentence that says it all."
    long = "  ".join([sentence] * 30)
    (row,) = quality.cap_sentences(spark.createDataFrame([(1, long)], "doc_id long, text string")).collect()
    assert row.removed == 27 and row.text == " ".join([sentence] * 3)
    loose = "  ".join(f"Sentence number {k} stands for itself." for k in range(30))
    assert quality.cap_sentences(spark.createDataFrame([(1, loose)], "doc_id long, text string")).first()["text"] == loose


@pytest.mark.parametrize("n", [0, 19, 20, 21, 999, 1000, 1001, 2055, 2050, 30_007])
def test_windows_equal_slices(spark, n):
    rng = np.random.default_rng(n)
    text = "".join(rng.choice(list("ab\n😀é"), n))
    want = [text[i : i + 10] for i in range(0, n - 10, max(1, n // 100))] if n >= 20 else None
    got = spark.createDataFrame([(text,)], "t string").select(T.sampled_windows(F.col("t"))).first()[0]
    assert got == want


def test_properties_of_mixed_types(spark):
    df = spark.sql("SELECT named_struct('s', ' a | b ', 'e', '  ', 'l', array(' x ', '', NULL), 'b', array(' '), 'n', 5) AS r")
    got = df.select(T.safe_struct(F.col("r"), {"s": "string", "e": "string", "l": "list", "b": "list", "n": "other"}).alias("p")).first()["p"]
    assert tuple(got) == ("a", None, ["x"], None, 5)


def test_all_domains_are_checked(spark):
    assert len(validate.DOMAINS) == 14 and len(validate.CHECKS) == 14 and {c[3] for c in validate.CHECKS} == set(validate.DOMAINS)
    rows = [("d", [(" victim | nobody ", None)], [("", "")], [("friend|legal",)], None)]
    schema = "doc_id string, people array<struct<role:string,name:string>>, allegations array<struct<severity:string,status:string>>, associations array<struct<nature:string>>, events array<struct<event_type:string>>"
    (r,) = validate.validate(spark.createDataFrame(rows, schema)).collect()
    # Blank severity is allowed, blank status isn't; associations aren't parted at pipes; a null category is no violation.
    assert not r.is_valid and r.violations == ["Invalid person.role: 'nobody' in doc d", "Invalid allegation.status: '' in doc d", "Invalid association.nature: 'friend|legal' in doc d"]
    assert validate.validate(spark.createDataFrame([("d", None)], "doc_id string, text string")).first()["is_valid"]


def test_link_counts_equal_plain_rule(spark):
    rng = np.random.default_rng(4)
    rows = []
    for k in range(160):
        text = None if k % 11 == 0 else f"t{rng.integers(25)}"
        rows.append((k, None if k % 23 == 0 else int(rng.integers(1, 4)), None if k % 13 == 0 else int(rng.integers(0, 60)), text, f"f{rng.integers(60)}"))
    df = spark.createDataFrame(rows, "doc_id long, page_count long, size long, text_hash string, file_hash string")
    got = {r.doc_id: r.n_links for r in duplicates.similar_counts(df).collect()}

    def similar(a, b):
        if a[1] is None or a[1] != b[1]:
            return False
        x, y = a[2] or 0, b[2] or 0
        return a[4] == b[4] or (a[3] is not None and a[3] == b[3]) or (x > 0 and y > 0 and min(x, y) / max(x, y) > 0.9)

    assert got == {a[0]: sum(similar(a, b) for b in rows if b is not a) for a in rows}


def test_look_alikes_equal_all_pairs(spark):
    rng = np.random.default_rng(5)
    base = rng.integers(0, 2, (12, 64))
    hashes = ["".join(map(str, np.where(rng.random(64) < rng.choice([0.02, 0.08, 0.12]), 1 - b, b))) for b in base for _ in range(6)]
    df = spark.createDataFrame([(1 + k % 2, h) for k, h in enumerate(hashes)] + [(1, "")], "page_count long, phash string")
    got = {(r.page_count, r.a, r.b) for r in duplicates.look_alikes(df).collect()}
    near = lambda a, b: sum(x == y for x, y in zip(a, b)) / 64 >= 0.9
    pages = {(p, h) for p, h in ((1 + k % 2, h) for k, h in enumerate(hashes))}
    assert got == {(p, a, b) for p, a in pages for q, b in pages if p == q and a < b and near(a, b)} and got


def test_look_alikes_compare_blocks_once(spark):
    rng = np.random.default_rng(6)
    hashes = ["".join(x) for x in rng.choice(list("01"), (150, 32))] + ["z" * 32, "\u00e9" + "z" * 31, "01"]
    df = spark.createDataFrame([(1 + k % 2, h) for k, h in enumerate(hashes)] + [(1, hashes[0]), (None, hashes[2]), (1, None)], "page_count int, phash string")
    found = duplicates.look_alikes(df, 0.7, 32, rows=16)
    got = [tuple(r) for r in found.collect()]
    share = lambda a, b: sum(x == y for x, y in zip(a, b)) / 32
    pages = {(1 + k % 2, h) for k, h in enumerate(hashes) if len(h) == 32}
    want = sorted((p, a, b, share(a, b)) for p, a in pages for q, b in pages if p == q and a < b and share(a, b) >= 0.7)
    assert sorted(got) == want and want
    # No row of the plan is a pair of hashes, but those that are found.
    assert "piece" not in found._jdf.queryExecution().toString() and "CoGroup" in found._jdf.queryExecution().toString()


def test_redaction_boxes():
    mask = np.zeros((60, 80), bool)
    mask[5:15, 10:40] = True
    mask[15:20, 35:60] = True  # touches the first
    mask[30:32, 0:80] = True  # too wide for its height
    mask[40:45, 5:10] = True  # too small
    mask[45:58, 10:30] = True  # meets the small one at a corner only
    assert sorted(routing.dark_boxes(mask)) == [(10, 5, 60, 20, 425, 0.85), (10, 45, 30, 58, 260, 0.85)]
    assert routing.dark_boxes(np.zeros((5, 5), bool)) == []
    bands = np.zeros((60, 50), bool)
    bands[20:40] = True
    assert (0, 20, 49, 35, 735, 0.7) in routing.dark_boxes(bands, bands=True)


def test_readers_and_confidence(spark):
    rows = [("a", "text", 10, "m" * 150, "s", "v"), ("b", "text", 60 * 2**20, "m" * 150, "s" * 60, "v"), ("c", "mixed", 10, None, None, "v"), ("d", "photograph", 10, "m" * 150, None, "v")]
    df = spark.createDataFrame(rows, "doc_id string, track string, size long, marked string, seen string, analysis string")
    got = {r.doc_id: (r.engine, r.text, r.confidence) for r in routing.results(df).collect()}
    assert got == {"a": ("marker", "m" * 150, 0.8), "b": ("vision", "s" * 60, 0.9), "c": ("vision", T.VISUAL + "v", 0.7), "d": ("vision", "v", 0.85)}
    first = {r.doc_id: (r.engine, r.text) for r in routing.results(df, "vision_first").collect()}
    assert first == {"a": ("marker", "m" * 150), "b": ("marker", "m" * 150), "c": ("vision", "c" + T.VISUAL + "v"), "d": ("vision", "v")}
    kinds = spark.createDataFrame([("a", "odd", 1), ("b", None, 1)], "doc_id string, doc_type string, size long")
    assert sorted(r.error for r in routing.routed(kinds).collect()) == ["Unknown document type: None", "Unknown document type: odd"]
    assert routing.routed(kinds, "legacy").count() == 0 and {r.track for r in routing.routed(kinds, "vision_first").collect()} == {"text"}


def test_a_text_of_100_characters_with_blanks_is_taken_from_the_text_reader(spark):
    rows = [(1, "text", 10, "x" * 30 + " " * 70, "seen", None), (2, "text", 10, "x" * 30 + " " * 69, "seen", None)]
    got = routing.results(spark.createDataFrame(rows, "doc_id long, track string, size long, marked string, seen string, analysis string"))
    assert [tuple(r)[2:] for r in got.orderBy("doc_id").collect()] == [("marker", "x" * 30 + " " * 70, 0.8), ("vision", "seen", 0.7)]


def test_providers_are_asked_in_turn_for_what_is_left(spark):
    def even(frames):
        for f in frames:
            yield f[f.doc_id % 2 == 0].assign(answer="even")[["doc_id", "answer"]]

    def broken(frames):
        raise RuntimeError("down")

    def threes(frames):
        for f in frames:
            assert (f.doc_id % 2 == 1).all()  # only what the others left
            yield f[f.doc_id % 3 == 0].assign(answer="three")[["doc_id", "answer"]]

    docs = spark.range(12).withColumnRenamed("id", "doc_id").repartition(2)
    got = providers.run_chain(docs, [("a", even), ("b", broken), ("c", threes)], "doc_id bigint, answer string")
    found = {r.doc_id: (r.provider, r.answer, r.error) for r in got.collect()}
    assert {k for k, v in found.items() if v[0] == "a"} == {0, 2, 4, 6, 8, 10} and {k for k, v in found.items() if v[0] == "c"} == {3, 9}
    assert {v for k, v in found.items() if k in (1, 5, 7, 11)} == {(None, None, "c: no answer")}
    down = providers.run_chain(docs.where("doc_id = 1"), [("b", broken)], "doc_id bigint, answer string").first()
    assert down.error == "b: RuntimeError: down"
    stats = providers.batch_stats(docs.unionByName(spark.createDataFrame([(99,)], "doc_id long")), spark.createDataFrame([(99,)], "doc_id long"), got).first()
    assert tuple(stats) == (13, 8, 1, 4)


def test_node_embedding_in_batches(spark):
    nodes = spark.createDataFrame([("Event", f"e{k}", None if k % 2 else "n", "  " if k == 3 else f"text {k}") for k in range(7)] + [("Person", "p", None, None), ("Person", "q", "Q", "r")], "label string, key string, name string, text string")
    done = spark.createDataFrame([("Event", "e6")], "label string, key string")
    vectors, stats = providers.embed_nodes(nodes, done, lambda texts: [[float(len(t)), float(len(texts))] for t in texts], 2)
    got = {r.key: r.embedding[0] for r in vectors.collect()}
    assert got == {"e0": 9.0, "e1": 6.0, "e2": 9.0, "e4": 9.0, "e5": 6.0, "q": 4.0} and vectors.agg(F.max(F.col("embedding")[1])).first()[0] <= 2
    assert {(r.label, r.total, r.embedded, r.skipped) for r in stats.collect()} == {("Event", 6, 5, 1), ("Person", 1, 1, 0), (None, 7, 6, 1)}


def test_merge_with_a_store(spark):
    props = "label string, key string, props map<string,string>"
    old = spark.createDataFrame([("P", "a", {"x": "1", "y": "2"}), ("P", "b", {"x": "3"}), ("P", "d", None)], props)
    new = spark.createDataFrame([("P", "a", {"x": "9"}), ("P", "c", {}), ("P", "d", {"z": "0"})], props)
    merged = graph.merge_properties(old, new, graph.NODE_KEY)
    want = {"a": {"x": "9", "y": "2"}, "b": {"x": "3"}, "c": {}, "d": {"z": "0"}}
    assert {r.key: r.props for r in merged.collect()} == want
    assert {r.key: r.props for r in graph.merge_properties(merged, new, graph.NODE_KEY).collect()} == want


def test_engine_composes_search_expansion_and_patterns(spark):
    edges = spark.createDataFrame([("Ann", "PARTICIPATED_IN", "Event", "gala"), ("Bob", "PARTICIPATED_IN", "Event", "gala"), ("Ann", "MENTIONED_IN", "Document", "1"), ("Ann", "MENTIONED_IN", "Document", "2"), ("Bob", "MENTIONED_IN", "Document", "2")], "src_key string, rel string, dst_label string, dst_key string")
    docs = spark.createDataFrame([(1, "about the gala"), (3, "who attended the gala that night"), (4, "nothing")], "doc_id long, text string")
    got = search.engine(spark, edges, docs, "Who attended gala?")
    assert {r.answer for r in got["answer"].collect()} == {"Ann", "Bob"}
    assert {r.doc: r.legs for r in got["sources"].collect()} == {"1": 2, "2": 1, "3": 1}
    assert got["patterns"].collect() == [("Ann", 2)] and {(r.key, r.hop) for r in got["graph_context"].collect()} == {("gala", 0), ("Ann", 0), ("Bob", 0), ("1", 1), ("2", 1)}
    none = search.engine(spark, edges, docs, "nothing of the kind")
    assert none["answer"].count() == 0 and {r.doc for r in none["sources"].collect()} == {"4"}
    assert "edges" not in [t.name for t in spark.catalog.listTables()]


def test_chains_and_dates(spark):
    edges = spark.createDataFrame([("a", "R", "b", "d1"), ("b", "R", "c", "d2"), ("c", "R", "d", "d3"), ("d", "R", "e", "d4"), ("a", "S", "c", "d5")], "src string, rel string, dst string, doc string")
    one = lambda *keys: spark.createDataFrame([(k,) for k in keys], "key string")
    got = {(r.end, r.hops, r.chain) for r in patterns.chains(edges, one("a"), one("d", "e", "c"), 3).collect()}
    assert got == {("c", 1, "a -[S @d5]-> c"), ("d", 2, "a -[S @d5]-> c -[R @d3]-> d"), ("e", 3, "a -[S @d5]-> c -[R @d3]-> d -[R @d4]-> e")}
    dates = spark.createDataFrame([(k, x, "e") for k, x in enumerate(["2001-02-03", "2001-02", "~2001", "2001-13", "soon", None])], "event_id long, date string, description string")
    none = spark.createDataFrame([], "event_id long, name string, doc string")
    lines = {r.event_id: (str(r.event_date), r.precision, r.approximate, r.line) for r in patterns.dated_timeline(dates, none, none).collect()}
    assert lines[0] == ("2001-02-03", "day", False, "2001-02-03: e") and lines[1] == ("2001-02-01", "month", False, "2001-02: e") and lines[2] == ("2001-01-01", "year", True, "~2001: e")
    assert all(lines[k] == ("None", None, False, "undated: e") for k in (3, 4, 5))


def test_streamed_counts_and_batches(spark, tmp_path):
    events = pd.DataFrame({"ts": pd.to_datetime(["2024-01-01 00:10", "2024-01-01 00:50", "2024-01-01 01:10", "2024-01-02 00:00"]), "event_type": ["a", "a", "a", "b"], "user_id": [1, 1, 1, 2]})
    path = str(tmp_path / "e")
    spark.createDataFrame(events).write.parquet(path)
    got = sessions.run_to_end(sessions.windowed_counts(sessions.file_stream(spark, path)), str(tmp_path / "out"), str(tmp_path / "c"))
    assert sorted((r.event_type, r.start_ts.hour, r.n) for r in got.collect()) == [("a", 0, 2), ("a", 1, 1)]
    seen = []
    sessions.each_batch(sessions.file_stream(spark, path), str(tmp_path / "c2"), lambda df, k: seen.append((k, df.count())))
    assert seen == [(0, 4)]
    every = sessions.closed_sessions(spark, path, str(tmp_path / "w"))
    assert sorted((r.user_id, r.n) for r in every.collect()) == [(1, 3), (2, 1)]


def test_search_takes_every_query(spark):
    rng = np.random.default_rng(1)
    x = rng.standard_normal((300, 8))
    x[7] = 0
    rows = [(k, v if k != 9 else None, k % 3) for k, v in enumerate(x.tolist())]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    asked = df.where("vec_id % 20 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query"))
    u = x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)
    keep = [k for k in range(300) if k not in (7, 9)]
    for by in (None, "label"):
        got = search.vector_topk(df, asked, 4, by, rows=64).collect()
        want = set()
        for q in range(0, 300, 20):
            for part in ([keep] if by is None else [[k for k in keep if k % 3 == m] for m in range(3)]):
                best = sorted(part, key=lambda k: (-round(float(u[q] @ u[k]), 6), k))[:4]
                want |= {(q, k, r + 1) for r, k in enumerate(best)}
        assert {(r.query_id, r.vec_id, r["rank"]) for r in got} == want


def test_a_sketch_stands_beside_no_user(spark, sf):
    plan = retrieval.approximate_users(spark, sf)._jdf.queryExecution().executedPlan().toString()
    aggregates = [line for line in plan.splitlines() if "Aggregate(" in line and "user_id#" in line.partition("functions=")[0]]
    assert aggregates and not any("approx_count_distinct" in line for line in aggregates)


def test_search_holds_one_pair_of_blocks_at_a_time(spark):
    rng = np.random.default_rng(2)
    x = rng.integers(-2, 3, (90, 2)).astype(float)  # many ties and zeros
    rows = [(f"v{k:02}", [*v, float("nan")] if k == 5 else [None, 1.0] if k == 6 else [*v, 1.0] if k % 9 == 4 else v, None if k % 7 == 0 else "a") for k, v in enumerate(x.tolist())]
    df = spark.createDataFrame(rows, "vec_id string, embedding array<float>, label string")
    asked = df.where("vec_id < 'v20'").select(F.hash("vec_id").alias("query_id"), F.col("vec_id").alias("name"), F.col("embedding").alias("query"))
    found = search.vector_topk(df, asked, 3, rows=8)
    assert "CoGroup" in found._jdf.queryExecution().toString() and "collect_list" not in found._jdf.queryExecution().toString()
    vectors = {k: [np.nan if e is None else e for e in v] for k, v, _ in rows}
    good = {k: np.array(v) / np.linalg.norm(v) for k, v in vectors.items() if np.isfinite(v).all() and np.any(v)}
    want = set()
    for q in asked.collect():
        if q.name in good:
            near = [(-round(float(good[q.name] @ u), 6), k) for k, u in good.items() if len(u) == len(good[q.name])]
            want |= {(q.query_id, k, r + 1) for r, (_, k) in enumerate(sorted(near)[:3])}
    assert {(r.query_id, r.vec_id, r["rank"]) for r in found.collect()} == want
    assert search.vector_topk(df, asked.where("false"), 3, "label", rows=8).count() == 0
    assert search.vector_topk(df.where("false"), asked, 3, "label", rows=8).count() == 0
