import pytest
from pyspark.sql import functions as F

from caseloom.functions import providers, text as T
from caseloom.operators import quality


def values(spark, items, expr, kind="string"):
    return [r[0] for r in spark.createDataFrame([(i, x) for i, x in enumerate(items)], f"i int, v {kind}").orderBy("i").select(expr(F.col("v"))).collect()]


def test_pipe_clean(spark):
    assert values(spark, ["perpetrator", "a|b|c", "  x  ", " a | b ", "", "\ttab\n"], T.pipe_clean) == ["perpetrator", "a", "x", "a", "", "tab"]


def test_valid_name(spark):
    bad = ["", "  ", "Full name as written", "Organization Name (unknown)", "user", "UNKNOWN", "n/a", "N/A", "none", "ABCD0001", "abcd0001", "an exact quote", "in one sentence", None]
    assert values(spark, ["Ada Smith", " Ada "], T.valid_name) == [True, True]
    assert not any(values(spark, bad, T.valid_name))


def test_safe_props(spark):
    got = spark.sql("SELECT map('a', '  x ', 'b', '', 'c', 'p|q', 'd', cast(null as string)) AS m").select(T.safe_props(F.col("m"))).first()[0]
    assert got == {"a": "x", "c": "p"}


def brute_repetition(t):
    if len(t) < 20:
        return 0.0
    w = [t[i : i + 10] for i in range(0, len(t) - 10, max(1, len(t) // 100))]
    return (len(w) - len(set(w))) / len(w)


def test_measures(spark, sf):
    texts = [r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").limit(60).collect()] + ["", "short", "ab " * 400]
    assert values(spark, texts, T.repetition_ratio) == pytest.approx([brute_repetition(t) for t in texts])
    want = [0.0 if len(w := t.lower().split()) < 10 else len(set(w)) / len(w) for t in texts]
    assert values(spark, texts, T.unique_word_ratio) == pytest.approx(want)
    assert values(spark, ["1. 2. 3. 4", "abc", ""], T.number_sequence) == [True, False, False]


def test_classify_and_triage(spark):
    assert values(spark, [["x" * 300], [""], ["abc"], ["", ""], ["a" * 150, "b" * 100]], T.classify, "array<string>") == ["text_document", "photograph", "mixed", "unknown", "text_document"]
    assert values(spark, ["x" * 50, "x" * 51, "x" * 200, "x" * 201], lambda c: T.triage(c, F.lit(True))) == ["image", "text_weak", "text_weak", "text"]


def test_caps_are_idempotent(spark):
    line = "this line is longer than twenty"
    docs = spark.createDataFrame([(1, "\n".join([line] * 5 + ["short"] * 5))], "doc_id long, text string")
    once = quality.cap_lines(docs)
    assert once.first()["removed"] == 2 and once.first()["text"].count("short") == 5
    assert quality.cap_lines(once.select("doc_id", "text")).first()["removed"] == 0
    long = "A sentence that is long enough. " * 20
    assert quality.cap_sentences(spark.createDataFrame([(1, long.strip())], "doc_id long, text string")).first()["removed"] == 17


def test_fences_hashes_embedding(spark):
    assert values(spark, ['```json\n{"k": 1}\n```', '{"k": 2}', '```\n{"k": 3}'], T.fenced_json) == ['{"k": 1}', '{"k": 2}', '{"k": 3}']
    assert values(spark, ["", "short", None], T.text_fingerprint) == [None, None, None]
    assert values(spark, ["1010", "101"], lambda c: T.bit_similarity(c, F.lit("1010"))) == [1.0, 0.0]
    v = values(spark, ["a b c", ""], lambda c: providers.hashed_embedding(c, 8))
    assert sum(x * x for x in v[0]) == pytest.approx(1) and v[1] == [0.0] * 8


def test_marker_ladder_counts_blanks_from_100_on(spark):
    texts = [None, "", " " * 120, "x" * 19 + " " * 100, "x" * 30 + " " * 69, "x" * 30 + " " * 70, " " * 5 + "x" * 95, "x" * 99, "x" * 100]
    assert values(spark, texts, T.marker_confidence, "string") == [0.0, 0.0, 0.2, 0.2, 0.4, 0.8, 0.8, 0.4, 0.8]
