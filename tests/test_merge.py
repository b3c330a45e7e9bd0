"""Merged copies, JSON in text, rewrites, prompts, the catalogue and the command line."""

import pytest
from pyspark.sql import functions as F

from caseloom import __main__ as cli
from caseloom.functions import text as T
from caseloom.operators import duplicates, schema
from tests.test_text import values


def test_balanced_json(spark):
    cases = ['say {"a": {"b": 1}} end }', "{}", "no braces", "open { only", "", None, "} {x} }", "{a}{b}", '{"a": "}"}']
    assert values(spark, cases, T.balanced_json) == ['{"a": {"b": 1}}', "{}", "no braces", "open { only", "", None, "{x}", "{a}", '{"a": "}']


def test_rewrites(spark):
    old = F.lit("x" * 20)
    cases = [None, "NO corrections needed", "y" * 9, "y" * 10, "```markdown\nmany " + "y" * 20 + "\n```", ""]
    assert values(spark, cases, lambda c: T.rewrite_outcome(old, c)) == ["error", "kept", "error", "rewritten", "rewritten", "error"]
    assert values(spark, cases, lambda c: T.accepted_rewrite(old, c)) == ["x" * 20] * 3 + ["y" * 10, "many " + "y" * 20, "x" * 20]


def test_prompts(spark):
    kinds = ["photograph", "table", "legal_document", "form", "other", None]
    assert values(spark, kinds, lambda c: T.prompt_template(c, F.lit(True))) == ["photograph", "redaction_aware+table", "redaction_aware", "redaction_aware+form", "redaction_aware", "redaction_aware"]
    assert values(spark, kinds, lambda c: T.prompt_template(c, F.lit(False))) == ["photograph", "general+table", "legal_document", "general+form", "general", "general"]
    assert values(spark, ["BlockTypes.Table", "Table", "x.Text", None], T.block_kind) == ["Table", "Table", "x.Text", None]
    assert values(spark, ["BlockTypes.Table", "Text", None], lambda c: T.block_prompt(F.lit("t"), c, {"Table": "cells"}, "%s|%s")) == ["cells|t", "|t", "|t"]


def test_mean_hash(spark):
    assert values(spark, [[0.0, 10.0, 5.0, 6.0], [], None, [1.0]], lambda c: T.mean_hash(c, 4), "array<double>") == ["0101", "", "", ""]


def test_merge(spark):
    docs = spark.createDataFrame([(1, 1, "base"), (1, 2, "copy"), (1, 3, ""), (1, 4, "same"), (2, 5, None)], "group int, doc_id int, text string")
    box = lambda d, x: (1, d, 1, float(x), 0.0, float(x + 10), 10.0)
    regions = spark.createDataFrame([box(1, 0), box(1, 0), box(1, 100), box(2, 0), box(2, 300), box(2, 600), box(3, 0), box(3, 20), box(3, 40), box(4, 0), box(4, 100), box(4, 200)], "group int, doc_id int, page int, x0 double, y0 double, x1 double, y1 double")
    got = {r["group"]: r for r in duplicates.merge_all(docs, regions).collect()}
    assert got[1]["base_id"] == 1 and got[1]["total_fillins"] == 1
    assert got[1]["merged_text"] == "base" + duplicates.BANNER + "\n--- From 2 (1 fillins) ---\n\ncopy"
    assert (got[2]["base_id"], got[2]["merged_text"], got[2]["total_fillins"]) == (5, "", 0)
    assert duplicates.merge_all(docs.limit(0), regions).count() == 0


def test_schema(spark):
    want = schema.wanted(spark)
    assert want.count() == 28 and want.where("kind = 'key'").select("labels").distinct().count() == 18
    some = want.where("kind != 'vector'")
    full = schema.create(some, want)
    assert schema.missing(some, want).count() == 6 and schema.missing(full, want).count() == 0
    other = want.withColumn("name", F.concat("name", F.lit("_old")))
    assert schema.missing(other, want).count() == 0
    foreign = spark.createDataFrame([("fulltext", "search", ["X"], ["y"], None)], schema.SCHEMA)
    assert schema.verify(full.union(foreign)).first()["fulltexts"] == 4
    assert not schema.verify(some).first()["ok"] and not schema.verify(some.limit(0)).first()["ok"]


def test_command_line(spark, sf, tmp_path, capsys):
    assert cli.run(spark, ["schema"]) == 0 and "complete" in capsys.readouterr().out
    assert cli.run(spark, ["query", "nothing", sf, str(tmp_path / "x")]) == 1
    assert cli.run(spark, ["quality", f"{sf}/documents.parquet", str(tmp_path / "q")]) == 0
    assert spark.read.parquet(str(tmp_path / "q")).count() == 200
    assert cli.run(spark, ["split", f"{sf}/documents.parquet", str(tmp_path / "s"), "--parts", "3"]) == 0
    assert sorted(r["count"] for r in spark.read.parquet(str(tmp_path / "s")).groupBy("chunk").count().collect()) == [66, 67, 67]
    spark.createDataFrame([(1, ["a" * 300])], "doc_id long, pages array<string>").write.parquet(str(tmp_path / "p"))
    assert cli.run(spark, ["classify", str(tmp_path / "p"), str(tmp_path / "c")]) == 0
    assert spark.read.parquet(str(tmp_path / "c")).first()["doc_type"] == "text_document"
    with pytest.raises(SystemExit):
        cli.run(spark, ["unknown"])
