from pyspark.sql import functions as F

from caseloom.llm import gru_lm


def test_learns_from_every_training_token(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(gru_lm, "TRAINERS", 2)
    monkeypatch.setattr(gru_lm, "PER_TRAINER", 120_000)
    words = F.expr("concat_ws(' ', transform(sequence(1, 1200), i -> concat('w', pmod(xxhash64(id, i), 300))))")
    # One text comes 50 times: its copies are dealt to all parts.
    docs = spark.range(450).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 50, F.lit("the same text")).otherwise(words).alias("text"), F.lit(True).alias("train"))
    v, p, _ = gru_lm.learn(spark, docs, f"{tmp_path}/work")
    assert v.total == 400 * 1201 + 50 * 4
    learned = spark.read.parquet(f"{tmp_path}/work/sample")
    assert learned.agg(F.sum(F.octet_length("ids") / 2)).first()[0] == v.total
    if "turn" in learned.columns:
        assert {(r["turn"], r["trainer"]) for r in learned.select("turn", "trainer").distinct().collect()} == {(a, b) for a in range(2) for b in range(2)}
        short = learned.where("octet_length(ids) = 8")
        assert short.select("turn", "trainer").distinct().count() == 4
    assert (p["u"] != v.start()["u"]).any()
