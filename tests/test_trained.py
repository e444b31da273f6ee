"""The trained classifier in a session that has done other work."""

from pyspark.sql import Observation, functions as F

from broadsheet.operators.scoring import classify_trained


def test_trained_classifier_after_an_observed_metric(spark):
    rows = [(i, "rates" if i % 2 else "sale", "the bank lifts rates" if i % 2 else "buy now and save", bool(i % 2)) for i in range(40)]
    mail = spark.createDataFrame(rows, "message_id long, subject string, body string, is_news boolean")
    seen = Observation("rows")
    mail.observe(seen, F.count(F.lit(1)).alias("n")).collect()
    assert seen.get["n"] == 40
    judged = classify_trained(mail.drop("is_news"), mail.select("subject", "body", "is_news"))
    assert {r["message_id"]: r["is_news"] for r in judged.collect()} == {i: news for i, _, _, news in rows}
