"""The model of problem 10 counts the words of all texts."""

from pyspark.sql import functions as F

from massquarry.llm import encoding


def test_every_word_of_every_text_counts(spark, monkeypatch):
    n, own = 30_000, 8  # more texts and more distinct words than any sample that was once taken
    letters = lambda c: F.translate(c.cast("string"), "0123456789", "abcdefghij")
    words = [F.concat(F.lit("é"), letters(F.col("id") * own + k)) for k in range(own)]
    df = spark.range(n).select(F.col("id").alias("doc_id"), F.concat_ws(" ", F.lit("Größe Größe"), *words).alias("text"))
    seen = []
    monkeypatch.setattr(encoding, "Model", lambda counts: seen.append(counts))
    encoding.repair(df, "doc_id", "text")
    clean = {k[1:]: v for k, v in seen[0].items() if k[0] == 0}
    assert clean[" ", "é"] == n * own and clean["ö", "ß"] == clean["r", "ö"] == 2 * n
    assert sum(v for (x, _), v in clean.items() if x == "é") == n * own
