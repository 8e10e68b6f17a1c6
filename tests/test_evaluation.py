import pytest
from pyspark.sql import functions as F

from massquarry.operators import evaluation, models, references, spectra

P = "array<struct<mz:double,intensity:double>>"


def test_tiers(spark):
    a = [(100.0, 1.0), (150.0, 4.0), (200.0, 9.0)]
    b = [(100.001, 1.0), (150.001, 4.0), (200.001, 9.0)]
    c = [(110.0, 1.0), (150.0, 4.0), (210.0, 9.0)]
    rows = [(1, a, a, 300.0, 300.0, 1.0), (2, a, b, 300.0, 300.005, 1.0), (3, a, c, 300.0, 300.005, 0.97), (4, a, c, 300.0, 310.0, 0.4), (5, a, None, None, 300.0, None)]
    df = spark.createDataFrame(rows, f"id int, q_peaks {P}, r_peaks {P}, q_precursor double, r_precursor double, cosine double").withColumns({"q_adduct": F.lit("x"), "r_adduct": F.when(F.col("id") < 5, "x"), "q_mode": F.lit("p"), "r_mode": F.lit("p")})
    df = df.withColumns({f"{s}_hash": spectra.peak_hash(F.col(f"{s}_peaks"), F.col(f"{s}_precursor")) for s in "qr"})
    assert {r.id: r.tier for r in references.identity_tier(df).collect()} == {1: "T1", 2: "T2", 3: "T3", 4: "T4", 5: "T4"}


def test_peak_hash_ignores_order_and_scale(spark):
    rows = [([1.0, 2.0], [10.0, 20.0]), ([2.0, 1.0], [1.0, 0.5]), ([2.0, 1.0], [1.0, 0.6])]
    h = spark.createDataFrame(rows, "m array<double>, i array<double>").select(spectra.peak_hash(spectra.peaks(F.col("m"), F.col("i")), F.lit(99.5)).alias("h")).collect()
    assert h[0].h == h[1].h != h[2].h


def test_boosted_trees_as_expressions(spark):
    rows = [(k % 5, float(k % 17), None if k % 13 == 0 else float((k * 7) % 11), int(k % 17 > 8)) for k in range(600)]
    df = spark.createDataFrame(rows, "fold int, x double, z double, y int")
    m = models.fit_folds(df, ["x", "z"], "y", "fold", [0, 1], trees=5, depth=3)
    s = df.withColumn("s", models.by_fold(m, "fold")).where("fold < 2")
    got = s.groupBy("y").agg(F.avg("s").alias("s")).collect()
    v = {r.y: r.s for r in got}
    assert v[1] > 0.9 and v[0] < 0.1
    assert df.select(models.fold_mean(list(m.values())).alias("s")).where("s is null").count() == 0
    with pytest.raises(ValueError):
        models.assert_allowed(["x", "is_true_candidate"])
    with pytest.raises(ValueError):
        models.fold_mean([{"features": ["x"], "trees": []}, {"features": ["z"], "trees": []}])
    c = models.constant_control(df, ["x"]).select("x").distinct().count()
    assert c == 1 and models.mask_control(df, ["x"], "fold", 1.0).where("x is not null").count() == 0
    assert df.select(models.missingness_score(["x", "z"]).alias("n")).where("n = 1").count() == len([r for r in rows if r[2] is None])


def test_hard_negatives_keep_the_truth(spark):
    rows = [("q", f"c{k:02d}", float(k), 1.0 / (k + 1), k == 15) for k in range(20)]
    df = spark.createDataFrame(rows, "q string, c string, m double, s double, t boolean")
    got = {r.c: r.kind for r in evaluation.hard_negatives(df, "q", "c", "m", "s", "t", 6).collect()}
    assert len(got) == 6 and got["c15"] == "truth" and {"c00", "c01", "c02", "c03"} <= {c for c, k in got.items() if k == "hard"}


def test_censored_median_and_bins(spark):
    df = spark.createDataFrame([("a", 1, True), ("a", 2, True), ("a", 5, False), ("b", 5, False), ("b", 5, False), ("b", 1, True)], "g string, n int, e boolean")
    got = {r.g: r["median"] for r in evaluation.censored_median(df, "g", "n", "e").collect()}
    assert got == {"a": 2.0, "b": None}
    b = spark.createDataFrame([(0,), (1,), (7,), (49,), (50,), (600,), (799,), (800,)], "n int").select(evaluation.pool_bin(F.col("n")).alias("b")).collect()
    assert [r.b for r in b] == [0, 0, 0, 0, 1, 4, 4, 5]  # edges 0, 50, 100, 200, 400, 800
