import random

from massquarry.llm.topn import top_n


def brute(rows, n):
    out, groups = set(), {}
    for g, s, i in rows:
        groups.setdefault(g, []).append((s, i))
    for g, v in groups.items():
        key = lambda x: (x[0] is None or x[0] != x[0], -(x[0] or 0) if x[0] == x[0] and x[0] is not None else 0, x[1] is not None, x[1] or "")
        # null ids come last
        v.sort(key=lambda x: (x[0] is None or x[0] != x[0], -(x[0]) if x[0] is not None and x[0] == x[0] else 0, x[1] is None, x[1] or ""))
        out |= {(g, i, p) for p, (_, i) in enumerate(v[:n], 1)}
        del key
    return out


def test_hot_group_ties_nulls_and_nan(spark):
    r = random.Random(1)
    rows = [("hot" if r.random() < 0.4 else f"g{r.randrange(40)}", r.choice([None, float("nan"), 0.5, 0.25, r.random()]), f"c{k}") for k in range(4000)]
    rows += [(None, 1.0, "x"), (None, 2.0, "y"), ("g1", 9.0, None)]
    df = spark.createDataFrame(rows, "g string, s double, i string").repartition(7)
    got = {(x.g, x.i, x.position) for x in top_n(df, ["g"], "s", ["i"], 5).collect()}
    assert got == brute(rows, 5)


def test_same_choice_whatever_the_partitioning(spark):
    rows = [("a", 1.0, f"{k:03d}") for k in range(300)]
    df = spark.createDataFrame(rows, "g string, s double, i string")
    picks = [sorted(x.i for x in top_n(df.repartition(p), ["g"], "s", ["i"], 7).collect()) for p in (1, 3, 11)]
    assert picks[0] == picks[1] == picks[2] == [f"{k:03d}" for k in range(7)]


def test_empty_and_clashing_columns(spark):
    empty = spark.createDataFrame([], "g string, s double, i string")
    assert top_n(empty, ["g"], "s", ["i"], 3).count() == 0
    df = spark.createDataFrame([("a", 1.0, "x", 5, 6), ("a", 2.0, "y", 7, 8)], "g string, s double, i string, position int, part int")
    out = top_n(df, ["g"], "s", ["i"], 1)
    assert out.columns == ["g", "s", "i", "position", "part", "_position"]
    assert [tuple(r) for r in out.collect()] == [("a", 2.0, "y", 7, 8, 1)]
    assert top_n(df, ["g"], "s", ["i"], 0).count() == 0
