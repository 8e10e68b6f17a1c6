import random

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from massquarry.llm import splits


def find(parents, x):
    while parents[x] != x:
        parents[x] = parents[parents[x]]
        x = parents[x]
    return x


def brute(links):
    parents = {}
    for a, b in links:
        if a is None or b is None or a == b:
            continue
        parents.setdefault(a, a)
        parents.setdefault(b, b)
        x, y = find(parents, a), find(parents, b)
        parents[max(x, y)] = min(x, y)
    return {n: find(parents, n) for n in parents}


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 25), st.integers(0, 25)), min_size=1, max_size=30))
def test_components_of_any_graph(spark, links):
    got = {r.node: r.root for r in splits.components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert got == brute(links)


def test_chain_star_and_nulls(spark):
    links = [(k, k + 1) for k in range(60)] + [(1000, 1000 + k) for k in range(1, 200)] + [(None, 5), (7, None), (3, 3), (0, 1)]
    got = {r.node: r.root for r in splits.components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert got == brute(links)


def test_no_links(spark):
    assert splits.components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_records_and_proportions(spark):
    r = random.Random(2)
    rows = [(k, "hot" if k % 10 == 0 else f"k{r.randrange(900)}", None if k % 7 == 0 else f"s{r.randrange(4000)}") for k in range(6000)] + [(k, None, None) for k in range(6000, 6100)]
    df = spark.createDataFrame(rows + rows[:50], "id long, k string, s string")
    ents = [F.concat(F.lit("0"), F.col("k")), F.concat(F.lit("1"), F.col("s"))]
    g = splits.group_records(df, "id", ents)
    got = {x.record: (x.root, x.records) for x in g.collect()}
    roots = brute([("0" + k, "1" + s) for _, k, s in rows if k and s])
    want = {i: roots.get("0" + k, "0" + k) if k else ("1" + s if s else None) for i, k, s in rows}
    assert {i: x for i, (x, _) in got.items()} == want
    assert all(n == 1 for x, n in got.values() if x is None)
    s = splits.proportional_splits(g, {"train": 0.8, "validation": 0.1, "test": 0.1})
    assert s.where("root is not null").groupBy("root").agg(F.count_distinct("split").alias("n")).where("n > 1").count() == 0
    assert s.count() == 6100


def test_a_large_component_does_not_upset_the_proportions(spark):
    rows = [(k, "hot" if k < 1500 else f"k{k}") for k in range(10000)]
    g = splits.group_records(spark.createDataFrame(rows, "id long, k string"), "id", [F.col("k")])
    n = {r["split"]: r["count"] for r in splits.proportional_splits(g, {"train": 0.8, "validation": 0.1, "test": 0.1}).groupBy("split").count().collect()}
    assert abs(n["train"] - 8000) < 200 and abs(n["test"] - 1000) < 150


def test_empty_records(spark):
    g = splits.group_records(spark.createDataFrame([], "id long, k string"), "id", [F.col("k")])
    assert splits.proportional_splits(g, {"train": 1.0}).count() == 0
