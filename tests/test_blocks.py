"""Spectra in blocks: the kernels against plain Python, with blocks of a few spectra."""

import itertools
import math
import os
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from massquarry.operators import blocks
from massquarry.plans import analysis, domain, evaluation, evidence


def sums(m, v):
    out = defaultdict(float)
    if m is None or v is None or len(m) != len(v):
        return out
    for x, y in zip(m, v, strict=True):
        if x is not None and y is not None and math.isfinite(x) and math.isfinite(y) and x >= 0 and y >= 0:
            out[math.floor(x / 0.1)] += y
    return out


def cosine(a, b):
    n = math.sqrt(sum(x * x for x in a.values()) * sum(x * x for x in b.values()))
    return sum(a[k] * b[k] for k in a if k in b) / n if n else 0.0


def entropy(a, b):
    h = lambda v: -sum(x * math.log(x) for x in v if x > 0)
    p, q = ({k: x / sum(s.values()) for k, x in s.items()} for s in (a, b))
    mixed = [(p.get(k, 0) + q.get(k, 0)) / 2 for k in p.keys() | q.keys()]
    return 1 - (2 * h(mixed) - h(p.values()) - h(q.values())) / math.log(4)


def spectra(r, n):
    out = []
    for _ in range(n):
        k = r.randrange(2, 9)
        out.append(([round(r.choice([50.0, 60.0, 70.0, 80.0, 90.0]) + r.choice([0, 0.05, 0.11]), 3) for _ in range(k)], [r.choice([0.0, 1.0, 5.0, 20.0]) for _ in range(k)]))
    return [*out, ([], []), (None, [1.0]), ([50.0, 60.0], [1.0]), ([50.0, None, float("nan"), -1.0], [3.0, 1.0, 1.0, 1.0]), ([50.0], [0.0])]


KIND = "id string, mode string, p double, mz array<double>, i array<double>"


def test_similar_pairs_in_blocks(spark):
    x = {f"s{k:03}": s for k, s in enumerate(spectra(random.Random(5), 60))}
    rows = [(k, None, None, *s) for k, s in x.items()]
    b = blocks.blocks(spark.createDataFrame([*rows, rows[3], (None, None, None, [50.0], [1.0])], KIND), "id", "mz", "i", most=7)
    got = {(r.a, r.b): (r.cosine, r.entropy_similarity) for r in blocks.similar(b, None, "a", "b", 0.3, entropy=True).collect()}
    s = {k: sums(*v) for k, v in x.items()}
    want = {(a, c): (cosine(s[a], s[c]), entropy(s[a], s[c])) for a, c in itertools.combinations(sorted(x), 2) if cosine(s[a], s[c]) >= 0.3}
    assert got.keys() == want.keys() and len(want) > 100
    assert all(got[k] == pytest.approx(v, abs=1e-9) for k, v in want.items())


@pytest.mark.parametrize("query", [evidence.q17_similar_test_pairs, evaluation.q75_entropy_similarity])
def test_no_shuffle_grows_with_the_pairs(spark, tmp_path, query):
    rows = [(f"s{k}", s[0], s[1]) for k, s in enumerate(spectra(random.Random(1), 20))]
    spark.createDataFrame(rows, "spectrum_id string, ms2_mzs array<double>, ms2_normalized_intensities array<double>").withColumn("precursor_mz", F.lit(1.0)).write.parquet(f"{tmp_path}/test.parquet")
    df = query(spark, str(tmp_path))
    assert "hashpartitioning" not in df._jdf.queryExecution().executedPlan().toString()
    assert df.count() > 10


def test_products_in_portions(monkeypatch):
    r = np.random.default_rng(3)
    a, b = r.integers(0, 9, 50), np.sort(r.integers(0, 9, 80))
    monkeypatch.setattr(blocks, "AT_ONCE", 30)
    got = [(i, j) for x, y in blocks._products(a, a, a, b) for i, j in zip(x.tolist(), y.tolist(), strict=True)]
    assert sorted(got) == [(i, j) for i in range(50) for j in range(80) if a[i] == b[j]]


def test_best_within_a_window_and_part(spark):
    r = random.Random(8)
    side = lambda n, x: [(f"{x}{k:03}", r.choice(["pos", "neg", None]), r.choice([100.0, 119.5, 120.0, 140.0, 0.0, float("nan"), None]), *s) for k, s in enumerate(spectra(r, n))]
    q, t = side(40, "q"), side(70, "t")
    left, right = (blocks.blocks(spark.createDataFrame(x, KIND), "id", "mz", "i", at=F.col("p"), part=F.col("mode"), slot=10.0, most=7) for x in (q, t))
    found = defaultdict(list)
    for x in blocks.similar(left, right, "q", "r", 0.3, width=20.0, best=3).collect():
        found[x.q].append((-round(x.cosine, 6), x.r))
    ok = lambda x: x[1] is not None and x[2] is not None and 0 < x[2] < math.inf
    for a in q:
        near = [b for b in t if ok(a) and ok(b) and a[1] == b[1] and abs(a[2] - b[2]) <= 20.0]
        c = sorted((-round(cosine(sums(*a[3:]), sums(*b[3:])), 6), b[0]) for b in near if cosine(sums(*a[3:]), sums(*b[3:])) >= 0.3)
        assert sorted(found[a[0]])[:3] == c[:3]


def by_pairs(spark, d):
    """The tiers of q20 from a join of single pairs."""
    mass = lambda t, i, x, p: domain.table(spark, d, t).where("precursor_mz > 0").dropDuplicates([i]).select(F.col(i).alias(x), F.col("precursor_mz").alias(p))
    near = mass("test", "spectrum_id", "query_id", "qp").join(mass("train", "row_offset", "r_id", "rp"), F.abs(F.col("qp") - F.col("rp")) <= 0.0101).select("query_id", "r_id")
    return {tuple(x) for x in evidence._tiers(spark, d, near).where("tier <> 'T4'").collect()}


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="no test tables")
def test_tiers_in_blocks(spark):
    d = "/root/testdata/sf0.01"
    df = evidence.q20_identity_tiers(spark, d)
    assert "hashpartitioning" not in df._jdf.queryExecution().executedPlan().toString()
    got = [tuple(x) for x in df.collect()]
    assert len(got) == len(set(got)) and set(got) == by_pairs(spark, d) and {x[2] for x in got} >= {"T1", "T3"}


def test_analogues_shuffle_no_pairs(spark):
    d = os.environ.get("MASSQUARRY_TEST_DATA", "/root/testdata/sf0.001")
    plan = analysis.q52_analog_topk(spark, d)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning") == 1  # the rank per query
