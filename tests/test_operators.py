import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from massquarry.functions import adducts, kernels
from massquarry.operators import molecules, quality, ranking, references, retrieval, spectra, statistics, universe


def test_window_join_against_nested_loop(spark):
    r = random.Random(1)
    lib = [(f"k{i}", r.choice([300.0, 300.001, 450.0, r.uniform(100, 900)])) for i in range(400)] + [("n", None), ("z", 0.0), ("x", float("nan"))]
    qs = [(i, r.choice([300.0, r.uniform(100, 900)]), r.choice([2.0, 40.0])) for i in range(100)] + [(900, None, 5.0), (901, float("nan"), 5.0), (902, 500.0, None)]
    L, Q = spark.createDataFrame(lib, "key string, mass double"), spark.createDataFrame(qs, "q long, m double, tol double")
    ok = lambda x: x is not None and x == x and x > 0
    for kw, f in (({"ppm": 30.0}, lambda m, t: m * 30.0 * 1e-6), ({"da": 0.5}, lambda m, t: 0.5), ({"ppm_col": "tol", "max_ppm": 40.0}, lambda m, t: m * t * 1e-6 if t else None)):
        got = {(x.q, x.key) for x in retrieval.window_join(Q, L, "m", "mass", **kw).collect()}
        want = {(q, k) for (q, m, t), (k, x) in itertools.product(qs, lib) if ok(m) and ok(x) and f(m, t) is not None and m - f(m, t) <= x <= m + f(m, t)}
        assert got == want
    with pytest.raises(ValueError):
        retrieval.window_join(Q, L, "m", "mass", ppm=1.0, da=1.0)


def test_adduct_round_trip(spark):
    names = ["[M+H]+", "[M-H]-", "[2M+Na]+", "[M+2H]2+", "[M+CH2O2-H]-", "[M-2H2O+H]+", "[M+Xx]+", "garbage", None, ""]
    df = spark.createDataFrame([(n, 321.5) for n in names], "a string, m double").withColumn("p", adducts.parse_adduct(F.col("a")))
    for r in df.withColumn("back", adducts.neutral_mass(adducts.precursor_mz(F.col("m"), F.col("p")), F.col("p"))).collect():
        if r.a in ("[M+Xx]+", "garbage", None, ""):
            assert not r.p.supported and r.back is None
        else:
            assert r.p.supported and r.back == pytest.approx(321.5)


def test_expected_metrics_by_enumeration(spark):
    rows = [("q", f"c{i}", s, i == 3) for i, s in enumerate([0.9, 0.5, 0.5, 0.5, 0.1])] + [("w", "c", None, True), ("w", "d", 0.2, False)]
    df = spark.createDataFrame(rows, "query_id string, c string, s double, is_true_candidate boolean")
    q = spark.createDataFrame([("q",), ("w",), ("none",)], "query_id string")
    got = {r.query_id: r for r in ranking.expected_tie_metrics(df, "s", q).collect()}
    assert got["q"].rr == pytest.approx((1 / 2 + 1 / 3 + 1 / 4) / 3) and got["q"].hit_at_5 == 1.0
    assert got["w"].rr == pytest.approx(0.5) and got["none"].rr == 0.0 and got["none"].n_candidates == 0


def test_walk_against_a_loop(spark):
    r, rows = random.Random(2), []
    for p in range(25):
        for k in range(r.randrange(1, 40)):
            rows.append((p, "a", "m", 1.0, "eV", "i", r.choice("st"), k, r.choice(["a", None]), "m", r.choice([1.0, 2.0, None]), "eV", r.choice("ij"), r.choice("st"), r.choice(["T1", "T2", "T3", "T4", "T5"])))
    cols = "pair long, q_adduct string, q_mode string, q_ce double, q_ce_unit string, q_instrument string, q_source string, r_id long, r_adduct string, r_mode string, r_ce double, r_ce_unit string, r_instrument string, r_source string, tier string"
    got = {(x.pair, x.r_id): x for x in references.walk(spark.createDataFrame(rows, cols), ["pair"]).collect()}
    names = ("standard", "cross_library", "mirror_aware", "near_dup_strict")
    for p, mine in itertools.groupby(sorted(rows, key=lambda x: (x[0], x[1] != x[8], x[10] is None, abs(x[3] - x[10]) if x[10] is not None else math.inf, x[5] != x[12], x[7])), key=lambda x: x[0]):
        n = dict.fromkeys(names, 0)
        for x in mine:
            other, t = x[6] != x[13], x[14]
            ok = {"standard": True, "cross_library": other, "mirror_aware": other and t not in ("T1", "T2"), "near_dup_strict": other and t not in ("T1", "T2", "T3")}
            walked = not all(v >= 5 for v in n.values())
            g = got[p, x[7]]
            assert g.walked == walked
            for k in names:
                assert g[f"accepted_{k}"] == (walked and ok[k] and n[k] < 5)
                n[k] += walked and ok[k]


def flat(spectra):
    return kernels.Peaks(np.repeat(np.arange(len(spectra)), [len(m) for m, _ in spectra]), np.concatenate([np.array(m, float) for m, _ in spectra]), np.concatenate([np.array(i, float) for _, i in spectra]), len(spectra))


def by_definition(a, b, pa, pb, tol=0.02):
    """The scores of one pair, peak by peak."""
    def ordered(x, y):
        x, y, n = sorted(x), sorted(y), 0
        while x and y:
            if abs(x[0] - y[0]) <= tol:
                n, x, y = n + 1, x[1:], y[1:]
            elif x[0] < y[0]:
                x = x[1:]
            else:
                y = y[1:]
        return n

    def greedy():
        all_ = sorted((-u * v, i, j) for i, (m, u) in enumerate(zip(*a, strict=True)) for j, (n, v) in enumerate(zip(*b, strict=True)) if abs(m - n) <= tol or abs(m - n - (pa - pb)) <= tol)
        ua, ub, s, n = set(), set(), 0.0, 0
        for x, i, j in all_:
            if i not in ua and j not in ub:
                ua.add(i)
                ub.add(j)
                s, n = s - x, n + 1
        return s, n

    def bins(m, v, p):
        out = {}
        for x, y in zip(m, v, strict=True):
            if x < p:
                out[math.floor((p - x) / 0.1)] = out.get(math.floor((p - x) / 0.1), 0) + y
        return out

    length = lambda v: math.sqrt(sum(x * x for x in v))
    la, lb = bins(*a, pa), bins(*b, pb)
    ln = length(la.values()) * length(lb.values())
    xa, xb = [pa - m for m in a[0] if m < pa], [pb - m for m in b[0] if m < pb]
    s, n = greedy() if a[0] and b[0] else (0.0, 0)
    norm = length(a[1]) * length(b[1])
    return (ordered(a[0], b[0]) / max(1, len(a[0])), s / norm if norm else 0.0, ordered(xa, xb) / max(1, len(xa)), sum(v * lb.get(k, 0) for k, v in la.items()) / ln if ln else 0.0, n if norm else 0)


def test_kernels_against_the_definitions():
    r, A, B, pa, pb = np.random.default_rng(0), [], [], [], []
    for k in range(200):
        n, m = int(r.integers(0, 14)), int(r.integers(0, 14))
        A.append((np.sort(r.uniform(50, 51.5, n)).tolist(), r.choice([1.0, 2.0, 3.0, 0.5], n).tolist()))
        B.append((np.sort(r.uniform(50, 51.5, m)).tolist(), r.uniform(0, 3, m).tolist()))
        pa.append(float(r.choice([51.0, 60.0])))
        pb.append(float(r.choice([50.7, 60.3])))
    got = kernels.pair_scores(flat(A), flat(B), np.array(pa), np.array(pb))
    for k in range(200):
        want = by_definition(A[k], B[k], pa[k], pb[k])
        assert [float(v[k]) for v in got.values()] == pytest.approx(list(want), abs=1e-9), k
    one = kernels.pair_scores(flat([([100.0], [1.0])]), flat([([100.04], [1.0])]), np.array([300.09]), np.array([300.09]))
    assert one["loss_cosine"][0] == pytest.approx(1.0) and one["peak_overlap"][0] == 0.0
    lost = kernels.pair_scores(flat([([100.0], [1.0])]), flat([([100.0], [1.0])]), np.array([np.nan]), np.array([300.0]))
    assert lost["loss_cosine"][0] == lost["loss_overlap"][0] == 0.0 and lost["modified_cosine"][0] == pytest.approx(1.0)


def test_mirrors():
    m, i = [100.0, 150.0, 200.0, 250.0], [1.0, 2.0, 3.0, 4.0]
    cases = [
        ((m, i), ([x + 0.001 for x in m], i), True), ((m, i), ([x + 0.01 for x in m], i), False), (([100.0], [1.0]), ([100.0], [1.0]), False),
        ((m, [1.0] * 4), (m, [1.0] * 4), False), ((m, i), (m[:3], i[:3]), False), (([*m, 300.0], [*i, 0.03]), (m, i), True), ((m, i), (m, i[::-1]), False), (([], []), (m, i), False),
    ]
    assert kernels.mirrors(flat([c[0] for c in cases]), flat([c[1] for c in cases])).tolist() == [c[2] for c in cases]


def test_peaks_edge_rows(spark):
    rows = [(1, [3.0, 1.0, 1.0, 2.0], [1.0, 5.0, 5.0, float("nan")]), (2, [], []), (3, None, None), (4, [1.0], [1.0, 2.0]), (5, [1.0, None, -1.0, float("inf")], [0.0, 1.0, 1.0, 1.0]), (6, [float(k) for k in range(3000)], [1.0] * 3000)]
    df = spark.createDataFrame(rows, "id long, mz array<double>, i array<double>").withColumn("p", spectra.peaks(F.col("mz"), F.col("i")))
    got = {r.id: r for r in df.select("id", "p", spectra.top_peaks(F.col("p"), 2).alias("top"), spectra.merge_close(F.col("p")).alias("m"), spectra.scaled(F.col("p"), "max").alias("s"), *(c.alias(k) for k, c in spectra.features(F.col("p"), F.lit(2.5)).items())).collect()}
    assert [tuple(x) for x in got[1].p] == [(1.0, 5.0), (1.0, 5.0), (3.0, 1.0)] and [tuple(x) for x in got[1].m] == [(1.0, 10.0), (3.0, 1.0)]
    assert got[2].n_peaks == 0 and got[2].mz_min is None and got[3].p is None and got[4].p is None
    assert [tuple(x) for x in got[5].p] == [(1.0, 0.0)] and [tuple(x) for x in got[5].s] == [(1.0, 0.0)]
    assert [x.mz for x in got[6].top] == [0.0, 1.0] and got[6].n_fragments_above_precursor == 2997


def test_absent_candidates(spark):
    rows = [("m", "s1", "A", 2.0, 1, 0.7, 1.0), ("m", "s1", "B", 1.0, 2, 0.3, 2.0), ("m", "s2", "A", 1.0, 2, 0.4, 3.0), ("m", "s2", "C", 3.0, 1, 0.6, 1.0)]
    df = spark.createDataFrame(rows, "molecule_id string, spectrum_id string, candidate string, score double, rank int, prob double, abs_mass_error_ppm double")
    agg = lambda n: {r.candidate: r.agg_score for r in molecules.aggregate(df, n).collect()}
    assert agg("A3_mean_prob") == pytest.approx({"A": 0.55, "B": 0.15, "C": 0.3})
    assert agg("A4_sum_log_prob")["B"] == pytest.approx(math.log(0.3) + math.log(1e-6))
    assert agg("A5_logmeanexp_present")["B"] == pytest.approx(math.log(0.3)) and agg("A6_rrf")["A"] == pytest.approx(1 / 61 + 1 / 62)
    assert set(agg("A7_most_confident_spectrum")) == {"A", "B"} and set(agg("A8_first_spectrum")) == {"A", "B"} and agg("A1_max_score")["C"] == 3.0


def test_temperature_recovers(spark):
    r, rows = np.random.default_rng(0), []
    for q in range(400):
        z = r.normal(size=6)
        p = np.exp(z / 0.5) / np.exp(z / 0.5).sum()
        t = r.choice(6, p=p)
        rows += [(q, float(z[k]), bool(k == t)) for k in range(6)]
    t = ranking.fit_temperature(spark.createDataFrame(rows, "q long, s double, t boolean"), "s", "q", "t")
    assert 0.35 < t < 0.7


def test_folds_bootstrap_and_shift(spark):
    rows = [(f"g{k % 50}" if k % 4 else "hot", float(k % 17)) for k in range(4000)]
    df = spark.createDataFrame(rows, "g string, v double")
    f = statistics.balanced_folds(df, "g", 5)
    n = {r["fold"]: r["n"] for r in f.groupBy("fold").agg(F.sum("n").alias("n")).collect()}
    assert sum(n.values()) == 4000 and f.count() == df.select("g").distinct().count()
    b = statistics.interval(statistics.cluster_bootstrap(df, "v", "g", 50, "s")).first()
    assert b.low < sum(v for _, v in rows) / 4000 + 0.5 and b.low <= b.mean <= b.high
    s = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("b", 2.0), ("b", 3.0), ("a", None), ("b", float("nan"))], "g string, v double")
    r = statistics.numeric_shift(s, "g", "v", ("a", "b")).first()
    assert (r.n_a, r.n_b) == (2, 2) and r.ks == pytest.approx(0.5) and r.wasserstein == pytest.approx(1.0)


def test_set_similarity_and_bits(spark):
    r = random.Random(4)
    sets = {k: set(r.sample(range(40), r.randrange(3, 12))) for k in range(60)} | {100: {1, 2, 3, 4, 5, 6, 7, 8, 9, 10}, 101: {1, 2, 3, 4, 5, 6, 7, 8, 9}}
    df = spark.createDataFrame([(k, sorted(v)) for k, v in sets.items()], "k long, s array<int>")
    got = {(x.a, x.b) for x in universe.set_similarity(df, "k", F.col("s"), 0.6).collect()}
    assert got == {(a, b) for a, b in itertools.combinations(sorted(sets), 2) if len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= 0.6}
    x = spark.createDataFrame([(["a", "b"], ["a", "b"], ["c"], [])], "p array<string>, q array<string>, r array<string>, e array<string>").select(*(universe.packed_bits(F.col(c), 256).alias(c) for c in "pqre"))
    v = x.select(universe.tanimoto(F.col("p"), F.col("q")).alias("same"), universe.tanimoto(F.col("p"), F.col("r")).alias("other"), universe.tanimoto(F.col("e"), F.col("e")).alias("none")).first()
    assert v.same == 1.0 and v.other < 1.0 and v.none is None


@pytest.mark.parametrize("least", [0.3, 0.75, 0.9, 1.0])
def test_set_similarity_of_sets_that_share_frequent_items(spark, least):
    r = random.Random(9)
    sets = {}
    for k in range(0, 90, 3):
        s = set(r.sample(range(60), r.randrange(1, 45)))
        sets |= {k: s, k + 1: s ^ set(r.sample(range(60), r.randrange(3))) or {1}, k + 2: set(s)}
    df = spark.createDataFrame([(k, [f"i{x}" for x in v]) for k, v in sets.items()], "k long, s array<string>")
    got = {(x.a, x.b): x.similarity for x in universe.set_similarity(df, "k", F.col("s"), least).collect()}
    want = {(a, b): len(sets[a] & sets[b]) / len(sets[a] | sets[b]) for a, b in itertools.combinations(sorted(sets), 2)}
    assert got == {p: pytest.approx(v) for p, v in want.items() if v >= least}


def test_sets_meet_by_parts_not_by_items(spark):
    """Sets of few frequent items, none alike: nearly no pair of them is compared."""
    r = random.Random(2)
    df = spark.createDataFrame([(k, sorted(r.sample(range(80), 40))) for k in range(600)], "k long, s array<int>")
    assert universe.set_pairs(universe.distinct_sets(df, "k", F.col("s")), 0.9).count() < 1_000


def test_contracts(spark):
    a = spark.createDataFrame([(1, 1.0), (2, float("nan")), (3, None)], "k long, v double")
    b = spark.createDataFrame([(1, 1.0 + 1e-12), (2, float("nan")), (4, 1.0)], "k long, v double")
    p = quality.parity(a, b, ["k"], ["v"]).first()
    assert (p.only_a, p.only_b, p.both, p.differs_v) == (1, 1, 2, 0)
    assert quality.checked_join(a, b.withColumnRenamed("v", "w"), ["k"]).count() == 3
    with pytest.raises(Exception, match="not unique"):
        quality.checked_join(a, b.unionByName(b).withColumnRenamed("v", "w"), ["k"]).collect()
    with pytest.raises(ValueError):
        quality.forbid_columns(a, patterns=("^v$",))
    g = quality.evaluate_gates([{"id": 1, "results_key": "x", "condition": ">= 0.5"}, {"id": 2, "results_key": "y", "condition": "exists"}, {"id": 3, "results_key": "x", "condition": "== 1"}], {"x": 0.7})
    assert [x["status"] for x in g] == ["PASS", "NOT_PROVEN", "FAIL"] and quality.overall(g) == "FAIL"
    assert [c.passed for c in quality.run_checks(a, {"key": F.col("k") > 0, "value": F.col("v").isNotNull()})] == [True, False]
