import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from massquarry.llm import knn, overlap
from massquarry.llm.vectors import as_binary, binned, from_binary, strongest

BAD = [
    (901, None, None, 300.0), (902, [], [], 300.0), (903, [1.0, 2.0], [1.0], 300.0), (904, [1.0, None, float("nan"), float("inf"), -3.0, 0.0], [1.0] * 6, 300.0),
    (905, [100.0, 200.0, 300.0, 400.0], [1.0] * 4, 300.0), (None, [100.0, 200.0, 300.0, 400.0, 500.0], [1.0] * 5, 300.0),
]


def spectra(n_clusters=60, seed=3, copies=40):
    """Clusters of noisy spectra, one cluster much larger, exact copies on another scale, and unusable rows."""
    r, rows = np.random.default_rng(seed), []
    for c in range(n_clusters):
        mz, it, pm = np.sort(r.uniform(50, 700, 24)), r.exponential(1, 24), float(r.uniform(200, 800))
        for _ in range(copies if c == 0 else int(r.integers(1, 6))):
            keep = r.random(24) > 0.05
            rows.append((len(rows), mz[keep].tolist(), (it[keep] * r.lognormal(0, 0.15, keep.sum()) * r.choice([1.0, 1000.0])).tolist(), pm + float(r.normal(0, 0.003))))
    for k in range(5):
        rows.append((len(rows), rows[k][1][::-1], [x * 7 for x in rows[k][2][::-1]], rows[k][3]))
    return rows


def sparse(rows, width=0.1):
    out = {}
    for i, m, w, p in rows:
        if i is None or m is None or w is None or len(m) != len(w):
            continue
        ok = [(a, b) for a, b in zip(m, w, strict=True) if a is not None and b is not None and np.isfinite(a) and np.isfinite(b) and a > 0 and b > 0]
        if len(ok) < 5:
            continue
        v = {}
        for a, b in ok:
            k = int(np.floor(a / width))
            v[k] = v.get(k, 0) + b
        n = np.sqrt(sum(x * x for x in v.values()))
        out[i] = ({k: x / n for k, x in v.items()}, p)
    return out


def cos(a, b):
    return round(sum(x * b.get(k, 0) for k, x in a.items()), 6)


def test_binned_matches_plain(spark):
    rows = spectra(8) + BAD
    got, off, b, w = binned(pa.array([r[1] for r in rows], pa.list_(pa.float64())), pa.array([r[2] for r in rows], pa.list_(pa.float64())))
    want = sparse([(k, *r[1:]) for k, r in enumerate(rows)])
    assert sorted(got.tolist()) == sorted(want)
    for j, k in enumerate(got.tolist()):
        assert dict(zip(b[off[j] : off[j + 1]].tolist(), w[off[j] : off[j + 1]].tolist(), strict=True)) == pytest.approx(want[k][0])
    o2, b2, w2 = from_binary(as_binary(off, b, w).to_pylist())
    assert (o2 == off).all() and (b2 == b).all() and (w2 == w).all()
    assert (strongest(off, b, w, 3) >= 0).all()


def top(v, i, k, least):
    best = sorted((-cos(v[i][0], v[j][0]), j) for j in v if j != i)[:k]
    return [(j, -s) for s, j in best if -s >= least]


def answers(df):
    got = {}
    for r in df.collect():
        got.setdefault(r.id, []).append((r["rank"], r.neighbour, r.similarity))
    return {i: [x[1:] for x in sorted(v)] for i, v in got.items()}


@pytest.mark.parametrize(("block", "exact"), [(800, False), (10, False), (10, True), (800, True)])
def test_nearest_against_brute_force(spark, block, exact):
    rows = spectra()
    df = spark.createDataFrame(rows + rows[:7] + BAD, "id long, mz array<double>, i array<double>, p double").withColumnRenamed("p", "neighbour")
    got = answers(knn.nearest(df.repartition(5), "id", "mz", "i", block=block, exact=exact))
    v = sparse(rows)
    hits = total = 0
    for i in v:
        want, have = top(v, i, 5, 0.75), got.get(i, [])
        total += len(want)
        hits += len({j for j, _ in want} & {j for j, _ in have})
        assert len(have) <= 5 and all(s >= 0.75 for _, s in have)
        if exact:
            assert have == want
    assert total > 100 and hits / total >= 0.97


def dominated(n, r, strong=1, first=0):
    """Spectra that share `strong` strong peaks and nothing else."""
    out = []
    for k in range(n):
        weak = 100 + 40 * r.random(9) + 60 * np.arange(9)
        mz = [50.05 + 0.5 * x for x in range(strong)] + weak.tolist()
        out.append((first + k, mz, [10.0] * strong + (0.5 + r.random(9)).tolist(), 300.0))
    return out


@pytest.mark.parametrize("strong", [1, 2])
def test_few_strong_shared_peaks_are_enough(spark, strong):
    r = np.random.default_rng(7)
    rows = dominated(20, r, strong)
    v = sparse(rows)
    df = spark.createDataFrame(rows, "id long, mz array<double>, i array<double>, p double")
    pairs = {(i, j) for i in v for j in v if i != j and cos(v[i][0], v[j][0]) >= 0.75}
    assert len(pairs) == 380
    for exact in (False, True):
        got = answers(knn.nearest(df, "id", "mz", "i", k=19, exact=exact))
        assert {(i, j) for i, x in got.items() for j, _ in x} == pairs
    ev = [(f"e{i}", m, [x * (40 if k < strong else 1) for k, x in enumerate(w)], p) for i, m, w, p in rows[:10]]
    tr = [(i, m, [x * (40 if k < strong else 1) for k, x in enumerate(w)], p) for i, m, w, p in rows[10:]]
    e, t = spark.createDataFrame(ev, "sid string, mz array<double>, i array<double>, p double"), spark.createDataFrame(tr, "id long, mz array<double>, i array<double>, p double")
    assert overlap.near_same(e, t, "sid", "id", "mz", "i", "p").count() == 100


def test_copies_are_searched_once_and_answered_for_all(spark):
    r = np.random.default_rng(8)
    one, other = dominated(1, r, 2)[0], dominated(1, r, 2)[0]
    rows = [(i, *one[1:]) for i in range(0, 60, 2)] + [(101, *other[1:]), (3, *other[1:])]
    v = sparse(rows)
    df = spark.createDataFrame(rows, "id long, mz array<double>, i array<double>, p double")
    for exact in (False, True):
        got = answers(knn.nearest(df, "id", "mz", "i", exact=exact))
        assert got == {i: top(v, i, 5, 0.75) for i in v}


def test_vectors_without_any_structure_split_by_hash(spark):
    """Vectors at equal angles from each other, that no vantage point parts well, in leaves of few."""
    rows = [(k, [50.05, *(100.05 + 10 * k + x for x in range(5))], [5.0, 1.0, 1.0, 1.0, 1.0, 1.0], 1.0) for k in range(60)]
    v = sparse(rows)
    df = spark.createDataFrame(rows, "id long, mz array<double>, i array<double>, p double")
    got = answers(knn.nearest(df, "id", "mz", "i", block=4))
    assert got == {i: top(v, i, 5, 0.75) for i in v} and len(got) == 60


def test_router_keeps_what_is_near():
    rows = spectra(40, 9)
    _, off, b, w = binned(pa.array([r[1] for r in rows], pa.list_(pa.float64())), pa.array([r[2] for r in rows], pa.list_(pa.float64())))
    router = knn.Router(*knn._rows_of(off, b, w, np.arange(0, len(off) - 1, 2)), 12)
    _, own = router.route(off, b, w)
    assert len(np.unique(own)) > 4
    r, leaf = router.route(off, b, w, np.full(len(own), np.arccos(0.75) + 1e-6))
    reached = set(zip(r.tolist(), leaf.tolist(), strict=True))
    v = sparse(rows)
    for i in range(len(own)):
        assert all((i, own[j]) in reached for j in range(len(own)) if cos(v[i][0], v[j][0]) >= 0.75)
    assert len(reached) < len(own) * len(np.unique(own))


def test_stated_queries_against_all_rows(spark):
    rows = spectra(30)
    df = spark.createDataFrame(rows + rows[:3] + BAD, "id long, mz array<double>, i array<double>, p double")
    v = sparse(rows)
    for block in (20_000, 17):
        got = answers(knn.nearest_of(df, "id", "mz", "i", F.col("id") % 7 == 0, block=block))
        assert got == {i: top(v, i, 5, 1e-9) for i in v if i % 7 == 0}


def test_tree_is_exact_at_factor_one_and_prunes():
    r = np.random.default_rng(0)
    centres = r.normal(size=(20, 30))
    x = np.abs(np.repeat(centres, 60, axis=0) + r.normal(0, 0.2, (1200, 30)))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    sim, pos = knn.Tree(x, leaf=16).search(x, 4, 0.0, 1.0)
    full = np.round(x @ x.T, 6)
    for i in range(0, 1200, 37):
        order = np.lexsort((np.arange(1200), -full[i]))[:4]
        assert pos[i].tolist() == order.tolist() and np.allclose(sim[i], full[i][order])


def test_a_hot_key_leaves_a_batch_once():
    rows = [(k, [50.05, 60.05, 70.05, *(100.05 + 10 * k + x for x in range(5))], [9.0, 8.0, 7.0, 1.0, 1.0, 1.0, 1.0, 1.0]) for k in range(400)]
    _, off, b, w = binned(pa.array([r[1] for r in rows]), pa.array([r[2] for r in rows]))
    batch = pa.RecordBatch.from_arrays([pa.array(np.arange(400)), as_binary(off, b, w)], ["id", "vector"])
    (out,) = knn._key_rows(4, 0.5)([batch])
    by = {}
    for key, i in zip(out.column(0).to_pylist(), out.column(1).to_pylist(), strict=True):
        by.setdefault(key, set()).add(i)
    assert max(len(x) for x in by.values()) == 2 and sum(x == {0} for x in by.values()) >= 1
    assert {min(x) for x in by.values() if len(x) == 2} == {0} and set().union(*(x for x in by.values() if len(x) == 2)) == set(range(400))


def chance(n=40, copies=3):
    """Groups of noisy spectra, each of which shares three strong peaks, and nothing else, with the next group."""
    r, rows = np.random.default_rng(12), []
    for g in range(n):
        mz = np.concatenate([50.05 + 3 * g + np.arange(6), 300.05 + 16 * g + np.arange(16)])
        for _ in range(copies):
            it = np.concatenate([3 + 0.1 * r.random(6), 2.8 * np.ones(1), 2 + 0.3 * r.random(15)])
            rows.append((len(rows), mz.tolist(), it.tolist(), 300.0))
    return rows


def shards_of(spark, rows):
    _, off, b, w = binned(pa.array([x[1] for x in rows]), pa.array([x[2] for x in rows]))
    df = spark.createDataFrame(list(zip(range(len(rows)), as_binary(off, b, w).to_pylist(), strict=True)), "id long, vector binary")
    got = {}
    for x in knn._by_links(df.unionByName(df.limit(5)).repartition(3), 7, 0.5, 0.75).collect():
        got.setdefault(x.shard, set()).add(x.id)
    return sorted(map(sorted, got.values()))


def test_links_by_chance_do_not_chain_shards(spark):
    rows = chance()
    v = sparse(rows)
    assert 0.1 < cos(v[0][0], v[3][0]) < 0.5 <= 0.75 < cos(v[0][0], v[1][0])
    assert shards_of(spark, rows) == [[3 * g, 3 * g + 1, 3 * g + 2] for g in range(40)]
    df = spark.createDataFrame(rows, "id long, mz array<double>, i array<double>, p double")
    assert answers(knn.nearest(df, "id", "mz", "i")) == {i: top(v, i, 5, 0.75) for i in v}


def test_similar_vectors_with_a_single_common_key_stay_together(spark):
    """Two whose strongest bins have three in common only, but whose other bins agree; and many that share one key."""
    mz = (100.05 + np.arange(30)).tolist()
    pair = [(k, mz, [1.2] * 3 + [1.1 if 3 + 4 * k <= x < 7 + 4 * k else 1.0 for x in range(3, 30)], 1.0) for k in range(2)]
    assert shards_of(spark, pair) == [[0, 1]]
    hot = [(k, [50.05, 51.05, 52.05, *(100.05 + 10 * k + x for x in range(20))], [1.1] * 3 + [1.0] * 20, 1.0) for k in range(knn.HOT + 4)]
    assert shards_of(spark, hot) == [list(range(knn.HOT + 4))]


def test_small_groups_at_once_against_brute_force():
    rows = spectra(30, 6, 12)
    _, off, b, w = binned(pa.array([x[1] for x in rows]), pa.array([x[2] for x in rows]))
    size = np.array([1, 2, 12, 7, len(rows) - 22])
    group = np.repeat(np.arange(5), size)
    vectors = as_binary(off, b, w)
    struct = pa.StructArray.from_arrays([pa.array(group), pa.array(np.zeros(len(rows), np.int64)), pa.array(np.zeros(len(rows), np.int32))], ["shard", "leaf", "part"])
    batch = pa.RecordBatch.from_arrays([struct, pa.array(np.arange(len(rows))), vectors], ["group", "id", "vector"])
    v, want = sparse(rows), []
    for i in range(len(rows)):
        mine = {j: v[j] for j in np.flatnonzero(group == group[i]).tolist()}
        want += [(int(group[i]), i, j, s) for j, s in top(mine, i, 3, 0.3)]
    assert len(want) > 20
    for step in (5, 1_000):
        for small, portion in ((64, 4_000_000), (64, 50), (3, 1_000)):
            out = list(knn._own_leaf(3, 0.3, 1.0, small, portion)(batch.slice(s, step) for s in range(0, len(rows), step)))
            have = sorted(tuple(x.values()) for o in out for x in o.to_pylist())
            assert [x[:3] for x in have] == [x[:3] for x in sorted(want)]
            assert [x[3] for x in have] == pytest.approx([x[3] for x in sorted(want)], abs=2e-6)


def test_empty_tables(spark):
    e = spark.createDataFrame([], "id long, mz array<double>, i array<double>, p double")
    assert knn.nearest(e, "id", "mz", "i").count() == 0
    t = spark.createDataFrame([], "sid string, mz array<double>, i array<double>, p double")
    assert overlap.near_same(t, e, "sid", "id", "mz", "i", "p").count() == 0


@pytest.mark.parametrize("shard", [20_000, 9])
def test_overlap_against_brute_force(spark, shard):
    rows = spectra(80, 5)
    r = random.Random(4)
    ev = [(f"e{k}", m, w, p) for k, (_, m, w, p) in enumerate(rows) if r.random() < 0.4]
    bad = [(None if i is None else f"x{i}", m, w, p) for i, m, w, p in BAD] + [("z", rows[0][1], rows[0][2], None), ("y", rows[0][1], rows[0][2], float("nan"))]
    e = spark.createDataFrame(ev + ev[:4] + bad, "sid string, mz array<double>, i array<double>, p double")
    t = spark.createDataFrame(rows + rows[:9] + BAD, "id long, mz array<double>, i array<double>, p double")
    got = {(x.eval_id, int(x.train_id)) for x in overlap.near_same(e, t, "sid", "id", "mz", "i", "p", shard=shard).collect()}
    a, b = sparse(ev), sparse(rows)
    want = {(i, j) for i in a for j in b if abs(a[i][1] - b[j][1]) < 0.01 and cos(a[i][0], b[j][0]) > 0.95}
    assert len(want) > 30 and got == want


def test_index_finds_every_occurrence():
    r = np.random.default_rng(6)
    texts = [r.integers(0, 6, r.integers(1, 12)) for _ in range(30)]
    queries = [r.integers(0, 7, r.integers(1, 10)) for _ in range(20)]
    flat = lambda x: (np.append(0, np.cumsum([len(t) for t in x])), np.concatenate(x))
    index = overlap.FMIndex(*flat(texts))
    off, sym = flat(queries)
    ends = np.arange(len(sym))
    start, length, lo, hi = index.matches(off, sym, ends)
    match, text = index.locate(lo, hi)
    got = sorted(zip(ends[start][match].tolist(), length[match].tolist(), text.tolist(), strict=True))
    want = []
    for a, q in enumerate(queries):
        for e in range(len(q)):
            for n in range(1, e + 2):
                piece = q[e + 1 - n : e + 1].tolist()
                want += [(int(off[a]) + e, n, t) for t, x in enumerate(texts) for s in range(len(x) - n + 1) if x[s : s + n].tolist() == piece]
    assert got == sorted(want)


def test_matches_merge_into_spans():
    q, t, pair, first, last = overlap.merged(np.array([0, 0, 0, 0, 1]), np.array([2, 2, 2, 1, 0]), np.array([4, 5, 9, 3, 7]), np.array([3, 2, 1, 1, 2]), 3)
    got = sorted(zip(q[pair].tolist(), t[pair].tolist(), first.tolist(), last.tolist(), strict=True))
    assert got == [(0, 1, 3, 3), (0, 2, 2, 5), (0, 2, 9, 9), (1, 0, 6, 7)]
