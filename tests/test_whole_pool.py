"""Pair features of the whole pool against brute force."""

import math
from collections import defaultdict

import pytest

from massquarry.plans import evidence


@pytest.fixture
def tables(spark, tmp_path):
    """Two queries with pools of nine and two candidates; references also beyond the fifth rank, more than five for one."""
    name = lambda k: "ABCDEFGHIJ"[k] * 14
    pool = [("q1", name(k), 1.0 - k / 10, float(k)) for k in range(9)] + [("q2", name(8), 0.2, 1.0), ("q2", name(9), 0.1, 2.0)]
    refs = [(100 * k + n, name(k), [50.0, 60.05 + n, 70.0 + k, 80.05, 90.05], [1.0, 0.5 + n / 10, 0.7, 0.2 + k / 20, 0.4]) for k, count in ((0, 1), (5, 1), (6, 2), (8, 7)) for n in range(count)]
    spectra = [("q1", [50.0, 60.05, 75.0, 80.05, 95.05], [0.9, 0.6, 0.3, 0.5, 0.1]), ("q2", [50.0, 62.05, 78.0, 80.05, 90.05], [0.2, 0.8, 0.5, 0.5, 0.3])]
    p = spark.createDataFrame([(*x, False) for x in pool], "query_id string, candidate_connectivity_key string, score double, abs_mass_error_ppm double, is_true_candidate boolean")
    p.write.parquet(f"{tmp_path}/candidate_pool.parquet")
    common = "adduct string, ionization_mode string, instrument_type string, {} string, collision_energy_ev array<double>, precursor_mz double, ms2_mzs array<double>, ms2_normalized_intensities array<double>"
    rest = ("[M+H]+", "positive", "Orbitrap", "a", [20.0], 200.0)
    spark.createDataFrame([(i, k, *rest, m, v) for i, k, m, v in refs], "row_offset long, inchikey14 string, " + common.format("ingest_lib")).write.parquet(f"{tmp_path}/train.parquet")
    spark.createDataFrame([(i, *rest, m, v) for i, m, v in spectra], "spectrum_id string, " + common.format("eval_set")).write.parquet(f"{tmp_path}/test.parquet")
    return str(tmp_path), pool, refs, {i: (m, v) for i, m, v in spectra}


def cosine(a, b):
    def bins(m, v):
        out = defaultdict(float)
        for x, y in zip(m, v, strict=True):
            out[math.floor(x / 0.1)] += y
        return out

    a, b = bins(*a), bins(*b)
    return sum(a[k] * b[k] for k in a if k in b) / math.sqrt(sum(x * x for x in a.values()) * sum(x * x for x in b.values()))


def test_every_candidate_has_its_references(spark, tables):
    d, pool, refs, queries = tables
    got = {(x.query_id, x.candidate): x for x in evidence.q24_pair_features_top3(spark, d).collect()}
    assert set(got) == {(q, c) for q, c, *_ in pool}
    want = {(q, c): [(i, cosine(queries[q], (m, v))) for i, k, m, v in sorted(refs) if k == c][:5] for q, c, *_ in pool}
    for pair, s in want.items():
        x, top = got[pair], sorted((c for _, c in s), reverse=True)[:3]
        assert (x.n_reference_spectra, x.has_reference_spectrum) == (len(s), bool(s))
        assert x.cosine_max == (pytest.approx(top[0], abs=2e-6) if top else None)
        assert x.cosine_top3_mean == (pytest.approx(sum(top) / len(top), abs=2e-6) if top else None)
    rows = {(x.query_id, x.candidate, x.r_id): x.cosine for x in evidence.q19_pair_similarities(spark, d).collect()}
    assert rows == {(*pair, i): pytest.approx(c, abs=2e-6) for pair, s in want.items() for i, c in s}
