"""Queries: spectra, references, molecules."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from massquarry.functions import structures
from massquarry.functions.kernels import pair_kernel
from massquarry.operators import blocks, molecules, references, spectra
from massquarry.plans import domain as D
from massquarry.workspace import stage

R = lambda c, n=6: F.round(c, n).alias(c)
PAIR = ["query_id", "candidate"]


def q13_spectrum_flags(spark: SparkSession, d: str) -> DataFrame:
    t = D.table(spark, d, "train").select("row_offset", "ms2_mzs", "ms2_normalized_intensities", "precursor_mz").dropDuplicates(["row_offset"])
    f = spectra.flags(F.col("ms2_mzs"), F.col("ms2_normalized_intensities"), F.col("precursor_mz"))
    return t.select("row_offset", *(c.alias(k) for k, c in f.items()))


def q14_spectrum_features(spark: SparkSession, d: str) -> DataFrame:
    t = D.test_spectra(spark, d).where(F.size("peaks") > 0)
    f = spectra.features(F.col("peaks"), F.col("precursor_mz"))
    return t.select("spectrum_id", *(F.round(c.cast("double"), 6).alias(k) for k, c in f.items()))


def q15_topn_peaks(spark: SparkSession, d: str) -> DataFrame:
    t = D.test_spectra(spark, d).select("spectrum_id", F.posexplode(spectra.top_peaks(F.col("peaks"), 10)).alias("pos", "p"))
    return t.select("spectrum_id", F.col("pos").cast("int").alias("pos"), F.col("p.mz").alias("mz"), F.col("p.intensity").alias("intensity"))


def _bins(spark: SparkSession, d: str) -> DataFrame:
    return spectra.binned(D.test_spectra(spark, d), ["spectrum_id"], F.col("peaks"))


def q16_bin_l2(spark: SparkSession, d: str) -> DataFrame:
    return _bins(spark, d).select("spectrum_id", "bin", R("value"))


def test_blocks(spark: SparkSession, d: str) -> DataFrame:
    """The binned test spectra in blocks."""
    return blocks.blocks(D.table(spark, d, "test"), "spectrum_id", "ms2_mzs", "ms2_normalized_intensities")


def q17_similar_test_pairs(spark: SparkSession, d: str) -> DataFrame:
    return blocks.similar(test_blocks(spark, d), None, "a", "b", 0.300001).select("a", "b", R("cosine"))


def _references(spark: SparkSession, d: str, named: bool = True) -> DataFrame:
    """Train spectra as references of their structure; with named=False also those that name none."""
    t = D.table(spark, d, "train").dropDuplicates(["row_offset"])
    e = spectra.energies(F.col("collision_energy_ev"))
    return t.select(
        F.col("row_offset").alias("r_id"), structures.inchikey14(F.col("inchikey14")).alias("candidate"), F.col("adduct").alias("r_adduct"), F.col("ionization_mode").alias("r_mode"), structures.instrument(F.col("instrument_type")).alias("r_instrument"),
        F.col("ingest_lib").alias("r_source"), F.round(e["ce_mean"], 3).alias("r_ce"), F.when(e["ce_n"] > 0, "eV").alias("r_ce_unit"), F.col("precursor_mz").alias("r_precursor"), F.col("ms2_mzs").alias("r_mz"), F.col("ms2_normalized_intensities").alias("r_i"),
    ).where(F.col("candidate").isNotNull() if named else F.lit(True))


def _pairs(spark: SparkSession, d: str, tiers: bool = True) -> DataFrame:
    """The whole pool's candidates per query with all references of the candidate, without peaks, and their tiers. Beyond
    a precursor difference of 0.01 the tier is T4, so peaks join only for pairs within it."""
    p = D.pool(spark, d).select("query_id", "candidate")
    q = D.table(spark, d, "test").dropDuplicates(["spectrum_id"])
    e = spectra.energies(F.col("collision_energy_ev"))
    q = q.select(F.col("spectrum_id").alias("query_id"), F.col("precursor_mz").alias("q_precursor"), F.col("adduct").alias("q_adduct"), F.col("ionization_mode").alias("q_mode"), structures.instrument(F.col("instrument_type")).alias("q_instrument"), F.col("eval_set").alias("q_source"), F.round(e["ce_mean"], 3).alias("q_ce"), F.when(e["ce_n"] > 0, "eV").alias("q_ce_unit"))
    r = _references(spark, d).drop("r_mz", "r_i")
    pairs = p.join(q, "query_id").join(r, "candidate")
    if not tiers:
        return pairs.withColumn("tier", F.lit(None).cast("string"))
    near = pairs.where(F.abs(F.col("q_precursor") - F.col("r_precursor")) <= 0.0101).select("query_id", "r_id").distinct()
    return pairs.join(_tiers(spark, d, near), ["query_id", "r_id"], "left").withColumn("tier", F.coalesce("tier", F.lit("T4")))


def _tiers(spark: SparkSession, d: str, near: DataFrame) -> DataFrame:
    """query_id, r_id, tier of the given pairs, over whole cleaned spectra."""
    near = stage(near, "near")
    hashed = lambda t, x: t.withColumn(f"{x}_hash", spectra.peak_hash(F.col(f"{x}_peaks"), F.col(f"{x}_precursor")))
    q = D.test_spectra(spark, d).select(F.col("spectrum_id").alias("query_id"), F.col("precursor_mz").alias("q_precursor"), F.col("peaks").alias("q_peaks"))
    q = hashed(q.join(near.select("query_id").distinct(), "query_id", "left_semi"), "q")
    r = _references(spark, d, named=False).select("r_id", "r_precursor", spectra.peaks(F.col("r_mz"), F.col("r_i")).alias("r_peaks"))
    r = hashed(r.join(near.select("r_id").distinct(), "r_id", "left_semi"), "r")
    qb, rb = spectra.binned(q, ["query_id"], F.col("q_peaks")), spectra.binned(r, ["r_id"], F.col("r_peaks"))
    rows = spectra.cosine_of_pairs(near, qb, rb, "query_id", "r_id").join(q, "query_id").join(r, "r_id")
    return references.identity_tier(rows).select("query_id", "r_id", "tier")


def q21_compat_order_top5(spark: SparkSession, d: str) -> DataFrame:
    return references.first_eligible(_pairs(spark, d), PAIR, "mirror_aware").select(*PAIR, "r_id", "compat_rank")


def q21b_standard_order_top5(spark: SparkSession, d: str) -> DataFrame:
    return references.first_eligible(_pairs(spark, d, tiers=False), PAIR, "standard").select(*PAIR, "r_id", "compat_rank")


def q22_protocol_counts(spark: SparkSession, d: str) -> DataFrame:
    rules = references.protocols()
    return _pairs(spark, d).groupBy(*PAIR).agg(F.count(F.lit(1)).alias("n_refs"), *(F.count_if(c).alias(f"n_{k}") for k, c in rules.items()))


def q23_walk_depth(spark: SparkSession, d: str) -> DataFrame:
    return references.walk_summary(references.walk(_pairs(spark, d), PAIR), PAIR)


def _scored_pairs(spark: SparkSession, d: str) -> DataFrame:
    """The first five references of each pair of the whole pool with all four similarities; peaks join after the cut."""
    sel = stage(references.first_eligible(_pairs(spark, d, tiers=False), PAIR, "standard").select(*PAIR, "r_id", "compat_rank"), "selected")
    r = _references(spark, d).join(sel.select("r_id").distinct(), "r_id", "left_semi").select("r_id", "r_precursor", spectra.peaks(F.col("r_mz"), F.col("r_i")).alias("r_all"))
    q = D.test_spectra(spark, d).select(F.col("spectrum_id").alias("query_id"), F.col("precursor_mz").alias("q_precursor"), F.col("peaks").alias("q_all"))
    q = q.join(sel.select("query_id").distinct(), "query_id", "left_semi")
    top = lambda t, x: t.select(*(c for c in t.columns if not c.endswith("_all")), spectra.top_peaks(F.col(f"{x}_all"), 100).alias(f"{x}_peaks"))
    rows = sel.join(top(r, "r"), "r_id").join(top(q, "q"), "query_id").where(F.col("r_peaks").isNotNull() & F.col("q_peaks").isNotNull())
    s = rows.withColumn("s", pair_kernel("q_peaks", "r_peaks", "q_precursor", "r_precursor")).select(*PAIR, "r_id", "compat_rank", "s.*")
    qb, rb = spectra.binned(q, ["query_id"], F.col("q_all")), spectra.binned(r, ["r_id"], F.col("r_all"))
    return s.join(spectra.cosine_of_pairs(sel, qb, rb, "query_id", "r_id"), ["query_id", "r_id"])


def q19_pair_similarities(spark: SparkSession, d: str) -> DataFrame:
    s = _scored_pairs(spark, d)
    return s.select(*PAIR, "r_id", "compat_rank", *(R(c) for c in ("cosine", "peak_overlap", "modified_cosine", "loss_overlap", "loss_cosine")), "n_matched")


def q18_reference_cosine(spark: SparkSession, d: str) -> DataFrame:
    sel = references.first_eligible(_pairs(spark, d, tiers=False), PAIR, "standard").select("query_id", "r_id")
    qb = spectra.binned(D.test_spectra(spark, d).select(F.col("spectrum_id").alias("query_id"), "peaks"), ["query_id"], F.col("peaks"))
    rb = spectra.binned(_references(spark, d).select("r_id", spectra.peaks(F.col("r_mz"), F.col("r_i")).alias("peaks")), ["r_id"], F.col("peaks"))
    return spectra.cosine_of_pairs(sel, qb, rb, "query_id", "r_id").select("query_id", "r_id", R("cosine"))


def q24_pair_features_top3(spark: SparkSession, d: str) -> DataFrame:
    pool = D.pool(spark, d).select(*PAIR, "abs_mass_error_ppm")
    f = references.pair_features(_scored_pairs(spark, d), pool, PAIR)
    return f.select(*PAIR, R("abs_mass_error_ppm"), "n_reference_spectra", "has_reference_spectrum", *(R(f"{m}_{k}") for m in references.METRICS for k in ("max", "top3_mean")))


def q20_identity_tiers(spark: SparkSession, d: str) -> DataFrame:
    """Test and train spectra with precursors less than 0.01 apart, by identity tier, T1 to T3. Equal hashes have equal
    precursors to three decimals, so no pair of these tiers lies outside."""
    peaks, precursor = spectra.peaks(F.col("ms2_mzs"), F.col("ms2_normalized_intensities")), F.col("precursor_mz")
    sides = (("test", "spectrum_id"), ("train", "row_offset"))
    q, r = (blocks.blocks(D.table(spark, d, t), i, "ms2_mzs", "ms2_normalized_intensities", at=precursor, code=F.unhex(spectra.peak_hash(peaks, precursor)), width=None) for t, i in sides)
    return blocks.tiers(q, r, "spectrum_id", "row_offset")


def _aggregator(name: str):
    def q(spark: SparkSession, d: str) -> DataFrame:
        a = molecules.aggregate(D.molecule_rankings(spark, d), name)
        return a.where("mol_rank <= 25").select("molecule_id", "candidate", F.round("agg_score", 6).alias("agg_score"), "mol_rank")

    return q


def q34_submission(spark: SparkSession, d: str) -> DataFrame:
    a = molecules.aggregate(D.molecule_rankings(spark, d), "A7_most_confident_spectrum")
    s = D.table(spark, d, "molecule_metadata").groupBy(F.col("connectivity_key").alias("candidate")).agg(F.min("normalized_smiles").alias("smiles"))
    return molecules.submission(a, s)


QUERIES = {k: v for k, v in list(globals().items()) if k.startswith("q") and callable(v)}
QUERIES |= {f"q{27 + i}a_{n}" if i == 0 else f"q{27 + i}_{n}": _aggregator(n) for i, n in enumerate(molecules.AGGREGATORS, 1)}

_RANK = f"""WITH {D.POOL}, mm AS (SELECT DISTINCT spectrum_id, molecule_id FROM test WHERE molecule_id IS NOT NULL),
 e AS (SELECT molecule_id, query_id AS spectrum_id, candidate, score, abs_mass_error_ppm, row_number() OVER (PARTITION BY query_id ORDER BY score DESC NULLS LAST, abs_mass_error_ppm NULLS LAST, candidate) AS rank,
  exp(score / 0.25 - max(score / 0.25) OVER (PARTITION BY query_id)) AS e FROM pool JOIN mm ON mm.spectrum_id = pool.query_id WHERE score IS NOT NULL),
 r AS (SELECT *, e / sum(e) OVER (PARTITION BY spectrum_id) AS prob FROM e), ns AS (SELECT molecule_id, count(DISTINCT spectrum_id) AS ns FROM r GROUP BY 1)"""
_AGG = {
    "A1_max_score": ("max(score)", "avg(abs_mass_error_ppm)"), "A2_max_prob": ("max(prob)", "avg(abs_mass_error_ppm)"), "A3_mean_prob": ("sum(prob) / max(ns)", "avg(abs_mass_error_ppm)"),
    "A4_sum_log_prob": ("sum(ln(greatest(prob, 1e-6))) + (max(ns) - count(*)) * ln(1e-6)", "avg(abs_mass_error_ppm)"), "A5_logmeanexp_present": ("ln(greatest(avg(prob), 1e-300))", "avg(abs_mass_error_ppm)"),
    "A6_rrf": ("sum(1.0::DOUBLE / (60 + rank))", "min(rank)"), "A7_most_confident_spectrum": ("max(prob)", "min(abs_mass_error_ppm)"), "A8_first_spectrum": ("max(prob)", "min(abs_mass_error_ppm)"),
}


def _agg_sql(n: str) -> str:
    pick = {
        "A7_most_confident_spectrum": "JOIN (SELECT molecule_id, min(spectrum_id) AS s FROM (SELECT molecule_id, spectrum_id, max(prob) AS p, max(max(prob)) OVER (PARTITION BY molecule_id) AS b FROM r GROUP BY 1, 2) WHERE p = b GROUP BY 1) k ON k.molecule_id = r.molecule_id AND k.s = r.spectrum_id",
        "A8_first_spectrum": "JOIN (SELECT molecule_id, min(spectrum_id) AS s FROM r GROUP BY 1) k ON k.molecule_id = r.molecule_id AND k.s = r.spectrum_id",
    }.get(n, "")
    return f"""{_RANK}, a AS (SELECT r.molecule_id, candidate, {_AGG[n][0]} AS s, {_AGG[n][1]} AS t FROM r JOIN ns ON ns.molecule_id = r.molecule_id {pick} GROUP BY 1, 2)
 SELECT * FROM (SELECT molecule_id, candidate, round(s, 6) AS agg_score, row_number() OVER (PARTITION BY molecule_id ORDER BY round(s, 9) DESC, round(t, 9) NULLS LAST, candidate) AS mol_rank FROM a) WHERE mol_rank <= 25"""


_CLEAN = """(SELECT m, i FROM (SELECT unnest({m}) AS m, unnest({i}) AS i) WHERE isfinite(m) AND isfinite(i) AND m >= 0 AND i >= 0)"""
_TS = """ts AS (SELECT DISTINCT spectrum_id, ms2_mzs AS mz, ms2_normalized_intensities AS it, precursor_mz FROM test),
 pk AS (SELECT spectrum_id, precursor_mz, m, i FROM (SELECT spectrum_id, precursor_mz, unnest(mz) AS m, unnest(it) AS i FROM ts WHERE len(mz) = len(it)) WHERE m IS NOT NULL AND i IS NOT NULL AND isfinite(m) AND isfinite(i) AND m >= 0 AND i >= 0)"""
_BINS = f"""{_TS}, b0 AS (SELECT spectrum_id, floor(m / 0.1)::BIGINT AS bin, sum(i) AS v FROM pk GROUP BY 1, 2), b AS (SELECT spectrum_id, bin, v / sqrt(sum(v * v) OVER (PARTITION BY spectrum_id)) AS value FROM b0 QUALIFY sum(v * v) OVER (PARTITION BY spectrum_id) > 0)"""
_CE = "CASE WHEN len(list_filter(collision_energy_ev, lambda x: x IS NOT NULL AND NOT isnan(x))) > 0 THEN round(list_sum(list_filter(collision_energy_ev, lambda x: x IS NOT NULL AND NOT isnan(x))) / len(list_filter(collision_energy_ev, lambda x: x IS NOT NULL AND NOT isnan(x))), 3) END"
_INST = "upper(regexp_replace(instrument_type, '[^A-Za-z0-9]', '', 'g'))"
_PAIRS = f"""{D.POOL}, p5 AS (SELECT query_id, candidate FROM pool),
 tq AS (SELECT DISTINCT spectrum_id AS query_id, adduct AS qa, ionization_mode AS qm, {_INST} AS qi, eval_set AS qs, {_CE} AS qc FROM test),
 rf AS (SELECT DISTINCT row_offset AS r_id, {D.IK} AS candidate, adduct AS ra, ionization_mode AS rm, {_INST} AS ri, ingest_lib AS rs, {_CE} AS rc FROM train),
 pr AS (SELECT p5.query_id, p5.candidate, r_id, (CASE WHEN qa = ra THEN 0 ELSE 1 END) AS k1, (CASE WHEN qm = rm THEN 0 ELSE 1 END) AS k2, (CASE WHEN qc IS NOT NULL AND rc IS NOT NULL THEN 0 ELSE 1 END) AS k3,
   coalesce(abs(qc - rc), 'inf'::DOUBLE) AS k4, (CASE WHEN qi = ri THEN 0 ELSE 1 END) AS k5 FROM p5 JOIN tq USING (query_id) JOIN rf USING (candidate))"""
_W = "PARTITION BY query_id, candidate ORDER BY k1, k2, k3, k4, k5, r_id"

ORACLE = {
    "q15_topn_peaks": f"WITH {_TS}, t AS (SELECT spectrum_id, m, i, row_number() OVER (PARTITION BY spectrum_id ORDER BY i DESC, m) AS r FROM pk) SELECT spectrum_id, (row_number() OVER (PARTITION BY spectrum_id ORDER BY m, i) - 1)::INT AS pos, m AS mz, i AS intensity FROM t WHERE r <= 10",
    "q13_spectrum_flags": """WITH t AS (SELECT DISTINCT row_offset, coalesce(ms2_mzs, []) AS m, coalesce(ms2_normalized_intensities, []) AS i, precursor_mz AS p FROM train), u AS (SELECT *, list_filter(m, lambda x: x IS NOT NULL AND NOT isnan(x)) AS r, list_filter(i, lambda x: x IS NOT NULL AND NOT isnan(x)) AS s FROM t)
 SELECT row_offset, len(m) = 0 AS empty, len(m) <> len(i) AS length_mismatch, len(list_filter(m, lambda x: x IS NULL OR NOT isfinite(x))) > 0 AS nonfinite_mz, len(list_filter(i, lambda x: x IS NULL OR NOT isfinite(x))) > 0 AS nonfinite_intensity,
  len(list_filter(r, lambda x: x < 0)) > 0 AS negative_mz, len(list_filter(s, lambda x: x < 0)) > 0 AS negative_intensity, len(list_filter(range(1, len(m)), lambda k: NOT coalesce(m[k + 1] >= m[k] AND NOT isnan(m[k]) AND NOT isnan(m[k + 1]), false))) > 0 AS unsorted_mz,
  len(list_distinct(r)) <> len(r) AS duplicate_mz, len(list_filter(r, lambda x: coalesce(x > p + 5.0, false))) > 0 AS fragment_above_precursor, len(list_filter(r, lambda x: x > 5000.0)) > 0 AS extreme_fragment_mz FROM u""",
    "q14_spectrum_features": f"""WITH {_TS}, a AS (SELECT spectrum_id, precursor_mz AS p, list(m ORDER BY m, i) AS m, list(i ORDER BY m, i) AS i, list(i ORDER BY i DESC) AS s, sum(i) AS t FROM pk GROUP BY 1, 2)
 SELECT spectrum_id, len(m)::DOUBLE AS n_peaks, m[1] AS mz_min, m[-1] AS mz_max, round(list_sum(m) / len(m), 6) AS mz_mean, round(list_median(m), 6) AS mz_median, round(list_stddev_pop(m), 6) AS mz_std, round(m[-1] - m[1], 6) AS fragment_mz_range,
  m[list_position(i, s[1])] AS base_peak_mz, s[1] AS base_peak_intensity, round(t, 6) AS total_intensity, {', '.join(f'round(CASE WHEN t > 0 THEN list_sum(s[1:{k}]) / t ELSE 0 END, 6) AS top{k}_intensity_fraction' for k in (1, 3, 5, 10))},
  round(CASE WHEN t > 0 THEN -coalesce(list_sum(list_transform(list_filter(i, lambda x: x > 0), lambda x: x / t * ln(x / t))), 0) ELSE 0 END, 6) AS spectral_entropy, round(m[-1] - p, 6) AS max_fragment_minus_precursor,
  CASE WHEN p IS NULL THEN 0 ELSE len(list_filter(m, lambda x: x > p)) END::DOUBLE AS n_fragments_above_precursor, round(CASE WHEN p IS NULL THEN 0 ELSE len(list_filter(m, lambda x: x > p)) END / len(m), 6) AS fraction_fragments_above_precursor FROM a""",
    "q16_bin_l2": f"WITH {_BINS} SELECT spectrum_id, bin, round(value, 6) AS value FROM b",
    "q17_similar_test_pairs": f"WITH {_BINS} SELECT x.spectrum_id AS a, y.spectrum_id AS b, round(sum(x.value * y.value), 6) AS cosine FROM b x JOIN b y ON x.bin = y.bin AND x.spectrum_id < y.spectrum_id GROUP BY 1, 2 HAVING sum(x.value * y.value) >= 0.300001",
    "q21b_standard_order_top5": f"WITH {_PAIRS} SELECT * FROM (SELECT query_id, candidate, r_id, row_number() OVER ({_W}) AS compat_rank FROM pr) WHERE compat_rank <= 5",
    "q18_reference_cosine": f"""WITH {_BINS}, {_PAIRS}, sel AS (SELECT DISTINCT query_id, r_id FROM (SELECT *, row_number() OVER ({_W}) AS r FROM pr) WHERE r <= 5),
 rp AS (SELECT row_offset AS r_id, m, i FROM (SELECT row_offset, unnest(mz) AS m, unnest(it) AS i FROM (SELECT DISTINCT row_offset, ms2_mzs AS mz, ms2_normalized_intensities AS it FROM train) WHERE len(mz) = len(it)) WHERE m IS NOT NULL AND i IS NOT NULL AND isfinite(m) AND isfinite(i) AND m >= 0 AND i >= 0),
 r0 AS (SELECT r_id, floor(m / 0.1)::BIGINT AS bin, sum(i) AS v FROM rp GROUP BY 1, 2), rb AS (SELECT r_id, bin, v / sqrt(sum(v * v) OVER (PARTITION BY r_id)) AS value FROM r0 QUALIFY sum(v * v) OVER (PARTITION BY r_id) > 0),
 dots AS (SELECT s.query_id, s.r_id, sum(b.value * rb.value) AS c FROM sel s JOIN b ON b.spectrum_id = s.query_id JOIN rb ON rb.r_id = s.r_id AND rb.bin = b.bin GROUP BY 1, 2)
 SELECT query_id, r_id, round(coalesce(c, 0), 6) AS cosine FROM sel LEFT JOIN dots USING (query_id, r_id)""",
    "q34_submission": f"""{_agg_sql('A7_most_confident_spectrum').replace('SELECT * FROM (SELECT molecule_id', ', z AS (SELECT * FROM (SELECT molecule_id', 1).replace('WHERE mol_rank <= 25', ')')},
 k AS (SELECT molecule_id, smiles, min(mol_rank) AS r FROM z JOIN (SELECT connectivity_key AS candidate, min(normalized_smiles) AS smiles FROM molecule_metadata GROUP BY 1) USING (candidate) WHERE smiles IS NOT NULL GROUP BY 1, 2)
 SELECT molecule_id, string_agg(smiles, ';' ORDER BY r, smiles) AS smiles FROM (SELECT *, row_number() OVER (PARTITION BY molecule_id ORDER BY r, smiles) AS n FROM k) WHERE n <= 25 GROUP BY 1""",
}
ORACLE |= {k: _agg_sql(k.split("_", 1)[1]) for k in QUERIES if k.split("_", 1)[1] in molecules.AGGREGATORS}
