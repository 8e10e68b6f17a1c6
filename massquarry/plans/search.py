"""Queries: adducts, mass windows, ranking and evaluation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from massquarry.functions import adducts
from massquarry.operators import ranking, retrieval, universe
from massquarry.plans import domain as D

R = lambda c, n=6: F.round(c, n).alias(c)
GRID = [2.0, 7.0, 12.0, 22.0, 47.0]


def q61_adduct_parse(spark: SparkSession, d: str) -> DataFrame:
    t = D.table(spark, d, "train").select("row_offset", "adduct").distinct().groupBy("adduct").agg(F.count(F.lit(1)).alias("n"))
    t = t.withColumn("p", adducts.parse_adduct(F.col("adduct")))
    return t.select("adduct", "n", F.coalesce("p.supported", F.lit(False)).alias("supported"), F.col("p.molecule_multiplier").alias("multiplier"), F.abs("p.charge").alias("z"), F.round("p.mass_shift", 8).alias("mass_shift"))


def q00_neutral_mass(spark: SparkSession, d: str) -> DataFrame:
    return D.test_queries(spark, d).select("query_id", R("neutral_mass"), F.coalesce("adduct_supported", F.lit(False)).alias("adduct_supported"))


def q01_band_join_ppm(spark: SparkSession, d: str) -> DataFrame:
    h = retrieval.window_join(D.test_queries(spark, d), D.library(spark, d), "neutral_mass", "exact_mass", ppm=22.0)
    return h.select("query_id", "mass_variant_id", R("mass_error_da"), R("abs_mass_error_ppm"))


def q02_band_join_variable_tol(spark: SparkSession, d: str) -> DataFrame:
    q = D.train_queries(spark, d).withColumn("tol", F.when(F.col("ionization_mode") == "negative", 22.0).otherwise(7.0))
    h = retrieval.window_join(q, D.library(spark, d), "neutral_mass", "exact_mass", ppm_col="tol", max_ppm=22.0)
    return h.select("query_id", "mass_variant_id", R("abs_mass_error_ppm"))


def q02b_band_join_da(spark: SparkSession, d: str) -> DataFrame:
    h = retrieval.window_join(D.test_queries(spark, d), D.library(spark, d), "neutral_mass", "exact_mass", da=0.0051)
    return h.select("query_id", "mass_variant_id", R("mass_error_da"))


def q02c_window_of_candidate_mass(spark: SparkSession, d: str) -> DataFrame:
    h = retrieval.window_join(D.test_queries(spark, d), D.library(spark, d), "neutral_mass", "exact_mass", ppm=33.0, relative="candidate")
    return h.select("query_id", "mass_variant_id", R("abs_mass_error_ppm"))


def _pool(spark: SparkSession, d: str, ppm: float = 22.0) -> DataFrame:
    h = retrieval.window_join(D.train_queries(spark, d), D.library(spark, d), "neutral_mass", "exact_mass", ppm=ppm)
    return retrieval.nearest_variant(h, "query_id", "connectivity_key").withColumn("is_true_candidate", F.coalesce(F.col("connectivity_key") == F.col("true_key"), F.lit(False)))


def q03_dedupe_variants(spark: SparkSession, d: str) -> DataFrame:
    return _pool(spark, d).select("query_id", "connectivity_key", R("abs_mass_error_ppm"), "n_supporting_variants", "is_true_candidate")


def q04_nearest_n_fallback(spark: SparkSession, d: str) -> DataFrame:
    f = retrieval.fallback_search(D.test_queries(spark, d), D.library(spark, d), "query_id", "neutral_mass", "connectivity_key", "exact_mass", [3.0, 30.0], nearest=3)
    return f.select("query_id", "connectivity_key", R("abs_mass_error_ppm"), F.when(F.col("level_ppm") <= 30, F.col("level_ppm")).alias("level_ppm"))


def _ranked(spark: SparkSession, d: str) -> DataFrame:
    p = _pool(spark, d).withColumn("ppm", F.round("abs_mass_error_ppm", 6))
    return ranking.rank_by_keys(p, [("ppm", True), ("connectivity_key", True)])


def q05_rank_by_keys(spark: SparkSession, d: str) -> DataFrame:
    return _ranked(spark, d).select("query_id", "connectivity_key", "rank")


def q06_per_query_metrics(spark: SparkSession, d: str) -> DataFrame:
    m = ranking.per_query_metrics(_ranked(spark, d), D.train_queries(spark, d))
    return m.select("query_id", "n_candidates", "truth_rank", R("rr"), "hit_at_1", "hit_at_5", "hit_at_25")


def q06b_metrics_by_library(spark: SparkSession, d: str) -> DataFrame:
    m = ranking.per_query_metrics(_ranked(spark, d), D.train_queries(spark, d)).join(D.train_queries(spark, d).select("query_id", "ingest_lib"), "query_id")
    s = ranking.summarise(m, ["ingest_lib"], 100)
    return s.select("ingest_lib", "n_queries", *(R(c) for c in ("mrr", "hit_at_1", "hit_at_5", "hit_at_25", "mean_candidates")), "low_support")


def _counts(spark: SparkSession, d: str) -> DataFrame:
    q = D.train_queries(spark, d)
    p = retrieval.window_join(q, D.library(spark, d), "neutral_mass", "exact_mass", ppm=max(GRID))
    p = p.groupBy("query_id", "connectivity_key", "true_key").agg(F.min("abs_mass_error_ppm").alias("abs_mass_error_ppm"))
    return retrieval.counts_by_tolerance(p, q, "query_id", "true_key", "connectivity_key", GRID)


def q07_tolerance_sweep(spark: SparkSession, d: str) -> DataFrame:
    s = retrieval.tolerance_sweep(_counts(spark, d))
    return s.select("tolerance_ppm", *(R(c) for c in s.columns[1:]))


def q08_tolerance_tradeoff(spark: SparkSession, d: str) -> DataFrame:
    t = retrieval.tradeoff(retrieval.tolerance_sweep(_counts(spark, d)))
    return t.select("tolerance_ppm", *(R(c) for c in t.columns[1:]))


def q08b_select_tolerance(spark: SparkSession, d: str) -> DataFrame:
    return retrieval.select_tolerance(retrieval.tolerance_sweep(_counts(spark, d)), 0.5).select("tolerance_ppm", R("candidate_recall"))


def _errors(spark: SparkSession, d: str) -> DataFrame:
    """Queries with the error of their own structure's nearest variant and their fold."""
    q, lib = D.train_queries(spark, d), D.library(spark, d)
    e = q.join(lib, F.col("true_key") == F.col("connectivity_key"), "left").groupBy("query_id", "adduct", "adduct_supported", "true_key", "neutral_mass").agg(
        F.min(F.abs((F.col("exact_mass") - F.col("neutral_mass")) / F.col("neutral_mass") * 1e6)).alias("error"), F.max(F.col("connectivity_key").isNotNull()).alias("in_library")
    )
    return e.withColumn("fold", F.pmod("query_id", F.lit(5)).cast("int"))


def q09_adaptive_policy(spark: SparkSession, d: str) -> DataFrame:
    """Windows fitted on four folds, applied to the fifth."""
    e, out = _errors(spark, d), None
    for fold in range(5):
        policy = retrieval.fit_windows(e.where(F.col("fold") != fold), ["adduct"], "error", 0.95, 3.0, 60.0, 50)
        part = retrieval.apply_windows(e.where(F.col("fold") == fold), policy, ["adduct"], 40.0)
        out = part if out is None else out.unionByName(part)
    found = F.coalesce(F.col("error") <= F.col("window_ppm"), F.lit(False)).cast("double")
    return out.groupBy("fold", "adduct").agg(F.count(F.lit(1)).alias("n"), F.round(F.max("window_ppm"), 6).alias("window_ppm"), F.round(F.avg(found), 6).alias("recall"))


def q10_subgroup_report(spark: SparkSession, d: str) -> DataFrame:
    e = _errors(spark, d).where(F.col("error").isNotNull())
    return e.groupBy("adduct").agg(F.count(F.lit(1)).alias("n"), *(F.round(F.percentile("error", F.lit(p / 100)), 6).alias(f"p{p}") for p in (50, 90, 95, 99)), (F.count(F.lit(1)) < 50).alias("low_support"))


def q11_failure_case(spark: SparkSession, d: str) -> DataFrame:
    e = _errors(spark, d)
    r = ranking.failure_reason(F.round("error", 6), F.col("adduct_supported"), F.col("in_library"), 10.0, 50.0)
    return e.groupBy(r.alias("reason")).agg(F.count(F.lit(1)).alias("n"))


def q12_molecule_support(spark: SparkSession, d: str) -> DataFrame:
    from massquarry.operators import molecules

    h = retrieval.window_join(D.test_queries(spark, d).where(F.col("molecule_id").isNotNull()), D.library(spark, d), "neutral_mass", "exact_mass", ppm=22.0)
    per = molecules.support(h, "molecule_id", "connectivity_key", "query_id")
    total = D.test_queries(spark, d).where(F.col("molecule_id").isNotNull()).groupBy("molecule_id").agg(F.count_distinct("query_id").alias("n_total"))
    return molecules.support_summary(per, total, "molecule_id")


def q12b_mass_variants(spark: SparkSession, d: str) -> DataFrame:
    return D.library(spark, d).select("mass_variant_id", "connectivity_key", "exact_mass", "n_spectra", "is_isotope_variant")


def _scored(spark: SparkSession, d: str) -> DataFrame:
    return D.pool(spark, d)


def q25_expected_tie_rr(spark: SparkSession, d: str) -> DataFrame:
    p = _scored(spark, d)
    m = ranking.expected_tie_metrics(p, "score", p.select("query_id").distinct())
    return m.select("query_id", "n_candidates", "truth_rank_min", "truth_rank_max", R("rr"), R("hit_at_1"), R("hit_at_5"), R("hit_at_25"))


def q26_zscore_fusion(spark: SparkSession, d: str) -> DataFrame:
    p = _scored(spark, d).where(F.col("score").isNotNull()).withColumn("mass", -F.col("abs_mass_error_ppm"))
    f = ranking.fuse(p, "mass", "score", 0.3).withColumn("fused", F.round("fused", 6))
    return ranking.rank_by_keys(f, [("fused", False), ("candidate", True)]).where("rank <= 25").select("query_id", "candidate", "fused", "rank")


def q26b_rank_sum(spark: SparkSession, d: str) -> DataFrame:
    p = _scored(spark, d).where(F.col("score").isNotNull()).withColumn("mass", -F.col("abs_mass_error_ppm"))
    return ranking.rank_sum(p, ["score", "mass"], "query_id", "candidate").where("rank <= 10").select("query_id", "candidate", F.col("rank_sum"), "rank")


def q27_softmax(spark: SparkSession, d: str) -> DataFrame:
    p = ranking.softmax(_scored(spark, d).where(F.col("score").isNotNull()), "score", "query_id", 0.25)
    return p.select("query_id", "candidate", R("prob"))


def q36_brier_ece(spark: SparkSession, d: str) -> DataFrame:
    """Calibration of the softmax of the scores, over the spectra whose truth is in the pool."""
    p = _scored(spark, d).where(F.col("score").isNotNull())
    has = p.where("is_true_candidate").select("query_id").distinct()
    p = ranking.softmax(p.join(has, "query_id", "left_semi"), "score", "query_id", 0.25).withColumn("prob", F.round("prob", 9))
    r = ranking.calibration_report(p, "prob", "query_id", "is_true_candidate", "candidate")
    return r.select("n_spectra", *(R(c) for c in ("nll", "brier", "brier_top1", "ece_top1")))


QUERIES = {k: v for k, v in list(globals().items()) if k.startswith("q") and callable(v)}

_H = f"WITH {D.ADDUCTS}, {D.TEST}, {D.TRAIN}, {D.LIB}"
_POOL = f"""{_H}, {D.window('trainq', '22.0')},
 dd AS (SELECT query_id, true_key, connectivity_key, min(abs_mass_error_ppm) AS abs_mass_error_ppm, count(*) AS n_supporting_variants FROM hits GROUP BY 1, 2, 3),
 ranked AS (SELECT *, coalesce(connectivity_key = true_key, false) AS is_true_candidate, row_number() OVER (PARTITION BY query_id ORDER BY round(abs_mass_error_ppm, 6), connectivity_key) AS rank FROM dd),
 metrics AS (SELECT q.query_id, coalesce(r.n, 0) AS n_candidates, r.truth_rank, CASE WHEN truth_rank <= 25 THEN 1.0 / truth_rank ELSE 0.0 END AS rr,
   CASE WHEN truth_rank <= 1 THEN 1.0::DOUBLE ELSE 0 END AS hit_at_1, CASE WHEN truth_rank <= 5 THEN 1.0::DOUBLE ELSE 0 END AS hit_at_5, CASE WHEN truth_rank <= 25 THEN 1.0::DOUBLE ELSE 0 END AS hit_at_25
  FROM (SELECT DISTINCT query_id FROM trainq) q LEFT JOIN (SELECT query_id, count(*) AS n, min(CASE WHEN is_true_candidate THEN rank END) AS truth_rank FROM ranked GROUP BY 1) r USING (query_id))"""
_COUNTS = f"""{_H}, {D.window('trainq', '47.0')}, near AS (SELECT query_id, true_key, connectivity_key, min(abs_mass_error_ppm) AS e FROM hits GROUP BY 1, 2, 3),
 grid(t) AS (VALUES (2.0::DOUBLE), (7.0), (12.0), (22.0), (47.0)),
 counts AS (SELECT g.t AS tolerance_ppm, q.query_id, count(n.e) AS c, coalesce(max((n.connectivity_key = n.true_key)::INT), 0) AS found
  FROM grid g CROSS JOIN (SELECT DISTINCT query_id FROM trainq) q LEFT JOIN near n ON n.query_id = q.query_id AND n.e <= g.t GROUP BY 1, 2),
 sweep AS (SELECT tolerance_ppm, avg(c) AS mean_candidates, quantile_cont(c, 0.5) AS p50_candidates, quantile_cont(c, 0.75) AS p75_candidates, quantile_cont(c, 0.9) AS p90_candidates, quantile_cont(c, 0.95) AS p95_candidates,
  quantile_cont(c, 0.99) AS p99_candidates, max(c) AS max_candidates, avg((c = 0)::INT) AS zero_rate, avg(found) AS candidate_recall FROM counts GROUP BY 1)"""
_ERR = f"""{_H}, err AS (SELECT q.query_id, q.adduct, q.adduct_supported, min(abs((l.exact_mass - q.neutral_mass) / q.neutral_mass * 1e6)) AS error, bool_or(l.connectivity_key IS NOT NULL) AS in_library, (q.query_id % 5)::INT AS fold
 FROM trainq q LEFT JOIN lib l ON l.connectivity_key = q.true_key GROUP BY 1, 2, 3, 6)"""

ORACLE = {
    "q61_adduct_parse": f"WITH {D.ADDUCTS}, t AS (SELECT adduct, count(*) AS n FROM (SELECT DISTINCT row_offset, adduct FROM train) GROUP BY 1) SELECT t.adduct, t.n, a.adduct IS NOT NULL AS supported, a.n AS multiplier, a.z, round(a.shift, 8) AS mass_shift FROM t LEFT JOIN adducts a ON a.adduct = t.adduct",
    "q00_neutral_mass": f"{_H} SELECT query_id, round(neutral_mass, 6) AS neutral_mass, adduct_supported FROM testq",
    "q01_band_join_ppm": f"{_H}, {D.window('testq', '22.0')} SELECT query_id, mass_variant_id, round(mass_error_da, 6) AS mass_error_da, round(abs_mass_error_ppm, 6) AS abs_mass_error_ppm FROM hits",
    "q02_band_join_variable_tol": f"{_H}, {D.window('trainq', chr(39).join(['(CASE WHEN q.ionization_mode = ', 'negative', ' THEN 22.0 ELSE 7.0 END)']))} SELECT query_id, mass_variant_id, round(abs_mass_error_ppm, 6) AS abs_mass_error_ppm FROM hits",
    "q02b_band_join_da": f"{_H} SELECT q.query_id, l.mass_variant_id, round(l.exact_mass - q.neutral_mass, 6) AS mass_error_da FROM testq q JOIN lib l ON l.exact_mass BETWEEN q.neutral_mass - 0.0051 AND q.neutral_mass + 0.0051 WHERE q.neutral_mass > 0",
    "q02c_window_of_candidate_mass": f"{_H} SELECT q.query_id, l.mass_variant_id, round(abs((l.exact_mass - q.neutral_mass) / l.exact_mass * 1e6), 6) AS abs_mass_error_ppm FROM testq q JOIN lib l ON l.exact_mass >= q.neutral_mass - l.exact_mass * 33.0 * 1e-6 AND l.exact_mass <= q.neutral_mass + l.exact_mass * 33.0 * 1e-6 WHERE q.neutral_mass > 0",
    "q03_dedupe_variants": f"{_POOL} SELECT query_id, connectivity_key, round(abs_mass_error_ppm, 6) AS abs_mass_error_ppm, n_supporting_variants, is_true_candidate FROM ranked",
    "q04_nearest_n_fallback": f"""{_H}, near AS (SELECT q.query_id, l.connectivity_key, min(abs((l.exact_mass - q.neutral_mass) / q.neutral_mass * 1e6)) AS e FROM testq q JOIN lib l
  ON l.exact_mass > 0 WHERE q.neutral_mass > 0 GROUP BY 1, 2),
 lv AS (SELECT *, min(e) OVER (PARTITION BY query_id) AS best, row_number() OVER (PARTITION BY query_id ORDER BY e, connectivity_key) AS r FROM near)
 SELECT query_id, connectivity_key, round(e, 6) AS abs_mass_error_ppm, CASE WHEN best <= 3 THEN 3.0::DOUBLE WHEN best <= 30 THEN 30.0 END AS level_ppm FROM lv
 WHERE (best <= 3 AND e <= 3) OR (best > 3 AND best <= 30 AND e <= 30) OR (best > 30 AND r <= 3)""",
    "q05_rank_by_keys": f"{_POOL} SELECT query_id, connectivity_key, rank FROM ranked",
    "q06_per_query_metrics": f"{_POOL} SELECT query_id, n_candidates, truth_rank, round(rr, 6) AS rr, hit_at_1, hit_at_5, hit_at_25 FROM metrics",
    "q06b_metrics_by_library": f"{_POOL} SELECT q.ingest_lib, count(*) AS n_queries, round(avg(rr), 6) AS mrr, round(avg(hit_at_1), 6) AS hit_at_1, round(avg(hit_at_5), 6) AS hit_at_5, round(avg(hit_at_25), 6) AS hit_at_25, round(avg(n_candidates), 6) AS mean_candidates, count(*) < 100 AS low_support FROM metrics JOIN trainq q USING (query_id) GROUP BY 1",
    "q07_tolerance_sweep": f"{_COUNTS} SELECT tolerance_ppm, {', '.join(f'round({c}, 6) AS {c}' for c in ('mean_candidates', 'p50_candidates', 'p75_candidates', 'p90_candidates', 'p95_candidates', 'p99_candidates', 'max_candidates', 'zero_rate', 'candidate_recall'))} FROM sweep",
    "q08_tolerance_tradeoff": f"{_COUNTS} SELECT tolerance_ppm, round(candidate_recall, 6) AS candidate_recall, round(mean_candidates, 6) AS mean_candidates, round(candidate_recall - lag(candidate_recall) OVER w, 6) AS delta_recall, round(mean_candidates - lag(mean_candidates) OVER w, 6) AS delta_candidates FROM sweep WINDOW w AS (ORDER BY tolerance_ppm)",
    "q08b_select_tolerance": f"{_COUNTS} SELECT tolerance_ppm, round(candidate_recall, 6) AS candidate_recall FROM sweep ORDER BY candidate_recall >= 0.5 DESC, CASE WHEN candidate_recall >= 0.5 THEN tolerance_ppm END, candidate_recall DESC, tolerance_ppm LIMIT 1",
    "q09_adaptive_policy": f"""{_ERR}, pol AS (SELECT f AS fold, adduct, least(greatest(quantile_cont(error, 0.95), 3.0), 60.0) AS w FROM err, range(5) r(f) WHERE err.fold <> f AND error IS NOT NULL GROUP BY 1, 2 HAVING count(*) >= 50)
 SELECT e.fold, e.adduct, count(*) AS n, round(max(coalesce(p.w, 40.0)), 6) AS window_ppm, round(avg(coalesce(e.error <= coalesce(p.w, 40.0), false)::INT), 6) AS recall FROM err e LEFT JOIN pol p ON p.fold = e.fold AND p.adduct IS NOT DISTINCT FROM e.adduct GROUP BY 1, 2""",
    "q10_subgroup_report": f"{_ERR} SELECT adduct, count(*) AS n, {', '.join(f'round(quantile_cont(error, {p / 100}), 6) AS p{p}' for p in (50, 90, 95, 99))}, count(*) < 50 AS low_support FROM err WHERE error IS NOT NULL GROUP BY 1",
    "q11_failure_case": f"{_ERR} SELECT CASE WHEN coalesce(round(error, 6) <= 10, false) THEN NULL WHEN NOT coalesce(adduct_supported, false) THEN 'unsupported_adduct' WHEN NOT coalesce(in_library, false) THEN 'truth_not_in_library' WHEN error IS NULL THEN 'no_mass' WHEN round(error, 6) <= 50 THEN 'just_outside' ELSE 'far_outside' END AS reason, count(*) AS n FROM err GROUP BY 1",
    "q12_molecule_support": f"""{_H}, {D.window('testq', '22.0')}, per AS (SELECT molecule_id, connectivity_key, count(DISTINCT query_id) AS n FROM hits WHERE molecule_id IS NOT NULL GROUP BY 1, 2), tot AS (SELECT molecule_id, count(DISTINCT query_id) AS t FROM testq WHERE molecule_id IS NOT NULL GROUP BY 1)
 SELECT molecule_id, count(n) AS union_size, count(CASE WHEN n = t THEN 1 END) AS intersection_size, count(CASE WHEN n = 1 THEN 1 END) AS seen_once, count(CASE WHEN n > 1 THEN 1 END) AS seen_multi FROM tot LEFT JOIN per USING (molecule_id) GROUP BY 1""",
    "q12b_mass_variants": f"WITH {D.LIB} SELECT mass_variant_id, connectivity_key, exact_mass, n_spectra, is_isotope_variant FROM lib",
    "q25_expected_tie_rr": f"""WITH {D.POOL}, r AS (SELECT *, rank() OVER (PARTITION BY query_id ORDER BY coalesce(score, '-inf'::DOUBLE) DESC) AS lo, count(*) OVER (PARTITION BY query_id, coalesce(score, '-inf'::DOUBLE)) AS m FROM pool),
 t AS (SELECT query_id, min(lo) AS lo, min(lo + m - 1) AS hi FROM (SELECT query_id, lo, m, row_number() OVER (PARTITION BY query_id ORDER BY lo) AS k FROM r WHERE is_true_candidate) WHERE k = 1 GROUP BY 1)
 SELECT q.query_id, q.n AS n_candidates, lo AS truth_rank_min, hi AS truth_rank_max, round(coalesce((SELECT sum(1.0 / x) FROM range(1, 26) g(x) WHERE x >= lo AND x <= hi) / (hi - lo + 1), 0), 6) AS rr,
  {', '.join(f'round(coalesce(greatest(0, least({k}, hi) - lo + 1) / (hi - lo + 1)::DOUBLE, 0), 6) AS hit_at_{k}' for k in (1, 5, 25))}
 FROM (SELECT query_id, count(*) AS n FROM pool GROUP BY 1) q LEFT JOIN t USING (query_id)""",
    "q26_zscore_fusion": f"""WITH {D.POOL}, s AS (SELECT avg(-abs_mass_error_ppm) AS m0, stddev_pop(-abs_mass_error_ppm) AS s0, avg(score) AS m1, stddev_pop(score) AS s1 FROM pool WHERE score IS NOT NULL),
 f AS (SELECT query_id, candidate, round(0.3 * coalesce((-abs_mass_error_ppm - m0) / s0, 0) + 0.7 * coalesce((score - m1) / s1, 0), 6) AS fused FROM pool, s WHERE score IS NOT NULL)
 SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY fused DESC, candidate) AS rank FROM f) WHERE rank <= 25""",
    "q26b_rank_sum": f"""WITH {D.POOL}, r AS (SELECT query_id, candidate, row_number() OVER (PARTITION BY query_id ORDER BY score DESC NULLS LAST, candidate) + row_number() OVER (PARTITION BY query_id ORDER BY -abs_mass_error_ppm DESC NULLS LAST, candidate) AS rank_sum FROM pool WHERE score IS NOT NULL)
 SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY rank_sum, candidate) AS rank FROM r) WHERE rank <= 10""",
    "q27_softmax": f"WITH {D.POOL}, e AS (SELECT query_id, candidate, exp(score / 0.25 - max(score / 0.25) OVER (PARTITION BY query_id)) AS e FROM pool WHERE score IS NOT NULL) SELECT query_id, candidate, round(e / sum(e) OVER (PARTITION BY query_id), 6) AS prob FROM e",
    "q36_brier_ece": f"""WITH {D.POOL}, e AS (SELECT query_id, candidate, is_true_candidate AS t, exp(score / 0.25 - max(score / 0.25) OVER (PARTITION BY query_id)) AS e FROM pool WHERE score IS NOT NULL),
 p AS (SELECT query_id, candidate, t, round(e / sum(e) OVER (PARTITION BY query_id), 9) AS p FROM e WHERE query_id IN (SELECT query_id FROM e WHERE t)),
 b AS (SELECT query_id, sum((p - t::INT) ** 2) AS brier FROM p GROUP BY 1), top AS (SELECT p, t FROM p QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY p DESC, candidate) = 1),
 bins AS (SELECT count(*) AS n, avg(p) AS c, avg(t::INT) AS a FROM top GROUP BY least(floor(p * 10), 9))
 SELECT (SELECT count(*) FROM b) AS n_spectra, round((SELECT -avg(ln(greatest(p, 1e-300))) FROM p WHERE t), 6) AS nll, round((SELECT avg(brier) FROM b), 6) AS brier, round((SELECT avg((p - t::INT) ** 2) FROM top), 6) AS brier_top1, round((SELECT sum(n * abs(a - c)) / sum(n) FROM bins), 6) AS ece_top1""",
}
