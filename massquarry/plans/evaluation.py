"""Queries: strata, reweighting, missingness, near misses, likelihoods, consensus, models, end-to-end inference."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from massquarry.operators import blocks, evaluation, models, molecules, ranking, retrieval
from massquarry.plans import domain as D
from massquarry.plans import evidence, search

R = lambda c, n=6: F.round(c, n).alias(c)


def _ranked_pool(spark: SparkSession, d: str) -> DataFrame:
    return ranking.rank_by_keys(D.pool(spark, d), [("score", False), ("candidate", True)])


def _metrics(spark: SparkSession, d: str) -> DataFrame:
    p = _ranked_pool(spark, d)
    return ranking.per_query_metrics(p, p.select("query_id").distinct())


def q42_density_reweight(spark: SparkSession, d: str) -> DataFrame:
    """Train queries by mass, as if their pools were as large as the scored pools."""
    m = ranking.per_query_metrics(search._ranked(spark, d), D.train_queries(spark, d)).withColumn("bin", evaluation.pool_bin(F.col("n_candidates")))
    t = D.pool(spark, d).groupBy("query_id").agg(F.count(F.lit(1)).alias("n")).withColumn("bin", evaluation.pool_bin(F.col("n")))
    return evaluation.reweighted_mean(m, t, "rr", "bin").select(R("mean"), R("covered"))


def q43b_stratified_metrics(spark: SparkSession, d: str) -> DataFrame:
    m = ranking.per_query_metrics(search._ranked(spark, d), D.train_queries(spark, d)).join(D.train_queries(spark, d).select("query_id", "ionization_mode", "ingest_lib", "instrument"), "query_id")
    s = evaluation.stratified(m, "ionization_mode", ["ingest_lib", "instrument"])
    return s.select("ionization_mode", "stratum", "level", "n", R("mean"))


def q44_mass_likelihood(spark: SparkSession, d: str) -> DataFrame:
    q = D.train_queries(spark, d).join(D.library(spark, d), F.col("true_key") == F.col("connectivity_key"))
    e = q.withColumn("error", F.round((F.col("exact_mass") - F.col("neutral_mass")) / F.col("neutral_mass") * 1e6, 4)).withColumn("abs_error", F.abs("error"))
    e = e.where(F.col("error").isNotNull())
    s = evaluation.mass_loglik(e, e, "error", "abs_error", min_rows=40)
    return s.groupBy("adduct", "mass_level").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("mass_loglik"), 5).alias("mean_loglik"))


def q45b_consensus(spark: SparkSession, d: str) -> DataFrame:
    """What the spectra of a molecule agree on: each votes for its best candidate."""
    v = D.molecule_rankings(spark, d).where("rank = 1")
    c = evaluation.consensus(v, "molecule_id", "spectrum_id", "candidate", "score")
    return c.select("molecule_id", "modal", R("modal_share"), "n_votes", "n_keys", R("leave_one_out"))


def q67_near_misses(spark: SparkSession, d: str) -> DataFrame:
    n = evaluation.near_misses(_ranked_pool(spark, d), "query_id", "candidate", "score", "is_true_candidate")
    return n.select("query_id", "truth", "truth_rank", "winner", R("score_gap"))


def q68_accounting(spark: SparkSession, d: str) -> DataFrame:
    q = D.table(spark, d, "test").select(F.col("spectrum_id").alias("query_id"))
    return evaluation.accounting(D.pool(spark, d), q, "query_id", "is_true_candidate", "score")


def q69_missingness(spark: SparkSession, d: str) -> DataFrame:
    p = D.table(spark, d, "candidate_pool").withColumn("truth", F.coalesce(F.col("is_true_candidate").cast("string"), F.lit("unknown")))
    m = evaluation.missingness(p, ["score", "molecule_id", "candidate_connectivity_key"], "truth")
    return m.select("truth", "n", *(R(c) for c in m.columns[2:]))


def q70_tree_scores(spark: SparkSession, d: str) -> DataFrame:
    """A tree ensemble over score and mass error as one expression."""
    m = {"features": ["score", "abs_mass_error_ppm"], "trees": [
        {"feature": "score", "threshold": 0.5, "missing": "left", "left": {"value": -0.5}, "right": {"feature": "abs_mass_error_ppm", "threshold": 5.0, "left": {"value": 1.5}, "right": {"value": 0.75}}},
        {"feature": "abs_mass_error_ppm", "threshold": 2.0, "missing": "right", "left": {"value": 0.25}, "right": {"value": -0.25}},
    ]}
    s = D.pool(spark, d).withColumn("model", models.fold_mean([m, m]))
    return ranking.rank_by_keys(s, [("model", False), ("abs_mass_error_ppm", True), ("candidate", True)]).where("rank <= 5").select("query_id", "candidate", "model", "rank")


def q71_marginal_weights(spark: SparkSession, d: str) -> DataFrame:
    p = D.train_queries(spark, d)
    w = evaluation.marginal_weights(p, D.test_queries(spark, d), ["adduct", "ionization_mode"], 0.1, 10.0)
    return evaluation.effective_size(w, "weight").select("n", R("n_effective", 3))


def q72_list_metrics(spark: SparkSession, d: str) -> DataFrame:
    """Metrics of the ten best candidates as lists, deduplicated before the cut."""
    p = _ranked_pool(spark, d).where("rank <= 10")
    lists = p.groupBy("query_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "candidate"))), lambda x: x["candidate"]).alias("l"))
    t = D.pool(spark, d).where("is_true_candidate").groupBy("query_id").agg(F.min("candidate").alias("truth"))
    m = evaluation.list_metrics(F.col("l"), F.col("truth"), 10)
    return t.join(lists, "query_id").select("query_id", F.round(m["rr"], 6).alias("rr"), m["hit"].alias("hit"))


def q73_hard_negatives(spark: SparkSession, d: str) -> DataFrame:
    h = evaluation.hard_negatives(D.pool(spark, d), "query_id", "candidate", "abs_mass_error_ppm", "score", "is_true_candidate", 8)
    return h.select("query_id", "candidate", "kind")


def q74_end_to_end(spark: SparkSession, d: str) -> DataFrame:
    """From raw test spectra to molecule rankings: mass, windows with fallback, mass likelihood as score, softmax, A7."""
    q = D.test_queries(spark, d).where(F.col("molecule_id").isNotNull())
    hits = retrieval.fallback_search(q, D.library(spark, d), "query_id", "neutral_mass", "connectivity_key", "exact_mass", [10.0, 50.0], nearest=5)
    s = hits.withColumn("score", F.round(-F.pow(F.col("abs_mass_error_ppm") / 10.0, F.lit(2)) / 2, 9))
    s = ranking.softmax(s.join(q.select("query_id", "molecule_id"), "query_id"), "score", "query_id", 1.1947045)
    s = s.withColumnsRenamed({"query_id": "spectrum_id", "connectivity_key": "candidate"})
    s = ranking.rank_by_keys(s, [("score", False), ("candidate", True)], "spectrum_id")
    a = molecules.aggregate(s, "A7_most_confident_spectrum")
    return a.where("mol_rank <= 25").select("molecule_id", "candidate", R("agg_score"), "mol_rank")


def q75_entropy_similarity(spark: SparkSession, d: str) -> DataFrame:
    """Spectral entropy similarity of the test pairs that share bins."""
    s = blocks.similar(evidence.test_blocks(spark, d), None, "a", "b", 0.300001, entropy=True)
    return s.select("a", "b", R("entropy_similarity"))


QUERIES = {k: v for k, v in list(globals().items()) if k.startswith("q") and callable(v)}

_BIN = lambda x: "CASE " + " ".join(f"WHEN {x} >= {e} THEN {i}" for i, e in reversed(list(enumerate(evaluation.POOL_EDGES)))) + " ELSE -1 END"
_RANKED = f"{D.POOL}, rk AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC NULLS LAST, candidate) AS rank FROM pool)"
_MED = """e AS (SELECT q.query_id, q.adduct, coalesce(q.adduct, 'None') AS ad, coalesce(q.instrument, 'None') AS ins, round((l.exact_mass - q.neutral_mass) / q.neutral_mass * 1e6, 4) AS err FROM trainq q JOIN lib l ON l.connectivity_key = q.true_key WHERE q.neutral_mass IS NOT NULL),
 f AS (SELECT * FROM e WHERE abs(err) <= 50), a1 AS (SELECT ins, ad, median(err) AS mu FROM f GROUP BY ALL HAVING count(*) >= 40), b1 AS (SELECT ins, ad, mu, greatest(median(abs(err - mu)) * 1.4826, 0.1) AS s FROM f JOIN a1 USING (ins, ad) GROUP BY ALL),
 a2 AS (SELECT ins, median(err) AS mu FROM f GROUP BY ALL HAVING count(*) >= 40), b2 AS (SELECT ins, mu, greatest(median(abs(err - mu)) * 1.4826, 0.1) AS s FROM f JOIN a2 USING (ins) GROUP BY ALL),
 a3 AS (SELECT ad, median(err) AS mu FROM f GROUP BY ALL HAVING count(*) >= 40), b3 AS (SELECT ad, mu, greatest(median(abs(err - mu)) * 1.4826, 0.1) AS s FROM f JOIN a3 USING (ad) GROUP BY ALL),
 a4 AS (SELECT median(err) AS mu FROM f), b4 AS (SELECT mu, greatest(median(abs(err - mu)) * 1.4826, 0.1) AS s FROM f, a4 GROUP BY mu),
 p AS (SELECT e.adduct, abs(err) AS a, coalesce(b1.mu, b2.mu, b3.mu, b4.mu) AS mu, coalesce(b1.s, b2.s, b3.s, b4.s) AS s, CASE WHEN b1.mu IS NOT NULL THEN 'instrument_adduct' WHEN b2.mu IS NOT NULL THEN 'instrument' WHEN b3.mu IS NOT NULL THEN 'adduct' ELSE 'global' END AS mass_level
  FROM e LEFT JOIN b1 ON b1.ins = e.ins AND b1.ad = e.ad LEFT JOIN b2 ON b2.ins = e.ins LEFT JOIN b3 ON b3.ad = e.ad CROSS JOIN b4)"""

ORACLE = {
    "q75_entropy_similarity": f"""WITH {evidence._BINS}, pr AS (SELECT x.spectrum_id AS a, y.spectrum_id AS b FROM b x JOIN b y ON x.bin = y.bin AND x.spectrum_id < y.spectrum_id GROUP BY 1, 2 HAVING sum(x.value * y.value) >= 0.300001),
 s AS (SELECT spectrum_id AS k, bin, v / sum(v) OVER (PARTITION BY spectrum_id) AS p FROM b0), f AS (SELECT pr.a, pr.b, coalesce(u.p, 0) AS p, coalesce(w.p, 0) AS q FROM pr JOIN (SELECT k, bin FROM s) z ON z.k IN (pr.a, pr.b) LEFT JOIN s u ON u.k = pr.a AND u.bin = z.bin LEFT JOIN s w ON w.k = pr.b AND w.bin = z.bin GROUP BY pr.a, pr.b, z.bin, u.p, w.p)
 SELECT a, b, round(1 - sum(-2 * CASE WHEN p + q > 0 THEN (p + q) / 2 * ln((p + q) / 2) ELSE 0 END + CASE WHEN p > 0 THEN p * ln(p) ELSE 0 END + CASE WHEN q > 0 THEN q * ln(q) ELSE 0 END) / ln(4), 6) AS entropy_similarity FROM f GROUP BY 1, 2""",
    "q42_density_reweight": f"""{search._POOL}, {D.POOL}, m AS (SELECT {_BIN('n_candidates')} AS b, avg(rr) AS m FROM metrics GROUP BY 1), t AS (SELECT {_BIN('n')} AS b, count(*) AS n FROM (SELECT query_id, count(*) AS n FROM pool GROUP BY 1) GROUP BY 1)
 SELECT round(sum(m * n) / sum(CASE WHEN m IS NOT NULL THEN n END), 6) AS mean, round(sum(CASE WHEN m IS NOT NULL THEN n END) / sum(n), 6) AS covered FROM t LEFT JOIN m USING (b)""",
    "q43b_stratified_metrics": f"""{search._POOL}, x AS (SELECT m.rr, q.ionization_mode, q.ingest_lib, q.instrument FROM metrics m JOIN trainq q USING (query_id)) SELECT ionization_mode, 'ALL' AS stratum, NULL::VARCHAR AS level, count(*) AS n, round(avg(rr), 6) AS mean FROM x GROUP BY 1
 UNION ALL SELECT ionization_mode, 'ingest_lib', ingest_lib, count(*), round(avg(rr), 6) FROM x GROUP BY 1, 3 UNION ALL SELECT ionization_mode, 'instrument', instrument, count(*), round(avg(rr), 6) FROM x GROUP BY 1, 3""",
    "q44_mass_likelihood": f"{search._H}, {_MED} SELECT adduct, mass_level, count(*) AS n, round(avg(ln(0.98 * (exp(-0.5 * ((a - mu) / s) ** 2) + exp(-0.5 * ((-a - mu) / s) ** 2)) / (s * sqrt(2 * pi())) + 0.02 / 50)), 5) AS mean_loglik FROM p GROUP BY 1, 2",
    "q45b_consensus": f"""WITH {D.POOL}, mm AS (SELECT DISTINCT spectrum_id, molecule_id FROM test WHERE molecule_id IS NOT NULL), r AS (SELECT molecule_id, candidate, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, abs_mass_error_ppm NULLS LAST, candidate) AS r FROM pool JOIN mm ON mm.spectrum_id = query_id WHERE score IS NOT NULL),
 c AS (SELECT molecule_id, candidate, count(*) AS n, sum(score) AS w FROM r WHERE r = 1 GROUP BY 1, 2), o AS (SELECT *, row_number() OVER (PARTITION BY molecule_id ORDER BY n DESC, round(w, 9) DESC, candidate) AS k, sum(n) OVER (PARTITION BY molecule_id) AS t FROM c),
 s AS (SELECT molecule_id, max(CASE WHEN k = 1 THEN n END) AS f, coalesce(max(CASE WHEN k = 2 THEN n END), 0) AS g FROM o GROUP BY 1)
 SELECT molecule_id, min(CASE WHEN k = 1 THEN candidate END) AS modal, round(max(CASE WHEN k = 1 THEN n END) / max(t), 6) AS modal_share, max(t)::BIGINT AS n_votes, count(*) AS n_keys, round(sum(CASE WHEN n - 1 > CASE WHEN k = 1 THEN g ELSE f END THEN n ELSE 0 END) / max(t), 6) AS leave_one_out FROM o JOIN s USING (molecule_id) GROUP BY 1""",
    "q67_near_misses": f"WITH {_RANKED}, t AS (SELECT query_id, candidate AS truth, rank AS truth_rank, score AS ts FROM rk WHERE is_true_candidate QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY rank) = 1) SELECT t.query_id, truth, truth_rank, w.candidate AS winner, round(w.score - ts, 6) AS score_gap FROM t JOIN rk w ON w.query_id = t.query_id AND w.rank = 1 AND NOT w.is_true_candidate",
    "q68_accounting": f"WITH {D.POOL}, q AS (SELECT DISTINCT spectrum_id AS query_id FROM test), p AS (SELECT query_id, bool_or(is_true_candidate) AS t, bool_or(is_true_candidate AND score IS NOT NULL) AS e, bool_or(score IS NOT NULL) AS a FROM pool GROUP BY 1) SELECT count(*) AS n_queries, count(p.query_id) AS with_candidates, count(CASE WHEN t THEN 1 END) AS truth_in_pool, count(CASE WHEN e THEN 1 END) AS truth_with_evidence, count(CASE WHEN a THEN 1 END) AS any_evidence FROM q LEFT JOIN p USING (query_id)",
    "q69_missingness": """WITH p AS (SELECT coalesce(is_true_candidate::VARCHAR, 'unknown') AS truth, (score IS NULL OR isnan(score)) AS a, molecule_id IS NULL AS b, candidate_connectivity_key IS NULL AS c FROM candidate_pool)
 SELECT truth, count(*) AS n, round(avg(a::INT), 6) AS null_score, round(avg(b::INT), 6) AS null_molecule_id, round(avg(c::INT), 6) AS null_candidate_connectivity_key, round(avg((a OR b OR c)::INT), 6) AS null_any, round(avg((a AND b AND c)::INT), 6) AS null_all FROM p GROUP BY 1""",
    "q70_tree_scores": f"WITH {D.POOL}, s AS (SELECT *, CASE WHEN score IS NULL OR score <= 0.5 THEN -0.5 WHEN abs_mass_error_ppm IS NULL OR abs_mass_error_ppm <= 5 THEN 1.5 ELSE 0.75 END + CASE WHEN abs_mass_error_ppm <= 2 THEN 0.25 ELSE -0.25 END AS model FROM pool) SELECT query_id, candidate, model::DOUBLE AS model, rank FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY model DESC, abs_mass_error_ppm NULLS LAST, candidate) AS rank FROM s) WHERE rank <= 5",
    "q71_marginal_weights": f"""{search._H}, {', '.join(f'''p{i} AS (SELECT {c}, count(*) AS n FROM trainq GROUP BY 1), t{i} AS (SELECT {c}, count(*) AS n FROM testq GROUP BY 1), w{i} AS (SELECT p{i}.{c} AS k, least(greatest((coalesce(t{i}.n, 0) / (SELECT sum(n) FROM t{i})) / (p{i}.n / (SELECT sum(n) FROM p{i})), 0.1), 10.0) AS w FROM p{i} LEFT JOIN t{i} ON t{i}.{c} IS NOT DISTINCT FROM p{i}.{c})''' for i, c in enumerate(('adduct', 'ionization_mode')))}
 SELECT count(*) AS n, round(sum(w0.w * w1.w) ** 2 / sum((w0.w * w1.w) ** 2), 3) AS n_effective FROM trainq q JOIN w0 ON w0.k IS NOT DISTINCT FROM q.adduct JOIN w1 ON w1.k IS NOT DISTINCT FROM q.ionization_mode""",
    "q72_list_metrics": f"WITH {_RANKED}, t AS (SELECT query_id, min(candidate) AS truth FROM pool WHERE is_true_candidate GROUP BY 1) SELECT t.query_id, round(coalesce(1.0 / r.rank, 0), 6) AS rr, (r.rank IS NOT NULL)::INT::DOUBLE AS hit FROM t LEFT JOIN rk r ON r.query_id = t.query_id AND r.candidate = t.truth AND r.rank <= 10",
    "q74_end_to_end": f"""{search._H}, near AS (SELECT q.query_id, q.molecule_id, l.connectivity_key AS candidate, min(abs((l.exact_mass - q.neutral_mass) / q.neutral_mass * 1e6)) AS e FROM testq q JOIN lib l ON l.exact_mass > 0 WHERE q.neutral_mass > 0 AND q.molecule_id IS NOT NULL GROUP BY 1, 2, 3),
 lv AS (SELECT *, min(e) OVER (PARTITION BY query_id) AS best, row_number() OVER (PARTITION BY query_id ORDER BY e, candidate) AS k FROM near), h AS (SELECT *, round(-((e / 10.0) ** 2) / 2, 9) / 1.1947045 AS z FROM lv WHERE (best <= 10 AND e <= 10) OR (best > 10 AND best <= 50 AND e <= 50) OR (best > 50 AND k <= 5)),
 x AS (SELECT *, exp(z - max(z) OVER (PARTITION BY query_id)) AS x FROM h), r AS (SELECT *, x / sum(x) OVER (PARTITION BY query_id) AS prob FROM x), b AS (SELECT molecule_id, min(query_id) AS s FROM (SELECT molecule_id, query_id, max(prob) AS p, max(max(prob)) OVER (PARTITION BY molecule_id) AS m FROM r GROUP BY 1, 2) WHERE p = m GROUP BY 1)
 SELECT * FROM (SELECT r.molecule_id, candidate, round(prob, 6) AS agg_score, row_number() OVER (PARTITION BY r.molecule_id ORDER BY round(prob, 9) DESC, round(e, 9), candidate) AS mol_rank FROM r JOIN b ON b.molecule_id = r.molecule_id AND b.s = r.query_id) WHERE mol_rank <= 25""",
}
