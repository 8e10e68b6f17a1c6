"""Queries: distribution shift, sampling, folds, bootstrap, universe, provenance, similarity of structures."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from massquarry.functions import structures
from massquarry.operators import blocks, quality, ranking, spectra, statistics, universe
from massquarry.plans import domain as D

R = lambda c, n=6: F.round(c, n).alias(c)


def _train(spark: SparkSession, d: str, *cols: str) -> DataFrame:
    return D.table(spark, d, "train").select("row_offset", *cols).dropDuplicates(["row_offset"])


def q37_ks_wasserstein(spark: SparkSession, d: str) -> DataFrame:
    s = statistics.numeric_shift(D.table(spark, d, "documents"), "lang", "n_chars", ("en", "fr"))
    return s.select("n_a", "n_b", R("ks"), R("wasserstein"))


def q37b_ks_precursor(spark: SparkSession, d: str) -> DataFrame:
    a = _train(spark, d, "precursor_mz").select(F.lit("train").alias("side"), "precursor_mz")
    b = D.table(spark, d, "test").dropDuplicates(["spectrum_id"]).select(F.lit("test").alias("side"), "precursor_mz")
    s = statistics.numeric_shift(a.unionByName(b), "side", "precursor_mz", ("train", "test"))
    return s.select("n_a", "n_b", R("ks"), R("wasserstein"))


def q38_js(spark: SparkSession, d: str) -> DataFrame:
    s = statistics.categorical_shift(D.table(spark, d, "documents"), "lang", "source", ("en", "de"))
    return s.select("n_categories", R("js_distance"), R("tv_distance"))


def q39_weighted_ks(spark: SparkSession, d: str) -> DataFrame:
    k = statistics.weighted_ks(D.table(spark, d, "lineitem"), "l_returnflag", "l_extendedprice", "l_quantity", ("A", "R"), "l_linestatus")
    return k.select("l_linestatus", "n_a", "n_b", R("ks"))


def q76_pair_dataset(spark: SparkSession, d: str) -> DataFrame:
    from massquarry.operators import evaluation

    t = _train(spark, d, "inchikey14", "ionization_mode", "adduct").select("row_offset", structures.inchikey14(F.col("inchikey14")).alias("k"), "ionization_mode", "adduct")
    return evaluation.pair_dataset(t, "row_offset", "k", ["ionization_mode", "adduct"], "p1")


def q40_weighted_quantile(spark: SparkSession, d: str) -> DataFrame:
    return statistics.weighted_quantile(D.table(spark, d, "lineitem"), "l_returnflag", "l_extendedprice", "l_quantity", 0.9)


def q41_cell_reweight(spark: SparkSession, d: str) -> DataFrame:
    pool = _train(spark, d, "adduct")
    return statistics.cell_weights(pool, D.table(spark, d, "test").dropDuplicates(["spectrum_id"]), "adduct", 0.1, 10.0).select("adduct", R("weight"))


def q43_stratified_rollup(spark: SparkSession, d: str) -> DataFrame:
    t = _train(spark, d, "ionization_mode", "ingest_lib", "num_peaks")
    return t.rollup("ionization_mode", "ingest_lib").agg(F.grouping_id().cast("int").alias("level"), F.count(F.lit(1)).alias("n"), F.round(F.avg("num_peaks"), 6).alias("mean_peaks"))


def q45_consensus_mode(spark: SparkSession, d: str) -> DataFrame:
    """Per structure the most frequent adduct (ties: alphabetically) and its share."""
    t = _train(spark, d, "inchikey14", "adduct").withColumn("k", structures.inchikey14(F.col("inchikey14"))).where(F.col("k").isNotNull() & F.col("adduct").isNotNull())
    c = t.groupBy("k", "adduct").agg(F.count(F.lit(1)).alias("n"))
    m = c.groupBy("k").agg(F.sum("n").alias("total"), F.min_by(F.struct("adduct", "n"), F.struct((-F.col("n")).alias("m"), "adduct")).alias("b"))
    return m.select(F.col("k").alias("connectivity_key"), F.col("b.adduct").alias("adduct"), F.round(F.col("b.n") / F.col("total"), 6).alias("share"))


def q46_provenance(spark: SparkSession, d: str) -> DataFrame:
    t = _train(spark, d, "inchikey14", "ingest_lib").withColumn("k", structures.inchikey14(F.col("inchikey14"))).where(F.col("k").isNotNull())
    p = universe.provenance(t, "k", "ingest_lib", "row_offset")
    return p.select(F.col("k").alias("connectivity_key"), F.array_join("sources", ";").alias("sources"), F.size("source_ids").alias("n_ids"), "n_records")


def q47_filters_with_reasons(spark: SparkSession, d: str) -> DataFrame:
    m = D.table(spark, d, "molecule_metadata")
    f = universe.apply_filters(m, "exact_mass", "molecular_formula", "normalized_smiles", 350.0, 500.0, F.lit(False))
    return f.select("connectivity_key", "reject_reasons", "kept")


def q48_formula_elements(spark: SparkSession, d: str) -> DataFrame:
    m = D.table(spark, d, "molecule_metadata").where(F.col("molecular_formula").isNotNull())
    return m.groupBy(universe.element_class(F.col("molecular_formula")).alias("element_class"), universe.is_organic(F.col("molecular_formula")).alias("organic")).agg(F.count(F.lit(1)).alias("n"))


def q49_universe_ids(spark: SparkSession, d: str) -> DataFrame:
    t = D.table(spark, d, "molecule_metadata").select("connectivity_key", F.col("connectivity_key").alias("ord")).where(F.col("connectivity_key").isNotNull()).distinct()
    x = D.table(spark, d, "candidate_pool").where(F.col("candidate_connectivity_key").isNotNull()).select(F.col("candidate_connectivity_key").alias("connectivity_key"), F.col("candidate_connectivity_key").alias("ord")).distinct()
    u = universe.unify(t, x, "connectivity_key", "ord")
    return universe.dense_ids(u, "connectivity_key").select("connectivity_key", "trusted", F.col("candidate_id").cast("long").alias("candidate_id"))


def q50_formula_index(spark: SparkSession, d: str) -> DataFrame:
    m = D.table(spark, d, "molecule_metadata").where(F.col("molecular_formula").isNotNull())
    return m.groupBy("molecular_formula").agg(F.count(F.lit(1)).alias("n"), F.min("connectivity_key").alias("first_key"))


def q51_structure_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Structures whose sets of smiles substrings reach a similarity of 0.9."""
    m = D.table(spark, d, "molecule_metadata").withColumn("s", structures.smiles(F.col("normalized_smiles"))).where(F.col("s").isNotNull())
    m = m.groupBy("connectivity_key").agg(F.min("s").alias("s"))
    return universe.set_similarity(m, "connectivity_key", universe.shingles(F.col("s"), 5), 0.9).select("a", "b", R("similarity"))


def q51b_tanimoto_bits(spark: SparkSession, d: str) -> DataFrame:
    """Bit similarity of each structure with the one named in its InChIKey group's first smiles."""
    m = D.table(spark, d, "molecule_metadata").withColumn("s", structures.smiles(F.col("normalized_smiles"))).where(F.col("s").isNotNull())
    b = m.select("connectivity_key", "molecular_formula", universe.packed_bits(universe.shingles(F.col("s"))).alias("bits"))
    first = b.groupBy("molecular_formula").agg(F.min(F.struct("connectivity_key", "bits")).alias("f"))
    return b.join(first, "molecular_formula").select("connectivity_key", F.col("f.connectivity_key").alias("other"), F.round(universe.tanimoto(F.col("bits"), F.col("f.bits")), 6).alias("tanimoto"))


def q52_analog_topk(spark: SparkSession, d: str) -> DataFrame:
    """The three most similar train spectra of each test spectrum with the same polarity and a precursor within 20 Da, by
    binned cosine from 0.3."""
    sides = (("test", "spectrum_id"), ("train", "row_offset"))
    q, t = (blocks.blocks(D.table(spark, d, n), i, "ms2_mzs", "ms2_normalized_intensities", at=F.col("precursor_mz"), part=F.col("ionization_mode"), slot=10.0) for n, i in sides)
    s = blocks.similar(q, t, "q", "r", 0.300001, width=20.0, best=3).withColumn("cosine", F.round("cosine", 6))
    return ranking.rank_by_keys(s, [("cosine", False), ("r", True)], "q").where("rank <= 3").select(F.col("q").alias("spectrum_id"), F.col("r").alias("row_offset"), "cosine", "rank")


def q54_regimes(spark: SparkSession, d: str) -> DataFrame:
    k = _train(spark, d, "inchikey14", "ingest_lib").withColumn("k", structures.inchikey14(F.col("inchikey14"))).where(F.col("k").isNotNull()).groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("ingest_lib").alias("libs"))
    k = k.withColumns({"e1": F.lit(True), "e2": F.col("n") >= 3, "e3": F.col("libs") >= 2})
    return statistics.regimes(k, "k", ["e1", "e2", "e3"], [0.5, 0.3, 0.2], "r1").select(F.col("k").alias("connectivity_key"), "regime")


def q55_fold_leakage(spark: SparkSession, d: str) -> DataFrame:
    """Structures that a fold by hash of the smiles would tear apart."""
    t = _train(spark, d, "inchikey14", "normalized_smiles").select(structures.inchikey14(F.col("inchikey14")).alias("k"), structures.smiles(F.col("normalized_smiles")).alias("s")).dropna()
    f = statistics.hash_folds(t, "s", 5, "f1")
    return statistics.leaked_groups(f, "k", "fold").select(F.col("k").alias("connectivity_key"), "folds")


def q56_weighted_prefix(spark: SparkSession, d: str) -> DataFrame:
    p = D.table(spark, d, "part").withColumn("w", F.col("p_size").cast("double"))
    o = statistics.weighted_order(p, "p_partkey", "w", "w1").withColumn("draw", F.round("draw", 9))
    return o.orderBy("draw", "p_partkey").limit(100).select("p_partkey", "draw")


def q57_stratified_sample(spark: SparkSession, d: str) -> DataFrame:
    return statistics.stratified_sample(D.table(spark, d, "orders"), "o_orderpriority", "o_orderkey", 500, "s1").select("o_orderkey", "o_orderpriority")


def q58_cluster_bootstrap(spark: SparkSession, d: str) -> DataFrame:
    b = statistics.cluster_bootstrap(D.table(spark, d, "orders"), "o_totalprice", "o_custkey", 20, "b1")
    return b.select("round", R("mean", 4))


def q59_parity(spark: SparkSession, d: str) -> DataFrame:
    """The candidate pool's masses against the molecule table."""
    a = D.table(spark, d, "candidate_pool").where(F.col("candidate_connectivity_key").isNotNull()).groupBy(F.col("candidate_connectivity_key").alias("k")).agg(F.round(F.min("candidate_exact_mass"), 3).alias("mass"))
    b = D.table(spark, d, "molecule_metadata").where(F.col("connectivity_key").isNotNull()).groupBy(F.col("connectivity_key").alias("k")).agg(F.round(F.min("exact_mass"), 3).alias("mass"))
    return quality.parity(a, b, ["k"], ["mass"], 0.0015)


def q62_dq_profile(spark: SparkSession, d: str) -> DataFrame:
    p = quality.profile(D.table(spark, d, "candidate_pool").select("query_id", "molecule_id", "score", "is_true_candidate", "abs_mass_error_ppm"))
    return p.select("column", "n", "nulls", "nans")


def q63_energy_summary(spark: SparkSession, d: str) -> DataFrame:
    t = _train(spark, d, "collision_energy_ev")
    e = spectra.energies(F.col("collision_energy_ev"))
    return t.select("row_offset", F.col("row_offset").isNotNull().alias("known"), e["ce_n"].alias("ce_n"), F.round(e["ce_mean"], 6).alias("ce_mean"), e["ce_min"].alias("ce_min"), e["ce_max"].alias("ce_max"))


def q64_disjointness(spark: SparkSession, d: str) -> DataFrame:
    """Structures of the libraries that several libraries share, per pair of libraries."""
    t = _train(spark, d, "inchikey14", "ingest_lib").select(structures.inchikey14(F.col("inchikey14")).alias("k"), "ingest_lib").dropna().distinct()
    return t.withColumnRenamed("ingest_lib", "a").join(t.withColumnRenamed("ingest_lib", "b"), "k").where("a < b").groupBy("a", "b").agg(F.count(F.lit(1)).alias("shared"))


def q65_auc(spark: SparkSession, d: str) -> DataFrame:
    t = D.table(spark, d, "candidate_pool").where(F.col("is_true_candidate").isNotNull() & F.col("score").isNotNull()).withColumn("g", F.lit("all"))
    return statistics.auc(t, "score", "is_true_candidate", ["g"]).select("n_pos", "n_neg", R("auc"))


def q66_precursor_outliers(spark: SparkSession, d: str) -> DataFrame:
    o = statistics.robust_outliers(_train(spark, d, "base_peak_intensity").where(F.col("base_peak_intensity") > 0).where(~F.isnan("base_peak_intensity")), "base_peak_intensity", 2.0)
    return o.where("outlier").select("row_offset", R("robust_z"))


QUERIES = {k: v for k, v in list(globals().items()) if k.startswith("q") and callable(v)}

_SM = """(CASE WHEN lower({0}) NOT IN ('', '-', 'na', 'n/a', 'nan', 'none', 'null', 'unknown') THEN {0} END)""".format("""regexp_replace(normalized_smiles, '^[\\s\\x{00A0}"'']+|[\\s\\x{00A0}"'']+$', '', 'g')""")
_U = lambda k, seed: f"(('0x' || substr(md5('{seed}|' || ({k})::VARCHAR), 1, 13))::UBIGINT::DOUBLE / 4503599627370496.0)"
_SHIFT = """, n AS (SELECT sum(a) AS na, sum(b) AS nb FROM s), c AS (SELECT v, sum(a) OVER (ORDER BY v) / na AS fa, sum(b) OVER (ORDER BY v) / nb AS fb, lead(v) OVER (ORDER BY v) - v AS gap, na, nb FROM s, n)
 SELECT max(na)::BIGINT AS n_a, max(nb)::BIGINT AS n_b, round(max(abs(fa - fb)), 6) AS ks, round(sum(abs(fa - fb) * coalesce(gap, 0)), 6) AS wasserstein FROM c"""

ORACLE = {
    "q37_ks_wasserstein": "WITH s AS (SELECT n_chars::DOUBLE AS v, count(CASE WHEN lang = 'en' THEN 1 END) AS a, count(CASE WHEN lang = 'fr' THEN 1 END) AS b FROM documents WHERE lang IN ('en', 'fr') AND n_chars IS NOT NULL GROUP BY 1)" + _SHIFT,
    "q37b_ks_precursor": "WITH s AS (SELECT v, count(CASE WHEN side = 1 THEN 1 END) AS a, count(CASE WHEN side = 2 THEN 1 END) AS b FROM (SELECT 1 AS side, precursor_mz AS v FROM (SELECT DISTINCT row_offset, precursor_mz FROM train) UNION ALL SELECT 2, precursor_mz FROM (SELECT DISTINCT spectrum_id, precursor_mz FROM test)) WHERE v IS NOT NULL AND NOT isnan(v) GROUP BY 1)" + _SHIFT,
    "q38_js": """WITH c AS (SELECT source, count(CASE WHEN lang = 'en' THEN 1 END) AS a, count(CASE WHEN lang = 'de' THEN 1 END) AS b FROM documents WHERE source IS NOT NULL AND lang IN ('en', 'de') GROUP BY 1), s AS (SELECT a / sum(a) OVER () AS p, b / sum(b) OVER () AS q FROM c)
 SELECT count(*) AS n_categories, round(sqrt(sum(CASE WHEN p > 0 THEN p * log2(p / ((p + q) / 2)) ELSE 0 END + CASE WHEN q > 0 THEN q * log2(q / ((p + q) / 2)) ELSE 0 END) / 2), 6) AS js_distance, round(sum(abs(p - q)) / 2, 6) AS tv_distance FROM s""",
    "q39_weighted_ks": """WITH s AS (SELECT l_linestatus, l_extendedprice AS v, sum(CASE WHEN l_returnflag = 'A' THEN l_quantity ELSE 0 END) AS a, sum(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0 END) AS b, count(CASE WHEN l_returnflag = 'A' THEN 1 END) AS na, count(CASE WHEN l_returnflag = 'R' THEN 1 END) AS nb FROM lineitem WHERE l_returnflag IN ('A', 'R') AND l_quantity > 0 GROUP BY 1, 2),
 d AS (SELECT *, abs(sum(a) OVER o / sum(a) OVER w - sum(b) OVER o / sum(b) OVER w) AS d FROM s WINDOW w AS (PARTITION BY l_linestatus), o AS (PARTITION BY l_linestatus ORDER BY v)) SELECT l_linestatus, sum(na)::BIGINT AS n_a, sum(nb)::BIGINT AS n_b, round(max(d), 6) AS ks FROM d GROUP BY 1 HAVING sum(na) >= 20 AND sum(nb) >= 20""",
    "q76_pair_dataset": f"""WITH t AS (SELECT row_offset AS i, k, m, a, {_U('i', 'p1')} AS u FROM (SELECT DISTINCT row_offset AS i, row_offset, {D.IK} AS k, ionization_mode AS m, adduct AS a FROM train) WHERE k IS NOT NULL),
 n AS (SELECT i, k, lead(i) OVER (PARTITION BY k ORDER BY u, i) AS p, lead(i) OVER c AS q, lead(k) OVER c AS qk FROM t WINDOW c AS (PARTITION BY m, a ORDER BY u, i))
 SELECT i AS anchor, p AS other, 'positive' AS kind FROM n WHERE p IS NOT NULL UNION ALL SELECT i, q, 'negative' FROM n WHERE q IS NOT NULL AND qk <> k""",
    "q40_weighted_quantile": "WITH s AS (SELECT l_returnflag, l_extendedprice AS v, sum(l_quantity) AS w FROM lineitem WHERE l_quantity > 0 GROUP BY 1, 2), r AS (SELECT *, sum(w) OVER (PARTITION BY l_returnflag ORDER BY v) / sum(w) OVER (PARTITION BY l_returnflag) AS run FROM s) SELECT l_returnflag, min(v) AS quantile FROM r WHERE run >= 0.9 - 1e-12 GROUP BY 1",
    "q41_cell_reweight": "WITH p AS (SELECT adduct, count(*) AS np FROM (SELECT DISTINCT row_offset, adduct FROM train) WHERE adduct IS NOT NULL GROUP BY 1), t AS (SELECT adduct, count(*) AS nt FROM (SELECT DISTINCT spectrum_id, adduct FROM test) WHERE adduct IS NOT NULL GROUP BY 1) SELECT adduct, round(least(greatest((coalesce(nt, 0) / (SELECT sum(nt) FROM t)) / (np / (SELECT sum(np) FROM p)), 0.1), 10.0), 6) AS weight FROM p LEFT JOIN t USING (adduct)",
    "q43_stratified_rollup": "SELECT ionization_mode, ingest_lib, grouping_id(ionization_mode, ingest_lib)::INT AS level, count(*) AS n, round(avg(num_peaks), 6) AS mean_peaks FROM (SELECT DISTINCT row_offset, ionization_mode, ingest_lib, num_peaks FROM train) GROUP BY ROLLUP (ionization_mode, ingest_lib)",
    "q45_consensus_mode": f"WITH c AS (SELECT k, adduct, count(*) AS n FROM (SELECT DISTINCT row_offset, {D.IK} AS k, adduct FROM train) WHERE k IS NOT NULL AND adduct IS NOT NULL GROUP BY 1, 2) SELECT k AS connectivity_key, adduct, round(n / t, 6) AS share FROM (SELECT *, sum(n) OVER (PARTITION BY k) AS t, row_number() OVER (PARTITION BY k ORDER BY n DESC, adduct) AS r FROM c) WHERE r = 1",
    "q46_provenance": f"SELECT k AS connectivity_key, coalesce(string_agg(DISTINCT ingest_lib, ';' ORDER BY ingest_lib), '') AS sources, count(DISTINCT concat_ws(':', ingest_lib, row_offset::VARCHAR))::INT AS n_ids, count(*) AS n_records FROM (SELECT DISTINCT row_offset, {D.IK} AS k, ingest_lib FROM train) WHERE k IS NOT NULL GROUP BY 1",
    "q47_filters_with_reasons": r"""WITH e AS (SELECT *, list_distinct(regexp_extract_all(molecular_formula, '[A-Z][a-z]?')) AS el, regexp_extract_all(normalized_smiles, '\[[^\]+-]*(\++[0-9]*|-+[0-9]*)(?::[0-9]+)?\]', 1) AS ch FROM molecule_metadata),
 f AS (SELECT *, coalesce(list_sum(list_transform(ch, lambda c: CASE WHEN c[1] = '-' THEN -1 ELSE 1 END * CASE WHEN regexp_matches(c, '[0-9]') THEN regexp_extract(c, '[0-9]+')::INT ELSE len(c) END)), 0) AS z FROM e),
 r AS (SELECT connectivity_key, concat_ws(';', CASE WHEN NOT coalesce(exact_mass >= 350 AND exact_mass <= 500, false) THEN 'mass_out_of_range' END, CASE WHEN NOT coalesce(len(el) > 0 AND list_contains(el, 'C') AND len(list_filter(el, lambda x: NOT list_contains(['C', 'H', 'N', 'O', 'S', 'P', 'F', 'Cl', 'Br', 'I', 'Si', 'B', 'Se'], x))) = 0, false) THEN 'not_organic' END,
  CASE WHEN normalized_smiles IS NULL OR z <> 0 THEN 'charged' END, CASE WHEN normalized_smiles IS NULL OR contains(normalized_smiles, '.') THEN 'multi_component' END) AS reject_reasons FROM f) SELECT *, reject_reasons = '' AS kept FROM r""",
    "q48_formula_elements": """WITH e AS (SELECT list_distinct(regexp_extract_all(molecular_formula, '[A-Z][a-z]?')) AS el FROM molecule_metadata WHERE molecular_formula IS NOT NULL)
 SELECT CASE WHEN len(el) = 0 THEN 'unknown' ELSE concat(CASE WHEN list_contains(el, 'C') THEN 'C' ELSE '' END, CASE WHEN list_contains(el, 'H') THEN 'H' ELSE '' END, CASE WHEN list_contains(el, 'N') THEN 'N' ELSE '' END, CASE WHEN list_contains(el, 'O') THEN 'O' ELSE '' END, CASE WHEN list_contains(el, 'S') THEN 'S' ELSE '' END, CASE WHEN list_contains(el, 'P') THEN 'P' ELSE '' END, CASE WHEN list_has_any(el, ['F', 'Cl', 'Br', 'I']) THEN '+X' ELSE '' END,
  CASE WHEN len(list_filter(el, lambda x: NOT list_contains(['C', 'H', 'N', 'O', 'S', 'P', 'F', 'Cl', 'Br', 'I'], x))) > 0 THEN '+other' ELSE '' END) END AS element_class,
  len(el) > 0 AND list_contains(el, 'C') AND len(list_filter(el, lambda x: NOT list_contains(['C', 'H', 'N', 'O', 'S', 'P', 'F', 'Cl', 'Br', 'I', 'Si', 'B', 'Se'], x))) = 0 AS organic, count(*) AS n FROM e GROUP BY 1, 2""",
    "q49_universe_ids": "WITH u AS (SELECT connectivity_key, bool_or(t) AS trusted FROM (SELECT connectivity_key, true AS t FROM molecule_metadata UNION ALL SELECT candidate_connectivity_key, false FROM candidate_pool) WHERE connectivity_key IS NOT NULL GROUP BY 1) SELECT *, row_number() OVER (ORDER BY connectivity_key) - 1 AS candidate_id FROM u",
    "q50_formula_index": "SELECT molecular_formula, count(*) AS n, min(connectivity_key) AS first_key FROM molecule_metadata WHERE molecular_formula IS NOT NULL GROUP BY 1",
    "q51_structure_pairs": f"""WITH m AS (SELECT connectivity_key AS k, min(s) AS s FROM (SELECT connectivity_key, {_SM} AS s FROM molecule_metadata) WHERE s IS NOT NULL GROUP BY 1), t AS (SELECT DISTINCT k, CASE WHEN length(s) >= 5 THEN substr(s, i, 5) ELSE s END AS g FROM m, range(1, 10000) r(i) WHERE i <= greatest(length(s) - 4, 1)), n AS (SELECT k, count(*) AS n FROM t GROUP BY 1),
 c AS (SELECT x.k AS a, y.k AS b, count(*) AS c FROM t x JOIN t y ON x.g = y.g AND x.k < y.k GROUP BY 1, 2) SELECT a, b, round(c / (p.n + q.n - c), 6) AS similarity FROM c JOIN n p ON p.k = a JOIN n q ON q.k = b WHERE c / (p.n + q.n - c) >= 0.9""",
    "q54_regimes": f"""WITH k AS (SELECT k, count(*) AS n, count(DISTINCT ingest_lib) AS l FROM (SELECT DISTINCT row_offset, {D.IK} AS k, ingest_lib FROM train) WHERE k IS NOT NULL GROUP BY 1), u AS (SELECT *, {_U('k', 'r1')} AS u, 0.5 + CASE WHEN n >= 3 THEN 0.3 ELSE 0 END + CASE WHEN l >= 2 THEN 0.2 ELSE 0 END AS t FROM k)
 SELECT k AS connectivity_key, CASE WHEN u * t < 0.5 THEN 'C1' WHEN n >= 3 AND u * t < 0.5 + 0.3 THEN 'C2' WHEN l >= 2 THEN 'C3' ELSE 'C2' END AS regime FROM u""",
    "q55_fold_leakage": f"WITH t AS (SELECT k, floor({_U('s', 'f1')} * 5) AS f FROM (SELECT DISTINCT row_offset, {D.IK} AS k, {_SM} AS s FROM train) WHERE k IS NOT NULL AND s IS NOT NULL) SELECT k AS connectivity_key, count(DISTINCT f) AS folds FROM t GROUP BY 1 HAVING count(DISTINCT f) > 1",
    "q56_weighted_prefix": f"SELECT p_partkey, round(-ln(greatest({_U('p_partkey', 'w1')}, 1e-15)) / p_size, 9) AS draw FROM part WHERE p_size > 0 ORDER BY draw, p_partkey LIMIT 100",
    "q57_stratified_sample": f"""WITH z AS (SELECT o_orderpriority AS s, count(*) AS n FROM orders GROUP BY 1), q AS (SELECT s, n, floor(n * 500 / sum(n) OVER ()) AS base, n * 500 / sum(n) OVER () - floor(n * 500 / sum(n) OVER ()) AS rest FROM z), g AS (SELECT s, base + (row_number() OVER (ORDER BY rest DESC, s) <= 500 - sum(base) OVER ())::INT AS quota FROM q)
 SELECT o_orderkey, o_orderpriority FROM (SELECT *, row_number() OVER (PARTITION BY o_orderpriority ORDER BY {_U('o_orderkey', 's1')}, o_orderkey) AS r FROM orders) o JOIN g ON g.s = o_orderpriority WHERE r <= quota""",
    "q58_cluster_bootstrap": f"""WITH s AS (SELECT o_custkey, sum(o_totalprice) AS s, count(*) AS n FROM orders WHERE o_totalprice IS NOT NULL GROUP BY 1), c AS (SELECT s, n, r AS round, {_U("o_custkey::VARCHAR || '|' || r::VARCHAR", 'b1')} AS u FROM s, range(20) g(r)),
 p(k, e) AS (SELECT k, exp(-1) * sum(1.0::DOUBLE / factorial(j::INT)) FROM range(8) a(k), range(8) b(j) WHERE j <= k GROUP BY 1) SELECT round::INT AS round, round(sum(w * s) / sum(w * n), 4) AS mean FROM (SELECT c.*, (SELECT count(*) FROM p WHERE c.u >= p.e) AS w FROM c) GROUP BY 1""",
    "q59_parity": """WITH a AS (SELECT candidate_connectivity_key AS k, round(min(candidate_exact_mass), 3) AS m FROM candidate_pool WHERE candidate_connectivity_key IS NOT NULL GROUP BY 1), b AS (SELECT connectivity_key AS k, round(min(exact_mass), 3) AS m FROM molecule_metadata WHERE connectivity_key IS NOT NULL GROUP BY 1)
 SELECT count(CASE WHEN b.k IS NULL THEN 1 END) AS only_a, count(CASE WHEN a.k IS NULL THEN 1 END) AS only_b, count(CASE WHEN a.k IS NOT NULL AND b.k IS NOT NULL THEN 1 END) AS both, count(CASE WHEN a.k IS NOT NULL AND b.k IS NOT NULL AND NOT (a.m IS NOT DISTINCT FROM b.m OR coalesce(abs(a.m - b.m) <= 0.0015, false)) THEN 1 END) AS differs_mass FROM a FULL JOIN b ON a.k = b.k""",
    "q62_dq_profile": " UNION ALL ".join(f"SELECT '{c}' AS \"column\", count(*) AS n, count(*) - count({c}) AS nulls, {f'count(CASE WHEN isnan({c}) THEN 1 END)' if c in ('score', 'abs_mass_error_ppm') else '0::BIGINT'} AS nans FROM candidate_pool" for c in ("query_id", "molecule_id", "score", "is_true_candidate", "abs_mass_error_ppm")),
    "q63_energy_summary": "WITH t AS (SELECT DISTINCT row_offset, list_filter(collision_energy_ev, lambda x: x IS NOT NULL AND NOT isnan(x)) AS v FROM train) SELECT row_offset, true AS known, coalesce(len(v), 0)::INT AS ce_n, CASE WHEN len(v) > 0 THEN round(list_sum(v) / len(v), 6) END AS ce_mean, list_min(v) AS ce_min, list_max(v) AS ce_max FROM t",
    "q64_disjointness": f"WITH t AS (SELECT DISTINCT {D.IK} AS k, ingest_lib FROM train WHERE ingest_lib IS NOT NULL) SELECT x.ingest_lib AS a, y.ingest_lib AS b, count(*) AS shared FROM t x JOIN t y ON x.k = y.k AND x.ingest_lib < y.ingest_lib WHERE x.k IS NOT NULL GROUP BY 1, 2",
    "q65_auc": "WITH s AS (SELECT score, count(CASE WHEN is_true_candidate THEN 1 END) AS p, count(CASE WHEN NOT is_true_candidate THEN 1 END) AS n FROM candidate_pool WHERE is_true_candidate IS NOT NULL AND score IS NOT NULL AND NOT isnan(score) GROUP BY 1), u AS (SELECT p, n, p * (sum(n) OVER (ORDER BY score) - n + n / 2) AS u FROM s) SELECT sum(p)::BIGINT AS n_pos, sum(n)::BIGINT AS n_neg, round(sum(u) / (sum(p) * sum(n)), 6) AS auc FROM u",
    "q66_precursor_outliers": """WITH t AS (SELECT DISTINCT row_offset, log10(base_peak_intensity) AS x FROM train WHERE base_peak_intensity > 0 AND NOT isnan(base_peak_intensity)), m AS (SELECT median(x) AS med FROM t), a AS (SELECT med, median(abs(x - med)) AS mad FROM t, m GROUP BY 1)
 SELECT row_offset, round((x - med) / (mad * 1.4826), 6) AS robust_z FROM t, a WHERE abs((x - med) / (mad * 1.4826)) > 2.0""",
    "q52_analog_topk": """WITH tp AS (SELECT spectrum_id AS id, ionization_mode AS mode, precursor_mz AS p, unnest(ms2_mzs) AS m, unnest(ms2_normalized_intensities) AS i FROM (SELECT DISTINCT spectrum_id, ionization_mode, precursor_mz, ms2_mzs, ms2_normalized_intensities FROM test WHERE precursor_mz > 0) WHERE len(ms2_mzs) = len(ms2_normalized_intensities)),
 rp AS (SELECT row_offset AS id, ionization_mode AS mode, precursor_mz AS p, unnest(ms2_mzs) AS m, unnest(ms2_normalized_intensities) AS i FROM (SELECT DISTINCT row_offset, ionization_mode, precursor_mz, ms2_mzs, ms2_normalized_intensities FROM train WHERE precursor_mz > 0) WHERE len(ms2_mzs) = len(ms2_normalized_intensities)),
 tb0 AS (SELECT id, mode, p, floor(m / 0.1)::BIGINT AS bin, sum(i) AS v FROM tp WHERE m IS NOT NULL AND i IS NOT NULL AND isfinite(m) AND isfinite(i) AND m >= 0 AND i >= 0 GROUP BY 1, 2, 3, 4), rb0 AS (SELECT id, mode, p, floor(m / 0.1)::BIGINT AS bin, sum(i) AS v FROM rp WHERE m IS NOT NULL AND i IS NOT NULL AND isfinite(m) AND isfinite(i) AND m >= 0 AND i >= 0 GROUP BY 1, 2, 3, 4),
 tb AS (SELECT id, mode, p, bin, v / sqrt(sum(v * v) OVER (PARTITION BY id)) AS w FROM tb0 QUALIFY sum(v * v) OVER (PARTITION BY id) > 0), rb AS (SELECT id, mode, p, bin, v / sqrt(sum(v * v) OVER (PARTITION BY id)) AS w FROM rb0 QUALIFY sum(v * v) OVER (PARTITION BY id) > 0),
 s AS (SELECT tb.id AS q, rb.id AS r, sum(tb.w * rb.w) AS c FROM tb JOIN rb ON tb.bin = rb.bin AND tb.mode = rb.mode AND abs(tb.p - rb.p) <= 20.0 GROUP BY 1, 2 HAVING sum(tb.w * rb.w) >= 0.300001)
 SELECT * FROM (SELECT q AS spectrum_id, r AS row_offset, round(c, 6) AS cosine, row_number() OVER (PARTITION BY q ORDER BY round(c, 6) DESC, r) AS rank FROM s) WHERE rank <= 3""",
}
