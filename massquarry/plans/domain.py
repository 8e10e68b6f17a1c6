"""Views of the tables that the queries share, and the same as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from massquarry.functions import adducts, structures
from massquarry.operators import spectra, universe
from massquarry.workspace import stage


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def with_mass(df: DataFrame) -> DataFrame:
    """df with neutral_mass and adduct_supported; unsupported adducts use that of the ionization mode.

    Each distinct adduct is parsed once, into a staged table: later expressions over the mass are plain arithmetic, and
    the planner broadcasts the table if its files are small."""
    defaults = df.sparkSession.createDataFrame([("[M+H]+",), ("[M-H]-",)], "adduct string")
    names = df.select("adduct").where(F.col("adduct").isNotNull()).unionByName(defaults).distinct()
    parsed = stage(names.withColumn("p", adducts.parse_adduct(F.col("adduct"))).where("p.supported"), "adducts")
    own = parsed.select(F.col("adduct").alias("a__"), F.col("p").alias("p__"))
    other = parsed.where(F.col("adduct").isin("[M+H]+", "[M-H]-")).select(F.col("adduct").alias("b__"), F.col("p").alias("q__"))
    df = df.join(own, F.col("adduct") == F.col("a__"), "left").join(F.broadcast(other), adducts.polarity_default(F.col("ionization_mode")) == F.col("b__"), "left")  # two rows
    mz = F.when(F.col("precursor_mz") > 0, F.col("precursor_mz"))
    mass = adducts.neutral_mass(mz, F.coalesce("p__", "q__"))
    return df.withColumns({"neutral_mass": mass, "adduct_supported": F.col("a__").isNotNull()}).drop("a__", "b__", "p__", "q__")


def train_queries(spark: SparkSession, d: str) -> DataFrame:
    """One row per train record: query_id, true_key, neutral_mass and its strata."""
    t = table(spark, d, "train").select("row_offset", "inchikey14", "adduct", "ionization_mode", "instrument_type", "ingest_lib", "precursor_mz").dropDuplicates(["row_offset"])
    t = with_mass(t).withColumns({"query_id": F.col("row_offset"), "true_key": structures.inchikey14(F.col("inchikey14")), "instrument": structures.instrument(F.col("instrument_type"))})
    return t.select("query_id", "true_key", "adduct", "ionization_mode", "instrument", "ingest_lib", "precursor_mz", "neutral_mass", "adduct_supported")


def test_queries(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "test").select("spectrum_id", "molecule_id", "eval_set", "adduct", "ionization_mode", "instrument_type", "precursor_mz").dropDuplicates(["spectrum_id"])
    return with_mass(t).withColumnRenamed("spectrum_id", "query_id").drop("instrument_type")


def library(spark: SparkSession, d: str) -> DataFrame:
    """Mass variants: mass_variant_id, connectivity_key, exact_mass."""
    return universe.mass_variants(table(spark, d, "molecule_metadata"), "connectivity_key", "exact_mass")


def pool(spark: SparkSession, d: str) -> DataFrame:
    """The scored candidate pool: one row per query and candidate, with the highest score and the least mass error."""
    p = table(spark, d, "candidate_pool").where(F.col("candidate_connectivity_key").isNotNull())
    s = F.when(~F.isnan("score"), F.col("score"))
    return p.groupBy("query_id", F.col("candidate_connectivity_key").alias("candidate")).agg(
        F.max(s).alias("score"), F.min("abs_mass_error_ppm").alias("abs_mass_error_ppm"), F.coalesce(F.bool_or("is_true_candidate"), F.lit(False)).alias("is_true_candidate")
    )


def test_spectra(spark: SparkSession, d: str) -> DataFrame:
    """One row per test spectrum with cleaned peaks."""
    t = table(spark, d, "test").dropDuplicates(["spectrum_id"])
    return t.withColumn("peaks", spectra.peaks(F.col("ms2_mzs"), F.col("ms2_normalized_intensities")))


def molecule_rankings(spark: SparkSession, d: str) -> DataFrame:
    """Per spectrum rankings of the test molecules with calibrated probabilities, from the candidate pool."""
    from massquarry.operators import ranking

    m = table(spark, d, "test").select(F.col("spectrum_id").alias("s__"), "molecule_id").where(F.col("molecule_id").isNotNull()).distinct()
    p = pool(spark, d).where(F.col("score").isNotNull()).join(m, F.col("query_id") == F.col("s__")).select("molecule_id", F.col("query_id").alias("spectrum_id"), "candidate", "score", "abs_mass_error_ppm")
    p = ranking.rank_by_keys(p, [("score", False), ("abs_mass_error_ppm", True), ("candidate", True)], "spectrum_id")
    return ranking.softmax(p, "score", "spectrum_id", 0.25)


ADDUCTS = """adducts(adduct, n, z, shift) AS (VALUES
 ('[M+H]+', 1, 1, 1.0078250319::DOUBLE - 0.00054858), ('[M-H]-', 1, 1, -1.0078250319::DOUBLE + 0.00054858), ('[M+Na]+', 1, 1, 22.98976928::DOUBLE - 0.00054858),
 ('[M+NH4]+', 1, 1, 14.0030740052::DOUBLE + 4 * 1.0078250319::DOUBLE - 0.00054858), ('[M+2H]2+', 1, 2, 2 * 1.0078250319::DOUBLE - 2 * 0.00054858),
 ('[M+CH2O2-H]-', 1, 1, 12.0::DOUBLE + 2 * 1.0078250319::DOUBLE + 2 * 15.9949146221::DOUBLE - 1.0078250319::DOUBLE + 0.00054858), ('[2M+H]+', 2, 1, 1.0078250319::DOUBLE - 0.00054858),
 ('[M+Cl]-', 1, 1, 34.96885268::DOUBLE + 0.00054858), ('[M+K]+', 1, 1, 38.9637069::DOUBLE - 0.00054858), ('[M+3H]3+', 1, 3, 3 * 1.0078250319::DOUBLE - 3 * 0.00054858),
 ('[M-2H]2-', 1, 2, -2 * 1.0078250319::DOUBLE + 2 * 0.00054858))"""

_MASS = """CASE WHEN precursor_mz > 0 THEN (precursor_mz * a.z - a.shift) / a.n END"""


def _queries(name: str, id_col: str, extra: str, source: str) -> str:
    return f"""{name} AS (SELECT t.{id_col} AS query_id, {extra}, t.precursor_mz, {_MASS} AS neutral_mass, a0.adduct IS NOT NULL AS adduct_supported
 FROM (SELECT DISTINCT {id_col}, {source}, adduct, ionization_mode, precursor_mz FROM {'train' if id_col == 'row_offset' else 'test'}) t
 LEFT JOIN adducts a0 ON a0.adduct = t.adduct
 LEFT JOIN adducts a ON a.adduct = coalesce(a0.adduct, CASE WHEN lower(ionization_mode) LIKE 'pos%' THEN '[M+H]+' WHEN lower(ionization_mode) LIKE 'neg%' THEN '[M-H]-' END))"""


IK = """nullif(regexp_extract(upper(regexp_replace(inchikey14, '^[\\s\\x{00A0}"'']+|[\\s\\x{00A0}"'']+$', '', 'g')), '^(INCHIKEY=)?([A-Z]{14})(-.*)?$', 2), '')"""
TRAIN = _queries("trainq", "row_offset", f"{IK} AS true_key, t.adduct, t.ionization_mode, upper(regexp_replace(instrument_type, '[^A-Za-z0-9]', '', 'g')) AS instrument, ingest_lib", "inchikey14, instrument_type, ingest_lib")
TEST = _queries("testq", "spectrum_id", "molecule_id, eval_set, t.adduct, t.ionization_mode", "molecule_id, eval_set")
LIB = """lib AS (SELECT connectivity_key, exact_mass, n_spectra, connectivity_key || '__v' || (row_number() OVER (PARTITION BY connectivity_key ORDER BY exact_mass) - 1) AS mass_variant_id,
  count(*) OVER (PARTITION BY connectivity_key) > 1 AS is_isotope_variant
 FROM (SELECT connectivity_key, floor(exact_mass * 1e5 + 0.5) / 1e5 AS exact_mass, count(*) AS n_spectra FROM molecule_metadata WHERE connectivity_key IS NOT NULL AND exact_mass IS NOT NULL AND NOT isnan(exact_mass) GROUP BY ALL))"""
POOL = """pool AS (SELECT query_id, candidate_connectivity_key AS candidate, max(CASE WHEN NOT isnan(score) THEN score END) AS score, min(abs_mass_error_ppm) AS abs_mass_error_ppm,
  coalesce(bool_or(is_true_candidate), false) AS is_true_candidate FROM candidate_pool WHERE candidate_connectivity_key IS NOT NULL GROUP BY 1, 2)"""


def window(queries: str, ppm: str) -> str:
    """SQL of a window join with the library."""
    return f"""hits AS (SELECT q.*, l.mass_variant_id, l.connectivity_key, l.exact_mass, l.exact_mass - q.neutral_mass AS mass_error_da, abs((l.exact_mass - q.neutral_mass) / q.neutral_mass * 1e6) AS abs_mass_error_ppm
 FROM {queries} q JOIN lib l ON l.exact_mass >= q.neutral_mass - q.neutral_mass * {ppm} * 1e-6 AND l.exact_mass <= q.neutral_mass + q.neutral_mass * {ppm} * 1e-6 WHERE q.neutral_mass > 0)"""
