"""From rankings of spectra to one ranking per molecule: aggregators A1 to A8, cut and submission."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

# Names of the aggregators.
AGGREGATORS = ("A1_max_score", "A2_max_prob", "A3_mean_prob", "A4_sum_log_prob", "A5_logmeanexp_present", "A6_rrf", "A7_most_confident_spectrum", "A8_first_spectrum")


def with_spectra(df: DataFrame, molecule: str, spectrum: str) -> DataFrame:
    """df with n_spectra, the number of the molecule's spectra."""
    n = df.groupBy(F.col(molecule).alias("m__")).agg(F.count_distinct(spectrum).alias("n_spectra"))
    return df.join(n, F.col(molecule) == F.col("m__")).drop("m__")


def aggregate(df: DataFrame, name: str, molecule: str = "molecule_id", spectrum: str = "spectrum_id", candidate: str = "candidate", k: int = 60, eps: float = 1e-6) -> DataFrame:
    """molecule, candidate, agg_score, secondary, mol_rank. df holds score, prob, rank and abs_mass_error_ppm per spectrum
    and candidate. Ties: secondary ascending (mean mass error; for A6 the best rank), then the candidate."""
    if name not in AGGREGATORS:
        raise ValueError(f"unknown aggregator {name}")
    keys = [molecule, candidate]
    if name in ("A7_most_confident_spectrum", "A8_first_spectrum"):
        if name.startswith("A7"):
            best = df.groupBy(molecule, spectrum).agg(F.max("prob").alias("p")).groupBy(molecule).agg(F.max_by(spectrum, F.struct("p", F.lit(0))).alias("x__"), F.max("p").alias("p"))
            tops = df.groupBy(molecule, spectrum).agg(F.max("prob").alias("p__"))
            best = best.select(F.col(molecule).alias("m__"), "p").join(tops, (F.col("m__") == F.col(molecule)) & (F.col("p") == F.col("p__"))).groupBy("m__").agg(F.min(F.col(spectrum).cast("string")).alias("s__"))
        else:
            best = df.groupBy(F.col(molecule).alias("m__")).agg(F.min(F.col(spectrum).cast("string")).alias("s__"))
        rows = df.join(best, (F.col(molecule) == F.col("m__")) & (F.col(spectrum).cast("string") == F.col("s__")))
        out = rows.groupBy(*keys).agg(F.max("prob").alias("agg_score"), F.min("abs_mass_error_ppm").alias("secondary"))
    else:
        score: dict[str, Column] = {
            "A1_max_score": F.max("score"), "A2_max_prob": F.max("prob"), "A3_mean_prob": F.sum("prob") / F.max("n_spectra"),
            "A4_sum_log_prob": F.sum(F.log(F.greatest(F.col("prob"), F.lit(eps)))) + (F.max("n_spectra") - F.count(F.lit(1))) * F.log(F.lit(eps)),
            "A5_logmeanexp_present": F.log(F.greatest(F.avg("prob"), F.lit(1e-300))), "A6_rrf": F.sum(1.0 / (k + F.col("rank"))),
        }
        rows = with_spectra(df, molecule, spectrum) if name in ("A3_mean_prob", "A4_sum_log_prob") else df
        second = F.min("rank").cast("double") if name == "A6_rrf" else F.avg("abs_mass_error_ppm")
        out = rows.groupBy(*keys).agg(score[name].alias("agg_score"), second.alias("secondary"))
    # sums of doubles may differ in the last bits by the order of rows; ties are decided on nine decimals
    w = W.partitionBy(molecule).orderBy(F.desc(F.round("agg_score", 9)), F.round("secondary", 9).asc_nulls_last(), candidate)
    return out.withColumn("mol_rank", F.row_number().over(w))


def model_scored_only(df: DataFrame, molecule: str = "molecule_id", flag: str = "model_scored") -> DataFrame:
    """Rows of the fallback ranking are dropped where the molecule has any row that a model scored."""
    w = W.partitionBy(molecule)
    return df.withColumn("any__", F.max(F.col(flag).cast("int")).over(w)).where((F.col("any__") == 0) | F.col(flag)).drop("any__")


def submission(ranking: DataFrame, smiles: DataFrame, molecule: str = "molecule_id", candidate: str = "candidate", k: int = 25) -> DataFrame:
    """molecule, smiles: the first k distinct structures joined by semicolons; candidates without a structure are skipped."""
    known = ranking.join(smiles, candidate).where(F.col("smiles").isNotNull())
    first = known.groupBy(molecule, "smiles").agg(F.min("mol_rank").alias("r"))
    first = first.withColumn("n__", F.row_number().over(W.partitionBy(molecule).orderBy("r", "smiles"))).where(F.col("n__") <= k)
    lists = F.array_sort(F.collect_list(F.struct("n__", "smiles")))  # at most k items
    return first.groupBy(molecule).agg(F.array_join(F.transform(lists, lambda x: x["smiles"]), ";").alias("smiles"))


def support(pool: DataFrame, molecule: str, candidate: str, spectrum: str) -> DataFrame:
    """Per molecule and candidate: spectra in which it is a candidate, least and mean mass error."""
    return pool.groupBy(molecule, candidate).agg(F.count_distinct(spectrum).alias("n_spectra"), F.min("abs_mass_error_ppm").alias("min_ppm"), F.avg("abs_mass_error_ppm").alias("mean_ppm"))


def support_summary(per: DataFrame, spectra: DataFrame, molecule: str) -> DataFrame:
    """Union and intersection sizes of a molecule's pools, candidates seen once and more often; spectra has n_total."""
    n = F.col("n_spectra")
    return spectra.join(per, molecule, "left").groupBy(molecule).agg(
        F.count(n).alias("union_size"), F.count_if(n == F.col("n_total")).alias("intersection_size"), F.count_if(n == 1).alias("seen_once"), F.count_if(n > 1).alias("seen_multi")
    )
