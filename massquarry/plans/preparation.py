"""Queries of the general preparation operators: units and packed fields."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from massquarry.operators import packed, units


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    """Values with a known unit other than eV, converted."""
    v = units.known_units(spark.read.parquet(f"{d}/train.parquet"), spark.read.parquet(f"{d}/nce_charge_factor.parquet"))
    v = v.where((F.col("unit") != "eV") & F.col("ev").isNotNull())
    return v.select("row_offset", F.col("step_no").cast("int").alias("step_no"), F.floor(F.col("ev") * 100 + 0.5).cast("long").alias("ev_x100"))


def p4_assigned(spark: SparkSession, d: str) -> DataFrame:
    """All values with the origin of their unit; uncertain ones are marked review."""
    return units.to_common_unit(spark.read.parquet(f"{d}/train.parquet"), spark.read.parquet(f"{d}/nce_charge_factor.parquet"))


def p4_held_out(spark: SparkSession, d: str) -> DataFrame:
    """What the model says of known units that are hidden from it."""
    return units.held_out_accuracy(spark.read.parquet(f"{d}/train.parquet"), spark.read.parquet(f"{d}/nce_charge_factor.parquet"))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    """Each value of the fields that hold at least two."""
    t = spark.read.parquet(f"{d}/train.parquet").select("row_offset", "ingest_lib", "collision_energy_orig")
    t = t.where(F.col("collision_energy_orig").rlike(r"\d")).dropDuplicates(["row_offset"])
    v = packed.split_packed(t, "collision_energy_orig", "ingest_lib").where((F.col("n_values") > 1) & F.col("value").isNotNull())
    return v.select("row_offset", F.col("step_no").cast("int").alias("step_no"), F.floor(F.col("value") * 1000 + 0.5).cast("long").alias("value_x1000"))


def p6_delimiters(spark: SparkSession, d: str) -> DataFrame:
    """The delimiters inferred for each source."""
    t = spark.read.parquet(f"{d}/train.parquet").select("row_offset", "ingest_lib", "collision_energy_orig")
    return packed.infer_delimiters(t.dropDuplicates(["row_offset"]), "collision_energy_orig", "ingest_lib")


QUERIES = {f.__name__: f for f in (p4_found, p4_assigned, p4_held_out, p6_found, p6_delimiters)}

# Decimal commas first (twice, as neighbours share a mark), then all numbers of the field.
_VALUES = r"""
fields AS (
  SELECT DISTINCT row_offset, collision_energy_orig AS raw, regexp_replace(regexp_replace(collision_energy_orig, chr(160), ' ', 'g'), '(^|[^0-9.,])0,([0-9]{1,3})', '\1'||'0.\2', 'g') AS s
  FROM train WHERE regexp_matches(collision_energy_orig, '[0-9]')),
marked AS (
  SELECT *, regexp_matches(s, '[0-9][^0-9,;]*[;/|+&:_\t\n\r–→>-][^0-9]*[0-9]') OR regexp_matches(s, '[0-9][^0-9]*\b(to|and)\b[^0-9]*[0-9]')
    OR regexp_matches(s, '[0-9]\.?[\x22'')\]}]* *(%( \(nominal\))?|[A-Za-z]{1,5})?[\x22'')\]}]* +[\x22''(\[{]*[0-9]') AS other FROM fields),
fixed AS (
  SELECT *, CASE WHEN other THEN regexp_replace(regexp_replace(s || ' ', '(^|[^0-9.,])([0-9]+),([0-9])([^0-9.,])', '\1\2.\3\4', 'g'), '(^|[^0-9.,])([0-9]+),([0-9])([^0-9.,])', '\1\2.\3\4', 'g') ELSE s END AS t FROM marked),
"""

ORACLE = {
    "p6_found": f"""WITH {_VALUES}
 vals AS (SELECT row_offset, regexp_extract_all(t, '([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][0-9]+)?') AS v FROM fixed)
 SELECT row_offset, CAST(i AS INTEGER) AS step_no, CAST(floor(CAST(v[i] AS DOUBLE) * 1000 + 0.5) AS BIGINT) AS value_x1000
 FROM vals, unnest(range(1, len(v) + 1)) AS r(i) WHERE len(v) > 1""",
}
