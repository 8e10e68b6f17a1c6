"""Structure sources: csv, tsv, parquet, smi and sdf files as canonical records; spectra from MGF files.

Every reader is a plan: files are split and parsed by tasks, a row without SMILES is still a row.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

RECORD = ("source", "source_id", "raw_smiles", "name", "source_formula", "source_metadata")
FORMATS = ("csv", "tsv", "parquet", "smi", "sdf")


@dataclass(frozen=True)
class SourceConfig:
    """Columns are named, never guessed."""

    name: str
    path: str
    format: str
    smiles: str | None = None
    id: str | None = None
    title: str | None = None
    formula: str | None = None
    metadata: tuple[str, ...] = field(default_factory=tuple)
    header: bool = True

    def __post_init__(self):
        if self.format not in FORMATS:
            raise ValueError(f"unknown format {self.format}; known are {FORMATS}")
        if self.format in ("csv", "tsv", "parquet") and not self.smiles:
            raise ValueError("tabular sources need the name of the SMILES column")


def load_source_config(path: str) -> SourceConfig:
    raw = json.loads(Path(path).read_text())
    unknown = set(raw) - set(SourceConfig.__dataclass_fields__)
    if unknown:
        raise ValueError(f"unknown settings {sorted(unknown)}")
    return SourceConfig(**{k: tuple(v) if k == "metadata" else v for k, v in raw.items()})


def _exists(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    if p.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(p) is None or not len(p.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(p)):
        raise FileNotFoundError(path)


def _canonical(df: DataFrame, cfg: SourceConfig, smiles: Column, id_: Column, name: Column, formula: Column, meta: Column) -> DataFrame:
    return df.select(F.lit(cfg.name).alias("source"), id_.cast("string").alias("source_id"), smiles.alias("raw_smiles"), name.alias("name"), formula.alias("source_formula"), meta.alias("source_metadata"))


def read_records(spark: SparkSession, cfg: SourceConfig) -> DataFrame:
    """The six canonical columns of a source, whatever its format."""
    _exists(spark, cfg.path)
    none = F.lit(None).cast("string")
    if cfg.format in ("csv", "tsv", "parquet"):
        df = spark.read.parquet(cfg.path) if cfg.format == "parquet" else spark.read.csv(cfg.path, header=True, sep="\t" if cfg.format == "tsv" else ",", quote='"', escape='"', multiLine=False)
        missing = [c for c in (cfg.smiles, cfg.id, cfg.title, cfg.formula, *cfg.metadata) if c and c not in df.columns]
        if missing:
            raise ValueError(f"{cfg.path} has no columns {missing}")
        col = lambda c: F.col(c).cast("string") if c else none
        return _canonical(df, cfg, col(cfg.smiles), col(cfg.id), col(cfg.title), col(cfg.formula), F.to_json(F.struct(*cfg.metadata)) if cfg.metadata else none)
    if cfg.format == "smi":
        df = spark.read.text(cfg.path).where(F.trim("value") != "")
        parts = F.split(F.trim("value"), r"\s+", 2)
        df = df.select(parts.alias("p"))
        if cfg.header:
            df = df.where(~F.lower(F.col("p")[0]).isin("smiles", "smi"))
        return _canonical(df, cfg, F.col("p")[0], F.get("p", F.lit(1)), F.get("p", F.lit(1)), none, none)
    df = spark.read.text(cfg.path, lineSep="$$$$\n").where(F.trim("value") != "")
    return _canonical(df, cfg, *_sdf_fields(cfg))


def sdf_property(text: Column, name: str) -> Column:
    """The first line of a data item of an SDF record."""
    v = F.regexp_extract(text, rf"(?m)^>[^\n]*<{name}>[^\n]*\r?\n([^\r\n]*)", 1)
    return F.when(v != "", v)


def _sdf_fields(cfg: SourceConfig) -> tuple[Column, ...]:
    v = F.col("value")
    title = F.trim(F.regexp_extract(v, r"^\s*([^\r\n]*)", 1))
    item = lambda n: sdf_property(v, n) if n else F.lit(None).cast("string")
    meta = F.to_json(F.struct(*(sdf_property(v, m).alias(m) for m in cfg.metadata))) if cfg.metadata else F.lit(None).cast("string")
    return item(cfg.smiles), F.coalesce(item(cfg.id), F.when(title != "", title)), F.coalesce(item(cfg.title), F.when(title != "", title)), item(cfg.formula), meta


def read_mgf(spark: SparkSession, path: str) -> DataFrame:
    """One row per BEGIN IONS block: headers (map with upper-case keys), precursor_mz, mzs and intensities."""
    _exists(spark, path)
    blocks = spark.read.text(path, lineSep="END IONS").where(F.col("value").contains("BEGIN IONS"))
    lines = F.transform(F.split(F.regexp_replace("value", r"(?s)^.*?BEGIN IONS", ""), r"\r?\n"), F.trim)
    df = blocks.select(lines.alias("l"))
    head = F.filter("l", lambda x: x.rlike("^[A-Za-z_0-9]+="))
    entries = F.transform(head, lambda x: F.struct(F.upper(F.regexp_extract(x, "^([^=]+)=", 1)).alias("k"), F.regexp_extract(x, "^[^=]+=(.*)$", 1).alias("v")))
    # of repeated keys the first counts
    keys = F.array_distinct(F.transform(entries, lambda e: e["k"]))
    first = F.map_from_arrays(keys, F.transform(keys, lambda k: F.filter(entries, lambda e: e["k"] == k)[0]["v"]))
    peak = F.transform(F.filter("l", lambda x: x.rlike(r"^[0-9.]+[\s,;]+[0-9.eE+-]+")), lambda x: F.split(x, r"[\s,;]+"))
    num = lambda i: F.transform(peak, lambda x: x[i].try_cast("double"))
    return df.select(first.alias("headers"), num(0).alias("mzs"), num(1).alias("intensities")).withColumn("precursor_mz", F.split(F.try_element_at("headers", F.lit("PEPMASS")), r"\s+")[0].try_cast("double"))


def load_table(spark: SparkSession, path: str, columns: list[str] | None = None, rows: int | None = None) -> DataFrame:
    """csv, tsv, json, jsonl, parquet or mgf by suffix, with only the named columns, and the first `rows` rows if given."""
    p = path.removesuffix(".gz")
    if p.endswith(".parquet"):
        df = spark.read.parquet(path)
    elif p.endswith((".csv", ".tsv", ".txt")):
        df = spark.read.csv(path, header=True, inferSchema=True, sep="," if p.endswith(".csv") else "\t")
    elif p.endswith((".jsonl", ".ndjson", ".json")):
        df = spark.read.json(path, multiLine=p.endswith(".json"))
    elif p.endswith(".mgf"):
        df = read_mgf(spark, path)
    else:
        raise ValueError(f"unknown suffix: {path}")
    df = df.select(*columns) if columns else df
    return df.limit(rows) if rows is not None else df


# Names under which each role's column goes, in normal form (letters and digits in lower case).
ROLES = {
    "smiles": ("smiles", "normalizedsmiles", "canonicalsmiles"), "precursor": ("precursormz", "pepmass", "parentmass"), "adduct": ("adduct", "precursortype", "iontype"),
    "mzs": ("mzs", "ms2mzs", "mz", "peaksmz"), "intensities": ("intensities", "ms2normalizedintensities", "intensity", "peaksintensity"), "id": ("spectrumid", "id", "identifier", "rowoffset"),
    "instrument": ("instrumenttype", "instrument"), "mode": ("ionizationmode", "ionmode", "polarity"), "energy": ("collisionenergy", "collisionenergyev", "ce"),
}


def guess_roles(df: DataFrame) -> dict[str, str]:
    """Role to column by normal form; array columns only for peak roles. Looks at the schema only."""
    kinds = dict(df.dtypes)
    norm = {"".join(ch for ch in c.lower() if ch.isalnum()): c for c in reversed(df.columns)}
    out = {}
    for role, names in ROLES.items():
        for n in names:
            if n in norm and (kinds[norm[n]].startswith("array") == (role in ("mzs", "intensities")) or role == "energy"):
                out[role] = norm[n]
                break
    return out


def peak_lists(peaks: Column, kind: str) -> tuple[Column, Column]:
    """Two lists of doubles from text such as "100.1:5;200.2:7", "[[100.1, 5], ...]" or JSON lists of pairs; kind is
    text or pairs (array of arrays)."""
    if kind == "pairs":
        return F.transform(peaks, lambda p: p[0].cast("double")), F.transform(peaks, lambda p: p[1].cast("double"))
    n = F.regexp_extract_all(peaks, F.lit(r"[-+]?(?:\d+\.?\d*|\.\d+)(?:[eE][-+]?\d+)?"), 0)
    every = lambda r: F.transform(F.filter(n, lambda x, i: i % 2 == r), lambda x: x.cast("double"))
    return every(0), every(1)
