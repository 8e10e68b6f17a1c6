"""Tables with a sidecar that says what they were made from, reuse by fingerprint, logs and submissions."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F


def stable_hash(x: object, length: int = 12) -> str:
    return hashlib.sha256(json.dumps(x, sort_keys=True, separators=(",", ":"), default=str).encode()).hexdigest()[:length]


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _write(spark: SparkSession, path: str, text: str) -> None:
    fs, p = _fs(spark, path)
    out = fs.create(p, True)
    out.write(bytearray(text.encode()))
    out.close()


def _read(spark: SparkSession, path: str) -> str | None:
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return None
    return "\n".join(r[0] for r in spark.read.text(path).collect())  # a small file


def file_fingerprint(spark: SparkSession, path: str) -> str:
    """Names, sizes and times of the files under a path."""
    fs, p = _fs(spark, path)
    files, out = fs.listFiles(p, True), []
    while files.hasNext():
        f = files.next()
        out.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return stable_hash(sorted(out), 32)


def content_hashes(spark: SparkSession, path: str) -> DataFrame:
    """path, sha256 of every file below a path, hashed by the tasks."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "length", F.sha2("content", 256).alias("sha256"))


def save_artifact(df: DataFrame, path: str, config: object = None, inputs: dict[str, str] | None = None, description: str = "") -> DataFrame:
    """Write the table, then its sidecar (<path>.meta.json), and return the table read back. A table without a sidecar
    was not finished."""
    spark = df.sparkSession
    fs, p = _fs(spark, f"{path}.meta.json")
    fs.delete(p, False)
    df.write.mode("overwrite").parquet(path)
    out = spark.read.parquet(path)
    meta = {"rows": out.count(), "columns": dict(df.dtypes), "config": stable_hash(config), "inputs": inputs or {}, "description": description, "made": datetime.now(timezone.utc).isoformat()}
    _write(spark, f"{path}.meta.json", json.dumps(meta, indent=1, sort_keys=True))
    return out


def artifact_metadata(spark: SparkSession, path: str) -> dict | None:
    text = _read(spark, f"{path}.meta.json")
    return json.loads(text) if text else None


def artifact_is_valid(spark: SparkSession, path: str, config: object = None, inputs: dict[str, str] | None = None) -> bool:
    m = artifact_metadata(spark, path)
    return bool(m) and m["config"] == stable_hash(config) and m["inputs"] == (inputs or {})


def cached(spark: SparkSession, path: str, build: Callable[[], DataFrame], config: object = None, inputs: dict[str, str] | None = None, force: bool = False) -> DataFrame:
    """The stored table if its configuration and inputs are unchanged, else built and stored."""
    if not force and artifact_is_valid(spark, path, config, inputs):
        return spark.read.parquet(path)
    return save_artifact(build(), path, config, inputs)


def missing_only(wanted: DataFrame, stored: DataFrame | None, keys: list[str]) -> DataFrame:
    """The keys of a memo table that are still to be computed."""
    w = wanted.select(*keys).distinct()
    return w if stored is None else w.join(stored.select(*keys).distinct(), keys, "left_anti")


def write_bucketed(df: DataFrame, path: str, key: str, prefix: int = 2) -> None:
    """Partition folders by key prefix, sorted within; filters on `bucket` read only their folders."""
    b = F.coalesce(F.substring(F.col(key), 1, prefix), F.lit(""))
    df.withColumn("bucket", b).repartition("bucket").sortWithinPartitions("bucket", key).write.mode("overwrite").partitionBy("bucket").parquet(path)


def read_by_keys(spark: SparkSession, path: str, keys: DataFrame, key: str, prefix: int = 2) -> DataFrame:
    """Rows of the wanted keys; the join on the bucket lets the scan skip other folders."""
    k = keys.select(F.col(key)).distinct().withColumn("bucket", F.coalesce(F.substring(F.col(key), 1, prefix), F.lit("")))
    return spark.read.parquet(path).join(k, ["bucket", key], "left_semi").drop("bucket")


def upsert(spark: SparkSession, path: str, row: DataFrame, key: str) -> DataFrame:
    """Replace the rows of the keys in `row` in a small registry table."""
    fs, p = _fs(spark, path)
    if fs.exists(p):
        old = spark.read.parquet(path)
        kept = old.join(row.select(key).distinct(), key, "left_anti").unionByName(row, allowMissingColumns=True)
    else:
        kept = row
    tmp = f"{path}.new"
    kept.write.mode("overwrite").parquet(tmp)
    fs.delete(p, True)
    fs.rename(spark._jvm.org.apache.hadoop.fs.Path(tmp), p)
    return spark.read.parquet(path)


def append_log(spark: SparkSession, path: str, entry: dict) -> None:
    """One JSON line more, as a file of its own in the log's folder, so that writers do not meet."""
    e = entry | {"at": datetime.now(timezone.utc).isoformat()}
    _write(spark, f"{path}/{e['at'].replace(':', '')}-{stable_hash(e)}.json", json.dumps(e, sort_keys=True) + "\n")


def read_log(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The entries with back-filled columns."""
    return spark.read.schema(schema).json(path)


def validate_submission(sub: DataFrame, expected: DataFrame, molecule: str = "molecule_id", k: int = 25) -> DataFrame:
    """One row of counts: missing and unknown molecules, duplicates, empty and over-long lists, repeated structures."""
    s = sub.select(molecule, F.filter(F.split(F.coalesce("smiles", F.lit("")), ";"), lambda x: x != "").alias("l"))
    e = expected.select(molecule).distinct()
    n = s.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct(molecule).alias("molecules"), F.count_if(F.size("l") == 0).alias("empty"), F.count_if(F.size("l") > k).alias("too_long"), F.count_if(F.size(F.array_distinct("l")) < F.size("l")).alias("repeated"))
    m = e.join(s, molecule, "left_anti").agg(F.count(F.lit(1)).alias("missing"))
    u = s.join(e, molecule, "left_anti").agg(F.count(F.lit(1)).alias("unknown"))
    return n.crossJoin(m).crossJoin(u)  # one row each


def write_submission(sub: DataFrame, expected: DataFrame, path: str, molecule: str = "molecule_id", k: int = 25) -> None:
    """One CSV folder with a header, refused unless every expected molecule has between one and k distinct structures."""
    v = validate_submission(sub, expected, molecule, k).first().asDict()
    bad = {n: v[n] for n in ("empty", "too_long", "repeated", "missing", "unknown") if v[n]}
    if bad or v["rows"] != v["molecules"]:
        raise ValueError(f"submission refused: {bad or 'repeated molecules'}")
    sub.select(molecule, "smiles").write.mode("overwrite").csv(path, header=True)
