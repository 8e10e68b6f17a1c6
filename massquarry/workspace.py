"""Intermediate results kept in the folder that all executors share.

A staged table cuts lineage, survives the loss of executors and, being columnar, is read back with column pruning and
true sizes, so that later joins are planned on what is there.
"""

from __future__ import annotations

import atexit
import contextlib
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

_own: dict[str, str] = {}
_SUB = f"massquarry-{uuid.uuid4().hex[:12]}"


def shared_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir. Where that is unset (tests, single machines) a temporary one is made;
    on a cluster without the setting this fails rather than use a folder that only one machine sees."""
    conf = spark.sparkContext.getConf()
    root = conf.get("spark.checkpoint.dir", None)
    if root:
        root = f"{root.rstrip('/')}/{_SUB}"
        if "shared" not in _own:
            _own["shared"] = root
            atexit.register(_leave, spark, root)
        return root
    if not conf.get("spark.master", "local").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if "dir" not in _own:
        _own["dir"] = tempfile.mkdtemp(prefix="massquarry-")
        atexit.register(shutil.rmtree, _own["dir"], True)
    return f"file://{_own['dir']}/{_SUB}"


def _leave(spark: SparkSession, root: str) -> None:
    """At the end of the driver, delete what it staged, if the session still runs."""
    with contextlib.suppress(Exception):
        p = spark._jvm.org.apache.hadoop.fs.Path(root)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def stage(df: DataFrame, name: str = "t") -> DataFrame:
    """Write df to the shared folder and return the table read from there."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def unstage(*tables: DataFrame | None) -> None:
    """Delete staged tables that no later plan reads."""
    for t in tables:
        if t is None:
            continue
        spark = t.sparkSession
        for f in {x.rsplit("/", 1)[0] for x in t.inputFiles()}:
            if _SUB in f:
                p = spark._jvm.org.apache.hadoop.fs.Path(f)
                p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def row_count(df: DataFrame) -> int:
    """Rows of a staged table, from file footers."""
    return df.agg(F.count(F.lit(1))).first()[0]


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names like those given that df does not use, in whatever letter case."""
    used, out = {c.lower() for c in df.columns}, []
    for n in names:
        while n.lower() in used:
            n = f"_{n}"
        used.add(n.lower())
        out.append(n)
    return out
