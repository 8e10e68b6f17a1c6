"""Scorers as Column expressions: linear fusions and tree ensembles given as JSON, averaged over folds; and controls.

A tree is {"feature": name, "threshold": x, "left": ..., "right": ..., "missing": "left" or "right"} or {"value": y};
an ensemble is {"features": [...], "trees": [...]}. Expressions stay inside generated code; nothing is shipped to Python.
"""

from __future__ import annotations

import hashlib
import json

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Column, DataFrame, functions as F

# Features that give the answer away or stand for the number of references.
PROHIBITED = ("is_true_candidate", "true_connectivity_key", "n_reference_spectra", "has_reference_spectrum", "n_eligible", "source_count")


def assert_allowed(features: list[str]) -> list[str]:
    bad = [f for f in features if f in PROHIBITED]
    if bad or len(set(features)) != len(features):
        raise ValueError(f"features not allowed or repeated: {bad or features}")
    return features


def tree_expression(tree: dict) -> Column:
    if "value" in tree:
        return F.lit(float(tree["value"]))
    x = F.col(tree["feature"]).cast("double")
    left, right = tree_expression(tree["left"]), tree_expression(tree["right"])
    lost = x.isNull() | F.isnan(x)
    return F.when(lost, left if tree.get("missing", "left") == "left" else right).when(x <= float(tree["threshold"]), left).otherwise(right)


def ensemble_expression(model: dict) -> Column:
    assert_allowed(model["features"])
    total = F.lit(0.0)
    for t in model["trees"]:
        total = total + tree_expression(t)
    return total


def fold_mean(models: list[dict]) -> Column:
    """Mean score of the folds' models; all must have the same features in the same order."""
    if len({feature_order_hash(m["features"]) for m in models}) != 1:
        raise ValueError("the folds' models have different features")
    total = F.lit(0.0)
    for m in models:
        total = total + ensemble_expression(m)
    return total / len(models)


def by_fold(models: dict[int, dict], fold: str) -> Column:
    """Out-of-fold score: each row by the model that did not see its fold."""
    out = F.lit(None).cast("double")
    for f, m in models.items():
        out = F.when(F.col(fold) == f, ensemble_expression(m)).otherwise(out)
    return out


def feature_order_hash(features: list[str]) -> str:
    return hashlib.sha256(json.dumps(list(features)).encode()).hexdigest()[:16]


def _as_json(node, features: list[str], weight: float) -> dict:
    """A fitted regression tree (JVM node) as JSON."""
    if node.getClass().getSimpleName() == "LeafNode":
        return {"value": node.prediction() * weight}
    s = node.split()
    return {"feature": features[s.featureIndex()], "threshold": s.threshold(), "left": _as_json(node.leftChild(), features, weight), "right": _as_json(node.rightChild(), features, weight)}


def fit(df: DataFrame, features: list[str], label: str, trees: int = 20, depth: int = 4, seed: int = 1) -> dict:
    """Boosted regression trees on the label (0 or 1), as JSON. Nulls and NaN are given as -1, outside of all features' ranges."""
    assert_allowed(features)
    x = df.select(F.col(label).cast("double").alias("label__"), *(F.coalesce(F.nanvl(F.col(f).cast("double"), F.lit(-1.0)), F.lit(-1.0)).alias(f) for f in features))
    v = VectorAssembler(inputCols=features, outputCol="features__").transform(x)
    m = GBTRegressor(featuresCol="features__", labelCol="label__", maxIter=trees, maxDepth=depth, seed=seed, stepSize=0.2).fit(v)
    out = []
    for t, w in zip(m.trees, m.treeWeights, strict=True):
        tree = _as_json(t._call_java("rootNode"), features, w)
        out.append(_with_missing(tree))
    return {"features": list(features), "trees": out}


def _with_missing(t: dict) -> dict:
    """Where missing values, which were -1 in training, go."""
    if "value" in t:
        return t
    return t | {"missing": "left" if t["threshold"] >= -1.0 else "right", "left": _with_missing(t["left"]), "right": _with_missing(t["right"])}


def fit_folds(df: DataFrame, features: list[str], label: str, fold: str, folds: list[int], **kw) -> dict[int, dict]:
    """Per fold a model of all other folds' rows."""
    return {f: fit(df.where(F.col(fold) != f), features, label, **kw) for f in folds}


def constant_control(df: DataFrame, features: list[str]) -> DataFrame:
    """Features replaced by their means: what a model scores without their evidence."""
    means = df.agg(*(F.avg(F.nanvl(F.col(f), F.lit(None).cast("double"))).alias(f"{f}__") for f in features))
    return df.crossJoin(F.broadcast(means)).withColumns({f: F.col(f"{f}__") for f in features}).drop(*(f"{f}__" for f in features))


def mask_control(df: DataFrame, features: list[str], query: str, share: float, seed: int = 0) -> DataFrame:
    """Features set to null for a hashed share of the queries."""
    hide = F.pmod(F.xxhash64(query, F.lit(seed)), F.lit(1000)) < share * 1000
    return df.withColumns({f: F.when(~hide, F.col(f)) for f in features})


def missingness_score(features: list[str]) -> Column:
    """A score from the presence of features only, to find what missing values give away."""
    n = F.lit(0)
    for f in features:
        n = n + (F.col(f).isNotNull() & ~F.isnan(f)).cast("int")
    return n.cast("double")
