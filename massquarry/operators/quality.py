"""Contracts and comparisons: checked joins, parity of two results, checks, gates, leakage guards."""

from __future__ import annotations

import operator
import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F


def assert_columns(df: DataFrame, required: list[str]) -> DataFrame:
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return df


def forbid_columns(df: DataFrame, names: tuple[str, ...] = (), patterns: tuple[str, ...] = ()) -> DataFrame:
    """Guard of label-free inputs and of model features: no listed name and no match of a pattern."""
    bad = [c for c in df.columns if c in names or any(re.search(p, c) for p in patterns)]
    if bad:
        raise ValueError(f"forbidden columns: {bad}")
    return df


def checked_join(left: DataFrame, right: DataFrame, on: list[str], how: str = "left", cardinality: str = "many_to_one") -> DataFrame:
    """Join that fails at run time if the promised side holds a key twice; the test is part of the plan and costs one
    aggregation of that side's keys."""

    def unique(df: DataFrame) -> DataFrame:
        others = [c for c in df.columns if c not in on]
        g = df.groupBy(*on).agg(F.count(F.lit(1)).alias("n__"), *(F.first(c).alias(c) for c in others))
        ok = F.when(F.col("n__") == 1, F.lit(True)).otherwise(F.raise_error(F.lit(f"key {on} is not unique")).cast("boolean"))
        return g.where(ok).select(*df.columns)

    if cardinality not in ("one_to_one", "many_to_one"):
        raise ValueError(cardinality)
    return (unique(left) if cardinality == "one_to_one" else left).join(unique(right), on, how)


def parity(a: DataFrame, b: DataFrame, keys: list[str], values: list[str], atol: float = 1e-9) -> DataFrame:
    """One row: keys only in a, only in b, in both, and per value the rows that differ (NaN equals NaN, null equals null)."""
    l = a.select(*keys, F.lit(True).alias("in_a"), *(F.col(v).alias(f"{v}_a") for v in values))
    r = b.select(*keys, F.lit(True).alias("in_b"), *(F.col(v).alias(f"{v}_b") for v in values))
    j = l.join(r, keys, "full_outer")
    both = F.col("in_a").isNotNull() & F.col("in_b").isNotNull()

    def differs(v: str) -> Column:
        x, y = F.col(f"{v}_a"), F.col(f"{v}_b")
        if dict(a.dtypes)[v] in ("double", "float"):
            return ~(x.eqNullSafe(y) | F.coalesce(F.abs(x - y) <= atol, F.lit(False)))
        return ~x.eqNullSafe(y)

    return j.agg(
        F.count_if(F.col("in_b").isNull()).alias("only_a"), F.count_if(F.col("in_a").isNull()).alias("only_b"), F.count_if(both).alias("both"), *(F.count_if(both & differs(v)).alias(f"differs_{v}") for v in values)
    )


@dataclass(frozen=True)
class Check:
    name: str
    passed: bool
    value: object = None


def run_checks(df: DataFrame, rules: dict[str, Column]) -> list[Check]:
    """Rules that every row must meet; one pass counts the rows that break each."""
    row = df.agg(*(F.count_if(~F.coalesce(c, F.lit(False))).alias(f"c{i}") for i, c in enumerate(rules.values()))).first()
    return [Check(n, row[i] == 0, row[i]) for i, n in enumerate(rules)]


def profile(df: DataFrame) -> DataFrame:
    """One row per column: type, nulls, NaN, distinct values (estimated), least and greatest as text; one pass."""
    aggs = [F.count(F.lit(1)).alias("n")]
    for i, (c, t) in enumerate(df.dtypes):
        nan = F.count_if(F.isnan(F.col(c))) if t in ("double", "float") else F.lit(0)
        flat = not t.startswith(("array", "map", "struct"))
        aggs += [F.count_if(F.col(c).isNull()).alias(f"u{i}"), nan.alias(f"a{i}"), (F.approx_count_distinct(c) if flat else F.lit(None).cast("long")).alias(f"d{i}"), (F.min(c).cast("string") if flat else F.lit(None).cast("string")).alias(f"l{i}"), (F.max(c).cast("string") if flat else F.lit(None).cast("string")).alias(f"h{i}")]
    one = df.agg(*aggs)
    cells = [F.struct(F.lit(c).alias("column"), F.lit(t).alias("type"), F.col("n"), F.col(f"u{i}").alias("nulls"), F.col(f"a{i}").cast("long").alias("nans"), F.col(f"d{i}").alias("distinct_estimate"), F.col(f"l{i}").alias("least"), F.col(f"h{i}").alias("greatest")) for i, (c, t) in enumerate(df.dtypes)]
    return one.select(F.explode(F.array(*cells)).alias("x")).select("x.*")


_OPS: dict[str, Callable] = {"==": operator.eq, "!=": operator.ne, "<=": operator.le, ">=": operator.ge, "<": operator.lt, ">": operator.gt}


def evaluate_gates(spec: list[dict], results: dict[str, object]) -> list[dict]:
    """PASS, FAIL or NOT_PROVEN (no result) for each gate {id, results_key, condition}, where a condition is an operator
    and a value, or "exists"."""
    out = []
    for g in spec:
        v, cond = results.get(g["results_key"]), g["condition"].strip()
        if v is None:
            status = "NOT_PROVEN"
        elif cond == "exists":
            status = "PASS"
        else:
            m = re.fullmatch(r"(==|!=|<=|>=|<|>)\s*(.+)", cond)
            if not m:
                raise ValueError(f"condition {cond!r}")
            rhs = m[2].strip()
            rhs = {"true": True, "false": False}.get(rhs.lower(), rhs)
            try:
                rhs = float(rhs) if not isinstance(rhs, bool) else rhs
            except ValueError:
                rhs = rhs.strip("'\"")
            status = "PASS" if _OPS[m[1]](v, rhs) else "FAIL"
        out.append({"id": g["id"], "value": v, "condition": cond, "status": status})
    return out


def overall(gates: list[dict]) -> str:
    s = {g["status"] for g in gates}
    return "FAIL" if "FAIL" in s else "NOT_PROVEN" if "NOT_PROVEN" in s else "PASS"
