"""Splits that keep related records together: connected components, then proportional ranges of a hash.

Components come from alternating large-star and small-star steps over the distinct links between entities. The label of
a component is its smallest node, so nodes are named such that the wanted label sorts first. Every step is a grouped
minimum (combined before the shuffle) and a join of links with one row per node, which adaptive execution splits where
one node holds a large part of the links; no group of links is ever gathered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from massquarry.workspace import stage, unstage


def _least_neighbour(links: DataFrame) -> DataFrame:
    """n, m: each node with the smallest of itself and its neighbours; links: u, v."""
    both = links.select(F.col("u").alias("n"), F.col("v").alias("w")).unionByName(links.select(F.col("v").alias("n"), F.col("u").alias("w")))
    return both.groupBy("n").agg(F.min(F.least("n", "w")).alias("m"))


def large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour v of u is linked with the smallest neighbour of u. links: distinct (u, v), u > v."""
    m = _least_neighbour(links)
    # both ends play u: the larger neighbours of v are the u of its links, those of u are none with u > v
    out = links.join(m, links["v"] == m["n"]).select(F.col("u").alias("a"), F.col("m").alias("b"))
    return out.where(F.col("a") > F.col("b")).select(F.col("a").alias("u"), F.col("b").alias("v")).distinct()


def small_star(links: DataFrame) -> DataFrame:
    """Every smaller neighbour of u, and u, is linked with the smallest one. links: distinct (u, v), u > v."""
    m = links.groupBy("u").agg(F.min("v").alias("m"))
    out = links.join(m.withColumnRenamed("u", "n"), F.col("u") == F.col("n")).select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
    return out.where(F.col("u") > F.col("v")).distinct()


def components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """node, root: every node of links (u, v) with the smallest node of its component.

    Nulls and links of a node with itself are ignored; repeated links count once; no links give an empty table. Each
    round is written to the shared folder, and the round before is deleted; only two numbers per round reach the driver.
    """
    now = links.where(F.col("u").isNotNull() & F.col("v").isNotNull() & (F.col("u") != F.col("v")))
    now = stage(now.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    print_of = lambda t: tuple(t.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
    seen = print_of(now)
    for _ in range(max_rounds):
        after = stage(small_star(large_star(now)), "links")
        unstage(now)
        now, (mark, seen) = after, (seen, print_of(after))
        if mark == seen:
            break
    else:
        raise RuntimeError(f"components did not settle within {max_rounds} rounds")
    roots = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())


def group_records(df: DataFrame, record: str, entities: list[Column]) -> DataFrame:
    """record, root, records: each distinct record with the label of its component and the component's records.

    Entities are string columns that name what a record is about, null where they name nothing; names of different
    kinds must differ, for example by their first letter. A record without any entity is a component of its own with a
    null label. Records with a null identifier are one record.
    """
    first = F.coalesce(*entities)
    # each record links its first name with its others; the distinct links are all that the steps see
    links = df.select(first.alias("u"), F.explode(F.array(*entities)).alias("v")).where(F.col("v").isNotNull()).distinct()
    roots = components(links)
    one = df.groupBy(F.col(record).alias("record")).agg(F.min(first).alias("name"))
    sizes = one.where(F.col("name").isNotNull()).groupBy("name").agg(F.count(F.lit(1)).alias("n"))
    sizes = sizes.join(roots, F.col("name") == F.col("node"), "left").select("name", F.coalesce("root", "name").alias("root"), "n")
    totals = sizes.groupBy(F.col("root").alias("r__")).agg(F.sum("n").alias("records"))
    known = sizes.join(totals, F.col("root") == F.col("r__")).select(F.col("name").alias("n__"), "root", "records")
    # one row per name on this side: a name that many records share makes the other side's partition large, which is split
    out = one.join(known, F.col("name") == F.col("n__"), "left")
    return out.select("record", "root", F.coalesce("records", F.lit(1)).alias("records"))


def proportional_splits(groups: DataFrame, shares: dict[str, float], seed: int = 0, large: float = 0.01) -> DataFrame:
    """groups (record, root, records) with the column split.

    The hash of a component's label falls into one of the ranges that are proportional to shares. A component that holds
    more than the share `large` of all records would upset the proportions if left to chance; such components (fewer
    than 1 / large by number) are placed first, each where most room is left, and the ranges are those of the room that
    remains. Records without a label are hashed by their own identifier. An empty table gives an empty result.
    """
    g = stage(groups, "groups")
    total = g.count()
    big = g.where((F.col("records") > large * total) & F.col("root").isNotNull()).select("root", "records").distinct()
    big = big.orderBy(F.desc("records"), "root").collect()  # fewer than 1 / large rows
    whole = sum(shares.values())
    room = {s: w / whole * total for s, w in shares.items()}
    placed = {}
    for r in big:
        s = max(room, key=lambda x: room[x])
        placed[r["root"]] = s
        room[s] -= r["records"]
    left = {s: max(0.0, x) for s, x in room.items()}
    scale = sum(left.values()) or 1.0
    u = F.abs(F.xxhash64(F.coalesce("root", F.concat(F.lit("record "), F.col("record").cast("string"))), F.lit(seed)) % 2**40) / float(2**40)
    split, edge = None, 0.0
    names = list(left)
    for s in names[:-1]:
        edge += left[s] / scale
        split = F.when(u < edge, s) if split is None else split.when(u < edge, s)
    split = F.lit(names[0]) if split is None else split.otherwise(names[-1])
    if placed:
        fixed = F.create_map(*(F.lit(x) for kv in placed.items() for x in kv))
        split = F.coalesce(fixed[F.coalesce("root", F.lit(""))], split)
    return g.withColumn("split", split)
