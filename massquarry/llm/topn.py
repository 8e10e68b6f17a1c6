"""Top N items within every group, by exact positions of one global sort.

All rows are range-partitioned and sorted by group, score and identifier, so a group of any size spreads over as many
partitions as it needs. Each partition numbers its rows within their group and drops those beyond N, which can't be
among the first N of the whole group either. The counts per partition and group are then prefix-summed over the
partitions: local position + rows of the group in earlier partitions = exact position.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window as W, functions as F, types as T

from massquarry.workspace import fresh, stage


def _differs(now: pa.Array, before: pa.Array) -> np.ndarray:
    """Null-safe inequality of neighbours; NaN equals NaN."""
    ne = pc.fill_null(pc.not_equal(now, before), False)
    if pa.types.is_floating(now.type):
        ne = pc.and_(ne, pc.invert(pc.and_(pc.fill_null(pc.is_nan(now), False), pc.fill_null(pc.is_nan(before), False))))
    return pc.or_(ne, pc.xor(pc.is_null(now), pc.is_null(before))).to_numpy(zero_copy_only=False)


def _number(groups: list[str], n: int, position: str):
    """mapInArrow function: rows of a sorted partition with their position in their group, as far as n."""

    def run(batches):
        last, seen = None, 0
        for b in batches:
            rows = b.num_rows
            if not rows:
                continue
            start = np.zeros(rows, bool)
            for g in groups:
                col = b.column(g)
                start[1:] |= _differs(col.slice(1), col.slice(0, rows - 1))
                if last is None or _differs(col.slice(0, 1), last[g])[0]:
                    start[0] = True
            at = np.flatnonzero(start)
            first = np.zeros(rows, np.int64)
            first[at] = at
            first = np.maximum.accumulate(first)
            pos = np.arange(rows) - first + 1
            run_in = rows if not len(at) else at[0]
            pos[:run_in] += seen
            last, seen = {g: b.column(g).slice(rows - 1, 1) for g in groups}, int(pos[-1])
            keep = pa.array(pos <= n)
            out = b.filter(keep)
            yield pa.RecordBatch.from_arrays([*out.columns, pa.array(pos[pos <= n], pa.int64())], [*b.schema.names, position])

    return run


def top_n(df: DataFrame, groups: list[str], score: str, ids: list[str], n: int, position: str = "position") -> DataFrame:
    """The n first rows of every group by score descending, then ids ascending, with their position from 1.

    Null and NaN scores come after all numbers, null ids after all others, null group keys form one group; rows that are
    equal in score and ids are told apart arbitrarily, so ids should be unique within a group. All further columns are
    kept. An empty table gives an empty result. n below 1 gives an empty result. A column named like `position` stays,
    and the new one gets a leading underscore.
    """
    position, part, local, rank = fresh(df, position, "part", "local", "rank")
    number = F.col(score)
    if isinstance(df.schema[score].dataType, (T.DoubleType, T.FloatType)):
        number = F.when(~F.isnan(number), number)
    order = [*(F.col(g).asc_nulls_first() for g in groups), F.col(rank).desc_nulls_last(), *(F.col(i).asc_nulls_last() for i in ids)]
    df = df.withColumn(rank, number)
    ordered = df.repartitionByRange(*order).sortWithinPartitions(*order).drop(rank).withColumn(part, F.spark_partition_id())
    schema = T.StructType([*ordered.schema.fields, T.StructField(local, T.LongType())])
    kept = stage(ordered.mapInArrow(_number(groups, n, local), schema), "topn")
    counts = kept.groupBy(*groups, part).agg(F.max(local).alias("c"))
    before = F.sum("c").over(W.partitionBy(*groups).orderBy(part).rowsBetween(W.unboundedPreceding, -1))
    # at most one group of a partition began in an earlier one: as many rows as partitions
    offset = counts.withColumn("offset", before).where(F.col("offset") > 0).select(*(F.col(g).alias(f"{g}__") for g in groups), F.col(part).alias("p__"), "offset")
    same = (kept[part] == F.col("p__"))
    for g in groups:
        same &= kept[g].eqNullSafe(F.col(f"{g}__"))
    out = kept.join(F.broadcast(offset), same, "left").withColumn(position, F.col(local) + F.coalesce("offset", F.lit(0)))
    return out.where(F.col(position) <= n).drop("p__", "offset", part, local, *(f"{g}__" for g in groups))
