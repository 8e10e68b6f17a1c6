"""Filling containers of fixed capacity: best-fit decreasing with a segment tree over remaining capacities.

Texts are measured in tokens and cut only if longer than a container. Every shard, a hash part of the pieces that one
task holds with ease, is packed by itself: pieces by size descending, each into the open container with the least room
that suffices. Whatever the number of shards, each leaves at most a few containers with room, which is why shards are
large against a container.
"""

from __future__ import annotations

import base64

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from massquarry.workspace import row_count, stage

# Fixed value: how the byte-level vocabulary cuts text before merging.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


class Tree:
    """Segment tree over remaining capacities 0..capacity: open containers by the room they have left."""

    def __init__(self, capacity: int):
        self.size = 1
        while self.size <= capacity:
            self.size *= 2
        self.count = [0] * (2 * self.size)
        self.at: list[list[int]] = [[] for _ in range(capacity + 1)]

    def add(self, room: int, container: int) -> None:
        self.at[room].append(container)
        k = room + self.size
        while k:
            self.count[k] += 1
            k //= 2

    def take(self, least: int) -> tuple[int, int] | None:
        """Remove and return (room, container) of the least room of at least `least`."""
        k = least + self.size
        if not self.count[k]:
            # up to the first right sibling that holds something, then down its left side
            while True:
                while k & 1:
                    k //= 2
                    if not k:
                        return None
                k += 1
                if self.count[k]:
                    break
                if k & (k - 1) == 0:
                    return None
            while k < self.size:
                k *= 2
                if not self.count[k]:
                    k += 1
        room = k - self.size
        container = self.at[room].pop()
        while k:
            self.count[k] -= 1
            k //= 2
        return room, container


def best_fit_decreasing(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """The container of each piece; sizes are at most capacity, and equal sizes are taken in the order given."""
    out = np.zeros(len(sizes), np.int64)
    tree, opened = Tree(capacity), 0
    for i in np.argsort(-sizes, kind="stable").tolist():
        s = int(sizes[i])
        got = tree.take(s)
        if got is None:
            room, c = capacity, opened
            opened += 1
        else:
            room, c = got
        out[i] = c
        tree.add(room - s, c)
    return out


def _measured(path: str):
    """mapInArrow (id, text): id, tokens."""

    def run(batches):
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        enc = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        for b in batches:
            n = [len(enc.encode_ordinary(t)) if t else 0 for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64())], ["id", "tokens"])

    return run


def _packed(capacity: int):
    """mapInArrow over rows sorted by shard: the container of each piece, numbered within the shard."""

    def close(rows):
        size = np.array([r[3] for r in rows], np.int64)
        c = best_fit_decreasing(size, capacity)
        cols = list(zip(*rows, strict=True))
        return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(c), *(pa.array(x, pa.int64()) for x in cols[1:])], ["shard", "container", "id", "first_token", "tokens"])

    def run(batches):
        rows: list = []
        for b in batches:
            for r in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if rows and r[0] != rows[0][0]:
                    yield close(rows)
                    rows = []
                rows.append(r)
        if rows:
            yield close(rows)

    return run


def pack(df: DataFrame, id_col: str, text: str, tokenizer: str, capacity: int = 2048, shard: int = 200_000) -> DataFrame:
    """container_id, doc_id, piece_no, first_token, tokens: where every text, or piece of a text longer than a
    container, is placed.

    A text longer than `capacity` tokens is cut into full pieces and a rest; all others stay whole. Null and empty
    texts have no tokens and are placed like any other. Rows of one id, and rows without an id, are told apart by
    nothing and each placed. Extra columns are ignored; an empty table gives an empty result. tokenizer is the path of
    a vocabulary file of ranks; shard is the number of texts that one task packs.
    """
    t = df.select(F.col(id_col).cast("long").alias("id"), F.col(text).alias("text"))
    sized = stage(t.mapInArrow(_measured(tokenizer), "id long, tokens long"), "sized")
    shards = max(1, -(-row_count(sized) // shard))
    cut = F.sequence(F.lit(0), F.greatest(F.ceil(F.col("tokens") / capacity) - 1, F.lit(0)).cast("long"))
    pieces = sized.select("id", "tokens", F.explode(cut).alias("piece"))
    pieces = pieces.select(
        F.pmod(F.xxhash64("id", "piece"), F.lit(shards)).alias("shard"), "id", (F.col("piece") * capacity).alias("first_token"),
        F.least(F.lit(capacity), F.col("tokens") - F.col("piece") * capacity).alias("tokens"),
    )
    one = pieces.repartition(shards, "shard").sortWithinPartitions("shard", "id", "first_token")
    out = one.select("shard", "id", "first_token", "tokens").mapInArrow(_packed(capacity), "shard long, container long, id long, first_token long, tokens long")
    number = F.concat(F.col("shard").cast("string"), F.lit("-"), F.col("container").cast("string"))
    return out.select(number.alias("container_id"), F.col("id").alias("doc_id"), (F.col("first_token") / capacity).cast("int").alias("piece_no"), "first_token", "tokens")
