"""Problem 9: filling containers of fixed capacity with texts of varying length.

Method: vector best fit. A bin has three residual capacities: tokens, number of texts, and attention cost (the sum of
squared lengths). An open bin takes the item that best suits what is left of it under every constraint, by the
weighted dot product of item and residual, or by the least weighted norm of the residual that the item would leave.
All three demands of an item follow from its length, so the choice is made among lengths, not among items, and one
step costs one vector operation however many items wait.

Distribution: items are spread by a hash of their key over shards of bounded size, so neither a frequent source nor a
frequent length makes a large one, and each shard is packed by itself. What a shard could not fill, its few loosest
bins, is taken apart and packed again over ever fewer shards, so the room lost to sharding shrinks to that of a single
bin or so and doesn't grow with the number of shards.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folium.session import cut


@dataclass(frozen=True)
class Limits:
    """Capacities of one kind of container. max_items and max_cost default to values that tokens alone imply."""

    tokens: int
    items: int | None = None
    cost: int | None = None

    @property
    def piece(self) -> int:
        """The longest item that an empty container holds."""
        return self.tokens if self.cost is None else min(self.tokens, math.isqrt(self.cost))

    def vector(self) -> np.ndarray:
        t = self.tokens
        return np.array([t, t if self.items is None else self.items, t * t if self.cost is None else self.cost], dtype=np.int64)


def pack_sizes(sizes: np.ndarray, limits: Limits, rule: str = "norm", weights: tuple[float, float, float] = (1.0, 0.05, 0.05)) -> np.ndarray:
    """Bin number of each size (1 to limits.tokens), bins counted from 0 in the order they are opened.

    rule is "norm" or "dot". Equal lengths are taken in the order given, so the result depends on the input alone.
    A size that no empty bin can hold under max_items or max_cost is refused with ValueError.
    """
    full, n = limits.vector(), len(sizes)
    out = np.full(n, -1, dtype=np.int64)
    if not n:
        return out
    order = np.argsort(sizes, kind="stable")
    kinds, first, count = np.unique(sizes[order], return_index=True, return_counts=True)
    kinds = kinds.astype(np.int64)
    if kinds[0] < 1 or kinds[-1] > full[0] or full[1] < 1 or kinds[-1] ** 2 > full[2]:
        raise ValueError("an item doesn't fit into an empty container")
    used = np.zeros(len(kinds), dtype=np.int64)
    demand = np.stack([kinds, np.ones_like(kinds), kinds * kinds], axis=1) / full
    w = np.asarray(weights, dtype=np.float64)
    free = np.ones(len(kinds), dtype=bool)
    left_items, bin_no = n, 0
    top = len(kinds) - 1
    while left_items:
        while not free[top]:
            top -= 1
        rest = full.copy()
        k = top  # each bin begins with the longest item that waits: it has the fewest partners
        while True:
            out[order[first[k] + used[k]]] = bin_no
            used[k] += 1
            left_items -= 1
            if used[k] == count[k]:
                free[k] = False
            rest -= (kinds[k], 1, kinds[k] * kinds[k])
            if not left_items or rest[0] < 1 or rest[1] < 1:
                break
            hi = int(np.searchsorted(kinds, min(rest[0], int(np.sqrt(rest[2]))), side="right"))
            can = np.flatnonzero(free[:hi])
            if not len(can):
                break
            r = rest / full
            if rule == "dot":
                score = demand[can] @ (w * r)
                k = int(can[len(can) - 1 - np.argmax(score[::-1])])
            else:
                left = r - demand[can]
                k = int(can[len(can) - 1 - np.argmin(((left * left) @ w)[::-1])])
        bin_no += 1
    return out


def pack(
    items: DataFrame, containers: DataFrame, id_col: str = "doc_id", size_col: str = "n_tokens", *,
    shard_rows: int = 50_000, rule: str = "norm", loose: float = 0.98, retry_bins: int = 32, fan_in: int = 32, items_limit: dict[str, int] | None = None, cost_limit: dict[str, int] | None = None,
) -> DataFrame:
    """(container_kind, capacity, bin, id_col, piece, start_token, n_tokens): where each item lies.

    items: one row an item; containers: container_kind, capacity_tokens (a few rows, broadcast). Only an item longer
    than an empty container holds is divided, into pieces of that length and a rest. Items of size 0 or null take no
    room and have no row; a null id is packed like any other; repeated rows are items of their own. Containers whose
    capacity is null or below 1 are left out, as are those of a limit below 1. bin is unique within a container_kind.
    items_limit and cost_limit give capacities of the other two dimensions by container_kind. Shards are made for the
    pieces there are. A shard gives at most its retry_bins loosest bins to the next round; the others stay as they are.
    """
    spark = items.sparkSession
    it, cl = items_limit or {}, cost_limit or {}
    boxes = [(r["container_kind"], int(r["capacity_tokens"])) for r in containers.select("container_kind", "capacity_tokens").where("capacity_tokens >= 1").distinct().collect()]
    limits = {k: Limits(c, it.get(k), cl.get(k)) for k, c in boxes if it.get(k, 1) >= 1 and cl.get(k, 1) >= 1}
    rows = [(k, c, limits[k].piece) for k, c in boxes if k in limits]
    kinds = spark.createDataFrame(rows or [("", 1, 1)], "container_kind string, capacity long, _most long").where(F.lit(bool(rows)))
    id_type = items.schema[id_col].dataType.simpleString()
    sized = items.select(F.col(id_col).alias("_id"), F.col(size_col).cast("long").alias("_n")).where("_n > 0")
    pieces = (
        sized.crossJoin(F.broadcast(kinds))  # a handful of containers, each item once for every one of them
        .withColumn("piece", F.explode(F.expr("sequence(0L, (_n - 1) div _most)")))
        .select("container_kind", "capacity", "_id", "piece", (F.col("piece") * F.col("_most")).alias("start_token"), F.least(F.col("_most"), F.col("_n") - F.col("piece") * F.col("_most")).alias("n_tokens"))
    )
    least = min((r[2] for r in rows), default=1)  # the kind with the most pieces
    n = sized.agg(F.coalesce(F.sum(F.expr(f"(_n - 1) div {least} + 1")), F.lit(0))).first()[0]
    out_schema = f"container_kind string, capacity long, bin long, _id {id_type}, piece long, start_token long, n_tokens long, _again boolean"

    def nearly_full(used: np.ndarray, b: np.ndarray, sizes: np.ndarray, lim: Limits) -> np.ndarray:
        """Bins nearly full in one of their capacities."""
        full = used >= loose * lim.tokens
        if lim.items is not None:
            full |= np.bincount(b) >= loose * lim.items
        if lim.cost is not None:
            full |= np.bincount(b, weights=sizes.astype(float) ** 2) >= loose * lim.cost
        return full

    def packer(stride: int):
        def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
            kind, shard = key[0], int(key[1])
            rows = rows.sort_values(["_id", "piece", "n_tokens"], kind="stable", ignore_index=True)
            sizes = rows["n_tokens"].to_numpy(np.int64)
            b = pack_sizes(sizes, limits[kind], rule)
            used = np.bincount(b, weights=rows["n_tokens"])
            again = np.zeros(len(used), dtype=bool)
            again[np.argsort(used, kind="stable")[:retry_bins]] = True
            rows["_again"] = (again & ~nearly_full(used, b, sizes, limits[kind]))[b]
            rows["bin"] = b * stride + shard
            return rows[["container_kind", "capacity", "bin", "_id", "piece", "start_token", "n_tokens", "_again"]]

        return run

    shards = max(1, -(-n // shard_rows))
    base, done = 0, None
    todo = pieces
    while True:
        key = F.pmod(F.xxhash64(F.col("_id"), F.col("piece")), F.lit(shards))
        # a number of partitions of its own, as small partitions would be put together though each costs much
        tasks = max(1, min(shards * max(1, len(rows)), 4 * spark.sparkContext.defaultParallelism))
        packed = todo.withColumn("_shard", key).repartition(tasks, "container_kind", "_shard").groupBy("container_kind", "_shard").applyInPandas(packer(shards), out_schema)
        if shards == 1:
            last = packed.withColumn("bin", F.col("bin") * 64 + base)
            done = last if done is None else done.unionByName(last)
            break
        packed = cut(packed)
        packed = packed.withColumn("bin", F.col("bin") * 64 + base)
        tight = packed.where("NOT _again")
        done = tight if done is None else done.unionByName(tight)
        todo = packed.where("_again").drop("bin", "_again")
        shards = max(1, shards // fan_in)
        base += 1
    return done.select("container_kind", "capacity", "bin", F.col("_id").alias(id_col), "piece", "start_token", "n_tokens")


def bin_report(packed: DataFrame) -> DataFrame:
    """(container_kind, capacity, bins, pieces, tokens, least_bins, fill): how well each container is used.

    least_bins is the bound no packing can beat, the tokens over the capacity rounded up. No rows in, no rows out.
    """
    bins = packed.groupBy("container_kind", "capacity", "bin").agg(F.count("*").alias("p"), F.sum("n_tokens").alias("t"))
    return bins.groupBy("container_kind", "capacity").agg(F.count("*").alias("bins"), F.sum("p").alias("pieces"), F.sum("t").alias("tokens")).withColumns({
        "least_bins": F.ceil(F.col("tokens") / F.col("capacity")), "fill": F.round(F.col("tokens") / (F.col("bins") * F.col("capacity")), 6)})


__all__ = ["Limits", "bin_report", "pack", "pack_sizes"]
