import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from folium.llm.packing import Limits, bin_report, pack, pack_sizes


@pytest.mark.parametrize("rule", ["norm", "dot"])
@pytest.mark.parametrize("limits", [Limits(100), Limits(100, items=4), Limits(100, cost=4000)])
def test_constraints_and_quality(rule, limits):
    rng = np.random.default_rng(1)
    sizes = rng.integers(1, 61, 900)
    bins = pack_sizes(sizes, limits, rule)
    full = limits.vector()
    for b in range(bins.max() + 1):
        own = sizes[bins == b]
        assert len(own) and own.sum() <= full[0] and len(own) <= full[1] and (own**2).sum() <= full[2]
    bound = max(-(-sizes.sum() // full[0]), -(-len(sizes) // full[1]), -(-(sizes**2).sum() // full[2]))
    assert bins.max() + 1 <= bound * 1.12 + 1
    assert (pack_sizes(sizes, limits, rule) == bins).all()


def test_small_against_exhaustive():
    rng = random.Random(2)

    def least(items, cap):
        best = len(items)

        def go(k, bins):
            nonlocal best
            if len(bins) >= best:
                return
            if k == len(items):
                best = len(bins)
                return
            for i in range(len(bins)):
                if bins[i] + items[k] <= cap:
                    bins[i] += items[k]
                    go(k + 1, bins)
                    bins[i] -= items[k]
            go(k + 1, [*bins, items[k]])

        go(0, [])
        return best

    for _ in range(60):
        s = sorted((rng.randrange(1, 11) for _ in range(8)), reverse=True)
        assert pack_sizes(np.array(s), Limits(10)).max() + 1 <= least(s, 10) + 1


def test_refused():
    with pytest.raises(ValueError, match="fit"):
        pack_sizes(np.array([11]), Limits(10))
    with pytest.raises(ValueError, match="fit"):
        pack_sizes(np.array([9]), Limits(10, cost=80))
    assert len(pack_sizes(np.array([], dtype=int), Limits(10))) == 0


def whole(spark, items, boxes, **how):
    return pack(spark.createDataFrame(items, "doc_id long, n_tokens long, bin string"), spark.createDataFrame(boxes, "container_kind string, capacity_tokens int"), **how)


@pytest.mark.parametrize("shard_rows", [10_000, 150])
def test_distributed(spark, shard_rows):
    rng = random.Random(3)
    items = [(k, rng.choice([0, None, rng.randrange(1, 90), rng.randrange(1, 400)]), "x") for k in range(2000)]
    got = whole(spark, items, [("small", 100), ("large", 1000), ("none", None)], shard_rows=shard_rows, fan_in=4)
    for kind, cap in (("small", 100), ("large", 1000)):
        g = got.where(F.col("container_kind") == kind)
        assert g.groupBy("bin").agg(F.sum("n_tokens").alias("n")).where(F.col("n") > cap).isEmpty()
        per = {r["doc_id"]: (r["n"], r["p"], r["m"]) for r in g.groupBy("doc_id").agg(F.sum("n_tokens").alias("n"), F.count("*").alias("p"), F.max("n_tokens").alias("m")).collect()}
        assert per.keys() == {k for k, n, _ in items if n}
        assert all(per[k][0] == n and per[k][1] == -(-n // cap) for k, n, _ in items if n)
        assert g.groupBy("doc_id", "piece").count().where("count > 1").isEmpty()
    rep = {r["container_kind"]: r for r in bin_report(got).collect()}
    assert set(rep) == {"small", "large"} and all(r["bins"] <= r["least_bins"] * 1.03 + 2 for r in rep.values())


@pytest.mark.parametrize("shard_rows", [10_000, 150])
def test_all_limits_hold(spark, shard_rows):
    rng = random.Random(5)
    items = [(k, rng.randrange(1, 30) if k % 3 else rng.randrange(60, 400), "x") for k in range(1500)]
    got = whole(spark, items, [("a", 100), ("b", 1000), ("zero", 50)], shard_rows=shard_rows, fan_in=4, items_limit={"a": 4, "b": 20, "zero": 0}, cost_limit={"a": 5000, "b": 300_000})
    assert {r["container_kind"] for r in got.select("container_kind").distinct().collect()} == {"a", "b"}
    bins = got.groupBy("container_kind", "bin").agg(F.sum("n_tokens").alias("n"), F.count("*").alias("k"), F.sum(F.col("n_tokens") ** 2).alias("c"))
    for kind, cap, most, cost, piece in (("a", 100, 4, 5000, 70), ("b", 1000, 20, 300_000, 547)):
        b = bins.where(F.col("container_kind") == kind)
        assert b.where((F.col("n") > cap) | (F.col("k") > most) | (F.col("c") > cost)).isEmpty()
        sizes = [min(piece, n - s) for _, n, _ in items for s in range(0, n, piece)]
        bound = max(-(-sum(sizes) // cap), -(-len(sizes) // most), -(-sum(s * s for s in sizes) // cost))
        alone = pack_sizes(np.array(sizes), Limits(cap, most, cost)).max() + 1  # all in one shard
        assert bound <= b.count() <= alone * 1.03 + 2
        g = got.where(F.col("container_kind") == kind)
        assert {r["doc_id"]: r["n"] for r in g.groupBy("doc_id").agg(F.sum("n_tokens").alias("n")).collect()} == {k: n for k, n, _ in items}


def test_very_long_items_make_shards_of_their_pieces(spark):
    items = [(k, 5000, "x") for k in range(20)]
    got = whole(spark, items, [("a", 10)], shard_rows=2000)
    assert got.count() == 10_000 == got.select("bin").distinct().count()


def test_edges(spark):
    assert whole(spark, [], [("a", 10)]).isEmpty()
    assert whole(spark, [(1, 5, "x")], []).isEmpty()
    same = whole(spark, [(1, 6, "x"), (1, 6, "x"), (None, 4, "x")], [("a", 10)])
    assert same.count() == 3 and same.select("bin").distinct().count() == 2
