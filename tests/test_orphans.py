import random
from datetime import datetime, timedelta

from folium.operators import orphans
from folium.streaming import feeds
from tests.conftest import rows

T0 = datetime(2024, 1, 1)


def feed(spark, seed=1, n=300):
    rng = random.Random(seed)
    ids = [f"n{k}" for k in range(12)]
    at = lambda: T0 + timedelta(hours=rng.randrange(24 * 40))
    nodes = []
    for _ in range(40):
        a = at()
        nodes.append((rng.choice(ids), a if rng.random() < 0.95 else None, a + timedelta(hours=rng.randrange(-2, 300)) if rng.random() < 0.5 else None))
    nodes += nodes[:5] + [(None, T0, None)]
    rels = []
    for k in range(n):
        side = lambda: rng.choice([*ids, "n1", "n1", " n2 ", "gone", "", "  ", None])
        rels.append((k, side(), side(), at() if rng.random() < 0.97 else None, "extra"))
    return spark.createDataFrame(nodes, "id string, loaded_at timestamp, deleted_at timestamp"), spark.createDataFrame(rels, "rel_id long, parent_node string, child_node string, seen_at timestamp, key string"), nodes, rels


def brute(nodes, rels):
    out = set()
    for rid, p, c, t, _ in rels:
        for side, v in (("parent_node", p), ("child_node", c)):
            v = (v or "").strip()
            if not v:
                continue
            own = [(a, b) for i, a, b in nodes if i == v]
            if not own:
                out.add((rid, side, "missing"))
            elif t is not None and not any(a is not None and a <= t and (b is None or b > t) for a, b in own):
                out.add((rid, side, "deleted" if any(a is not None and a <= t for a, b in own) else "late"))
    return out


def found(state):
    return rows(state.pending().select("ref_id", "side", "reason"))


def test_matches_brute_force_in_any_steps(spark):
    n, r, nodes, rels = feed(spark)
    want = brute(nodes, rels)
    refs, ev = orphans.references(r), orphans.parent_events(n)
    assert found(orphans.replay(refs, ev)) == want
    assert found(orphans.replay(refs, ev, [T0 + timedelta(days=9), T0 + timedelta(days=25)])) == want


def test_any_order_of_arrival(spark):
    n, r, nodes, rels = feed(spark, seed=5, n=120)
    refs, ev = orphans.references(r), orphans.parent_events(n)
    s = orphans.OrphanState(compact_every=3)
    for k in range(4):  # neither side in order of time
        s = s.step(refs.where(f"pmod(ref_id, 4) = {k}"), ev.where(f"pmod(hash(key, t), 4) = {k}"))
    assert found(s) == brute(nodes, rels)


def test_arrivals_resolve_and_deletions_reopen(spark):
    r = spark.createDataFrame([(1, "a", None, T0 + timedelta(days=5))], "rel_id long, parent_node string, child_node string, seen_at timestamp")
    none = spark.createDataFrame([], "id string, loaded_at timestamp, deleted_at timestamp")
    s = orphans.OrphanState().step(orphans.references(r), orphans.parent_events(none))
    assert found(s) == {(1, "parent_node", "missing")}
    no_refs = orphans.references(r.limit(0))
    up = spark.createDataFrame([("a", T0, None)], none.schema)
    s = s.step(no_refs, orphans.parent_events(up))
    assert found(s) == set()
    gone = orphans.parent_events(up).selectExpr("key", "timestamp'2024-01-03' AS t", "0 AS came", "-1 AS here")
    s = s.step(no_refs, gone)
    assert found(s) == {(1, "parent_node", "deleted")}
    assert rows(s.snapshot()) == {("parent_node", "2024-01", "deleted", 1)}


def test_empty(spark):
    n, r, *_ = feed(spark)
    assert found(orphans.replay(orphans.references(r.limit(0)), orphans.parent_events(n))) == set()
    got = found(orphans.replay(orphans.references(r), orphans.parent_events(n.limit(0))))
    assert {x[2] for x in got} == {"missing"}


def test_feed_sees_late_rows_and_deletions(spark, tmp_path):
    schema = "rel_id long, parent_node string, child_node string, seen_at timestamp"
    day = lambda k: T0 + timedelta(days=k)
    refs = [(1, "a", None, day(5)), (2, "late", None, day(5)), (3, "none", None, day(5))]
    tables = [[("a", T0, None), ("new", day(9), None)], [("a", T0, day(2)), ("new", day(9), None), ("late", day(1), None), ("none", None, None)]]
    nodes = "id string, loaded_at timestamp, deleted_at timestamp"
    now = [tables[0]]
    feed = feeds.OrphanFeed(lambda n, snap: None)
    for k, want in enumerate(({(2, "missing"), (3, "missing")}, {(1, "deleted"), (3, "late")}, {(1, "deleted"), (3, "late")})):
        now[0] = tables[min(k, 1)]
        spark.createDataFrame(refs if not k else [(9 + k, "new", None, day(10))], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        q = feed.follow(feeds.read_feed(spark, str(tmp_path / "in"), spark.createDataFrame([], schema).schema), lambda: spark.createDataFrame(now[0], nodes), str(tmp_path / "cp"))
        q.awaitTermination(60)
        assert q.exception() is None
        assert rows(feed.state.pending().select("ref_id", "reason")) == want
