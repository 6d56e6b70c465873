"""Problem 4: references to records that aren't there, kept up to date as both sides arrive.

Method: pending-orphan state. The state holds the parents' index (arrivals and deletions by key), the references known
so far and which of them wait without a parent. A step takes new references and new parent events: new references probe
the index, parents that arrive resolve the references that wait for their key (or turn `missing` into `late`), deletions
open them again. Only references whose key had news are judged again, so a step costs its news, not its past; any way of
dividing the feed into steps gives the same state. Counts by side, period and reason are a snapshot of it.

Judging is a running count over the events of a key: at an instant a row is there if more rows have come than gone.
The count is taken within slices of (key, day), with what earlier days carry over computed from pre-aggregated sums, so
a key that holds a third of all references is spread over as many tasks as it has days.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folium.session import cut

BLANK = r"[\s\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"


def token(c: Column) -> Column:
    """A reference without surrounding blanks; null if nothing is left."""
    c = c.cast("string")
    t = F.regexp_replace(F.regexp_replace(c, f"^{BLANK}", ""), f"{BLANK}$", "")
    return F.when(t != "", t)


def references(df: DataFrame, ref_id: str = "rel_id", sides: tuple[str, ...] = ("parent_node", "child_node"), seen: str = "seen_at") -> DataFrame:
    """(ref_id, side, key, t): one row for each side that refers to something. Null and blank values refer to nothing."""
    pairs = F.array(*[F.struct(F.lit(s).alias("side"), token(F.col(s)).alias("key")) for s in sides])
    return df.select(F.col(ref_id).alias("ref_id"), F.col(seen).alias("t"), F.explode(pairs).alias("p")).select("ref_id", "p.side", "p.key", "t").where("key IS NOT NULL")


def parent_events(df: DataFrame, key: str = "id", loaded: str = "loaded_at", deleted: str = "deleted_at") -> DataFrame:
    """(key, t, came, here): what each parent row does to its key, and when.

    came counts rows loaded, here the change of rows present. A row deleted before or when it's loaded came but was
    never here. A row without a loading time is known (t null, no change) but never here. Null keys are left out.
    """
    valid = F.col("d").isNull() | (F.col("d") > F.col("l"))
    rows = df.select(F.col(key).alias("key"), F.col(loaded).alias("l"), F.col(deleted).alias("d")).where("key IS NOT NULL").distinct()
    come = F.struct(F.col("l").alias("t"), F.when(F.col("l").isNotNull(), 1).otherwise(0).alias("came"), F.when(F.col("l").isNotNull() & valid, 1).otherwise(0).alias("here"))
    go = F.when(F.col("l").isNotNull() & F.col("d").isNotNull() & valid, F.struct(F.col("d").alias("t"), F.lit(0).alias("came"), F.lit(-1).alias("here")))
    return rows.select("key", F.explode(F.array_compact(F.array(come, go))).alias("e")).select("key", "e.*")


def judge(refs: DataFrame, events: DataFrame) -> DataFrame:
    """refs with `reason`: null if a parent is there at t, else missing, deleted or late.

    A reference without a time can't be placed in the history: its reason is missing if no parent row has its key, else
    null. An event at t counts for a reference at t.
    """
    day = F.to_date("t")
    ref = F.lit(None).cast("long")
    e = events.select("key", "t", "came", "here", F.lit(0).alias("is_ref"), ref.alias("ref_id"), F.lit(None).cast("string").alias("side"))
    r = refs.select("key", "t", F.lit(0).alias("came"), F.lit(0).alias("here"), F.lit(1).alias("is_ref"), F.col("ref_id"), "side")
    e = e.withColumn("ref_id", F.col("ref_id").cast(refs.schema["ref_id"].dataType))
    both = e.unionByName(r).withColumn("day", day)
    days = both.groupBy("key", "day").agg(F.sum("came").alias("d_came"), F.sum("here").alias("d_here"), F.sum(1 - F.col("is_ref")).alias("d_rows"))
    before = Window.partitionBy("key").orderBy("day").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("key")
    days = days.select("key", "day", F.coalesce(F.sum("d_came").over(before), F.lit(0)).alias("b_came"), F.coalesce(F.sum("d_here").over(before), F.lit(0)).alias("b_here"), F.sum("d_rows").over(whole).alias("rows"))
    inside = Window.partitionBy("key", "day").orderBy("t", "is_ref").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    run = both.withColumns({"s_came": F.sum("came").over(inside), "s_here": F.sum("here").over(inside)}).where("is_ref = 1")
    out = run.join(days, (run["key"] == days["key"]) & run["day"].eqNullSafe(days["day"])).select(run["ref_id"], run["side"], run["key"], run["t"], (F.col("s_came") + F.col("b_came")).alias("n_came"), (F.col("s_here") + F.col("b_here")).alias("n_here"), "rows")
    reason = F.when(F.col("rows") == 0, "missing").when(F.col("t").isNull() | (F.col("n_here") > 0), F.lit(None)).when(F.col("n_came") > 0, "deleted").otherwise("late")
    return out.select("ref_id", "side", "key", "t", reason.alias("reason"))


def _union(parts: tuple[DataFrame, ...]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@dataclass
class OrphanState:
    """What is known after some steps, in parts that are only ever added to.

    refs: (ref_id, side, key, t, reason), those with a reason wait; events: the parents' index. A step writes a part
    with what it judged and hides the rows it judged anew in older parts; after compact_every steps they are written
    as one.
    """

    parts: tuple[DataFrame, ...] = ()
    index: tuple[DataFrame, ...] = ()
    compact_every: int = 8

    @property
    def refs(self) -> DataFrame:
        return _union(self.parts)

    @property
    def events(self) -> DataFrame:
        return _union(self.index)

    def step(self, new_refs: DataFrame, new_events: DataFrame) -> OrphanState:
        """The state after new references and parent events; what is new is written to the shared folder.

        Of the known references those are judged again whose key has news that reach back to their time, and those
        whose key was missing. The rest is neither moved nor written.
        """
        added = cut(new_events)
        index = (*self.index, added)
        todo, older = new_refs.select("ref_id", "side", "key", "t"), self.parts
        if self.parts:
            news = added.groupBy(F.col("key").alias("_k")).agg(F.min("t").alias("_from"))
            back = (F.col("key") == F.col("_k")) & ((F.col("reason") == "missing") | F.coalesce(F.col("t") >= F.col("_from"), F.lit(True)))
            again = cut(self.refs.join(news, back, "left_semi").select("ref_id", "side", "key", "t"))
            ids = again.select(F.col("ref_id").alias("_r"), F.col("side").alias("_s"), F.col("t").alias("_t"), F.col("key").alias("_k")).distinct()
            same = (F.col("ref_id") == F.col("_r")) & (F.col("side") == F.col("_s")) & (F.col("key") == F.col("_k")) & F.col("t").eqNullSafe(F.col("_t"))
            older = tuple(p.join(ids, same, "left_anti") for p in self.parts)
            todo = todo.unionByName(again)
        known = _union(index)
        if len(index) > 1:
            known = known.join(todo.select("key").distinct(), "key", "left_semi")
        parts = (*older, cut(judge(todo, known)))
        if len(parts) > self.compact_every:
            parts, index = (cut(_union(parts)),), (cut(_union(index)),)
        return OrphanState(parts, index, self.compact_every)

    def pending(self) -> DataFrame:
        """(ref_id, side, key, t, reason) of the references without a parent."""
        return self.refs.where("reason IS NOT NULL")

    def snapshot(self) -> DataFrame:
        """(side, period, reason, n): pending references per side and month; period is yyyy-MM, null without a time."""
        return self.pending().groupBy("side", F.date_format("t", "yyyy-MM").alias("period"), "reason").agg(F.count("*").alias("n"))


def replay(refs: DataFrame, events: DataFrame, bounds: list[datetime] | None = None) -> OrphanState:
    """The state after a whole feed, taken in steps that end at bounds (by time; what has none comes last)."""
    state, low = OrphanState(), None
    for b in [*(bounds or []), None]:
        def part(d: DataFrame, low=low, b=b) -> DataFrame:
            c = F.lit(True) if low is None else F.coalesce(F.col("t") >= F.lit(low), F.lit(b is None))
            return d.where(c if b is None else c & (F.col("t") < F.lit(b)))

        state, low = state.step(part(refs), part(events)), b
    return state
