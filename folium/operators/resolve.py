"""References by id, name or source_type to node ids, with nodes made up for what can't be resolved.

The three ways are equi-joins with first-wins tables that are built by combining aggregates; none is broadcast by
decree, so the planner decides by size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folium.functions import lexicon as lx
from folium.functions.text import strip


def relation_type_column(columns: list[str]) -> str | None:
    """The column that holds a relation's type: the first known name that is there."""
    return next((c for c in lx.RELATION_TYPE_COLUMNS if c in columns), None)


def canonical_key() -> Column:
    s, t = strip(F.coalesce("source", F.lit(""))), strip(F.coalesce("type", F.lit("")))
    return F.when((s != "") & (t != ""), F.concat(s, F.lit("_"), t))


def node_index(nodes: DataFrame, order: list[str]) -> DataFrame:
    """(key, by_id, name_hit, name_id, canon_id): all that a token may resolve to; the first node by order wins.

    A name may lead to an empty id, which resolves to nothing but ends the search.
    """
    o = F.struct(*[F.col(c) for c in order])
    nid, name = strip(F.coalesce("id", F.lit(""))), strip(F.coalesce("name", F.lit("")))
    rows = nodes.select(o.alias("o"), nid.alias("nid"), F.explode(F.array(F.struct(F.lit("i").alias("way"), nid.alias("key")), F.struct(F.lit("n").alias("way"), name.alias("key")), F.struct(F.lit("c").alias("way"), canonical_key().alias("key")))).alias("k")).where("k.key <> ''")
    way = F.col("k.way")
    pick = {w: F.min_by(F.when(way == w, F.col("nid")), F.when(way == w, F.col("o"))) for w in ("n", "c")}
    return rows.groupBy(F.col("k.key").alias("key")).agg(F.max(F.when(way == "i", F.col("nid"))).alias("by_id"), F.max((way == "n").cast("int")).alias("name_hit"), pick["n"].alias("name_id"), pick["c"].alias("canon_id"))


def _resolved(key: Column) -> Column:
    canon = F.when(key.contains("_"), F.col("canon_id"))
    out = F.when(F.col("by_id").isNotNull(), F.col("by_id")).when(F.col("name_hit") == 1, F.col("name_id")).otherwise(canon)
    return F.when(out != "", out)


def _look_up(df: DataFrame, token: str, index: DataFrame, out: str) -> DataFrame:
    key = strip(F.coalesce(F.col(token), F.lit("")))
    d = df.withColumn("_key", F.when(key != "", key))
    j = d.join(index.withColumnRenamed("key", "_ikey"), F.col("_key") == F.col("_ikey"), "left")
    return j.withColumn(out, _resolved(F.col("_key"))).drop("_key", "_ikey", "by_id", "name_hit", "name_id", "canon_id")


def resolve(rels: DataFrame, nodes: DataFrame, *, node_order: list[str], allow_orphans: bool = False, default_type: str = lx.EDGE_TYPE, captures: dict[str, tuple[object, str]] | None = None, order: str = "ord") -> DataFrame:
    """rels (parent_node, child_node, type, order) with start_id, end_id, etype, made_start, made_end.

    A child that is a base type and resolves to nothing is looked for in the parent's own source; with allow_orphans it
    gets that id, and everything else unresolved an id of its own. Without, start_id or end_id stay null. captures: base
    type to (order, id) of nodes made up before, to which later bare tokens lead.
    """
    index = node_index(nodes, node_order)
    # of nodes with one id the last one's source counts
    src = nodes.groupBy("id").agg(F.max_by("source", F.struct(*[F.col(c) for c in node_order])).alias("_src"))
    d = _look_up(_look_up(rels, "parent_node", index, "_s"), "child_node", index, "_e")
    raw_p, raw_c = F.coalesce("parent_node", F.lit("")), F.coalesce("child_node", F.lit(""))
    for t, (at, made) in (captures or {}).items():
        later = F.col(order) > F.lit(at)
        for raw, out in ((raw_p, "_s"), (raw_c, "_e")):
            hit = later & ((strip(raw) == t) | (strip(raw) == made))
            d = d.withColumn(out, F.when(hit & (F.col(out).isNull() | (strip(raw) == t) & F.lit(True)), F.lit(made)).otherwise(F.col(out)))
    d = d.join(src.withColumnRenamed("id", "_sid"), F.col("_s") == F.col("_sid"), "left").drop("_sid")
    own = strip(F.coalesce("_src", F.lit("")))
    own = F.when(own != "", own).when(F.col("_s").contains("_"), F.substring_index("_s", "_", 1))
    base = F.col("_e").isNull() & raw_c.isin(*lx.BASE_TYPES) & F.col("_s").isNotNull()
    d = d.withColumn("_cand", F.when(base & (own != ""), F.concat(own, F.lit("_"), raw_c)))
    d = _look_up(d, "_cand", index, "_ce")
    end = F.coalesce("_e", "_ce")
    made_base = F.when(end.isNull(), F.col("_cand"))
    start_id, end_id = F.col("_s"), end
    if allow_orphans:
        start_id = F.coalesce(start_id, F.concat(F.lit("ORPHAN::"), raw_p))
        end_id = F.coalesce(end_id, made_base, F.concat(F.lit("ORPHAN::"), raw_c))
    etype = strip(F.coalesce("type", F.lit("")))
    return d.withColumns({
        "start_id": start_id, "end_id": end_id, "etype": F.when(etype != "", etype).otherwise(default_type), "candidate": made_base,
        "made_start": F.lit(allow_orphans) & F.col("_s").isNull(), "made_end": F.lit(allow_orphans) & end.isNull(),
    }).drop("_s", "_e", "_src", "_cand", "_ce")


def capture_bare_types(rels: DataFrame, nodes: DataFrame, node_order: list[str], order: str = "ord") -> dict[str, tuple[object, str]]:
    """Base type to (order, id) of the first node made up for it, to which every later bare token of that type leads.

    That is how a single pass over the relations behaves that adds to its index as it goes. There are seven base types,
    so at most seven rounds find one each; every round is one distributed pass that returns a row.
    """
    found: dict[str, tuple[object, str]] = {}
    for _ in lx.BASE_TYPES:
        d = resolve(rels, nodes, node_order=node_order, captures=found, order=order).where(F.col("candidate").isNotNull())
        if found:
            d = d.where(~F.col("child_node").isin(*found))
        row = d.agg(F.min(F.struct(F.col(order).alias("o"), F.col("child_node").alias("t"), F.col("candidate").alias("c"))).alias("m")).first()["m"]
        if row is None:
            break
        found[row["t"]] = (row["o"], row["c"])
    return found


def resolved_edges(resolved: DataFrame) -> DataFrame:
    """(start_id, end_id, type), each once; those with an unresolved end are left out."""
    return resolved.where("start_id IS NOT NULL AND end_id IS NOT NULL").select("start_id", "end_id", F.col("etype").alias("type")).distinct()


def unresolved_count(resolved: DataFrame) -> DataFrame:
    return resolved.where("start_id IS NULL OR end_id IS NULL").agg(F.count("*").alias("missing_pairs"))


def made_nodes(resolved: DataFrame) -> DataFrame:
    """(id, name, type, source) of the nodes made up, each once."""
    base = F.col("candidate").isNotNull()
    ends = resolved.where("made_end").select(F.col("end_id").alias("id"), F.coalesce("child_node", F.lit("")).alias("name"), F.when(base, F.col("child_node")).otherwise("orphan").alias("type"), F.when(base, F.expr("left(end_id, length(end_id) - length(child_node) - 1)")).otherwise("relations").alias("source"))
    starts = resolved.where("made_start").select(F.col("start_id").alias("id"), F.coalesce("parent_node", F.lit("")).alias("name"), F.lit("orphan").alias("type"), F.lit("relations").alias("source"))
    alls = starts.unionByName(ends)
    return alls.groupBy("id").agg(F.min(F.struct("name", "type", "source")).alias("m")).select("id", "m.*")
