"""Structured streaming: windowed counts of events, first arrivals, and the pending-orphan state fed batch by batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from folium.operators import graph, orphans


def read_feed(spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int = 8) -> DataFrame:
    """Parquet files as they arrive in a folder."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def timed(rows: DataFrame, time: str, late: str | None) -> DataFrame:
    """A stream with a watermark on its time, which a watermark wants with a zone; a table as it is.

    late None: the stream has its watermark from an earlier step, and a second one isn't allowed.
    """
    return rows.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, late) if rows.isStreaming and late is not None else rows


def windowed(events: DataFrame, time: str = "ts", by: str = "event_type", value: str = "value", size: str = "1 hour", late: str | None = "10 minutes") -> DataFrame:
    """(start, by, n, total): tumbling windows; events later than `late` behind the newest are dropped by the watermark.

    The same expression serves a stream and a table; over a table nothing is late.
    """
    e = timed(events, time, late)
    return e.groupBy(F.window(time, size).alias("w"), by).agg(F.count("*").alias("n"), F.sum(value).alias("total")).select(F.col("w.start").alias("start"), by, "n", "total")


def sessions(events: DataFrame, time: str = "ts", by: str = "user_id", gap: str = "30 minutes", late: str | None = "10 minutes") -> DataFrame:
    """(by, start, end, n): runs of events with no gap of that length between them."""
    e = timed(events, time, late)
    return e.groupBy(by, F.session_window(time, gap).alias("w")).agg(F.count("*").alias("n")).select(by, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")


def first_arrivals(rows: DataFrame, key: str, time: str, late: str = "1 day") -> DataFrame:
    """Each key once within the time that late rows are waited for."""
    return timed(rows, time, late).dropDuplicatesWithinWatermark([key]) if rows.isStreaming else rows.dropDuplicates([key])


class OrphanFeed:
    """Keeps an OrphanState over batches of references and of parent rows, and hands a snapshot on after each."""

    def __init__(self, on_snapshot: Callable[[int, DataFrame], None]):
        self.state, self.on_snapshot, self.steps = orphans.OrphanState(), on_snapshot, 0

    def take(self, refs: DataFrame, parents: DataFrame) -> None:
        self._step(refs, orphans.parent_events(parents))

    def _step(self, refs: DataFrame, events: DataFrame) -> None:
        self.state = self.state.step(orphans.references(refs), events)
        self.steps += 1
        self.on_snapshot(self.steps, self.state.snapshot())

    def _news(self, events: DataFrame) -> DataFrame:
        """What events of the whole parents' table add to or take from those the state knows, by key and time."""
        if not self.state.index:
            return events
        sums = [F.sum("came").cast("int").alias("came"), F.sum("here").cast("int").alias("here")]
        now = events.groupBy("key", "t").agg(*sums).withColumn("n", F.lit(1))
        old = self.state.events.groupBy("key", "t").agg(*sums).select("key", "t", -F.col("came").alias("came"), -F.col("here").alias("here"), F.lit(-1).alias("n"))
        old = old.toDF("key", "t", "came", "here", "n")
        d = now.unionByName(old).groupBy("key", "t").agg(*sums, F.sum("n").alias("n"))
        return d.where("came <> 0 OR here <> 0 OR n > 0").select("key", "t", "came", "here")

    def follow(self, refs: DataFrame, parents: DataFrame | Callable[[], DataFrame], checkpoint: str, **trigger: object) -> StreamingQuery:
        """References stream in; with each batch the whole parents' table is held against what is known of it.

        So late rows, rows without a time, and deletions of known rows count as soon as a batch comes. parents may be a
        function that gives the table as it is then. A key once known stays known.
        """

        def batch(rows: DataFrame, _: int) -> None:
            self._step(rows, self._news(orphans.parent_events(parents() if callable(parents) else parents)))

        return refs.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def upsert_feed(nodes: DataFrame, path: str, order: list[str], checkpoint: str) -> StreamingQuery:
    """Loads node batches into a store by id; each batch writes a new version, and the last finished one counts."""

    def batch(rows: DataFrame, n: int) -> None:
        spark = rows.sparkSession
        old = spark.read.parquet(f"{path}/v={n - 1}") if n else None
        graph.upsert_nodes(old, rows, order).write.mode("overwrite").parquet(f"{path}/v={n}")

    return nodes.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
