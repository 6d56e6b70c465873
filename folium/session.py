"""Session defaults and the few helpers that every operator shares."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

#: Settings the operators rely on; none of them fixes a size, so a cluster's own sizing stays in force.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.sql.variant.allowDuplicateKeys": "true",
}


def build_session(app: str = "folium", master: str | None = None, **conf: str) -> SparkSession:
    """A session with DEFAULTS; conf overrides them."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    return b.config(map=DEFAULTS | conf).getOrCreate()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The Parquet table `name` under sf_dir."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """df with its lineage cut by a reliable checkpoint, which outlives any executor.

    The folder is the session's spark.checkpoint.dir; only where that is unset, as in tests, a local one is made.
    """
    spark = df.sparkSession
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(spark.conf.get("spark.checkpoint.dir", None) or tempfile.mkdtemp(prefix="folium-"))
    return df.checkpoint()


def slots(spark: SparkSession, most: int = 64) -> int:
    """Tasks that run at once, between 1 and most."""
    return max(1, min(most, spark.sparkContext.defaultParallelism))


def lowest(df: DataFrame, h: str, most: int, n: int | None = None) -> DataFrame:
    """The rows of the `most` lowest values of h, a 64-bit hash: a bounded sample that doesn't depend on how df is divided.

    Where df is larger, values that can't be among the lowest are filtered out first, by its size n, so that only about
    as many rows as wanted are ever sorted.
    """
    from pyspark.sql import functions as F

    n = df.count() if n is None else n
    if n > most:
        top = min(1.0, 1.2 * most / n + 50 / n)
        if top < 1:
            df = df.where(F.col(h) < F.lit(int(-(2**63) + top * (2**64 - 1))))
    return df.orderBy(h).limit(most)
