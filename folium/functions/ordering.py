"""Global numbering without a single task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from folium.session import cut


def number_rows(df: DataFrame, *order: str, name: str = "k") -> DataFrame:
    """df with consecutive numbers from 1 in the order given, which must be total.

    Rows are divided into ranges and sorted within them; the ranges' sizes, one row each, give the offsets. The
    ranges are written before they are counted, so both passes see the same division.
    """
    ranged = cut(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_mid", F.monotonically_increasing_id()))
    part, at = F.shiftright("_mid", 33), F.col("_mid").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = ranged.groupBy(part.alias("_p")).agg(F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = sizes.select("_p", before.alias("_o"))  # a row a range
    return ranged.withColumn("_p", part).join(F.broadcast(offsets), "_p").withColumn(name, at + F.col("_o") + 1).drop("_p", "_o", "_mid")
