"""Running sums over tables of any size, without a window over all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage


def with_running_sum(rows: DataFrame, value: Column, order: list[str], group: tuple[str, ...] = (),
                     name: str = "before") -> DataFrame:
    """``rows`` with the sum of ``value`` over the rows before them in
    ``order`` (a key: ties fall in any order), per ``group``. Two levels: rows
    are dealt over ranges of (group, order), ranges are added up, and a row's
    sum is that of its group's earlier ranges plus that of the rows before it
    in its own. A group of any size is spread over ranges; the window over
    ranges has one row per range and group."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = cut_lineage(rows.withColumn("_value", value).repartitionByRange(parts, *group, *order)
                         .withColumn("_range", F.spark_partition_id()))
    earlier = Window.partitionBy(*group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sums = ranged.groupBy(*group, "_range").agg(F.sum("_value").alias("_sum")).select(
        *[F.col(g).alias(f"_of_{g}") for g in group], F.col("_range").alias("_of"),
        F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_earlier"))
    inside = Window.partitionBy(*group, "_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    same = F.col("_range") == F.col("_of")
    for g in group:
        same = same & F.col(g).eqNullSafe(F.col(f"_of_{g}"))
    return ranged.withColumn("_inside", F.coalesce(F.sum("_value").over(inside), F.lit(0))).join(sums, same) \
        .select(*rows.columns, (F.col("_earlier") + F.col("_inside")).alias(name))
