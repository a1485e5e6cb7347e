"""Places of rows within groups of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textloom.plans.lineage import cut


def _beside(rows: DataFrame, other: DataFrame, keys: dict[str, str]) -> DataFrame:
    """Joined on rows' key = other's, null equal to null; other's keys are dropped."""
    same = F.lit(True)
    for mine, theirs in keys.items():
        same = same & F.col(mine).eqNullSafe(F.col(theirs))
    return rows.join(other, same).drop(*keys.values())


def numbered(rows: DataFrame, order: str, *by: str) -> DataFrame:
    """Adds number: the row's place, from 0, in order of `order` within its group (by); order not null and unique in a group,
    null a group of its own.

    Rows are dealt by ranges of group and order, so a group as large as the table lies in many partitions; each is numbered
    by itself and shifted by the sizes of the group's partitions before it. The ranges are stored, as they are sampled.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = cut(rows.repartitionByRange(parts, *by, order).withColumn("_part", F.spark_partition_id()))
    sizes = placed.groupBy(*by, "_part").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shift = sizes.select(*(F.col(c).alias(f"_of_{c}") for c in by), F.col("_part").alias("_of_part"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_shift"))
    rank = F.row_number().over(Window.partitionBy(*by, "_part").orderBy(order))
    joined = _beside(placed.withColumn("_rank", rank), shift, {**{c: f"_of_{c}" for c in by}, "_part": "_of_part"})
    return joined.withColumn("number", F.col("_shift") + F.col("_rank") - 1).drop("_part", "_rank", "_shift")


def next_in_group(rows: DataFrame, order: str, by: str, *columns: str) -> DataFrame:
    """Rows that have a next one in their group, with its columns under next_<name>."""
    placed = cut(numbered(rows, order, by))
    after = placed.select(F.col(by).alias("_of_group"), (F.col("number") - 1).alias("_of_number"), *(F.col(c).alias(f"next_{c}") for c in columns))
    return _beside(placed, after, {by: "_of_group", "number": "_of_number"}).drop("number")
