"""Window operators.  Global orders run on aggregated or dimension tables, never on raw facts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from ..scratch import cut_lineage


def numbered(df: DataFrame, order: list, name: str = "id", over: list[str] | None = None) -> DataFrame:
    """1-based row numbers in an order, by group or (without ``over``) over all rows.

    A global order is range-partitioned; each partition is numbered from the
    rows before it, so no task holds more than one partition.
    """
    if over:
        return df.withColumn(name, F.row_number().over(Window.partitionBy(*over).orderBy(*order)))
    parted = cut_lineage(df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()))
    # one row for each partition
    sizes = parted.groupBy("_part").agg(F.count("*").alias("_n"))
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"))
    ranked = parted.withColumn("_in_part", F.row_number().over(Window.partitionBy("_part").orderBy(*order)))
    return ranked.join(F.broadcast(offsets), "_part").withColumn(name, F.col("_in_part") + F.col("_off")).drop("_part", "_in_part", "_off")


def dense_numbers(df: DataFrame, key: str, name: str) -> DataFrame:
    """1-based dense number of each distinct key in order."""
    return df.join(numbered(df.select(key).distinct(), [key], name), key)


def adjacent(df: DataFrame, over: list[str], order: list, value: str, step: int = 1) -> DataFrame:
    """Flag: the next row of the group is the next value."""
    nxt = F.lead(value).over(Window.partitionBy(*over).orderBy(*order))
    return df.withColumn("adjacent", F.coalesce(nxt == F.col(value) + step, F.lit(False)))


def offsets(df: DataFrame, order: list, size: str, name: str = "offset") -> DataFrame:
    """Sum of the sizes of the rows before (of a small dimension)."""
    w = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumn(name, F.coalesce(F.sum(size).over(w), F.lit(0)))


def first_over(df: DataFrame, over: list[str], order: list, value: str, share: float) -> DataFrame:
    """(over, k): how many of the leading rows it takes to reach a share of the total."""
    p = Window.partitionBy(*over)
    w = p.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    ranked = df.select(*over, F.row_number().over(p.orderBy(*order)).alias("k"), (F.sum(value).over(w) / F.sum(value).over(p)).alias("c"))
    return ranked.where(F.col("c") >= share).groupBy(*over).agg(F.min("k").alias("k"))


def share_of(df: DataFrame, over: list[str], value: str, name: str = "share") -> DataFrame:
    return df.withColumn(name, F.col(value) / F.sum(value).over(Window.partitionBy(*over)))


def scaled(df: DataFrame, over: list[str], value: str, name: str = "z") -> DataFrame:
    w = Window.partitionBy(*over)
    return df.withColumn(name, (F.col(value) - F.avg(value).over(w)) / F.stddev_samp(value).over(w))


def tiles(df: DataFrame, n: int, order: list, name: str = "tile", over: list[str] | None = None) -> DataFrame:
    """Tiles of near equal size in an order, the first ones larger; by group or (without ``over``) over all rows."""
    if over:
        return df.withColumn(name, F.ntile(n).over(Window.partitionBy(*over).orderBy(*order)))
    ranked = numbered(df, order, "_k")
    total = df.agg(F.count("*").alias("_all"))
    size, more = F.expr(f"_all div {n}"), F.col("_all") % n
    ahead = (size + 1) * more
    tile = F.when(F.col("_k") <= ahead, F.ceil(F.col("_k") / (size + 1))).otherwise(more + F.ceil((F.col("_k") - ahead) / size))
    return ranked.crossJoin(F.broadcast(total)).withColumn(name, tile.cast("int")).drop("_k", "_all")
