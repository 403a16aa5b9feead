"""Tables laid out by position, so that queries of regions and probes read only the files that may hold an answer.

Rows lie in folders by chromosome and bin of WIDTH bases, sorted by position
in each file; a bin with more than MOST_ROWS rows has several files.  A probe
table beside the rows says which bins each probe's rows lie in.
"""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.joins import interval_join

WIDTH, MOST_ROWS = 1_000_000, 5_000_000
#: Regions that are turned into a list of bins before the scan; more are joined.
MOST_REGIONS = 2_000


def write(df: DataFrame, path: str, width: int = WIDTH, probe: str | None = None) -> None:
    """Store rows (chr, bp, ...) by position; ``probe`` names a column to be found by as well."""
    t = df.withColumn("bin", F.floor(F.col("bp") / width).cast("long"))
    # by range, so a bin with most of the rows is several files
    t.repartitionByRange("chr", "bin", "bp").sortWithinPartitions("chr", "bin", "bp").write.option("maxRecordsPerFile", MOST_ROWS).partitionBy("chr", "bin").parquet(f"{path}/rows")
    df.sparkSession.createDataFrame([(width, t.schema.json())], "width long, schema string").write.parquet(f"{path}/layout")
    if probe:
        t.groupBy(F.col(probe).alias("probe"), "chr").agg(F.min("bin").alias("first_bin"), F.max("bin").alias("last_bin")).repartitionByRange("probe").sortWithinPartitions("probe").write.parquet(f"{path}/probes")


def _opened(spark: SparkSession, path: str) -> tuple[int, DataFrame]:
    """(width of a bin, rows): the schema is stored too, so no file is opened to find it."""
    layout = spark.read.parquet(f"{path}/layout").first()
    return layout["width"], spark.read.schema(T.StructType.fromJson(json.loads(layout["schema"]))).parquet(f"{path}/rows")


def _bins(parts: list[tuple]) -> Column:
    """Partition filter from (chr, first bin, last bin)."""
    return reduce(lambda a, b: a | b, [(F.col("chr") == c) & F.col("bin").between(lo, hi) for c, lo, hi in parts], F.lit(False))


def within(spark: SparkSession, path: str, regions: DataFrame, closed: bool = True) -> DataFrame:
    """Rows in regions (chr, start, stop, ...), each with the region's other columns.

    Only the files of the regions' bins are read; for more than MOST_REGIONS
    regions all of them are, and the join sorts it out.
    """
    width, rows = _opened(spark, path)
    named = regions.select("chr", F.floor(F.col("start") / width), F.floor(F.col("stop") / width)).distinct().limit(MOST_REGIONS + 1).collect()
    if len(named) <= MOST_REGIONS:
        rows = rows.where(_bins([tuple(r) for r in named]))
    return interval_join(rows.drop("bin"), regions, closed=closed)


def around(spark: SparkSession, path: str, chrom, center: int, window_kb: int) -> DataFrame:
    """Rows within ``window_kb`` thousand bases of a position."""
    (width, rows), reach = _opened(spark, path), window_kb * 1000
    rows = rows.where(_bins([(chrom, (center - reach) // width, (center + reach) // width)]))
    return rows.where(F.abs(F.col("bp") - center) <= reach).drop("bin")


def of_probe(spark: SparkSession, path: str, probe: str, column: str = "probe", center: int | None = None, window_kb: int | None = None, p: float = 1.0) -> DataFrame:
    """Rows of a probe, and of a window around a position if one is given, with a p-value of at most ``p``."""
    width, rows = _opened(spark, path)
    parts = [(r["chr"], r["first_bin"], r["last_bin"]) for r in spark.read.parquet(f"{path}/probes").where(F.col("probe") == probe).collect()]
    keep = (F.col(column) == probe) & (F.col("p") <= p)
    if center is not None and window_kb is not None:
        reach = window_kb * 1000
        parts = [(c, max(lo, (center - reach) // width), min(hi, (center + reach) // width)) for c, lo, hi in parts]
        keep &= F.abs(F.col("bp") - center) <= reach
    return rows.where(_bins(parts) & keep).drop("bin")
