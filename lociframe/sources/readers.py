"""Sources: every reader takes an explicit schema."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def delimited(spark: SparkSession, path: str | list[str], schema: T.StructType, sep: str = "\t", header: bool = True, columns: list[str] | None = None) -> DataFrame:
    """Text tables (.gz is read as is); ``columns`` reach the parser, which skips the others."""
    df = spark.read.schema(schema).option("sep", sep).option("header", header).option("nullValue", "NA").csv(path)
    return df.select(*columns) if columns else df


def zipped(spark: SparkSession, path: str, schema: T.StructType, sep: str = "\t") -> DataFrame:
    """Text tables inside zip archives: one archive is one task; lines are split and cast in the JVM."""

    def lines(batches):
        import io
        import zipfile

        import pyarrow as pa

        for batch in batches:
            for content in batch.column(0):
                with zipfile.ZipFile(io.BytesIO(content.as_py())) as z:
                    for name in z.namelist():
                        with z.open(name) as f:
                            next(f, None)
                            rows = [x.decode().rstrip("\r\n") for x in f]
                            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.string())], names=["line"])

    raw = spark.read.format("binaryFile").load(path).select("content").mapInArrow(lines, "line string")
    parts = F.split("line", sep)
    return raw.select(*[F.nullif(F.get(parts, F.lit(i)), F.lit("NA")).cast(f.dataType).alias(f.name) for i, f in enumerate(schema)])


def union_of(spark: SparkSession, paths: list[str], schema: T.StructType, sep: str = "\t") -> DataFrame:
    """One scan over the files that exist; missing ones are skipped, missing columns are null."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    conf = spark._jsc.hadoopConfiguration()
    there = [p for p in paths if hadoop(p).getFileSystem(conf).exists(hadoop(p))]
    return delimited(spark, there, schema, sep) if there else spark.createDataFrame([], schema)


def discover(spark: SparkSession, folder: str, pattern: str) -> DataFrame:
    """(path, name, modified): files by glob, name without extension; the contents aren't read."""
    df = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(folder)
    name = F.regexp_replace(F.regexp_extract("path", "([^/]+)$", 1), "\\.[^.]*(\\.gz)?$", "")
    return df.select("path", name.alias("name"), F.col("modificationTime").alias("modified")).distinct()


def sidecars(spark: SparkSession, path: str, schema: T.StructType, required: list[str], defaults: dict[str, object]) -> DataFrame:
    """JSON metadata files: rows without a required field are dropped, others filled with defaults."""
    df = spark.read.schema(schema).option("multiLine", True).json(path)
    return df.dropna(subset=required).fillna(defaults)


def numbered_columns(spark: SparkSession, path: str, kinds: str, sep: str = "\t") -> DataFrame:
    """A table without header as X1..Xn; ``kinds`` is one Spark type name per column."""
    return delimited(spark, path, T.StructType.fromDDL(", ".join(f"X{i} {k}" for i, k in enumerate(kinds.split(), 1))), sep, header=False)


def heritability(lines: DataFrame, text: str = "value", over: list[str] | None = None) -> DataFrame:
    """(h2, se) scraped from regression logs."""
    pattern = "Total Observed scale h2: (-?[0-9.eE-]+) \\(([0-9.eE-]+)\\)"
    hit = lines.where(F.col(text).rlike(pattern))
    return hit.select(*(over or []), F.regexp_extract(text, pattern, 1).cast("double").alias("heritability"), F.regexp_extract(text, pattern, 2).cast("double").alias("heritability_se"))


def vcf(spark: SparkSession, path: str) -> DataFrame:
    """Body of association VCF files: fixed fields, and the sample's fields by the FORMAT keys as a map."""
    lines = spark.read.text(path).where(~F.col("value").startswith("#"))
    return vcf_rows(lines)


def vcf_rows(lines: DataFrame) -> DataFrame:
    p = F.split("value", "\t")
    sample = F.map_from_arrays(F.split(p[8], ":"), F.split(p[9], ":"))
    number = lambda k: F.try_element_at(F.col("_s"), F.lit(k)).try_cast("double")
    df = lines.select(F.regexp_replace(p[0], "^chr", "").alias("chr"), p[1].cast("long").alias("bp"), p[2].alias("id"), p[3].alias("oa"), p[4].alias("ea"), sample.alias("_s"))
    return df.select("chr", "bp", "id", "oa", "ea", number("ES").alias("beta"), number("SE").alias("se"), number("LP").alias("lp"), number("AF").alias("eaf"))


def vcf_below(df: DataFrame, p: float) -> DataFrame:
    """Rows with a p-value of at most ``p``: the cut is on LP, so it is pushed below the power."""
    return df.where(F.col("lp") >= -math.log10(p)).withColumn("p", F.pow(F.lit(10.0), -F.col("lp")))


def besd_query(df: DataFrame, probe: str | None = None, center: int | None = None, window_kb: int = 2000, p: float = 1.0) -> DataFrame:
    """Rows of a probe and/or of a window around a position, at most a p-value."""
    keep: Column = F.col("p") <= p
    if probe is not None:
        keep &= F.col("probe") == probe
    if center is not None:
        keep &= F.abs(F.col("bp") - center) <= window_kb * 1000
    return df.where(keep)


def long_entries(df: DataFrame, keys: dict[str, str], entry: Column) -> DataFrame:
    """Entries of a matrix table kept in long form: columns by exact key, then entries by condition."""
    keep = F.lit(True)
    for k, v in keys.items():
        keep &= F.col(k) == v
    return df.where(keep & entry)


def attach(spark: SparkSession, name: str, tables: dict[str, DataFrame]) -> None:
    """Make tables of another database joinable by ``name_table`` views."""
    for t, df in tables.items():
        df.createOrReplaceTempView(f"{name}_{t}")
