"""Sinks: text, warehouse tables, chunks, JSON, sitemap and series for plots."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_tsv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Compressed text with a header; a table without rows leaves one file with the header."""
    out = df.write.mode(mode).option("sep", "\t").option("header", True).option("compression", "gzip").option("nullValue", "NA")
    out.csv(path)
    if not df.sparkSession.read.text(path).take(1):
        df.limit(0).coalesce(1).write.mode("append").option("sep", "\t").option("header", True).option("compression", "gzip").csv(path)


def write_table(df: DataFrame, name: str, path: str, bucket: str | None = None, buckets: int = 16, mode: str = "overwrite") -> DataFrame:
    """A warehouse table in a folder; bucketing and sorting by the join key stand for an index.  Returns what is now in it."""
    w = df.write.mode(mode).format("parquet").option("path", path)
    (w.bucketBy(buckets, bucket).sortBy(bucket) if bucket else w).saveAsTable(name)
    return df.sparkSession.table(name)


def reload_table(df: DataFrame, name: str, path: str, **layout) -> DataFrame:
    """Drop a table and write it anew (not from its own rows: those are read as they are written over)."""
    df.sparkSession.sql(f"DROP TABLE IF EXISTS {name}")
    return write_table(df, name, path, **layout)


def published(results: DataFrame, processed: DataFrame, extracted: DataFrame, key: str = "study") -> tuple[DataFrame, DataFrame]:
    """(latest, cleaned): what is published after a run, and the studies to clean up because nothing was extracted from them."""
    empty = processed.join(extracted.select(key).distinct(), key, "left_anti").select(key).distinct()
    return results.join(empty, key, "left_anti"), empty


def update_where(df: DataFrame, condition, **values) -> DataFrame:
    """UPDATE as a projection, to be written over the table."""
    return df.withColumns({c: F.when(condition, v).otherwise(F.col(c)) for c, v in values.items()})


def chunk_ranges(df: DataFrame, ident: str) -> DataFrame:
    """(chunk, start_id, end_id, n) of a chunked table."""
    return df.groupBy("chunk").agg(F.min(ident).alias("start_id"), F.max(ident).alias("end_id"), F.count("*").alias("n"))


def json_rows(df: DataFrame, columns: list[str]) -> DataFrame:
    """One JSON object per row; nulls are written."""
    return df.select(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}).alias("json"))


def sitemap(df: DataFrame, base: str, path: str, ident: str) -> DataFrame:
    """(ident, line): an entry of the sitemap for each row; header and footer are literals of the writer."""
    return df.select(F.col(ident), F.format_string(f"<url><loc>{base}/{path}/%s</loc></url>", F.col(ident).cast("string")).alias("line"))


def split_clean(df: DataFrame, key: list[str], required: list[str]) -> tuple[DataFrame, DataFrame]:
    """(clean, quarantined): quarantined are rows with a missing field and all rows of a repeated key, with the reason."""
    missing = F.lit(False)
    for c in required:
        missing |= F.col(c).isNull()
    n = df.groupBy(*key).agg(F.count("*").alias("_n")).where("_n > 1").select(*key, F.lit(True).alias("_twice"))
    marked = df.join(n, key, "left").withColumn("reason", F.when(missing, "missing").when(F.col("_twice"), "repeated")).drop("_twice")
    return marked.where("reason IS NULL").drop("reason"), marked.where("reason IS NOT NULL")
