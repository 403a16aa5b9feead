"""Projections and reshaping that don't depend on the data's values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import CHUNK_ROWS


def rename_by(df: DataFrame, mapping: dict[str, str | None], only: bool = False) -> DataFrame:
    """User mapping target -> source: empty sources are skipped, a clashing target is dropped, ``only`` keeps what is mapped."""
    used = {t: s for t, s in mapping.items() if s and s in df.columns}
    for target, source in used.items():
        if target != source:
            df = df.drop(target).withColumnRenamed(source, target)
    return df.select(*used) if only else df


def tolerant_select(df: DataFrame, wanted: list[str], rest: bool = False) -> DataFrame:
    have = [c for c in wanted if c in df.columns]
    return df.select(*have, *[c for c in df.columns if rest and c not in have])


def add_missing(df: DataFrame, defaults: dict[str, object]) -> DataFrame:
    return df.withColumns({c: F.lit(v) for c, v in defaults.items() if c not in df.columns})


def clean_names(df: DataFrame, suffix: str = "") -> DataFrame:
    import re

    return df.toDF(*[re.sub(r"[^a-z0-9]+", "_", c.lower()).strip("_") + suffix for c in df.columns])


def across(df: DataFrame, columns: list[str], function) -> DataFrame:
    return df.select(*[function(F.col(c)).alias(c) if c in columns else F.col(c) for c in df.columns])


def swap_sides(df: DataFrame, swap: Column, stems: list[str]) -> DataFrame:
    """Exchange every ``x_a`` and ``x_b`` where ``swap`` holds."""
    out = {f"{s}_a": F.when(swap, F.col(f"{s}_b")).otherwise(F.col(f"{s}_a")) for s in stems}
    return df.withColumns(out | {f"{s}_b": F.when(swap, F.col(f"{s}_a")).otherwise(F.col(f"{s}_b")) for s in stems})


def wider(df: DataFrame, keys: list[str], names: str, values: list, value: Column) -> DataFrame:
    return df.groupBy(*keys).pivot(names, values).agg(value).fillna(0)


def longer(df: DataFrame, ids: list[str], columns: list[str], name: str = "name", value: str = "value") -> DataFrame:
    return df.unpivot(ids, columns, name, value)


def split_columns(df: DataFrame, column: str, mark: str, names: list[str]) -> DataFrame:
    parts = F.split(F.col(column), mark)
    return df.select("*", *[F.get(parts, F.lit(i)).alias(n) for i, n in enumerate(names)])


def parallel_rows(df: DataFrame, columns: list[str], mark: str = ", ") -> DataFrame:
    """One row per position of several delimited lists at once."""
    lists = [F.split(F.col(c), mark).alias(c) for c in columns]
    rest = [c for c in df.columns if c not in columns]
    zipped = df.select(*rest, *lists).select(*rest, F.explode(F.arrays_zip(*columns)).alias("_z"))
    return zipped.select(*rest, *[F.col(f"_z.{c}").alias(c) for c in columns])


def patterns(df: DataFrame, key: str, item: str) -> DataFrame:
    """(pattern, n): how many keys have each exact set of items."""
    sets = df.groupBy(key).agg(F.array_join(F.array_sort(F.collect_set(item)), "&").alias("pattern"))
    return sets.groupBy("pattern").agg(F.count("*").alias("n"))


def multi_hot(df: DataFrame, key: str, column: str, mark: str, values: list[str]) -> DataFrame:
    items = F.split(F.col(column), mark)
    return df.select(key, *[F.array_contains(items, v).alias(v) for v in values])


def chunks(df: DataFrame, ident: str, rows: int = CHUNK_ROWS) -> DataFrame:
    """``df`` with a chunk number: rows in order of a dense 1-based id, ``rows`` to a chunk."""
    return df.withColumn("chunk", F.floor((F.col(ident) - 1) / rows).cast("long"))
