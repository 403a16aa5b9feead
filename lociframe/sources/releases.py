"""Stored tables that change: partitions rewritten in place, and sets of tables that change together.

``rewritten`` replaces only the partitions that a change touches; the files of
the others stay as they are.  A *release* is a folder of table versions with
one small file, ``current``, that names the version of each table.  Readers go
through that file, and it is replaced by one rename, so a reader sees all
tables of a release before a change or all of them after it, never a mixture.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..scratch import cut_lineage

#: Most partitions that a change names by value; one that touches more rewrites them all.
MOST_NAMED = 10_000


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def write_partitioned(df: DataFrame, path: str, part: str) -> None:
    df.repartition(part).write.partitionBy(part).parquet(path)


def rewritten(spark: SparkSession, path: str, part: str, touched: DataFrame, change: Callable[[DataFrame], DataFrame], schema: str | None = None) -> list:
    """Replace the rows of the partitions in ``touched`` by ``change(rows)`` of them; returns the values of these partitions.

    New rows may go to those partitions only.  What is to be written is
    checkpointed first, since it is read from the files that it replaces; a
    partition that loses all its rows is removed.  ``schema`` is for tables
    that may hold no rows yet.
    """
    names = [r[0] for r in touched.select(part).distinct().limit(MOST_NAMED + 1).collect()]
    table = (spark.read.schema(schema) if schema else spark.read).parquet(path)
    if len(names) > MOST_NAMED:
        names = [r[0] for r in table.select(part).distinct().collect()]
    if not names:
        return []
    rows = cut_lineage(change(table.where(F.col(part).isin(names))).select(*table.columns))
    left = {r[0] for r in rows.select(part).distinct().collect()}
    if strange := left - set(names):
        raise ValueError(f"rows for partitions that were not named: {sorted(strange)[:5]}")
    rows.repartition(part).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(part).parquet(path)
    for gone in set(names) - left:
        p, fs = _fs(spark, f"{path}/{part}={gone}")
        fs.delete(p, True)
    spark.catalog.refreshByPath(path)
    return sorted(names)


def update_where(spark: SparkSession, path: str, part: str, condition: Column, **values: Column) -> list:
    """UPDATE of a stored table: rows that meet the condition get the values."""
    change = lambda rows: rows.withColumns({c: F.when(condition, v).otherwise(F.col(c)) for c, v in values.items()})
    return rewritten(spark, path, part, spark.read.parquet(path).where(condition), change)


def replace_keys(spark: SparkSession, path: str, part: str, new: DataFrame, key: str, gone: DataFrame | None = None, schema: str | None = None) -> list:
    """Rows of ``new`` take the place of all stored rows of their keys; keys in ``gone`` lose theirs.

    A key's partition must follow from the key, as it does if it is a hash of it.
    """
    new = cut_lineage(new)
    keys = new.select(key, part)
    if gone is not None:
        keys = keys.unionByName(gone.select(key, part))
    keys = cut_lineage(keys.distinct())
    return rewritten(spark, path, part, keys, lambda rows: rows.join(keys.select(key).distinct(), key, "left_anti").unionByName(new, allowMissingColumns=True), schema)


# ---- releases -------------------------------------------------------------------------------------------------


def current(spark: SparkSession, root: str) -> dict[str, str]:
    """{table: folder} of the release that readers see; empty before the first."""
    p, fs = _fs(spark, f"{root}/current")
    return json.loads(spark.read.text(f"{root}/current", wholetext=True).first()[0]) if fs.exists(p) else {}


def read(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root}/{current(spark, root)[name]}")


def publish(spark: SparkSession, root: str, tables: dict[str, DataFrame]) -> dict[str, str]:
    """Write new versions of tables and make them current together; tables not named stay as they are."""
    new = {name: f"{name}-{uuid.uuid4().hex}" for name in tables}
    for name, df in tables.items():
        df.write.parquet(f"{root}/{new[name]}")
    names = current(spark, root) | new
    fresh, fs = _fs(spark, f"{root}/current-{uuid.uuid4().hex}")
    out = fs.create(fresh)
    out.write(bytearray(json.dumps(names).encode()))
    out.close()
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(fresh.toUri() if fresh.toUri().getScheme() else fs.getUri(), spark._jsc.hadoopConfiguration())
    rename = spark._jvm.org.apache.hadoop.fs.Options.Rename
    how = spark.sparkContext._gateway.new_array(rename, 1)
    how[0] = rename.OVERWRITE
    context.rename(fs.makeQualified(fresh), fs.makeQualified(_fs(spark, f"{root}/current")[0]), how)
    return names


def without_studies(spark: SparkSession, root: str, keys: dict[str, list[str]], gone: DataFrame, study: str = "study") -> list[str]:
    """Remove studies from all tables of a release at once; returns the tables that held any of them.

    ``keys``: for each table the columns that name a study; a row goes if any
    of them names one that goes.  Tables without such rows keep their version.
    """
    ids = cut_lineage(gone.select(F.col(study).alias("_gone")).distinct())
    changed = {}
    for name, columns in keys.items():
        table = rows = read(spark, root, name)
        held = None
        for c in columns:
            hit = table.join(ids, F.col(c) == F.col("_gone"), "left_semi").limit(1)
            held = hit if held is None else held.union(hit)
            rows = rows.join(ids, F.col(c) == F.col("_gone"), "left_anti")
        if held is not None and held.count():
            changed[name] = rows
    if changed:
        publish(spark, root, changed)
    return sorted(changed)
