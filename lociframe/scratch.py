"""Where intermediate tables and checkpoints go."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own: dict[str, str] = {}
#: Paths given out, by application.
_given: dict[str, list[str]] = {}


def base(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir; where that is unset, a temporary one for this application, on a local master only."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    sc = spark.sparkContext
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    if sc.applicationId not in _own:
        _own[sc.applicationId] = tempfile.mkdtemp(prefix="lociframe-")
    return _own[sc.applicationId]


def fresh(spark: SparkSession, name: str) -> str:
    """A path under the base folder that nothing else uses."""
    path = f"{base(spark)}/{name}-{uuid.uuid4().hex}"
    _given.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def exists(spark: SparkSession, path: str) -> bool:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a path that ``fresh`` gave, in whatever file system it lies."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint under the base folder."""
    sc = df.sparkSession.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        sc.setCheckpointDir(base(df.sparkSession))
    return df.checkpoint(eager=True)


def stored(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """The table as written below the base folder, and its path: reading it takes as many tasks as its bytes ask for, unlike a checkpoint."""
    path = fresh(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def clear(spark: SparkSession) -> None:
    """Remove all intermediate tables and checkpoints of this application; results that are read from them are gone then."""
    for path in _given.pop(spark.sparkContext.applicationId, []):
        remove(spark, path)
    folder = spark.sparkContext._jsc.sc().getCheckpointDir()
    if folder.isDefined():  # a folder of this application's own below the one that was set
        remove(spark, folder.get())
        spark.sparkContext.setCheckpointDir(base(spark))
