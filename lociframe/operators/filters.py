"""Filters and validation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from ..constants import EAF_COMMON, EAF_RARE


def autosome(chrom: Column) -> Column:
    """Chromosome number 1 to 22 after an optional ``chr``; null for anything else."""
    n = F.regexp_replace(chrom.cast("string"), "^chr", "").try_cast("int")
    return F.when(n.between(1, 22), n)


def common_band(eaf: Column) -> Column:
    return (eaf > EAF_COMMON[0]) & (eaf < EAF_COMMON[1])


def rare_band(eaf: Column) -> Column:
    return eaf.between(*EAF_RARE) | (1 - eaf).between(*EAF_RARE)


def groups_where(df: DataFrame, keys: list[str], condition: Column) -> DataFrame:
    """Rows of the groups for which an aggregate condition holds."""
    good = df.groupBy(*keys).agg(condition.alias("_ok")).where("_ok").select(*keys)
    return df.join(good, keys, "left_semi")


def members_of(df: DataFrame, key: str, other: DataFrame) -> DataFrame:
    return df.join(other.select(key).distinct(), key, "left_semi")


def hashed_sample(df: DataFrame, n: int, *columns: str) -> DataFrame:
    """The n rows with the least hash: a sample that is the same on every run."""
    return df.orderBy(F.md5(F.concat_ws("|", *[F.col(c).cast("string") for c in columns])), *columns).limit(n)


def broken(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """(check, n): rows that break each check, in one pass."""
    wide = df.agg(*[F.coalesce(F.sum((~F.coalesce(c, F.lit(False))).cast("long")), F.lit(0)).alias(f"c{i}") for i, c in enumerate(checks.values())])
    return wide.select(F.expr("stack({}, {}) AS (check, n)".format(len(checks), ", ".join(f"'{n}', c{i}" for i, n in enumerate(checks)))))


def upload_verdict(df: DataFrame) -> DataFrame:
    """One row (valid, error): mandatory columns, one kind of effect, nulls, ranges and half-filled EAF, messages joined."""
    have, errors = set(df.columns), []
    missing = [c for c in ("CHR", "BP", "EA", "OA", "P") if c not in have]
    errors += [F.lit(f"missing columns {', '.join(missing)}")] if missing else []
    effect, odds = {"BETA", "SE"} <= have, {"OR", "LB", "UB"} <= have
    errors += [F.lit("need either BETA and SE or OR, LB and UB")] if effect == odds else []
    rules = {c: F.col(c).isNull() for c in ("CHR", "BP", "EA", "OA", "P", "BETA", "SE") if c in have}
    sums = {f"{c} has nulls": F.max(cond) for c, cond in rules.items()}
    if "P" in have:
        sums["P is out of range"] = F.max(~F.col("P").between(0, 1))
    if "SE" in have:
        sums["SE is negative"] = F.max(F.col("SE") < 0)
    if "EAF" in have:
        sums["EAF is partly missing"] = F.max(F.col("EAF").isNull()) & F.max(F.col("EAF").isNotNull())
    errors += [F.when(c, F.lit(m)) for m, c in sums.items()]
    out = df.agg(F.array_join(F.filter(F.array(*errors), lambda e: e.isNotNull()), "; ").alias("error"))
    return out.select((F.col("error") == "").alias("valid"), "error")


def panel_eaf(df: DataFrame, panel: DataFrame, study: str, snp: str) -> DataFrame:
    """EAF from a panel for studies that have none at all."""
    none = F.count("eaf").over(Window.partitionBy(study)) == 0
    out = df.withColumn("_none", none).join(panel.select(snp, F.col("eaf").alias("_panel")), snp, "left")
    return out.withColumn("eaf", F.when(F.col("_none"), F.col("_panel")).otherwise(F.col("eaf"))).drop("_none", "_panel")
