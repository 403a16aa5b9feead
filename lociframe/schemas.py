"""Declared schemas: nothing is ever inferred from data."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _schema(text: str) -> T.StructType:
    kinds = {"s": T.StringType(), "d": T.DoubleType(), "l": T.LongType(), "i": T.IntegerType(), "b": T.BooleanType(), "t": T.TimestampType()}
    return T.StructType([T.StructField(n, kinds[k]) for n, k in (c.split(":") for c in text.split())])


ASSOCIATION = _schema("SNP:s CHR:i BP:l EA:s OA:s EAF:d BETA:d SE:d P:d Z:d RSID:s GENE:s IMPUTED:b")
LD_BLOCK = _schema("chr:i start:l stop:l ancestry:s")
STUDY = _schema(
    "data_type:s source:s data_format:s study_name:s trait:s trait_name:s ancestry:s sample_size:l category:s study_location:s extracted_location:s "
    "reference_build:s p_value_threshold:d variant_type:s probe:s gene:s ensg:s tissue:s cell_type:s coverage:s heritability:d heritability_se:d"
)
COLOC_PAIR = _schema("unique_study_a:s study_a:s unique_study_b:s study_b:s bp_distance:l ignore:b false_positive:b false_negative:b nsnps:l h0:d h1:d h2:d h3:d h4:d ld_block:s")
CLUSTER_MEMBER = _schema("unique_study_id:s component:l ld_block:s snp:s h4_connectedness:d h3_connectedness:d")
LD_LONG = _schema("lead_variant:s proxy_variant:s ld_block:s r:d")
UPLOAD_MESSAGE = T.StructType([T.StructField("file_location", T.StringType()), T.StructField("metadata", T.StructType([T.StructField("guid", T.StringType()), T.StructField("name", T.StringType()), T.StructField("ancestry", T.StringType()), T.StructField("sample_size", T.LongType()), T.StructField("p_value_threshold", T.DoubleType()), T.StructField("column_names", T.MapType(T.StringType(), T.StringType())), T.StructField("compare_with_upload_guids", T.ArrayType(T.StringType()))]))])


def violations(df: DataFrame, key: list[str] | None = None, ranges: dict[str, tuple[float, float]] | None = None, enums: dict[str, tuple] | None = None) -> DataFrame:
    """(check, n): rows that break a primary key, a CHECK range or an enumeration; all checks in two passes."""
    checks = [F.sum((~F.col(c).between(lo, hi)).cast("long")).alias(f"range:{c}") for c, (lo, hi) in (ranges or {}).items()]
    checks += [F.sum((~F.col(c).isin(list(vs))).cast("long")).alias(f"enum:{c}") for c, vs in (enums or {}).items()]
    out = df.agg(F.count("*").alias("rows"), *checks).selectExpr("stack({}, {}) AS (check, n)".format(len(checks) + 1, ", ".join(f"'{x}', coalesce(`{x}`, 0)" for x in ["rows", *[f"range:{c}" for c in ranges or {}], *[f"enum:{c}" for c in enums or {}]])))
    if key:
        repeated = df.groupBy(*key).count().where("count > 1").agg(F.lit("key").alias("check"), F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).alias("n"))
        out = out.unionByName(repeated)
    return out


def validate(df: DataFrame, **checks) -> DataFrame:
    """``df`` itself if no check is broken, else ValueError."""
    broken = {r["check"]: r["n"] for r in violations(df, **checks).collect() if r["check"] != "rows" and r["n"]}
    if broken:
        raise ValueError(f"invalid rows: {broken}")
    return df
