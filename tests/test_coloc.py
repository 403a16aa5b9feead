"""Colocalisation of all pairs of a block against SQL and plain joins."""

import re

import duckdb
import numpy as np
from pyspark.sql import functions as F

from lociframe.operators import kernels as K
from lociframe.plans import registry

from .compare import rows
from .growth import most_rows

registry.load()


def _both(spark, path, name: str, studies: list[tuple[int, int, list[float]]]):
    """Rows of a query and of its SQL over these vectors (study, block, values)."""
    spark.createDataFrame([(s, b, [None if v is None else float(np.float32(v)) for v in values]) for s, b, values in studies], "vec_id long, label int, embedding array<float>").write.mode("overwrite").parquet(f"{path}/embeddings.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{path}/embeddings.parquet/*.parquet'")
    return rows(registry.QUERIES[name](spark, str(path)).toPandas()), rows(con.execute(registry.ORACLES[name]).df())


def test_masked_counts_are_of_rounded_posteriors(spark, tmp_path):
    """A posterior of 0.79999974 rounds to 0.8 and counts as high, as SQL counts it."""
    signal = [0.21730065] + [0.0] * 63
    got, want = _both(spark, tmp_path, "k19_masked_colocalisation", [(1, 0, signal), (2, 0, signal)])
    assert got == want and all("0.8" in r and ", 1.0" in r for r in got)


def _studies(seed: int, n: int = 40) -> list[tuple[int, int, list]]:
    """Studies of two blocks: strong signals far beyond what exp can hold, values left out, few SNPs, none at all."""
    rng = np.random.default_rng(seed)
    out = []
    for s in range(n):
        v = rng.normal(0, 0.12, 64)
        if s % 5 == 0:
            v[int(rng.integers(0, 4))] = 30.0
        values = [None if s % 4 == 1 and rng.random() < 0.1 else float(x) for x in v]
        out.append((s, s % 2, values[: 30 if s % 9 == 2 else 64] if s != 7 else [None] * 64))
    return out


def test_all_pairs_give_what_sql_gives(spark, tmp_path):
    got, want = _both(spark, tmp_path, "k18_colocalisation", _studies(1))
    assert got == want and len(want) == 2 * 20 * 19 // 2


def test_a_group_is_dealt_to_few_tiles(spark):
    """Many small tiles would lay out each study once for each: what is shuffled would grow with the square of the studies."""
    n = 300
    lbf = spark.createDataFrame([(0, s, "own", p, float(s + p)) for s in range(n) for p in range(4)], "blk long, study long, own string, snp long, lbf double")
    assert most_rows(K.coloc_within(lbf, ["blk"], owner="own", tile=7)) <= K.MOST_TILES * n
    assert K.coloc_within(lbf, ["blk"], tile=7).count() == n * (n - 1) // 2


def test_masked_pairs_give_what_sql_gives(spark, tmp_path):
    got, want = _both(spark, tmp_path, "k19_masked_colocalisation", _studies(2))
    assert got == want and len(want) == 3
    got, want = _both(spark, tmp_path, "k19_masked_colocalisation", _studies(3, 1))  # no pair at all
    assert got == want and len(want) == 3


def test_masked_pairs_are_summed_where_they_are_made(spark, sf_dir):
    """No row for a pair: the most that a step gives is the studies by SNP."""
    values = 64 * spark.read.parquet(f"{sf_dir}/embeddings.parquet").count()
    assert most_rows(registry.QUERIES["k19_masked_colocalisation"](spark, sf_dir)) <= values


def test_calls_of_a_group_go_to_many_tasks(spark):
    """Tile pairs are dealt by group and tiles: by the group alone, a block with most studies would be one task."""
    lbf = spark.createDataFrame([(0, s, p, float(s + p)) for s in range(60) for p in range(4)], "blk long, study long, snp long, lbf double")
    out = K.coloc_within(lbf, ["blk"], tile=7)
    used = {r["p"] for r in out.select(F.spark_partition_id().alias("p")).distinct().collect()}
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"hashpartitioning\(blk#\d+L?, _i#\d+, _j#\d+", plan) and used
