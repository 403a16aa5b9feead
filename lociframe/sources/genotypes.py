"""Genotype panels: two-bit genotype files decoded in batches, frequencies, and LD by sums of tile products.

A panel is one file of genotypes per LD block (variant-major, two bits a
sample after three magic bytes) with a table of its variants.  Variants are put
in order of their alleles: where the first is the greater one, the two change
places and the dosage with them.  Frequencies and correlations take each
variant's, and each pair's, own samples without missing genotypes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MAGIC = b"\x6c\x1b\x01"
#: Dosage of the first allele by the two bits of a genotype; the second code stands for missing (-1).
DOSAGE = np.array([2, -1, 1, 0], np.int8)
#: Variants a tile: a task multiplies two tiles' dosages.
TILE = 512


def files(spark: SparkSession, path: str, samples: int) -> DataFrame:
    """(path, samples, content) of genotype files of so many samples."""
    return spark.read.format("binaryFile").load(path).select("path", F.lit(samples).alias("samples"), "content")


def decoded(content: DataFrame, key: str = "path") -> DataFrame:
    """(key, place, dosage) from files (key, samples, content): a row per variant with the dosages of the first allele, a byte each, -1 where missing."""
    kind = dict(content.dtypes)[key]

    def run(batches):
        for batch in batches:
            for name, samples, body in zip(batch.column(0), batch.column(1).to_pylist(), batch.column(2), strict=True):
                width = -(-samples // 4)
                raw = np.frombuffer(body.as_buffer(), np.uint8)
                if raw[:3].tobytes() != MAGIC or (len(raw) - 3) % width:
                    raise ValueError(f"{name.as_py()}: not a variant-major genotype file of {samples} samples")
                rows = raw[3:].reshape(-1, width)
                for lo in range(0, len(rows), 1024):
                    part = rows[lo : lo + 1024]
                    codes = (part[:, :, None] >> np.array([0, 2, 4, 6], np.uint8)) & 3
                    dosage = DOSAGE[codes.reshape(len(part), -1)[:, :samples]]
                    yield pa.RecordBatch.from_arrays([pa.array([name.as_py()] * len(part), name.type), pa.array(np.arange(lo, lo + len(part)), pa.int32()), pa.array([d.tobytes() for d in dosage], pa.binary())], names=["key", "place", "dosage"])

    return content.select(key, "samples", "content").mapInArrow(run, f"key {kind}, place int, dosage binary").withColumnRenamed("key", key)


def in_order(genotypes: DataFrame, variants: DataFrame, key: str = "path") -> DataFrame:
    """(key, chr, bp, ea, oa, snp, turned, dosage) from genotypes and variants (key, place, chr, bp, a1, a2): alleles in order, dosage of ea."""
    turned = F.col("a1") > F.col("a2")
    ea, oa = F.least("a1", "a2"), F.greatest("a1", "a2")
    t = genotypes.join(variants, [key, "place"])
    t = t.select(key, "chr", "bp", ea.alias("ea"), oa.alias("oa"), F.concat(F.col("chr"), F.lit(":"), F.col("bp"), F.lit("_"), ea, F.lit("_"), oa).alias("snp"), turned.alias("turned"), "dosage")
    kind = ", ".join(f"`{c}` {k}" for c, k in t.dtypes)

    def run(batches):
        for batch in batches:
            out = []
            for flip, body in zip(batch.column("turned").to_pylist(), batch.column("dosage"), strict=True):
                d = np.frombuffer(body.as_buffer(), np.int8)
                out.append((np.where(d < 0, d, 2 - d).astype(np.int8) if flip else d).tobytes())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in batch.schema.names[:-1]), pa.array(out, pa.binary())], names=batch.schema.names)

    return t.mapInArrow(run, kind)


def frequencies(genotypes: DataFrame) -> DataFrame:
    """Adds eaf (null without genotypes) and n, the samples with one; the dosages are left out."""
    names = [c for c in genotypes.columns if c != "dosage"]
    kind = ", ".join(f"`{c}` {k}" for c, k in genotypes.dtypes if c != "dosage")

    def run(batches):
        for batch in batches:
            eaf, n = [], []
            for body in batch.column("dosage"):
                d = np.frombuffer(body.as_buffer(), np.int8)
                n.append(int((d >= 0).sum()))
                eaf.append(float(d[d >= 0].sum()) / (2 * n[-1]) if n[-1] else None)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(eaf, pa.float64()), pa.array(n, pa.int64())], names=[*names, "eaf", "n"])

    return genotypes.select(*names, "dosage").mapInArrow(run, f"{kind}, eaf double, n long")


def _correlations(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Correlation of all rows of x with all rows of y over the samples where both are 0 or more; nan where it isn't defined."""
    a, b, p, q = (v.astype(np.float64) for v in ((x >= 0), (y >= 0), np.maximum(x, 0), np.maximum(y, 0)))
    n, sx, sy, sxy = a @ b.T, p @ b.T, a @ q.T, p @ q.T
    with np.errstate(divide="ignore", invalid="ignore"):
        vx, vy = (p * p) @ b.T - sx * sx / n, a @ (q * q).T - sy * sy / n
        r = (sxy - sx * sy / n) / np.sqrt(vx * vy)
    return np.where((vx > 1e-9) & (vy > 1e-9), r, np.nan)


def correlations(genotypes: DataFrame, key: str = "path", order: tuple[str, ...] = ("bp", "snp"), tile: int = TILE) -> DataFrame:
    """(key, lead, proxy, r): the upper triangle of each block's matrix, pairs without a correlation left out.

    Variants of a block are numbered in order and dealt to tiles; each pair of
    tiles of a block is one group, so a block is spread over as many tasks as it
    has pairs of tiles, and a task holds two tiles.
    """
    from pyspark.sql import Window

    kind = dict(genotypes.dtypes)
    # one block's variants only
    place = F.row_number().over(Window.partitionBy(key).orderBy(*order)) - 1
    t = genotypes.select(F.col(key).alias("key"), "snp", "dosage", place.alias("at")).withColumn("tile", F.floor(F.col("at") / tile).cast("int"))
    last = t.groupBy("key").agg(F.max("tile").alias("last"))
    t = t.join(last, "key")
    upper = t.select("key", F.col("tile").alias("i"), F.explode(F.sequence(F.col("tile"), F.col("last"))).alias("j"), "at", "snp", "dosage")
    # the same rows as the other side of a pair, under names of their own
    other = t.select(*[F.col(c).alias(c) for c in t.columns]).select("key", F.explode(F.sequence(F.lit(0), F.col("tile"))).alias("i"), F.col("tile").alias("j"), *[F.col(c).alias(c) for c in ("at", "snp", "dosage")])

    def run(x: pa.Table, y: pa.Table) -> pa.Table:
        x, y = x.sort_by("at"), y.sort_by("at")
        if not x.num_rows or not y.num_rows:
            return pa.table({"key": pa.array([], x.schema.field("key").type), "lead": pa.array([], pa.string()), "proxy": pa.array([], pa.string()), "r": pa.array([], pa.float64())})
        stack = lambda t: np.stack([np.frombuffer(b.as_buffer(), np.int8) for b in t.column("dosage")])
        r = _correlations(stack(x), stack(y))
        keep = ~np.isnan(r) & (x.column("at").to_numpy()[:, None] < y.column("at").to_numpy()[None])
        i, j = np.nonzero(keep)
        block = x.column("key")[0]
        return pa.table({"key": pa.array([block.as_py()] * len(i), block.type), "lead": x.column("snp").take(pa.array(i)), "proxy": y.column("snp").take(pa.array(j)), "r": pa.array(r[i, j])})

    out = upper.groupBy("key", "i", "j").cogroup(other.groupBy("key", "i", "j")).applyInArrow(run, f"key {kind[key]}, lead string, proxy string, r double")
    return out.withColumnRenamed("key", key)
