"""Helpers that several operators share: words, hashes, checkpoints, graphs."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import scratch
from ..scratch import cut_lineage  # noqa: F401

#: Words are runs of anything but ASCII white space; bytes.split() cuts at just these.
SPACE_CLASS = "[\\x20\\x09-\\x0D]+"
MASK = np.uint64(0xFFFFFFFFFFFFFFFF)


def prepare(spark: SparkSession) -> None:
    """Bound Arrow batches by bytes as well as rows: one text may be very long."""
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000":
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(4 << 20))


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once per row and hand it to ``body`` as a lambda variable."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words(text: Column) -> Column:
    """Array of words of a text; null and blank texts give an empty array."""
    parts = F.split(F.coalesce(text, F.lit("")), SPACE_CLASS)
    return F.filter(parts, lambda w: w != "")


def text_bytes(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def give_back() -> None:
    """Return freed memory of a Python worker to the system: workers live on between stages."""
    import ctypes
    import gc

    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


class WordHashes(dict):
    """word -> 64-bit hash, kept for reuse and emptied when it gets too large."""

    def __init__(self, most: int = 60_000):
        super().__init__()
        self.most = most

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= self.most:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value

    def of(self, parts: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, parts), np.uint64, len(parts))


def lower_words(text: str | None) -> list[bytes]:
    """Words with A-Z lower-cased (bytes.lower() touches ASCII only)."""
    return text.encode().lower().split() if text else []


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser on 64-bit integers."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def window_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` words; the whole sequence if it is shorter; none for no words."""
    n = len(hashes)
    if n == 0:
        return hashes
    k = min(n, size)
    acc = np.full(n - k + 1, k, np.uint64)
    with np.errstate(over="ignore"):
        for j in range(k):
            acc = acc * np.uint64(0x9E3779B97F4A7C15) + hashes[j : n - k + 1 + j]
    return mix(acc)


#: Tables that are added together in one group on each level of summed_tables.
FAN_IN = 128


def _pack(counts: np.ndarray) -> bytes:
    return zlib.compress((counts.astype(np.int32) if np.abs(counts).max() < 2**31 else counts.astype(np.int64)).tobytes(), 1)


def _unpack(packed: bytes, width: int) -> np.ndarray:
    raw = zlib.decompress(packed)
    return np.frombuffer(raw, np.int32 if len(raw) == 4 * width else np.int64)


def summed_tables(src: DataFrame, fill, lengths: list[int], block: int = 1 << 16, kind: type = np.int64) -> list[np.ndarray]:
    """Sums over all partitions of the count tables that ``fill(batches)`` returns, of the fixed ``lengths``.

    Each partition sends one compressed row per block that isn't zero; these
    are added on three levels, FAN_IN of them in a group on the first two.
    What reaches the driver is one row per block; the result is of the number type ``kind``.
    """
    schema = "part int, table int, block int, counts binary"
    names = ["part", "table", "block", "counts"]
    width = lambda t, b: min(block, lengths[t] - block * b)

    def parts(batches):
        tables = fill(batches)
        for t, counts in enumerate(tables):
            for b, at in enumerate(range(0, len(counts), block)):
                piece = counts[at : at + block]
                if piece.any():
                    row = [pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([t], pa.int32()), pa.array([b], pa.int32()), pa.array([_pack(piece)], pa.binary())]
                    yield pa.RecordBatch.from_arrays(row, names=names)
        del tables
        give_back()

    def merge(table):
        t, b = table.column("table")[0].as_py(), table.column("block")[0].as_py()
        total = np.zeros(width(t, b), np.int64)
        for packed in table.column("counts"):
            total += _unpack(packed.as_py(), len(total))
        return table.slice(0, 1).drop_columns(["counts"]).append_column("counts", pa.array([_pack(total)], pa.binary()))

    got = src.mapInArrow(parts, schema)
    for share in (FAN_IN, FAN_IN * FAN_IN):
        got = got.groupBy(F.floor(F.col("part") / share), "table", "block").applyInArrow(merge, schema)
    out = [np.zeros(n, kind) for n in lengths]
    for r in got.groupBy("table", "block").applyInArrow(merge, schema).toLocalIterator():
        at, n = r["block"] * block, width(r["table"], r["block"])
        out[r["table"]][at : at + n] = _unpack(bytes(r["counts"]), n)
    return out


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for the nodes of ``edges`` (a, b long); component is the least node reachable.

    Alternates the large-star and small-star steps: every step is one
    min-aggregation with map-side combine and one equi-join, whose skewed keys
    AQE may split, so a hub with most of the nodes isn't gathered in one task.
    It ends when a round changes nothing.  A round's pairs are written and read
    again, so that few pairs make few tasks: the driver keeps something of each.
    Self-loops keep isolated nodes; an empty input gives an empty result.
    """
    spark = edges.sparkSession
    both_ways = lambda pairs: pairs.select(F.inline(F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))))
    pairs, _ = scratch.stored(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "pairs")
    nodes = both_ways(pairs).select(F.col("u").alias("node")).distinct()
    pairs = pairs.where("u <> v")
    seen = before = None
    while True:
        both = both_ways(pairs)
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        # (u, m) and, unless it is the same, (v, m)
        small = large.join(least, "u").select(F.inline(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))))
        pairs, path = scratch.stored(small.where("u <> v").distinct(), "pairs")
        if before:
            scratch.remove(spark, before)
        before = path
        state = pairs.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
    root = pairs.groupBy("u").agg(F.min("v").alias("component"))
    return nodes.join(root, nodes["node"] == root["u"], "left").select("node", F.coalesce("component", "node").alias("component"))
