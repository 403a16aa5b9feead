"""Sharding by a hierarchical weighted hash tree (law ``key``), in DataFrame expressions only.

The tree has three levels: regions, racks in a region, shards in a rack.  At
each level a row draws one number per child, ``-ln(u) / weight`` with u from a
hash of (id, node), and descends into the child with the smallest draw, so a
child gets rows in proportion to the weight below it.  A draw depends on the
id, the node's name and its weight alone: growing the tree leaves every draw
of an untouched subtree as it was, and rows move only into the subtree whose
weight has changed.  Weights are given by shard (1 where not given); a rack and
a region weigh what is in them, and raising a shard's weight moves rows only
into its region, inside of that only into its rack, and inside of that only
into the shard.  One more shard joins as a rack and region of its own, so rows
move into that shard only.

Under law ``key`` the id alone decides, so equal texts under different ids lie
in the shards of their ids, and rows of one id lie together.

Cases: a null id draws as the string ``null``; a null or empty text has no
bytes and the checksum of none; rows with equal ids share a shard and get
distinct slots, in order of id, size and checksum inside a hash range; equal
rows are interchangeable; texts of any length are read whole; an empty table
gives an empty result; further columns are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from .common import text_bytes

SHARDS, REGIONS, RACKS = 24, 3, 2
#: A repeated row is laid out in runs of this many slots.
RUN = 4096

Tree = list[tuple[str, float, list]]


def tree(shards: int = SHARDS, base: int = SHARDS, regions: int = REGIONS, racks: int = RACKS, weights: dict[int, float] | None = None) -> Tree:
    """Regions as (name, weight, racks); racks as (name, weight, shards); shards as (number, weight).

    The first ``base`` shards are dealt evenly; each further one is a region of its own.
    ``weights``: by shard number, above 0; 1 where none is given.
    """
    weight = lambda s: float((weights or {}).get(s, 1.0))
    heavy = lambda children: sum(c[1] for c in children)
    if any(weight(s) <= 0 for s in range(shards)):
        raise ValueError("weights must be above 0")
    if shards < base or base % (regions * racks):
        raise ValueError("the base must fill its racks evenly and be no larger than the shard count")
    per, out = base // (regions * racks), []
    for r in range(regions):
        below = []
        for k in range(racks):
            leaves = [(s, weight(s)) for s in range((r * racks + k) * per, (r * racks + k + 1) * per)]
            below.append((f"r{r}/k{k}", heavy(leaves), leaves))
        out.append((f"r{r}", heavy(below), below))
    for s in range(base, shards):
        name = f"r{regions + s - base}"
        out.append((name, weight(s), [(f"{name}/k0", weight(s), [(s, weight(s))])]))
    return out


def draw(key: Column, node: str, weight: float) -> Column:
    """Exponential draw of a node: 52 bits of an MD5 give u, never 0."""
    bits = F.conv(F.substring(F.md5(F.concat(key, F.lit(f"@{node}"))), 1, 13), 16, 10).cast("double")
    return -F.log((bits + 0.5) / float(1 << 52)) / weight


def shard_of(key: Column, top: Tree) -> Column:
    """Shard number for a string key: least draw at the region, rack and shard levels."""

    def descend(children: list) -> Column:
        if len(children) == 1:
            return below(children[0])
        draws = F.array(*[draw(key, str(c[0]), c[1]) for c in children])
        # element index of the least draw; ties (never in practice) go to the first
        least = F.array_position(draws, F.array_min(draws))
        return F.element_at(F.transform(F.array(least), lambda at: _pick(at, children)), 1)

    def _pick(at: Column, children: list) -> Column:
        out = below(children[-1])
        for i in range(len(children) - 2, -1, -1):
            out = F.when(at == i + 1, below(children[i])).otherwise(out)
        return out

    def below(child) -> Column:
        return descend(child[2]) if len(child) == 3 else F.lit(child[0])

    return descend(top).cast("int")


def assign(docs: DataFrame, shards: int = SHARDS, id_column: str = "doc_id", name: str = "shard", weights: dict[int, float] | None = None) -> DataFrame:
    """``docs`` with the shard of each row; a projection, without a shuffle."""
    return docs.withColumn(name, shard_of(F.coalesce(F.col(id_column).cast("string"), F.lit("null")), tree(shards, weights=weights)))


def slots(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot (gapless in a shard), grown_shard.

    Equal rows are counted first (with map-side combine); a shard is cut into
    hash ranges, about as many as a range has rows, range totals give each
    range its first slot, and only the rows of one range are ordered together.
    """
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    crc = F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary"))
    rows = docs.select("doc_id", (text_bytes(F.col("text")) + 8).alias("size"), crc.alias("text_crc32"))
    rows = rows.groupBy("doc_id", "size", "text_crc32").agg(F.count("*").alias("copies"))
    rows = rows.withColumn("shard", shard_of(key, tree(shards)))
    total = docs.count()
    ranges = math.isqrt(total // shards) + 1
    rows = rows.withColumn("part", F.pmod(F.xxhash64("doc_id", "size", "text_crc32"), F.lit(ranges)).cast("int"))
    sums = rows.groupBy("shard", "part").agg(F.sum("copies").alias("n"))
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("shard", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    within = Window.partitionBy("shard", "part").orderBy("doc_id", "size", "text_crc32").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("ahead", F.coalesce(F.sum("copies").over(within), F.lit(0)))
    rows = rows.join(sums, ["shard", "part"]).withColumn("first", F.col("base") + F.col("ahead"))
    runs = F.sequence(F.lit(0).cast("long"), F.floor((F.col("copies") - 1) / RUN))
    rows = rows.withColumn("run", F.explode(runs))
    last = F.least(F.col("copies"), (F.col("run") + 1) * RUN) - 1
    rows = rows.withColumn("copy", F.explode(F.sequence(F.col("run") * RUN, last)))
    return rows.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", (F.col("first") + F.col("copy")).cast("long").alias("slot"), shard_of(key, tree(shards + 1)).alias("grown_shard"))
