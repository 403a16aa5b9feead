"""Liftover from chain files: aligned segments, and positions carried over by an interval join.

A chain file lists chains (a header line with the two sequences, their sizes,
strands and spans), each followed by lines of aligned lengths and of the gaps
after them in either sequence.  Each chain is one record of the reader, so a
file is read by Spark in parts, in parallel if it is not compressed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import interval_join


def segments(spark: SparkSession, path: str) -> DataFrame:
    """(chain, score, chr, start, stop, to_chr, to_start, to_size, reverse): ungapped pieces, from 0, ``stop`` excluded.

    ``to_start`` counts on the chain's strand: from the end of the sequence if
    ``reverse``.  The prefix ``chr`` is left out of names.
    """
    # a record ends where the next header begins; comments and blank lines before the first aren't chains
    text = spark.read.option("lineSep", "chain ").text(path)
    lines = F.filter(F.split("value", "\r?\n"), lambda x: ~x.rlike("^\\s*(#.*)?$"))
    # numbered before the lines are dealt to rows, so all rows of a chain share the number
    t = text.select(F.monotonically_increasing_id().alias("_id"), lines.alias("lines")).where((F.size("lines") > 1) & F.get("lines", F.lit(0)).rlike("^[0-9]+ \\S+ [0-9]+ [+-] "))
    h = F.split(F.element_at("lines", 1), "\\s+")
    rows = F.transform(F.slice("lines", 2, 2_000_000_000), lambda x: F.transform(F.split(F.trim(x), "\\s+"), lambda v: v.cast("long")))
    t = t.select(
        h[11].alias("chain"), h[0].cast("long").alias("score"), F.regexp_replace(h[1], "^chr", "").alias("chr"), h[4].cast("long").alias("from"),
        F.regexp_replace(h[6], "^chr", "").alias("to_chr"), h[7].cast("long").alias("to_size"), (h[8] == "-").alias("reverse"), h[9].cast("long").alias("to"), "_id", F.posexplode(rows).alias("_at", "r"),
    )
    size, gap, to_gap = F.col("r")[0], F.coalesce(F.get("r", F.lit(1)), F.lit(0)), F.coalesce(F.get("r", F.lit(2)), F.lit(0))
    # what comes before a piece in its chain: a chain's lines are one array, so its window is within one record's rows
    before = lambda v: F.expr(f"sum({v}) OVER (PARTITION BY _id ORDER BY _at ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)")
    t = t.withColumns({"_size": size, "_step": size + gap, "_to_step": size + to_gap})
    t = t.withColumns({"start": F.col("from") + F.coalesce(before("_step"), F.lit(0)), "to_start": F.col("to") + F.coalesce(before("_to_step"), F.lit(0))})
    return t.select("chain", "score", "chr", "start", (F.col("start") + F.col("_size")).alias("stop"), "to_chr", "to_start", "to_size", "reverse")


def lifted(points: DataFrame, pieces: DataFrame, chrom: str = "chr", bp: str = "bp", keep_moved: bool = False) -> tuple[DataFrame, DataFrame]:
    """(lifted, unmapped) rows of ``points``: with ``to_chr`` and ``to_bp``; and those without a place or on another chromosome.

    A point that several chains cover goes where the one of highest score says
    (of ties the least chain).  Rows that move to another chromosome count as
    unmapped unless ``keep_moved``.
    """
    p = points.select(F.col(chrom).cast("string").alias("_chr"), F.col(bp).cast("long").alias("_bp")).distinct()
    hit = interval_join(p, pieces.withColumnRenamed("chr", "_chr"), key="_chr", pos="_bp", closed=False)
    along = F.col("to_start") + F.col("_bp") - F.col("start")
    place = F.when(F.col("reverse"), F.col("to_size") - 1 - along).otherwise(along)
    best = hit.groupBy("_chr", "_bp").agg(F.min_by(F.struct(F.col("to_chr").alias("to_chr"), place.alias("to_bp")), F.struct(-F.col("score"), "chain", "start")).alias("_to"))
    out = points.join(best, (F.col(chrom).cast("string") == F.col("_chr")) & (F.col(bp).cast("long") == F.col("_bp")), "left")
    there = F.col("_to").isNotNull() if keep_moved else F.coalesce(F.col("_to.to_chr") == F.col("_chr"), F.lit(False))
    return out.where(there).select(*points.columns, "_to.to_chr", "_to.to_bp"), out.where(~there).select(*points.columns)
