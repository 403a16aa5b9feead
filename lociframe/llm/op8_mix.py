"""Mixing sources to target weights by weighted fair queueing, in DataFrame expressions only.

Sources in code point order (null last) weigh 1, 2, 3, repeating; their
targets share the corpus's words by weight, each stopping at ``MOST_EPOCHS``
times its source's words with the excess reshared (water-filling, in closed
form over the sources sorted by the level at which they fill up).  Each source
queues its documents in a shuffled order, once per epoch; a document's virtual
finish time is the source's cumulative words divided by its target.  All
documents are range-sorted by finish time and taken as long as the words up to
and with them (and all that finish at the same time) are within the budget.

Running sums have two levels.  Inside a source, about the square root of the
number of rows of hash ranges are summed first, and only the rows of one range
are ordered together, so a source with a third of all rows isn't gathered in
one task; rows that are equal in id, source and text are counted first and are
one row there.  Over all rows or sources, the rows are range-partitioned and each
partition starts at the sum of those before it.

Cases: null or blank texts have size 0 and take no words; with no words at all
nothing is taken; documents that finish together are taken together or not at
all; rows of one id and text queue one after the other (equal rows are
interchangeable); texts of any length are counted whole; an empty table gives
an empty result; further columns pass through ``mixed`` untouched.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from .common import cut_lineage

WEIGHTS = (1, 2, 3)
MOST_EPOCHS = 3
#: Equal rows that are laid out from one row of their group at a time; groups of more than MANY_COPIES are numbered in parts.
RUN, MANY_COPIES = 10_000, 1_000


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("long")


def _queued(docs: DataFrame) -> DataFrame:
    """Adds the queue columns: source key and null flag, size, shuffled place (60 bits of an MD5 of id and text)."""
    ident = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    key = F.concat(ident, F.lit("@"), F.md5(F.coalesce("text", F.lit(""))))
    place = F.conv(F.substring(F.md5(key), 1, 15), 16, 10).cast("long")
    return docs.withColumns({"_mx_null": F.col("source").isNull(), "_mx_source": F.coalesce("source", F.lit("")), "_mx_size": size_of(F.col("text")), "_mx_place": place, "_mx_id": ident})


def _range(count: int) -> Column:
    """Hash range of a row; ranges are in the order of the places."""
    return F.expr(f"CAST(_mx_place div {-(-(1 << 60) // count)}L AS INT)") if count > 1 else F.lit(0)


def running_totals(rows: DataFrame, order: list[str], **values: Column) -> DataFrame:
    """``rows`` with the totals of ``values`` over all rows up to and with each row (and its ties) in the order."""
    parted = cut_lineage(rows.repartitionByRange(*order).withColumn("_mx_part", F.spark_partition_id()))
    before = Window.orderBy("_mx_part").rowsBetween(Window.unboundedPreceding, -1)
    # one row for each partition
    per = parted.groupBy("_mx_part").agg(*[F.sum(v).alias(f"_mx_before_{k}") for k, v in values.items()])
    per = per.select("_mx_part", *[F.coalesce(F.sum(f"_mx_before_{k}").over(before), F.lit(0)).alias(f"_mx_before_{k}") for k in values])
    inside = Window.partitionBy("_mx_part").orderBy(*order)
    out = parted.withColumns({k: F.sum(v).over(inside) for k, v in values.items()}).join(F.broadcast(per), "_mx_part")
    return out.withColumns({k: F.col(k) + F.col(f"_mx_before_{k}") for k in values}).drop("_mx_part", *[f"_mx_before_{k}" for k in values])


def targets(rows: DataFrame, weights: tuple = WEIGHTS, most_epochs: float = MOST_EPOCHS) -> DataFrame:
    """(_mx_null, _mx_source, source_size, target): one row per source."""
    per = rows.groupBy("_mx_null", "_mx_source").agg(F.sum("_mx_size").alias("source_size"))
    per = running_totals(per, ["_mx_null", "_mx_source"], _mx_rank=F.lit(1))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.col("_mx_rank") - 1) % len(weights) + 1).cast("int"))
    per = per.withColumn("weight", weight).withColumn("cap", F.col("source_size") * float(most_epochs))
    per = per.withColumn("fills", F.col("cap") / F.col("weight"))
    per = running_totals(per, ["fills", "_mx_null", "_mx_source"], caps=F.col("cap"), weights=F.col("weight"))
    whole = per.agg(F.sum("source_size").cast("double").alias("all_size"), F.sum("weight").alias("all_weight"))
    per = per.crossJoin(F.broadcast(whole))
    # the level if all sources before this one are full; the first source that stays below its cap sets the common level
    level = (F.col("all_size") - (F.col("caps") - F.col("cap"))) / (F.col("all_weight") - (F.col("weights") - F.col("weight")))
    per = per.withColumn("level", level)
    common = per.where(F.col("level") * F.col("weight") <= F.col("cap")).agg(F.min(F.struct("fills", "level")).alias("first")).select(F.col("first.level").alias("common"))
    target = F.least(F.col("cap"), F.coalesce("common", F.lit(float("inf"))) * F.col("weight"))
    return per.crossJoin(F.broadcast(common)).select("_mx_null", "_mx_source", "source_size", target.alias("target"))


#: What makes rows equal for the queue.
KEYS = ["_mx_null", "_mx_source", "_mx_place", "_mx_size", "_mx_id"]


class Plan:
    """Groups of equal rows with the words of their source up to and with each group, and the finish time of the last document taken.

    ``groups``: KEYS, doc_id, copies, _mx_end, source_size and target.  Equal rows are
    counted before they are ordered, so they are one row here however many
    there are, and are laid out one after the other afterwards.
    """

    def __init__(self, docs: DataFrame):
        narrow = _queued(docs.select("doc_id", "source", "text")).groupBy(*KEYS).agg(F.first("doc_id").alias("doc_id"), F.count("*").alias("copies"))
        narrow = cut_lineage(narrow)
        narrow = narrow.withColumn("_mx_range", _range(math.isqrt(narrow.count()) + 1))
        words = F.col("_mx_size") * F.col("copies")
        sums = narrow.groupBy("_mx_null", "_mx_source", "_mx_range").agg(F.sum(words).alias("n"))
        before = Window.partitionBy("_mx_null", "_mx_source").orderBy("_mx_range").rowsBetween(Window.unboundedPreceding, -1)
        sums = sums.withColumn("_mx_base", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
        starts = cut_lineage(sums.join(targets(narrow.withColumn("_mx_size", words)), ["_mx_null", "_mx_source"]))
        within = Window.partitionBy("_mx_null", "_mx_source", "_mx_range").orderBy("_mx_place", "doc_id", "_mx_size").rowsBetween(Window.unboundedPreceding, 0)
        timed = narrow.withColumn("_mx_sum", F.sum(words).over(within)).join(starts, ["_mx_null", "_mx_source", "_mx_range"])
        self.groups = cut_lineage(timed.select(*KEYS, "doc_id", "copies", (F.col("_mx_sum") + F.col("_mx_base")).alias("_mx_end"), "source_size", "target"))
        self.last = self._last_finish(starts)

    def rows(self) -> DataFrame:
        """One row for each row of the input: KEYS, doc_id, source_size, target and the words of the source up to and with it (_mx_sum)."""
        runs = self.groups.withColumn("_mx_run", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(copies - 1) div {RUN}L"))))
        first = F.col("_mx_run") * RUN
        k = F.explode(F.sequence(first + 1, F.least(first + RUN, F.col("copies"))))
        return runs.withColumn("_mx_k", k).select(*KEYS, "doc_id", "source_size", "target", self.upto(F.col("_mx_k")).alias("_mx_sum"))

    @staticmethod
    def upto(k: Column) -> Column:
        """Words of the source up to and with the k-th of equal rows."""
        return F.col("_mx_end") - F.col("_mx_size") * (F.col("copies") - k)

    @staticmethod
    def finish(epoch: Column) -> Column:
        """Virtual finish time; null where the source has no target."""
        return F.when(F.col("target") > 0, (epoch * F.col("source_size") + F.col("_mx_sum")) / F.col("target"))

    def _last_finish(self, starts: DataFrame) -> DataFrame:
        """One row (_mx_last): documents that finish by then are taken."""
        rows = self.rows().select("_mx_size", "_mx_sum", "source_size", "target", F.explode(F.array(*map(F.lit, range(MOST_EPOCHS)))).alias("epoch"))
        rows = rows.select("_mx_size", self.finish(F.col("epoch")).alias("f")).where("f IS NOT NULL")
        budget = starts.select("_mx_null", "_mx_source", "source_size").distinct().agg(F.coalesce(F.sum("source_size"), F.lit(0)).alias("budget"))
        upto = running_totals(rows, ["f"], upto=F.col("_mx_size")).crossJoin(F.broadcast(budget))
        return cut_lineage(upto.where("upto <= budget").agg(F.max("f").alias("_mx_last")))

    def taken(self, rows: DataFrame) -> DataFrame:
        """Adds the finish times at which the row is taken, one for each epoch."""
        times = F.array(*[self.finish(F.lit(e)) for e in range(MOST_EPOCHS)])
        return rows.crossJoin(F.broadcast(self.last)).withColumn("_mx_times", F.filter(times, lambda f: f <= F.col("_mx_last")))


def mix(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target and taken of every row."""
    plan = Plan(docs)
    rows = plan.taken(plan.rows())
    return rows.select("doc_id", F.col("_mx_size").alias("size"), "source_size", "target", (F.col("_mx_size") * F.size("_mx_times")).alias("taken"))


def _placed(rows: DataFrame, plan: Plan) -> DataFrame:
    """``rows`` (KEYS and others) with source_size, target and _mx_sum: each takes a place of its own among equal ones.

    Groups of more than MANY_COPIES rows are numbered by partition and within
    it, so none of them meets in one task; the others are numbered as they meet
    their group's row.
    """
    groups = plan.groups.drop("doc_id")
    many = groups.where(F.col("copies") > MANY_COPIES)
    # the window needs no exchange of its own
    placed = rows.join(groups.where(F.col("copies") <= MANY_COPIES), KEYS).withColumn("_mx_k", F.row_number().over(Window.partitionBy(*KEYS).orderBy(F.lit(1))))
    if many.limit(1).count():
        # dealt by chance and read from a checkpoint, then numbered in each part
        part = F.floor(F.rand(7) * F.least(F.ceil(F.col("copies") / MANY_COPIES), F.lit(10_000))).cast("int")
        hot = cut_lineage(rows.join(many, KEYS).withColumn("_mx_part", part))
        before = Window.partitionBy(*KEYS).orderBy("_mx_part").rowsBetween(Window.unboundedPreceding, -1)
        # at most 10 000 rows for each group
        per = hot.groupBy(*KEYS, "_mx_part").agg(F.count("*").alias("n")).withColumn("_mx_before", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
        inside = F.row_number().over(Window.partitionBy(*KEYS, "_mx_part").orderBy(F.lit(1)))
        hot = hot.withColumn("_mx_in", inside).join(per, [*KEYS, "_mx_part"]).withColumn("_mx_k", F.col("_mx_before") + F.col("_mx_in"))
        placed = placed.unionByName(hot.select(*placed.columns))
    return placed.withColumn("_mx_sum", plan.upto(F.col("_mx_k")))


def mixed(docs: DataFrame) -> DataFrame:
    """The mixture itself, in order of finish times: each row of ``docs`` as often as it is taken."""
    plan = Plan(docs)
    wrapped = docs.select("doc_id", "source", "text", F.struct(*docs.columns).alias("_mx_row"))
    rows = _placed(_queued(wrapped).select(*KEYS, "_mx_row"), plan)
    rows = plan.taken(rows).select("_mx_row", F.explode("_mx_times").alias("_mx_time"))
    return rows.repartitionByRange("_mx_time").sortWithinPartitions("_mx_time").select("_mx_row.*")
