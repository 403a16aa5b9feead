"""Aggregations: extremes, bins, ratios, sweeps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from ..scratch import cut_lineage


def best_row(df: DataFrame, keys: list[str], order: list[Column | str], keep: list[str], largest: bool = False) -> DataFrame:
    """One row per key: the least (or largest) by ``order``; ties are decided by what ``order`` lists."""
    pick = F.max_by if largest else F.min_by
    return df.groupBy(*keys).agg(pick(F.struct(*keep), F.struct(*order)).alias("_b")).select(*keys, "_b.*")


def keep_first(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """Whole rows, one per key, by an explicit order."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")


def with_total(df: DataFrame, key: str, aggs: dict[str, Column], total: str = "Total") -> DataFrame:
    """Grouped aggregates and a grand total row, from one pass."""
    out = df.rollup(key).agg(F.grouping(key).alias("_g"), *[c.alias(n) for n, c in aggs.items()])
    return out.withColumn(key, F.when(F.col("_g") == 1, F.lit(total)).otherwise(F.col(key).cast("string"))).drop("_g")


def contingency(df: DataFrame, row: str, column: str, values: list[str]) -> DataFrame:
    return df.groupBy(row).pivot(column, values).count().fillna(0)


def type_matrix(pairs: DataFrame, a: str, b: str) -> DataFrame:
    """(type_lo, type_hi, n): counts of unordered type pairs."""
    return pairs.groupBy(F.least(a, b).alias("type_lo"), F.greatest(a, b).alias("type_hi")).agg(F.count("*").alias("n"))


def positional_bins(df: DataFrame, keys: list[str], pos: str, value: str, width: int) -> DataFrame:
    """Mean position and largest value of each bin of positions."""
    return df.groupBy(*keys, F.floor(F.col(pos) / width).alias("bin")).agg(F.avg(pos).alias("mean_pos"), F.max(value).alias("top"), F.count("*").alias("n"))


def cut(value: Column, breaks: list[float], labels: list[str]) -> Column:
    """Label of the interval (lower, upper] that holds the value; null outside."""
    out = F.lit(None).cast("string")
    for lo, hi, label in reversed(list(zip(breaks, breaks[1:], labels, strict=False))):
        out = F.when((value > lo) & (value <= hi), F.lit(label)).otherwise(out)
    return out


def repeated(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def sweep(df: DataFrame, value: str, cuts: list[float], over: list[str] | None = None) -> DataFrame:
    """(cut, n): rows above each cut-off, in one pass over the data."""
    sums = [F.sum((F.col(value) > c).cast("long")).alias(f"c{i}") for i, c in enumerate(cuts)]
    wide = df.groupBy(*over).agg(*sums) if over else df.agg(*sums)
    stack = F.expr("stack({}, {}) AS (cut, n)".format(len(cuts), ", ".join(f"CAST({c} AS DOUBLE), coalesce(c{i}, 0)" for i, c in enumerate(cuts))))
    return wide.select(*(over or []), stack)


def gene_pleiotropy(members: DataFrame, categories: DataFrame) -> DataFrame:
    """(gene, n_categories, n_other_genes): what a gene meets in its groups.

    Groups with the same genes are one set before pairs are made of it, and
    pairs are reduced to distinct (gene, other) before counting.
    """
    g = members.select("grp", "gene").distinct()
    cats = members.join(categories, "study").select("grp", "category").distinct()
    by_cat = g.join(cats, "grp").groupBy("gene").agg(F.countDistinct("category").alias("n_categories"))
    sets = g.groupBy("grp").agg(F.sort_array(F.collect_set("gene")).alias("genes")).where(F.size("genes") > 1).select("genes").distinct()
    pairs = sets.select("genes", F.explode("genes").alias("gene")).select("gene", F.explode("genes").alias("other")).where("gene <> other").distinct()
    other = pairs.groupBy("gene").agg(F.count("*").alias("n_other_genes"))
    return g.select("gene").distinct().join(by_cat, "gene", "left").join(other, "gene", "left").fillna(0)


def quantiles(df: DataFrame, key: str, value: str, shares: dict[str, float]) -> DataFrame:
    """(key, and the exact quantile of each share under its name), between values in a straight line; null where a key has no values.

    Values are counted, dealt to partitions in their order and numbered on from
    the counts of the partitions before, so no task holds all values of a key.
    """
    counts = df.groupBy(key, value).agg(F.count(value).alias("_n"))
    parted = cut_lineage(counts.where(F.col(value).isNotNull()).repartitionByRange(key, value).withColumn("_part", F.spark_partition_id()))
    # one row for each key and partition
    sizes = parted.groupBy(key, "_part").agg(F.sum("_n").alias("_size"))
    ahead = Window.partitionBy(key).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(F.col(key).alias("_key"), "_part", F.coalesce(F.sum("_size").over(ahead), F.lit(0)).alias("_off"), F.sum("_size").over(Window.partitionBy(key)).alias("_all"))
    inside = Window.partitionBy("_part", key).orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    ends = parted.withColumn("_in", F.sum("_n").over(inside)).withColumnRenamed("_part", "_at").join(F.broadcast(offsets), F.col(key).eqNullSafe(F.col("_key")) & (F.col("_at") == F.col("_part")))
    last = F.col("_off") + F.col("_in")  # places from 0: this value's are those from last - _n up to it
    holds = lambda place: F.max(F.when((place >= last - F.col("_n")) & (place < last), F.col(value)))
    picked = []
    for name, share in shares.items():
        place = (F.col("_all") - 1) * F.lit(share)
        picked += [holds(F.floor(place)).alias(f"_{name}_lo"), holds(F.ceil(place)).alias(f"_{name}_hi"), F.max(place - F.floor(place)).alias(f"_{name}_by")]
    out = ends.groupBy(key).agg(*picked)
    between = lambda n: F.col(f"_{n}_lo") + (F.col(f"_{n}_hi") - F.col(f"_{n}_lo")) * F.col(f"_{n}_by")
    got = out.select(F.col(key).alias("_key"), *[between(n).alias(n) for n in shares])
    every = counts.select(key).distinct()
    return every.join(F.broadcast(got), every[key].eqNullSafe(F.col("_key")), "left").select(key, *shares)


def risk_ratio(df: DataFrame, supported: str, success: str, over: list[str]) -> DataFrame:
    """Success among the supported over success among the others, with a log-normal interval."""
    s, y = F.col(supported), F.col(success)
    n = lambda c: F.sum(c.cast("double"))
    out = df.groupBy(*over).agg(n(s & y).alias("a"), n(s).alias("m"), n(~s & y).alias("b"), n(~s).alias("k"))
    out = out.where("a > 0 AND b > 0 AND m > 0 AND k > 0").withColumn("rs", (F.col("a") / F.col("m")) / (F.col("b") / F.col("k")))
    se = F.sqrt(1 / F.col("a") - 1 / F.col("m") + 1 / F.col("b") - 1 / F.col("k"))
    return out.withColumn("low", F.exp(F.log("rs") - 1.96 * se)).withColumn("high", F.exp(F.log("rs") + 1.96 * se))


def wilson(x: Column, n: Column, z: float = 1.959963984540054) -> Column:
    """struct(share, low, high): a proportion with its Wilson interval."""
    p = x / n
    middle, half = p + z * z / (2 * n), z * F.sqrt(p * (1 - p) / n + z * z / (4 * n * n))
    scale = 1 + z * z / n
    return F.struct(p.alias("share"), ((middle - half) / scale).alias("low"), ((middle + half) / scale).alias("high"))


def in_all(df: DataFrame, item: str, group: str, k: int) -> DataFrame:
    """Items that occur in all of ``k`` groups."""
    return df.groupBy(item).agg(F.countDistinct(group).alias("n")).where(F.col("n") == k).select(item)


def index_rows(df: DataFrame, key: str, value: str, name: str, hits: str | None = None) -> DataFrame:
    """Rows at the largest value of their key, with the names of the others, sorted.

    With ``hits`` also top_hits: whether the index row (of ties in ``value``
    the least name) has the most hits of its key as well.
    """
    best = F.struct(F.col(value), F.col(name))
    # one aggregation with map-side combine; only the names of a key are gathered
    more = [F.max(hits).alias("_hits"), F.min_by(hits, F.struct(-F.col(value), F.col(name))).alias("_own")] if hits else []
    per = df.groupBy(key).agg(F.max(value).alias("_top"), F.collect_list(best).alias("_all"), *more)
    others = F.array_join(F.array_sort(F.transform(F.filter("_all", lambda s: s[value] < F.col("_top")), lambda s: s[name])), ", ")
    per = per.select(key, "_top", F.when(others != "", others).alias("others"), *([F.col("_own").eqNullSafe(F.col("_hits")).alias("top_hits")] if hits else []))
    return df.join(per, key).where(F.col(value) == F.col("_top")).drop("_top")


def connectedness(pairs: DataFrame, members: DataFrame, threshold: float = 0.8, posteriors: tuple[str, ...] = ("h4",)) -> DataFrame:
    """(component, n_pairs, and for each posterior its connectedness): share of pairs inside a component at or above the threshold.

    The first posterior's share is ``connectedness``; if there are several,
    each one's is ``<name>_connectedness``.
    """
    a, b = members.toDF("a", "component"), members.toDF("b", "component_b")
    inside = pairs.join(a, "a").join(b, "b").where("component = component_b")
    share = lambda h: F.sum((F.col(h) >= threshold).cast("int")) / F.count("*")
    names = ["connectedness"] if len(posteriors) == 1 else [f"{h}_connectedness" for h in posteriors]
    return inside.groupBy("component").agg(F.count("*").alias("n_pairs"), *[share(h).alias(n) for h, n in zip(posteriors, names, strict=True)])


def error_rates(pairs: DataFrame, members: DataFrame, group: str, most_p: float = 5e-8, threshold: float = 0.8) -> DataFrame:
    """One row: significant pairs, false positives among them, pairs expected inside groups, false negatives among those.

    ``pairs``: h4, min_p_a, min_p_b, false_positive, false_negative; both ends
    must be below ``most_p``.  ``members``: one row per member of a group, of
    which n (n - 1) / 2 pairs are expected.
    """
    expected = members.groupBy(group).agg(F.count("*").alias("_n")).agg(F.sum(F.expr("_n * (_n - 1) / 2")).alias("expected_pairs"))
    strong = pairs.where((F.col("min_p_a") < most_p) & (F.col("min_p_b") < most_p))
    high = F.col("h4") > threshold
    n = strong.agg(F.count("*").alias("n_pairs"), F.count_if(high).alias("n_significant"), F.count_if(high & F.col("false_positive")).alias("n_false_positive"), F.count_if("false_negative").alias("n_false_negative"))
    out = n.crossJoin(F.broadcast(expected))  # one row each
    return out.withColumns({"false_positive_rate": F.try_divide("n_false_positive", "n_significant"), "false_negative_rate": F.try_divide("n_false_negative", "expected_pairs")})


def masked_summary(results: DataFrame, cut: str, threshold: float = 0.8) -> DataFrame:
    """Per cut-off (null: the baseline, first; then falling): pairs, mean, median, greatest and share of high h4, and the same of the stored h4.

    ``results``: the cut, h4 of the masked run and file_h4 of the stored one
    (null where there is none).  Pairs without a masked h4 are left out.
    """
    h, f = F.col("h4"), F.col("file_h4")
    passes, stored = h >= threshold, f >= threshold
    there = F.count("file_h4")
    out = results.where("h4 IS NOT NULL").groupBy(cut).agg(
        F.count("*").alias("n_controls"), F.avg(h).alias("mean_h4"), F.median(h).alias("median_h4"), F.max(h).alias("max_h4"),
        F.count_if(passes).alias("n_passing"), (F.count_if(passes) / F.count("*")).alias("fraction_passing"),
        F.avg(f).alias("mean_file_h4"), there.alias("n_file"), F.try_divide(F.count_if(stored), there).alias("fraction_file_passing"), F.try_divide(F.count_if(passes & stored), there).alias("fraction_both_passing"),
    )
    return out.orderBy(F.col(cut).desc_nulls_first())


def fdr(df: DataFrame, p: str, over: list[str]) -> DataFrame:
    """Benjamini-Hochberg q-values in each group, as column q."""
    up = Window.partitionBy(*over).orderBy(F.col(p))
    down = Window.partitionBy(*over).orderBy(F.col(p).desc()).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    rank = F.count("*").over(up.rangeBetween(Window.unboundedPreceding, Window.currentRow))
    n = F.count("*").over(Window.partitionBy(*over))
    return df.withColumn("_raw", F.col(p) * n / rank).withColumn("q", F.least(F.min("_raw").over(down), F.lit(1.0))).drop("_raw")
