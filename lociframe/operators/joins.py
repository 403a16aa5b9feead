"""Joins: intervals, distances, lookups, cascades.  All have an equality key, or one side of a checked small size."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window, WindowSpec

from .windows import numbered

#: A side is broadcast up to so many bytes; where Spark's own estimate says nothing, so many rows are read to find out.
BROADCAST_BYTES, BROADCAST_ROWS = 32 << 20, 50_000


def fits_broadcast(df: DataFrame) -> bool:
    """True if the table is within the bounds: by the optimiser's estimate, else by reading at most one row more than the bound."""
    if int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) <= BROADCAST_BYTES:
        return True
    size = F.sum(F.octet_length(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]))))
    rows, read = df.limit(BROADCAST_ROWS + 1).agg(F.count("*"), F.coalesce(size, F.lit(0))).first()
    return rows <= BROADCAST_ROWS and read <= BROADCAST_BYTES


def small(df: DataFrame, what: str) -> DataFrame:
    """A broadcast side of a join that has no key; larger ones are refused."""
    if not fits_broadcast(df):
        raise ValueError(f"{what} is larger than {BROADCAST_BYTES} bytes")
    return F.broadcast(df)


def interval_join(points: DataFrame, intervals: DataFrame, key: str = "chr", pos: str = "bp", start: str = "start", stop: str = "stop", closed: bool = True, how: str = "inner", bin_width: int = 1_000_000) -> DataFrame:
    """Each point with the intervals that hold it: start <= pos <= stop (closed) or start <= pos < stop.

    A small interval table is broadcast.  A larger one is dealt into bins of
    ``bin_width`` and joined on (key, bin); a point is in one bin, so no pair
    comes twice.
    """
    inside = (F.col(f"p.{pos}") >= F.col(f"i.{start}")) & ((F.col(f"p.{pos}") <= F.col(f"i.{stop}")) if closed else (F.col(f"p.{pos}") < F.col(f"i.{stop}")))
    p_cols = [F.col(f"p.{c}") for c in points.columns]
    i_cols = [F.col(f"i.{c}") for c in intervals.columns if c != key]
    if fits_broadcast(intervals):
        out = points.alias("p").join(F.broadcast(intervals).alias("i"), (F.col(f"p.{key}") == F.col(f"i.{key}")) & inside, how)
        return out.select(*p_cols, *i_cols)
    bins = F.explode(F.sequence(F.floor(F.col(start) / bin_width), F.floor(F.col(stop) / bin_width)))
    i = intervals.withColumn("_bin", bins).alias("i")
    p = points.withColumn("_bin", F.floor(F.col(pos) / bin_width)).alias("p")
    out = p.join(i, (F.col(f"p.{key}") == F.col(f"i.{key}")) & (F.col("p._bin") == F.col("i._bin")) & inside, how)
    return out.select(*p_cols, *i_cols)


def _binned(df: DataFrame, start: str, stop: str, width: int) -> DataFrame:
    lo, hi = F.floor(F.col(start) / width), F.floor(F.col(stop) / width)
    return df.withColumn("_first", lo).withColumn("_bin", F.explode(F.sequence(lo, hi)))


def overlap_join(a: DataFrame, b: DataFrame, key: str, a_range: tuple[str, str], b_range: tuple[str, str], width: int = 1_000_000, within: bool = False) -> DataFrame:
    """Pairs of intervals that overlap (or a inside b): joined on (key, bin), each pair kept in the first bin it shares.

    Columns of ``a`` get the prefix ``a_``, those of ``b`` the prefix ``b_``.
    """
    x = _binned(a, *a_range, width).select(*[F.col(c).alias(f"a_{c}") for c in [*a.columns, "_first", "_bin"]])
    y = _binned(b, *b_range, width).select(*[F.col(c).alias(f"b_{c}") for c in [*b.columns, "_first", "_bin"]])
    (s, e), (t, u) = a_range, b_range
    meets = (F.col(f"a_{s}") >= F.col(f"b_{t}")) & (F.col(f"a_{e}") <= F.col(f"b_{u}")) if within else (F.col(f"a_{s}") <= F.col(f"b_{u}")) & (F.col(f"a_{e}") >= F.col(f"b_{t}"))
    out = x.join(y, (F.col(f"a_{key}") == F.col(f"b_{key}")) & (F.col("a__bin") == F.col("b__bin")) & meets & (F.col("a__bin") == F.greatest("a__first", "b__first")))
    return out.drop("a__first", "a__bin", "b__first", "b__bin")


def overlap_totals(a: DataFrame, b: DataFrame, key: str, a_range: tuple[str, str], b_range: tuple[str, str], value: str, width: int = 1_000_000) -> DataFrame:
    """Rows of ``a`` with n and total: how many intervals of ``b`` each overlaps, and the sum of their ``value``, without the pairs.

    An interval (start <= stop) overlaps all of its key that start at or before
    its stop, but for those that stop before its start.  Both are running totals
    over the positions that occur, summed inside bins of ``width`` and over the
    bins of a key, so the work follows the rows and not the pairs.
    """
    (s, e), (t, u) = a_range, b_range
    none, one, v = F.lit(0).cast("long"), F.lit(1).cast("long"), F.coalesce(value, F.lit(0))
    b, a = b.where(F.col(t).isNotNull() & F.col(u).isNotNull()), a.where(F.col(s).isNotNull() & F.col(e).isNotNull())
    at = lambda d, pos, n0, v0, n1, v1: d.select(F.col(key), F.col(pos).alias("_pos"), n0.alias("_n0"), v0.alias("_v0"), n1.alias("_n1"), v1.alias("_v1"))
    parts = [at(b, t, one, v, none, none), at(b, u, none, none, one, v), at(a, e, none, none, none, none), at(a, s, none, none, none, none)]
    sums = ["_n0", "_v0", "_n1", "_v1"]
    points = reduce(DataFrame.union, parts).groupBy(key, "_pos").agg(*[F.sum(c).alias(c) for c in sums]).withColumn("_bin", F.floor(F.col("_pos") / width))
    before = Window.partitionBy(key).orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    bins = points.groupBy(key, "_bin").agg(*[F.sum(c).alias(c) for c in sums]).select(key, "_bin", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"_b{c}") for c in sums])
    inside = Window.partitionBy(key, "_bin").orderBy("_pos").rowsBetween(Window.unboundedPreceding, 0)
    run = points.select(key, "_pos", "_bin", *[F.sum(c).over(inside).alias(f"_u{c}") for c in sums], "_n1", "_v1").join(bins, [key, "_bin"])
    begun = run.select(key, F.col("_pos").alias(e), (F.col("_b_n0") + F.col("_u_n0")).alias("_n_begun"), (F.col("_b_v0") + F.col("_u_v0")).alias("_v_begun"))
    over = run.select(key, F.col("_pos").alias(s), (F.col("_b_n1") + F.col("_u_n1") - F.col("_n1")).alias("_n_over"), (F.col("_b_v1") + F.col("_u_v1") - F.col("_v1")).alias("_v_over"))
    out = a.join(begun, [key, e]).join(over, [key, s])
    return out.select(*a.columns, (F.col("_n_begun") - F.col("_n_over")).alias("n"), (F.col("_v_begun") - F.col("_v_over")).alias("total"))


def close_pairs(df: DataFrame, group: str, ident: str, pos: str, distance: int, same: str | None = None) -> DataFrame:
    """Unordered pairs (a < b by ``ident``) in a group that are at most ``distance`` apart or share ``same``.

    Distance pairs are found in a bin of that width and the next one, so the
    work follows the number of near pairs and not the square of a group; what
    shares ``same`` and is further apart comes from a join on it.
    """
    cols = [c for c in dict.fromkeys([group, ident, pos, same]) if c]
    base = df.select(*cols).withColumn("_bin", F.floor(F.col(pos) / distance))
    named = lambda d, side, *more: d.select(*[F.col(c).alias(f"{side}_{c}") for c in cols], F.col(group), *more)
    order, apart = F.col(f"x_{ident}") < F.col(f"y_{ident}"), F.abs(F.col(f"x_{pos}") - F.col(f"y_{pos}"))
    x = named(base, "x", F.col("_bin").alias("_own"), F.explode(F.array("_bin", F.col("_bin") + 1)).alias("_bin"))
    near = x.join(named(base, "y", "_bin"), [group, "_bin"]).where((apart <= distance) & ((F.col("_own") < F.col("_bin")) | order)).drop("_bin", "_own")
    if same:
        far = named(base, "x", F.col(same)).join(named(base, "y", F.col(same)), [group, same]).where(order & (apart > distance)).drop(same)
        near = near.unionByName(far)
    first = lambda c: F.when(order, F.col(f"x_{c}")).otherwise(F.col(f"y_{c}")).alias(f"a_{c}")
    second = lambda c: F.when(order, F.col(f"y_{c}")).otherwise(F.col(f"x_{c}")).alias(f"b_{c}")
    rest = [c for c in cols if c != group]
    return near.where(F.col(f"x_{ident}") != F.col(f"y_{ident}")).select(*map(first, rest), *map(second, rest), group, apart.alias("distance"))


def close_pair_totals(df: DataFrame, group: str, pos: str, distance: int, same: str | None = None) -> DataFrame:
    """(group, n, total): how many pairs ``close_pairs`` gives in each group, and the sum of their distances, without the pairs.

    Every row counts as one of its own (``ident`` would be unique in its group);
    rows without group, position or ``same`` meet nothing.  Near pairs come from
    sums over the positions within the distance before each, in a bin of that
    width and the one before it; pairs that share ``same`` from places in the
    order of its positions, less those that are near.
    """
    keys = [group, same] if same else [group]
    base = df.select(*keys, F.col(pos).alias("_pos")).where(reduce(Column.__and__, [F.col(c).isNotNull() for c in [*keys, "_pos"]]))
    zero, width = F.lit(0).cast("long"), max(distance, 1)
    # of rows with the sums _m and _t of the counts and positions that they meet
    pairs = lambda m, t: (F.col("_n") * F.col(m), F.col("_n") * (F.col(m) * F.col("_pos") - F.col(t)))
    alike = F.expr("_n * (_n - 1) div 2")

    def sums(w: WindowSpec, m: str, t: str) -> dict[str, Column]:
        return {m: F.coalesce(F.sum("_n").over(w), zero), t: F.coalesce(F.sum(F.col("_n") * F.col("_pos")).over(w), zero)}

    points = base.groupBy(group, "_pos").agg(F.count("*").alias("_n")).withColumn("_own", F.floor(F.col("_pos") / width))
    dealt = points.withColumn("_bin", F.explode(F.array("_own", F.col("_own") + 1)))
    near = dealt.withColumns(sums(Window.partitionBy(group, "_bin").orderBy("_pos").rangeBetween(-distance, -1), "_m", "_t") if distance else {"_m": zero, "_t": zero}).where("_own = _bin")
    n, total = pairs("_m", "_t")
    parts = [near.groupBy(group).agg(F.sum(n + alike).alias("n"), F.sum(total).alias("total"))]
    if same:
        w = Window.partitionBy(*keys).orderBy("_pos")
        fine = base.groupBy(*keys, "_pos").agg(F.count("*").alias("_n"))
        fine = fine.withColumns(sums(w.rowsBetween(Window.unboundedPreceding, -1), "_m", "_t") | (sums(w.rangeBetween(-distance, -1), "_near_m", "_near_t") if distance else {"_near_m": zero, "_near_t": zero}))
        (n, total), (near_n, near_total) = pairs("_m", "_t"), pairs("_near_m", "_near_t")  # rows alike are near
        parts.append(fine.groupBy(group).agg(F.sum(n - near_n).alias("n"), F.sum(total - near_total).alias("total")))
    return reduce(DataFrame.unionByName, parts).groupBy(group).agg(F.sum("n").alias("n"), F.sum("total").alias("total")).where("n > 0")


def first_match(left: DataFrame, right: DataFrame, on: str, order: list[str], keep: list[str]) -> DataFrame:
    """Left join with the first row of each key on the right (by ``order``)."""
    first = right.groupBy(on).agg(F.min_by(F.struct(*keep), F.struct(*order)).alias("_m"))
    return left.join(first, on, "left").select(*left.columns, *[F.col(f"_m.{c}").alias(c) for c in keep])


def update_join(left: DataFrame, new: DataFrame, on: list[str], columns: list[str]) -> DataFrame:
    """Rows of ``left`` with ``columns`` taken from ``new`` where it has the key and a value."""
    n = new.select(*on, *[F.col(c).alias(f"_new_{c}") for c in columns])
    out = left.join(n, on, "left")
    return out.select(*[F.coalesce(f"_new_{c}", c).alias(c) if c in columns else F.col(c) for c in left.columns])


def both_ways(pairs: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Pairs and their mirror images."""
    turned = pairs.select(*[F.col(b).alias(a) if c == a else F.col(a).alias(b) if c == b else F.col(c) for c in pairs.columns])
    return pairs.unionByName(turned)


def full_grid(df: DataFrame, rows: DataFrame, columns: DataFrame, fill: dict[str, object]) -> DataFrame:
    """Every combination of ``rows`` and ``columns`` (the latter a small dimension), with defaults where ``df`` has none."""
    grid = rows.crossJoin(small(columns, "the column dimension"))
    out = grid.join(df, [*rows.columns, *columns.columns], "left")
    return out.fillna(fill)


def shared_keys(a: DataFrame, b: DataFrame, key: str, value: str) -> DataFrame:
    """(key, value_a, value_b): keys both sides have exactly once and not null."""
    once = lambda d, n: d.where(F.col(key).isNotNull() & F.col(value).isNotNull()).groupBy(key).agg(F.count("*").alias("_n"), F.first(value).alias(n)).where("_n = 1").drop("_n")
    return once(a, f"{value}_a").join(once(b, f"{value}_b"), key)


def cascade(left: DataFrame, right: DataFrame, on: str, against: str, forms: list) -> DataFrame:
    """(left columns, right columns, step): matches by one normal form after another; matched rows leave both sides.

    ``forms``: functions of a column, tried in order.
    """
    found = []
    for step, form in enumerate(forms):
        a, b = left.withColumn("_k", form(F.col(on))), right.withColumn("_k", form(F.col(against)))
        hit = a.join(b, "_k").drop("_k").withColumn("step", F.lit(step))
        found.append(hit)
        left, right = left.join(hit.select(on).distinct(), on, "left_anti"), right.join(hit.select(against).distinct(), against, "left_anti")
    return reduce(DataFrame.unionByName, found)


def blocked(df: DataFrame, block_list: DataFrame, name: str, kind: str) -> DataFrame:
    """Rows not named by a block-list of (id_pattern, cis_trans); a null or blank cis_trans blocks any kind."""
    b = small(block_list.select(F.col("id_pattern").alias("_pattern"), F.col("cis_trans").alias("_kind")), "the block-list")
    hit: Column = F.rlike(F.col(name), F.col("_pattern")) & ((F.coalesce("_kind", F.lit("")) == "") | (F.col("_kind") == F.col(kind)))
    return df.join(b, hit, "left_anti")


def surrogate_ids(df: DataFrame, old: DataFrame, key: str, ident: str = "id") -> DataFrame:
    """Ids of ``old`` by natural key; new keys get the numbers after its largest, in order of the key."""
    have = df.join(old.select(key, F.col(ident)), key, "left")
    top = old.agg(F.coalesce(F.max(ident), F.lit(0)).alias("_top"))
    fresh = have.where(F.col(ident).isNull()).drop(ident)
    ranged = numbered(fresh, [key], "_rank").crossJoin(F.broadcast(top))
    given = ranged.withColumn(ident, (F.col("_top") + F.col("_rank")).cast("long")).drop("_top", "_rank")
    return have.where(F.col(ident).isNotNull()).unionByName(given)
