"""Statistical kernels.

Closed forms are column expressions and aggregates.  What needs linear algebra
runs by group (one study in one block) with numpy, on the group's rows and
its block's LD rows only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from ..constants import COLOC_PRIORS, IMPUTATION_LD_R, MIN_SHARED_SNPS
from ..scratch import cut_lineage

# ---- closed forms ---------------------------------------------------------------------------------------------


def trait_sd(df: DataFrame, over: list[str], n: Column) -> DataFrame:
    """(over, sd): root of the slope through the origin of 2 n eaf (1 - eaf) on 1 / se^2; null if negative."""
    y, x = 2 * n * F.col("eaf") * (1 - F.col("eaf")), 1 / (F.col("se") * F.col("se"))
    slope = F.sum(x * y) / F.sum(x * x)
    return df.groupBy(*over).agg(F.when(slope >= 0, F.sqrt(slope)).alias("sd"))


def effects_from_z(df: DataFrame, over: list[str], n: Column, z: str = "z") -> DataFrame:
    """beta_new and se_new from z, scaled by the slope of new on old effects in each group."""
    se = 1 / F.sqrt(2 * F.col("eaf") * (1 - F.col("eaf")) * n)
    out = df.withColumn("_se", se).withColumn("_beta", F.col(z) * se)
    slopes = out.groupBy(*over).agg(F.regr_slope("_beta", "beta").alias("_slope"))
    out = out.join(slopes, over)
    return out.withColumn("beta_new", F.col("_beta") / F.col("_slope")).withColumn("se_new", F.col("_se") / F.col("_slope")).drop("_se", "_beta", "_slope")


def outliers(df: DataFrame, over: list[str], value: str) -> DataFrame:
    """Flag beyond three standard deviations from the median, twice: the second deviation is that of what passed the first; null is an outlier."""
    first = df.groupBy(*over).agg(F.median(value).alias("_m"), F.stddev_samp(value).alias("_s1"))
    near = df.join(first, over)
    inside = F.abs(F.col(value) - F.col("_m")) <= 3 * F.col("_s1")
    second = near.where(inside).groupBy(*over).agg(F.stddev_samp(value).alias("_s2"))
    out = near.join(second, over, "left")
    ok = inside & (F.abs(F.col(value) - F.col("_m")) <= 3 * F.col("_s2"))
    return out.withColumn("outlier", ~F.coalesce(ok, F.lit(False))).drop("_m", "_s1", "_s2")


def cooks(df: DataFrame, over: list[str], y: str, x: str) -> DataFrame:
    """Cook's distance of each row in the simple regression of y on x."""
    s = df.groupBy(*over).agg(F.count("*").alias("_n"), F.avg(x).alias("_mx"), F.regr_slope(y, x).alias("_b"), F.regr_intercept(y, x).alias("_a"), F.regr_sxx(y, x).alias("_sxx"), F.regr_syy(y, x).alias("_syy"), F.regr_sxy(y, x).alias("_sxy"))
    s = s.withColumn("_mse", (F.col("_syy") - F.col("_b") * F.col("_sxy")) / (F.col("_n") - 2))
    out = df.join(s, over)
    h = 1 / F.col("_n") + F.pow(F.col(x) - F.col("_mx"), F.lit(2)) / F.col("_sxx")
    e = F.col(y) - F.col("_a") - F.col("_b") * F.col(x)
    return out.withColumn("cook", e * e / (2 * F.col("_mse")) * h / F.pow(1 - h, F.lit(2))).drop("_n", "_mx", "_b", "_a", "_sxx", "_syy", "_sxy", "_mse")


def origin_slope(df: DataFrame, over: list[str], y: str, x: str) -> DataFrame:
    """Adjustment of first degree: slope through the origin and its fitted values."""
    s = df.groupBy(*over).agg((F.sum(F.col(x) * F.col(y)) / F.sum(F.col(x) * F.col(x))).alias("_b"))
    return df.join(s, over).withColumn("adjusted", F.col("_b") * F.col(x)).drop("_b")


def padded(df: DataFrame) -> DataFrame:
    """Null effects of a sparse study become no effect, flagged as imputed."""
    return df.withColumn("imputed", F.col("beta").isNull()).withColumns({c: F.coalesce(c, F.lit(v)) for c, v in {"beta": 0.0, "se": 1.0, "p": 1.0, "z": 0.0}.items()})


def without_inflated(df: DataFrame, ld: DataFrame, over: list[str], snp: str = "snp", r: float = IMPUTATION_LD_R, factor: float = 10.0) -> DataFrame:
    """Rows without the imputed ones that are ``factor`` times more significant than the best observed LD neighbour, or than all observed without one."""
    seen = df.where("NOT imputed")
    floor = seen.groupBy(*over).agg(F.min("p").alias("_floor"))
    near = ld.where(F.abs(F.col("r")) > r).select(F.col("lead").alias(snp), F.col("proxy").alias("_proxy"))
    best = near.join(seen.select(*over, F.col(snp).alias("_proxy"), "p"), "_proxy").groupBy(*over, snp).agg(F.min("p").alias("_best"))
    out = df.join(best, [*over, snp], "left").join(floor, over, "left")
    bad = F.when(F.col("_best").isNotNull(), F.col("p") * factor < F.col("_best")).otherwise(F.col("p") < F.col("_floor"))
    return out.where(~(F.col("imputed") & F.coalesce(bad, F.lit(False)))).drop("_best", "_floor")


def coloc(pairs: DataFrame, lbf: DataFrame, study: str = "study", snp: str = "snp", priors: tuple = COLOC_PRIORS, least: int = MIN_SHARED_SNPS) -> DataFrame:
    """(a, b, nsnps, h0..h4, ignored): posteriors of no, one, other, two distinct and one shared signal for each pair.

    One join of pairs to both log Bayes factors and two aggregations (the
    largest, then the shifted sums); no vectors are collected.
    """
    p1, p2, p12 = priors
    x = lbf.select(F.col(study).alias("a"), F.col(snp).alias("_s"), F.col("lbf").alias("la"))
    y = lbf.select(F.col(study).alias("b"), F.col(snp).alias("_s"), F.col("lbf").alias("lb"))
    rows = pairs.select("a", "b").join(x, "a").join(y, ["b", "_s"])
    top = rows.groupBy("a", "b").agg(F.count("*").alias("nsnps"), F.max("la").alias("ma"), F.max("lb").alias("mb"), F.max(F.col("la") + F.col("lb")).alias("mab"))
    ex = lambda v, m: F.sum(F.exp(F.col(v) - F.col(m)) if isinstance(v, str) else F.exp(v - F.col(m)))
    sums = rows.join(top, ["a", "b"]).groupBy("a", "b", "nsnps", "ma", "mb", "mab").agg(ex("la", "ma").alias("sa"), ex("lb", "mb").alias("sb"), ex(F.col("la") + F.col("lb"), "mab").alias("sab"))
    l1, l2, l12 = (F.col(m) + F.log(F.col(s)) for m, s in (("ma", "sa"), ("mb", "sb"), ("mab", "sab")))
    gap = l12 - (l1 + l2)
    l3 = F.when(gap < 0, l1 + l2 + F.log1p(-F.exp(gap))).otherwise(F.lit(float("-inf")))
    logs = [F.lit(0.0), F.log(F.lit(p1)) + l1, F.log(F.lit(p2)) + l2, F.log(F.lit(p1 * p2)) + l3, F.log(F.lit(p12)) + l12]
    out = sums.select("a", "b", "nsnps", *[v.alias(f"_l{i}") for i, v in enumerate(logs)])
    m = F.greatest(*[f"_l{i}" for i in range(5)])
    total = sum((F.exp(F.col(f"_l{i}") - m) for i in range(1, 5)), F.exp(F.col("_l0") - m))
    post = [F.when(F.col("nsnps") >= least, F.exp(F.col(f"_l{i}") - m) / total).alias(f"h{i}") for i in range(5)]
    return out.select("a", "b", "nsnps", *post, (F.col("nsnps") < least).alias("ignored"))


#: Fewest studies of a tile, but for the last; a group has at most so many tiles, unless a tile would hold more than so many values.
TILE_STUDIES, MOST_TILES, TILE_VALUES = 1000, 4, 1 << 22
#: Studies of both tiles that are worked on at once.
STEP = (64, 1024)


def _dealt(lbf: DataFrame, over: list[str], study: str, snp: str, owner: str | None, tile: int) -> DataFrame:
    """Studies as single rows with their SNPs, dealt to tiles; each two tiles (_i, _j) of a group get the studies of both.

    A study's row is there once for each tile of its group, and a group has a
    bounded number of tiles: what is shuffled grows with the studies.  The
    tiles of a group are counted in a row for each group, which goes to the
    studies: these are never sent whole, nor kept together by group.
    """
    lbf = lbf.where(F.col(study).isNotNull() & F.col(snp).isNotNull())
    n, p = F.approx_count_distinct(study), F.approx_count_distinct(snp)
    count = F.least(F.ceil(n / tile), F.greatest(F.lit(MOST_TILES), F.ceil(n * p / TILE_VALUES)))
    tiles = lbf.groupBy(*over).agg(F.greatest(count, F.lit(1)).cast("int").alias("_tiles"))
    who = F.col(owner or study)
    packed = lbf.groupBy(*over, F.col(study).alias("_name"), who.alias("_owner")).agg(F.collect_list(F.struct(F.col(snp).alias("s"), F.col("lbf").cast("double").alias("v"))).alias("_v"))
    own = F.pmod(F.xxhash64("_name"), F.col("_tiles")).cast("int")
    dealt = packed.join(F.broadcast(tiles), over).select(*over, "_name", "_owner", F.col("_v.s").alias("_snps"), F.col("_v.v").alias("_lbf"), own.alias("_own"), F.explode(F.sequence(F.lit(0), F.col("_tiles") - 1)).alias("_other"))
    return dealt.withColumns({"_i": F.least("_own", "_other"), "_j": F.greatest("_own", "_other")}).drop("_other")


def coloc_within(lbf: DataFrame, over: list[str], study: str = "study", snp: str = "snp", owner: str | None = None, priors: tuple = COLOC_PRIORS, least: int = MIN_SHARED_SNPS, tile: int = TILE_STUDIES, digits: int | None = None) -> DataFrame:
    """``coloc`` of all pairs a < b of a group (``over``): (over, a, b, nsnps, h0..h4, ignored); a pair without a shared SNP has no row.

    A study is one row with its SNPs (each once).  A group's studies are dealt
    to tiles, and each two tiles meet in one call, which gives its pairs bit by
    bit; no row is made for each SNP of a pair.  Pairs of the same ``owner``
    are left out.  Posteriors are rounded to ``digits``, if given.
    """
    dealt = _dealt(lbf, over, study, snp, owner, tile)
    kinds = dict(dealt.dtypes)
    schema = ", ".join([*[f"`{c}` {kinds[c]}" for c in over], f"a {kinds['_name']}", f"b {kinds['_name']}", "nsnps long", *[f"h{k} double" for k in range(5)], "ignored boolean"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = pa.Table.from_batches(list(batches))
        x, y, names, same = _two_tiles(t)
        groups = [t.column(c)[0] for c in over]
        for turned, keep, count, none, e, total in _met(x, y, same, priors):
            if keep.all():
                flat = lambda v, shape=keep.shape: np.broadcast_to(v, shape).ravel()
            else:
                flat = lambda v, keep=keep: np.broadcast_to(v, keep.shape)[keep]
            nsnps, swap = flat(count).astype(np.int64), flat(turned[0])
            at_x, at_y = flat(turned[1]), flat(turned[2])
            few = nsnps < least
            h = [flat(v) / flat(total) for v in e]
            if digits is not None:
                h = [_rounded(v, digits) for v in h]
            h[1], h[2] = np.where(swap, h[2], h[1]), np.where(swap, h[1], h[2])
            mask = few | flat(none)
            columns = [*[pa.repeat(v, len(few)) for v in groups], names.take(pa.array(np.where(swap, at_y, at_x))), names.take(pa.array(np.where(swap, at_x, at_y))), pa.array(nsnps), *[pa.array(v, mask=mask) for v in h], pa.array(few)]
            yield pa.RecordBatch.from_arrays(columns, names=[*over, "a", "b", "nsnps", *[f"h{k}" for k in range(5)], "ignored"])

    return dealt.groupBy(*over, "_i", "_j").applyInArrow(run, schema)


def coloc_masked(lbf: DataFrame, over: list[str], cuts: tuple[float, ...], study: str = "study", snp: str = "snp", priors: tuple = COLOC_PRIORS, least: int = MIN_SHARED_SNPS, tile: int = TILE_STUDIES, digits: int = 6, high: float = 0.8) -> DataFrame:
    """(cut, n, mean_h4, high): ``coloc`` of all pairs of a group, where log Bayes factors below a cut (in size) count as 0.

    Pairs, the mean of their rounded h4 and how many reach ``high``, for each
    cut.  Each two tiles of studies meet once for all cuts and give a row for
    each, so pairs are summed where they are made.
    """
    dealt = _dealt(lbf, over, study, snp, None, tile)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        x, y, _, same = _two_tiles(pa.Table.from_batches(list(batches)))
        rows = []
        for cut in cuts:
            n = known = reach = 0
            total = 0.0
            mine = x.masked(cut)
            for _, keep, count, none, (h,), whole in _met(mine, mine if same else y.masked(cut), same, priors, (4,)):
                valid = keep & ~(none | (count < least))
                h /= whole
                h = _rounded(h.ravel() if valid.all() else h[valid], digits)
                n, known, total, reach = n + int(keep.sum()), known + len(h), total + float(h.sum()), reach + int((~(h < high)).sum())  # what is no number is above all, as in SQL
            rows.append((cut, n, known, total, reach))
        yield pa.RecordBatch.from_arrays([pa.array(v) for v in zip(*rows, strict=True)], names=["cut", "n", "known", "total", "high"])

    sums = dealt.groupBy(*over, "_i", "_j").applyInArrow(run, "cut double, n long, known long, total double, high long")
    sums = sums.groupBy("cut").agg(*[F.sum(c).alias(c) for c in ("n", "known", "total", "high")])
    grid = lbf.sparkSession.createDataFrame([(float(c),) for c in cuts], "cut double")
    whole = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    return grid.join(sums, "cut", "left").select("cut", whole("n"), F.when(F.col("known") > 0, F.col("total") / F.col("known")).alias("mean_h4"), whole("high"))


class _Tile:
    """Studies (rows) by SNP: log Bayes factors (-inf where there is none), which SNPs are there, which have a value."""

    def __init__(self, v: np.ndarray, there: np.ndarray, known: np.ndarray, place: np.ndarray, rank: np.ndarray, owner: np.ndarray):
        self.v, self.there, self.known, self.place, self.rank, self.owner = v, there, known, place, rank, owner
        self.odd = np.isnan(v).any(1) | np.isposinf(v).any(1) | np.isneginf(v).all(1)  # what has no finite sum is left to the direct way
        self.top = np.where(self.odd, 0.0, v.max(1, initial=-np.inf))
        # exp of the values less their row's largest
        self.e = np.where(self.odd[:, None], 0.0, np.exp(np.where(self.odd[:, None], 0.0, v) - self.top[:, None]))
        self.far = self.odd | (np.abs(self.top) > 300)  # goes by logs
        self.scale = np.exp(-np.where(self.far, 0.0, self.top))
        self.sum = self.e.sum(1)
        self.full = bool(there.all() and known.all())

    def masked(self, cut: float) -> _Tile:
        """The same with 0 for values below the cut in size, and for those without a value."""
        there = self.there > 0
        v = np.where(there, np.where((self.known > 0) & ~(np.abs(self.v) < cut), self.v, 0.0), -np.inf)
        return _Tile(v, self.there, self.there, self.place, self.rank, self.owner)


def _two_tiles(t: pa.Table) -> tuple[_Tile, _Tile, pa.Array, bool]:
    """Both tiles of a call in order of name, the names that their places stand for, and whether they are the same tile."""
    codes = lambda c: np.unique(c.to_numpy(zero_copy_only=False), return_inverse=True)[1].reshape(-1)
    i, j = (t.column(c)[0].as_py() for c in ("_i", "_j"))
    own, names = t.column("_own").to_numpy(), pa.concat_arrays(t.column("_name").chunks)
    rank, owner = codes(names), codes(pa.concat_arrays(t.column("_owner").chunks))
    snps = np.unique(pa.concat_arrays(t.column("_snps").chunks).flatten().to_numpy(zero_copy_only=False))

    def tile(k: int) -> _Tile:
        place = np.flatnonzero(own == k)
        place = place[np.argsort(rank[place], kind="stable")]
        part = t.select(["_snps", "_lbf"]).take(pa.array(place))
        lists, values = part.column("_snps").combine_chunks(), part.column("_lbf").combine_chunks().flatten()
        v, there, known = np.full((len(place), len(snps)), -np.inf), np.zeros((len(place), len(snps))), np.zeros((len(place), len(snps)))
        at = (np.repeat(np.arange(len(place)), lists.value_lengths().to_numpy()), np.searchsorted(snps, lists.flatten().to_numpy(zero_copy_only=False)))
        has = values.is_valid().to_numpy(zero_copy_only=False)
        v[at] = np.where(has, values.to_numpy(zero_copy_only=False), -np.inf)
        there[at], known[at] = 1.0, has
        return _Tile(v, there, known, place, rank[place], owner[place])

    x = tile(i)
    return x, x if i == j else tile(j), names, i == j


def _log_sums(la: np.ndarray, lb: np.ndarray, shared: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Logs of the sums of exp(la), exp(lb) and exp(la + lb) over the shared SNPs of pairs (rows), each shifted by its own largest."""
    out = []
    with np.errstate(invalid="ignore", divide="ignore"):
        for v in (la, lb, la + lb):
            v = np.where(shared, v, -np.inf)
            top = v.max(1)
            out.append(top + np.log(np.exp(v - top[:, None]).sum(1)))
    return tuple(out)


def _rounded(v: np.ndarray, digits: int) -> np.ndarray:
    """Halves up, in place."""
    v *= 10.0**digits
    v += 0.5
    np.floor(v, out=v)
    v /= 10.0**digits
    return v


def _met(x: _Tile, y: _Tile, same: bool, priors: tuple, which: tuple[int, ...] = (0, 1, 2, 3, 4)) -> Iterator[tuple]:
    """Pairs of two tiles, a few of their studies at a time: (turned and places, keep, count, none, e, total).

    Of each pair: whether its first study is that of the second tile (and the
    places of both), whether it is a pair, how many SNPs it shares, whether
    none of them has both values, the weights of ``which`` hypotheses (1 is
    the first tile's study, 2 the second's) and the sum of all five: the
    posteriors are e / total.
    """
    p1, p2, p12 = priors
    full = x.full and y.full
    for first in range(0, len(x.v), STEP[0]):
        r = slice(first, min(len(x.v), first + STEP[0]))
        for start in range(first - first % STEP[1] if same else 0, len(y.v), STEP[1]):
            c = slice(start, min(len(y.v), start + STEP[1]))
            one, other = lambda v, r=r: v[r, None], lambda v, c=c: v[None, c]
            turned = one(x.rank) > other(y.rank)
            keep = one(x.owner) != other(y.owner)
            if same:
                keep &= one(x.rank) < other(y.rank)
            sxy = x.e[r] @ y.e[c].T
            if full:
                count, none, sx, sy = np.full((1, 1), float(x.v.shape[1])), np.zeros((1, 1), bool), one(x.sum), other(y.sum)
            else:
                count, none = x.there[r] @ y.there[c].T, x.known[r] @ y.known[c].T == 0
                sx, sy = x.e[r] @ y.there[c].T, x.there[r] @ y.e[c].T
                keep &= count > 0
            if not keep.any():
                continue
            a, b = one(x.scale), other(y.scale)
            px, py = (p1, p2) if p1 == p2 else (np.where(turned, p2, p1), np.where(turned, p1, p2))
            weight = (lambda: a * b, lambda: px * sx * b, lambda: py * sy * a, lambda: p1 * p2 * np.maximum(sx * sy - sxy, 0.0), lambda: p12 * sxy)  # noqa: B023
            e = [np.broadcast_to(weight[k](), keep.shape).copy() if k < 4 else weight[k]() for k in which]
            total = (a + px * sx) * (b + py * sy)
            total += (p12 - p1 * p2) * sxy
            # what is far below its row's largest is summed again from its own largest
            tiny = sxy < 1e-250 if full else np.minimum(np.minimum(sx, sy), sxy) < 1e-250
            if tiny.any() or x.far[r].any() or y.far[c].any():
                at = np.nonzero(keep & (tiny | one(x.far) | other(y.far)))
                for k in range(0, len(at[0]), 4096):
                    i, j = at[0][k : k + 4096], at[1][k : k + 4096]
                    h = _by_logs(x, y, i + first, j + start, [np.broadcast_to(v, keep.shape)[i, j] for v in (sx, sy, sxy)], np.broadcast_to(px, keep.shape)[i, j], np.broadcast_to(py, keep.shape)[i, j], priors)
                    for v, m in zip(e, which, strict=True):
                        v[i, j] = h[m]
                    total[i, j] = 1.0
            yield (turned, one(x.place), other(y.place)), keep, count, none, e, total


def _by_logs(x: _Tile, y: _Tile, r: np.ndarray, c: np.ndarray, sums: list[np.ndarray], px: np.ndarray, py: np.ndarray, priors: tuple) -> np.ndarray:
    """Posteriors of listed pairs from the logs of their sums, which are made anew from the values where they are small or not finite."""
    p1, p2, p12 = priors
    again = np.flatnonzero((np.minimum.reduce(sums) < 1e-250) | x.odd[r] | y.odd[c])
    with np.errstate(divide="ignore", invalid="ignore"):
        lx, ly, lxy = (np.log(s) + shift for s, shift in zip(sums, (x.top[r], y.top[c], x.top[r] + y.top[c]), strict=True))
        if len(again):
            lx[again], ly[again], lxy[again] = _log_sums(x.v[r[again]], y.v[c[again]], (x.there[r[again]] > 0) & (y.there[c[again]] > 0))
        gap = lxy - (lx + ly)
        l3 = np.where(gap < 0, lx + ly + np.log1p(-np.exp(np.minimum(gap, 0.0))), -np.inf)
        logs = np.stack([np.zeros(len(r)), np.log(px) + lx, np.log(py) + ly, np.log(p1 * p2) + l3, np.log(p12) + lxy])
        e = np.exp(logs - logs.max(0))
        return e / e.sum(0)


def ivw(df: DataFrame, over: list[str]) -> DataFrame:
    """Inverse-variance-weighted slope and standard error of by on bx."""
    w = 1 / (F.col("se_y") * F.col("se_y"))
    return df.groupBy(*over).agg((F.sum(F.col("bx") * F.col("by") * w) / F.sum(F.col("bx") * F.col("bx") * w)).alias("slope"), (1 / F.sqrt(F.sum(F.col("bx") * F.col("bx") * w))).alias("se"), F.count("*").alias("n"))


def ivw_by_set(df: DataFrame, over: list[str], instrument: str) -> DataFrame:
    """Slopes by instrument set (cis, trans, indirect cis): inverse-variance weighted, the Wald ratio where a set has one instrument."""
    return ivw(df, [*over, instrument]).withColumn("method", F.when(F.col("n") == 1, "wald").otherwise("ivw"))


def ks_distance(df: DataFrame, side: str, value: str) -> DataFrame:
    """Largest gap of the two empirical distributions (side is a boolean).

    Ties are summed first; the distinct values are range-partitioned, and each
    partition starts at the sums of those before it, so no task holds them all.
    """
    at = df.groupBy(value).agg(F.sum(F.col(side).cast("long")).alias("n1"), F.sum((~F.col(side)).cast("long")).alias("n0"))
    at = cut_lineage(at.repartitionByRange(value).withColumn("_part", F.spark_partition_id()))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # one row for each partition
    per = at.groupBy("_part").agg(F.sum("n1").alias("s1"), F.sum("n0").alias("s0"))
    per = per.select("_part", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"b{c[1]}") for c in ("s1", "s0")])
    whole = at.agg(F.sum("n1").alias("t1"), F.sum("n0").alias("t0"))
    w = Window.partitionBy("_part").orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    run = at.withColumns({"u1": F.sum("n1").over(w), "u0": F.sum("n0").over(w)}).join(F.broadcast(per), "_part").crossJoin(F.broadcast(whole))
    gap = F.abs((F.col("u1") + F.col("b1")) / F.col("t1") - (F.col("u0") + F.col("b0")) / F.col("t0"))
    return run.agg(F.max(gap).alias("d"))


def ld_long(matrix: DataFrame, leads: DataFrame, keep_r2: float = 0.8) -> DataFrame:
    """(block, lead, proxy, r) from matrix rows (block, snp, names, r array): strong pairs, or all of a lead; never the diagonal."""
    cells = matrix.select("block", F.col("snp").alias("lead"), F.explode(F.arrays_zip(F.col("names").alias("proxy"), F.col("r").alias("r"))).alias("c")).select("block", "lead", F.col("c.proxy").alias("proxy"), F.col("c.r").alias("r"))
    cells = cells.join(leads.select(F.col("snp").alias("lead"), F.lit(True).alias("_is")).distinct(), "lead", "left")
    return cells.where((F.col("lead") != F.col("proxy")) & ((F.col("r") * F.col("r") > keep_r2) | F.col("_is"))).select("block", "lead", "proxy", "r")


def ld_signs(ld: DataFrame, flipped: DataFrame) -> DataFrame:
    """r with its sign turned once for each flipped end."""
    f = flipped.select("snp").distinct()
    out = ld.join(f.select(F.col("snp").alias("lead"), F.lit(-1).alias("_a")), "lead", "left").join(f.select(F.col("snp").alias("proxy"), F.lit(-1).alias("_b")), "proxy", "left")
    return out.withColumn("r", F.col("r") * F.coalesce("_a", F.lit(1)) * F.coalesce("_b", F.lit(1))).drop("_a", "_b")


# ---- by group, with numpy -------------------------------------------------------------------------------------


def by_group(df: DataFrame, over: list[str], kernel, schema: str) -> DataFrame:
    """``kernel(pandas) -> pandas`` for each group; its output holds the keys."""
    return df.groupBy(*over).applyInPandas(kernel, schema)


def polynomial(x: np.ndarray, y: np.ndarray, clean: np.ndarray, degree: int = 3) -> np.ndarray:
    """Fitted values for all rows of a raw polynomial without intercept, fitted on the clean ones."""
    basis = np.vander(x, degree + 1, increasing=True)[:, 1:]
    if clean.sum() < degree:
        return np.full(len(x), np.nan)
    return basis @ np.linalg.lstsq(basis[clean], y[clean], rcond=None)[0]


def eigen_imputed(z: np.ndarray, seen: np.ndarray, upto: np.ndarray, vectors: np.ndarray, share: float = 0.9) -> np.ndarray:
    """z for all SNPs of all studies (rows): regression of the seen ones on the leading eigenvectors that hold ``share`` of the variance.

    ``upto``: share of the variance up to each eigenvector.  Studies that have
    seen the same SNPs are solved for together.
    """
    out, k = np.empty(z.shape), int(np.searchsorted(upto, share)) + 1
    patterns, which = np.unique(seen, axis=0, return_inverse=True)
    for i, pattern in enumerate(patterns):
        rows = np.flatnonzero(which.reshape(-1) == i)
        basis = np.column_stack([np.ones(z.shape[1]), vectors[:, : min(k, max(1, int(pattern.sum()) - 2))]])
        out[rows] = (basis @ np.linalg.lstsq(basis[pattern], z[rows][:, pattern].T, rcond=None)[0]).T
    return out


def elastic_net_path(x: np.ndarray, y: np.ndarray, penalties: np.ndarray, mix: float = 0.5, rounds: int = 2000, tolerance: float = 1e-9, exact: bool = True) -> np.ndarray:
    """Coefficients (intercept first) for each penalty: half the mean squared error plus penalty * (mix |b| + (1 - mix) / 2 b^2) is least, on scaled columns."""
    return elastic_net_paths(x, y[None], penalties[None], mix, rounds, tolerance, exact)[0]


def elastic_net_paths(x: np.ndarray, y: np.ndarray, penalties: np.ndarray, mix: float = 0.5, rounds: int = 2000, tolerance: float = 1e-9, exact: bool = True) -> np.ndarray:
    """The same of many responses (rows of ``y``) on one ``x``, each with penalties of its own.

    All responses and penalties at once, by alternating directions on the
    eigenvectors of the Gram matrix; a response that has settled leaves the
    rounds.  ``exact`` solves for the coefficients found not to be zero.
    """
    n, (many, each) = x.shape[0], penalties.shape
    mean, sd = x.mean(0), x.std(0)
    sd = np.where(sd > 0, sd, 1.0)
    z = (x - mean) / sd
    gram, cross = z.T @ z / n, z.T @ (y - y.mean(1, keepdims=True)).T / n
    ridge, cut, rho = penalties * (1 - mix), penalties * mix, np.maximum(3 * penalties, 1e-3)
    values, vectors = np.linalg.eigh(gram)
    wide = lambda v: v.reshape(len(v), -1, each)
    found, left = np.zeros((x.shape[1], many, each)), np.arange(many)
    b = u = np.zeros((x.shape[1], many * each))
    for _ in range(rounds):
        weight = rho[left].ravel()
        free = vectors @ (vectors.T @ (np.repeat(cross[:, left], each, axis=1) + weight * (b - u)) / (values[:, None] + ridge[left].ravel() + weight))
        ahead = 1.6 * free - 0.6 * b
        new = np.sign(ahead + u) * np.maximum(np.abs(ahead + u) - cut[left].ravel() / weight, 0.0)
        moved = wide(np.maximum(np.abs(new - b), np.abs(free - new))).max(axis=(0, 2), initial=0.0)
        u, b = u + ahead - new, new
        if (settled := moved < tolerance).any():
            found[:, left[settled]] = wide(b)[:, settled]
            left, b, u = left[~settled], wide(b)[:, ~settled].reshape(len(b), -1), wide(u)[:, ~settled].reshape(len(u), -1)
            if not len(left):
                break
    found[:, left] = wide(b)
    if exact:
        for s in range(many):
            for k in range(each):
                on = np.flatnonzero(found[:, s, k])
                solved = np.linalg.solve(gram[np.ix_(on, on)] + (ridge[s, k] + 1e-12) * np.eye(len(on)), cross[on, s] - cut[s, k] * np.sign(found[on, s, k]))
                if (np.sign(solved) == np.sign(found[on, s, k])).all():
                    found[on, s, k] = solved
    out = (found / sd[:, None, None]).transpose(1, 2, 0)
    return np.concatenate([(y.mean(1)[:, None] - out @ mean)[:, :, None], out], axis=2)


def elastic_net_cv(x: np.ndarray, y: np.ndarray, folds: int = 5, penalties: int = 8) -> np.ndarray:
    """Coefficients at the penalty of least cross-validated error; the folds are fixed."""
    return elastic_nets_cv(x, y[None], folds, penalties)[0]


def elastic_nets_cv(x: np.ndarray, y: np.ndarray, folds: int = 5, penalties: int = 8) -> np.ndarray:
    """The same of many responses (rows of ``y``) on one ``x``, fitted together."""
    n = x.shape[0]
    top = np.abs((x - x.mean(0)).T @ (y - y.mean(1, keepdims=True)).T).max(axis=0, initial=1e-6) / n
    grid, fold = top[:, None] * np.logspace(0, -3, penalties), np.arange(n) % folds
    error = np.zeros(grid.shape)
    for f in range(folds):
        b = elastic_net_paths(x[fold != f], y[:, fold != f], grid, tolerance=1e-4, exact=False)
        error += ((y[:, None, fold == f] - b[:, :, :1] - b[:, :, 1:] @ x[fold == f].T) ** 2).sum(2)
    return elastic_net_paths(x, y, np.take_along_axis(grid, np.argmin(error, axis=1)[:, None], axis=1))[:, 0]


def raiss(z: np.ndarray, seen: np.ndarray, ld: np.ndarray, ridge: float = 0.01, rtol: float = 0.01) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(z, r2, ld_score) of the unseen SNPs: conditional means given the seen ones under a ridged pseudo-inverse."""
    known, cross = ld[np.ix_(seen, seen)], ld[np.ix_(~seen, seen)]
    inverse = np.linalg.pinv(known + ridge * np.eye(len(known)), rcond=rtol, hermitian=True)
    mean = cross @ inverse @ z[seen]
    var = 1 + ridge - np.einsum("ij,jk,ik->i", cross, inverse, cross)
    r2 = 1 - var
    return mean / np.sqrt(np.clip(r2, 1e-12, None)), r2, (cross**2).sum(1)


def projected(x: np.ndarray, missing: np.ndarray, basis: np.ndarray, rounds: int = 30) -> np.ndarray:
    """Missing entries of all rows by repeated projection on a basis, from the row's mean on."""
    seen = (~missing).sum(1, keepdims=True)
    out = np.where(missing, np.where(missing, 0.0, x).sum(1, keepdims=True) / np.maximum(seen, 1), x)
    for _ in range(rounds):
        out = np.where(missing, out @ basis @ basis.T, out)
    return out


def conditional_spread(index: np.ndarray, effect: np.ndarray, ld: np.ndarray, sd: np.ndarray) -> np.ndarray:
    """Marginal effects at all SNPs from effects at the index SNPs, through LD and allele deviations."""
    return (ld[:, index] * sd[index] / sd[:, None]) @ effect


def conditional_effects(index: np.ndarray, beta: np.ndarray, ld: np.ndarray, sd: np.ndarray) -> np.ndarray:
    """Effects of the index SNPs given each other, from their marginal ones; one alone keeps its own."""
    own = beta[index]
    return own if len(index) == 1 else sd[index] * (np.linalg.pinv(ld[np.ix_(index, index)], hermitian=True) @ (own / sd[index]))


def clean(ratio: np.ndarray, width: float = 3.0) -> np.ndarray:
    """What lies within ``width`` standard deviations of the median, twice: the second deviation is that of what passed the first; nan doesn't."""
    fine = np.isfinite(ratio)
    middle = np.median(ratio[fine]) if fine.any() else np.nan
    for _ in range(2):
        spread = ratio[fine].std(ddof=1) if fine.sum() > 1 else np.nan
        fine = fine & (np.abs(ratio - middle) <= width * spread)
    return fine


def rescaled(truth: np.ndarray, predicted: np.ndarray) -> tuple[np.ndarray, float]:
    """(predictions on the scale of the truth, their correlation with it): a straight line through the clean ratios; nan where there are fewer than three."""
    with np.errstate(divide="ignore", invalid="ignore"):
        fine = clean(truth / predicted)
    if fine.sum() < 3 or np.ptp(predicted[fine]) == 0:
        return np.full(len(truth), np.nan), np.nan
    slope, intercept = np.polyfit(predicted[fine], truth[fine], 1)
    out = predicted * slope + intercept
    return out, float(np.corrcoef(out[fine], truth[fine])[0, 1])


def filled_by_index(beta: np.ndarray, se: np.ndarray, eaf: np.ndarray, ld: np.ndarray, index: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, float, float]:
    """(beta, se, imputed, correlation of effects, of errors): missing ones (nan) from the index SNPs' conditional effects.

    Effects are spread over LD and rescaled to the known ones, errors follow
    from allele frequency and are rescaled alike.  A study with nothing missing,
    without index SNPs or with too few clean values comes back as it is.
    """
    missing, sd = np.isnan(beta), np.sqrt(2 * eaf * (1 - eaf))
    if not missing.any() or not len(index):
        return beta, se, np.zeros(len(beta), bool), np.nan, np.nan
    effects, fit = rescaled(beta, conditional_spread(index, conditional_effects(index, beta, ld, sd), ld, sd))
    errors, fit_se = rescaled(se, 1 / sd)
    if np.isnan(effects).any() or np.isnan(errors).any():
        return beta, se, np.zeros(len(beta), bool), fit, fit_se
    return np.where(missing, effects, beta), np.where(missing, errors, se), missing, fit, fit_se


def clump(z: np.ndarray, ld: np.ndarray, r2: float = 0.1, least: float = 0.0, pos: np.ndarray | None = None, width: float = 1_000_000) -> np.ndarray:
    """Indices of lead SNPs: the strongest, then the strongest not yet covered by LD (and distance), until below ``least``."""
    left, leads = np.abs(z).astype(float), []
    while len(left):
        i = int(np.argmax(left))
        if not left[i] > least:
            break
        leads.append(i)
        covered = ld[i] ** 2 > r2
        if pos is not None:
            covered &= np.abs(pos - pos[i]) <= width
        left[covered] = -1.0
        left[i] = -1.0
    return np.array(leads, int)


def dentist(z: np.ndarray, ld: np.ndarray, cut: float = 5.45, share: float = 0.4, rounds: int = 10, worst: float = 0.005, seed: int = 5, known: dict | None = None) -> np.ndarray:
    """Flag of SNPs whose z disagrees with its prediction from LD.

    In each round the SNPs left are dealt to two halves, each half is predicted
    from the other (leading eigenvectors, ``share`` of the half's size, one
    factorisation a half), and what lies beyond the cut is removed, the worst
    first and at most a ``worst`` part (one at least) in a round but the last.
    ``known`` keeps what studies of one matrix share: the halves of their first round.
    """
    rng, bad = np.random.default_rng(seed), np.zeros(len(z), bool)
    known = {} if known is None else known
    for k in range(rounds):
        left = np.flatnonzero(~bad)
        if len(left) < 4:
            break
        dealt = rng.permutation(left)
        halves, stat = (np.sort(dealt[::2]), np.sort(dealt[1::2])), np.zeros(len(z))
        for own, other in (halves, halves[::-1]):
            key = own.tobytes()
            if key in known:
                w, back, r2 = known[key]
            else:
                values, vectors = np.linalg.eigh(ld[np.ix_(other, other)])
                use = slice(max(len(other) - max(int(share * len(other)), 1), 0), None)
                use = np.arange(len(other))[use][values[use] > 1e-4]
                across = ld[np.ix_(own, other)] @ vectors[:, use]
                w, back = across / values[use], vectors[:, use].T
                r2 = np.einsum("ij,ij->i", w, across)
                if k == 0:
                    known[key] = w, back, r2
            stat[own] = np.abs(z[own] - w @ (back @ z[other])) / np.sqrt(np.maximum(1 - r2, 0.05))
        beyond = left[stat[left] > cut]
        if not len(beyond):
            break
        most = len(beyond) if k == rounds - 1 else max(int(worst * len(left)), 1)
        bad[beyond[np.argsort(-stat[beyond], kind="stable")][:most]] = True
    return bad


def principal(x: np.ndarray, k: int = 2) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(scores, loadings, share of variance) of scaled columns; constant columns are left out (zero loadings)."""
    sd = x.std(0, ddof=1)
    use = sd > 0
    u, s, vt = np.linalg.svd((x[:, use] - x[:, use].mean(0)) / sd[use], full_matrices=False)
    sign = np.where(vt[np.arange(len(s)), np.abs(vt).argmax(1)] < 0, -1, 1)
    loadings = np.zeros((x.shape[1], min(k, len(s))))
    loadings[use] = (vt * sign[:, None])[:k].T
    return (u * s * sign)[:, :k], loadings, (s**2 / (s**2).sum())[:k]


#: Bytes of the rows of distances that a clustering holds, and of those that it makes at a time.
HELD_BYTES, PIECE_BYTES = 64 << 20, 8 << 20


class _Groups:
    """Groups of rows and mean distances between them: those of some groups to all others are held, the rest made again when asked for."""

    def __init__(self, x: np.ndarray, held: int):
        n = len(x)
        self.x, self.square = x, (x * x).sum(1)
        self.size, self.there, self.of = np.ones(n, int), np.ones(n, bool), np.arange(n)
        self.rows = {i: [i] for i in range(n)}
        self.means = np.zeros((min(n, max(8, held // (8 * n))), n))
        self.slot: dict[int, int] = {}
        self.owner, self.used, self.clock = np.full(len(self.means), -1), np.zeros(len(self.means), np.int64), 0

    def to_all(self, c: int) -> np.ndarray:
        """Mean distances of a group to all others; infinite for itself and what is no more."""
        self.clock += 1
        if c not in self.slot:
            # the smallest group goes, and of these the one that was not asked for longest: it is made again soonest
            k = int(np.argmin(np.where(self.owner < 0, -1, (self.size[self.owner] << 36) + self.used)))
            if self.owner[k] >= 0:
                del self.slot[int(self.owner[k])]
            self.means[k] = self._made(c)
            self.slot[c], self.owner[k] = k, c
        k = self.slot[c]
        self.used[k] = self.clock
        return self.means[k]

    def _made(self, c: int) -> np.ndarray:
        rows, n = np.array(self.rows[c]), len(self.x)
        total, step = np.zeros(n), max(1, PIECE_BYTES // (8 * n))
        for lo in range(0, len(rows), step):
            at = rows[lo : lo + step]
            both = self.square[at, None] + self.square
            d = both - 2 * (self.x[at] @ self.x.T)
            d[d <= 1e-13 * both] = 0  # less than the products' rounding: equal rows
            total += np.sqrt(d, out=d).sum(0)
        total = np.bincount(self.of, total, n) / (self.size * len(rows))
        total[~self.there] = total[c] = np.inf
        return total

    def join(self, a: int, b: int) -> None:
        """``b`` becomes part of ``a``."""
        x, y = self.size[a], self.size[b]
        i, j = self.slot.get(a), self.slot.pop(b, None)
        self.means[:, a] = (x * self.means[:, a] + y * self.means[:, b]) / (x + y)
        self.means[:, b] = np.inf
        if i is not None and j is not None:
            self.means[i] = (x * self.means[i] + y * self.means[j]) / (x + y)
            self.means[i, a] = np.inf
        elif i is not None:
            del self.slot[a]
            self.owner[i] = -1
        if j is not None:
            self.owner[j] = -1
        self.of[self.rows[b]] = a
        self.rows[a] += self.rows.pop(b)
        self.size[a] += y
        self.there[b] = False


def linkage(x: np.ndarray, held: int = HELD_BYTES) -> list[tuple[int, int, float, int]]:
    """Average-linkage merges of rows by rising height: (a, b, height, size), groups named by their least row, a < b.

    Chains of nearest neighbours: a chain is followed until two groups are each
    other's nearest, which may be joined at once, since joining them brings no
    other group nearer to any.  Memory is that of the rows and of ``held``
    bytes; distances that are not held are made again from the rows.
    """
    n = len(x)
    groups, chain, came, on, height, merges = _Groups(x, held), [], [], np.zeros(n, bool), np.zeros(n), []
    while len(merges) < n - 1:
        if not chain:
            chain, came = [int(np.argmax(groups.there))], [np.inf]
            on[chain[0]] = True
        while True:
            row = groups.to_all(chain[-1])
            near = int(np.argmin(row))
            # a distance that is made from either end may differ in its last digits: no chain may turn back on itself
            if len(chain) > 1 and (row[chain[-2]] <= row[near] or row[near] >= came[-1] or on[near]):
                break
            chain.append(near)
            came.append(row[near])
            on[near] = True
        h = row[chain[-2]]
        a, b = sorted((chain.pop(), chain.pop()))
        del came[-2:]
        on[a] = on[b] = False
        height[a] = max(h, height[a], height[b])
        groups.join(a, b)
        merges.append((a, b, float(height[a]), int(groups.size[a])))
    return sorted(merges, key=lambda m: m[2])


def leaf_order(merges: list[tuple[int, int, float, int]], n: int) -> list[int]:
    """Rows in the order of the tree's leaves: of two groups the one with the least row first."""
    groups = {i: [i] for i in range(n)}
    for a, b, _, _ in merges:
        groups[a] += groups.pop(b)
    return [i for a in sorted(groups) for i in groups[a]]


def multivariable(bx: np.ndarray, by: np.ndarray, se: np.ndarray, se_x: np.ndarray | None = None, correlation: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(effects, standard errors, conditional F) of exposures on an outcome, weighted by the outcome's variance.

    Conditional F: each exposure's effects less what the other exposures
    predict of them, squared over the variance of that difference (from the
    exposures' standard errors ``se_x`` and their ``correlation``, none if not
    given), summed and divided by SNPs - exposures + 1.
    """
    k = bx.shape[1]
    w = 1 / se**2
    inv = np.linalg.pinv((bx * w[:, None]).T @ bx)
    se_x = np.ones_like(bx) if se_x is None else se_x
    correlation = np.eye(k) if correlation is None else correlation
    f = np.empty(k)
    for j in range(k):
        rest = [i for i in range(k) if i != j]
        delta = np.zeros(k)
        delta[j] = 1.0
        if rest:
            delta[rest] = -np.linalg.lstsq(bx[:, rest], bx[:, j], rcond=None)[0]
        spread = se_x * delta
        f[j] = ((bx @ delta) ** 2 / np.einsum("ij,jk,ik->i", spread, correlation, spread)).sum() / max(len(by) - k + 1, 1)
    return inv @ (bx * w[:, None]).T @ by, np.sqrt(np.diag(inv)), f


def poisson_fit(x: np.ndarray, y: np.ndarray, rounds: int = 50) -> np.ndarray:
    """Coefficients (intercept first) of a Poisson regression by reweighted least squares."""
    x = np.column_stack([np.ones(len(y)), x])
    b = np.concatenate([[np.log(max(y.mean(), 1e-9))], np.zeros(x.shape[1] - 1)])
    for _ in range(rounds):
        mu = np.exp(np.clip(x @ b, -30, 30))
        step = np.linalg.lstsq((x * mu[:, None]).T @ x, x.T @ (y - mu), rcond=None)[0]
        b = b + step
        if np.abs(step).max() < 1e-10:
            break
    return b


def imputed_studies(z: np.ndarray, se: np.ndarray, eaf: np.ndarray, seen: np.ndarray, upto: np.ndarray, vectors: np.ndarray, least: int = 10) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(z, se, imputed) of the studies (rows) of one block: z from LD eigenvectors, errors from allele frequency.

    Studies with too little seen, or with nothing to impute, stay as they are.
    """
    z, se, take = z.copy(), se.copy(), (seen.sum(1) >= least) & ~seen.all(1)
    if take.any():
        own, there = np.where(seen, z, 0.0)[take], seen[take]
        fitted = eigen_imputed(own, there, upto, vectors)
        spread = lambda v: np.array([np.std(r[s]) for r, s in zip(v, there, strict=True)])
        scale = spread(own) / np.maximum(spread(fitted), 1e-9)
        basis = 1 / np.sqrt(2 * eaf[take] * (1 - eaf[take]))
        slope = np.where(there, basis * se[take], 0.0).sum(1) / np.where(there, basis * basis, 0.0).sum(1)
        z[take] = np.where(there, own, fitted * scale[:, None])
        se[take] = np.where(there, se[take], slope[:, None] * basis)
    return z, se, ~seen & take[:, None]
