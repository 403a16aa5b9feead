"""Queries of the statistical kernels.

Kernels with linear algebra have no SQL form; their tests compare the queries
with direct numpy solutions.  Here they run over made-up blocks: a label is a
block, a vector is a study in it, the vector's positions are its SNPs, and the
LD rows of a block fall off with distance, at a pace of its own.
"""

from __future__ import annotations

from math import erfc, sqrt

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F

from .. import scratch
from ..fixtures import Fixtures
from ..functions import scalar as S
from ..operators import finemap as FM
from ..operators import kernels as K
from ..operators import windows as W
from ..sources import ld_store
from .registry import query

N = 10_000.0


def _r(c, n: int = 6, name: str | None = None):
    return F.round(c, n).alias(name or c)


def _vectors(x: Fixtures):
    """(study, blk, snp, z, eaf, se, beta, seen): signals from the embeddings."""
    z = F.col("lbf") / 6
    t = x.lbf.select("study", "blk", "snp", z.alias("z"), (0.05 + F.col("snp") % 40 / 100.0).alias("eaf"))
    t = t.withColumn("se", 1 / F.sqrt(2 * F.col("eaf") * (1 - F.col("eaf")) * N)).withColumn("beta", F.col("z") * F.col("se"))
    return t.withColumn("seen", (F.col("study") + F.col("snp")) % 5 != 0)


def _kernel(f, columns: str):
    """A group kernel over one study, ordered by SNP, that needs no LD; ``f`` maps the frame to a dict of columns."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("snp")
        return pd.DataFrame({"study": pdf["study"].iloc[0], **f(pdf)})

    return lambda df: K.by_group(df, ["study"], run, "study long, " + columns)


#: Stores of this session, by application and tables.
_stores: dict[tuple[str, str], str] = {}


def _store(x: Fixtures) -> str:
    """The stored LD of the tables: packed and factored once a session, read by all kernels."""
    key = (x.spark.sparkContext.applicationId, x.dir)
    if key not in _stores or not scratch.exists(x.spark, _stores[key]):
        path = scratch.fresh(x.spark, "ld")
        ld_store.write(x.ld, path)
        _stores[key] = path
    return _stores[key]


def _with_ld(x: Fixtures, kernel, columns: str):
    """``kernel(rows, matrix)`` of every study with the stored matrix of its block."""

    def run(frames: list[pd.DataFrame], held: ld_store.Block) -> list:
        at = [held.places(one["snp"].to_numpy()) for one in frames]
        return [kernel(one, held.r[np.ix_(a, a)]) for one, a in zip(frames, at, strict=True)]

    return ld_store.by_block(_vectors(x), _store(x), run, columns).drop("ld_known")


def _with_factors(x: Fixtures, kernel, columns: str, share: float, unknown=None):
    """``kernel(arrays, block)`` of all studies of a group at once, with the leading eigenvectors of their block.

    ``arrays``: z, se, eaf and seen of each study (rows) at each SNP of the
    block; SNPs that a study doesn't have are not seen.  The kernel gives
    arrays of the same shape by name.
    """
    names = [c.split()[0] for c in columns.split(", ")]

    def run(frames: list[pd.DataFrame], held: ld_store.Block) -> list:
        at = [held.places(one["snp"].to_numpy()) for one in frames]
        arrays = {c: np.full((len(frames), len(held.snps)), fill) for c, fill in (("z", 0.0), ("se", 1.0), ("eaf", 0.5), ("seen", False))}
        for i, (one, a) in enumerate(zip(frames, at, strict=True)):
            for c in arrays:
                arrays[c][i, a] = one[c]
        got = kernel(arrays, held)
        return [{"snp": one["snp"], **{c: got[c][i, a] for c in names[1:]}} for i, (one, a) in enumerate(zip(frames, at, strict=True))]

    return ld_store.by_block(_vectors(x), _store(x), run, columns, matrix=False, share=share, unknown=unknown)


@query("SELECT study, round(sqrt(sum(x * y) / sum(x * x)), 6) AS sd FROM (SELECT study, 2 * 10000.0 * eaf * (1 - eaf) AS y, 1 / (se * se) AS x FROM snps) GROUP BY study HAVING sum(x * y) / sum(x * x) >= 0", "snps")
def k1_trait_sd(x: Fixtures):
    return K.trait_sd(x.snps, ["study"], F.lit(N)).where("sd IS NOT NULL").select("study", _r("sd"))


@query("SELECT s.study, chr, bp, round(bn / slope, 6) AS beta_new, round(sn / slope, 6) AS se_new FROM (SELECT *, 1 / sqrt(2 * eaf * (1 - eaf) * 10000.0) AS sn, beta / se / sqrt(2 * eaf * (1 - eaf) * 10000.0) AS bn FROM snps) s JOIN (SELECT study, regr_slope(beta / se / sqrt(2 * eaf * (1 - eaf) * 10000.0), beta) AS slope FROM snps GROUP BY study) m ON s.study = m.study", "snps")
def k2_effects_from_z(x: Fixtures):
    out = K.effects_from_z(x.snps.withColumn("z", F.col("beta") / F.col("se")), ["study"], F.lit(N))
    return out.select("study", "chr", "bp", _r("beta_new"), _r("se_new"))


@query("SELECT o_orderkey, NOT coalesce(abs(v - m) <= 3 * s1 AND abs(v - m) <= 3 * s2, FALSE) AS outlier FROM (SELECT o_orderkey, o_orderstatus AS g, o_totalprice * o_totalprice * o_totalprice AS v FROM orders) JOIN (SELECT o_orderstatus AS g, median(o_totalprice * o_totalprice * o_totalprice) AS m, stddev_samp(o_totalprice * o_totalprice * o_totalprice) AS s1 FROM orders GROUP BY 1) USING (g) JOIN (SELECT g, stddev_samp(v) AS s2 FROM (SELECT o_orderstatus AS g, o_totalprice * o_totalprice * o_totalprice AS v FROM orders) JOIN (SELECT o_orderstatus AS g, median(o_totalprice * o_totalprice * o_totalprice) AS m, stddev_samp(o_totalprice * o_totalprice * o_totalprice) AS s1 FROM orders GROUP BY 1) USING (g) WHERE abs(v - m) <= 3 * s1 GROUP BY g) USING (g)")
def k3_outliers(x: Fixtures):
    p = F.col("o_totalprice")
    return K.outliers(x.table("orders").withColumn("v", p * p * p), ["o_orderstatus"], "v").select("o_orderkey", "outlier")


@query("SELECT s.study, chr, bp, round(b * se, 6) AS adjusted FROM snps s JOIN (SELECT study, sum(se * beta) / sum(se * se) AS b FROM snps GROUP BY study) USING (study)", "snps")
def k4_first_degree_adjustment(x: Fixtures):
    return K.origin_slope(x.snps, ["study"], "beta", "se").select("study", "chr", "bp", _r("adjusted"))


@query()
def k4_polynomial_adjustment(x: Fixtures):
    f = lambda p: {"snp": p["snp"], "adjusted": K.polynomial(p["eaf"].to_numpy(), p["se"].to_numpy(), p["seen"].to_numpy())}
    return _kernel(f, "snp long, adjusted double")(_vectors(x))


@query("SELECT s.study, chr, bp, round(pow(beta - a - b * se, 2) / (2 * mse) * h / pow(1 - h, 2), 6) AS cook FROM (SELECT s.*, a, b, mse, 1 / n + pow(se - mx, 2) / sxx AS h FROM snps s JOIN (SELECT study, CAST(count(*) AS DOUBLE) AS n, avg(se) AS mx, regr_slope(beta, se) AS b, regr_intercept(beta, se) AS a, regr_sxx(beta, se) AS sxx, (regr_syy(beta, se) - regr_slope(beta, se) * regr_sxy(beta, se)) / (count(*) - 2) AS mse FROM snps GROUP BY study) USING (study)) s", "snps")
def k5_cooks_distance(x: Fixtures):
    return K.cooks(x.snps, ["study"], "beta", "se").select("study", "chr", "bp", _r("cook"))


@query()
def k6_eigen_imputation(x: Fixtures):
    f = lambda v, held: {"z": K.eigen_imputed(v["z"], v["seen"], held.upto, held.vectors)}
    return _with_factors(x, f, "snp long, z double", 0.9, unknown=lambda p: {"snp": p["snp"], "z": p["z"].where(p["seen"])})


@query()
def k7_elastic_net_imputation(x: Fixtures):
    """Studies of a block that saw the same SNPs are fitted together."""

    def run(frames: list[pd.DataFrame], held: ld_store.Block) -> list:
        at, alike, out = [held.places(one["snp"].to_numpy()) for one in frames], {}, [None] * len(frames)
        for i, one in enumerate(frames):
            alike.setdefault((at[i].tobytes(), one["seen"].to_numpy().tobytes()), []).append(i)
        for group in alike.values():
            a, seen = at[group[0]], frames[group[0]]["seen"].to_numpy()
            ld = held.r[np.ix_(a, a)]
            fits = K.elastic_nets_cv(ld[seen], np.array([frames[i]["z"].to_numpy()[seen] for i in group]))
            for i, b in zip(group, fits, strict=True):
                out[i] = {"snp": frames[i]["snp"], "z": b[0] + ld @ b[1:]}
        return out

    return ld_store.by_block(_vectors(x), _store(x), run, "snp long, z double", copies=256).drop("ld_known")


@query()
def k8_dense_imputation(x: Fixtures):
    """Effects of all SNPs; studies whose block has no LD come back as they are (ld_known false)."""

    def f(v, held):
        z, se, imputed = K.imputed_studies(v["z"], v["se"], v["eaf"], v["seen"], held.upto, held.vectors)
        return {"z": z, "se": se, "beta": z * se, "p": np.vectorize(erfc)(np.abs(z) / sqrt(2)), "imputed": imputed}

    def unknown(p):
        return p[["snp", "z", "se", "beta"]].assign(p=[erfc(abs(v) / sqrt(2)) for v in p["z"]], imputed=False)

    return _with_factors(x, f, "snp long, z double, se double, beta double, p double, imputed boolean", 0.9, unknown)


@query("SELECT study, chr, bp, chr % 3 = 0 AS imputed, CASE WHEN chr % 3 = 0 THEN 0 ELSE beta END AS beta, CASE WHEN chr % 3 = 0 THEN 1 ELSE se END AS se FROM snps", "snps")
def k9_sparse_padding(x: Fixtures):
    gone = F.col("chr") % 3 == 0
    t = x.snps.withColumns({c: F.when(~gone, F.col(c)) for c in ("beta", "se")}).withColumn("p", F.lit(None).cast("double")).withColumn("z", F.lit(None).cast("double"))
    return K.padded(t).select("study", "chr", "bp", "imputed", "beta", "se")




@query("SELECT study, snp FROM (SELECT study, snp, exp(-abs(lbf) / 10) AS p, (study + snp) % 5 = 0 AS imputed FROM lbf) v LEFT JOIN (SELECT study, CASE WHEN s THEN snp - 1 ELSE snp + 1 END AS snp, min(p) AS best FROM (SELECT study, snp, exp(-abs(lbf) / 10) AS p, (study + snp) % 5 = 0 AS imputed FROM lbf) CROSS JOIN (SELECT unnest([TRUE, FALSE]) AS s) WHERE NOT imputed AND snp % 7 <> 0 AND (CASE WHEN s THEN snp - 1 ELSE snp + 1 END) % 7 <> 0 GROUP BY 1, 2) USING (study, snp) LEFT JOIN (SELECT study, min(exp(-abs(lbf) / 10)) AS floor FROM lbf WHERE (study + snp) % 5 <> 0 GROUP BY 1) USING (study) WHERE NOT (imputed AND coalesce(CASE WHEN best IS NOT NULL THEN p * 1.5 < best ELSE p < floor END, FALSE))", "lbf")
def k10_inflated_imputations(x: Fixtures):
    v = x.lbf.select("study", "snp", F.exp(-F.abs("lbf") / 10).alias("p"), ((F.col("study") + F.col("snp")) % 5 == 0).alias("imputed"))
    s = x.spark.range(64).select(F.col("id").alias("lead"))
    ld = s.withColumn("proxy", F.explode(F.array(F.col("lead") - 1, F.col("lead") + 1))).where("proxy BETWEEN 0 AND 63 AND lead % 7 <> 0 AND proxy % 7 <> 0").withColumn("r", F.lit(0.9))
    return K.without_inflated(v, ld, ["study"], factor=1.5).select("study", "snp")


@query()
def k11_conditional_imputation(x: Fixtures):
    def f(p, ld):
        seen = p["seen"].to_numpy()
        z, r2, score = K.raiss(p["z"].to_numpy(), seen, ld)
        return {"snp": p["snp"].to_numpy()[~seen], "z": z, "r2": r2, "ld_score": score}

    return _with_ld(x, f, "snp long, z double, r2 double, ld_score double")


def _to_map(x: Fixtures):
    """Studies to fine-map: signals three times as strong; every seventh is sparse, every eleventh has few SNPs."""
    t = _vectors(x).withColumn("z", F.col("z") * 3).withColumn("p", F.round(S.two_sided_p("z"), 12))
    t = t.withColumns({"bp": F.col("snp") * 50_000, "n": F.lit(N), "sparse": F.col("study") % 7 == 0})
    return t.where((F.col("study") % 11 != 0) | (F.col("snp") < 40))


def _fine_mapped(x: Fixtures) -> tuple:
    """(rows, start): the stored fine-mapped rows of all studies, and where each study started."""
    path = scratch.fresh(x.spark, "finemapped")
    FM.fine_mapped(_to_map(x), _store(x), discard=30, smallest=50).write.parquet(path)
    start = x.table("embeddings").select(F.col("label").cast("long").alias("blk"), F.col("vec_id").cast("long").alias("study"), F.lit(1_600_000).alias("start_bp"), F.lit("cis").alias("cis_trans"))
    return x.spark.read.parquet(path), start


@query()
def k12_fine_mapping(x: Fixtures):
    """Fine-mapped rows: one for each SNP of each credible set, with the branches for studies without two sets."""
    return _fine_mapped(x)[0]


@query()
def k13_fine_mapped_leads(x: Fixtures):
    """The catalog: a lead for each credible set of the fine-mapped studies, quarantined SNPs left out."""
    return FM.split(*_fine_mapped(x))[1]


@query()
def k13_sets_colocalised(x: Fixtures):
    """Fine-mapping, split and colocalisation in one plan: all pairs of credible sets of different studies of a block."""
    rows, leads, _ = FM.split(*_fine_mapped(x))
    found = rows.join(leads.select("blk", "ident"), ["blk", "ident"], "left_semi")
    return K.coloc_within(found, ["blk"], study="ident", owner="study", digits=6).select("a", "b", "nsnps", *[f"h{i}" for i in range(5)], "ignored")


#: Rows as a fine-mapping leaves them: every vector is a set of a study, whose number is the vector's modulo 40.
_SETS = f"SELECT *, CASE WHEN success THEN {S.erfc_sql('sqrt(greatest((2 * lbf0 - ln(sqrt(1 - 50 / (50 + se * se)))) / (50 / (50 + se * se)), 0)) / sqrt(2.0::DOUBLE)')} END AS lbf_p, CASE WHEN success THEN lbf0 ELSE (ln(1 - 0.04::DOUBLE / (0.04::DOUBLE + se * se)) + 0.04::DOUBLE / (0.04::DOUBLE + se * se) * z * z) / 2 END AS lbf FROM (SELECT *, concat(study, '_', blk, '_', set) AS ident FROM (SELECT blk, study % 40 AS study, CAST(study // 40 + 1 AS INTEGER) AS set, snp, snp * 50000 AS bp, lbf / 6 AS z, 0.01::DOUBLE + snp % 5 / 50.0::DOUBLE AS se, exp(-abs(lbf) / 3) AS p, lbf AS lbf0, lbf > 4 AS in_set, study % 40 % 3 <> 0 AS success FROM lbf))"
_BAD = "coalesce(success AND lbf_p < 0.00015 AND p > 0.001, FALSE)"


def _sets(x: Fixtures) -> tuple:
    """(rows, start) for split, as _SETS has them."""
    study = F.col("study") % 40
    message = F.when(study % 3 != 0, "success").when(study % 2 == 0, "less_than_2_cs").otherwise("sparse_population")
    rows = x.lbf.select("blk", study.alias("study"), (F.floor(F.col("study") / 40) + 1).cast("int").alias("set"), "snp", (F.col("snp") * 50_000).alias("bp"), (F.col("lbf") / 6).alias("z"), (0.01 + F.col("snp") % 5 / 50.0).alias("se"), F.lit(0.3).alias("eaf"), F.exp(-F.abs("lbf") / 3).alias("p"), "lbf", (F.col("lbf") > 4).alias("in_set"), message.alias("message"), F.when(message == "less_than_2_cs", F.lit(7)).cast("long").alias("lead"))
    return rows, rows.select("blk", "study").distinct().select("blk", "study", (F.col("study") * 80_000).alias("start_bp"), F.lit("cis").alias("cis_trans"))


_FIRST = "{'a': CASE WHEN NOT success AND study % 2 = 0 AND snp = 7 THEN 0 ELSE 1 END, 'b': CASE WHEN success THEN lbf_p ELSE p END, 'c': snp}"


@query(f"SELECT ident, study, set, snp, round(min_p, 9) AS min_p, round(lbf, 6) AS lbf, n_in_set, CASE WHEN bool_or(far) OVER (PARTITION BY blk, study) THEN 'trans' ELSE 'cis' END AS cis_trans FROM (SELECT ident, blk, study, set, arg_min(snp, {_FIRST}) AS snp, min(CASE WHEN success THEN lbf_p ELSE p END) AS min_p, arg_min(lbf, {_FIRST}) AS lbf, CAST(count(*) FILTER (in_set) AS BIGINT) AS n_in_set, bool_and(success) AND abs(arg_min(bp, {_FIRST}) - study * 80000) >= 1000000 AS far FROM ({_SETS}) WHERE NOT {_BAD} GROUP BY ident, blk, study, set)", "lbf")
def k13_split_leads(x: Fixtures):
    """Leads of credible sets: least p by Bayes factor, the set's size, cis or trans by where the leads of all sets lie."""
    leads = FM.split(*_sets(x))[1]
    return leads.select("ident", "study", "set", "snp", _r("min_p", 9), _r("lbf"), "n_in_set", "cis_trans")


@query(f"SELECT {_BAD} AS bad, ident, snp, round(lbf, 6) AS lbf, round(lbf_p, 9) AS lbf_p FROM ({_SETS})", "lbf")
def k13_split_rows(x: Fixtures):
    """Rows of the sets, and those quarantined because their Bayes factor is inflated against their own p."""
    rows, _, bad = FM.split(*_sets(x))
    part = lambda t, flag: t.select(F.lit(flag).alias("bad"), "ident", "snp", _r("lbf"), _r("lbf_p", 9))
    return part(rows, False).union(part(bad, True))


@query("SELECT study, arg_max(snp, {'a': lbf, 'b': -snp}) AS lead, round(max(lbf), 5) AS lbf, CASE WHEN abs(arg_max(snp, {'a': lbf, 'b': -snp}) - 32) <= 10 THEN 'cis' ELSE 'trans' END AS cis_trans FROM lbf WHERE NOT (lbf > 8 AND snp % 4 = 0) GROUP BY study", "lbf")
def k13_credible_set_lead(x: Fixtures):
    good = x.lbf.where(~((F.col("lbf") > 8) & (F.col("snp") % 4 == 0)))
    lead = good.groupBy("study").agg(F.max_by("snp", F.struct("lbf", -F.col("snp"))).alias("lead"), F.max("lbf").alias("lbf"))
    return lead.select("study", "lead", _r("lbf", 5), F.when(F.abs(F.col("lead") - 32) <= 10, "cis").otherwise("trans").alias("cis_trans"))


@query("SELECT study, arg_min(bp, {'a': -abs(z), 'b': chr, 'c': bp}) AS lead_bp, round(arg_min((ln(1 - r) + r * z * z) / 2, {'a': -abs(z), 'b': chr, 'c': bp}), 6) AS lbf FROM (SELECT *, beta / se AS z, 0.04 / (0.04 + se * se) AS r FROM snps) GROUP BY study", "snps")
def k14_unmapped_record(x: Fixtures):
    from ..functions.scalar import bayes_factor

    z = F.col("beta") / F.col("se")
    t = x.snps.withColumn("z", z).withColumn("lbf", bayes_factor(z, "se", F.lit(0.2)))
    best = F.struct(-F.abs("z"), "chr", "bp")
    return t.groupBy("study").agg(F.min_by("bp", best).alias("lead_bp"), F.round(F.min_by("lbf", best), 6).alias("lbf"))


@query()
def k15_quality_control(x: Fixtures):
    return _with_ld(x, lambda p, ld: {"snp": p["snp"], "bad": K.dentist(p["z"].to_numpy(), ld)}, "snp long, bad boolean")


@query()
def k16_clumping(x: Fixtures):
    f = lambda p, ld: {"lead": p["snp"].to_numpy()[K.clump(p["z"].to_numpy(), ld, 0.1, 0.5, p["snp"].to_numpy() * 100_000.0)]}
    return _with_ld(x, f, "lead long")


@query()
def k17_greedy_clumping(x: Fixtures):
    return _with_ld(x, lambda p, ld: {"lead": p["snp"].to_numpy()[K.clump(p["z"].to_numpy(), ld, 0.3, 0.5)]}, "lead long")


_COLOC = "SELECT a, b, nsnps, {cols}, nsnps < {least} AS ignored FROM (SELECT *, greatest(0.0, l1 + ln(1e-4), l2 + ln(1e-4), l3 + ln(1e-8), l12 + ln(1e-5)) AS m FROM (SELECT a, b, nsnps, l1, l2, l12, CASE WHEN l12 < l1 + l2 THEN l1 + l2 + ln(1 - exp(l12 - l1 - l2)) ELSE CAST('-inf' AS DOUBLE) END AS l3 FROM (SELECT a, b, CAST(count(*) AS BIGINT) AS nsnps, max(ma) + ln(sum(exp(la - ma))) AS l1, max(mb) + ln(sum(exp(lb - mb))) AS l2, max(mab) + ln(sum(exp(la + lb - mab))) AS l12 FROM (SELECT p.a, p.b, x.lbf AS la, y.lbf AS lb, max(x.lbf) OVER w AS ma, max(y.lbf) OVER w AS mb, max(x.lbf + y.lbf) OVER w AS mab FROM ({pairs}) p JOIN lbf x ON x.study = p.a JOIN lbf y ON y.study = p.b AND x.snp = y.snp {where} WINDOW w AS (PARTITION BY p.a, p.b)) GROUP BY a, b)))"


def _posteriors() -> str:
    logs = ["0.0", "l1 + ln(1e-4)", "l2 + ln(1e-4)", "l3 + ln(1e-8)", "l12 + ln(1e-5)"]
    total = " + ".join(f"exp({v} - m)" for v in logs)
    return ", ".join(f"round(CASE WHEN nsnps >= 50 THEN exp({v} - m) / ({total}) END, 6) AS h{i}" for i, v in enumerate(logs))


_PAIRS = "SELECT a.study AS a, b.study AS b FROM (SELECT DISTINCT study, blk FROM lbf) a JOIN (SELECT DISTINCT study, blk FROM lbf) b ON a.blk = b.blk AND a.study < b.study"


@query(_COLOC.format(cols=_posteriors(), least=50, pairs=_PAIRS, where=""), "lbf")
def k18_colocalisation(x: Fixtures):
    return K.coloc_within(x.lbf, ["blk"], digits=6).select("a", "b", "nsnps", *[f"h{i}" for i in range(5)], "ignored")


def _masked_sql(cut: float) -> str:
    masked = f"(SELECT study, snp, CASE WHEN abs(lbf) >= {cut} THEN lbf ELSE 0 END AS lbf FROM lbf)"
    runs = _COLOC.format(cols=_posteriors(), least=50, pairs=_PAIRS, where="").replace("JOIN lbf x", f"JOIN {masked} x").replace("JOIN lbf y", f"JOIN {masked} y")
    return f"SELECT {cut}::DOUBLE AS cut, CAST(count(*) AS BIGINT) AS n, round(avg(h4), 5) AS mean_h4, CAST(count(*) FILTER (h4 >= 0.8) AS BIGINT) AS high FROM ({runs})"


@query(" UNION ALL ".join(map(_masked_sql, (0.0, 2.0, 5.0))), "lbf")
def k19_masked_colocalisation(x: Fixtures):
    """Means and counts are of rounded posteriors."""
    return K.coloc_masked(x.lbf, ["blk"], (0.0, 2.0, 5.0), digits=6, high=0.8).select("cut", "n", _r("mean_h4", 5), "high")


@query(f"SELECT study, round(slope, 6) AS slope, round(r2, 6) AS r2, n, round({S.f_test_p_sql('(r2 / (1 - r2) * (n - 2))', '1', '(n - 2)')}, 9) AS p FROM (SELECT study, regr_slope(beta, eaf) AS slope, regr_r2(beta, eaf) AS r2, CAST(count(*) AS BIGINT) AS n FROM snps GROUP BY study)", "snps")
def k20_regression(x: Fixtures):
    """Slope, share of variance and the p-value of the overall F-test."""
    t = x.snps.groupBy("study").agg(F.regr_slope("beta", "eaf").alias("slope"), F.regr_r2("beta", "eaf").alias("r2"), F.count("*").alias("n"))
    f = F.col("r2") / (1 - F.col("r2")) * (F.col("n") - 2)
    return t.select("study", _r("slope"), _r("r2"), "n", F.round(S.f_test_p(f, F.lit(1), F.col("n") - 2), 9).alias("p"))


@query("SELECT round(max(abs(n1 / t1 - n0 / t0)), 6) AS d FROM (SELECT sum(c1) OVER w AS n1, sum(c0) OVER w AS n0, sum(c1) OVER () AS t1, sum(c0) OVER () AS t0 FROM (SELECT eaf, count(*) FILTER (ea = 'R') AS c1, count(*) FILTER (ea <> 'R') AS c0 FROM sumstats GROUP BY eaf) WINDOW w AS (ORDER BY eaf))", "sumstats")
def k20_ks_distance(x: Fixtures):
    return K.ks_distance(x.sumstats.withColumn("side", F.col("ea") == "R"), "side", "eaf").select(_r("d"))


@query()
def k20_poisson(x: Fixtures):
    t = x.table("orders").groupBy(F.col("o_custkey").alias("study")).agg(F.count("*").alias("n"), F.avg("o_totalprice").alias("v")).select((F.col("study") % 8).alias("study"), F.col("study").alias("snp"), "n", "v")

    def f(p):
        b = K.poisson_fit(p[["v"]].to_numpy() / 1e5, p["n"].to_numpy(float))
        return {"intercept": [b[0]], "slope": [b[1]]}

    return _kernel(f, "intercept double, slope double")(t)


@query()
def k21_principal_components(x: Fixtures):
    def f(pdf: pd.DataFrame) -> pd.DataFrame:
        wide = pdf.pivot_table(index="study", columns="snp", values="lbf").sort_index()
        scores, _, share = K.principal(wide.to_numpy(), 2)
        return pd.DataFrame({"blk": pdf["blk"].iloc[0], "study": wide.index, "pc1": scores[:, 0], "pc2": scores[:, 1] if scores.shape[1] > 1 else 0.0, "share1": share[0]})

    return K.by_group(x.lbf, ["blk"], f, "blk long, study long, pc1 double, pc2 double, share1 double")


def _heatmap(x: Fixtures, side: str):
    """(blk, side, step, a, b, height, size, and the order of the leaves) of a block's shares: rows are studies, columns SNPs."""

    schema = "blk long, side string, step long, a long, b long, height double, size long, place long"

    def f(t: pa.Table) -> pa.Table:
        blk, t = t["blk"][0], t.select(["study", "shares"]).sort_by("study").combine_chunks()
        studies, lists = t["study"].to_numpy(), t["shares"].chunk(0)
        lengths, (snp, share) = np.diff(lists.offsets.to_numpy()), (c.to_numpy() for c in lists.flatten().flatten())
        snps, at = np.unique(snp, return_inverse=True)
        v = np.zeros((len(studies), len(snps)))
        v[np.repeat(np.arange(len(studies)), lengths), at] = share
        del t, lists, snp, share, at
        v -= v.mean(0)
        if len(v) > 1:
            sd = v.std(0, ddof=1)
            v /= np.where(sd > 0, sd, 1)
        v, names = (v, studies) if side == "row" else (v.T, snps)
        merges = K.linkage(v)
        place = np.empty(len(names), np.int64)
        place[K.leaf_order(merges, len(names))] = np.arange(len(names))
        a, b = (np.array([m[i] for m in merges], np.int64) for i in (0, 1))
        n = len(names) + len(merges)
        return pa.table({
            "blk": pa.repeat(blk, n), "side": pa.repeat(side, n), "step": np.r_[np.full(len(names), -1), np.arange(len(merges))],
            "a": np.r_[names, names[a]], "b": np.r_[names, names[b]], "height": np.r_[np.zeros(len(names)), [m[2] for m in merges]],
            "size": np.r_[np.ones(len(names), np.int64), np.array([m[3] for m in merges], np.int64)], "place": np.r_[place, place[a]],
        })

    total = x.lbf.groupBy("blk", "study").agg(F.sum(F.abs("lbf")).alias("t"))
    shares = x.lbf.join(total, ["blk", "study"]).select("blk", "study", "snp", (F.abs("lbf") / F.col("t")).alias("share"))
    shares = shares.where("share IS NOT NULL AND NOT isnan(share)").groupBy("blk", "study", "snp").agg(F.avg("share").alias("share"))
    # a study is one row of its block's group
    vectors = shares.groupBy("blk", "study").agg(F.sort_array(F.collect_list(F.struct("snp", "share"))).alias("shares"))
    return vectors.groupBy("blk").applyInArrow(f, schema)


@query()
def k22_row_order(x: Fixtures):
    """Average linkage of each block's studies: leaves (step -1) with their places, then the merges by rising height."""
    return _heatmap(x, "row")


@query()
def k22_column_order(x: Fixtures):
    """The same of the block's SNPs."""
    return _heatmap(x, "column")


_EXPOSURES = "SELECT study, z AS y, z * s AS a, e AS b, s AS sa, 0.05::DOUBLE AS sb FROM (SELECT study, lbf / 6 AS z, e, 1 / sqrt(2 * e * (1 - e) * 10000.0::DOUBLE) AS s FROM (SELECT study, lbf, 0.05::DOUBLE + snp % 40 / 100.0::DOUBLE AS e FROM lbf))"
_NORMAL = f"SELECT study, sum(a * a) AS aa, sum(b * b) AS bb, sum(a * b) AS ab, sum(a * y) AS ay, sum(b * y) AS by_, count(*) AS n FROM ({_EXPOSURES}) GROUP BY study"
_STRENGTH = f"SELECT study, sum(pow(a - ab / bb * b, 2) / (sa * sa + pow(ab / bb * sb, 2))) / (max(n) - 1) AS fa, sum(pow(b - ab / aa * a, 2) / (sb * sb + pow(ab / aa * sa, 2))) / (max(n) - 1) AS fb FROM ({_EXPOSURES}) JOIN ({_NORMAL}) USING (study) GROUP BY study"


@query(f"SELECT study, CAST(0 AS INTEGER) AS exposure, round((bb * ay - ab * by_) / (aa * bb - ab * ab), 6) AS effect, round(0.1 * sqrt(bb / (aa * bb - ab * ab)), 6) AS se, round(fa, 6) AS f FROM ({_NORMAL}) JOIN ({_STRENGTH}) USING (study) UNION ALL SELECT study, CAST(1 AS INTEGER), round((aa * by_ - ab * ay) / (aa * bb - ab * ab), 6), round(0.1 * sqrt(aa / (aa * bb - ab * ab)), 6), round(fb, 6) FROM ({_NORMAL}) JOIN ({_STRENGTH}) USING (study)", "lbf")
def k23_multivariable(x: Fixtures):
    def f(p):
        se_x = np.column_stack([p["se"], np.full(len(p), 0.05)])
        e, s, cf = K.multivariable(p[["beta", "eaf"]].to_numpy(), p["z"].to_numpy(), np.full(len(p), 0.1), se_x)
        return {"exposure": [0, 1], "effect": np.round(e, 6), "se": np.round(s, 6), "f": np.round(cf, 6)}

    return _kernel(f, "exposure int, effect double, se double, f double")(_vectors(x))


_INSTRUMENT = "CASE WHEN chr % 3 = 0 THEN 'cis' WHEN chr % 3 = 1 THEN 'discovery trans' WHEN chr = 2 THEN 'indirect cis' END"


@query(f"SELECT study, instrument, CASE WHEN n = 1 THEN 'wald' ELSE 'ivw' END AS method, round(slope, 6) AS slope, round(se, 6) AS se, n FROM (SELECT study, {_INSTRUMENT} AS instrument, sum(eaf * beta / (se * se)) / sum(eaf * eaf / (se * se)) AS slope, 1 / sqrt(sum(eaf * eaf / (se * se))) AS se, CAST(count(*) AS BIGINT) AS n FROM snps GROUP BY 1, 2) WHERE instrument IS NOT NULL", "snps")
def k24_weighted_slope(x: Fixtures):
    """Effects by instrument set: cis, trans and indirect cis."""
    t = x.snps.select("study", F.expr(_INSTRUMENT).alias("instrument"), F.col("eaf").alias("bx"), F.col("beta").alias("by"), F.col("se").alias("se_y")).where("instrument IS NOT NULL")
    return K.ivw_by_set(t, ["study"], "instrument").select("study", "instrument", "method", _r("slope"), _r("se"), "n")


def _chain(x: Fixtures) -> str:
    """A chain file made from the tables: each block of a chromosome is a chain of two pieces with gaps between and after.

    Every third block lies on the reverse strand, every fourth on the next chromosome.
    """
    b = x.blocks.withColumn("k", F.floor(F.col("start") / 1_000_000).cast("long"))
    to = F.when(F.col("k") % 4 == 3, F.col("chr") % 22 + 1).otherwise(F.col("chr"))
    strand = F.when(F.col("k") % 3 == 2, "-").otherwise("+")
    header = F.concat_ws(" ", F.lit("chain"), F.lit(1000) + F.col("k"), F.concat(F.lit("chr"), "chr"), F.lit(10_000_000), F.lit("+"), "start", F.col("start") + 900_000, F.concat(F.lit("chr"), to), F.lit(12_000_000), strand, F.col("start") + 70_000, F.col("start") + 960_000, F.col("chr") * 100 + F.col("k"))
    lines = b.select(F.concat(header, F.lit("\n400000\t100000\t90000\n400000\n")).alias("value"))
    path = scratch.fresh(x.spark, "chain")
    x.spark.createDataFrame([("# made from the tables\n",)], "value string").union(lines).write.text(path)
    return path


#: Piece, place along the chain's target strand, chromosome and position of each point; from 0.
_LIFTED = "SELECT *, CASE WHEN k % 3 = 2 THEN 12000000 - 1 - along ELSE along END AS to_bp, CASE WHEN k % 4 = 3 THEN chr % 22 + 1 ELSE chr END AS to_chr FROM (SELECT study, chr, bp, bp // 1000000 AS k, CASE WHEN bp % 1000000 < 400000 THEN bp + 70000 WHEN bp % 1000000 >= 500000 AND bp % 1000000 < 900000 THEN bp + 60000 END AS along FROM snps WHERE bp < 10000000)"


@query(f"SELECT study, chr, bp, CASE WHEN along IS NOT NULL AND to_chr = chr THEN CAST(to_bp AS BIGINT) END AS lifted FROM ({_LIFTED})", "snps")
def k25_liftover(x: Fixtures):
    """Positions carried over by a chain file with gaps, reverse strands and other chromosomes; unmapped rows have none."""
    from ..sources import chain

    there, gone = chain.lifted(x.snps.select("study", "chr", "bp"), chain.segments(x.spark, _chain(x)))
    return there.select("study", "chr", "bp", F.col("to_bp").alias("lifted")).union(gone.select("study", "chr", "bp", F.lit(None).cast("long")))


_LD = "SELECT a.n AS i, b.n AS j, pow(0.95, abs(a.n - b.n)) AS r FROM (SELECT CAST(n_nationkey AS BIGINT) AS n FROM nation) a CROSS JOIN (SELECT CAST(n_nationkey AS BIGINT) AS n FROM nation) b"


def _matrix(x: Fixtures):
    n = x.table("nation").select(F.col("n_nationkey").cast("long").alias("snp"))
    names = F.sequence(F.lit(0).cast("long"), F.lit(24).cast("long"))
    return n.select(F.lit("b").alias("block"), "snp", names.alias("names"), F.transform(names, lambda j: F.pow(F.lit(0.95), F.abs(F.col("snp") - j).cast("double"))).alias("r"))


@query(f"SELECT i AS lead, j AS proxy, round(r, 6) AS r FROM ({_LD}) WHERE i <> j AND (r * r > 0.8 OR i = 3)")
def k26_ld_long(x: Fixtures):
    leads = x.table("nation").where("n_nationkey = 3").select(F.col("n_nationkey").cast("long").alias("snp"))
    return K.ld_long(_matrix(x), leads).select("lead", "proxy", _r("r"))


@query(f"SELECT i AS lead, j AS proxy, round(r * CASE WHEN i % 4 = 0 THEN -1 ELSE 1 END * CASE WHEN j % 4 = 0 THEN -1 ELSE 1 END, 6) AS r FROM ({_LD}) WHERE i <> j AND r * r > 0.8")
def k27_ld_signs(x: Fixtures):
    ld = K.ld_long(_matrix(x), x.spark.createDataFrame([], "snp long"))
    return K.ld_signs(ld, x.table("nation").where("n_nationkey % 4 = 0").select(F.col("n_nationkey").cast("long").alias("snp"))).select("lead", "proxy", _r("r"))


@query()
def k28_conditional_spread(x: Fixtures):
    """Studies with their missing effects filled from the index SNPs' conditional ones, and how well these agree with what is known."""

    def f(p, ld):
        seen = p["seen"].to_numpy()
        index = K.clump(np.where(seen, p["z"], 0.0), ld, 0.01, 1.0)
        hide = lambda c: np.where(seen, p[c], np.nan)
        beta, se, imputed, fit, fit_se = K.filled_by_index(hide("beta"), hide("se"), p["eaf"].to_numpy(), ld, index)
        return {"snp": p["snp"], "beta": beta, "se": se, "imputed": imputed, "fit": fit, "fit_se": fit_se}

    return _with_ld(x, f, "snp long, beta double, se double, imputed boolean, fit double, fit_se double")


def _panel(x: Fixtures):
    """Genotype files (blk, samples, content) made from the embeddings, and their variants: a label is a block, a vector a sample."""
    import pyarrow as pa

    from ..sources.genotypes import MAGIC

    def packed(t: pa.Table) -> pa.Table:
        t = t.sort_by("study")
        rows = np.array(t.column("codes").to_pylist(), np.uint8).T  # a row per variant
        rows = np.pad(rows, ((0, 0), (0, -rows.shape[1] % 4))).reshape(rows.shape[0], -1, 4)
        body = MAGIC + (rows << np.array([0, 2, 4, 6], np.uint8)).sum(2, dtype=np.uint8).tobytes()
        return pa.table({"blk": t.column("blk").slice(0, 1), "samples": pa.array([t.num_rows], pa.int32()), "content": pa.array([body], pa.binary())})

    e = x.table("embeddings").select(F.col("label").cast("long").alias("blk"), F.col("vec_id").cast("long").alias("study"), F.transform("embedding", lambda v: F.when(v > 0.08, 0).when(v > -0.02, 2).when(v > -0.03, 1).otherwise(3)).alias("codes"))
    content = e.groupBy("blk").applyInArrow(packed, "blk long, samples int, content binary")
    v = x.lbf.select("blk", F.col("snp").cast("int").alias("place")).distinct()
    allele = lambda k: F.element_at(F.array(*map(F.lit, "ACGT")), F.col("place") % k + 1)
    return content, v.select("blk", "place", F.lit(1).alias("chr"), (F.col("place") * 1000).alias("bp"), allele(4).alias("a1"), F.when(F.col("place") % 2 == 0, "T").otherwise("A").alias("a2")).where("a1 <> a2 OR place % 4 < 4")


def _ordered_panel(x: Fixtures):
    from ..sources import genotypes as GT

    content, variants = _panel(x)
    return GT.in_order(GT.decoded(content, "blk"), variants, "blk")


_DOSES = "SELECT blk, study, snp, a1 > a2 AS turned, CASE WHEN a1 > a2 THEN 2 - d ELSE d END AS d FROM (SELECT blk, study, snp, substr('ACGT', CAST(snp % 4 + 1 AS INTEGER), 1) AS a1, CASE WHEN snp % 2 = 0 THEN 'T' ELSE 'A' END AS a2, CASE WHEN v > 0.08 THEN 2 WHEN v > -0.02 THEN 1 WHEN v > -0.03 THEN NULL ELSE 0 END AS d FROM (SELECT CAST(vec_id AS BIGINT) AS study, CAST(label AS BIGINT) AS blk, CAST(generate_subscripts(embedding, 1) - 1 AS BIGINT) AS snp, unnest(embedding) AS v FROM embeddings))"


@query(f"SELECT blk, CAST(snp * 1000 AS INTEGER) AS bp, turned, round(avg(d) / 2, 6) AS eaf, count(d) AS n FROM ({_DOSES}) GROUP BY ALL")
def k30_panel_frequencies(x: Fixtures):
    """Allele frequencies of a panel read from two-bit genotype files, alleles in order."""
    from ..sources import genotypes as GT

    return GT.frequencies(_ordered_panel(x)).select("blk", "bp", "turned", _r("eaf"), "n")


@query(f"SELECT a.blk, CAST(a.snp * 1000 AS INTEGER) AS i, CAST(b.snp * 1000 AS INTEGER) AS j, round(corr(a.d, b.d), 6) AS r FROM ({_DOSES}) a JOIN ({_DOSES}) b ON a.blk = b.blk AND a.study = b.study AND a.snp < b.snp WHERE a.d IS NOT NULL AND b.d IS NOT NULL GROUP BY ALL HAVING stddev_pop(a.d) > 0 AND stddev_pop(b.d) > 0")
def k30_panel_correlation(x: Fixtures):
    """Full LD matrices of the panel's blocks from genotypes, over each pair's own samples."""
    from ..sources import genotypes as GT

    bp = lambda c: F.regexp_extract(c, ":([0-9]+)_", 1).cast("int")
    return GT.correlations(_ordered_panel(x), "blk").select("blk", bp("lead").alias("i"), bp("proxy").alias("j"), _r("r"))


@query("SELECT chr, min(start) AS first, max(stop) AS last, CAST(sum(CASE WHEN start = m THEN 0 ELSE start END) AS BIGINT) AS padded FROM (SELECT *, min(start) OVER (PARTITION BY chr) AS m FROM blocks) GROUP BY chr", "blocks")
def k30_block_padding(x: Fixtures):
    b = x.blocks
    first = b.groupBy("chr").agg(F.min("start").alias("m"))
    return b.join(F.broadcast(first), "chr").groupBy("chr").agg(F.min("start").alias("first"), F.max("stop").alias("last"), F.sum(F.when(F.col("start") == F.col("m"), 0).otherwise(F.col("start"))).alias("padded"))


@query()
def k31_projected_imputation(x: Fixtures):
    f = lambda v, held: {"z": K.projected(v["z"], ~v["seen"], held.vectors[:, :20])}
    return _with_factors(x, f, "snp long, z double", 1.0, unknown=lambda p: {"snp": p["snp"], "z": p["z"].where(p["seen"])})


@query("SELECT blk, snp, round((v - avg(v) OVER w) / stddev_samp(v) OVER w, 5) AS z FROM (SELECT blk, snp, sum(abs(lbf)) AS v FROM lbf GROUP BY 1, 2) WINDOW w AS (PARTITION BY snp)", "lbf")
def k22_scaled_shares(x: Fixtures):
    v = x.lbf.groupBy("blk", "snp").agg(F.sum(F.abs("lbf")).alias("v"))
    return W.scaled(v, ["snp"], "v").select("blk", "snp", _r("z", 5))
