"""Kernels with LD: whole queries against plain loops over the tables, functions against direct solutions."""

import tracemalloc
from math import erfc, sqrt

import numpy as np
import pandas as pd
import pytest

from lociframe.operators import kernels as K
from lociframe.plans import registry

registry.load()
N = 10_000.0


@pytest.fixture(scope="module")
def studies(duck):
    """{(block, study): rows}, as the queries make them, and {block: LD matrix}."""
    df = duck.execute("SELECT CAST(label AS BIGINT) AS blk, CAST(vec_id AS BIGINT) AS study, embedding FROM embeddings").df()
    rows, ld = {}, {}
    for blk, study, e in df.itertuples(index=False):
        snp = np.arange(len(e))
        eaf = 0.05 + snp % 40 / 100
        se = 1 / np.sqrt(2 * eaf * (1 - eaf) * N)
        z = np.asarray(e, float) * 30 / 6
        rows[blk, study] = pd.DataFrame({"snp": snp, "z": z, "eaf": eaf, "se": se, "beta": z * se, "seen": (study + snp) % 5 != 0})
        ld[blk] = (0.5 + blk % 10 * 0.04) ** np.abs(snp[:, None] - snp[None])
    return rows, ld


def compared(spark, sf_dir, studies, name, want, columns, atol=1e-8):
    """Every study's rows of a query equal ``want(rows, matrix)``."""
    got = registry.QUERIES[name](spark, sf_dir).toPandas()
    n = 0
    for (blk, study), one in got.groupby(["blk", "study"]):
        exact = want(studies[0][blk, study], studies[1][blk])
        for c in columns:
            g, w = one[c].to_numpy(), np.asarray(exact[c])
            assert len(g) == len(w), (name, study)
            assert np.allclose(g.astype(float), w.astype(float), atol=atol), (name, study, c)
        n += 1
    assert n == len(studies[0]) and set(zip(got.blk, got.study, strict=True)) == set(studies[0])


def test_eigen_imputation(spark, sf_dir, studies):
    def want(p, ld):
        values, vectors = np.linalg.eigh(ld)
        values, vectors = values[::-1], vectors[:, ::-1]
        k = next(i for i in range(len(values)) if values[: i + 1].sum() / values.sum() >= 0.9) + 1
        seen = p["seen"].to_numpy()
        basis = np.column_stack([np.ones(len(p)), vectors[:, : min(k, seen.sum() - 2)]])
        return {"z": basis @ np.linalg.pinv(basis[seen]) @ p["z"].to_numpy()[seen]}

    compared(spark, sf_dir, studies, "k6_eigen_imputation", want, ["z"], 1e-6)


def test_elastic_net_imputation(spark, sf_dir, studies):
    def want(p, ld):
        seen = p["seen"].to_numpy()
        b = K.elastic_net_cv(ld[seen], p["z"].to_numpy()[seen])
        return {"z": b[0] + ld @ b[1:]}

    compared(spark, sf_dir, studies, "k7_elastic_net_imputation", want, ["z"], 1e-6)


def test_elastic_net_meets_its_optimality_conditions():
    rng = np.random.default_rng(8)
    x = rng.normal(size=(60, 40)) @ np.linalg.cholesky(0.9 ** np.abs(np.subtract.outer(range(40), range(40)))).T
    y = x[:, 3] - 2 * x[:, 20] + rng.normal(size=60)
    z = (x - x.mean(0)) / x.std(0)
    for mix in (0.5, 1.0):
        for penalty, b in zip((0.3, 0.02), K.elastic_net_path(x, y, np.array([0.3, 0.02]), mix, rounds=50_000, tolerance=1e-12), strict=True):
            scaled = b[1:] * x.std(0)
            slope = z.T @ (y - y.mean() - z @ scaled) / len(y) - penalty * (1 - mix) * scaled
            on = scaled != 0
            assert np.allclose(slope[on], penalty * mix * np.sign(scaled[on]), atol=1e-6) and (np.abs(slope[~on]) <= penalty * mix + 1e-6).all()
            assert np.isclose((y - b[0] - x @ b[1:]).sum(), 0, atol=1e-6) and 0 < on.sum() <= 40


def test_dense_imputation(spark, sf_dir, studies):
    def want(p, ld):
        seen = p["seen"].to_numpy()
        values, vectors = np.linalg.eigh(ld)
        basis = np.column_stack([np.ones(len(p)), vectors[:, ::-1][:, : np.searchsorted(np.cumsum(values[::-1]) / values.sum(), 0.9) + 1]])
        fitted = basis @ np.linalg.lstsq(basis[seen], p["z"].to_numpy()[seen], rcond=None)[0]
        z = np.where(seen, p["z"], fitted * np.std(p["z"][seen]) / np.std(fitted[seen]))
        basis = 1 / np.sqrt(2 * p["eaf"] * (1 - p["eaf"]))
        se = np.where(seen, p["se"], basis * (basis[seen] * p["se"][seen]).sum() / (basis[seen] ** 2).sum())
        return {"z": z, "se": se, "beta": z * se, "p": [erfc(abs(v) / sqrt(2)) for v in z]}

    compared(spark, sf_dir, studies, "k8_dense_imputation", want, ["z", "se", "beta", "p"], 1e-8)


def test_conditional_imputation(spark, sf_dir, studies):
    def want(p, ld):
        seen = p["seen"].to_numpy()
        known, cross = ld[seen][:, seen] + 0.01 * np.eye(seen.sum()), ld[~seen][:, seen]
        values, vectors = np.linalg.eigh(known)
        inverse = vectors @ np.diag(np.where(values > 0.01 * values.max(), 1 / values, 0)) @ vectors.T
        r2 = np.diag(cross @ inverse @ cross.T) - 0.01
        return {"snp": p["snp"][~seen], "z": cross @ inverse @ p["z"][seen] / np.sqrt(np.maximum(r2, 1e-12)), "r2": r2, "ld_score": (cross**2).sum(1)}

    compared(spark, sf_dir, studies, "k11_conditional_imputation", want, ["snp", "z", "r2", "ld_score"], 1e-6)


def test_quality_control(spark, sf_dir, studies):
    compared(spark, sf_dir, studies, "k15_quality_control", lambda p, ld: {"snp": p["snp"], "bad": K.dentist(p["z"].to_numpy(), ld)}, ["snp", "bad"])
    rng = np.random.default_rng(3)
    ld = 0.95 ** np.abs(np.subtract.outer(range(200), range(200)))
    z = np.linalg.cholesky(ld) @ rng.normal(size=200)
    assert not K.dentist(z, ld).any()
    wrong = z.copy()
    wrong[[40, 120]] += 12
    bad = K.dentist(wrong, ld)
    assert bad[40] and bad[120] and bad.sum() <= 4


@pytest.mark.parametrize(("name", "r2", "width"), [("k16_clumping", 0.1, 1e6), ("k17_greedy_clumping", 0.3, None)])
def test_clumping(spark, sf_dir, studies, name, r2, width):
    def want(p, ld):
        left, leads = sorted(range(len(p)), key=lambda i: (-abs(p["z"][i]), i)), []
        while left and abs(p["z"][left[0]]) > 0.5:
            top = left[0]
            leads.append(top)
            left = [i for i in left if i != top and not (ld[top, i] ** 2 > r2 and (width is None or abs(i - top) * 100_000 <= width))]
        return {"lead": leads}

    compared(spark, sf_dir, studies, name, want, ["lead"])


def test_effects_filled_from_index_snps(spark, sf_dir, studies):
    def line(truth, predicted):
        ratio = {i: truth[i] / predicted[i] for i in range(len(truth)) if not np.isnan(truth[i])}
        middle = np.median(list(ratio.values()))
        for _ in range(2):
            spread = np.std(list(ratio.values()), ddof=1)
            ratio = {i: r for i, r in ratio.items() if abs(r - middle) <= 3 * spread}
        x, y = np.array([predicted[i] for i in ratio]), np.array([truth[i] for i in ratio])
        slope = ((x - x.mean()) * (y - y.mean())).sum() / ((x - x.mean()) ** 2).sum()
        return y.mean() + slope * (predicted - x.mean()), abs(np.corrcoef(x, y)[0, 1]) * np.sign(1.0)

    def want(p, ld):
        seen, sd = p["seen"].to_numpy(), np.sqrt(2 * p["eaf"] * (1 - p["eaf"])).to_numpy()
        left, index = {i: abs(p["z"][i]) for i in range(len(p)) if seen[i] and abs(p["z"][i]) > 1}, []
        while left:
            top = min(left, key=lambda i: (-left[i], i))
            index.append(top)
            left = {i: v for i, v in left.items() if i != top and ld[top, i] ** 2 <= 0.01}
        beta, se = np.where(seen, p["beta"], np.nan), np.where(seen, p["se"], np.nan)
        if not index:
            return {"beta": beta, "se": se, "fit": np.full(len(p), np.nan)}
        own = beta[index] if len(index) == 1 else np.diag(sd[index]) @ np.linalg.pinv(ld[index][:, index]) @ np.diag(1 / sd[index]) @ beta[index]
        spread = np.array([sum(ld[i, j] * sd[j] / sd[i] * b for j, b in zip(index, own, strict=True)) for i in range(len(p))])
        effects, fit = line(beta, spread)
        errors, _ = line(se, 1 / sd)
        return {"beta": np.where(seen, beta, effects), "se": np.where(seen, se, errors), "fit": np.full(len(p), fit)}

    got = registry.QUERIES["k28_conditional_spread"](spark, sf_dir).toPandas()
    filled = 0
    for (blk, study), one in got.groupby(["blk", "study"]):
        exact = want(studies[0][blk, study], studies[1][blk])
        one = one.sort_values("snp")
        for c in ("beta", "se", "fit"):
            assert np.allclose(one[c].astype(float), exact[c], atol=1e-7, equal_nan=True), (study, c)
        filled += one.imputed.sum()
    assert filled > len(got) / 10 and got.fit.mean() > 0.2


def test_projection(spark, sf_dir, studies):
    def projected(p, ld):
        basis, gone = np.linalg.eigh(ld)[1][:, -20:], ~p["seen"].to_numpy()
        z = p["z"].to_numpy().copy()
        z[gone] = z[~gone].mean()
        for _ in range(30):
            z[gone] = (basis @ (basis.T @ z))[gone]
        return {"z": z}

    compared(spark, sf_dir, studies, "k31_projected_imputation", projected, ["z"], 1e-6)


def test_masked_colocalisation_without_a_mask_is_colocalisation(spark, sf_dir):
    plain = registry.QUERIES["k18_colocalisation"](spark, sf_dir).toPandas()
    got = registry.QUERIES["k19_masked_colocalisation"](spark, sf_dir).toPandas().set_index("cut")
    assert (got.n == len(plain)).all() and abs(got.mean_h4[0] - plain.h4.mean()) < 1e-5 and got.high[0] == (plain.h4 >= 0.8).sum()


def test_principal_components(spark, sf_dir, studies):
    got = registry.QUERIES["k21_principal_components"](spark, sf_dir).toPandas()
    for blk, one in got.groupby("blk"):
        one = one.sort_values("study")
        x = np.array([studies[0][blk, s]["z"].to_numpy() for s in one.study])
        x = (x - x.mean(0)) / x.std(0, ddof=1)
        values, vectors = np.linalg.eigh(x @ x.T)
        pc = vectors[:, -1] * np.sqrt(values[-1])
        assert np.isclose(abs(one.pc1 @ pc), values[-1], rtol=1e-6) and np.allclose(one.share1, values[-1] / values.sum())


def plain_linkage(x):
    """Merges one after the other, each the nearest of all pairs by the mean of the distances between their rows."""
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2))
    groups, merges = {i: [i] for i in range(len(x))}, []
    while len(groups) > 1:
        a, b = min(((i, j) for i in groups for j in groups if i < j), key=lambda ij: (d[np.ix_(groups[ij[0]], groups[ij[1]])].mean(), ij))
        merges.append((a, b, d[np.ix_(groups[a], groups[b])].mean(), len(groups[a]) + len(groups[b])))
        groups[a] += groups.pop(b)
    return merges, groups[0]


def test_linkage_is_plain_average_linkage():
    x = np.random.default_rng(5).normal(size=(30, 4))
    merges, order = plain_linkage(x)
    got = K.linkage(x)
    assert [m[:2] + m[3:] for m in got] == [m[:2] + m[3:] for m in merges] and np.allclose([m[2] for m in got], [m[2] for m in merges])
    assert K.leaf_order(got, 30) == order
    assert K.linkage(x[:1]) == [] and K.leaf_order([], 1) == [0]


def test_linkage_holds_no_square_matrix():
    x = np.random.default_rng(6).normal(size=(4_000, 4))
    tracemalloc.start()
    assert len(K.linkage(x)) == 3_999
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < len(x) ** 2 * 8  # all distances


def test_linkage_with_few_rows_held_and_with_copies():
    rng = np.random.default_rng(7)
    x = rng.normal(size=(60, 5))
    merges, _ = plain_linkage(x)
    got = K.linkage(x, held=0)
    assert [m[:2] + m[3:] for m in got] == [m[:2] + m[3:] for m in merges] and np.allclose([m[2] for m in got], [m[2] for m in merges])
    x = np.repeat(rng.normal(size=(6, 5)), [9, 1, 5, 1, 7, 2], axis=0)[rng.permutation(25)]
    for held in (0, 1 << 20):
        got = K.linkage(x, held=held)
        heights = np.array([m[2] for m in got])
        assert (heights[:19] == 0).all() and np.allclose(heights[19:], [m[2] for m in plain_linkage(x)[0]][19:])
        assert sorted(K.leaf_order(got, 25)) == list(range(25))


@pytest.mark.parametrize("side", ["row", "column"])
def test_clustering_of_a_heatmap(spark, sf_dir, studies, side):
    got = registry.QUERIES[f"k22_{side}_order"](spark, sf_dir).toPandas()
    assert set(got.blk) == {b for b, _ in studies[0]}
    for blk, one in got.groupby("blk"):
        names = sorted(s for b, s in studies[0] if b == blk)
        x = np.array([np.abs(studies[0][blk, s]["z"].to_numpy()) for s in names])
        x = x / x.sum(1, keepdims=True)
        x = (x - x.mean(0)) / x.std(0, ddof=1)
        if side == "column":
            x, names = x.T, list(range(x.shape[1]))
        merges, order = plain_linkage(x)
        leaves, steps = one[one.step < 0].sort_values("place"), one[one.step >= 0].sort_values("step")
        assert leaves.a.tolist() == [names[i] for i in order]
        assert list(zip(steps.a, steps.b, steps["size"], strict=True)) == [(names[a], names[b], n) for a, b, _, n in merges] and np.allclose(steps.height, [m[2] for m in merges])


def test_polynomial_adjustment_and_poisson_regression(spark, duck, sf_dir, studies):
    got = registry.QUERIES["k4_polynomial_adjustment"](spark, sf_dir).toPandas()
    for (_, study), p in list(studies[0].items())[:40]:
        one, seen = got[got.study == study].sort_values("snp"), p["seen"].to_numpy()
        e = p["eaf"].to_numpy()
        basis = np.column_stack([e, e**2, e**3])
        want = basis @ np.linalg.solve(basis[seen].T @ basis[seen], basis[seen].T @ p["se"].to_numpy()[seen])
        assert np.allclose(one.adjusted, want, atol=1e-8)
    rows = duck.execute("SELECT o_custkey % 8 AS g, count(*) AS n, avg(o_totalprice) / 1e5 AS v FROM orders GROUP BY o_custkey").df()
    fits = registry.QUERIES["k20_poisson"](spark, sf_dir).toPandas().set_index("study")
    for g, one in rows.groupby("g"):
        a, b = fits.loc[g, "intercept"], fits.loc[g, "slope"]
        gap = one.n - np.exp(a + b * one.v)  # the likelihood's slope is zero at the fit
        assert abs(gap.sum()) < 1e-5 * one.n.sum() and abs((gap * one.v).sum()) < 1e-5 * one.n.sum()


def plain_dentist(z, ld, cut, share, rounds, worst, seed):
    rng, bad = np.random.default_rng(seed), set()
    for k in range(rounds):
        left = [i for i in range(len(z)) if i not in bad]
        if len(left) < 4:
            return bad
        dealt, stat = rng.permutation(left), {}
        halves = sorted(dealt[::2]), sorted(dealt[1::2])
        for own, other in (halves, halves[::-1]):
            values, vectors = np.linalg.eigh(ld[other][:, other])
            top = [i for i in range(len(other) - max(int(share * len(other)), 1), len(other)) if values[i] > 1e-4]
            inverse = sum(np.outer(vectors[:, i], vectors[:, i]) / values[i] for i in top)
            for i in own:
                cross = ld[i][other]
                stat[i] = abs(z[i] - cross @ inverse @ z[other]) / np.sqrt(max(1 - cross @ inverse @ cross, 0.05))
        beyond = sorted((i for i in left if stat[i] > cut), key=lambda i: (-stat[i], i))
        if not beyond:
            return bad
        bad |= set(beyond if k == rounds - 1 else beyond[: max(int(worst * len(left)), 1)])
    return bad


def test_quality_control_against_plain_loops():
    rng = np.random.default_rng(7)
    for trial in range(6):
        ld = (0.5 + 0.08 * trial) ** np.abs(np.subtract.outer(range(60), range(60)))
        z = np.linalg.cholesky(ld) @ rng.normal(size=60)
        z[rng.integers(0, 60, 3)] += 9
        for worst, rounds in ((0.005, 10), (0.2, 3)):
            assert set(np.flatnonzero(K.dentist(z, ld, 5.0, 0.4, rounds, worst, 5)).tolist()) == {int(i) for i in plain_dentist(z, ld, 5.0, 0.4, rounds, worst, 5)}


def test_centralities_against_all_shortest_paths(spark):
    from itertools import combinations

    from lociframe.operators import graph as G

    rng = np.random.default_rng(3)
    edges = [(i, j) for i in range(14) for j in range(i + 1, 14) if rng.random() < 0.22] + [(i, i + 1) for i in range(13)]
    edges = sorted(set(edges))
    nbr = {i: {b if a == i else a for a, b in edges if i in (a, b)} for i in range(14)}

    def paths(s, t):
        level = [[s]]
        while level:
            found = [p for p in level if p[-1] == t]
            if found:
                return found
            level = [[*p, u] for p in level for u in nbr[p[-1]] if u not in p]

    between, far = dict.fromkeys(range(14), 0.0), dict.fromkeys(range(14), 0)
    for s, t in combinations(range(14), 2):
        found = paths(s, t)
        far[s] += len(found[0]) - 1
        far[t] += len(found[0]) - 1
        for v in range(14):
            if v not in (s, t):
                between[v] += sum(v in p for p in found) / len(found)
    got = G.centralities(spark.createDataFrame([(0, a, b) for a, b in edges], "component long, a long, b long")).collect()
    for r in got:
        v = r["node"]
        assert r["degree"] == len(nbr[v]) and np.isclose(r["betweenness"], between[v]) and np.isclose(r["closeness"], 13 / far[v])
    assert len(got) == 14
