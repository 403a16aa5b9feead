"""Kernels against direct solutions, and edge cases."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from lociframe.functions import scalar as S
from lociframe.operators import aggregates as A
from lociframe.operators import graph as G
from lociframe.operators import joins as J
from lociframe.operators import kernels as K


def ladder(n, fall=0.8):
    i = np.arange(n)
    return fall ** np.abs(i[:, None] - i[None])


def test_imputation_recovers_a_correlated_signal():
    rng = np.random.default_rng(1)
    ld = ladder(60, 0.95)
    z = np.linalg.cholesky(ld + 1e-9 * np.eye(60)) @ rng.normal(size=60)
    seen = rng.random(60) > 0.2
    got, r2, score = K.raiss(z, seen, ld)
    assert np.corrcoef(got, z[~seen])[0, 1] > 0.8 and (r2 < 1).all() and (score > 0).all()
    values, vectors = np.linalg.eigh(ld)
    got = K.eigen_imputed(z[None], seen[None], np.cumsum(values[::-1]) / values.sum(), vectors[:, ::-1])[0]
    assert np.corrcoef(got[~seen], z[~seen])[0, 1] > 0.6


def test_elastic_net_is_least_squares_without_penalty():
    rng = np.random.default_rng(2)
    x, b = rng.normal(size=(80, 3)), np.array([1.0, -2.0, 0.5])
    got = K.elastic_net_path(x, 3 + x @ b, np.array([0.0]), rounds=500)[0]
    assert np.allclose(got, [3, *b], atol=1e-3)
    assert np.allclose(K.elastic_net_cv(x, 3 + x @ b)[1:], b, atol=0.1)


def test_clumping_takes_the_strongest_of_each_clump():
    z = np.array([1.0, 5.0, 4.9, 0.2, 3.0])
    ld = np.eye(5)
    ld[1, 2] = ld[2, 1] = 0.9
    assert K.clump(z, ld, 0.1, 0.5).tolist() == [1, 4, 0]


def test_principal_components_and_regressions():
    rng = np.random.default_rng(4)
    x = np.column_stack([rng.normal(size=50), np.ones(50)])
    x = np.column_stack([x, 2 * x[:, 0]])
    scores, loadings, share = K.principal(x, 1)
    assert share[0] > 0.999 and loadings[1, 0] == 0 and abs(np.corrcoef(scores[:, 0], x[:, 0])[0, 1]) > 0.999
    b = K.poisson_fit(x[:, :1], np.exp(0.3 + 0.5 * x[:, 0]))
    assert np.allclose(b, [0.3, 0.5], atol=1e-6)
    effects, _, f = K.multivariable(x[:, [0, 2]] + rng.normal(size=(50, 2)), x[:, 0], np.ones(50))
    assert effects.shape == (2,) and (f > 0).all()


def test_p_values_against_the_exact_function(spark):
    from math import erfc, sqrt

    rows = spark.createDataFrame([(float(z),) for z in (-8, -3, -1, 0, 0.5, 2, 6)], "z double").select("z", S.two_sided_p("z").alias("p")).collect()
    assert all(abs(r["p"] / erfc(abs(r["z"]) / sqrt(2)) - 1) < 1e-6 for r in rows)


def test_interval_join_by_bins_equals_broadcast(spark, monkeypatch):
    p = spark.range(500).select((F.col("id") % 3).alias("chr"), (F.col("id") * 37 % 1000).alias("bp"), "id")
    i = spark.range(60).select((F.col("id") % 3).alias("chr"), (F.col("id") * 15).alias("start"), (F.col("id") * 15 + 40).alias("stop"))
    want = sorted(map(tuple, J.interval_join(p, i).collect()))
    monkeypatch.setattr(J, "fits_broadcast", lambda *_: False)
    assert want == sorted(map(tuple, J.interval_join(p, i, bin_width=50).collect())) and want


def test_components_of_a_chain_and_of_nothing(spark):
    e = spark.range(60).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    assert {r["component"] for r in G.components(e).collect()} == {0}
    assert G.components(e.limit(0)).count() == 0


def test_communities_split_two_cliques():
    pairs = [(i, j) for s in (0, 5) for i in range(s, s + 5) for j in range(i + 1, s + 5)] + [(4, 5)]
    a, b = np.array(pairs).T
    got = G.communities_kernel(a, b, np.ones(len(a)))
    assert len({got[i] for i in range(5)}) == 1 and len(set(got.values())) == 2


def length_of(a, b, w, own):
    nodes = sorted(set(a) | set(b))
    total, modules = 2 * sum(w), sorted(set(own.values()))
    flow = np.array([sum(v for x, y, v in zip(a, b, w, strict=True) for e in (x, y) if e == n) for n in nodes]) / total
    leave = np.array([sum(v for x, y, v in zip(a, b, w, strict=True) if own[x] != own[y] and m in (own[x], own[y])) for m in modules]) / total
    inside = np.array([sum(f for f, n in zip(flow, nodes, strict=True) if own[n] == m) for m in modules])
    return G.code_length(flow, leave, inside)


def test_communities_have_the_shortest_code_of_all_partitions():
    def partitions(items):
        if not items:
            yield []
            return
        for rest in partitions(items[1:]):
            yield [[items[0]], *rest]
            for i in range(len(rest)):
                yield [*rest[:i], [items[0], *rest[i]], *rest[i + 1 :]]

    rng = np.random.default_rng(9)
    for _ in range(6):
        pairs = [(i, j) for i in range(7) for j in range(i + 1, 7) if rng.random() < 0.5] or [(0, 1)]
        a, b = np.array(pairs).T
        w = rng.integers(1, 9, len(a)) / 4.0
        got = length_of(a.tolist(), b.tolist(), w.tolist(), G.communities_kernel(a, b, w))
        nodes = sorted({*a.tolist(), *b.tolist()})
        least = min(length_of(a.tolist(), b.tolist(), w.tolist(), {n: k for k, part in enumerate(p) for n in part}) for p in partitions(nodes))
        assert abs(got - least) < 1e-9


def test_communities_of_planted_groups():
    rng = np.random.default_rng(1)
    pairs = [(i, j) for i in range(60) for j in range(i + 1, 60) if rng.random() < (0.6 if i // 12 == j // 12 else 0.02)]
    a, b = np.array(pairs).T
    got = G.communities_kernel(a, b, np.ones(len(a)))
    assert all(got[i] == (i // 12) * 12 for i in range(60))


def test_centralities_of_a_path(spark):
    e = spark.createDataFrame(pd.DataFrame({"component": [0, 0], "a": [0, 1], "b": [1, 2]}))
    rows = {r["node"]: r for r in G.centralities(e).collect()}
    assert rows[1]["betweenness"] == 1.0 and rows[1]["degree"] == 2 and rows[0]["betweenness"] == 0.0


def test_empty_and_null_groups(spark):
    t = spark.createDataFrame([], "g long, v double")
    assert A.best_row(t, ["g"], ["v"], ["v"]).count() == 0
    n = spark.createDataFrame([(1, None), (1, 2.0), (2, None)], "g long, v double")
    assert {r["g"]: r["v"] for r in A.keep_first(n, ["g"], [F.col("v").desc_nulls_last()]).collect()} == {1: 2.0, 2: None}


def murmur3(data: bytes, seed: int = 42) -> int:
    """32-bit Murmur3 as the engine's hash has it: whole words first, then the bytes left over one by one."""
    mask, h = 0xFFFFFFFF, seed
    turn = lambda v, r: ((v << r) | (v >> (32 - r))) & mask
    whole = len(data) // 4 * 4
    words = [int.from_bytes(data[i : i + 4], "little") for i in range(0, whole, 4)] + [(b - 256 if b > 127 else b) & mask for b in data[whole:]]
    for k in words:
        h = (turn(h ^ (turn(k * 0xCC9E2D51 & mask, 15) * 0x1B873593 & mask), 13) * 5 + 0xE6546B64) & mask
    h ^= len(data)
    h = ((h ^ (h >> 16)) * 0x85EBCA6B) & mask
    h = ((h ^ (h >> 13)) * 0xC2B2AE35) & mask
    return h ^ (h >> 16)


def test_long_alleles_are_named_by_their_hash(spark):
    alleles = ["A", "ACGTACGTAC", "ACGTACGTACG", "CCGCCGCCGCCGTTA", "G" * 1000, "é" * 11]
    got = [r["c"] for r in spark.createDataFrame([(a,) for a in alleles], "a string").select(S.compress_allele("a").alias("c")).collect()]
    assert got == [a if len(a) <= 10 else f"{murmur3(a.encode()):x}" if murmur3(a.encode()) < 2**31 else f"ffffffff{murmur3(a.encode()):x}" for a in alleles]
