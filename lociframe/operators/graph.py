"""Graph operators on edge lists."""

from __future__ import annotations

from math import log2

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from ..constants import EDGE_MIN_WEIGHT, H4_THRESHOLD, MIN_DEGREE_FRACTION
from ..functions.scalar import edge_weight
from ..scratch import cut_lineage


def weighted_edges(pairs: DataFrame, min_p: DataFrame) -> DataFrame:
    """(a, b, w): weight from the larger of the two p-values where h4 is high; weights below the floor are 0 and left out."""
    p = min_p.select("study", "min_p")
    e = pairs.join(p.toDF("a", "_pa"), "a").join(p.toDF("b", "_pb"), "b")
    w = F.when(F.col("h4") >= H4_THRESHOLD, edge_weight(F.greatest("_pa", "_pb"))).otherwise(F.lit(0.0))
    return e.select("a", "b", w.alias("w")).where(F.col("w") >= EDGE_MIN_WEIGHT)


def degrees(edges: DataFrame) -> DataFrame:
    """(node, degree); a node without edges isn't listed."""
    return edges.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count("*").alias("degree"))


def components(edges: DataFrame) -> DataFrame:
    """(node, component): least reachable node.

    Alternates large-star and small-star steps (each a min-aggregation with
    map-side combine and an equi-join) until the edges no longer change; one
    checkpoint a round.  Nodes of self-loops are components of their own.
    """
    e = cut_lineage(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    nodes = e.select(F.explode(F.array("u", "v")).alias("node")).distinct()
    e, before = e.where("u <> v"), None
    while True:
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        hooked = large.join(low, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        e = cut_lineage(hooked.select("e.*").where("u <> v").distinct())
        now = e.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            root = e.groupBy("u").agg(F.min("v").alias("c"))
            return nodes.join(root, nodes["node"] == root["u"], "left").select("node", F.coalesce("c", "node").alias("component"))
        before = now


def _plogp(x):
    x = np.maximum(x, 0.0)
    return x * np.log2(np.where(x > 0, x, 1.0))


def _xlog(x: float) -> float:
    return x * log2(x) if x > 0 else 0.0


def code_length(flow: np.ndarray, leave: np.ndarray, inside: np.ndarray) -> float:
    """Two-level map equation: bits a step of a random walk, from node flows, and modules' exit and whole flows."""
    return float(_plogp(leave.sum()) - 2 * _plogp(leave).sum() - _plogp(flow).sum() + _plogp(leave + inside).sum())


class _Walk:
    """A weighted graph with flows, and a partition that local moves improve."""

    def __init__(self, nbr: list[dict[int, float]], flow: np.ndarray, leave: np.ndarray, own: np.ndarray):
        # weights are shares of all flow; a node's leave is its flow over edges to other nodes
        self.nbr, self.flow, self.out, self.own = nbr, flow, leave, own.copy()
        m = len(nbr)
        self.inside = np.bincount(own, weights=flow, minlength=m)
        cut = [sum(v for j, v in nbr[i].items() if own[j] != own[i]) for i in range(m)]
        self.leave = np.bincount(own, weights=cut, minlength=m)

    def improve(self, rng: np.random.Generator) -> bool:
        """Move nodes, in random order, to the neighbouring module that shortens the code most, until none does."""
        any_moved, moved = False, True
        # plain lists and floats: the loop reads single values only
        nbr, flow, out = self.nbr, self.flow.tolist(), self.out.tolist()
        own, leave, inside = self.own.tolist(), self.leave.tolist(), self.inside.tolist()
        while moved:
            moved, q = False, float(np.sum(leave))
            for i in rng.permutation(len(nbr)).tolist():
                f, to_module = own[i], {}
                for j, v in nbr[i].items():
                    to_module[own[j]] = to_module.get(own[j], 0.0) + v
                if not to_module.keys() - {f}:
                    continue
                lf = leave[f] - out[i] + 2 * to_module.get(f, 0.0)
                nf, best, target = inside[f] - flow[i], -1e-12, None
                whole, from_leave, from_all = _xlog(q), _xlog(lf) - _xlog(leave[f]), _xlog(lf + nf) - _xlog(leave[f] + inside[f])
                for t in sorted(to_module.keys() - {f}):
                    lt, nt = leave[t] + out[i] - 2 * to_module[t], inside[t] + flow[i]
                    gain = _xlog(q - (leave[f] + leave[t]) + (lf + lt)) - whole - 2 * (from_leave + (_xlog(lt) - _xlog(leave[t])))
                    gain += from_all + (_xlog(lt + nt) - _xlog(leave[t] + inside[t]))
                    if gain < best:
                        best, target = gain, (t, lt, nt)
                if target:
                    t, lt, nt = target
                    q += lf + lt - leave[f] - leave[t]
                    leave[f], leave[t], inside[f], inside[t] = lf, lt, nf, nt
                    own[i], moved, any_moved = t, True, True
        self.own, self.leave, self.inside = np.array(own), np.array(leave), np.array(inside)
        return any_moved

    def merged(self) -> tuple["_Walk", np.ndarray]:
        """The graph of the modules, each a node in a module of its own, and the node that stands for each node of this graph."""
        _, at = np.unique(self.own, return_inverse=True)
        k = int(at.max()) + 1
        nbr: list[dict[int, float]] = [{} for _ in range(k)]
        for i, row in enumerate(self.nbr):
            for j, v in row.items():
                if at[i] != at[j]:
                    nbr[at[i]][at[j]] = nbr[at[i]].get(at[j], 0.0) + v
        leave = np.array([sum(d.values()) for d in nbr])
        return _Walk(nbr, np.bincount(at, weights=self.flow, minlength=k), leave, np.arange(k)), at


def communities_kernel(a: np.ndarray, b: np.ndarray, w: np.ndarray, trials: int = 20, seed: int = 7) -> dict:
    """Community of each node (named by its least node) by the two-level map equation: the shortest code of several trials.

    A trial moves nodes in random order, then whole modules, level by level,
    and starts again from single nodes in the modules found until the code no
    longer gets shorter.
    """
    nodes = np.unique(np.concatenate([a, b]))
    i, j = np.searchsorted(nodes, a), np.searchsorted(nodes, b)
    total = 2 * float(w.sum())
    nbr: list[dict[int, float]] = [{} for _ in nodes]
    for x, y, v in zip(i.tolist(), j.tolist(), (w / total).tolist(), strict=True):
        if x != y:
            nbr[x][y] = nbr[x].get(y, 0.0) + v
            nbr[y][x] = nbr[y].get(x, 0.0) + v
    flow = (np.bincount(i, weights=w, minlength=len(nodes)) + np.bincount(j, weights=w, minlength=len(nodes))) / total
    leave = np.array([sum(d.values()) for d in nbr])
    rng, best, found = np.random.default_rng(seed), np.inf, np.arange(len(nodes))
    for _ in range(trials):
        own, length = np.arange(len(nodes)), np.inf
        while True:
            walk = _Walk(nbr, flow, leave, own)
            walk.improve(rng)
            own, top = walk.own.copy(), walk
            names = np.arange(len(nodes))
            while True:
                top, at = top.merged()
                names = at[names]
                if not top.improve(rng):
                    break
            own = top.own[names]
            new = code_length(flow, top.leave, top.inside)
            if new >= length - 1e-10:
                break
            length, kept = new, own
            own = np.unique(own, return_inverse=True)[1]
        if length < best - 1e-10:
            best, found = length, kept
    return {v: nodes[np.flatnonzero(found == found[k])[0]] for k, v in enumerate(nodes)}


def communities(edges: DataFrame, over: str = "block") -> DataFrame:
    """(block, node, community): one block is one group of the map-equation kernel."""

    def kernel(pdf: pd.DataFrame) -> pd.DataFrame:
        got = communities_kernel(pdf["a"].to_numpy(), pdf["b"].to_numpy(), pdf["w"].to_numpy())
        return pd.DataFrame({over: pdf[over].iloc[0], "node": list(got), "community": list(got.values())})

    return edges.select(over, "a", "b", "w").groupBy(over).applyInPandas(kernel, f"{over} long, node long, community long")


def cut_between(edges: DataFrame, labels: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(kept, pruned): edges inside a community and those between two."""
    n = labels.select("node", "community")
    e = edges.join(n.toDF("a", "_ca"), "a").join(n.toDF("b", "_cb"), "b")
    return e.where("_ca = _cb").withColumnRenamed("_ca", "community").drop("_cb"), e.where("_ca <> _cb").drop("_ca", "_cb")


def weak_nodes(kept: DataFrame, share: float = MIN_DEGREE_FRACTION) -> DataFrame:
    """(community, node, degree): nodes with less than a share of their community's largest inner degree."""
    d = kept.select("community", F.explode(F.array("a", "b")).alias("node")).groupBy("community", "node").agg(F.count("*").alias("degree"))
    return d.withColumn("_top", F.max("degree").over(Window.partitionBy("community"))).where(F.col("degree") < share * F.col("_top")).drop("_top")


def one_per_study(labels: DataFrame) -> DataFrame:
    """Of several sets of a study in a community the one of least min_p (first by name) stays."""
    w = Window.partitionBy("community", "study").orderBy("min_p", "node")
    return labels.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")


def verdicts(pairs: DataFrame, comp: DataFrame, pruned: DataFrame) -> DataFrame:
    """Pairs with false_positive (a pruned edge of high h4) and false_negative (same component, low h4)."""
    c = comp.select("node", "component")
    out = pairs.join(c.toDF("a", "_ca"), "a", "left").join(c.toDF("b", "_cb"), "b", "left").join(pruned.select("a", "b", F.lit(True).alias("_cut")).distinct(), ["a", "b"], "left")
    same = F.coalesce(F.col("_ca") == F.col("_cb"), F.lit(False))
    return out.withColumn("false_positive", F.coalesce(F.col("_cut"), F.lit(False)) & (F.col("h4") > H4_THRESHOLD)).withColumn("false_negative", same & (F.col("h4") < H4_THRESHOLD)).drop("_ca", "_cb", "_cut")


def triangles(edges: DataFrame) -> DataFrame:
    """(x, y, z) with x < y < z: each edge is directed from the lower degree, so hubs start few paths."""
    e = edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct()
    d = degrees(e)
    e = e.join(d.toDF("a", "_da"), "a").join(d.toDF("b", "_db"), "b")
    first = (F.col("_da") < F.col("_db")) | ((F.col("_da") == F.col("_db")) & (F.col("a") < F.col("b")))
    o = e.select(F.when(first, F.col("a")).otherwise(F.col("b")).alias("s"), F.when(first, F.col("b")).otherwise(F.col("a")).alias("t"), "a", "b")
    x, y = o.select("s", F.col("t").alias("t1")), o.select("s", F.col("t").alias("t2"))
    paths = x.join(y, "s").where("t1 < t2")
    closed = paths.join(o.select(F.col("a").alias("t1"), F.col("b").alias("t2")), ["t1", "t2"])
    return closed.select(F.sort_array(F.array("s", "t1", "t2")).alias("n")).select(*[F.col("n")[i].alias(c) for i, c in enumerate("xyz")])


def measures(edges: DataFrame, comp: DataFrame) -> DataFrame:
    """(component, n_nodes, n_edges, mean_weight, density, transitivity): transitivity is 0 without paths."""
    c = comp.select("node", "component")
    e = edges.join(c.toDF("a", "component"), "a")
    sizes = c.groupBy("component").agg(F.count("*").alias("n_nodes"))
    per = e.groupBy("component").agg(F.count("*").alias("n_edges"), F.avg("w").alias("mean_weight"))
    paths = degrees(edges).join(c, "node").groupBy("component").agg(F.sum(F.expr("degree * (degree - 1) / 2")).alias("_paths"))
    tri = triangles(edges).join(c.toDF("x", "component"), "x").groupBy("component").agg(F.count("*").alias("_tri"))
    out = sizes.join(per, "component").join(paths, "component", "left").join(tri, "component", "left")
    density = 2 * F.col("n_edges") / (F.col("n_nodes") * (F.col("n_nodes") - 1))
    transitivity = F.when(F.col("_paths") > 0, 3 * F.coalesce("_tri", F.lit(0)) / F.col("_paths")).otherwise(F.lit(0.0))
    return out.withColumn("density", density).withColumn("transitivity", transitivity).drop("_paths", "_tri")


def summary(edges: DataFrame, comp: DataFrame, unpruned: DataFrame) -> DataFrame:
    """One row over the components: their number, mean weight, transitivity and conductance, and median size.

    A component's conductance is the share of the weight of all edges of
    ``unpruned`` that touch its nodes which is not inside the component.
    """
    c = comp.select("node", "component")
    inside = edges.join(c.toDF("a", "component"), "a").groupBy("component").agg(F.sum("w").alias("_inside"))
    sides = unpruned.join(c.toDF("a", "_ca"), "a", "left").join(c.toDF("b", "_cb"), "b", "left")
    touched = sides.select("w", F.explode(F.array_distinct(F.array_compact(F.array("_ca", "_cb")))).alias("component")).groupBy("component").agg(F.sum("w").alias("_touched"))
    m = measures(edges, comp).join(inside, "component").join(touched, "component", "left")
    cond = F.when(F.col("_touched") > 0, (F.col("_touched") - F.col("_inside")) / F.col("_touched")).otherwise(F.lit(0.0))
    return m.agg(F.count("*").alias("n_components"), F.avg("mean_weight").alias("mean_weight"), F.avg("transitivity").alias("mean_transitivity"), F.avg(cond).alias("mean_conductance"), F.median("n_nodes").alias("median_size"))


def conductance(edges: DataFrame, labels: DataFrame) -> DataFrame:
    """(community, conductance): weight that leaves a community over its whole weight."""
    n = labels.select("node", "community")
    both = edges.select("a", "b", "w").union(edges.select("b", "a", "w"))
    e = both.join(n.toDF("a", "community"), "a").join(n.toDF("b", "_cb"), "b")
    return e.groupBy("community").agg((F.sum(F.when(F.col("community") != F.col("_cb"), F.col("w")).otherwise(0.0)) / F.sum("w")).alias("conductance"))


def centralities(edges: DataFrame, over: str = "component") -> DataFrame:
    """(node, degree, closeness, betweenness) by breadth-first search; one component is one group."""

    def kernel(pdf: pd.DataFrame) -> pd.DataFrame:
        nbr: dict = {}
        for x, y in zip(pdf["a"], pdf["b"], strict=True):
            nbr.setdefault(x, set()).add(y)
            nbr.setdefault(y, set()).add(x)
        between, close = dict.fromkeys(nbr, 0.0), {}
        for s in sorted(nbr):
            order, dist, paths, before = [s], {s: 0}, {s: 1.0}, {s: []}
            for v in order:
                for u in sorted(nbr[v]):
                    if u not in dist:
                        dist[u], paths[u], before[u] = dist[v] + 1, 0.0, []
                        order.append(u)
                    if dist[u] == dist[v] + 1:
                        paths[u] += paths[v]
                        before[u].append(v)
            close[s] = (len(order) - 1) / sum(dist.values()) if len(order) > 1 else 0.0
            share = dict.fromkeys(order, 0.0)
            for v in reversed(order):
                for u in before[v]:
                    share[u] += paths[u] / paths[v] * (1 + share[v])
                if v != s:
                    between[v] += share[v] / 2
        keys = sorted(nbr)
        return pd.DataFrame({over: pdf[over].iloc[0], "node": keys, "degree": [len(nbr[k]) for k in keys], "closeness": [close[k] for k in keys], "betweenness": [between[k] for k in keys]})

    return edges.groupBy(over).applyInPandas(kernel, f"{over} long, node long, degree long, closeness double, betweenness double")


def merged_variants(ld: DataFrame, r2: float = 0.99) -> DataFrame:
    """(variant, representative): variants joined by r^2 at or above the cut are represented by the least id."""
    strong = ld.where((F.col("r") * F.col("r") >= r2) & (F.col("lead") != F.col("proxy"))).select(F.least("lead", "proxy").alias("a"), F.greatest("lead", "proxy").alias("b")).distinct()
    return components(strong).toDF("variant", "representative")
