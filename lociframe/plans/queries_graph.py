"""Queries of the graph operators, on study pairs with a made-up posterior."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..fixtures import SQL, Fixtures
from ..operators import graph as G
from .registry import query

#: A sparse graph with several components and one row per edge.
SQL["edges"] = "SELECT DISTINCT least(c_custkey, t) AS a, greatest(c_custkey, t) AS b, 0.5 + (c_custkey % 50) / 100.0 AS w FROM (SELECT CAST(c_custkey AS BIGINT) AS c_custkey, CAST((c_custkey * 13) % 997 + c_custkey - c_custkey % 997 AS BIGINT) AS t FROM customer WHERE c_custkey % 3 <> 0) WHERE c_custkey <> t AND t % 5 <> 0"
SQL["reach"] = "SELECT node, min(m) AS component FROM (WITH RECURSIVE r(node, m) AS (SELECT a, a FROM edges UNION SELECT b, b FROM edges UNION SELECT CASE WHEN e.a = r.node THEN e.b ELSE e.a END, r.m FROM r JOIN edges e ON e.a = r.node OR e.b = r.node) SELECT * FROM r) GROUP BY node"

#: The same without its weaker edges.
SQL["strong"] = "SELECT * FROM edges WHERE w >= 0.7"
SQL["spread"] = SQL["reach"].replace("edges", "strong")


def _edges(x: Fixtures):
    c = F.col("c_custkey").cast("long")
    t = x.table("customer").where("c_custkey % 3 <> 0").select(c.alias("c"), (c * 13 % 997 + c - c % 997).alias("t")).where("c <> t AND t % 5 <> 0")
    return t.select(F.least("c", "t").alias("a"), F.greatest("c", "t").alias("b"), (0.5 + (F.col("c") % 50) / 100.0).alias("w")).distinct()


def _min_p(x: Fixtures):
    return x.table("supplier").select(F.col("s_suppkey").cast("long").alias("study"), F.pow(F.lit(10.0), -(3 + F.col("s_suppkey") % 8)).alias("min_p"))


@query("SELECT a, b, w FROM (SELECT a, b, round(CASE WHEN h4 >= 0.8 THEN pow((least(greatest(-log10(greatest(pow(10.0, -(3 + a % 8)), pow(10.0, -(3 + b % 8)))), 4.0), 7.301) - 4.0) / 3.301, 4) * 0.5 + 0.5 ELSE 0 END, 6) AS w FROM pairs) WHERE w >= 0.8", "pairs")
def g1_weighted_edges(x: Fixtures):
    return G.weighted_edges(x.pairs, _min_p(x)).select("a", "b", F.round("w", 6).alias("w"))


@query("SELECT node, CAST(count(*) AS BIGINT) AS degree FROM (SELECT a AS node FROM edges UNION ALL SELECT b FROM edges) GROUP BY node", "edges")
def g2_nodes_with_edges(x: Fixtures):
    return G.degrees(_edges(x))


@query("SELECT node, component FROM reach", "edges reach")
def g3_components(x: Fixtures):
    return G.components(_edges(x))


@query("SELECT blk, CAST(count(DISTINCT component) AS BIGINT) AS n, count(DISTINCT component) = 1 AS whole FROM (SELECT component % 2 AS blk, component FROM reach) GROUP BY blk", "edges reach")
def g4_one_component(x: Fixtures):
    c = G.components(_edges(x)).select((F.col("component") % 2).alias("blk"), "component")
    n = F.countDistinct("component")
    return c.groupBy("blk").agg(n.alias("n"), (n == 1).alias("whole"))


@query()
def g5_communities(x: Fixtures):
    e = _edges(x)
    block = G.components(e).toDF("a", "block")
    return G.communities(e.join(block, "a"))


LABELS = "(SELECT node, component * 10 + node % 2 AS community FROM reach)"


def _labels(x: Fixtures, e):
    return G.components(e).select("node", (F.col("component") * 10 + F.col("node") % 2).alias("community"))


@query(f"SELECT a, b, x.community = y.community AS kept FROM edges JOIN {LABELS} x ON a = x.node JOIN {LABELS} y ON b = y.node", "edges reach")
def g6_cut_between(x: Fixtures):
    e = G.cut_lineage(_edges(x))
    kept, pruned = G.cut_between(e, _labels(x, e))
    return kept.select("a", "b", F.lit(True).alias("kept")).union(pruned.select("a", "b", F.lit(False)))


@query(f"SELECT community, node, degree FROM (SELECT *, max(degree) OVER (PARTITION BY community) AS top FROM (SELECT community, node, CAST(count(*) AS BIGINT) AS degree FROM (SELECT x.community, unnest([a, b]) AS node FROM edges JOIN {LABELS} x ON a = x.node JOIN {LABELS} y ON b = y.node AND x.community = y.community) GROUP BY 1, 2)) WHERE degree < 0.6 * top", "edges reach")
def g7_weak_nodes(x: Fixtures):
    e = G.cut_lineage(_edges(x))
    return G.weak_nodes(G.cut_between(e, _labels(x, e))[0], 0.6)


@query("SELECT community, study, node FROM (SELECT *, row_number() OVER (PARTITION BY community, study ORDER BY min_p, node) AS r FROM (SELECT p_partkey AS node, p_size % 7 AS community, p_partkey % 40 AS study, round(p_retailprice % 10, 4) AS min_p FROM part)) WHERE r = 1")
def g8_one_per_study(x: Fixtures):
    t = x.table("part").select(F.col("p_partkey").alias("node"), (F.col("p_size") % 7).alias("community"), (F.col("p_partkey") % 40).alias("study"), F.round(F.col("p_retailprice") % 10, 4).alias("min_p"))
    return G.one_per_study(t).select("community", "study", "node")


@query("SELECT e.a, e.b FROM edges e WHERE e.a % 11 = 0 OR e.b % 11 = 0", "edges")
def g9_edges_of_removed(x: Fixtures):
    e = _edges(x)
    gone = e.select(F.explode(F.array("a", "b")).alias("node")).where("node % 11 = 0").distinct()
    touch = e.join(gone.withColumnRenamed("node", "a"), "a", "left_semi").unionByName(e.join(gone.withColumnRenamed("node", "b"), "b", "left_semi"))
    return touch.select("a", "b").distinct()


@query("SELECT a, b, (a + b) % 3 = 0 AND h4 > 0.8 AS false_positive, a % 6 = b % 6 AND h4 < 0.8 AS false_negative FROM pairs", "pairs")
def g10_verdicts(x: Fixtures):
    p = x.pairs
    comp = x.table("supplier").select(F.col("s_suppkey").cast("long").alias("node"), (F.col("s_suppkey") % 6).alias("component"))
    return G.verdicts(p, comp, p.where("(a + b) % 3 = 0")).select("a", "b", "false_positive", "false_negative")


@query("SELECT DISTINCT CASE WHEN pa > pb OR (pa = pb AND a > b) THEN a ELSE b END AS node FROM (SELECT a, b, pow(10.0, -(3 + a % 8)) AS pa, pow(10.0, -(3 + b % 8)) AS pb, h4 FROM pairs WHERE a % 9 = b % 9) WHERE h4 >= 0.8", "pairs")
def g11_weaker_of_same_study(x: Fixtures):
    p = _min_p(x)
    e = x.pairs.where("a % 9 = b % 9 AND h4 >= 0.8").join(p.toDF("a", "pa"), "a").join(p.toDF("b", "pb"), "b")
    weak = (F.col("pa") > F.col("pb")) | ((F.col("pa") == F.col("pb")) & (F.col("a") > F.col("b")))
    return e.select(F.when(weak, F.col("a")).otherwise(F.col("b")).alias("node")).distinct()


@query("SELECT r.component, arg_min(b.snp, {'a': -b.s, 'b': b.snp}) AS snp FROM (SELECT DISTINCT blk % 3 AS component FROM lbf) r JOIN (SELECT blk % 3 AS component, snp, round(sum(lbf), 6) AS s FROM lbf GROUP BY 1, 2) b USING (component) GROUP BY r.component", "lbf")
def g12_cluster_lead(x: Fixtures):
    s = x.lbf.groupBy((F.col("blk") % 3).alias("component"), "snp").agg(F.round(F.sum("lbf"), 6).alias("s"))
    return s.groupBy("component").agg(F.min_by("snp", F.struct(-F.col("s"), "snp")).alias("snp"))


@query("SELECT node AS variant, component AS representative FROM reach", "edges reach")
def g13_merged_variants(x: Fixtures):
    ld = _edges(x).select(F.col("a").alias("lead"), F.col("b").alias("proxy"), F.lit(0.999).alias("r"))
    return G.merged_variants(ld)


@query("SELECT c.component, c.n AS n_nodes, e.n AS n_edges, round(e.w, 6) AS mean_weight, round(2 * e.n / (c.n * (c.n - 1)), 6) AS density, round(CASE WHEN p.k > 0 THEN 3 * coalesce(t.k, 0) / p.k ELSE 0 END, 6) AS transitivity FROM (SELECT component, CAST(count(*) AS BIGINT) AS n FROM reach GROUP BY 1) c JOIN (SELECT component, CAST(count(*) AS BIGINT) AS n, avg(w) AS w FROM edges JOIN reach ON a = node GROUP BY 1) e USING (component) LEFT JOIN (SELECT component, sum(d * (d - 1) / 2) AS k FROM (SELECT node, count(*) AS d FROM (SELECT unnest([a, b]) AS node FROM edges) GROUP BY 1) JOIN reach USING (node) GROUP BY 1) p USING (component) LEFT JOIN (SELECT component, count(*) AS k FROM edges x JOIN edges y ON x.b = y.a JOIN edges z ON z.a = x.a AND z.b = y.b JOIN reach ON x.a = node GROUP BY 1) t USING (component)", "edges reach")
def g14_measures(x: Fixtures):
    e = G.cut_lineage(_edges(x))
    m = G.measures(e, G.components(e))
    return m.select("component", "n_nodes", "n_edges", *[F.round(c, 6).alias(c) for c in ("mean_weight", "density", "transitivity")])


@query(f"SELECT community, round(sum(CASE WHEN out THEN w ELSE 0 END) / sum(w), 6) AS conductance FROM (SELECT x.community, x.community <> y.community AS out, w FROM (SELECT a, b, w FROM edges UNION ALL SELECT b, a, w FROM edges) JOIN {LABELS} x ON a = x.node JOIN {LABELS} y ON b = y.node) GROUP BY 1", "edges reach")
def g14_conductance(x: Fixtures):
    e = G.cut_lineage(_edges(x))
    return G.conductance(e, _labels(x, e)).select("community", F.round("conductance", 6).alias("conductance"))


_PER_COMPONENT = "SELECT c.component, c.n, e.w AS mean_weight, CASE WHEN p.k > 0 THEN 3 * coalesce(t.k, 0) / p.k ELSE 0 END AS transitivity, (o.w - e.s) / o.w AS conductance FROM (SELECT component, count(*) AS n FROM spread GROUP BY 1) c JOIN (SELECT component, avg(w) AS w, sum(w) AS s FROM strong JOIN spread ON a = node GROUP BY 1) e USING (component) JOIN (SELECT component, sum(w) AS w FROM (SELECT DISTINCT component, a, b, w FROM edges JOIN spread ON node = a OR node = b) GROUP BY 1) o USING (component) LEFT JOIN (SELECT component, sum(d * (d - 1) / 2) AS k FROM (SELECT node, count(*) AS d FROM (SELECT unnest([a, b]) AS node FROM strong) GROUP BY 1) JOIN spread USING (node) GROUP BY 1) p USING (component) LEFT JOIN (SELECT component, count(*) AS k FROM strong x JOIN strong y ON x.b = y.a JOIN strong z ON z.a = x.a AND z.b = y.b JOIN spread ON x.a = node GROUP BY 1) t USING (component)"


@query(f"SELECT CAST(count(*) AS BIGINT) AS n_components, round(avg(mean_weight), 6) AS mean_weight, round(avg(transitivity), 6) AS mean_transitivity, round(avg(conductance), 6) AS mean_conductance, median(n) AS median_size FROM ({_PER_COMPONENT})", "edges strong spread")
def g14_summary(x: Fixtures):
    """Means and median over the components of a pruned graph, their conductance against the graph before."""
    e = G.cut_lineage(_edges(x))
    kept = e.where("w >= 0.7")
    out = G.summary(kept, G.components(kept), e)
    return out.select("n_components", *[F.round(c, 6).alias(c) for c in ("mean_weight", "mean_transitivity", "mean_conductance")], "median_size")


@query()
def g15_centralities(x: Fixtures):
    e = _edges(x)
    return G.centralities(e.join(G.components(e).toDF("a", "component"), "a").select("component", "a", "b"))


@query(f"SELECT component, CAST(count(DISTINCT community) AS BIGINT) AS n_communities, CAST(count(*) AS BIGINT) AS n FROM reach JOIN {LABELS} USING (node) GROUP BY 1 HAVING count(DISTINCT community) > 1 AND count(*) < 100 ORDER BY n DESC, component LIMIT 3", "edges reach")
def g16_split_candidates(x: Fixtures):
    c = G.components(_edges(x)).withColumn("community", F.col("component") * 10 + F.col("node") % 2)
    n = c.groupBy("component").agg(F.countDistinct("community").alias("n_communities"), F.count("*").alias("n"))
    return n.where("n_communities > 1 AND n < 100").orderBy(F.desc("n"), "component").limit(3)
