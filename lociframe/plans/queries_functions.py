"""Queries of the scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..constants import EDGE_LOGP
from ..fixtures import Fixtures
from ..functions import scalar as S
from ..operators import aggregates as A
from .registry import query

KEY = ["study", "chr", "bp", "ok", "pk"]
K = ", ".join(KEY)


def _r(c, n: int, name: str):
    return F.round(c, n).alias(name)


@query(f"SELECT {K}, concat(chr, ':', bp, '_', trim(ea), '_', trim(oa)) AS snp FROM sumstats", "sumstats")
def f1_snp_key(x: Fixtures):
    return x.sumstats.select(*KEY, S.snp_key("chr", "bp", "ea", "oa").alias("snp"))


@query()
def f2_compressed_alleles(x: Fixtures):
    return x.table("supplier").select("s_suppkey", S.compress_allele("s_name").alias("allele"))


@query("SELECT ld_block, split_part(ld_block, '/', 1) AS anc, CAST(chr AS INTEGER) AS chr, start, stop, concat('EUR_', chr, '_', start, '_', stop) AS flat FROM blocks", "blocks")
def f3_block_names(x: Fixtures):
    p = S.block_parts("ld_block")
    return x.blocks.select("ld_block").select("ld_block", p["ancestry"].alias("anc"), p["chr"].alias("chr"), p["start"].alias("start"), p["stop"].alias("stop"), S.flat_block("ld_block").alias("flat"))


@query("SELECT p_partkey, regexp_replace(p_name, '[aeiou]', '*') AS first_only, regexp_replace(p_name, '[aeiou]', '*', 'g') AS every, regexp_matches(p_name, '[0-9]$') AS digit FROM part")
def f4_regex(x: Fixtures):
    return x.table("part").select("p_partkey", S.sub_first("p_name", "[aeiou]", "*").alias("first_only"), F.regexp_replace("p_name", "[aeiou]", "*").alias("every"), F.col("p_name").rlike("[0-9]$").alias("digit"))


@query("SELECT o_orderkey, concat(strftime(o_orderdate, '%Y-%m-%d'), '_', o_orderkey, '_x') AS name FROM orders")
def f5_keep_two_dashes(x: Fixtures):
    name = F.concat(F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("-"), "o_orderkey", F.lit("-x"))
    return x.table("orders").select("o_orderkey", S.keep_two_dashes(name).alias("name"))


@query("SELECT n_nationkey, split_part(concat(n_name, ', ', n_regionkey), ',', 1) AS head, split_part(concat(n_name, '_', n_regionkey), '_', 1) AS stem FROM nation")
def f6_before_mark(x: Fixtures):
    return x.table("nation").select("n_nationkey", S.before(F.concat("n_name", F.lit(", "), "n_regionkey"), ",").alias("head"), S.before(F.concat("n_name", F.lit("_"), "n_regionkey"), "_").alias("stem"))


@query("SELECT c_custkey, upper(trim(c_name)) AS up, lower(c_mktsegment) AS low, CAST(length(c_name) AS INTEGER) AS n, substr(c_name, 1, 4) AS head, starts_with(c_name, 'Cust') AS cust FROM customer")
def f7_string_basics(x: Fixtures):
    return x.table("customer").select("c_custkey", F.upper(F.trim("c_name")).alias("up"), F.lower("c_mktsegment").alias("low"), F.length("c_name").alias("n"), F.substring("c_name", 1, 4).alias("head"), F.startswith("c_name", F.lit("Cust")).alias("cust"))


_INDEL = "SELECT p_partkey AS k, p_partkey * 3 AS pos, CASE WHEN p_partkey % 3 = 0 THEN 'A' WHEN p_partkey % 3 = 1 THEN 'ACGT' ELSE 'G' END AS r, CASE WHEN p_partkey % 3 = 0 THEN 'ATT' WHEN p_partkey % 3 = 1 THEN 'A' ELSE 'T' END AS a FROM part"


@query(f"SELECT k, CASE WHEN k % 3 < 2 THEN pos + 1 ELSE pos END AS pos1, CASE WHEN k % 3 = 1 THEN pos + 1 + 4 - 2 ELSE pos END AS pos2, CASE k % 3 WHEN 0 THEN '-' WHEN 1 THEN 'CGT' ELSE r END AS ref, CASE k % 3 WHEN 0 THEN 'TT' WHEN 1 THEN '-' ELSE a END AS alt FROM ({_INDEL})")
def f8_indel_positions(x: Fixtures):
    m = F.col("p_partkey") % 3
    t = x.table("part").select(F.col("p_partkey").alias("k"), (F.col("p_partkey") * 3).alias("pos"), F.when(m == 0, "A").when(m == 1, "ACGT").otherwise("G").alias("r"), F.when(m == 0, "ATT").when(m == 1, "A").otherwise("T").alias("a"))
    return t.select("k", S.fix_indel("pos", "pos", "r", "a").alias("s")).select("k", "s.*")


@query(f"SELECT {K}, concat(chr, ':', bp, '_', least(ea, oa), '_', greatest(ea, oa)) AS name FROM sumstats", "sumstats")
def f9_variant_name(x: Fixtures):
    return x.sumstats.select(*KEY, S.variant_name("chr", "bp", "ea", "oa").alias("name"))


@query("SELECT s_suppkey, s_name AS symbol, CAST(s_nationkey AS VARCHAR) AS nation, CAST(NULL AS VARCHAR) AS absent FROM supplier")
def f10_annotation_keys(x: Fixtures):
    extra = F.concat(F.lit("IMPACT=LOW;SYMBOL="), "s_name", F.lit(";EUR_AF=0.1;NATION="), "s_nationkey")
    get = lambda k: F.try_element_at(F.str_to_map(extra, F.lit(";"), F.lit("=")), F.lit(k))
    return x.table("supplier").select("s_suppkey", S.annotation(extra, "SYMBOL").alias("symbol"), S.annotation(extra, "NATION").alias("nation"), get("GONE").alias("absent"))


@query("SELECT n_nationkey, concat(lower(n_name), '.tsv') AS file, lower(n_name) AS stem FROM nation")
def f11_base_name(x: Fixtures):
    path = F.concat(F.lit("/data//studies/"), F.lower("n_name"), F.lit(".tsv"))
    return x.table("nation").select("n_nationkey", S.base_name(path).alias("file"), S.base_name(path, "\\.tsv").alias("stem"))


@query(f"SELECT {K}, round(ln(se), 8) AS l, round(log10(se), 8) AS l10, round(exp(beta), 8) AS e, round(sqrt(se), 8) AS s, round(pow(beta, 2), 8) AS p, CAST(floor(beta * 10) AS BIGINT) AS f FROM sumstats", "sumstats")
def f12_math(x: Fixtures):
    b, s = F.col("beta"), F.col("se")
    return x.sumstats.select(*KEY, _r(F.log(s), 8, "l"), _r(F.log10(s), 8, "l10"), _r(F.exp(b), 8, "e"), _r(F.sqrt(s), 8, "s"), _r(F.pow(b, F.lit(2)), 8, "p"), F.floor(b * 10).cast("long").alias("f"))


@query(f"SELECT {K}, round({S.erfc_sql('(abs(beta / se) / sqrt(2.0::DOUBLE))')}, 8) AS p FROM sumstats", "sumstats")
def f13_two_sided_p(x: Fixtures):
    return x.sumstats.select(*KEY, _r(S.two_sided_p(F.col("beta") / F.col("se")), 8, "p"))


@query(f"SELECT {K}, round(beta - 1.959963984540054 * se, 8) AS low, round(beta + 1.959963984540054 * se, 8) AS high FROM sumstats", "sumstats")
def f14_normal_quantile(x: Fixtures):
    return x.sumstats.select(*KEY, _r(F.col("beta") - S.Z_975 * F.col("se"), 8, "low"), _r(F.col("beta") + S.Z_975 * F.col("se"), 8, "high"))


@query(f"SELECT {K}, round(ln(eaf + 1), 8) AS beta, round((ln(eaf + 0.5) - ln(eaf + 1)) / -1.959963984540054, 8) AS se FROM sumstats", "sumstats")
def f15_odds_to_beta(x: Fixtures):
    o = S.odds_to_beta(F.col("eaf") + 1, F.col("eaf") + 0.5)
    return x.sumstats.select(*KEY, _r(o["beta"], 8, "beta"), _r(o["se"], 8, "se"))


@query("SELECT l_orderkey, l_linenumber, l_partkey, round(ln(CASE WHEN l_tax = 0 THEN 0.01 ELSE l_tax END), 8) AS beta, CASE WHEN l_tax IN (0, 0.01) THEN 0 ELSE round((ln(l_tax + 1) - ln(l_tax)) / 1.96, 8) END AS se FROM lineitem")
def f16_odds_to_beta_rare(x: Fixtures):
    o = S.odds_to_beta_rare("l_tax", F.col("l_tax") + 1)
    return x.table("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", _r(o["beta"], 8, "beta"), _r(o["se"], 8, "se"))


@query("SELECT o_orderkey, round(CASE WHEN o_orderkey % 50 = 0 THEN 0 ELSE o_orderkey % 50 / 10 END, 4) AS lp, CASE WHEN o_orderkey % 50 = 0 THEN 1.0 ELSE round(pow(10.0, -(o_orderkey % 50 / 10)), 8) END AS p FROM orders")
def f17_p_from_log(x: Fixtures):
    lp = F.col("o_orderkey") % 50 / F.lit(10.0)
    return x.table("orders").select("o_orderkey", _r(lp, 4, "lp"), _r(S.p_from_log(lp), 8, "p"))


@query(f"SELECT {K}, least(ea, oa) AS ea, greatest(ea, oa) AS oa, round(CASE WHEN ea > oa THEN 1 - eaf ELSE eaf END, 6) AS eaf, round(CASE WHEN ea > oa THEN -beta ELSE beta END, 6) AS beta FROM sumstats", "sumstats")
def f18_standard_alleles(x: Fixtures):
    t = x.sumstats.select(*KEY, S.standard_alleles("ea", "oa", "eaf", "beta", "beta").alias("s"))
    return t.select(*KEY, "s.ea", "s.oa", _r("s.eaf", 6, "eaf"), _r("s.beta", 6, "beta"))


@query("SELECT l_orderkey, l_linenumber, l_partkey, round(l_discount / CASE WHEN l_tax = 0 THEN 1e-5 ELSE l_tax END, 4) AS z FROM lineitem")
def f19_z_score(x: Fixtures):
    return x.table("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", _r(S.z_score("l_discount", "l_tax"), 4, "z"))


@query(f"SELECT {K}, round((ln(1 - r) + r * pow(beta / se, 2)) / 2, 6) AS lbf FROM (SELECT *, 0.04 / (0.04 + se * se) AS r FROM sumstats)", "sumstats")
def f20_bayes_factor(x: Fixtures):
    return x.sumstats.select(*KEY, _r(S.bayes_factor(F.col("beta") / F.col("se"), "se", F.lit(0.2)), 6, "lbf"))


@query("SELECT study, snp, round(sqrt(greatest((2 * lbf - ln(sqrt(1 - r))) / r, 0)), 5) AS z FROM (SELECT *, 50.0 / (50.0 + (0.1 + snp / 100.0) * (0.1 + snp / 100.0)) AS r FROM lbf)", "lbf")
def f21_z_from_lbf(x: Fixtures):
    return x.lbf.select("study", "snp", _r(S.abs_z_from_lbf("lbf", F.lit(0.1) + F.col("snp") / 100.0), 5, "z"))


@query(f"SELECT {K}, round(pow((least(greatest(-log10(eaf * eaf * 0.0001), {EDGE_LOGP[0]}), {EDGE_LOGP[1]}) - {EDGE_LOGP[0]}) / ({EDGE_LOGP[1]} - {EDGE_LOGP[0]}), 4) * 0.5 + 0.5, 6) AS w FROM sumstats", "sumstats")
def f22_edge_weight(x: Fixtures):
    return x.sumstats.select(*KEY, _r(S.edge_weight(F.col("eaf") * F.col("eaf") * 0.0001), 6, "w"))


@query(f"SELECT {K}, round(bp / 10000000 * 800, 4) AS px, round(300 - 10 - beta / 0.3 * 300, 4) AS py FROM sumstats", "sumstats")
def f23_pixels(x: Fixtures):
    return x.sumstats.select(*KEY, _r(S.pixel("bp", F.lit(10_000_000), 800.0), 4, "px"), _r(S.pixel("beta", F.lit(0.3), 300.0, inverted=True, margin=10.0), 4, "py"))


@query(f"SELECT {K}, round(exp(beta), 6) AS estimate, round(exp(beta - 1.96 * se), 6) AS low, round(exp(beta + 1.96 * se), 6) AS high FROM sumstats", "sumstats")
def f24_wald(x: Fixtures):
    w = S.wald("beta", "se")
    return x.sumstats.select(*KEY, *[_r(w[c], 6, c) for c in ("estimate", "low", "high")])


@query("SELECT o_orderkey, o_orderdate < TIMESTAMP '1996-01-01' AS old, strftime(o_orderdate, '%Y-%m') AS month FROM orders")
def f25_dates(x: Fixtures):
    return x.table("orders").select("o_orderkey", (F.to_date("o_orderdate") < F.lit("1996-01-01").cast("date")).alias("old"), F.date_format("o_orderdate", "yyyy-MM").alias("month"))


@query("SELECT study, CAST(count(*) AS INTEGER) AS n, CAST(count(DISTINCT gene) AS INTEGER) AS k FROM members GROUP BY study", "members")
def f26_arrays(x: Fixtures):
    lists = x.members.groupBy("study", "gene").agg(F.collect_list("gene").alias("g")).groupBy("study").agg(F.flatten(F.collect_list("g")).alias("g"))
    return lists.select("study", F.size("g").alias("n"), F.size(F.array_distinct("g")).alias("k"))


@query("SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'filled' WHEN 'O' THEN 'open' END AS status FROM orders")
def f27_map_lookup(x: Fixtures):
    table = F.create_map(F.lit("F"), F.lit("filled"), F.lit("O"), F.lit("open"))
    return x.table("orders").select("o_orderkey", F.try_element_at(table, F.col("o_orderstatus")).alias("status"))


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, concat('{\"id\":', event_id, ',\"type\":\"', event_type, '\"}') AS json FROM events")
def f28_json(x: Fixtures):
    k = F.from_json("props", "k long")["k"]
    return x.table("events").select("event_id", k.alias("k"), F.to_json(F.struct(F.col("event_id").alias("id"), F.col("event_type").alias("type"))).alias("json"))


@query("SELECT k, g, p, round(least(1.0, min(p * n / r) OVER (PARTITION BY g ORDER BY p DESC RANGE UNBOUNDED PRECEDING)), 8) AS q FROM (SELECT *, count(*) OVER (PARTITION BY g ORDER BY p RANGE UNBOUNDED PRECEDING) AS r, count(*) OVER (PARTITION BY g) AS n FROM (SELECT p_partkey AS k, p_size % 5 AS g, round((p_partkey * 7919 % 10007 + 1) / 10010.0, 8) AS p FROM part))")
def f29_fdr(x: Fixtures):
    t = x.table("part").select(F.col("p_partkey").alias("k"), (F.col("p_size") % 5).alias("g"), F.round((F.col("p_partkey") * 7919 % 10007 + 1).cast("double") / 10010.0, 8).alias("p"))
    return A.fdr(t, "p", ["g"]).select("k", "g", "p", _r("q", 8, "q"))


@query(f"SELECT {K}, round(beta / se * se, 6) AS beta_from_z FROM sumstats", "sumstats")
def f30_beta_from_z(x: Fixtures):
    return x.sumstats.select(*KEY, _r(S.z_score("beta", "se") * F.col("se"), 6, "beta_from_z"))


@query("SELECT p_partkey, CASE WHEN regexp_matches(p_type, '(?i)brass') THEN 'metal-b' WHEN regexp_matches(p_type, '(?i)s.*l') THEN 'sl' WHEN regexp_matches(p_type, '(?i)copper') THEN 'metal-c' ELSE p_type END AS cls FROM part")
def f31_keyword_class(x: Fixtures):
    return x.table("part").select("p_partkey", S.keyword_class("p_type", [("copper", "metal-c"), ("s.*l", "sl"), ("BRASS", "metal-b")]).alias("cls"))


@query("SELECT l_orderkey, l_linenumber, l_partkey, CAST((l_tax > 0.04)::INT + (l_discount > 0.05)::INT + (l_quantity > 25)::INT AS INTEGER) AS n FROM lineitem")
def f32_count_true(x: Fixtures):
    return x.table("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", S.count_true(F.col("l_tax") > 0.04, F.col("l_discount") > 0.05, F.col("l_quantity") > 25, F.lit(None).cast("boolean")).alias("n"))


@query("SELECT n_nationkey, CASE WHEN n_regionkey = 0 THEN NULL WHEN n_name < 'M' THEN concat(n_name, ';M') ELSE concat('M;', n_name) END AS items FROM nation")
def f33_tidy_list(x: Fixtures):
    raw = F.when(F.col("n_regionkey") == 0, " ;").otherwise(F.concat("n_name", F.lit("; M ;"), "n_name"))
    return x.table("nation").select("n_nationkey", S.tidy_list(raw).alias("items"))
