"""Queries of sources, sinks, warehouse composites and the queue worker."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import scratch
from ..fixtures import Fixtures
from ..functions import scalar as S
from ..operators import filters as FL
from ..operators import joins as J
from ..operators import reshape as R
from ..operators import windows as W
from ..sources import positions as POS
from ..sources import readers as RD
from ..sources import releases as REL
from ..sources import sinks as SK
from ..streaming import queue as Q
from ..streaming import uploads as U
from . import warehouse as D
from .registry import query

P = S.erfc_sql("(abs(beta / se) / sqrt(2.0::DOUBLE))")


def _with_p(x: Fixtures):
    return x.snps.withColumn("p", F.round(S.two_sided_p(F.col("beta") / F.col("se")), 8))


WITH_P = f"(SELECT study, chr, bp, beta, se, eaf, round({P}, 8) AS p FROM snps)"


# ---- sources and sinks ----------------------------------------------------------------------------------------


def _lines(x: Fixtures, lines: DataFrame, name: str, **options) -> str:
    """Path of a fresh folder of text files with the one string column of ``lines``."""
    path = scratch.fresh(x.spark, name)
    lines.write.options(**options).text(path)
    return path


@query("SELECT c_custkey AS id, concat('chr', c_nationkey % 22 + 1) AS chr FROM customer")
def src1_text_rows(x: Fixtures):
    """Compressed delimited files with other columns in between; only two of them reach the parser."""
    t = x.table("customer").select(F.col("c_custkey").alias("id"), "c_name", F.concat(F.lit("chr"), F.col("c_nationkey") % 22 + 1).alias("chr"))
    path = scratch.fresh(x.spark, "customers")
    SK.write_tsv(t, path)
    return RD.delimited(x.spark, path, T.StructType.fromDDL("id long, name string, chr string"), columns=["id", "chr"])


@query("SELECT l_orderkey, l_tax FROM lineitem")
def src2_projected_scan(x: Fixtures):
    return x.table("lineitem").select("l_orderkey", "l_tax")


@query("SELECT n_nationkey AS k, n_name AS name, NULL AS extra FROM nation UNION ALL SELECT r_regionkey, r_name, r_name FROM region")
def src3_union_scan(x: Fixtures):
    """One scan over files of which one lacks the last column and one isn't there."""
    paths = [scratch.fresh(x.spark, n) for n in ("nations", "regions", "absent")]
    SK.write_tsv(x.table("nation").select(F.col("n_nationkey").alias("k"), F.col("n_name").alias("name")), paths[0])
    SK.write_tsv(x.table("region").select(F.col("r_regionkey").alias("k"), F.col("r_name").alias("name"), F.col("r_name").alias("extra")), paths[1])
    return RD.union_of(x.spark, paths, T.StructType.fromDDL("k long, name string, extra string"))


@query("SELECT o_orderkey AS k, o_orderstatus AS status FROM orders")
def src4_many_files(x: Fixtures):
    """Text files of one table, sixteen of them, read as one."""
    t = x.table("orders").select(F.concat_ws("\t", "o_orderkey", "o_orderstatus"))
    return RD.delimited(x.spark, _lines(x, t.repartition(16), "orders"), T.StructType.fromDDL("k long, status string"), header=False)


@query("SELECT concat('n_name=', n_name) AS folder, CAST(1 AS BIGINT) AS files FROM nation")
def src5_discovery(x: Fixtures):
    path = scratch.fresh(x.spark, "nations")
    x.table("nation").select("n_name", F.col("n_regionkey").cast("string").alias("v")).coalesce(1).write.partitionBy("n_name").text(path)
    found = RD.discover(x.spark, path, "*.txt")
    return found.select(F.url_decode(F.regexp_extract("path", "/(n_name=[^/]*)/", 1)).alias("folder")).groupBy("folder").agg(F.count("*").alias("files"))


@query("SELECT n_name AS trait, CAST(n_regionkey AS BIGINT) AS n, 'EUR' AS ancestry FROM nation WHERE n_regionkey <> 2")
def src6_json_metadata(x: Fixtures):
    """One JSON file for each study, over several lines; those without the required field are left out, a default fills another."""
    n = F.when(F.col("n_regionkey") != 2, F.format_string('{\n "trait": "%s",\n "n": %d\n}', "n_name", "n_regionkey")).otherwise(F.format_string('{\n "trait": "%s"\n}', "n_name"))
    path = scratch.fresh(x.spark, "metadata")
    x.table("nation").select(F.col("n_nationkey").alias("f"), n.alias("value")).coalesce(1).write.partitionBy("f").text(path)
    schema = T.StructType.fromDDL("trait string, n long, ancestry string")
    return RD.sidecars(x.spark, f"{path}/*/", schema, ["n"], {"ancestry": "EUR"}).select("trait", "n", "ancestry")


@query("SELECT CAST(s_suppkey AS BIGINT) AS \"X1\", s_name AS \"X2\" FROM supplier")
def src7_headerless(x: Fixtures):
    path = _lines(x, x.table("supplier").select(F.concat_ws("\t", "s_suppkey", "s_name")), "suppliers")
    return RD.numbered_columns(x.spark, path, "long string")


@query("SELECT s_suppkey, round(s_suppkey / 1000, 4) AS heritability, 0.01 AS heritability_se FROM supplier WHERE s_suppkey % 2 = 0")
def src8_log_scrape(x: Fixtures):
    h = F.format_string("Total Observed scale h2: %.4f (0.0100)", F.col("s_suppkey") / 1000.0)
    lines = x.table("supplier").select("s_suppkey", F.when(F.col("s_suppkey") % 2 == 0, h).otherwise("done").alias("value"))
    return RD.heritability(lines, over=["s_suppkey"])


_VCF = "SELECT study, chr, bp, round(beta, 6) AS beta, round(-log10(greatest(eaf, 0.0001)), 4) AS lp FROM snps"


def _vcf(x: Fixtures):
    lp = F.format_string("%.4f", -F.log10(F.greatest("eaf", F.lit(0.0001))))
    line = F.concat_ws("\t", F.concat(F.lit("chr"), "chr"), "bp", F.concat(F.lit("rs"), "study"), F.lit("A"), F.lit("G"), F.lit("."), F.lit("PASS"), F.lit("."), F.lit("ES:SE:LP"), F.concat_ws(":", F.format_string("%.6f", "beta"), F.format_string("%.6f", "se"), lp))
    head = x.spark.createDataFrame([("##fileformat=VCFv4.2",), ("#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\tS",)], "value string")
    path = _lines(x, head.union(x.snps.select(line)), "vcf")
    return RD.vcf(x.spark, path).withColumn("study", F.regexp_replace("id", "rs", "").cast("long")).withColumn("chr", F.col("chr").cast("long"))


@query(f"SELECT study, s.chr, bp, beta FROM ({_VCF}) s JOIN blocks b ON s.chr = b.chr AND bp >= start AND bp <= stop WHERE start = 2000000", "snps blocks")
def src9_vcf_regions(x: Fixtures):
    """Rows of regions, from a VCF body stored by position: only the files of the regions' bins are read."""
    path = scratch.fresh(x.spark, "vcf-index")
    POS.write(_vcf(x).select("study", "chr", "bp", "beta"), path)
    b = x.blocks.where("start = 2000000").select("chr", "start", "stop")
    return POS.within(x.spark, path, b).select("study", "chr", "bp", "beta")


@query(f"SELECT study, chr, bp, lp FROM ({_VCF}) WHERE lp >= 1", "snps")
def src10_vcf_significant(x: Fixtures):
    return RD.vcf_below(_vcf(x), 0.1).select("study", "chr", "bp", "lp")


@query(f"SELECT study, chr, bp FROM {WITH_P} WHERE study = 3 AND abs(bp - 4000000) <= 2000000 AND p <= 0.05", "snps")
def src11_window_query(x: Fixtures):
    """Rows of a probe in a window, from a table stored by position: the probe's bins within the window are read."""
    path = scratch.fresh(x.spark, "probes")
    POS.write(_with_p(x).withColumn("probe", F.col("study").cast("string")), path, probe="probe")
    return POS.of_probe(x.spark, path, "3", center=4_000_000, window_kb=2000, p=0.05).select("study", "chr", "bp")


@query("SELECT l_orderkey, l_partkey, l_quantity FROM lineitem WHERE l_returnflag = 'R' AND l_linestatus = 'F' AND l_quantity > 40")
def src12_matrix_entries(x: Fixtures):
    return RD.long_entries(x.table("lineitem"), {"l_returnflag": "R", "l_linestatus": "F"}, F.col("l_quantity") > 40).select("l_orderkey", "l_partkey", "l_quantity")


@query("SELECT p_partkey AS gene_id, p_size AS size FROM part WHERE p_brand = 'Brand#11'")
def src13_parquet_gene(x: Fixtures):
    return x.table("part").where("p_brand = 'Brand#11'").select(F.col("p_partkey").alias("gene_id"), F.col("p_size").alias("size"))


@query("SELECT s.category, CAST(count(*) AS BIGINT) AS n FROM pairs p JOIN studies s ON p.a = s.study GROUP BY 1", "pairs studies")
def src14_cross_database(x: Fixtures):
    RD.attach(x.spark, "other", {"studies": x.studies})
    x.pairs.createOrReplaceTempView("coloc_pairs_here")
    return x.spark.sql("SELECT s.category, count(*) AS n FROM coloc_pairs_here p JOIN other_studies s ON p.a = s.study GROUP BY s.category")


@query("SELECT blk, CAST(count(*) AS BIGINT) AS n, round(sum(lbf), 4) AS total FROM lbf GROUP BY blk", "lbf")
def src15_array_objects(x: Fixtures):
    """Vectors kept as array columns, opened again."""
    packed = x.lbf.groupBy("study", "blk").agg(F.transform(F.sort_array(F.collect_list(F.struct("snp", "lbf"))), lambda s: s["lbf"]).alias("v"))
    return packed.select("blk", F.explode("v").alias("lbf")).groupBy("blk").agg(F.count("*").alias("n"), F.round(F.sum("lbf"), 4).alias("total"))


@query("SELECT chunk, min(i) AS start_id, max(i) AS end_id, CAST(count(*) AS BIGINT) AS n FROM (SELECT i, CAST(floor((i - 1) / 500) AS BIGINT) AS chunk FROM (SELECT dense_rank() OVER (ORDER BY variant) AS i FROM (SELECT DISTINCT variant FROM members))) GROUP BY chunk", "members")
def snk7_chunk_ranges(x: Fixtures):
    v = x.members.select("variant").distinct()
    return SK.chunk_ranges(R.chunks(W.dense_numbers(v, "variant", "i"), "i", 500), "i")


@query("SELECT concat('{\"n_nationkey\":', n_nationkey, ',\"n_name\":\"', n_name, '\",\"note\":null}') AS json FROM nation")
def snk8_json_rows(x: Fixtures):
    return SK.json_rows(x.table("nation").withColumn("note", F.lit(None).cast("string")), ["n_nationkey", "n_name", "note"])


@query("SELECT p_partkey, concat('<url><loc>https://example.org/gene/', p_partkey, '</loc></url>') AS line FROM part")
def snk9_sitemap(x: Fixtures):
    return SK.sitemap(x.table("part"), "https://example.org", "gene", "p_partkey")


@query("SELECT s_suppkey, CASE WHEN s_nationkey = 3 THEN 'https://example.org/3' ELSE s_name END AS url FROM supplier")
def snk5_update_where(x: Fixtures):
    """A stored table after an update in place; partitions without a row that meets the condition keep their files."""
    path = scratch.fresh(x.spark, "updated")
    t = x.table("supplier").select("s_suppkey", F.col("s_name").alias("url"), "s_nationkey", (F.col("s_suppkey") % 8).cast("int").alias("part"))
    REL.write_partitioned(t, path, "part")
    REL.update_where(x.spark, path, "part", F.col("s_nationkey") == 3, url=F.lit("https://example.org/3"))
    return x.spark.read.parquet(path).select("s_suppkey", "url")


@query("SELECT variant, CAST(floor(variant / 100) AS BIGINT) AS bin, n FROM (SELECT variant, CAST(count(*) AS BIGINT) AS n FROM members GROUP BY variant)", "members")
def snk10_plot_series(x: Fixtures):
    n = x.members.groupBy("variant").agg(F.count("*").alias("n"))
    return n.select("variant", F.floor(F.col("variant") / 100).cast("long").alias("bin"), "n")


@query("SELECT reason, CAST(count(*) AS BIGINT) AS n FROM (SELECT CASE WHEN s THEN 'missing' WHEN c > 1 THEN 'repeated' ELSE 'clean' END AS reason FROM (SELECT l_orderkey % 97 = 0 AS s, count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS c FROM lineitem)) GROUP BY reason")
def snk12_quarantine(x: Fixtures):
    t = x.table("lineitem").select("l_orderkey", "l_linenumber", F.when(F.col("l_orderkey") % 97 != 0, F.col("l_tax")).alias("tax"))
    clean, bad = SK.split_clean(t, ["l_orderkey", "l_linenumber"], ["tax"])
    return clean.select(F.lit("clean").alias("reason")).union(bad.select("reason")).groupBy("reason").agg(F.count("*").alias("n"))


@query("SELECT n_nationkey AS k FROM nation UNION ALL SELECT r_regionkey FROM region")
def snk2_append(x: Fixtures):
    path = scratch.fresh(x.spark, "appended")
    for name, key in (("nation", "n_nationkey"), ("region", "r_regionkey")):
        SK.write_tsv(x.table(name).select(F.col(key).alias("k")), path, "append")
    return RD.delimited(x.spark, path, T.StructType.fromDDL("k long"))


def _table(x: Fixtures, name: str) -> dict:
    """Name and folder of a table that nothing else uses."""
    path = scratch.fresh(x.spark, name)
    return {"name": path.rsplit("/", 1)[-1].replace("-", "_"), "path": path}


@query("SELECT o_orderkey, o_custkey, c_name FROM orders JOIN customer ON o_custkey = c_custkey")
def snk3_bulk_tables(x: Fixtures):
    """Two tables bucketed alike, one of them filled in two appends; their join needs no exchange of either."""
    o, t = x.table("orders").select("o_orderkey", "o_custkey"), _table(x, "orders")
    orders = SK.write_table(o.where("o_orderkey % 2 = 0"), **t, bucket="o_custkey")
    orders = SK.write_table(o.where("o_orderkey % 2 = 1"), **t, bucket="o_custkey", mode="append")
    c = SK.write_table(x.table("customer").select("c_custkey", "c_name"), **_table(x, "customer"), bucket="c_custkey")
    return orders.join(c.hint("merge"), orders["o_custkey"] == c["c_custkey"]).select("o_orderkey", "o_custkey", "c_name")


@query("SELECT p.a, p.b, p.h4, s.study_name AS name_a, t.study_name AS name_b, s.category AS category_a FROM pairs p JOIN studies s ON p.a = s.study JOIN studies t ON p.b = t.study", "pairs studies")
def snk4_wide_table(x: Fixtures):
    """A wide table made from a query, kept, and read back."""
    s = x.studies.select("study", "study_name", "category")
    wide = x.pairs.select("a", "b", "h4").join(s.toDF("a", "name_a", "category_a"), "a").join(s.select("study", "study_name").toDF("b", "name_b"), "b")
    return SK.write_table(wide, **_table(x, "wide")).select("a", "b", "h4", "name_a", "name_b", "category_a")


@query("SELECT n_nationkey AS k, n_name AS name FROM nation")
def snk6_reload(x: Fixtures):
    """A table with other columns is dropped and loaded anew."""
    t = _table(x, "reloaded")
    SK.write_table(x.table("region"), **t)
    return SK.reload_table(x.table("nation").select(F.col("n_nationkey").alias("k"), F.col("n_name").alias("name")), **t)


@query("SELECT 'latest' AS part, study FROM studies WHERE study IN (SELECT study FROM snps WHERE beta > 0.2) UNION ALL SELECT 'cleaned', study FROM studies WHERE study NOT IN (SELECT study FROM snps WHERE beta > 0.2)", "snps studies")
def d18_publish(x: Fixtures):
    """After a run: results of studies with extractions are published, studies without any are cleaned up."""
    s = x.studies.select("study")
    latest, cleaned = SK.published(s, s, x.snps.where("beta > 0.2"))
    return latest.select(F.lit("latest").alias("part"), "study").union(cleaned.select(F.lit("cleaned"), "study"))


@query("SELECT n_name AS name, n_regionkey AS region FROM nation")
def snk1_text_round_trip(x: Fixtures):
    path = scratch.fresh(x.spark, "nation")
    SK.write_tsv(x.table("nation").select(F.col("n_name").alias("name"), F.col("n_regionkey").alias("region")), path)
    return RD.delimited(x.spark, path, T.StructType.fromDDL("name string, region int"))


# ---- composites -----------------------------------------------------------------------------------------------


_FOUND = """
WITH g AS (SELECT concat('/gwas/', replace(s_name, '#', '_')) AS directory, s_suppkey AS k FROM supplier),
  b AS (SELECT concat('/besd/eqtl/set_', p_size) AS path, count(*) AS n, p_size AS k FROM part GROUP BY p_size),
  q AS (SELECT concat('/besd/eqtl/set_', p_size) AS path, p_partkey AS k, p_brand AS gene, p_size FROM part),
  t AS (SELECT c_custkey AS k, concat('/tables/', c_custkey, '.tsv') AS location FROM customer),
  a AS (
    SELECT replace(substr(directory, 7), '_', '-') AS study_name, 'opengwas' AS data_format, concat('trait ', k) AS trait_name, CAST(1000 + k AS BIGINT) AS sample_size, lower(CASE WHEN k % 3 = 0 THEN 'Categorical' ELSE 'continuous' END) AS category, CAST(NULL AS VARCHAR) AS ensg,
      CASE WHEN k % 2 = 0 THEN 0.01::DOUBLE * (k % 7) END AS h FROM g WHERE k % 5 <> 0 AND k % 4 <> 1 AND k % 6 <> 2
    UNION ALL SELECT concat('eqtl-set-', p_size, '-ENSG000', k), 'besd', concat(gene, ' blood eQTL'), CAST(100 + p_size AS BIGINT), 'continuous', concat('ENSG000', k), NULL FROM q WHERE k % 23 + 1 <= 22 AND p_size % 4 <> 0 AND p_size % 5 <> 0 AND p_size % 7 <> 0
    UNION ALL SELECT concat('table-', k), 'tsv', concat('table trait ', k), CAST(k AS BIGINT), 'continuous', NULL, NULL FROM t WHERE location SIMILAR TO '.*[02468]\\.tsv')
SELECT study_name, data_format, trait_name, sample_size, category, ensg, round(h, 6) AS heritability FROM a WHERE study_name NOT LIKE '%7'
"""


@query(_FOUND)
def d1_study_discovery(x: Fixtures):
    """Studies to process from a study list with an entry of each format, less those that were processed before."""
    from . import discovery as DI

    entry = lambda kind, where, pattern, data_type: (data_type, "s", kind, "EUR", "GRCh38", 1.5e-4, "common", "dense", "none", where, pattern)
    names = ", ".join(f"{c} {'double' if c == 'p_value_threshold' else 'string'}" for c in (*DI.TAKEN, "bespoke_parsing", "data_location", "id_pattern"))
    entries = x.spark.createDataFrame([entry("opengwas", "/gwas", "Supplier_*", "phenotype"), entry("besd", "/besd/eqtl", "set_*", "gene_expression"), entry("tsv", "/tables", "[02468]\\.tsv$", "phenotype")], names)
    entries = DI.checked(entries, x.spark.createDataFrame([("s",)], "source string"))
    k = F.col("s_suppkey")
    log = F.when(k % 2 == 0, F.concat(F.lit("Total Observed scale h2: "), F.format_string("%.2f", 0.01 * (k % 7)), F.lit(" (0.01)"))).otherwise("nothing to report")
    folders = x.table("supplier").select(F.concat(F.lit("/gwas/"), F.replace("s_name", F.lit("#"), F.lit("_"))).alias("directory"), F.concat(F.lit("trait "), k).alias("trait"), F.when(k % 5 != 0, "European").otherwise("African").alias("population"), F.when(k % 3 == 0, "Categorical").alias("category"), F.when(k % 4 != 1, 2_000_000).otherwise(999_999).alias("nsnp"), F.when(k % 6 != 2, 1000 + k).alias("sample_size"), log.alias("log"))
    size, path = F.col("p_size"), F.concat(F.lit("/besd/eqtl/set_"), "p_size").alias("path")
    sets = x.table("part").groupBy("p_size").agg(F.count("*")).select(path, F.when(size % 4 == 0, 3).otherwise(4).alias("files"), F.when(size % 5 != 0, "blood").alias("tissue"), F.when(size % 7 == 0, "no such cell").otherwise("NK").alias("cell_type"), F.lit(None).cast("string").alias("category"), F.lit("cis").alias("cis_trans"), (100 + size).alias("sample_size"))
    probes = x.table("part").select(path, (F.col("p_partkey") % 23 + 1).cast("string").alias("chr"), F.concat(F.lit("ENSG000"), "p_partkey").alias("probe"), F.col("p_brand").alias("gene"))
    files = x.table("customer").select(F.lit("/tables").alias("data_location"), F.concat(F.lit("/tables/"), "c_custkey", F.lit(".tsv")).alias("study_location"), F.concat(F.lit("table_"), "c_custkey").alias("study_name"), F.concat(F.lit("table trait "), "c_custkey").alias("trait"), F.col("c_custkey").alias("sample_size"), F.lit("continuous").alias("category"), F.lit("gene").alias("gene"), F.lit("blood").alias("tissue"))
    found = [DI.opengwas(entries, folders), DI.besd(entries, sets, probes)[0], DI.tsv(entries, files)]
    before = [f.where("study_name LIKE '%7'").select("study_name") for f in found]
    out = DI.to_process(found, before)
    return out.select("study_name", "data_format", "trait_name", "sample_size", "category", "ensg", F.round("heritability", 6).alias("heritability"))


_REGIONS = f"(SELECT study, ld_block, arg_min(bp, {{'a': p, 'b': bp}}) AS bp, min(p) AS p, CAST(count(*) AS BIGINT) AS n FROM {WITH_P} s JOIN blocks b ON s.chr = b.chr AND s.bp >= b.start AND s.bp < b.stop GROUP BY 1, 2)"


@query(f"SELECT study, ld_block, min(bp) AS bp FROM (SELECT study, ld_block, bp, 0 AS age FROM {_REGIONS} WHERE study % 2 = 0 UNION ALL SELECT study, ld_block, bp, 1 FROM {_REGIONS} WHERE study % 3 = 0) GROUP BY 1, 2", "snps blocks")
def d2_organised_regions(x: Fixtures):
    r = D.regions(_with_p(x), x.blocks, 1.0).select("study", "ld_block", "bp")
    return D.organised(r.where("study % 3 = 0"), r.where("study % 2 = 0"), ["study", "ld_block"])


@query(f"SELECT study, ld_block, bp, p, n FROM {_REGIONS} WHERE p <= 0.00015", "snps blocks")
def d3_region_extraction(x: Fixtures):
    return D.regions(_with_p(x), x.blocks)


@query(f"SELECT study, ld_block, CAST(count(*) AS BIGINT) AS n FROM {WITH_P} s JOIN blocks b ON s.chr = b.chr AND s.bp >= b.start AND s.bp < b.stop GROUP BY 1, 2 HAVING min(p) <= 0.00015", "snps blocks")
def d3_region_rows(x: Fixtures):
    return D.region_rows(_with_p(x), x.blocks).groupBy("study", "ld_block").agg(F.count("*").alias("n"))


@query(f"SELECT study, ld_block, CASE WHEN cis THEN 'cis' ELSE 'trans' END AS cis_trans FROM (SELECT study, ld_block, bp % 3000 = 0 AS cis FROM {_REGIONS})", "snps blocks")
def d4_cis_then_trans(x: Fixtures):
    r = D.regions(_with_p(x), x.blocks, 1.0).select("study", "ld_block", "bp")
    cis = r.where("bp % 3000 = 0").withColumn("cis_trans", F.lit("cis"))
    return D.cis_then_trans(cis.unionByName(r.withColumn("cis_trans", F.lit("trans")))).select("study", "ld_block", "cis_trans")


@query("SELECT s.study, s.chr, s.bp, CASE WHEN s.study % 4 = 0 THEN p.eaf ELSE s.eaf END AS eaf FROM snps s LEFT JOIN (SELECT chr, bp, max(eaf) AS eaf FROM snps WHERE study % 2 = 1 GROUP BY 1, 2) p ON s.chr = p.chr AND s.bp = p.bp", "snps")
def d5_panel_frequency(x: Fixtures):
    s = x.snps.withColumn("snp", F.concat_ws(":", "chr", "bp"))
    panel = s.where("study % 2 = 1").groupBy("snp").agg(F.max("eaf").alias("eaf"))
    return FL.panel_eaf(s.withColumn("eaf", F.when(F.col("study") % 4 != 0, F.col("eaf"))), panel, "study", "snp").select("study", "chr", "bp", "eaf")


@query("SELECT study, ld_block, rare, CAST(count(*) AS BIGINT) AS n FROM (SELECT study, ld_block, eaf < 0.01 AS rare FROM snps s JOIN blocks b ON s.chr = b.chr AND s.bp >= b.start AND s.bp < b.stop) GROUP BY ALL", "snps blocks")
def d6_extractions(x: Fixtures):
    s = J.interval_join(x.snps, x.blocks, closed=False)
    return D.extractions(s.where("eaf >= 0.01"), s.where("eaf < 0.01")).groupBy("study", "ld_block", "rare").agg(F.count("*").alias("n"))


@query("SELECT gene, CASE WHEN gene < 'Brand#3' THEN k ELSE (SELECT count(DISTINCT p_brand) FROM part WHERE p_brand < 'Brand#3') + row_number() OVER (PARTITION BY gene < 'Brand#3' ORDER BY gene) END AS id FROM (SELECT p_brand AS gene, row_number() OVER (ORDER BY p_brand) AS k FROM (SELECT DISTINCT p_brand FROM part))")
def d7_id_persistence(x: Fixtures):
    g = x.table("part").select(F.col("p_brand").alias("gene")).distinct()
    old = W.numbered(g.where("gene < 'Brand#3'"), ["gene"])
    return J.surrogate_ids(g, old, "gene").select("gene", "id")


@query("SELECT DISTINCT variant FROM members WHERE gene = 'Brand#11' OR study = 5 OR grp % 100 = 0", "members")
def d8_relevant_variants(x: Fixtures):
    m = x.members
    return D.relevant_variants(m.where("gene = 'Brand#11'"), m.where("study = 5"), m.where("grp % 100 = 0"))


@query("SELECT study, specific, CAST(count(*) AS BIGINT) AS n FROM (SELECT a.study, EXISTS (SELECT 1 FROM members m WHERE m.study = a.study AND m.variant = a.variant AND m.grp % 2 = 0) AS specific FROM (SELECT study, pk AS variant FROM sumstats) a) GROUP BY ALL", "sumstats members")
def d9_association_split(x: Fixtures):
    a = x.sumstats.select("study", F.col("pk").alias("variant"))
    return D.split_associations(a, x.members.where("grp % 2 = 0")).groupBy("study", "specific").agg(F.count("*").alias("n"))


@query("SELECT a, b, h4, a % 7 = b % 7 AS same_group FROM pairs WHERE h4 > 0.5", "pairs")
def d10_coloc_tables(x: Fixtures):
    m = x.studies.select("study", (F.col("study") % 7).alias("g"))
    return D.coloc_tables(x.pairs, m).select("a", "b", "h4", "same_group")


@query("SELECT gene, CAST(count(DISTINCT data_type) AS BIGINT) AS n_types, CAST(count(DISTINCT grp) AS BIGINT) AS n_groups FROM members GROUP BY gene", "members")
def d11_pleiotropy_table(x: Fixtures):
    return x.members.groupBy("gene").agg(F.countDistinct("data_type").alias("n_types"), F.countDistinct("grp").alias("n_groups"))


@query("SELECT 'members' AS t, CAST(count(*) AS BIGINT) AS n FROM members WHERE study < 10 UNION ALL SELECT 'studies', CAST(count(*) AS BIGINT) FROM studies WHERE study < 10 UNION ALL SELECT 'variants', CAST(count(*) AS BIGINT) FROM (SELECT DISTINCT variant FROM members WHERE study < 10)", "members studies")
def d12_subset(x: Fixtures):
    m = x.members
    out = D.subset({"members": m, "studies": x.studies, "variants": m.select("variant").distinct()}, x.studies.where("study < 10"))
    frames = [t.agg(F.lit(n).alias("t"), F.count("*").alias("n")) for n, t in out.items()]
    return frames[0].union(frames[1]).union(frames[2])


@query("SELECT 'members' AS t, CAST(count(*) AS BIGINT) AS n, CAST(sum(study) AS BIGINT) AS total FROM members WHERE study >= 10 UNION ALL SELECT 'studies', CAST(count(*) AS BIGINT), CAST(sum(study) AS BIGINT) FROM studies WHERE study >= 10 UNION ALL SELECT 'pairs', CAST(count(*) AS BIGINT), CAST(sum(a) AS BIGINT) FROM pairs WHERE a >= 10 AND b >= 10", "members studies pairs")
def d13_study_removal(x: Fixtures):
    """Stored tables after studies were removed from all of them at once."""
    root = scratch.fresh(x.spark, "release")
    REL.publish(x.spark, root, {"members": x.members, "studies": x.studies, "pairs": x.pairs})
    keys = {"members": ["study"], "studies": ["study"], "pairs": ["a", "b"]}
    REL.without_studies(x.spark, root, keys, x.studies.where("study < 10"))
    counted = [REL.read(x.spark, root, n).agg(F.lit(n).alias("t"), F.count("*").alias("n"), F.sum(k[0]).alias("total")) for n, k in keys.items()]
    return counted[0].union(counted[1]).union(counted[2])


@query("SELECT m.grp, m.study, m.variant, a.beta FROM members m LEFT JOIN (SELECT study, variant, min(beta) AS beta FROM (SELECT study, pk AS variant, CASE WHEN beta > 0 THEN beta END AS beta FROM sumstats) GROUP BY 1, 2) a USING (study, variant) WHERE m.grp IN (SELECT grp FROM members WHERE study = 7)", "members sumstats")
def d14_worker_groups(x: Fixtures):
    a = x.sumstats.select("study", F.col("pk").alias("variant"), F.when(F.col("beta") > 0, F.col("beta")).alias("beta"))
    return D.worker_groups(x.members, 7, a).select("grp", "study", "variant", "beta")


@query("SELECT study, ld_block FROM (SELECT DISTINCT study, ld_block FROM snps s JOIN blocks b ON s.chr = b.chr AND s.bp >= b.start AND s.bp < b.stop) WHERE study % 5 <> 0", "snps blocks")
def d15_incremental(x: Fixtures):
    work = J.interval_join(x.snps, x.blocks, closed=False).select("study", "ld_block").distinct()
    return D.not_done(work, work.where("study % 5 = 0"), ["study", "ld_block"])


@query("SELECT variant, CAST(count(*) AS BIGINT) AS n_studies, string_agg(CAST(study AS VARCHAR), ', ' ORDER BY study) AS studies, min(p) AS least_p FROM (SELECT pk AS variant, study, min(eaf) AS p FROM sumstats WHERE eaf <= 0.1 GROUP BY 1, 2) GROUP BY variant HAVING count(*) >= 2", "sumstats")
def d16_rare_groups(x: Fixtures):
    return D.rare_groups(x.sumstats.select(F.col("pk").alias("variant"), "study", F.col("eaf").alias("p")), 0.1)


@query("SELECT study, chr, bp, greatest(beta, 0.01) AS beta FROM snps WHERE eaf IS NOT NULL AND chr <> 6", "snps")
def d17_repair(x: Fixtures):
    gone = x.snps.where("chr = 6").select("chr", "bp").distinct()
    t = x.snps.dropna(subset=["eaf"]).join(gone, ["chr", "bp"], "left_anti")
    return SK.update_where(t, F.col("beta") < 0.01, beta=F.lit(0.01)).select("study", "chr", "bp", "beta")


@query("SELECT trait, max(study) AS study, CAST(count(*) - 1 AS BIGINT) AS others FROM (SELECT study, lower(category) AS trait FROM studies) GROUP BY trait", "studies")
def d19_trait_collapse(x: Fixtures):
    return x.studies.groupBy(F.lower("category").alias("trait")).agg(F.max("study").alias("study"), (F.count("*") - 1).alias("others"))


#: Traits of common and rare studies by the last digit of a part's key, one digit for each step of the pairing.
_TRAITS = {
    0: ("protein", "'Levels of g'||k", "'p q OID'||k||' r'"),
    1: ("icd10", "'Diagnoses - main ICD10: A'||k||'.1 Something'", "'ICD10 A'||k||'.1: Something'"),
    2: ("medication", "'Treatment/medication code: drug'||k", "'Treatment/medication code (drug'||k||')'"),
    3: ("procedure", "'Operative procedures - main OPCS: X'||k", "'Operative procedures - main OPCS4 (X'||k||')'"),
    4: ("operation", "'Operation code: op'||k", "'Operation code (op'||k||')'"),
    5: ("union", "'disease '||k", "'Chapter IX disease '||k||' (union)'"),
    6: ("trait", "'height '||k", "'height '||k"),
    7: ("form", "'blood/cell '||k", "'blood cell '||k||' (30 '||k||')'"),
    8: ("field", "'noted '||k", "'other words '||k"),
    9: ("block", "'kidney '||k", "'N10-N20 kidney '||k||' (union)'"),
}
_CASES = [" ".join(["CASE k % 10", *[f"WHEN {d} THEN {t[side]}" for d, t in _TRAITS.items()], "END"]) for side in (1, 2)]
_STEP = " ".join(["CASE k % 10", *[f"WHEN {d} THEN '{t[0]}'" for d, t in _TRAITS.items()], "END"])


@query(f"SELECT CASE k % 10 WHEN 0 THEN 'protein' ELSE 'phenotype' END AS data_type, concat('common:x:OID', k) AS study_name_common, concat('rare', k) AS study_name_rare, {_CASES[0]} AS trait_common, {_CASES[1]} AS trait_rare, CASE WHEN twice THEN 'form' ELSE {_STEP} END AS step FROM (SELECT p_partkey AS k FROM part) CROSS JOIN (SELECT unnest([FALSE, TRUE]) AS twice) WHERE k % 7 <> 0 AND k % 20 <> 18 AND (NOT twice OR k % 10 = 6) UNION ALL SELECT 'phenotype', 'by hand', 'its pair', 'a', 'b', 'manual'")
def d19_trait_pairs(x: Fixtures):
    """Common and rare studies paired step by step; every seventh is of another data type (or gene), fields of the keys that end on 18 are shared; equal traits are paired by their form as well."""
    from . import traits as TR

    k = x.table("part").select(F.col("p_partkey").alias("k"))
    other = "k % 7 = 0"
    common = k.selectExpr("k", "CASE k % 10 WHEN 0 THEN 'protein' ELSE 'phenotype' END AS data_type", "concat('common:x:OID', k) AS study_name", f"{_CASES[0]} AS trait", "concat('g', k) AS gene")
    rare = k.selectExpr(f"CASE WHEN k % 10 = 0 THEN 'protein' WHEN {other} AND k % 10 <> 8 THEN 'other' ELSE 'phenotype' END AS data_type", "concat('rare', k) AS study_name", f"{_CASES[1]} AS trait", f"concat(CASE WHEN {other} THEN 'h' ELSE 'g' END, k) AS gene", f"CASE WHEN k % 20 = 18 THEN 'f' WHEN k % 10 = 8 AND {other} THEN 'none' WHEN k % 10 = 8 THEN concat('f', k) END AS field")
    fields = k.where("k % 10 = 8").selectExpr("concat('common:x:OID', k) AS study_name", "CASE WHEN k % 20 = 18 THEN 'f' ELSE concat('f', k) END AS field")
    manual = x.spark.createDataFrame([("by hand", "its pair", "a", "b")] * 2, ", ".join(f"{c} string" for c in TR.COLUMNS[1:]))
    return TR.paired(common.drop("k"), rare, fields, manual)


@query("SELECT gene, CAST(count(*) AS BIGINT) AS n FROM (SELECT CAST(p_partkey AS BIGINT) AS gene, CAST(p_partkey % 22 + 1 AS BIGINT) AS chr, CAST(p_partkey * 7919 % 9000 * 1000 AS BIGINT) AS mid FROM part) g JOIN (SELECT DISTINCT chr, bp FROM snps) s ON s.chr = g.chr AND s.bp BETWEEN g.mid - 500000 AND g.mid + 500000 GROUP BY gene", "snps")
def d20_gene_windows(x: Fixtures):
    k = F.col("p_partkey").cast("long")
    mid = k * 7919 % 9000 * 1000
    g = x.table("part").select(k.alias("gene"), (k % 22 + 1).alias("chr"), (mid - 500_000).alias("start"), (mid + 500_000).alias("stop"))
    return J.interval_join(x.snps.select("chr", "bp").distinct(), g).groupBy("gene").agg(F.count("*").alias("n"))


@query("SELECT CAST(chr AS VARCHAR) AS chr, concat(chr, ':', bp) AS snp, bp, ea, oa, round(eaf, 6) AS eaf, round(beta, 6) AS beta, round(pow(10, -round(study / 10.0::DOUBLE, 1)), 8) AS p FROM snps JOIN (SELECT 'A' AS ea, 'G' AS oa) ON TRUE", "snps")
def d20_protein_rows(x: Fixtures):
    """Blank-separated lines of a protein study."""
    from ..sources import raw_layouts as RAW

    six = lambda c: F.format_string("%.6f", c)
    line = F.concat_ws(" ", "chr", "bp", F.concat_ws(":", "chr", "bp", F.lit("G"), F.lit("A"), F.lit("imp")), F.lit("G"), F.lit("A"), six("eaf"), F.lit("0.9"), F.lit("100"), F.lit("ADD"), six("beta"), six("se"), F.lit("1"), F.format_string("%.1f", F.col("study") / 10.0), F.lit("NA"))
    head = x.spark.createDataFrame([("CHROM GENPOS ID ALLELE0 ALLELE1 A1FREQ INFO N TEST BETA SE CHISQ LOG10P EXTRA",)], "value string")
    path = _lines(x, head.union(x.snps.select(line)), "protein")
    return RAW.protein_rows(x.spark.read.text(path)).select("chr", "snp", "bp", "ea", "oa", F.round("eaf", 6).alias("eaf"), F.round("beta", 6).alias("beta"), F.round("p", 8).alias("p"))


_MOLECULAR = "SELECT study, chr, bp, CASE WHEN bp % 3000 = 0 THEN 'T' ELSE 'A' END AS ea, 'C' AS oa, eaf, beta, se FROM snps"


@query(f"SELECT concat(chr, '_', bp, '_', least(ea, oa), '_', greatest(ea, oa)) AS snp, concat('probe', study) AS probe, round(CASE WHEN ea > oa THEN 1 - eaf ELSE eaf END, 6) AS eaf, round(CASE WHEN ea > oa THEN -beta ELSE beta END, 6) AS beta FROM ({_MOLECULAR})", "snps")
def d20_molecular_rows(x: Fixtures):
    from ..sources import raw_layouts as RAW

    return RAW.molecular_rows(_molecular(x))[0].select("snp", "probe", F.round("eaf", 6).alias("eaf"), F.round("beta", 6).alias("beta"))


@query(f"SELECT DISTINCT chr, concat('probe', study) AS probe, bp - bp % 5000000 AS probe_bp, concat('esd/chr', chr, '/probe', study, '.esd') AS path, 0 AS genetic_distance FROM ({_MOLECULAR})", "snps")
def d20_probe_list(x: Fixtures):
    from ..sources import raw_layouts as RAW

    return RAW.molecular_rows(_molecular(x))[1]


def _molecular(x: Fixtures):
    return x.snps.select(F.concat(F.lit("probe"), "study").alias("phenotype_id"), (F.col("bp") % 5_000_000).alias("distance"), "eaf", F.lit(0.5).alias("p"), "beta", "se", "chr", "bp", F.when(F.col("bp") % 3000 == 0, "T").otherwise("A").alias("ea"), F.lit("C").alias("oa"))


_RARE = "(SELECT study, chr, bp, eaf AS maf, CASE WHEN study % 3 = 0 THEN 0.4::DOUBLE ELSE 0.8::DOUBLE END AS info, CASE WHEN bp % 97000 = 0 THEN 1e-6::DOUBLE WHEN bp % 2000 = 0 THEN 0.05::DOUBLE ELSE 0.5::DOUBLE END AS p FROM snps)"
_FINE = "info >= 0.5 AND (maf BETWEEN 0.000012 AND 0.01 OR 1 - maf BETWEEN 0.000012 AND 0.01)"


@query(f"SELECT DISTINCT r.study, r.chr, r.bp FROM {_RARE} r JOIN {_RARE} l ON l.chr = r.chr AND abs(l.bp - r.bp) <= 500000 AND l.p <= 5e-5 AND {_FINE.replace('info', 'l.info').replace('maf', 'l.maf')} WHERE r.p <= 0.1 AND {_FINE.replace('info', 'r.info').replace('maf', 'r.maf')}", "snps")
def d20_rare_windows(x: Fixtures):
    """Rare variants around strong ones."""
    from ..sources import raw_layouts as RAW

    p = F.when(F.col("bp") % 97_000 == 0, 1e-6).when(F.col("bp") % 2000 == 0, 0.05).otherwise(0.5)
    t = x.snps.select("study", "chr", "bp", F.col("eaf").alias("maf"), F.when(F.col("study") % 3 == 0, 0.4).otherwise(0.8).alias("info"), p.alias("p"))
    return RAW.rare_windows(t).select("study", "chr", "bp")


@query("SELECT CAST(chr AS VARCHAR) AS chr, bp, 'A' AS ea, 'G' AS oa, round(CASE k WHEN 'c' THEN eaf ELSE eaf END, 6) AS eaf, CASE WHEN k = 'b' THEN NULL ELSE round(beta, 6) END AS beta, CASE WHEN k = 'b' THEN round(beta, 6) END AS odds, CASE k WHEN 'a' THEN 'x' WHEN 'b' THEN 'y' END AS trait, k FROM snps CROSS JOIN (SELECT unnest(['a', 'b', 'c']) AS k)", "snps")
def d20_exome_rows(x: Fixtures):
    """Three releases of exome results in one form: catalog columns, dashed variants with odds, and markers."""
    from ..sources import raw_layouts as RAW

    s = x.snps
    catalog = s.select(F.col("chr").alias("chromosome"), F.col("bp").alias("base_pair_location"), F.lit("A").alias("effect_allele"), F.lit("G").alias("other_allele"), F.col("eaf").alias("effect_allele_frequency"), F.lit(0.1).alias("p_value"), "beta", F.col("se").alias("standard_error"), F.lit("x").alias("Trait"))
    dash = s.select(F.concat_ws("-", "chr", "bp", F.lit("G"), F.lit("A")).alias("Variant"), F.lit(0.1).alias("p-value"), F.col("eaf").alias("Control AAF"), F.col("beta").alias("Odds ratio"), F.lit(0.1).alias("Odds ratio LCI"), F.lit(0.2).alias("Odds ratio UCI"), F.lit("union#y").alias("Phenotype"), F.lit("g").alias("Gene"))
    marker = s.select(F.concat(F.lit("chr"), "chr", F.lit(":"), "bp", F.lit("_G/A")).alias("markerID"), F.lit(0.1).alias("Pvalue"), F.col("eaf").alias("AF"), F.col("beta").alias("BETA"), F.col("se").alias("SE"), F.lit("g").alias("gene"))
    parts = [RAW.exome_rows(t, layout).withColumn("k", F.lit(k)) for t, layout, k in ((catalog, "catalog", "a"), (dash, "dash", "b"), (marker, "marker", "c"))]
    return parts[0].union(parts[1]).union(parts[2]).select("chr", "bp", "ea", "oa", *[F.round(c, 6).alias(c) for c in ("eaf", "beta", "odds")], "trait", "k")


@query("SELECT t.gene AS target, t.category, CASE WHEN t.gene < 'Brand#4' THEN coalesce(e.hit, FALSE) END AS supported FROM (SELECT DISTINCT m.gene, s.category FROM members m JOIN studies s USING (study)) t LEFT JOIN (SELECT m.gene, s.category, bool_or(m.grp % 50 = 0) AS hit FROM members m JOIN studies s USING (study) GROUP BY 1, 2) e ON t.gene = e.gene AND t.category = e.category", "members studies")
def d21_target_support(x: Fixtures):
    m = x.members.join(x.studies.select("study", "category"), "study").select(F.col("gene").alias("target"), "category", (F.col("grp") % 50 == 0).alias("hit"))
    return D.target_support(m.select("target", "category").distinct(), m, m.where("target < 'Brand#4'"))


# ---- queue ----------------------------------------------------------------------------------------------------


def _messages(x: Fixtures):
    e = F.col("event_id")
    body = F.to_json(F.struct(F.lit("f").alias("file_location"), F.struct(F.concat(F.lit("g"), e).alias("guid"), (e % 10 / 100.0).alias("p_value_threshold")).alias("metadata")))
    kind = F.when(e % 7 == 0, "delete").when(e % 5 == 0, "in_progress").otherwise("process")
    return x.table("events").select("event_id", kind.alias("kind"), F.when(e % 11 != 0, body).otherwise("{broken").alias("value"))


def _served(x: Fixtures, fails: int = 0):
    """(out folder, order of kinds, waits): a worker's run over the events as messages in files; the first ``fails`` calls of its handler fail."""
    base, calls, waits = scratch.fresh(x.spark, "queue"), [], []
    _messages(x).select("kind", "value").repartition(4).write.json(f"{base}/in")

    def handle(m, kind):
        calls.append(kind)
        if len(calls) <= fails:
            raise OSError("not there yet")
        return m.select("guid", "p_value_threshold", F.lit(len(calls)).alias("call"))

    retry = lambda action: Q.with_retry(action, sleep=waits.append)
    for _ in range(2):  # the second start finds everything served
        Q.start(x.spark, f"{base}/in", "kind string, value string", f"{base}/out", f"{base}/checkpoint", handle, retry).awaitTermination()
    return f"{base}/out", calls, waits


@query("SELECT concat('g', event_id) AS guid, CASE WHEN event_id % 5 = 0 THEN 'in_progress' ELSE 'process' END AS served, CASE WHEN event_id % 5 = 0 THEN 1 ELSE 2 END AS call FROM events WHERE event_id % 11 <> 0 AND event_id % 7 <> 0")
def st1_priorities(x: Fixtures):
    """What the worker served, and in which call: deletions first (no call), what was in progress, then the rest."""
    out, *_ = _served(x)
    return x.spark.read.parquet(f"{out}/results").select("guid", "served", "call")


@query("SELECT concat('g', event_id) AS guid, CAST(1 AS BIGINT) AS n FROM events WHERE event_id % 11 <> 0 AND event_id % 7 <> 0")
def st2_at_least_once(x: Fixtures):
    """Results by message after two failed calls and a second start: each once."""
    out, *_ = _served(x, fails=2)
    return x.spark.read.parquet(f"{out}/results").groupBy("guid").agg(F.count("*").alias("n"))


@query("SELECT * FROM (VALUES (1, 2.0::DOUBLE), (2, 4.0::DOUBLE), (3, 8.0::DOUBLE)) AS t(k, wait)")
def st4_backoff(x: Fixtures):
    """Waits of the worker whose handler fails three times."""
    _, _, waits = _served(x, fails=3)
    return x.spark.createDataFrame(list(enumerate(waits, 1)), "k int, wait double")


@query("SELECT concat('g', event_id) AS guid FROM events WHERE event_id % 7 = 0 AND event_id % 11 <> 0")
def st5_tombstones(x: Fixtures):
    out, *_ = _served(x)
    return x.spark.read.parquet(f"{out}/tombstones").select("guid")


@query("SELECT event_id % 11 <> 0 AS valid, CAST(count(*) AS BIGINT) AS n FROM events GROUP BY 1")
def st3_dead_letters(x: Fixtures):
    return Q.parsed(_messages(x)).groupBy("valid").agg(F.count("*").alias("n"))


@query("SELECT event_id FROM events WHERE event_id % 7 <> 0 AND event_id % 11 <> 0")
def st5_deletions(x: Fixtures):
    m = Q.parsed(_messages(x)).where("valid")
    return Q.without_deleted(m, m.where("kind = 'delete'")).select("event_id")


@query("SELECT event_id, event_id % 3 = 0 AS new FROM events")
def st6_reprocessing(x: Fixtures):
    """Stored results after a third of the keys was processed again: what they had before is gone."""
    path = scratch.fresh(x.spark, "reprocessed")
    t = x.table("events").select("event_id", F.lit(False).alias("new"), F.pmod(F.xxhash64("event_id"), F.lit(16)).cast("int").alias("part"))
    REL.write_partitioned(t, path, "part")
    REL.replace_keys(x.spark, path, "part", t.where("event_id % 3 = 0").withColumn("new", F.lit(True)), "event_id")
    return x.spark.read.parquet(path).select("event_id", "new")


def _uploads(x: Fixtures, crash: bool = False) -> str:
    """Folder of a worker with state that has served three deliveries of messages from the events, one after the other.

    The first holds uploads, the second deletes every seventh, the third sends
    every third again and reports every 21st as left in progress.  With
    ``crash`` the first run of the second delivery ends after its marker.
    """
    base = scratch.fresh(x.spark, "uploads")
    e = F.col("event_id")
    body = F.to_json(F.struct(F.struct(F.concat(F.lit("g"), e).alias("guid"), (e % 10 / 100.0).alias("p_value_threshold")).alias("metadata")))
    t = x.table("events").select("event_id", body.alias("value"))
    deliveries = [t.withColumn("kind", F.lit("process")), t.where(e % 7 == 0).withColumn("kind", F.lit("delete")), t.where((e % 3 == 0) | (e % 21 == 0)).withColumn("kind", F.when(e % 21 == 0, "in_progress").otherwise("process"))]
    handle = lambda m: m.select("guid", "again")
    marked = []

    def on_step(step: str, number: int) -> None:
        if crash and step == "marked" and number == 1 and not marked:
            marked.append(number)
            raise OSError("the worker ends here")

    for d in deliveries:
        d.select("kind", "value").write.mode("append").json(f"{base}/in")
        for _ in range(2):
            try:
                U.serve(x.spark, f"{base}/in", f"{base}/out", f"{base}/checkpoint", handle, "again boolean", on_step).awaitTermination()
                break
            except Exception:
                if not crash:
                    raise
    return f"{base}/out"


_SERVED = "SELECT concat('g', event_id) AS guid, event_id % 3 = 0 AS again FROM events WHERE event_id % 7 <> 0"


@query(_SERVED)
def st1_stateful_worker(x: Fixtures):
    """Results of a worker with state: what was deleted in a later delivery is gone, what was left in progress but deleted since is not served."""
    return U.results(x.spark, _uploads(x), "again boolean").select("guid", "again")


@query(_SERVED)
def st2_recovered_worker(x: Fixtures):
    """The same after a run that ended between its marker and its results: each upload has its results once."""
    return U.results(x.spark, _uploads(x, crash=True), "again boolean").select("guid", "again")


@query("SELECT heavy, CAST(count(*) AS BIGINT) AS n FROM (SELECT count(*) OVER (PARTITION BY gene) > (SELECT count(*) / count(DISTINCT gene) FROM members) AS heavy FROM members) GROUP BY heavy", "members")
def st7_heavy_groups(x: Fixtures):
    """Heavy groups run apart and salted, the light ones as they are."""
    m = x.members
    n, g = m.agg(F.count("*"), F.count_distinct("gene")).first()
    heavy, light = Q.heavy_split(m, "gene", n // g)
    parts = Q.salted(heavy, "gene", 100).groupBy("gene", "_salt").agg(F.count("*").alias("n")).select(F.lit(True).alias("heavy"), "n")
    return parts.union(light.groupBy("gene").agg(F.count("*")).select(F.lit(False), "count(1)")).groupBy("heavy").agg(F.sum("n").alias("n"))


@query(f"SELECT u.guid, r.study AS other, u.first_bp FROM (SELECT study AS guid, ld_block, min(bp) AS first_bp FROM {_REGIONS} WHERE study % 10 = 0 GROUP BY 1, 2) u JOIN {_REGIONS} r ON u.ld_block = r.ld_block AND abs(u.first_bp - r.bp) <= 50000 AND r.p <= 0.01", "snps blocks")
def st8_compare_with_warehouse(x: Fixtures):
    r = D.regions(_with_p(x), x.blocks, 1.0)
    up = r.where("study % 10 = 0").select(F.col("study").alias("guid"), F.col("ld_block").alias("block"), "bp")
    wh = r.select("study", F.col("ld_block").alias("block"), "bp", F.col("p").alias("min_p"))
    return Q.near_warehouse(up, wh, 50_000, 0.01).select("guid", "other", "first_bp")


_UPLOADED = f"(SELECT concat('u', study) AS guid, study, ld_block, concat(study, '_', ld_block) AS ident, bp, p AS min_p FROM {_REGIONS} WHERE study % 10 = 0)"
_STORED = f"(SELECT ld_block, concat(study, '_', ld_block) AS ident, bp, p AS min_p FROM {_REGIONS} WHERE study % 10 <> 0)"


@query(
    f", u AS {_UPLOADED}, w AS {_STORED} SELECT guid, ld_block AS block, ident, arg_min(origin, rank) AS origin FROM (SELECT guid, ld_block, ident, 'upload' AS origin, 0 AS rank FROM u WHERE min_p <= 0.05 UNION ALL SELECT f.guid, f.ld_block, w.ident, 'warehouse', 1 FROM (SELECT guid, ld_block, min(bp) AS first_bp FROM u WHERE min_p <= 0.05 GROUP BY 1, 2) f JOIN w ON w.ld_block = f.ld_block AND w.min_p <= 0.01 AND abs(f.first_bp - w.bp) <= 50000 UNION ALL SELECT DISTINCT a.guid, a.ld_block, b.ident, 'other', 2 FROM u a JOIN u b ON a.ld_block = b.ld_block AND (b.study = a.study + 10 OR b.study = a.study + 20) AND b.min_p <= 0.05) GROUP BY ALL",
    "snps blocks",
)
def st8_compare_uploads(x: Fixtures):
    """A stream of uploads against the warehouse and against the stored uploads that each names.

    The stream stores where each upload lies and what it meets besides the
    warehouse; the warehouse's signals near it are joined when the result is read.
    """
    r = D.regions(_with_p(x), x.blocks, 1.0).select("study", F.col("ld_block").alias("block"), F.concat_ws("_", "study", "ld_block").alias("ident"), "bp", F.col("p").alias("min_p"))
    r = scratch.stored(r, "regions")[0]
    up = r.where("study % 10 = 0").select(F.concat(F.lit("u"), "study").alias("guid"), "block", "ident", "bp", "min_p", F.lit(0.05).alias("p_value_threshold"), F.transform(F.array(F.col("study"), F.col("study") + 10, F.col("study") + 20), lambda s: F.concat(F.lit("u"), s)).alias("compare"))
    base, warehouse = scratch.fresh(x.spark, "compared"), r.where("study % 10 <> 0")
    up.write.parquet(f"{base}/in")

    def serve(batch: DataFrame, number: int) -> None:
        U.leads(batch).write.mode("overwrite").parquet(f"{base}/leads/batch={number}")
        U.beside(batch, warehouse, up, 50_000, 0.01).write.mode("overwrite").parquet(f"{base}/beside/batch={number}")

    stream = x.spark.readStream.schema(up.schema).parquet(f"{base}/in")
    stream.writeStream.foreachBatch(serve).option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    leads, beside = (x.spark.read.parquet(f"{base}/{name}").drop("batch") for name in ("leads", "beside"))
    return U.near(leads, beside, warehouse, 50_000, 0.01).union(beside).select("guid", "block", "ident", "origin")
