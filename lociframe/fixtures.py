"""Association data derived from the TPC-H-like tables, as expressions that Spark and DuckDB share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_SUMSTATS = (
    "CAST(l_suppkey AS BIGINT) AS study",
    "CAST(l_partkey % 22 + 1 AS BIGINT) AS chr",
    "CAST((l_partkey * 9973 + l_orderkey * 101 + l_linenumber) % 10000 * 1000 AS BIGINT) AS bp",
    "l_returnflag AS ea",
    "l_linestatus AS oa",
    "round(abs(l_discount) * 9 + 0.004, 6) AS eaf",
    "round((l_quantity - 25.5) / 100, 6) AS beta",
    "round(0.02 + abs(l_tax) / 2, 6) AS se",
    "CAST(l_orderkey AS BIGINT) AS ok",
    "CAST(l_partkey AS BIGINT) AS pk",
)
#: One row per (study, chr, bp): the least of its rows.
_SNPS = "study, chr, bp, min(eaf) AS eaf, min(beta) AS beta, min(se) AS se"

SQL = {
    "sumstats": f"SELECT {', '.join(_SUMSTATS)} FROM lineitem",
    "snps": f"SELECT {_SNPS} FROM sumstats GROUP BY study, chr, bp",
    "blocks": "SELECT c.n AS chr, k.n * 1000000 AS start, (k.n + 1) * 1000000 AS stop, concat('EUR/', c.n, '/', k.n * 1000000, '-', (k.n + 1) * 1000000) AS ld_block FROM (SELECT CAST(n_nationkey + 1 AS BIGINT) AS n FROM nation WHERE n_nationkey < 22) c CROSS JOIN (SELECT CAST(n_nationkey AS BIGINT) AS n FROM nation WHERE n_nationkey < 10) k",
    "studies": "SELECT CAST(s_suppkey AS BIGINT) AS study, s_name AS study_name, n_name AS source, r_name AS category FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey",
    "members": "SELECT DISTINCT CAST(l_orderkey AS BIGINT) AS grp, CAST(l_suppkey AS BIGINT) AS study, CAST(l_partkey AS BIGINT) AS variant, p_brand AS gene, p_type AS data_type FROM lineitem JOIN part ON l_partkey = p_partkey",
    "lbf": "SELECT CAST(vec_id AS BIGINT) AS study, CAST(label AS BIGINT) AS blk, CAST(generate_subscripts(embedding, 1) - 1 AS BIGINT) AS snp, CAST(unnest(embedding) AS DOUBLE) * 30 AS lbf FROM embeddings",
    "ld": "SELECT blk, i AS lead, j AS proxy, pow(0.5::DOUBLE + blk % 10 * 0.04::DOUBLE, abs(i - j)) AS r FROM (SELECT DISTINCT CAST(label AS BIGINT) AS blk, len(embedding) AS n FROM embeddings), range(64) a(i), range(64) b(j) WHERE i < n AND j < n",
    "pairs": "SELECT a.study AS a, b.study AS b, count(*) AS n, round(((count(*) * 37 + a.study * 31 + b.study * 17) % 1000) / 1000.0, 6) AS h4 FROM members a JOIN members b ON a.grp = b.grp AND a.study < b.study GROUP BY a.study, b.study",
}
#: CTEs that each CTE reads.
NEEDS = {"snps": ["sumstats"], "pairs": ["members"], "reach": ["edges"], "strong": ["edges"], "spread": ["strong"]}


def with_sql(*names: str) -> str:
    """WITH clause that defines the named fixtures for DuckDB."""
    order: list[str] = []

    def add(n: str) -> None:
        for x in NEEDS.get(n, []):
            add(x)
        if n not in order:
            order.append(n)

    for n in names:
        add(n)
    return "WITH " + ", ".join(f"{n} AS ({SQL[n]})" for n in order) + " "


#: Bytes of a table's files that the rows made from it are dealt to one task for.
BYTES_A_TASK = 4 << 20


def dealt_by_size(df: DataFrame, source: DataFrame, *keys: str) -> DataFrame:
    """``df`` by its keys in so many partitions that each stands for about BYTES_A_TASK of the table that it is made from."""
    size = int(str(source._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return df.repartition(max(df.sparkSession.sparkContext.defaultParallelism, size // BYTES_A_TASK), *keys)


class Fixtures:
    """The same tables as DataFrames."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    @property
    def sumstats(self) -> DataFrame:
        return self.table("lineitem").selectExpr(*_SUMSTATS)

    @property
    def snps(self) -> DataFrame:
        return self.sumstats.groupBy("study", "chr", "bp").agg(F.min("eaf").alias("eaf"), F.min("beta").alias("beta"), F.min("se").alias("se"))

    @property
    def blocks(self) -> DataFrame:
        n = self.table("nation").select(F.col("n_nationkey").cast("long").alias("n"))
        c, k = n.where("n < 22").select((F.col("n") + 1).alias("chr")), n.where("n < 10").select((F.col("n") * 1_000_000).alias("start"), ((F.col("n") + 1) * 1_000_000).alias("stop"))
        return c.crossJoin(F.broadcast(k)).withColumn("ld_block", F.concat(F.lit("EUR/"), "chr", F.lit("/"), "start", F.lit("-"), "stop"))

    @property
    def studies(self) -> DataFrame:
        s, n, r = self.table("supplier"), self.table("nation"), self.table("region")
        out = s.join(n, s["s_nationkey"] == n["n_nationkey"]).join(r, F.col("n_regionkey") == F.col("r_regionkey"))
        return out.select(F.col("s_suppkey").cast("long").alias("study"), F.col("s_name").alias("study_name"), F.col("n_name").alias("source"), F.col("r_name").alias("category"))

    @property
    def members(self) -> DataFrame:
        li, p = self.table("lineitem").select("l_orderkey", "l_suppkey", "l_partkey"), self.table("part").select("p_partkey", "p_brand", "p_type")
        out = li.join(p, li["l_partkey"] == p["p_partkey"])
        return out.select(F.col("l_orderkey").cast("long").alias("grp"), F.col("l_suppkey").cast("long").alias("study"), F.col("l_partkey").cast("long").alias("variant"), F.col("p_brand").alias("gene"), F.col("p_type").alias("data_type")).distinct()

    @property
    def lbf(self) -> DataFrame:
        e = self.table("embeddings").select(F.col("vec_id").cast("long").alias("study"), F.col("label").cast("long").alias("blk"), F.posexplode("embedding").alias("snp", "v"))
        return e.select("study", "blk", F.col("snp").cast("long").alias("snp"), (F.col("v").cast("double") * 30).alias("lbf"))

    @property
    def ld(self) -> DataFrame:
        """LD rows (blk, lead, proxy, r): r falls with each step, at a pace of the block's own."""
        n = self.table("embeddings").select(F.col("label").cast("long").alias("blk"), F.size("embedding").alias("n")).distinct()
        steps = lambda name: F.explode(F.sequence(F.lit(0).cast("long"), F.col("n").cast("long") - 1)).alias(name)
        pairs = n.select("blk", "n", steps("lead")).select("blk", "lead", steps("proxy"))
        return pairs.withColumn("r", F.pow(0.5 + F.col("blk") % 10 * 0.04, F.abs(F.col("lead") - F.col("proxy")).cast("double")))

    @property
    def pairs(self) -> DataFrame:
        """Study pairs with a made-up posterior: edges of a graph.

        What pairs are made of is counted first: rows of ``members`` by group and
        study, from the distinct lines and how many genes and types a part has.
        Lines and pairs are dealt to as many partitions as their size asks for.
        """
        kinds = self.table("part").select("p_partkey", "p_brand", "p_type").distinct().groupBy("p_partkey").agg(F.count("*").alias("rows"))
        li = self.table("lineitem").where("l_orderkey IS NOT NULL AND l_suppkey IS NOT NULL")
        li = li.join(kinds, li["l_partkey"] == kinds["p_partkey"]).select(F.col("l_orderkey").cast("long").alias("grp"), F.col("l_suppkey").cast("long").alias("study"), "l_partkey", "rows")
        m = dealt_by_size(li, self.table("lineitem"), "grp").distinct().groupBy("grp", "study").agg(F.sum("rows").alias("rows"))
        a, b = m.select("grp", F.col("study").alias("a"), F.col("rows").alias("x")), m.select("grp", F.col("study").alias("b"), F.col("rows").alias("y"))
        met = a.join(b, "grp").where("a < b").select("a", "b", (F.col("x") * F.col("y")).alias("n"))
        n = dealt_by_size(met, self.table("lineitem"), "a", "b").groupBy("a", "b").agg(F.sum("n").alias("n"))
        return n.withColumn("h4", F.expr("round(((n * 37 + a * 31 + b * 17) % 1000) / CAST(1000.0 AS DOUBLE), 6)"))
