"""Raw layouts of association files, brought to the columns that the pipeline reads."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.joins import interval_join

# Bounds of the search for rare variants.
LEAST_INFO, MAF, LEAD_P, NEAR_P, REACH = 0.5, (0.000012, 0.01), 5e-5, 0.1, 500_000


def protein_rows(lines: DataFrame, text: str = "value") -> DataFrame:
    """(chr, snp, bp, ea, oa, eaf, beta, se, p) of blank-separated lines: chromosome, position, id, alleles (other first), frequency and from the tenth field on effect, error and, thirteenth, -log10 p; headers are left out."""
    f = F.split(F.trim(text), "[ \\t]+")
    place = F.split(f[2], ":")
    number = lambda i: f[i].try_cast("double")
    rows = lines.where(f[0] != "CHROM").select(f[0].alias("chr"), F.concat_ws(":", place[0], place[1]).alias("snp"), place[1].try_cast("long").alias("bp"), f[4].alias("ea"), f[3].alias("oa"), number(5).alias("eaf"), number(9).alias("beta"), number(10).alias("se"), F.pow(F.lit(10.0), -number(12)).alias("p"))
    return rows.where("bp IS NOT NULL")


def molecular_rows(df: DataFrame, folder: str = "esd") -> tuple[DataFrame, DataFrame]:
    """(rows, probes) of a molecular trait's file (phenotype_id, distance, eaf, p, beta, se, chr, bp, ea, oa; distance: from the probe to the variant).

    Rows have their alleles in order, the effect and the frequency turned with
    them, and the id chr_bp_ea_oa; probes are distinct, with their position and
    the file of their rows.
    """
    turned = F.col("ea") > F.col("oa")
    ea, oa = F.least("ea", "oa"), F.greatest("ea", "oa")
    rows = df.select("chr", F.concat_ws("_", "chr", "bp", ea, oa).alias("snp"), "bp", ea.alias("ea"), oa.alias("oa"), F.when(turned, 1 - F.col("eaf")).otherwise(F.col("eaf")).alias("eaf"), F.when(turned, -F.col("beta")).otherwise(F.col("beta")).alias("beta"), "se", "p", F.col("phenotype_id").alias("probe"))
    probes = df.select("chr", F.col("phenotype_id").alias("probe"), (F.col("bp") - F.col("distance")).alias("probe_bp"), F.concat_ws("/", F.lit(folder), F.concat(F.lit("chr"), "chr"), F.concat("phenotype_id", F.lit(".esd"))).alias("path"), F.lit(0).alias("genetic_distance")).distinct()
    return rows, probes


def rare_windows(df: DataFrame) -> DataFrame:
    """Rare variants (chr, bp, p, maf, info, ...) around strong ones, each row once.

    Strong ones have p of at most LEAD_P; around them, within REACH bases, all
    with p of at most NEAR_P are kept.  Both kinds are imputed well enough and
    rare on either side of the frequency.
    """
    rare = F.col("maf").between(*MAF) | (1 - F.col("maf")).between(*MAF)
    fine = df.where((F.col("info") >= LEAST_INFO) & rare & (F.col("p") <= NEAR_P))
    around = fine.where(F.col("p") <= LEAD_P).select("chr", (F.col("bp") - REACH).alias("start"), (F.col("bp") + REACH).alias("stop")).distinct()
    return interval_join(fine, around).select(*df.columns).distinct()


def _parts(variant: str, mark: str) -> dict:
    p = F.split(variant, mark)
    return {"chr": F.regexp_replace(p[0], "^chr", ""), "bp": p[1].try_cast("long"), "oa": p[2], "ea": p[3]}


def exome_rows(df: DataFrame, layout: str) -> DataFrame:
    """(chr, bp, ea, oa, eaf, p, beta, se, odds, lower, upper, gene, annotation, trait) of a release of exome results; what a release lacks is null.

    Layouts: ``catalog`` (columns of the association catalog, effects or odds),
    ``marker`` (chr:bp_oa/ea), ``dash`` (chr-bp-oa-ea; the trait after a #).
    """
    names = {
        "catalog": {"chr": "chromosome", "bp": "base_pair_location", "ea": "effect_allele", "oa": "other_allele", "eaf": "effect_allele_frequency", "p": "p_value", "beta": "beta", "se": "standard_error", "odds": "odds_ratio", "lower": "ci_lower", "upper": "ci_upper", "trait": "Trait"},
        "marker": {"eaf": "AF", "p": "Pvalue", "beta": "BETA", "se": "SE", "gene": "gene", "annotation": "annotation"},
        "dash": {"eaf": "AAF", "p": "p-value", "beta": "Effect size", "se": "Effect size standard error", "odds": "Odds ratio", "lower": "Odds ratio LCI", "upper": "Odds ratio UCI", "gene": "Gene", "annotation": "Consequence type", "trait": "Phenotype"},
    }[layout]
    if layout == "dash" and "AAF" not in df.columns:  # binary traits give the controls' frequency
        names = names | {"eaf": "Control AAF"}
    columns = {c: F.col(f"`{n}`") for c, n in names.items() if n in df.columns}
    if layout != "catalog":
        columns |= _parts("markerID" if layout == "marker" else "Variant", "[:_/]" if layout == "marker" else "-")
    if layout == "dash" and "trait" in columns:
        columns["trait"] = F.regexp_replace(columns["trait"], ".*#", "")
    kinds = {"bp": "long", "eaf": "double", "p": "double", "beta": "double", "se": "double", "odds": "double", "lower": "double", "upper": "double"}
    order = ("chr", "bp", "ea", "oa", "eaf", "p", "beta", "se", "odds", "lower", "upper", "gene", "annotation", "trait")
    return df.select(*[columns.get(c, F.lit(None)).cast(kinds.get(c, "string")).alias(c) for c in order])
