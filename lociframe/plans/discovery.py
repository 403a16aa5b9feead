"""Study discovery: entries of a study list, in three formats, become the studies to process.

An entry names a location and a pattern (``*`` and ``?`` as in file names, a
regular expression for tables of files).  The metadata of what lies there comes
as tables (made by ``sources.readers``: sidecars, probe lists, logs), and the
few entries are broadcast to them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.joins import small
from ..schemas import STUDY, validate
from ..sources.readers import heritability

# What entries may hold, names of data types in trait names, populations, cell types.
ENUMS = {
    "data_format": ("opengwas", "besd", "tsv"),
    "variant_type": ("common", "rare_exome", "rare_wgs"),
    "reference_build": ("GRCh37", "GRCh38"),
    "coverage": ("dense", "sparse"),
    "bespoke_parsing": ("none", "interval_sqtl", "godmc"),
}
TYPE_NAMES = {
    "splice_variant": "sQTL", "transcript": "tQTL", "gene_expression": "eQTL", "protein": "pQTL", "methylation": "methQTL", "metabolome": "metaQTL",
    "cell_trait": "Cell Trait", "plasma_protein": "Targeted Protein Measure", "phenotype": "Phenotype",
}
POPULATIONS = {"EUR": "European", "EAS": "East Asian", "AFR": "African", "SAS": "South Asian"}
CELL_TYPES = ("B IN", "B Mem", "CD4 ET", "CD4 NC", "CD4 SOX4", "CD8 ET", "CD8 NC", "CD8 S100B", "DC", "Mono C", "Mono NC", "NK")
LEAST_SNPS, BESD_FILES = 1_000_000, 4

#: Columns of an entry that its studies take over.
TAKEN = ("data_type", "source", "data_format", "ancestry", "reference_build", "p_value_threshold", "variant_type", "coverage")


def _named(table: dict[str, str], key: Column) -> Column:
    return F.create_map(*[F.lit(x) for kv in table.items() for x in kv])[key]


def glob(pattern: Column) -> Column:
    """A file name pattern as a regular expression for the whole path."""
    safe = F.regexp_replace(pattern, "([.+^$(){}|\\[\\]\\\\])", "\\\\$1")
    return F.concat(F.lit("^"), F.regexp_replace(F.regexp_replace(safe, "\\*", "[^/]*"), "\\?", "[^/]"), F.lit("$"))


def dashed(name: Column) -> Column:
    return F.regexp_replace(name, "[_.]", "-")


def checked(entries: DataFrame, sources: DataFrame) -> DataFrame:
    """The entries, if all their values are allowed and their sources known; else ValueError."""
    strange = entries.join(sources.select("source").distinct(), "source", "left_anti").limit(1).collect()
    if strange:
        raise ValueError(f"unknown source: {strange[0]['source']}")
    return validate(entries, enums=ENUMS | {"data_type": tuple(TYPE_NAMES)})


def _at(entries: DataFrame, found: DataFrame, path: str, kind: str) -> DataFrame:
    """What lies where an entry of this format points to, with the entry's columns."""
    e = small(entries.where(F.col("data_format") == kind), "the study list").alias("e")
    where = glob(F.concat_ws("/", "e.data_location", "e.id_pattern"))
    return found.alias("f").join(e, F.rlike(F.col(f"f.{path}"), where)).select("f.*", *[F.col(f"e.{c}") for c in (*TAKEN, "bespoke_parsing", "data_location")])


def _studies(df: DataFrame, **values: Column) -> DataFrame:
    """Rows of the declared schema; what isn't given is null."""
    given = values | {c: F.col(c) for c in TAKEN}
    given["extracted_location"] = F.concat(F.lit("study/"), values["study_name"], F.lit("/"))
    return df.select(*[given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in STUDY])


def opengwas(entries: DataFrame, found: DataFrame) -> DataFrame:
    """Studies of folders (directory, trait, population, category, nsnp, sample_size, log): those of the entry's population, with enough SNPs and a sample size.

    The heritability is what the log of the regression says, if it says any.
    """
    t = _at(entries, found, "directory", "opengwas")
    t = t.where((F.col("population") == _named(POPULATIONS, F.col("ancestry"))) & (F.col("nsnp").cast("double") >= LEAST_SNPS) & F.col("sample_size").isNotNull())
    scraped = heritability(t.select("directory", "log"), "log", ["directory"]).distinct()
    t = t.join(scraped, "directory", "left")
    name = F.regexp_replace(F.substring_index("directory", "/", -1), "_", "-")
    return _studies(t, study_name=name, trait=name, trait_name=F.col("trait"), sample_size=F.col("sample_size"), category=F.lower(F.coalesce("category", F.lit("continuous"))), study_location=F.col("directory"), heritability=F.col("heritability"), heritability_se=F.col("heritability_se"))


def besd(entries: DataFrame, found: DataFrame, probes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(studies, problems): a study for each autosomal probe of the file sets (path, files, tissue, cell_type, category, cis_trans, sample_size).

    ``probes``: path, chr, probe, gene.  Problems (study_location, problem) are
    file sets with files or metadata missing, or with a cell type that isn't
    known; they give no studies.
    """
    t = _at(entries, found, "path", "besd")
    problem = F.when(F.col("files") < BESD_FILES, "files missing").when(F.col("tissue").isNull() | F.col("sample_size").isNull(), "tissue or sample size missing").when(~F.col("cell_type").isin(*CELL_TYPES), "cell type not valid")
    t = t.withColumn("problem", problem)
    p = probes.where(F.col("chr").try_cast("int").between(1, 22)).select("path", "probe", "gene")
    good = t.where("problem IS NULL").join(p, "path")
    name = dashed(F.concat_ws("-", F.substring_index("data_location", "/", -1), F.substring_index("path", "/", -1), "probe"))
    kind, parse = _named(TYPE_NAMES, F.col("data_type")), F.col("bespoke_parsing")
    # a name without such a place is taken whole
    cis = F.regexp_replace(F.regexp_replace(name, "^.*cis-(chr[^:]+-[^:]+:[^:]+).*$", "$1"), "-", ":")
    trans = F.concat(F.lit("chr"), F.regexp_replace(F.regexp_replace(name, "^.*trans-(.*):clu.*$", "$1"), "-", ":"))
    place = F.when(F.col("cis_trans") == "cis", cis).when(F.col("cis_trans") == "trans", trans)
    words = lambda *w: F.concat_ws(" ", *w)
    trait = F.when(parse == "interval_sqtl", words("gene", "tissue", kind, place)).when(parse == "godmc", words("tissue", "probe", kind)).otherwise(words("gene", "tissue", kind))
    ensg = F.nullif(F.regexp_extract("probe", "(ENSG[0-9]+)", 1), F.lit(""))
    studies = _studies(good, study_name=name, trait=name, trait_name=trait, sample_size=F.col("sample_size"), category=F.lower(F.coalesce("category", F.lit("continuous"))), study_location=F.col("path"), probe=F.col("probe"), gene=F.col("gene"), ensg=ensg, tissue=F.col("tissue"), cell_type=F.col("cell_type"))
    return studies, t.where("problem IS NOT NULL").select(F.col("path").alias("study_location"), "problem")


def tsv(entries: DataFrame, found: DataFrame) -> DataFrame:
    """Studies of listed files (data_location, study_location, study_name, trait, sample_size, category, gene, tissue) whose location matches the entry's expression."""
    e = small(entries.where("data_format = 'tsv'"), "the study list").alias("e")
    t = found.alias("f").join(e, (F.col("f.data_location") == F.col("e.data_location")) & F.rlike(F.col("f.study_location"), F.col("e.id_pattern"))).select("f.*", *[F.col(f"e.{c}") for c in TAKEN])
    name, measured = F.regexp_replace("study_name", "_", "-"), F.col("data_type") != "phenotype"
    return _studies(t, study_name=name, trait=name, trait_name=F.col("trait"), sample_size=F.col("sample_size"), category=F.col("category"), study_location=F.col("study_location"), gene=F.when(measured, F.col("gene")), tissue=F.when(measured, F.col("tissue")))


def to_process(found: list[DataFrame], leave: list[DataFrame]) -> DataFrame:
    """The studies of all formats without those in ``leave`` (study_name: processed before, or to be ignored); ValueError if a name comes twice."""
    studies = found[0]
    for f in found[1:]:
        studies = studies.unionByName(f)
    twice = studies.groupBy("study_name").count().where("count > 1").orderBy("study_name").limit(5).collect()
    if twice:
        raise ValueError(f"study names are not unique: {[r['study_name'] for r in twice]}")
    for gone in leave:
        studies = studies.join(gone.select("study_name").distinct(), "study_name", "left_anti")
    return studies
