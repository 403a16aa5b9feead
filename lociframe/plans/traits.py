"""Traits of common and rare variant studies: which rare studies repeat others, and which studies of the two kinds belong together.

Pairs are found step by step, each an equi-join on the data type and a normal
form of the trait.  Steps of one stage see the same studies; what a stage has
paired leaves before the next.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

COLUMNS = ["data_type", "study_name_common", "study_name_rare", "trait_common", "trait_rare"]


def _sub(text: Column, *rules: tuple[str, str]) -> Column:
    """Each rule (pattern, new) replaces its first match."""
    return reduce(lambda t, r: F.regexp_replace(t, f"^((?s:.*?)){r[0]}" if not r[0].startswith(("^", ".*")) else r[0], f"$1{r[1]}" if not r[0].startswith(("^", ".*")) else r[1]), rules, text)


def _joined(step: str, common: DataFrame, common_key: Column, rare: DataFrame, rare_key: Column, *more: str) -> DataFrame:
    """Pairs of one step; ``more``: columns that must agree besides the data type and the key."""
    side = lambda t, key, mark: t.select("data_type", *more, key.alias("_key"), F.col("study_name").alias(f"study_name_{mark}"), F.col("trait").alias(f"trait_{mark}"))
    pairs = side(common, common_key, "common").join(side(rare, rare_key, "rare"), ["data_type", "_key", *more])
    return pairs.select(*COLUMNS, F.lit(step).alias("step"))


def _left(studies: DataFrame, pairs: DataFrame, mark: str) -> DataFrame:
    return studies.join(pairs.select(F.col(f"study_name_{mark}").alias("study_name")).distinct(), "study_name", "left_anti")


def without_repeats(meta: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(kept, left out) of rare variant studies (release, study_name, trait, trait_original, category, data_type, field) of three releases.

    From ``bm`` self-reported and medication traits go; from ``gb`` binary
    traits, categorical ones but for operations and treatments, and continuous
    ones of a field that ``bm`` has as continuous; from ``az`` all but unions,
    blocks of diagnoses, proteins and metabolites.
    """
    t, kind, release = F.col("trait_original"), F.col("category"), F.col("release")
    told = (t.rlike("^Non cancer illness code self reported|Self Report")) | t.rlike("(?i)Treatment or Medication|medication for")
    procedure = t.rlike("(?i)operat|^Treatment|^Medication")
    had = meta.where((release == "bm") & (kind == "continuous")).select(F.col("field").alias("_field")).where("_field IS NOT NULL").distinct().withColumn("_had", F.lit(True))
    marked = meta.join(had, F.col("field") == F.col("_field"), "left")
    special = t.rlike("(?i)^union") | t.rlike("(?i)^41202#Block") | (F.col("data_type") == "protein") | F.col("trait").rlike("^NMR ")
    gone = F.when(release == "bm", told).when(release == "gb", (kind == "binary") | ((kind == "categorical") & ~procedure) | ((kind == "continuous") & F.col("_had"))).when(release == "az", ~special)
    marked = marked.withColumn("_gone", F.coalesce(gone, F.lit(False)))
    return marked.where("NOT _gone").select(*meta.columns), marked.where("_gone").select(*meta.columns)


#: Steps of the first stage: name, what the trait of either side holds, and its normal form on the common and the rare side.
TYPED: list[tuple[str, str, str, Callable[[Column], Column], Callable[[Column], Column]]] = [
    ("icd10", "main ICD10", "ICD10", lambda t: _sub(_sub(t, (".*(ICD10: [A-Z][0-9.]+).*", "$1")), (":", "")), lambda t: _sub(t, (".*(ICD10 [A-Z][0-9.]+):.*", "$1"))),
    ("medication", "Treatment/medication code", "Treatment/medication code", lambda t: _sub(t, (".*: ", "")), lambda t: _sub(t, (".*\\((.*)\\)", "$1"))),
    ("procedure", "Operative procedures", "Operative procedures", lambda t: t, lambda t: F.regexp_replace(_sub(t, ("OPCS4 \\(", "OPCS: ")), "\\)$", "")),
    ("operation", "Operation code", "Operation code", lambda t: _sub(t, (".*: ", "")), lambda t: F.regexp_replace(t, "Operation code \\((.*)\\)$", "$1")),
]


def paired(common: DataFrame, rare: DataFrame, fields: DataFrame, manual: DataFrame) -> DataFrame:
    """(COLUMNS, step) of common and rare studies (data_type, study_name, trait, gene; rare ones with field) that belong together.

    ``fields``: study_name and field of common studies, from their notes; a
    field pairs where it does so once only.  ``manual``: pairs made by hand.
    """
    trait = F.col("trait")
    proteins = rare.where("data_type = 'protein'")
    first = [_joined("protein", common.where("data_type = 'protein'"), F.get(F.split("study_name", ":"), F.lit(2)), proteins, F.get(F.split("trait", " "), F.lit(2)), "gene")]
    typed = [proteins]
    for step, held, rare_held, key, rare_key in TYPED:
        here = rare.where(F.contains(trait, F.lit(rare_held)))
        typed.append(here)
        first.append(_joined(step, common.where(F.contains(trait, F.lit(held))), key(trait), here, rare_key(trait)))
    first = reduce(DataFrame.unionByName, first)
    # of the rare ones all of a kind with a step of its own leave, paired or not
    of_kind = reduce(DataFrame.unionByName, [t.select(F.col("study_name").alias("study_name_rare")) for t in typed])
    common, others = _left(common, first, "common"), _left(rare, of_kind, "rare")
    union = _sub(_sub(trait, (" \\(union\\)", "")), ("Chapter [A-Z]+ ", ""))
    second = [
        _joined("union", common, trait, rare.where(F.contains(trait, F.lit("union"))), union),
        _joined("trait", common, trait, rare, trait),
        _joined("form", common, _sub(trait, ("/", " ")), others, F.regexp_replace(_sub(trait, (" - ", ": ")), " \\([0-9].*\\)$", "")),
    ]
    second = reduce(DataFrame.unionByName, second)
    common, others = _left(common, second, "common"), _left(others, second, "rare")
    noted = common.drop("field").join(fields.where("field <> ''"), "study_name").select("study_name", "trait", "field")
    # a field pairs once if each side has it once, so others leave before the join and a shared field makes no pairs
    once = lambda t: t.join(t.groupBy("field").agg(F.count("*").alias("_n")).where("_n = 1").select("field"), "field", "left_semi")
    by_field = once(noted.toDF("study_name_common", "trait_common", "field")).join(once(others.select("field", F.col("study_name").alias("study_name_rare"), F.col("trait").alias("trait_rare"))), "field")
    by_field = by_field.select(F.lit("phenotype").alias("data_type"), *COLUMNS[1:], F.lit("field").alias("step"))
    blocks = others.where(trait.rlike("^[A-Z][0-9].*-[A-Z][0-9].*\\(union\\)"))
    by_block = _joined("block", common, trait, blocks, _sub(F.regexp_replace(trait, "^[A-Z][0-9]+-[A-Z][0-9]+ ", ""), (" \\(union\\)", "")))
    by_hand = manual.distinct().select(F.lit("phenotype").alias("data_type"), *COLUMNS[1:], F.lit("manual").alias("step"))
    return reduce(DataFrame.unionByName, [first, second, by_field, by_block, by_hand])
