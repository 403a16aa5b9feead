"""Study discovery: patterns, naming, checks and problems of each format."""

import pytest

from lociframe.plans import discovery as DI

NAMES = "data_type string, source string, data_format string, ancestry string, reference_build string, p_value_threshold double, variant_type string, coverage string, bespoke_parsing string, data_location string, id_pattern string"


def entry(kind, where, pattern, data_type="phenotype", parse="none", **changed):
    row = {"data_type": data_type, "source": "s", "data_format": kind, "ancestry": "EUR", "reference_build": "GRCh38", "p_value_threshold": 1.5e-4, "variant_type": "common", "coverage": "dense", "bespoke_parsing": parse, "data_location": where, "id_pattern": pattern}
    return tuple((row | changed).values())


def test_patterns_are_those_of_file_names(spark):
    cases = {("/d/a.b*", "/d/a.bcd"): True, ("/d/a.b*", "/d/axbcd"): False, ("/d/*", "/d/x/y"): False, ("/d/s?(1)", "/d/sA(1)"): True, ("/d/[x]", "/d/x"): False, ("/d/+", "/d/+"): True}
    t = spark.createDataFrame([(*k, v) for k, v in cases.items()], "pattern string, path string, want boolean")
    from pyspark.sql import functions as F

    assert all(r["got"] == r["want"] for r in t.select("want", F.rlike("path", DI.glob(F.col("pattern"))).alias("got")).collect())


def test_entries_are_checked(spark):
    sources = spark.createDataFrame([("s",)], "source string")
    good = spark.createDataFrame([entry("opengwas", "/g", "*")], NAMES)
    assert DI.checked(good, sources).count() == 1
    for changed in ({"data_format": "xlsx"}, {"coverage": "thin"}, {"reference_build": "T2T"}, {"variant_type": "odd"}, {"bespoke_parsing": "mine"}, {"data_type": "colour"}, {"source": "elsewhere"}):
        with pytest.raises(ValueError):
            DI.checked(spark.createDataFrame([entry("opengwas", "/g", "*", **changed)], NAMES), sources)


def test_folders_of_association_files(spark):
    e = spark.createDataFrame([entry("opengwas", "/g", "ukb_*")], NAMES)
    rows = [("/g/ukb_1", "T", "European", None, "1000000", 5, "x\nTotal Observed scale h2: 0.25 (1e-2)"), ("/g/ukb_2", "T", "African", "Categorical", "2000000", 5, ""), ("/g/ukb_3", "T", "European", "Categorical", "999999", 5, ""), ("/g/ukb_4", "T", "European", "Categorical", "2000000", None, ""), ("/g/other", "T", "European", None, "2000000", 5, ""), ("/g/ukb_5", "T", None, None, "2000000", 5, None), ("/g/ukb_6", "T", "European", "CATEGORICAL", "2000000", 7, None)]
    got = {r["study_name"]: r for r in DI.opengwas(e, spark.createDataFrame(rows, "directory string, trait string, population string, category string, nsnp string, sample_size long, log string")).collect()}
    assert set(got) == {"ukb-1", "ukb-6"}
    assert (got["ukb-1"]["heritability"], got["ukb-1"]["heritability_se"], got["ukb-1"]["category"], got["ukb-1"]["extracted_location"]) == (0.25, 0.01, "continuous", "study/ukb-1/")
    assert got["ukb-6"]["heritability"] is None and got["ukb-6"]["category"] == "categorical" and got["ukb-6"]["sample_size"] == 7


def test_probe_studies_their_names_and_problems(spark):
    e = spark.createDataFrame([entry("besd", "/b/iv", "*", "splice_variant", "interval_sqtl"), entry("besd", "/b/meth", "*", "methylation", "godmc"), entry("besd", "/b/gtex", "*", "gene_expression")], NAMES)
    sets = [("/b/iv/cis", 4, "blood", None, None, "cis", 9), ("/b/iv/trans", 5, "blood", None, None, "trans", 9), ("/b/meth/m", 4, "blood", "NK", "Categorical", "cis", 9), ("/b/gtex/liver_1.2", 4, "liver", None, None, None, 9), ("/b/gtex/few", 3, "liver", None, None, None, 9), ("/b/gtex/bare", 4, None, None, None, None, 9), ("/b/gtex/cell", 4, "liver", "Z cell", None, None, 9)]
    probes = [("/b/iv/cis", "1", "chr1_10_20:clu_3_+", "G1"), ("/b/iv/trans", "2", "7:30_40:clu_5_-", "G2"), ("/b/meth/m", "22", "cg0001", None), ("/b/gtex/liver_1.2", "3", "x_ENSG0042.7", "G3"), ("/b/gtex/liver_1.2", "X", "ENSG9", "G4"), ("/b/gtex/few", "1", "p", "G"), ("/b/gtex/cell", "1", "p", "G")]
    studies, problems = DI.besd(e, spark.createDataFrame(sets, "path string, files int, tissue string, cell_type string, category string, cis_trans string, sample_size long"), spark.createDataFrame(probes, "path string, chr string, probe string, gene string"))
    got = {r["study_name"]: (r["trait_name"], r["ensg"], r["category"]) for r in studies.collect()}
    assert got == {
        "iv-cis-chr1-10-20:clu-3-+": ("G1 blood sQTL chr1:10:20:clu:3:+", None, "continuous"),
        "iv-trans-7:30-40:clu-5--": ("G2 blood sQTL chr7:30:40", None, "continuous"),
        "meth-m-cg0001": ("blood cg0001 methQTL", None, "categorical"),
        "gtex-liver-1-2-x-ENSG0042-7": ("G3 liver eQTL", "ENSG0042", "continuous"),
    }
    assert {r["study_location"]: r["problem"] for r in problems.collect()} == {"/b/gtex/few": "files missing", "/b/gtex/bare": "tissue or sample size missing", "/b/gtex/cell": "cell type not valid"}


def test_listed_files_and_what_is_left_to_process(spark):
    e = spark.createDataFrame([entry("tsv", "/t", "new_.*\\.gz$", "protein"), entry("tsv", "/u", ".*", "phenotype")], NAMES)
    rows = [("/t", "/t/new_1.gz", "a_1", "A", 3, "continuous", "G", "plasma"), ("/t", "/t/old_1.gz", "a_2", "B", 3, "continuous", "G", "plasma"), ("/u", "/u/x", "b_1", "C", 3, "categorical", "G", "plasma")]
    t = DI.tsv(e, spark.createDataFrame(rows, "data_location string, study_location string, study_name string, trait string, sample_size long, category string, gene string, tissue string"))
    assert {r["study_name"]: (r["gene"], r["tissue"], r["category"]) for r in t.collect()} == {"a-1": ("G", "plasma", "continuous"), "b-1": (None, None, "categorical")}
    gone = spark.createDataFrame([("b-1",), ("b-1",)], "study_name string")
    assert [r["study_name"] for r in DI.to_process([t, t.limit(0)], [gone, gone.limit(0)]).collect()] == ["a-1"]
    with pytest.raises(ValueError, match="not unique"):
        DI.to_process([t, t], [])


def test_rare_studies_that_repeat_others_are_left_out(spark):
    from lociframe.plans import traits as TR

    rows = [
        ("bm", "b1", "t", "Non cancer illness code self reported: x", "binary", "phenotype", None), ("bm", "b2", "t", "Medication for pain", "binary", "phenotype", None), ("bm", "b3", "t", "Height", "continuous", "phenotype", "50"), ("bm", "b4", "t", "Self Report", None, "phenotype", None),
        ("gb", "g1", "t", "Date first reported", "binary", "phenotype", None), ("gb", "g2", "t", "Operative procedures", "categorical", "phenotype", None), ("gb", "g3", "t", "Colour", "categorical", "phenotype", None), ("gb", "g4", "t", "Height", "continuous", "phenotype", "50"), ("gb", "g5", "t", "Weight", "continuous", "phenotype", "51"),
        ("az", "a1", "t", "Union#x", "binary", "phenotype", None), ("az", "a2", "t", "41202#Block A", "binary", "phenotype", None), ("az", "a3", "t", "P", "continuous", "protein", None), ("az", "a4", "NMR x", "m", "continuous", "phenotype", None), ("az", "a5", "t", "Height", "continuous", "phenotype", "50"),
        ("zz", "z1", None, None, None, None, None),
    ]
    kept, gone = TR.without_repeats(spark.createDataFrame(rows, "release string, study_name string, trait string, trait_original string, category string, data_type string, field string"))
    assert sorted(r["study_name"] for r in kept.collect()) == ["a1", "a2", "a3", "a4", "b3", "g2", "g5", "z1"]
    assert sorted(r["study_name"] for r in gone.collect()) == ["a5", "b1", "b2", "b4", "g1", "g3", "g4"]
