"""Stored tables that change, tables by position, chain files, genotype panels, and the worker with state."""

import json
import math
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from lociframe.sources import chain, genotypes, positions, releases
from lociframe.streaming import uploads as U


def prints(path):
    """{file: (size, time)} of a stored table."""
    return {str(p.relative_to(path)): (p.stat().st_size, p.stat().st_mtime_ns) for p in Path(path).rglob("*.parquet")}


# ---- rewrites -------------------------------------------------------------------------------------------------


def test_an_update_rewrites_only_the_partitions_it_touches(spark, tmp_path):
    path = str(tmp_path / "t")
    releases.write_partitioned(spark.range(40).select(F.col("id").alias("k"), F.lit("old").alias("v"), (F.col("id") % 4).cast("int").alias("part")), path, "part")
    before = prints(path)
    assert releases.update_where(spark, path, "part", F.col("k").isin(2, 6), v=F.lit("new")) == [2]
    after, rows = prints(path), {r["k"]: r["v"] for r in spark.read.parquet(path).collect()}
    assert rows == {k: "new" if k in (2, 6) else "old" for k in range(40)}
    assert {f for f in before if f in after and before[f] == after[f]} == {f for f in before if not f.startswith("part=2")}
    assert not {f for f in before if f.startswith("part=2")} & set(after)
    assert releases.update_where(spark, path, "part", F.col("k") > 99, v=F.lit("x")) == [] and prints(path) == after


def test_keys_are_replaced_and_emptied_partitions_go(spark, tmp_path):
    path = str(tmp_path / "t")
    t = spark.range(12).select(F.col("id").alias("k"), F.lit(0).alias("run"), (F.col("id") % 3).cast("int").alias("part"))
    releases.write_partitioned(t.union(t), path, "part")  # two rows of each key
    releases.replace_keys(spark, path, "part", t.where("k = 4").withColumn("run", F.lit(1)), "k", t.where("part = 2"))
    got = sorted((r["k"], r["run"]) for r in spark.read.parquet(path).collect())
    assert got == sorted([(k, 0) for k in range(12) if k % 3 != 2 and k != 4] * 2 + [(4, 1)])
    assert {p.name for p in Path(path).glob("part=*")} == {"part=0", "part=1"}
    with pytest.raises(ValueError, match="not named"):
        releases.rewritten(spark, path, "part", t.where("k = 0"), lambda rows: rows.withColumn("part", F.lit(1)))


def test_readers_see_all_tables_before_or_after_a_release(spark, tmp_path):
    root = str(tmp_path / "r")
    studies = spark.range(6).select(F.col("id").alias("study"))
    pairs = studies.toDF("a").crossJoin(studies.toDF("b")).where("a < b")
    releases.publish(spark, root, {"studies": studies, "pairs": pairs, "notes": spark.range(3)})
    first = releases.current(spark, root)
    reader = releases.read(spark, root, "pairs")  # opened before the change
    gone = studies.where("study IN (1, 4)")
    assert releases.without_studies(spark, root, {"studies": ["study"], "pairs": ["a", "b"]}, gone) == ["pairs", "studies"]
    second = releases.current(spark, root)
    assert second["notes"] == first["notes"] and second["pairs"] != first["pairs"] and len(second) == 3
    assert sorted(r["study"] for r in releases.read(spark, root, "studies").collect()) == [0, 2, 3, 5]
    assert releases.read(spark, root, "pairs").count() == 6 and reader.count() == 15
    assert releases.without_studies(spark, root, {"studies": ["study"], "pairs": ["a", "b"]}, gone) == [] and releases.current(spark, root) == second

    def broken(i):
        raise OSError("the writer ends here")

    bad = studies.select(F.udf(broken, "long")("study").alias("study"))
    with pytest.raises(Exception, match="the writer ends here"):
        releases.publish(spark, root, {"pairs": pairs, "studies": bad})
    assert releases.current(spark, root) == second


def test_an_application_can_remove_what_it_wrote(spark):
    from lociframe import scratch

    path = scratch.fresh(spark, "some")
    spark.range(3).write.parquet(path)
    checked = scratch.cut_lineage(spark.range(5))
    assert checked.count() == 5 and Path(path).exists()
    scratch.clear(spark)
    assert not Path(path).exists() and scratch.cut_lineage(spark.range(4)).count() == 4


# ---- positions ------------------------------------------------------------------------------------------------


def test_only_the_files_of_a_region_are_read(spark, tmp_path):
    path = str(tmp_path / "p")
    t = spark.range(4000).select((F.col("id") % 4 + 1).alias("chr"), (F.col("id") * 2003 % 10_000_000).alias("bp"), F.concat(F.lit("q"), F.col("id") % 7).alias("probe"), (F.col("id") % 100 / 100.0).alias("p"))
    positions.write(t, path, probe="probe")
    assert spark.read.parquet(f"{path}/rows").count() == 4000
    rows = [tuple(r) for r in t.collect()]
    regions = spark.createDataFrame([(2, 3_000_000, 3_400_000, "x"), (4, 9_999_000, 12_000_000, "y")], "chr long, start long, stop long, name string")
    needed = {"chr=2/bin=3", "chr=4/bin=9"}
    for f in Path(path, "rows").rglob("*.parquet"):  # no other file may be opened
        if not any(n in str(f) for n in needed | {"chr=3/bin=5", "chr=3/bin=6"}):
            f.write_bytes(b"not to be read")
    got = sorted((r["chr"], r["bp"], r["name"]) for r in positions.within(spark, path, regions).collect())
    assert got == sorted((c, b, n) for c, b, _, _ in rows for k, lo, hi, n in ((2, 3_000_000, 3_400_000, "x"), (4, 9_999_000, 12_000_000, "y")) if c == k and lo <= b <= hi) and got
    assert sorted(r["bp"] for r in positions.around(spark, path, 3, 6_000_000, 300).collect()) == sorted(b for c, b, _, _ in rows if c == 3 and abs(b - 6_000_000) <= 300_000)
    full = str(tmp_path / "full")
    positions.write(t, full, probe="probe")
    got = sorted((r["chr"], r["bp"]) for r in positions.of_probe(spark, full, "q3", center=5_000_000, window_kb=1500, p=0.5).collect())
    assert got == sorted((c, b) for c, b, q, p in rows if q == "q3" and p <= 0.5 and abs(b - 5_000_000) <= 1_500_000) and got
    assert positions.of_probe(spark, full, "absent").count() == 0
    assert positions.within(spark, full, regions.limit(0)).count() == 0


# ---- chains ---------------------------------------------------------------------------------------------------

CHAIN = """# a comment
chain 500 chr1 1000 + 100 400 chr1 2000 + 1100 1390 7
100\t50\t40
150

chain 400 chr1 1000 + 600 700 chr1 2000 - 300 400 8
100

chain 900 chr2 1000 + 0 50 chrX 500 + 10 60 9
50
chain 100 chr1 1000 + 90 120 chr3 800 + 0 30 10
30
"""


def plain_lift(c, p):
    """Where a position goes, by hand from the chains above."""
    if c == "1" and 100 <= p < 200:
        return "1", p + 1000
    if c == "1" and 250 <= p < 400:
        return "1", p + 990
    if c == "1" and 600 <= p < 700:
        return "1", 2000 - 1 - (300 + p - 600)
    if c == "2" and p < 50:
        return "X", p + 10
    if c == "1" and 90 <= p < 100:
        return "3", p - 90  # the chain of higher score has the rest
    return None


def test_liftover_by_a_chain_file(spark, tmp_path):
    (tmp_path / "a.chain").write_text(CHAIN)
    pieces = chain.segments(spark, str(tmp_path / "a.chain"))
    assert sorted((r["chain"], r["start"], r["stop"], r["to_chr"], r["to_start"], r["reverse"]) for r in pieces.collect()) == sorted([("7", 100, 200, "1", 1100, False), ("7", 250, 400, "1", 1240, False), ("8", 600, 700, "1", 300, True), ("9", 0, 50, "X", 10, False), ("10", 90, 120, "3", 0, False)])
    points = spark.createDataFrame([(c, p, f"{c}:{p}") for c in ("1", "2", "5") for p in range(0, 800, 3)] + [("1", 150, "again"), (None, 5, "n"), ("1", None, "m")], "chr string, bp long, name string")
    for keep in (False, True):
        there, gone = chain.lifted(points, pieces, keep_moved=keep)
        want = {}
        for r in points.collect():
            to = plain_lift(r["chr"], r["bp"]) if r["bp"] is not None else None
            if to and (keep or to[0] == r["chr"]):
                want[r["name"]] = to
        assert {r["name"]: (r["to_chr"], r["to_bp"]) for r in there.collect()} == want and want
        assert there.count() + gone.count() == points.count() and set(want) & {r["name"] for r in gone.collect()} == set()


# ---- genotypes ------------------------------------------------------------------------------------------------


def packed(dosage):
    """A genotype file's bytes from dosages of the first allele (variants x samples, -1 missing)."""
    code = {2: 0, -1: 1, 1: 2, 0: 3}
    out = bytearray(genotypes.MAGIC)
    for row in dosage:
        for i in range(0, len(row), 4):
            out.append(sum(code[int(d)] << (2 * k) for k, d in enumerate(row[i : i + 4])))
    return bytes(out)


def test_panel_from_genotype_files(spark, tmp_path):
    rng = np.random.default_rng(6)
    base = rng.integers(0, 3, (30, 21))
    base[1:30:3] = np.where(rng.random((10, 21)) < 0.7, base[0:30:3], base[1:30:3])
    dosage = np.where(rng.random(base.shape) < 0.1, -1, base)
    dosage[5] = 1  # one that doesn't vary
    for name, part in (("a", dosage[:18]), ("b", dosage[18:])):
        (tmp_path / f"{name}.bed").write_bytes(packed(part))
    files = genotypes.files(spark, str(tmp_path / "*.bed"), 21)
    blocks = {r["path"]: r["path"].rsplit("/", 1)[-1][0] for r in files.collect()}
    rows = [(p, i, 1, 1000 * i + (0 if n == "a" else 18_000), *(("A", "G") if i % 2 else ("T", "C"))) for p, n in blocks.items() for i in range(18 if n == "a" else 12)]
    variants = spark.createDataFrame(rows, "path string, place int, chr int, bp int, a1 string, a2 string")
    ordered = genotypes.in_order(genotypes.decoded(files), variants)
    got = {(blocks[r["path"]], r["bp"]): r for r in genotypes.frequencies(ordered).collect()}
    turned = np.where(dosage < 0, -1, np.where((np.arange(30) % 2 == 0)[:, None], 2 - dosage, dosage))  # T, C become C, T
    for i, d in enumerate(turned):
        r = got["a" if i < 18 else "b", 1000 * i]
        known = d[d >= 0]
        assert r["turned"] == (i % 2 == 0) and r["n"] == len(known) and math.isclose(r["eaf"], known.mean() / 2) and r["snp"] == f"1:{1000 * i}_{'C_T' if i % 2 == 0 else 'A_G'}"
    for tile in (512, 5):
        pairs = {(r["lead"], r["proxy"]): r["r"] for r in genotypes.correlations(ordered, tile=tile).collect()}
        want = {}
        for lo, hi in ((0, 18), (18, 30)):
            for i in range(lo, hi):
                for j in range(i + 1, hi):
                    both = (turned[i] >= 0) & (turned[j] >= 0)
                    x, y = turned[i][both], turned[j][both]
                    if x.std() > 0 and y.std() > 0:
                        name = lambda k: f"1:{1000 * k}_{'C_T' if k % 2 == 0 else 'A_G'}"
                        want[name(i), name(j)] = np.corrcoef(x, y)[0, 1]
        assert set(pairs) == set(want) and all(math.isclose(pairs[k], v, abs_tol=1e-9) for k, v in want.items())
    (tmp_path / "c.bed").write_bytes(b"no such file format")
    with pytest.raises(Exception, match="not a variant-major genotype file"):
        genotypes.decoded(genotypes.files(spark, str(tmp_path / "c.bed"), 21)).collect()


# ---- the worker with state ------------------------------------------------------------------------------------


def body(guid):
    return json.dumps({"metadata": {"guid": guid, "p_value_threshold": 0.5}})


class Worker:
    def __init__(self, spark, path):
        self.spark, self.path, self.served = spark, path, []

    def deliver(self, *rows):
        folder = self.path / "in"
        folder.mkdir(exist_ok=True)
        (folder / f"{len(list(folder.iterdir()))}.json").write_text("\n".join(json.dumps({"kind": k, "value": body(g) if not g.startswith("{") and not g.startswith("Caught") else g}) for k, g in rows))

    def run(self, on_step=lambda step, number: None):
        def handle(m):
            self.served.append(sorted((r["guid"], r["kind"], r["again"]) for r in m.collect()))
            return m.select("guid", F.explode(F.array(F.lit("s1"), F.lit("s2"))).alias("signal"))

        U.serve(self.spark, str(self.path / "in"), str(self.path / "out"), str(self.path / "cp"), handle, "signal string", on_step).awaitTermination()

    def results(self):
        return sorted((r["guid"], r["signal"], r["attempt"]) for r in U.results(self.spark, str(self.path / "out"), "signal string").collect())


def both(guid, attempt=1):
    return [(guid, "s1", attempt), (guid, "s2", attempt)]


def test_a_later_deletion_removes_earlier_results(spark, tmp_path):
    w = Worker(spark, tmp_path)
    w.deliver(("process", "g1"), ("process", "g2"), ("process", "g3"), ("process", "{bad"), ("process", "Caught error {"))
    w.run()
    assert w.results() == both("g1") + both("g2") + both("g3")
    assert [r["value"] for r in spark.read.json(str(tmp_path / "out/dead")).collect()] == ["{bad"]
    w.deliver(("delete", "g1"), ("process", "g4"), ("delete", "g5"), ("process", "g5"))
    w.run()
    assert w.results() == both("g2") + both("g3") + both("g4") and w.served[-1] == [("g4", "process", False)]
    w.deliver(("in_progress", "g1"), ("in_progress", "g6"), ("process", "g2"))  # g1 was deleted since
    w.run()
    assert w.served[-1] == [("g2", "process", True), ("g6", "in_progress", False)] and w.results() == both("g2") + both("g3") + both("g4") + both("g6")
    w.deliver(("process", "g1"))  # a new upload of what was deleted
    w.run()
    assert w.results() == both("g1") + both("g2") + both("g3") + both("g4") + both("g6") and w.served[-1] == [("g1", "process", False)]
    n = len(w.served)
    w.run()
    assert len(w.served) == n


@pytest.mark.parametrize("step", ["marked", "stored"])
def test_a_run_that_ends_half_way_is_served_once_more(spark, tmp_path, step):
    w = Worker(spark, tmp_path)
    w.deliver(("process", "g0"))
    w.run()
    w.deliver(("process", "g1"), ("process", "g2"), ("delete", "g0"))

    def stop(at, number):
        if at == step:
            raise OSError("the worker ends here")

    with pytest.raises(Exception, match="the worker ends here"):
        w.run(stop)
    assert list((tmp_path / "out/in_progress").glob("*/attempt=1"))  # what was begun is known
    assert w.results() == (both("g0") if step == "marked" else both("g1") + both("g2"))
    n = len(w.served)
    w.run()
    assert len(w.served) == n + 1 and w.served[-1] == [("g1", "process", False), ("g2", "process", False)]
    assert w.results() == both("g1", 2) + both("g2", 2) and not list((tmp_path / "out/in_progress").glob("*"))


def test_uploads_meet_the_warehouse_and_the_uploads_they_name(spark):
    up = spark.createDataFrame([("u1", "b1", "u1_a", 100, 1e-8, 1e-5, ["u2", "u1"]), ("u1", "b1", "u1_b", 300, 1e-2, 1e-5, ["u2", "u1"]), ("u1", "b2", "u1_c", 500, 1e-9, 1e-5, ["u2", "u1"]), ("u3", "b1", "u3_a", 100_000, 1e-9, 1e-5, [])], "guid string, block string, ident string, bp long, min_p double, p_value_threshold double, compare array<string>")
    warehouse = spark.createDataFrame([("b1", "w1", 50_100, 1e-9), ("b1", "w2", 50_101, 1e-9), ("b1", "w3", 120, 1e-5), ("b3", "w4", 500, 1e-9), ("b1", "u1_a", 130, 1e-9)], "block string, ident string, bp long, min_p double")
    others = spark.createDataFrame([("u2", "b1", "u2_a", 9_999_999, 1e-4, 1e-3), ("u2", "b1", "u2_b", 5, 1e-2, 1e-3), ("u2", "b9", "u2_c", 5, 1e-9, 1e-3), ("u3", "b1", "u3_a", 5, 1e-9, 1e-3), ("u2", "b2", "w9", 5, 1e-9, 1e-3)], "guid string, block string, ident string, bp long, min_p double, p_value_threshold double")
    got = sorted((r["guid"], r["block"], r["ident"], r["origin"]) for r in U.compared(up, warehouse, others).collect())
    assert got == [("u1", "b1", "u1_a", "upload"), ("u1", "b1", "u2_a", "other"), ("u1", "b1", "w1", "warehouse"), ("u1", "b2", "u1_c", "upload"), ("u1", "b2", "w9", "other"), ("u3", "b1", "u3_a", "upload"), ("u3", "b1", "w1", "warehouse"), ("u3", "b1", "w2", "warehouse")]
