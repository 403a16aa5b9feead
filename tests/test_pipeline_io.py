"""Sources, sinks and the queue worker on files."""

import gzip
import json
import zipfile

import pytest

from lociframe.schemas import _schema, validate, violations
from lociframe.sources import readers as R
from lociframe.sources import sinks as SK
from lociframe.streaming import queue as Q


def test_text_sources(spark, tmp_path):
    a, schema = tmp_path / "a.tsv.gz", _schema("SNP:s EA:s P:d")
    a.write_bytes(gzip.compress(b"SNP\tEA\tP\n1:2_A_T\tT\t0.5\n1:3_A_T\tNA\tNA\n"))
    df = R.delimited(spark, str(a), schema)
    assert [tuple(r) for r in df.orderBy("SNP").collect()] == [("1:2_A_T", "T", 0.5), ("1:3_A_T", None, None)]
    assert R.union_of(spark, [str(a), str(tmp_path / "absent.tsv")], schema).count() == 2
    assert R.union_of(spark, [str(tmp_path / "absent.tsv")], schema).count() == 0
    with zipfile.ZipFile(tmp_path / "z.zip", "w") as z:
        z.writestr("x.tsv", "SNP\tEA\tP\nq\tT\t0.1\n")
    assert [tuple(r) for r in R.zipped(spark, str(tmp_path / "z.zip"), schema).collect()] == [("q", "T", 0.1)]
    assert {r["name"] for r in R.discover(spark, str(tmp_path), "*.tsv.gz").collect()} == {"a"}


def test_sidecars_and_headerless(spark, tmp_path):
    (tmp_path / "m.json").write_text(json.dumps({"trait": "bmi", "n": None}, indent=1))
    s = _schema("trait:s n:l build:s")
    assert [tuple(r) for r in R.sidecars(spark, str(tmp_path / "m.json"), s, ["trait"], {"build": "hg38"}).collect()] == [("bmi", None, "hg38")]
    (tmp_path / "x.bim").write_text("1\trs1\n")
    assert R.numbered_columns(spark, str(tmp_path / "x.bim"), "int string").first().X2 == "rs1"


def test_text_sink_keeps_a_header_without_rows(spark, tmp_path):
    SK.write_tsv(spark.createDataFrame([], "a long, b string"), str(tmp_path / "out"))
    part = next((tmp_path / "out").glob("part-*"))
    assert gzip.decompress(part.read_bytes()) == b"a\tb\n"
    SK.write_tsv(spark.range(3), str(tmp_path / "full"))
    assert R.delimited(spark, str(tmp_path / "full"), _schema("id:l")).count() == 3


def test_validation(spark):
    df = spark.createDataFrame([(1, 0.5), (1, 2.0)], "k long, p double")
    assert {r["check"]: r["n"] for r in violations(df, ["k"], {"p": (0, 1)}).collect()} == {"rows": 2, "range:p": 1, "key": 1}
    with pytest.raises(ValueError):
        validate(df, key=["k"])


def messages(path, rows):
    path.mkdir(exist_ok=True)
    body = lambda g: json.dumps({"metadata": {"guid": g, "p_value_threshold": 0.5}})
    (path / f"{len(list(path.iterdir()))}.json").write_text("\n".join(json.dumps({"kind": k, "value": body(g) if len(g) < 4 else g}) for k, g in rows))


def test_queue_serves_by_priority_and_sets_broken_messages_aside(spark, tmp_path):
    messages(tmp_path / "in", [("process", "g1"), ("in_progress", "g2"), ("delete", "g3"), ("process", "g3"), ("process", "{bad"), ("process", "Caught error {")])
    order = []

    def handle(m, kind):
        order.append((kind, sorted(r["guid"] for r in m.collect())))
        return m.select("guid")

    run = lambda: Q.start(spark, str(tmp_path / "in"), "kind string, value string", str(tmp_path / "out"), str(tmp_path / "cp"), handle).awaitTermination()
    run()
    assert order == [("in_progress", ["g2"]), ("process", ["g1"])]  # g3 was deleted before
    read = lambda p: spark.read.parquet(str(tmp_path / "out" / p)).collect()
    assert sorted(r["guid"] for r in read("results")) == ["g1", "g2"]
    assert [r["guid"] for r in read("tombstones")] == ["g3"] and [r["value"] for r in read("dead")] == ["{bad"]
    run()
    assert len(order) == 2


def test_queue_serves_a_failed_batch_again(spark, tmp_path):
    messages(tmp_path / "in", [("process", "g1"), ("in_progress", "g2")])
    calls = []

    def handle(m, kind):
        calls.append(kind)
        if calls == ["in_progress", "process"]:
            raise OSError("down")
        return m.select("guid")

    def run():
        Q.start(spark, str(tmp_path / "in"), "kind string, value string", str(tmp_path / "out"), str(tmp_path / "cp"), handle, retry=lambda action: action()).awaitTermination()

    with pytest.raises(Exception, match="down"):
        run()
    run()
    assert calls == ["in_progress", "process"] * 2
    assert sorted(r["guid"] for r in spark.read.parquet(str(tmp_path / "out/results")).collect()) == ["g1", "g2"]


def test_retry_backs_off(spark):
    waits, calls = [], []

    def action():
        calls.append(1)
        if len(calls) < 4:
            raise OSError
        return 7

    assert Q.with_retry(action, sleep=waits.append) == 7 and waits == [2.0, 4.0, 8.0]
