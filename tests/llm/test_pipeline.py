"""The corpus pipeline: every stage on odd rows, and the whole against plain versions of its stages."""

import hashlib
import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as cp
from lociframe import scratch
from lociframe.llm import op1_quality, op5_rules, op8_mix, op9_bpe

from .test_operators import brute_components, odd  # noqa: F401


@pytest.mark.parametrize("name", [n for n, _ in cp.STAGES[:-1]])
def test_stage_on_odd_rows(spark, sf_dir, odd, name):  # noqa: F811
    stage = dict(cp.STAGES)[name]
    out = stage(spark, odd, sf_dir)
    assert out.schema.fieldNames() == odd.columns
    known = Counter(map(str, odd.collect()))
    got = Counter(map(str, out.collect()))
    assert set(got) <= set(known)
    if name != "mix":
        assert all(n <= known[r] for r, n in got.items())
    assert stage(spark, odd.limit(0), sf_dir).count() == 0


def test_encoding_stage_on_odd_rows(spark, sf_dir, odd):  # noqa: F811
    out = cp.encode(spark, odd, sf_dir).collect()
    assert len(out) == odd.count() and sum(r["doc_id"] is None for r in out) == 2
    assert {r["n_tokens"] for r in out if r["decoded_sha256"] == hashlib.sha256(b"").hexdigest()} == {0}
    assert cp.encode(spark, odd.limit(0), sf_dir).count() == 0


def test_pipeline_against_plain_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = {r["doc_id"]: r for r in docs.collect()}
    good = {r["doc_id"] for r in op1_quality.accepted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")).collect()}
    kept = {r["doc_id"] for r in op5_rules.judged(docs, ["doc_id"]).where("kept").collect()} & good
    comp = brute_components([(i, rows[i]["text"]) for i in sorted(kept)], 5, 80)
    single = {i for i in kept if comp[i][1] == i or not comp[i][0]}
    taken = {r["doc_id"]: r["taken"] // r["size"] for r in op8_mix.mix(docs.where(F.col("doc_id").isin(sorted(single)))).collect() if r["taken"]}
    bpe = op9_bpe.encoder()
    out = cp.run(spark, sf_dir).collect()
    assert len(good) < len(rows) and len(kept) < len(good) and len(single) < len(kept)
    assert Counter(r["doc_id"] for r in out) == Counter(taken)
    for r in out:
        assert r["ids"] == bpe.encode(rows[r["doc_id"]]["text"]).tolist() and r["n_tokens"] == len(r["ids"])


def test_intermediate_tables_are_removed(spark, sf_dir):
    folder = os.path.dirname(os.path.dirname(cp.run(spark, sf_dir).inputFiles()[0].removeprefix("file://")))
    assert folder.startswith(scratch.base(spark)) and os.listdir(folder) == ["encode"]
