"""Rows, ids and tokens that many documents share: spread over tasks, with the same results."""

import random

import pytest
from pyspark.sql import functions as F

from lociframe.llm import op3_join, op7_vectors, op8_mix, op10_lm


@pytest.fixture(scope="module")
def many(spark):
    """20 000 equal rows, as many without id and text, and some others."""
    rng = random.Random(4)
    other = [(i, " ".join(rng.choices(["alpha", "beta", "gamma", "delta"], k=rng.randint(1, 30))), f"s{i % 3}", i) for i in range(300)]
    equal = spark.range(20_000).select(F.lit(7000).cast("long").alias("doc_id"), F.lit("one text for all").alias("text"), F.lit("s1").alias("source"), F.col("id").alias("extra"))
    blank = spark.range(20_000).select(F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("string").alias("text"), F.lit(None).cast("string").alias("source"), F.col("id").alias("extra"))
    return spark.createDataFrame(other, "doc_id long, text string, source string, extra long").union(equal).union(blank).repartition(8)


def test_mix_counts_equal_rows_before_it_orders_them(spark, many):
    plan = op8_mix.Plan(many)
    assert plan.groups.count() == 302 and plan.groups.agg(F.sum("copies")).first()[0] == 40_300
    got = op8_mix.mix(many)
    assert got.count() == 40_300
    per = {r["target"]: (r["taken"], r["n"]) for r in got.where("size > 0").groupBy("target").agg(F.sum("taken").alias("taken"), F.max("size").alias("n")).collect()}
    assert all(abs(taken - target) <= 4 * n for target, (taken, n) in per.items())
    # of equal rows each has a place of its own: their finish times are as far apart as their sizes
    sums = [r["_mx_sum"] for r in plan.rows().where("doc_id = 7000").orderBy("_mx_sum").collect()]
    assert len(sums) == 20_000 and {b - a for a, b in zip(sums, sums[1:], strict=False)} == {4}


def test_mixture_takes_as_many_of_equal_rows_as_it_says(spark, many):
    want = {r["doc_id"]: r["n"] for r in op8_mix.mix(many).where("size > 0").groupBy("doc_id").agg(F.sum(F.col("taken") / F.col("size")).alias("n")).collect()}
    out = op8_mix.mixed(many).where("text IS NOT NULL").groupBy("doc_id").agg(F.count("*").alias("n"), F.count_distinct("extra").alias("kinds")).collect()
    assert {r["doc_id"]: r["n"] for r in out} == {k: v for k, v in want.items() if v}
    hot = next(r for r in out if r["doc_id"] == 7000)
    assert hot["kinds"] == min(20_000, hot["n"])  # no row is taken twice before each was taken once


def test_language_model_scores_copies_as_documents_of_their_own(spark, many, monkeypatch):
    some = many.where("doc_id IS NULL OR doc_id <> 7000 OR extra < 300").where("doc_id IS NOT NULL OR extra < 300")
    good = some.where("doc_id % 3 = 1").select("doc_id").distinct()
    key = lambda rows: sorted((str(r["doc_id"]), r["n_words"], round(r["score"], 9), round(r["target_loss"], 9)) for r in rows)
    counted = key(op10_lm.score(some, good).collect())
    monkeypatch.setattr(op10_lm, "MANY_COPIES", 10**9)
    assert counted == key(op10_lm.score(some, good).collect()) and len(counted) == 900
    assert op10_lm._dealt(many, good)[0].groupBy("chunk").count().count() == op10_lm.LEAST_CHUNKS


def test_texts_of_one_id_are_spread_over_chunks_and_equal_rows_are_one(spark):
    t = spark.range(4000).select(F.lit(5).cast("long").alias("doc_id"), F.concat(F.lit("w"), F.col("id")).alias("text"))
    rows, _ = op10_lm._dealt(t, t.limit(1))
    per = [r["count"] for r in rows.groupBy("chunk").count().collect()]
    assert len(per) == op10_lm.LEAST_CHUNKS and max(per) < 1.3 * min(per) and rows.where("is_target").count() == 4000
    same = t.select("doc_id", F.lit("w").alias("text"))
    rows, _ = op10_lm._dealt(same.union(t), t.limit(1))
    assert rows.count() == 4001 and rows.agg(F.max("copies")).first()[0] == 4000
    assert op10_lm.score(same, t.limit(0)).count() == 4000


def test_language_model_exchange_follows_the_keys(spark):
    rng = random.Random(2)
    words = ["".join(rng.choices("abcdefghij", k=5)) for _ in range(3000)]
    texts = [(i, " ".join(rng.choices(words, k=200))) for i in range(640)]
    per_mb = {}
    for share in (8, 64):
        part = spark.createDataFrame(texts[: 10 * share], "doc_id long, text string")
        size = sum(len(t) for _, t in texts[: 10 * share])
        rows, _ = op10_lm._dealt(part, part.limit(0), chunk_bytes=size // share)
        sent = op10_lm._counted(rows, 16)  # far more buckets than keys of a chunk
        n, keys, least = sent.agg(F.count("*"), F.sum("n"), F.min("n")).first()
        assert n <= keys and least >= 1
        per_mb[rows.select("chunk").distinct().count()] = n / size
    assert len(per_mb) == 2 and max(per_mb.values()) < 1.1 * min(per_mb.values())


def test_vectors_of_any_size_link(spark):
    rows = [(1, 0, [1e200, 1e200]), (2, 0, [2e200, 1.9e200]), (3, 0, [1e-170, 1e-170]), (4, 0, [5e-324, 5e-324]), (5, 0, [1.0, 1.0]), (6, 0, [1e200, -1e200]), (7, 0, [0.0, 0.0]), (8, 0, [1e308, 1e308])]
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in op7_vectors.near_duplicates(spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")).collect()}
    assert got == {**{i: (5, 1) for i in (1, 2, 3, 4, 5, 8)}, 6: (0, 6), 7: (0, 7)}


def test_crowded_tokens_give_the_same_components(spark, monkeypatch):
    rng = random.Random(6)
    base = [f"k{i}" for i in range(12)]
    texts = [(i, " ".join([*base[:3], *(rng.choice("abcdefgh") + str(rng.randrange(2)) for _ in range(6)), *base[3 : 3 + rng.randint(0, 9)]])) for i in range(500)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(5)
    run = lambda: sorted(map(tuple, op3_join.components(docs, 2, 60).collect()))
    want = run()
    monkeypatch.setattr(op3_join, "TOKEN_BLOCK", 5)
    assert run() == want
    sets = {i: {tuple(t.split()[k : k + 2]) for k in range(len(t.split()) - 1)} for i, t in texts}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in sets:
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= 60 * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    assert want == sorted((i, len(s), find(i)) for i, s in sets.items()) and len({w[2] for w in want}) < 500
