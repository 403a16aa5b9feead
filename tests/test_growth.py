"""Steps that must not grow with the square of a table, held by the rows that they give."""

import numpy as np
import pandas as pd
import pytest

from lociframe.operators import kernels as K
from lociframe.plans import registry
from lociframe.plans import traits as TR

from .growth import most_rows

registry.load()


def test_shared_fields_make_no_pairs(spark):
    n = 300
    side = "data_type string, study_name string, trait string, gene string"
    common = spark.createDataFrame([("phenotype", f"c{i}", f"noted {i}", "g") for i in range(n)], side)
    rare = spark.createDataFrame([("phenotype", f"r{i}", f"words {i}", "h", "own" if i == 0 else "f") for i in range(n)], side + ", field string")
    fields = spark.createDataFrame([(f"c{i}", "own" if i == 0 else "f") for i in range(n)], "study_name string, field string")
    out = TR.paired(common, rare, fields, spark.createDataFrame([], ", ".join(f"{c} string" for c in TR.COLUMNS[1:])))
    assert most_rows(out) <= 2 * n
    assert [tuple(r) for r in out.collect()] == [("phenotype", "c0", "r0", "noted 0", "words 0", "field")]


@pytest.mark.parametrize("name", ["k18_colocalisation", "k19_masked_colocalisation"])
def test_pairs_are_not_laid_out_by_snp(spark, sf_dir, name):
    of = [r["label"] for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("label").collect()]
    pairs = sum(of.count(v) * (of.count(v) - 1) // 2 for v in set(of))
    assert most_rows(registry.QUERIES[name](spark, sf_dir)) <= max(3 * pairs, 3 * 64 * len(of))


def test_tiles_give_what_the_joins_give(spark):
    """Studies with SNPs, values and signals of their own (far below another's too), in groups of several tiles."""
    rng = np.random.default_rng(3)
    rows = []
    for s in range(60):
        for snp in np.flatnonzero(rng.random(70) < (0.1 if s % 13 == 0 else 0.9)):
            value = None if rng.random() < 0.02 else float(rng.normal(0, 900 if s % 7 == 0 else 4))
            rows.append((s % 2, f"s{s}", f"o{s // 5}", int(snp), value))
    lbf = spark.createDataFrame(rows, "blk long, study string, own string, snp long, lbf double")
    s = lbf.select("blk", "study", "own").distinct()
    pairs = s.toDF("blk", "a", "x").join(s.toDF("blk", "b", "y"), "blk").where("a < b AND x <> y").select("a", "b")
    want = K.coloc(pairs, lbf).toPandas().sort_values(["a", "b"], ignore_index=True)
    for tile in (7, 1000):
        got = K.coloc_within(lbf, ["blk"], owner="own", tile=tile).drop("blk").toPandas().sort_values(["a", "b"], ignore_index=True)
        assert got[["a", "b", "nsnps", "ignored"]].equals(want[["a", "b", "nsnps", "ignored"]])
        assert np.allclose(got[[f"h{i}" for i in range(5)]], want[[f"h{i}" for i in range(5)]], atol=1e-9, equal_nan=True)
    assert want["h0"].isna().any() and want["h0"].notna().any()


def test_second_fits_are_made_together(spark):
    """Studies with SNPs left out are fitted in one call, each as it would be alone on what it has."""
    from lociframe.operators import finemap as FM

    rng = np.random.default_rng(4)
    i = np.arange(40)
    ld = 0.6 ** np.abs(i[:, None] - i)
    z = rng.normal(0, 1, (6, 40)) @ np.linalg.cholesky(ld).T
    z[:, 5] += 8
    z[:, 25] -= 7
    use = rng.random((6, 40)) < 0.9
    n = np.full(6, 10_000.0)
    for s, (sets, lbf, done) in enumerate(FM.susie_all(z, ld, n, use=use)):
        kept = np.flatnonzero(use[s])
        want, want_lbf, want_done = FM.susie_all(z[s][kept][None], ld[np.ix_(kept, kept)], n[:1])[0]
        assert done == want_done and [(k, m.tolist()) for k, m in sets] == [(k, kept[m].tolist()) for k, m in want]
        assert np.allclose(lbf[:, kept], want_lbf, atol=1e-6)


def test_map_equation_reads_single_values(monkeypatch):
    """The loop over nodes makes no arrays: the logs of arrays are taken for whole partitions only."""
    from lociframe.operators import graph as G

    calls, whole = [], G._plogp
    monkeypatch.setattr(G, "_plogp", lambda x: calls.append(1) or whole(x))
    i = np.arange(60)
    got = G.communities_kernel(i, np.where(i % 6 == 5, i - 5, i + 1), np.ones(60), trials=1)
    assert {k: v for k, v in got.items()} == {int(k): int(k) // 6 * 6 for k in i}
    assert len(calls) < 60


def test_overlaps_are_counted_without_pairs(spark, sf_dir):
    genes = spark.read.parquet(f"{sf_dir}/part.parquet").count()
    assert most_rows(registry.QUERIES["j3_interval_overlap"](spark, sf_dir)) <= 4 * genes
    from lociframe.operators import joins as J

    rng = np.random.default_rng(5)
    rows = [("x" if k % 3 else "y", k, int(lo), int(lo + n)) for k, (lo, n) in enumerate(zip(rng.integers(-40, 60, 90), rng.integers(0, 25, 90), strict=True))]
    t = spark.createDataFrame(rows, "chr string, gene long, lo long, hi long")
    got = {r["gene"]: (r["n"], r["total"]) for r in J.overlap_totals(t, t, "chr", ("lo", "hi"), ("lo", "hi"), "gene", width=10).collect()}
    for c, k, lo, hi in rows:
        met = [j for d, j, s, e in rows if c == d and lo <= e and hi >= s]
        assert got[k] == (len(met), sum(met))


def test_many_to_many_is_counted_before_it_meets(spark, sf_dir):
    read = lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet").count()
    assert most_rows(registry.QUERIES["j7_many_to_many"](spark, sf_dir)) <= max(read("supplier"), read("customer"))


def test_signals_meet_by_bins(spark):
    """Only what is near by bins meets, and each pair once."""
    from lociframe.streaming import queue as Q

    up = spark.createDataFrame([(f"g{i}", "b", 1000 * i) for i in range(60)], "guid string, block string, bp long")
    wh = spark.createDataFrame([(i, "b", 1000 * i + 50, 0.001) for i in range(-5, 60)], "study long, block string, bp long, min_p double")
    out = Q.near_warehouse(up, wh, 1000, 0.01)
    assert "_bin" in out._jdf.queryExecution().optimizedPlan().toString()  # the distance alone would compare all of a block
    got = sorted((r["guid"], r["other"]) for r in out.collect())
    assert got == sorted((f"g{i}", j) for i in range(60) for j in range(-5, 60) if abs(1000 * i - 1000 * j - 50) <= 1000)


def test_worker_keeps_one_state_for_a_bucket_of_guids(spark, tmp_path, monkeypatch):
    """Many guids in few buckets: one state each, and every guid fares as by itself."""
    import json

    from lociframe.streaming import uploads as U

    monkeypatch.setattr(U, "BUCKETS", 3)
    path, n, seen = str(tmp_path), 120, []
    body = lambda i, more=0: json.dumps({"metadata": {"guid": f"g{i}", "sample_size": more}})

    def handle(m):
        seen.append({r["guid"]: (r["kind"], json.loads(r["value"])["metadata"]["sample_size"], r["again"]) for r in m.collect()})
        return m.select("guid", "again")

    deliveries = [
        [("process", body(i, k)) for i in range(n) for k in (1, 2)] + [("in_progress", body(i, 9)) for i in range(0, n, 4)],
        [("delete", body(i)) for i in range(0, n, 5)] + [("process", body(i)) for i in range(0, n, 15)],
        [("in_progress", body(i)) for i in range(n)] + [("process", body(i, 3)) for i in range(0, n, 10)],
    ]
    for rows in deliveries:
        spark.createDataFrame(rows, "kind string, value string").coalesce(1).write.mode("append").json(f"{path}/in")
        q = U.serve(spark, f"{path}/in", f"{path}/out", f"{path}/cp", handle, "again boolean")
        q.awaitTermination()
        assert max(p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress) <= 3
    assert seen[0] == {f"g{i}": ("process", 2, False) for i in range(n)}
    assert not seen[1]
    assert seen[2] == {f"g{i}": ("process", 3, i % 5 != 0) if i % 10 == 0 else ("in_progress", 0, True) for i in range(n) if i % 10 == 0 or i % 5}
    left = {r["guid"]: r["again"] for r in U.results(spark, f"{path}/out", "again boolean").collect()}
    assert left == {g: again for g, (_, _, again) in seen[2].items()}


def test_pairs_are_dealt_by_size_and_count_repeated_parts(spark, duck, sf_dir, tmp_path, monkeypatch):
    """More bytes, more partitions; parts given twice, with the same kind or another, count as SQL counts them."""
    import duckdb

    from lociframe import fixtures

    monkeypatch.setattr(fixtures, "BYTES_A_TASK", 4096)
    assert fixtures.Fixtures(spark, sf_dir).pairs.rdd.getNumPartitions() > 8
    lines = [(o, p, s) for o in range(6) for p, s in ((1, 1), (2, 2), (2, 3), (3, 2), (1, 1))] + [(None, 1, 5), (2, None, 5), (2, 1, None), (7, 9, 1), (7, 9, 2)]
    parts = [(1, "x", "u"), (1, "x", "u"), (2, "x", "u"), (2, "y", "u"), (2, None, "u"), (3, "x", None)]
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_suppkey long").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame(parts, "p_partkey long, p_brand string, p_type string").write.parquet(f"{tmp_path}/part.parquet")
    con = duckdb.connect()
    for t in ("lineitem", "part"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{tmp_path}/{t}.parquet/*.parquet'")
    want = con.execute(fixtures.with_sql("pairs") + "SELECT a, b, n, h4 FROM pairs ORDER BY a, b").fetchall()
    got = fixtures.Fixtures(spark, str(tmp_path)).pairs
    assert got.dtypes == [("a", "bigint"), ("b", "bigint"), ("n", "bigint"), ("h4", "double")]
    assert sorted(map(tuple, got.collect())) == want and len(want) == 3


def test_close_pairs_are_counted_without_pairs(spark, sf_dir):
    from lociframe.operators import joins as J

    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()
    assert most_rows(registry.QUERIES["j5_close_pairs"](spark, sf_dir)) <= 2 * lines
    rng = np.random.default_rng(6)
    rows = [(k, "x" if k % 3 else "y", int(p), int(s)) for k, (p, s) in enumerate(zip(rng.integers(-40, 60, 150), rng.integers(0, 8, 150), strict=True))]
    t = spark.createDataFrame(rows + [(200, None, 1, 1), (201, "x", None, 1)], "id long, chr string, bp long, study long")
    for distance, same in ((0, "study"), (7, None), (7, "study")):
        if distance:
            listed = J.close_pairs(t, "chr", "id", "bp", distance, same).collect()
            plain = [(r["chr"], r["distance"]) for r in listed]
        else:
            plain = [(a[1], abs(a[2] - b[2])) for a in rows for b in rows if a[0] < b[0] and a[1] == b[1] and (a[2] == b[2] or (same and a[3] == b[3]))]
        want = {c: (sum(d == c for d, _ in plain), sum(n for d, n in plain if d == c)) for c in ("x", "y")}
        assert {r["chr"]: (r["n"], r["total"]) for r in J.close_pair_totals(t, "chr", "bp", distance, same).collect()} == want, (distance, same)


def test_quantiles_gather_no_key_in_one_task(spark, sf_dir):
    from lociframe.operators import aggregates as A

    text = registry.QUERIES["a24_quantiles"](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert "percentile" not in text.lower()
    rng = np.random.default_rng(7)
    rows = [(k, float(v)) for k in ("a", "b", None) for v in rng.integers(0, 9, 101 if k == "a" else 54)] + [("c", 2.5), ("d", None), ("a", None)]
    got = {r["k"]: tuple(r)[1:] for r in A.quantiles(spark.createDataFrame(rows, "k string, v double"), "k", "v", {"lo": 0.0, "q": 0.37, "hi": 1.0}).collect()}
    assert got.pop("d") == (None, None, None) and set(got) == {"a", "b", "c", None}
    for k, v in got.items():
        assert np.allclose(v, np.quantile([x for n, x in rows if n == k and x is not None], [0, 0.37, 1]))


def test_elastic_nets_are_fitted_together(monkeypatch):
    """Responses on one matrix take one decomposition a fold, and each is fitted as it would be alone."""
    rng = np.random.default_rng(9)
    x = rng.normal(size=(40, 25)) @ np.linalg.cholesky(0.8 ** np.abs(np.subtract.outer(range(25), range(25)))).T
    y = x[:, rng.integers(0, 25, 30)].T * rng.normal(0, 2, (30, 1)) + rng.normal(size=(30, 40))
    want = [K.elastic_net_cv(x, one) for one in y]
    calls, whole = [], np.linalg.eigh
    monkeypatch.setattr(np.linalg, "eigh", lambda m: calls.append(1) or whole(m))
    assert np.allclose(K.elastic_nets_cv(x, y), want, atol=1e-8)
    assert len(calls) == 6


def test_quality_control_factors_its_first_halves_once(monkeypatch):
    """Studies of one matrix share the first round's factors, and each is judged as it would be alone."""
    rng = np.random.default_rng(11)
    ld = 0.7 ** np.abs(np.subtract.outer(range(60), range(60)))
    z = rng.normal(0, 1, (8, 60)) @ np.linalg.cholesky(ld).T
    z[::2, 20] += 12
    want = [K.dentist(one, ld) for one in z]
    calls, whole, known = [], np.linalg.eigh, {}
    monkeypatch.setattr(np.linalg, "eigh", lambda m: calls.append(1) or whole(m))
    assert all((K.dentist(one, ld, known=known) == w).all() for one, w in zip(z[1::2], want[1::2], strict=True)) and len(calls) == 2
    assert all((K.dentist(one, ld, known=known) == w).all() for one, w in zip(z[::2], want[::2], strict=True))
    assert any(w.any() for w in want) and not all(w.any() for w in want)


def test_results_of_studies_are_joined_by_column():
    """One frame for a group, without one for each study; what a study says once holds for all of its rows."""
    from lociframe.sources import ld_store

    tables = [{"snp": np.array([1, 2]), "lead": None, "why": "a", "blk": 3}, {"snp": [], "lead": None, "why": "b", "blk": 3}, {"snp": pd.Series([5], index=[9]), "lead": 7, "why": "c", "blk": 3}]
    got = ld_store._joined(tables, ["snp", "lead", "why"], ["blk", "snp", "lead", "why"])
    assert [tuple(r) for r in got.itertuples(index=False)] == [(3, 1, None, "a"), (3, 2, None, "a"), (3, 5, 7, "c")]
    assert list(ld_store._joined([], ["snp"], ["blk", "snp"]).columns) == ["blk", "snp"]


def test_uploads_and_near_signals_are_not_shuffled_as_pairs(spark):
    """No exchange or window above the join of leads and signals; of an identity's signals the least near one is taken, once."""
    from lociframe.streaming import uploads as U

    n = 40
    up = [(f"u{i}", "b", f"u{i}_s", 100 * i, 1e-9, 1e-5, [f"u{i + 1}"]) for i in range(n)] + [("v", "b", f"u{i}_s", 90_000, 1e-9, 1e-5, []) for i in range(3)]
    wh = [("b", f"w{i % 30}", 37 * i, 1e-9) for i in range(120)] + [("b", "u3_s", 90_010, 1e-9), ("b", "u2_s", 90_020, 1e-9), ("b", "u5_s", 400, 1e-9), ("b", None, 5, 1e-9), ("b", None, 7, 1e-9), ("b", "w0", None, 1e-9)]
    uploads = spark.createDataFrame(up, "guid string, block string, ident string, bp long, min_p double, p_value_threshold double, compare array<string>")
    warehouse = spark.createDataFrame(wh, "block string, ident string, bp long, min_p double")
    others = uploads.drop("compare")
    for distance in (0, 250):
        want = {}
        for g, _, ident, bp, _, _, named in up:
            first = min(r[3] for r in up if r[0] == g)
            for key, rank, origin, at in [((g, ident), 0, "upload", bp), *[((g, w[1]), 1, "warehouse", w[2]) for w in wh if w[2] is not None and abs(first - w[2]) <= distance], *[((g, o[2]), 2, "other", o[3]) for o in up if o[0] in named]]:
                want[key] = min(want.get(key, (9, "", 0)), (rank, origin, at))
        out = U.compared(uploads, warehouse, others, distance, 1e-6)
        got = [((r["guid"], r["ident"]), r["origin"], r["bp"]) for r in out.collect()]
        assert sorted(map(str, got)) == sorted(str((k, v[1], v[2])) for k, v in want.items())
    plan = U.near(U.leads(uploads), U.beside(uploads, warehouse, others), warehouse)._jdf.queryExecution().executedPlan().toString()
    above = plan[: plan.index("Join")]
    assert not any(w in above for w in ("Exchange", "Aggregate", "Window", "Sort "))


def test_pairs_stand_together_and_leads_go_to_the_bins(spark):
    """Signals, of which there are more, are laid out once; a lead's pairs follow each other, or with by_signal a signal's."""
    from lociframe.streaming import queue as Q

    lead = spark.createDataFrame([(f"g{i}", "b", 10 * i) for i in range(5)], "guid string, block string, first_bp long")
    signals = spark.createDataFrame([(i, "b", i) for i in range(300)], "other long, block string, bp long")
    for key, by_signal in (("guid", False), ("other", True)):
        out = Q.within_distance(lead.hint("merge"), signals.hint("merge"), "first_bp", "bp", 20, by_signal)
        assert most_rows(out) <= 300
        got = [(r["guid"], r["other"]) for r in out.coalesce(1).collect()]
        assert sorted(got) == sorted((f"g{i}", j) for i in range(5) for j in range(300) if abs(10 * i - j) <= 20)
        near = [r[0 if key == "guid" else 1] for r in got]
        runs = 1 + sum(a != b for a, b in zip(near, near[1:], strict=False))
        assert runs <= 3 * len(set(near))
