"""Each operator against brute force, exact round trips or held-out labels, and on edge cases."""

import hashlib
import math
import random
import re
import time
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from lociframe.llm import common, op1_quality, op2_shards, op3_join, op4_extract, op5_rules, op6_licenses, op7_vectors, op8_mix, op9_bpe, op10_lm, oracles, registry
from lociframe.llm.op4_pages import FRAMES, MARK, labelled

from ..compare import rows

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, n int, label string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty, blank and long texts, ties, repeated rows, and columns whose names clash with results."""
    long = " ".join(f"word{i % 977} the of and" for i in range(8000))
    rng = random.Random(1)
    base = ["".join(rng.choices("abcdefgh", k=5)) for _ in range(120)]
    near = base[:60] + ["changed"] + base[61:]
    texts = [None, "", " \t\n", "one", "one two", long, " ".join(base), " ".join(near), " ".join(base), "Ünï cödé ẞtraße MIT License", "a a a a a a a a a a a a a a a a a a a a a a", "licensed under the Apache License version 2 0 and the GNU General Public License."]
    out = [(i, t, "en" if i % 2 else None, None if i % 5 == 0 else f"s{i % 3}", None, 0.5, 1, "x") for i, t in enumerate(texts)]
    out += [out[6], out[6], (None, "no id here", "fr", "s1", 0, None, None, None), (None, None, None, None, None, None, None, None)]
    return spark.createDataFrame(out, SCHEMA)


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def empty(df):
    return df.limit(0)


@pytest.mark.parametrize("name", sorted(oracles.SQL))
def test_sql(spark, duck, sf_dir, name):
    got, want = registry.queries()[name](spark, sf_dir).toPandas(), duck.execute(oracles.SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


# ---- 1 ----


def test_classifier_on_held_out_labels(spark, sf_dir, docs):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    got = op1_quality.classify(docs, labels).join(labels, "doc_id").toPandas()
    held = got[got.held_out]
    assert (held.predicted == held.quality).mean() > 0.85
    assert got.score.between(0, 1).all()
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 3 == 1 for i in got.doc_id]).all()


def test_classifier_without_labels_and_on_odd_rows(spark, sf_dir, odd):
    none = spark.createDataFrame([(1, None, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    assert {r["score"] for r in op1_quality.classify(odd, none).collect()} == {0.5}
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(12)], "doc_id long, quality int, toxic int")
    assert op1_quality.classify(odd, labels).count() == odd.count()
    assert op1_quality.accepted(odd, labels).columns == odd.columns
    assert op1_quality.classify(empty(odd), labels).count() == 0


def test_word_table_and_pooling_against_plain_loops(spark, docs, odd):
    texts = [r["text"] for r in odd.union(docs.select(*[F.col(c) if c in docs.columns else F.lit(None).alias(c) for c in odd.columns])).select("text").collect()]
    df = spark.createDataFrame([(t,) for t in texts], "text string").repartition(5)
    hashes = common.WordHashes()
    vector = {}
    for t in texts:
        for x in set(op1_quality.tokens(t)):
            v = np.zeros(op1_quality.WIDTH)
            for k in range(op1_quality.NONZERO):
                part = (hashes[x] >> 16 * k) & 0xFFFF
                v[(part & 0x7FFF) % op1_quality.WIDTH] += 1 if part & 0x8000 else -1
            vector[x] = v
    place = {x: int(op1_quality.table_places(np.array([hashes[x]], np.uint64), 256)[0]) for x in vector}
    counts, sums = np.zeros(256, int), np.zeros((256, op1_quality.WIDTH))
    for t in texts:
        own = op1_quality.tokens(t)
        for i, x in enumerate(own):
            counts[place[x]] += 1
            for j in range(max(0, i - op1_quality.REACH), min(len(own), i + op1_quality.REACH + 1)):
                if i != j:
                    sums[place[x]] += vector[own[j]]
    got = op1_quality.word_table(df, 8)
    assert (got[0] == counts).all() and (got[1] == sums).all()
    words, some = op1_quality.WordVectors(*got), texts[:40]
    pooled = words.pooled([hashes.of(op1_quality.tokens(t)) for t in some])
    for t, row in zip(some, pooled, strict=True):
        own, want = op1_quality.tokens(t), np.zeros(2 * op1_quality.WIDTH + 2)
        for x in own:
            share, v = counts[place[x]] / counts.sum(), sums[place[x]]
            want[: op1_quality.WIDTH] += 1e-3 / (1e-3 + share) * v / max(np.sqrt(v @ v), 1e-9)
            want[op1_quality.WIDTH : -2] += vector[x] / np.sqrt(op1_quality.NONZERO)
            want[-2] -= np.log(share + 1e-7) / 10
        want[-1] = len(set(own))
        assert np.allclose(row, want / max(len(own), 1), atol=2e-4)


def test_network_learns_and_is_calibrated():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(2000, 6))
    y = (rng.random(2000) < 1 / (1 + np.exp(-3 * x[:, 0]))).astype(float)
    p = op1_quality.Network(x[:1500], y[:1500]).probability(x[1500:])
    assert ((p >= 0.5) == y[1500:]).mean() > 0.8 and abs(p.mean() - y[1500:].mean()) < 0.06


# ---- 2 ----


def tree_shard(key: str, top) -> int:
    def draw(node, w):
        u = (int(hashlib.md5(f"{key}@{node}".encode()).hexdigest()[:13], 16) + 0.5) / 2**52
        return -math.log(u) / w

    while True:
        child = min(top, key=lambda c: draw(c[0], c[1])) if len(top) > 1 else top[0]
        if len(child) == 2:
            return child[0]
        top = child[2]


@pytest.mark.parametrize("table", ["docs", "odd"])
def test_shards(request, table):
    df = request.getfixturevalue(table)
    got = op2_shards.slots(df).collect()
    assert len(got) == df.count()
    texts = {r["doc_id"]: (r["text"] or "").encode() for r in df.collect() if r["doc_id"] is not None}
    slots = {}
    for r in got:
        key = "null" if r["doc_id"] is None else str(r["doc_id"])
        assert r["shard"] == tree_shard(key, op2_shards.tree(24)) and r["grown_shard"] == tree_shard(key, op2_shards.tree(25))
        assert r["grown_shard"] in (r["shard"], 24) and r["law"] == "key"
        if r["doc_id"] is not None:
            assert r["size"] == len(texts[r["doc_id"]]) + 8 and r["text_crc32"] == zlib.crc32(texts[r["doc_id"]])
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_shards_of_a_repeated_row_and_of_nothing(spark, odd, monkeypatch):
    monkeypatch.setattr(op2_shards, "RUN", 7)
    many = spark.range(100).select(F.lit(5).cast("long").alias("doc_id"), F.lit("t").alias("text"))
    assert sorted(r["slot"] for r in op2_shards.slots(many).collect()) == list(range(100))
    assert op2_shards.slots(empty(odd)).count() == 0


def test_a_heavier_shard_draws_rows_along_its_path_only(spark):
    ids = spark.range(6000).select(F.col("id").alias("doc_id"))
    both = op2_shards.assign(op2_shards.assign(ids, name="old"), name="new", weights={5: 3.0})
    where = {s: (region[0], rack[0]) for region in op2_shards.tree() for rack in region[2] for s, _ in rack[2]}
    moved = 0
    for r in both.collect():
        old, new = r["old"], r["new"]
        moved += old != new
        if old != new:
            assert where[new][0] == where[5][0]
            assert where[old][0] != where[5][0] or where[new][1] == where[5][1]
            assert where[old] != where[5] or new == 5
    share = both.where("new = 5").count() / 6000
    assert moved and abs(share - 3 / 26) < 0.02
    with pytest.raises(ValueError):
        op2_shards.tree(weights={3: 0.0})


# ---- 3 ----


def brute_components(pairs: list, size: int, percent: int) -> dict:
    sets = {}
    for i, t in pairs:
        w = [x.encode().lower() for x in WORD.findall(t or "")]
        k = min(size, len(w))
        sets[i] = frozenset(tuple(w[j : j + k]) for j in range(len(w) - k + 1)) if w else frozenset()
    least = {i: i for i in sets}
    changed = True
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    while changed:
        changed = False
        for a, b in links:
            m = min(least[a], least[b])
            changed |= least[a] != m or least[b] != m
            least[a] = least[b] = m
    return {i: (len(sets[i]), least[i]) for i in sets}


@pytest.mark.parametrize(("size", "percent"), [(3, 90), (5, 80)])
def test_join_against_brute_force(docs, odd, size, percent):
    for df in (docs, odd.where("doc_id IS NOT NULL")):
        want = brute_components([(r["doc_id"], r["text"]) for r in df.collect()], size, percent)
        got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in op3_join.components(df, size, percent).collect()}
        assert got == want


def test_join_of_many_near_copies(spark):
    rng = random.Random(3)
    base = [f"w{rng.randrange(10**6)}" for _ in range(150)]
    made = []
    for i in range(120):
        w = list(base)
        for _ in range(rng.choice([0, 1, 1, 2, 3, 6])):
            w[rng.randrange(150)] = f"x{rng.randrange(10**6)}"
        made.append((i, " ".join(w)))
    df = spark.createDataFrame(made, "doc_id long, text string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in op3_join.components(df).collect()}
    assert got == brute_components(made, 3, 90)


def test_join_keeps_one_of_each_group(spark, odd):
    kept = op3_join.one_each(odd)
    assert kept.columns == odd.columns
    ids = sorted(r["doc_id"] for r in kept.collect() if r["doc_id"] is not None)
    assert ids == [0, 1, 2, 3, 4, 5, 6, 9, 10, 11]  # 7 and 8 are copies of 6
    assert op3_join.components(odd).count() == odd.count()
    assert op3_join.components(empty(odd)).count() == 0 and op3_join.one_each(empty(odd)).count() == 0


def test_join_of_any_ids_and_of_one_id_on_different_texts(spark):
    rng = random.Random(11)
    text = lambda: " ".join(f"w{rng.randrange(10**6)}" for _ in range(40))
    x, y, z = text(), text(), text()
    top = 2**63 - 1
    made = [(2**62 + 5, x), (2**62 + 6, x), (top, y + " end"), (-top, y), (7, z), (7, x + " and"), (None, z), (None, "alone " + z[::-1]), (8, y + " end")]
    df = spark.createDataFrame(made, "doc_id long, text string")
    got = sorted((str(r["doc_id"]), str(r["component_id"])) for r in op3_join.components(df, 3, 80).collect())
    want = [(2**62 + 5, 7), (2**62 + 6, 7), (top, -top), (-top, -top), (7, 7), (7, 7), (None, 7), (None, None), (8, -top)]
    assert got == sorted((str(a), str(b)) for a, b in want)
    assert sorted(str(r["doc_id"]) for r in op3_join.one_each(df, 3, 80).collect()) == sorted(map(str, [-top, 7, 7, None]))


def test_join_by_key_when_too_many_to_broadcast(docs, odd, monkeypatch):
    monkeypatch.setattr(op3_join, "MOST_BROADCAST", 0)
    monkeypatch.setattr(op3_join, "PAIRS_A_SALT", 2)
    df = odd.where("doc_id IS NOT NULL").select("doc_id", "text").union(docs.where("doc_id > 100").select("doc_id", "text"))
    want = brute_components([(r["doc_id"], r["text"]) for r in df.collect()], 3, 90)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in op3_join.components(df).collect()} == want


def test_parity_bits_bound_the_difference():
    rng = np.random.default_rng(5)
    for n, cut in ((50, 5), (3000, 900)):
        x = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))
        y = np.unique(np.concatenate([x[cut:], rng.integers(0, 2**63, cut, dtype=np.uint64)]))
        apart = sum(bin(int(a) ^ int(b)).count("1") for a, b in zip(op3_join.parity_bits(x).view(np.uint64), op3_join.parity_bits(y).view(np.uint64), strict=True))
        assert 0 < apart <= len(np.setxor1d(x, y))


# ---- 4 ----


def found_words(pages: list, weights, pairs) -> tuple:
    """(precision, recall) over the distinct words of each page."""
    got = want = both = 0
    for page in pages:
        parsed = op4_extract.Page(page)
        truth = [" ".join(t.replace(MARK, "").split()) for _, t in parsed.runs if MARK in t]
        found = op4_extract.main_texts([page.replace(MARK, "")], weights, pairs)[0].split()
        truth = " ".join(truth).split()
        common_words = len(set(found) & set(truth))
        got, want, both = got + len(set(found)), want + len(set(truth)), both + common_words
    return both / got, both / want


def test_extraction_of_unseen_labelled_pages():
    assert min(found_words(labelled(150, seed=77), *op4_extract.model())) > 0.9


@pytest.mark.parametrize("family", [("<div id='content'>", "<div class='container'>", "<div id='main'>"), ("<section", "<table"), ("<main><h1>", "<h1>")])
def test_extraction_of_layouts_never_trained_on(family):
    """Frames of a family are left out of training and make up the test."""
    out = [f for f in FRAMES if f.startswith(family)]
    model = op4_extract.train(labelled(200, frames=[f for f in FRAMES if f not in out]))
    precision, recall = found_words(labelled(80, seed=78, frames=out), *model)
    print(family, round(precision, 3), round(recall, 3))
    assert precision > 0.85 and recall > 0.8


def test_extraction_of_deep_and_broken_nesting_in_linear_time():
    weights, pairs = op4_extract.model()
    began = time.time()
    for page in ("<ul>" * 20_000, "<p><div>" + "<ul>" * 20_000, "<div>" * 20_000 + "</b></i></x>" * 20_000, "<div>" * 10_000 + "<li>" * 10_000 + "<td>" * 5000, "<p><section>" * 10_000):
        op4_extract.main_texts([page + "some words of a text that ends here"], weights, pairs)
    assert time.time() - began < 60


def test_extraction_of_the_pages_table(spark, sf_dir):
    import html

    for r in op4_extract.extract(spark.read.parquet(f"{sf_dir}/pages.parquet"), ["page_id", "html"]).collect():
        m = re.search(r"<article>(.*?)(</article>|$)", r["html"], re.S)
        parts = re.sub(r"<[^>]*(>|$)", "", re.sub(r"<br>", " ", re.sub(r"</?(p|h1)>", "\x01", m[1]))).split("\x01") if m else []
        assert r["text"] == " ".join(b for b in (" ".join(html.unescape(p).split()) for p in parts) if b)
        assert r["n_chars"] == len(r["text"])


def test_extraction_of_odd_pages(spark):
    deep = "<div>" * 400 + "<article><p>" + "deep words here. " * 30
    pages = [(1, None), (2, ""), (3, "<article><p>A &amp; B&nbsp;<b>c</b>d <br>e</p><script>x</script></article>"), (4, deep), (5, "<article><p>text of a page that ends in a tag <a href='x"), (6, "<!-- open"), (7, "<nav><a href=x>menu</a></nav>")]
    df = spark.createDataFrame([(i, "u", h, "x", 1) for i, h in pages], "page_id long, url string, html string, text string, n_chars int")
    got = {r["page_id"]: r["text"] for r in op4_extract.extract(df, ["page_id", "url"]).collect()}
    assert got[1] == got[2] == got[6] == got[7] == "" and got[3] == "A & B cd e"
    assert got[4].count("deep") == 30 and got[5] == "text of a page that ends in a tag"
    assert op4_extract.extract(empty(df), ["page_id"]).count() == 0


def test_sum_product_equals_enumeration():
    page = op4_extract.Page("<div><p>aa</p><ul><li>b</li><li>c</li></ul></div>")
    forest = op4_extract.Forest([page])
    rng = np.random.default_rng(0)
    w, pairs = rng.normal(size=op4_extract.FEATURES), rng.normal(size=(len(op4_extract.PLAIN) + 1, 2, 2))
    n, total, on = len(page.parent), 0.0, np.zeros(len(page.parent))
    for bits in range(2**n):
        s = [(bits >> i) & 1 for i in range(n)]
        e = math.exp(sum(s[i] * float(forest.x[i] @ w) for i in range(n)) + sum(pairs[forest.link[i], s[forest.parent[i]], s[i]] for i in range(1, n)))
        total, on = total + e, on + e * np.array(s)
    assert np.allclose(forest.marginals(w, pairs)[0], on / total)


# ---- 5 and 6 ----


def test_rules_on_odd_rows(odd):
    got = {r["doc_id"]: r for r in op5_rules.judged(odd, ["doc_id"]).collect()}
    assert got[0]["n_words"] == 0 and got[0]["base_failed"] and not got[0]["kept"]
    assert got[10]["n_words"] == 22 and got[10]["n_repeat_words"] == 22 and got[10]["base_failed"]
    assert got[5]["n_words"] == 32000
    assert op5_rules.filtered(odd).columns == odd.columns and op5_rules.judged(empty(odd), ["doc_id"]).count() == 0


def test_rules_reject_what_is_far_from_prose(spark):
    prose = "The house of the old man stood by the river and it was known to all that in winter the wind came over the hills. " * 1
    texts = [prose + "A second line of plain words follows for the length of it, as is the custom on such days in that land.", "QQ## $$%% ||&& ** ## $$ %% " * 12 + " ".join(f"#{i}%" for i in range(40))]
    df = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    assert {r["doc_id"]: r["kept"] for r in op5_rules.judged(df, ["doc_id"]).collect()} == {0: True, 1: False}


def test_rules_reject_long_texts_without_common_words(spark):
    rng = random.Random(8)
    prose = "The house of the old man stood by the river and it was known to all that in winter the wind came over the hills with snow, as is the custom on such days for a land at peace. "
    plain = ["".join(rng.choices("aeioulnrst", k=rng.randint(3, 7))) for _ in range(400)]
    salad = "".join(w.capitalize() + ", " if i % 9 == 0 else w + " " for i, w in enumerate(w for w in plain if w not in op5_rules.COMMON_WORDS["en"]))
    shorter = " ".join(salad.split()[: op5_rules.LEAST_COMMON_OF - 1])
    varied = "".join(f"{prose} {' '.join(plain[9 * i : 9 * i + 9])}. " for i in range(5))
    texts = [(0, varied, "en"), (1, salad, "en"), (2, salad, None), (3, shorter, "en")]
    got = {r["doc_id"]: r for r in op5_rules.judged(spark.createDataFrame(texts, "doc_id long, text string, lang string"), ["doc_id"]).collect()}
    assert not any(r["base_failed"] or r["char_distance"] > op5_rules.MOST_CHAR_DISTANCE for i, r in got.items() if i)
    assert not got[1]["kept"] and round(got[1]["word_distance"], 3) == 0.411
    assert got[2]["kept"] and got[3]["kept"] and got[2]["word_distance"] is None and got[3]["word_distance"] is None
    assert got[0]["word_distance"] < 0.3


def brute_licenses(text: str) -> tuple:
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    base = [(i, label) for p, label in op6_licenses.PHRASES.items() for i in range(len(w)) if w[i : i + len(p.split())] == p.split()]
    norm = "".join(f" {x}" for x in w) + " "
    # every rule on every text: no gate, no keywords
    spans = sorted((m.start(), -m.end(), -r["priority"], r["label"], r["confidence"]) for r in op6_licenses.rules() for m in re.finditer(r["pattern"], norm))
    free = []
    for x in spans:
        if not free or -x[1] > -free[-1][1]:
            free.append(x)
    beside = lambda i, j: 0 <= j < len(free) and max(free[i][0], free[j][0]) < min(-free[i][1], -free[j][1]) and free[j][2] < free[i][2]
    kept = [x for i, x in enumerate(free) if not beside(i, i - 1) and not beside(i, i + 1)]
    labels = {x for _, x in base} | {s[3] for s in kept}
    score = max([0.0, *(s[4] for s in kept), *([0.7] if base else [])])
    at = [i for i, _ in base]
    return len(w), len(base), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in base})), ",".join(sorted(labels)), score


def test_licenses_against_brute_force(spark, docs, odd):
    lines = ["SPDX-License-Identifier: MPL-2.0", "Copyright (c) 2020 X. All rights reserved.", "mit license MIT License, mit", "Redistribution and use in source and binary forms, with or without", "under the terms of the GNU Lesser General Public License version 3 or the Apache License 2", "Licensed under the Do What The Fuck You Want To Public License"]
    extra = spark.createDataFrame([(1000 + i, t) for i, t in enumerate(lines)], "doc_id long, text string")
    df = docs.select("doc_id", "text").union(odd.select("doc_id", "text")).union(extra)
    n = 0
    for r in op6_licenses.scan(df, ["doc_id", "text"]).collect():
        assert tuple(r[c] for c in ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")) == brute_licenses(r["text"]), r["text"]
        n += r["labels"] != ""
    assert n > 6 and len(op6_licenses.rules()) > 200
    assert op6_licenses.scan(empty(odd), ["doc_id"]).count() == 0


def test_identifiers_licensed_forms_and_dual_grants(spark):
    want = {
        "MIT Licensed": "mit", "Apache-2.0": "apache", "BSD-3-Clause": "bsd", "GPL-3.0-or-later": "gpl", "LGPL v2.1 or later": "lgpl", "This code is GPLv3": "gpl",
        "dual licensed under MIT and Apache 2.0": "apache,mit", 'license = "MIT OR Apache-2.0"': "apache,mit", "MPL-2.0": "mpl", "see (CC-BY-SA-4.0)": "cc-by-sa", "CC0-1.0": "cc0", "AGPLv3": "agpl", "EPL-2.0 or BSD 2-clause": "bsd,epl",
        "a simple example of a temple mit dem Apache-Hubschrauber": "", "bsl and cc to all": "", "under the gplv2+ only, GPL 2.0 licensed": "gpl",
    }
    got = {r["text"]: r for r in op6_licenses.scan(spark.createDataFrame([(t,) for t in want], "text string"), ["text"]).collect()}
    assert {t: r["labels"] for t, r in got.items()} == want
    for t, r in got.items():
        assert tuple(r[c] for c in ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")) == brute_licenses(t) and (r["score"] > 0) == bool(want[t])


def test_licenses_without_the_word_license_and_across_lines(spark):
    texts = ["This library is released under the MIT terms", "available under the Apache 2.0 terms", "distributed under BSD", "Altered source versions must be plainly marked as such, and", "All rights\nreserved", "went into the public\ndomain then", "released under the GNU General Public v2", "Distributed under the Mozilla Public 2.0", "no statement at all"]
    want = [brute_licenses(t) for t in texts]
    assert [w[5] for w in want] == ["mit", "apache", "bsd", "zlib", "proprietary", "public-domain", "gpl", "mpl", ""]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in op6_licenses.scan(df, ["doc_id"]).collect():
        assert tuple(r[c] for c in ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")) == want[r["doc_id"]], texts[r["doc_id"]]


def test_every_license_rule_is_found_by_its_gates_and_resolved(spark):
    """Each signature, spelled out, in its own text and all of them in one: the brute force has no gates."""
    rng = random.Random(6)

    def spelled(expression: str) -> str:
        out = expression
        while "(" in out:  # one alternative of each group, or none of an optional one
            out = re.sub(r"\(\?:([^()]*)\)([?*+]?)", lambda m: "" if m[2] == "?" and rng.random() < 0.5 else rng.choice(m[1].split("|")), out)
        out = re.sub(r"\[([^]]*)\][+*]?", lambda m: m[1][0], out)
        return re.sub(r"(.)\?", lambda m: m[1] if rng.random() < 0.5 else "", out)

    rules = op6_licenses.rules()
    texts = [spelled(r["pattern"].removesuffix("(?= )")) for r in rules]
    for r, t in zip(rules, texts, strict=True):
        assert re.search(r["pattern"], t + " ") and r["keyword"] in t + " ", r
    rng.shuffle(texts)
    texts += [" and ".join(texts), "".join(texts), " under the mit license copyright 2020 mit license version 2"]
    df = spark.createDataFrame([(i, t.title() if i % 2 else t) for i, t in enumerate(texts)], "doc_id long, text string")
    for r in op6_licenses.scan(df, ["doc_id", "text"]).collect():
        assert tuple(r[c] for c in ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")) == brute_licenses(r["text"]), r["text"]


def test_licenses_of_a_long_text_of_repeats(spark):
    df = spark.createDataFrame([(1, "mit license " * 32_000)], "doc_id long, text string")
    began = time.time()
    r = op6_licenses.scan(df, ["doc_id"]).first()
    assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["labels"], len(r["spans"])) == (64_000, 32_000, 0, 63_998, "mit", 63_999)
    assert time.time() - began < 30


# ---- 7 ----


def test_vectors_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(op7_vectors, "BLOCK", 40)
    monkeypatch.setattr(op7_vectors, "LIST_ROWS", 30)
    rng = np.random.default_rng(2)
    made = []
    for c in rng.normal(size=(25, 16)):
        for _ in range(rng.integers(1, 14)):
            made.append((c + rng.normal(size=16) * rng.choice([0.0, 0.1, 0.25, 0.35])).astype(np.float32).tolist())
    data = [(i, v, int(i % 2)) for i, v in enumerate(made)]
    n = len(data)
    data += [(n, None, 0), (n + 1, [0.0] * 16, 0), (n + 2, [None] * 16, 0), (n + 3, [float("nan")] * 16, 1), (n + 4, made[0], None), (n + 5, made[0][:8], 0), (n + 6, made[0], 0)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<float>, label int").withColumn("links", F.lit(1)).withColumn("node", F.lit("x"))
    x = {i: np.array(v, float) for i, v, lab in data if lab is not None and v and None not in v and np.isfinite(v).all() and any(v)}
    lab = {i: b for i, _, b in data}
    near = lambda a, b: lab[a] == lab[b] and len(x[a]) == len(x[b]) and x[a] @ x[b] / np.sqrt((x[a] @ x[a]) * (x[b] @ x[b])) >= 0.93
    links = {i: [j for j in x if j != i and near(i, j)] for i in x}
    got = {r["vec_id"]: r for r in op7_vectors.near_duplicates(df).collect()}
    assert len(got) == len(data) and sum(map(len, links.values())) > 50
    least = {i: i for i in lab}
    for _ in range(n):
        least = {i: min([least[i], *(least[j] for j in links.get(i, []))]) for i in least}
    for i, r in got.items():
        assert (r["n_links"], r["component_id"], r["kept"]) == (len(links.get(i, [])), least[i], least[i] == i), i
    assert op7_vectors.near_duplicates(empty(df)).count() == 0


def test_vectors_of_any_ids_and_repeated_ids(spark):
    a, b, c = [1.0, 0.0, 0.0], [0.0, 1.0, 0.0], [0.0, 0.99, 0.01]
    top = 2**63 - 1
    data = [(top, a), (2**62 + 9, a), (None, a), (3, b), (3, a), (-top, c), (None, [0.0, 0.0, 1.0])]
    df = spark.createDataFrame([(i, v, 1) for i, v in data], "vec_id long, embedding array<double>, label int")
    got = sorted((str(r["vec_id"]), r["n_links"], str(r["component_id"]), r["kept"]) for r in op7_vectors.near_duplicates(df).collect())
    want = [(top, 3, 3, False), (2**62 + 9, 3, 3, False), (None, 3, 3, False), (3, 3, 3, True), (3, 1, -top, False), (-top, 1, -top, True), (None, 0, None, True)]
    assert got == sorted((str(i), n, str(k), f) for i, n, k, f in want)


def test_vectors_of_several_lists_against_brute_force(spark):
    """The module's own sizes: 20,000 vectors in clusters, the default lists and blocks, whole result."""
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(6000, 24))
    x = (centres[rng.integers(0, 6000, 20_000)] + rng.normal(size=(20_000, 24)) * 0.22).astype(np.float32)
    lab = rng.integers(0, 3, len(x))
    df = spark.createDataFrame([(i, v.tolist(), int(k)) for i, (v, k) in enumerate(zip(x, lab, strict=True))], "vec_id long, embedding array<float>, label int").repartition(4)
    y = x.astype(float)
    y /= np.sqrt((y * y).sum(1))[:, None]
    n = np.zeros(len(x), int)
    for k in range(3):
        of = np.flatnonzero(lab == k)
        for at in range(0, len(of), 1000):
            n[of[at : at + 1000]] = (y[of[at : at + 1000]] @ y[of].T >= 0.93).sum(1) - 1
    got = {r["vec_id"]: r["n_links"] for r in op7_vectors.near_duplicates(df).collect()}
    assert n.sum() > 5000 and [got[i] for i in range(len(x))] == n.tolist()


# ---- 8 ----


def test_mix_reaches_its_targets(docs):
    got = op8_mix.mix(docs).join(docs.select("doc_id", "source", "text"), "doc_id").toPandas()
    assert (got["size"] == [len(WORD.findall(t or "")) for t in got.text]).all()
    per = got.groupby("source").agg(size=("size", "sum"), source_size=("source_size", "first"), target=("target", "first"), taken=("taken", "sum"), most=("size", "max"))
    assert (per["size"] == per.source_size).all()
    weight = {s: i % 3 + 1 for i, s in enumerate(sorted(per.index))}
    total, level, capped = per["size"].sum(), None, set()
    while True:  # plain resharing
        open_ = [s for s in per.index if s not in capped]
        level = (total - sum(3 * per["size"][s] for s in capped)) / sum(weight[s] for s in open_)
        more = {s for s in open_ if level * weight[s] > 3 * per["size"][s]}
        if not more:
            break
        capped |= more
    want = {s: 3 * per["size"][s] if s in capped else level * weight[s] for s in per.index}
    assert all(math.isclose(per.target[s], want[s], rel_tol=1e-9) for s in per.index)
    assert (abs(per.taken - per.target) <= per.most).all() and got.taken.sum() <= total
    assert (got.taken % got["size"].clip(lower=1) == 0).all() and (got.taken <= 3 * got["size"]).all()


def test_mix_of_odd_rows(odd):
    first, again = (sorted(map(str, op8_mix.mix(odd).collect())) for _ in range(2))
    assert first == again and len(first) == odd.count()
    assert op8_mix.mixed(odd).columns == odd.columns
    assert op8_mix.mix(empty(odd)).count() == 0 and op8_mix.mix(odd.where("text IS NULL")).agg(F.sum("taken")).first()[0] == 0


def test_mix_takes_what_finishes_within_the_budget(spark, docs, odd):
    """Plain queues in the operator's shuffled order: every document taken or not as a sort by finish time says."""
    for df in (docs.select("doc_id", "source", "text"), odd.select("doc_id", "source", "text").where("doc_id IS NOT NULL").distinct()):
        queued = op8_mix._queued(df).select("doc_id", "_mx_null", "_mx_source", "_mx_size", "_mx_place").collect()
        got = {r["doc_id"]: r for r in op8_mix.mix(df).collect()}
        done, sums = [], {}
        for r in sorted(queued, key=lambda r: (r["_mx_place"], r["doc_id"], r["_mx_size"])):
            key, g = (r["_mx_null"], r["_mx_source"]), got[r["doc_id"]]
            sums[key] = sums.get(key, 0) + r["_mx_size"]
            if g["target"] > 0:
                done += [((e * g["source_size"] + sums[key]) / g["target"], r["_mx_size"], r["doc_id"]) for e in range(3)]
        budget, total, taken = sum(r["_mx_size"] for r in queued), 0, Counter()
        for f in sorted({x[0] for x in done}):
            same = [x for x in done if x[0] == f]
            total += sum(x[1] for x in same)
            if total > budget:
                break
            taken.update({x[2]: x[1] for x in same})
        assert {i: r["taken"] for i, r in got.items() if r["taken"]} == {i: n for i, n in taken.items() if n}
        out = op8_mix.mixed(df).select(op8_mix.size_of(F.col("text")).alias("n"), "doc_id").collect()
        assert Counter({i: n for i, n in Counter([r["doc_id"] for r in out if r["n"]]).items()}) == Counter({i: r["taken"] // r["size"] for i, r in got.items() if r["taken"]})


# ---- 9 ----


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(op9_bpe.default_path())
    t.no_truncation()
    t.no_padding()
    return t


def test_tree_concatenation_is_exact(library):
    bpe = op9_bpe.ByteBpe(op9_bpe.default_path(), leaf_bytes=160)
    rng = random.Random(4)
    pieces = ["the ", "  ", "\n\n", "a", "aaaa", "日本語", "é", "'s", "'", "!!", "123", "<|endoftext|>", " word", "don't", "\t", "🙂", "ß", " ", "xyzzy", "=" * 9]
    for _ in range(250):
        text = "".join(rng.choices(pieces, k=rng.randint(1, 400))) if rng.random() < 0.7 else rng.choice(pieces) * rng.randint(1, 900)
        want = library.encode(text, add_special_tokens=False).ids
        got = bpe.encode(text)
        assert got.tolist() == want
        assert bpe.decode(got) == library.decode(want, skip_special_tokens=False)


def test_encoding_of_tables(docs, odd, library):
    for df in (docs, odd):
        for r in op9_bpe.encode_texts(df, ["doc_id", "text"]).collect():
            ids = library.encode(r["text"] or "", add_special_tokens=False).ids
            assert r["n_tokens"] == len(ids) and r["ids"] == ids
            assert r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
            assert r["decoded_sha256"] == hashlib.sha256((r["text"] or "").encode()).hexdigest()
    assert op9_bpe.decode_ids(op9_bpe.encode_texts(odd, ["doc_id", "n"]), ["doc_id"]).where("text = 'one two'").count() == 1
    assert op9_bpe.encode_texts(empty(odd), ["doc_id"]).count() == 0


# ---- 10 ----


def brute_losses(texts: list, target: list) -> list:
    """Losses by plain counts over the other documents' words."""
    w = [[x.encode().lower() for x in WORD.findall(t or "")] for t in texts]
    vocabulary = len({x for ws in w for x in ws})
    counted = lambda ws: (Counter(ws), Counter([None, *ws[:-1]][: len(ws)]), Counter(zip([None, *ws[:-1]], ws, strict=False)))
    each = [counted(ws) for ws in w]
    out = [[] for _ in texts]
    for inside in (target, [True] * len(texts)):
        total = [sum((c[k] for c, i in zip(each, inside, strict=True) if i), Counter()) for k in range(3)]
        size = sum(len(ws) for ws, i in zip(w, inside, strict=True) if i)
        for ws, own, i, losses in zip(w, each, inside, out, strict=True):
            left, n, loss = lambda k, x: total[k][x] - own[k][x] * i, size - len(ws) * i, 0.0  # noqa: B023, E731
            for before, x in zip([None, *ws], ws, strict=False):
                base = (1 - op10_lm.UNIFORM) * left(0, x) / max(n, 1) + (op10_lm.UNIFORM if n else 1.0) / vocabulary
                follow = left(2, (before, x)) / left(1, before) if left(1, before) else base
                loss -= math.log(op10_lm.BLEND * follow + (1 - op10_lm.BLEND) * base)
            losses.append(loss / len(ws) if ws else 0.0)
    return out


def test_language_models_against_brute_force(spark, docs, odd):
    for df in (docs.select("doc_id", "text"), odd.where("doc_id IS NOT NULL").select("doc_id", "text").distinct()):
        data = [(r["doc_id"], r["text"]) for r in df.collect()]
        df = spark.createDataFrame(data, "doc_id long, text string")
        good = df.where("doc_id % 3 = 0")
        want = dict(zip([i for i, _ in data], brute_losses([t for _, t in data], [i % 3 == 0 for i, _ in data]), strict=True))
        for r in op10_lm.score(df, good).collect():
            assert np.allclose([r["target_loss"], r["background_loss"]], want[r["doc_id"]], rtol=1e-9)
            assert math.isclose(r["score"], r["target_loss"] - r["background_loss"], abs_tol=1e-12)
    assert op10_lm.score(empty(odd), odd).count() == 0 and op10_lm.score(odd, empty(odd)).count() == odd.count()


def test_language_models_keep_every_word_and_pair_apart(spark):
    # 40,000 pairs of words of their own in two documents each: counts are as exact for the last as for the first
    data = [(i + 40_000 * k, f"left{i} right{i} " + (f"left{i} right{i}" if i % 2 else f"left{i} other{i}")) for k in range(2) for i in range(40_000)]
    df = spark.createDataFrame(data, "doc_id long, text string")
    good = df.where("doc_id % 4 < 2")
    vocabulary, n = 100_000, {0: 4 * 40_000, 1: 4 * 80_000}
    want = {}
    for odd_one in (0, 1):
        for inside in (0, 1):
            per = []
            for model in (0, 1):
                member = 1 if model or inside else 0  # the copy is in the same models
                total = n[model] - 4 * member
                base = lambda c: (1 - op10_lm.UNIFORM) * c / total + op10_lm.UNIFORM / vocabulary  # noqa: B023, E731
                starts = n[model] // 4 - member
                counts, follows = ((2, 2, 2, 2), (1 / starts, 1, 1, 1)) if odd_one else ((2, 1, 2, 1), (1 / starts, 0.5, 1, 0.5))
                if not member:
                    counts, follows = (0,) * 4, (0.0, None, None, None)
                losses = [-math.log(op10_lm.BLEND * (base(c) if f is None else f) + (1 - op10_lm.BLEND) * base(c)) for c, f in zip(counts, follows, strict=True)]
                per.append(sum(losses) / 4)
            want[odd_one, inside] = per
    for r in op10_lm.score(df, good).collect():
        i = r["doc_id"]
        assert np.allclose([r["target_loss"], r["background_loss"]], want[i % 2, int(i % 4 < 2)], rtol=1e-9), i
    sizes = {r["kind"]: r["n"] for r in op10_lm.table_sizes(df, good).collect()}
    assert sizes == {"words": 100_000, "contexts": 80_001, "pairs": 40_000 * 3 + 20_000}


# ---- shared ----


def test_components_of_a_long_chain(spark):
    e = spark.range(80).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b")).union(spark.createDataFrame([(500, 501), (700, 700)], "a long, b long"))
    got = {r["node"]: r["component"] for r in common.connected_components(e).collect()}
    assert got == {**dict.fromkeys(range(81), 0), 500: 500, 501: 500, 700: 700}
    assert common.connected_components(e.limit(0)).count() == 0


def test_components_of_few_pairs_take_few_tasks(spark):
    e = spark.createDataFrame([(i, i + 1) for i in range(0, 60, 2)] + [(0, 40), (40, 50)], "a long, b long")
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "50")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    sc = spark.sparkContext
    sc.setJobGroup("few_pairs", "")
    try:
        got = {r["node"]: r["component"] for r in common.connected_components(e).collect()}
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
        for k, v in before.items():
            spark.conf.set(k, v)
    assert len(got) == 60 and len(set(got.values())) == 28 and got[51] == 0
    track = sc.statusTracker()
    stages = {i for j in track.getJobIdsForGroup("few_pairs") for i in track.getJobInfo(j).stageIds}
    tasks = sum(s.numCompletedTasks for i in stages if (s := track.getStageInfo(i)))
    assert tasks < 1_200
