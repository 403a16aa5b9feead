"""Operators 11 to 13 against brute force, held-out labels and odd rows."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from lociframe.llm import op11_toxicity, op12_variants, op13_search

SCHEMA = "doc_id long, text string, word string, n long, score double, item_id string, part int, run string"
UPPER = {c: c + 32 for c in range(65, 91)}


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty, blank and very long texts, repeated rows, ties, and columns whose names clash with results."""
    rng = random.Random(3)
    stems = ["".join(rng.choices("abcdeé", k=rng.randint(6, 9))) for _ in range(25)]
    texts = [None, "", " \t\n", "¿?", "ABCDEFG abcdefg abcdefgh ÀÉÎÕÜÿ× ABCDEFG", "x" * 5000 + " " + "x" * 5001]
    for _ in range(160):
        words = []
        for s in rng.choices(stems, k=12):
            at, kind = rng.randrange(len(s)), rng.randrange(4)
            words.append(s if kind == 0 else s[:at] + s[at + 1 :] if kind == 1 else s[:at] + rng.choice("abé") + s[at + kind - 2 :])
        texts.append(" ".join(words))
    texts.append(" ".join(rng.choice(stems) for _ in range(60_000)))
    rows = [(i, t, "w", 1, 0.5, "i", 2, "r") for i, t in enumerate(texts)]
    rows += [rows[8], rows[8], (None, texts[9], None, None, None, None, None, None), (None, None, None, None, None, None, None, None), (-5, texts[9], "w", 1, 0.5, "i", 2, "r")]
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


def empty(df):
    return df.limit(0)


# ---- 11 ----


def test_places_against_plain_windows():
    def plain(text):
        out = set()
        text = "".join(c if ord(c) >= 128 or c.isalnum() else " " for c in f" {text} ".lower())
        for size in op11_toxicity.SIZES:
            for i in range(len(text) - size + 1):
                gram = text[i : i + size]
                if " " not in gram[1:-1]:
                    h = 0
                    for c in gram:
                        h = (h * 0x100000001B3 + ord(c) + 1) % 2**64
                    out.add((h * 0x9E3779B97F4A7C15 % 2**64) >> (64 - op11_toxicity.TABLE_BITS))
        return sorted(out)

    for text in ["", "a", "an", "You IDIOT!! été 12x", "  tabs\tand\nlines ", "ab" * 40_000 + " cd" * 40_000]:
        assert op11_toxicity.places(text).tolist() == plain(text)
    known = op11_toxicity.numbered(op11_toxicity.places("idiot"))
    assert len(op11_toxicity.places("an idiot here", known)) == len(op11_toxicity.places("idiot"))
    assert op11_toxicity.places(None).tolist() == []


def test_counts_and_ratios_against_plain_loops(spark):
    texts = [("you idiot", True), ("you there", False), ("idiot idiot", True), ("", False)]
    other, toxic = op11_toxicity.counts(spark.createDataFrame(texts, "text string, y boolean").repartition(3))
    for y, table in ((True, toxic), (False, other)):
        want = Counter(p for t, k in texts if k == y for p in op11_toxicity.places(t).tolist())
        assert {int(i): int(table[i]) for i in np.flatnonzero(table)} == dict(want)
    ratio, errors = op11_toxicity.ratios(np.array([3.0]), np.array([1.0]), 8, 18)
    assert ratio[0] == pytest.approx(math.log(4 / 10) - math.log(2 / 20)) and errors[0] == pytest.approx(ratio[0] / math.sqrt(1 / 4 + 1 / 2))


def test_regression_reaches_the_optimum():
    rng = np.random.default_rng(2)
    rows = [np.flatnonzero(rng.random(6) < 0.4).astype(np.int32) for _ in range(300)]
    y = np.array([float(rng.random() < 1 / (1 + np.exp(-(2.0 * (0 in r) - 1.5 * (1 in r))))) for r in rows])
    share, scale, ridge = np.ones(300), np.array([2.0, 1.5, 1.0, 0.5, 1.0, 1.0]), 3.0
    got = op11_toxicity.Linear(rows, y, share, scale, ridge)
    x = np.zeros((300, 6))
    for i, r in enumerate(rows):
        x[i, r] = scale[r]
    w = got.weights / scale
    p = 1 / (1 + np.exp(-(x @ w + got.bias)))
    assert np.abs(x.T @ (p - y) / 300 + ridge / 300 * w).max() < 1e-4 and abs((p - y).mean()) < 1e-4
    assert got.weights[0] > 0.5 > -0.5 > got.weights[1]


def test_classifier_on_held_out_labels(spark, sf_dir):
    big = sf_dir.replace("sf0.001", "sf0.1")  # smaller ones hold too few toxic texts to judge by
    docs, labels = (spark.read.parquet(f"{big}/{t}.parquet") for t in ("documents", "labels"))
    got = op11_toxicity.classify(docs, labels).join(labels, "doc_id").toPandas()
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 5 == 0 for i in got.doc_id]).all()
    held = got[got.held_out & got.toxic.notna()]
    assert (held.predicted == held.toxic).mean() > 0.97 and held[held.toxic == 0].predicted.mean() < 0.01
    assert got.score.between(0, 1).all() and got.score.notna().all()


def test_held_out_labels_are_not_read(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    turned = labels.withColumn("toxic", F.when(op11_toxicity.is_held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = (op11_toxicity.classify(docs, l).orderBy("doc_id", "score").collect() for l in (labels, turned))
    assert a == b


def test_insults_in_short_and_long_texts_and_odd_rows(spark, odd):
    rng = random.Random(5)
    plain = ["the", "quick", "brown", "fox", "jumps", "over", "lazy", "dogs", "and", "idols", "clowning"]
    text = lambda n: " ".join(rng.choices(plain, k=n))
    rows = [(i, f"{text(20)} {'idiot' if i % 3 == 0 else 'idol'} {text(20)}", int(i % 3 == 0)) for i in range(300)]
    t = spark.createDataFrame(rows, "doc_id long, text string, toxic int").repartition(4)
    model = op11_toxicity.fit(t.select("doc_id", "text"), t.select("doc_id", "toxic", F.lit(1).alias("quality")))
    probe = spark.createDataFrame([(1, f"{text(30_000)} IDIOT, {text(30_000)}"), (2, "idiots"), (3, text(60_000)), (4, None), (5, "")], "doc_id long, text string")
    got = {r["doc_id"]: r["score"] for r in op11_toxicity.scored(probe, model).collect()}
    assert got[1] > 0.5 and got[2] > 0.5 and max(got[3], got[4], got[5]) < 0.5 and got[4] == got[5]
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)] + [(None, 1), (7, None)], "doc_id long, toxic int")
    judged = op11_toxicity.classify(odd, labels)
    assert judged.count() == odd.count() and judged.columns == ["doc_id", "held_out", "score", "predicted"]
    assert op11_toxicity.classify(empty(odd), labels).count() == 0
    assert {r["score"] for r in op11_toxicity.classify(odd, labels.limit(0)).collect()} == {0.5}
    assert {r["predicted"] for r in op11_toxicity.classify(odd, labels.where("toxic = 0")).collect()} == {0}


# ---- 12 ----


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_variants(rows):
    n = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(UPPER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            n[run] += 1
    n = {w: c for w, c in n.items() if len(w) >= 7 and c >= 2}
    found = {w: [v for v in n if near(w, v)] for w in n}
    form = {}
    for w, near_words in found.items():
        best = min(near_words, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best and n[best] >= 10 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n[w], len(found[w]), n[form[w]] if form[w] else None))
    return sorted(out, key=str)


def test_variants_against_all_pairs(spark, odd):
    got = [tuple(r) for r in op12_variants.grouped(odd).collect()]
    want = plain_variants([(r["doc_id"], r["text"]) for r in odd.collect()])
    assert sorted(got, key=str) == want and len(want) > 100 and any(r[1] for r in want)
    assert op12_variants.grouped(empty(odd)).count() == 0


def test_every_single_edit_is_found_once(spark):
    rng = random.Random(9)
    words = set()
    for base in ("abcdefg", "aaaaaaaa", "abababababa", "éclairs", "mississippis", "x" * 40):
        words.add(base)
        for i in range(len(base) + 1):
            words |= {base[:i] + "z" + base[i:], base[:i] + base[i + 1 :], base[:i] + "q" + base[i + 1 :], base[:i] + (base[i : i + 1] or "a") + base[i:]}
    words = sorted(w for w in words if len(w) >= 7)
    rng.shuffle(words)
    t = spark.createDataFrame([(w, 2) for w in words], "word string, n long").repartition(3)
    got = [tuple(sorted((r["a"], r["b"]))) for r in op12_variants.near_pairs(t).collect()]
    assert len(got) == len(set(got)) and set(got) == {tuple(sorted((a, b))) for i, a in enumerate(words) for b in words[:i] if near(a, b)}


def test_roots_follow_long_ways(spark):
    way = spark.createDataFrame([(f"w{i}", f"w{i + 1}") for i in range(11)] + [("x", "w3")], "word string, form string")
    assert {r["word"]: r["root"] for r in op12_variants.roots(way).collect()} == {**{f"w{i}": "w11" for i in range(11)}, "x": "w11"}
    assert op12_variants.roots(way.limit(0)).count() == 0


# ---- 13 ----


def plain_search(docs, items, best=20):
    pattern = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
    terms = lambda t: pattern.findall((t or "").translate(UPPER))
    held = [(d, Counter(terms(t))) for d, t in docs]
    held = [(d, c) for d, c in held if c]
    big, total, df = len(held), sum(sum(c.values()) for _, c in held), Counter(t for _, c in held for t in c)
    out = []
    for item, text in set(items):
        scored = []
        for d, c in held:
            m = 75 + 25 * sum(c.values()) * big // total
            score = sum(math.floor(1000 * math.log((2 * big + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m)) for t in terms(text) if t in c)
            if score > 0:
                scored.append((-score, d is None, d or 0))
        out += [(item, k + 1, None if none else d, -score) for k, (score, none, d) in enumerate(sorted(scored)[:best])]
    return sorted(out, key=str)


def test_search_against_all_pairs(spark, odd):
    items = [(1, "abcdefg ABCDEFG ÀÉÎÕÜÿ× nowhere"), (2, None), (3, ""), (4, "...no such terms..."), (1, "abcdefg ABCDEFG ÀÉÎÕÜÿ× nowhere"), (None, " ".join(r["text"] for r in odd.where("doc_id BETWEEN 10 AND 14").collect())), (6, "x" * 5000)]
    items += [(10 + i, r["text"]) for i, r in enumerate(odd.where("doc_id BETWEEN 20 AND 40").collect())]
    table = spark.createDataFrame([(i, t, "clash", 0.1) for i, t in items], "item_id long, text string, doc_id string, score double").repartition(3)
    want = plain_search([(r["doc_id"], r["text"]) for r in odd.collect()], items)
    assert len(want) > 200
    for block in (op13_search.BLOCK, 60):
        got = op13_search.search(odd, table, block=block)
        assert got.columns == ["item_id", "rank", "doc_id", "score"]
        assert sorted((tuple(r) for r in got.collect()), key=str) == want
    assert sorted((tuple(r) for r in op13_search.search(odd, table, best=2).collect()), key=str) == plain_search([(r["doc_id"], r["text"]) for r in odd.collect()], items, 2)


def test_search_ties_and_empty_tables(spark, odd):
    items = spark.createDataFrame([(1, "needle")], "item_id long, text string")
    docs = spark.createDataFrame([(100 - i, "needle in hay") for i in range(60)] + [(None, "needle in hay"), (500, "hay hay hay hay")], "doc_id long, text string").repartition(7)
    got = op13_search.search(docs, items).orderBy("rank").collect()
    assert [r["doc_id"] for r in got] == list(range(41, 61)) and len({r["score"] for r in got}) == 1
    assert op13_search.search(empty(docs), items).count() == 0
    assert op13_search.search(docs, empty(items)).count() == 0
