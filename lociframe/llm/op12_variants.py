"""Grouping of spelling variants by asymmetric q-chunks, in DataFrame expressions.

Words are runs of letters, lower-cased, of at least ``LEAST_LENGTH`` code
points that occur ``LEAST_COUNT`` times or more.  Two words are near if they
differ by exactly one inserted, deleted or replaced code point.  Of two such
words the shorter one (of equally long ones the lesser) contributes two
disjoint chunks, its halves; the other contributes its positional grams of the
chunks' lengths.  One edit leaves a chunk whole, and the chunk then lies in the
other word at its own place or shifted by the difference of the lengths, which
is at most one; grams at other places would meet no chunk of a near word and
are not made.  A chunk alone is shared by too many words, so its key also holds
half of what the edit is in: one edit leaves the first or the second half of
that whole too.  This gives four kinds of keys; a pair of words that agrees in
several is taken at the first.  What meets is verified by its edit distance.

A word's form is its near word of largest count if that is ``RATIO`` times its
own or more, its root the last word on the way from form to form.  Counts grow
by that factor with each step, so the ways are short; they are followed by
doubling until nothing changes.

Occurrences are summed before the shuffle and words meet once each, so no key
grows with the number of occurrences, however frequent a word or a text.

Cases: null, empty and blank texts have no words; a null doc_id stands as the
empty text in the hash that decides which letter is left out; repeated rows
count as often as they occur; ties of counts go to the smallest word in code
point order; texts and words of any length are read whole; an empty table gives
an empty result; further columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage

LEAST_LENGTH, LEAST_COUNT, RATIO = 7, 2, 10
LETTERS = "[A-Za-z\\u00C0-\\u00FF]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: One in so many runs (by hash of id and run) is read with a letter left out.
MARKED = 31


def occurrences(docs: DataFrame) -> DataFrame:
    """(word): every run of letters that may be long enough, with the letter left out where the hash asks for it."""
    # a shorter run can't become long enough
    runs = F.regexp_extract_all(F.translate("text", UPPER, LOWER), F.lit(f"({LETTERS}{{{LEAST_LENGTH},}})"), 1)
    t = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.explode(runs).alias("run"))
    t = t.select("run", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")).alias("h"))
    at = (F.col("h") % F.length("run")).cast("int")
    less = F.concat(F.substring(F.col("run"), F.lit(1), at), F.substring(F.col("run"), at + 2, F.length("run")))
    return t.select(F.when(F.col("h") % MARKED == 0, less).otherwise(F.col("run")).alias("word"))


def vocabulary(docs: DataFrame) -> DataFrame:
    """(word, n) of the words that are long and frequent enough."""
    words = occurrences(docs).where(F.length("word") >= LEAST_LENGTH)
    return words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= LEAST_COUNT)


def _cut(word: Column, start: Column, end: Column) -> Column:
    """Code points from ``start`` (from 0) up to ``end``."""
    return F.substring(word, start + 1, end - start)


def _keys(word: Column, length: Column, shift: int) -> list[Column]:
    """The four kinds of keys that ``word`` has for a partner of ``length`` code points with the chunks; ``shift``: by how many the word is longer.

    Chunks are [0, half) and [half, length).  Kinds 0 and 1 hold the first chunk
    with the first or second half of what follows, kinds 2 and 3 the second
    chunk with the first or second half of what comes before.
    """
    half = F.floor(length / 2).cast("int")
    low, high = F.floor(half / 2).cast("int"), (half + F.floor((length - half) / 2)).cast("int")
    zero, end = F.lit(0), length + shift
    first, second = _cut(word, zero, half), _cut(word, half + shift, end)
    return [
        F.struct(first.alias("chunk"), _cut(word, half, high).alias("side")),
        F.struct(first.alias("chunk"), _cut(word, high + shift, end).alias("side")),
        F.struct(second.alias("chunk"), _cut(word, zero, low).alias("side")),
        F.struct(second.alias("chunk"), _cut(word, low + shift, half + shift).alias("side")),
    ]


def _keyed(words: DataFrame, shift: int) -> DataFrame:
    """(key, kind, word, n): one row for each kind; the key is a hash of kind, partner's length, chunk and side."""
    length = F.length("word") - shift
    rows = [F.struct(F.xxhash64(F.lit(i), length, k).alias("key"), F.lit(i).cast("byte").alias("kind")) for i, k in enumerate(_keys(F.col("word"), length, shift))]
    return words.select("word", "n", F.explode(F.array(*rows)).alias("r")).select("r.key", "r.kind", "word", "n")


def near_pairs(words: DataFrame) -> DataFrame:
    """(a, a_n, b, b_n): every pair of near words once, a the shorter or lesser."""
    chunks = _keyed(words, 0).select("key", F.col("kind").alias("kind"), F.col("word").alias("a"), F.col("n").alias("a_n"))
    # grams of words as long as the chunks' word, and of words longer by one
    grams = _keyed(words, 0).union(_keyed(words.where(F.length("word") > LEAST_LENGTH), 1))
    grams = grams.select("key", F.col("kind").alias("b_kind"), F.col("word").alias("b"), F.col("n").alias("b_n"))
    longer = F.length("b") - F.length("a")
    met = chunks.join(grams, "key").where((F.col("kind") == F.col("b_kind")) & ((longer == 1) | ((longer == 0) & (F.col("a") < F.col("b")))))
    met = met.where(F.levenshtein("a", "b", 1) == 1)
    # keys on which both words agree; the pair counts at the first
    agree = [[x == y for x, y in zip(_keys(F.col("a"), F.length("a"), 0), _keys(F.col("b"), F.length("a"), s), strict=True)] for s in (0, 1)]
    kinds = [F.when(longer == 0, same).otherwise(shifted) for same, shifted in zip(*agree, strict=True)]
    first = F.coalesce(*[F.when(k, F.lit(i)) for i, k in enumerate(kinds)])
    return met.where(F.col("kind") == first).select("a", "a_n", "b", "b_n")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for the words of ``forms`` (word, form): the last word on the way of forms."""
    way = cut_lineage(forms.select("word", F.col("form").alias("root")))
    while True:
        on = way.select(F.col("word").alias("root"), F.col("root").alias("next"))
        further = cut_lineage(way.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        way = further.drop("moved")
        if not further.where("moved").limit(1).count():
            return way


def grouped(docs: DataFrame) -> DataFrame:
    """word, form, root, n, n_near and form_n of every word; near words, forms and roots as the module says."""
    words = cut_lineage(vocabulary(docs))
    pairs = near_pairs(words)
    sides = pairs.select(F.explode(F.array(F.struct(F.col("a").alias("word"), F.col("b").alias("near"), F.col("b_n").alias("near_n")), F.struct(F.col("b").alias("word"), F.col("a").alias("near"), F.col("a_n").alias("near_n")))).alias("s")).select("s.*")
    best = sides.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("form"))).alias("best"))
    joined = words.join(best, "word", "left").withColumn("form_n", -F.col("best.less"))
    is_form = F.coalesce(F.col("form_n") >= RATIO * F.col("n"), F.lit(False))
    judged = joined.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(is_form, F.col("best.form")).alias("form"), F.when(is_form, F.col("form_n")).alias("form_n"))
    judged = cut_lineage(judged)
    way = roots(judged.where("form IS NOT NULL"))
    return judged.join(way, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
