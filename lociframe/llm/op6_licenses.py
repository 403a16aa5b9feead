"""License scans by ordered signature rules, in DataFrame expressions only.

A text is brought to lower case (A-Z) and to words parted by single spaces.
Rules are hand-written regular expressions over that form (``op6_signatures``),
each with a priority, a confidence and a label.  A rule runs only where the
longest text that its expression cannot match without stands; texts without
any cue word skip all rules, and every rule's expression holds a cue word
(checked when the rules are read, so neither gate can lose a detection).
Detections that lie in another one's interval are suppressed, of equal
intervals the one of higher priority stays, and of two neighbours left that
overlap in part the one of lower priority goes.

The base phrases are found apart from the rules: every place where their words
stand consecutively counts, and their labels always stay.

Cases: a null text counts as empty (no words, no places, empty strings, score
0); rows are scanned one by one in one projection, so repeated rows, ties,
empty tables and further columns change nothing; whole texts are read, and a
text with n detections takes work in proportion to n log n.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let
from .op6_signatures import literals, rules

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What parts words, before and after lower-casing.
RAW_WORD = "[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
GAP = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
#: Parts of single words, so it makes no difference what stands between words; every rule needs one of them.
CUES = ("licen", "under", "copyright", "permission", "permitted", "redistribut", "reserved", "domain", "warrant", "altered", "acknowledg", "misrepresent", "evil", "openssl", "jpeg", "proprietary", "prohibited", "whatever", "reproduced", "internal", "apache", "gpl", "clause")
#: Cues that are whole words (digits may follow), for identifiers whose letters stand in many other words.
SHORT_CUES = ("mpl", "mplv", "epl", "cddl", "eupl", "bsl", "cc")

# Base phrases and their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

SPAN = "struct<s:int,e:int,p:int,label:string,confidence:double>"


def _table() -> Column:
    out = []
    for r in rules():
        fixed = literals(r["pattern"].removesuffix("(?= )"))
        if not any(c in x for x in fixed for c in CUES) and not any(re.search(f" {c}(?![a-z])", x) for x in fixed for c in SHORT_CUES):
            raise ValueError(f"no cue in {r['pattern']}")
        out.append(F.struct(*[F.lit(r[c]).alias(c) for c in ("keyword", "priority", "confidence", "label", "pattern")]))
    return F.array(*out)


def normal_form(text: Column) -> Column:
    """Lower-cased words, each with a space before it, and a space at the end."""
    return F.regexp_replace(F.concat(F.lit(" "), F.translate(text, UPPER, LOWER), F.lit(" ")), GAP, " ")


def running(values: Column, combine) -> Column:
    """Running sums, maxima or the like of an array, by doubling steps: work in proportion to n log n."""
    steps = F.filter(F.array(*[F.lit(1 << k) for k in range(31)]), lambda k: k < F.size(values))
    return F.aggregate(steps, values, lambda acc, k: F.transform(acc, lambda x, i: F.when(i >= k, combine(x, F.get(acc, i - k))).otherwise(x)))


def _spans(norm: Column, rule: Column) -> Column:
    """Detections of one rule: array of (start, minus end, minus priority, label, confidence)."""

    def placed(x: Column) -> Column:
        # a detection ends where the text before it, the detections before it and itself have been passed
        steps = F.transform(x["found"], lambda f, i: F.length(f) + F.length(F.get(x["parts"], i)))
        ends = running(steps, lambda a, b: a + b)
        return let(ends, lambda e: F.transform(x["found"], lambda f, i: F.struct((F.get(e, i) - F.length(f)).alias("s"), (-F.get(e, i)).alias("e"), (-rule["priority"]).alias("p"), rule["label"].alias("label"), rule["confidence"].alias("confidence"))))

    return let(F.struct(F.split(norm, rule["pattern"], -1).alias("parts"), F.regexp_extract_all(norm, rule["pattern"], F.lit(0)).alias("found")), placed)


def _resolved(spans: Column) -> Column:
    """Detections in order without the suppressed ones."""

    def uncontained(x: Column) -> Column:
        upto = running(F.transform(x, lambda d: -d["e"]), F.greatest)
        return let(upto, lambda u: F.filter(x, lambda d, i: (i == 0) | (-d["e"] > F.get(u, i - 1))))

    def strong(x: Column) -> Column:
        # p is minus the priority
        before = lambda d, i: F.coalesce((d["s"] < -F.get(x, i - 1)["e"]) & (F.get(x, i - 1)["p"] < d["p"]), F.lit(False))
        after = lambda d, i: F.coalesce((F.get(x, i + 1)["s"] < -d["e"]) & (F.get(x, i + 1)["p"] < d["p"]), F.lit(False))
        return F.filter(x, lambda d, i: ~before(d, i) & ~after(d, i))

    return let(let(F.sort_array(spans), uncontained), strong)


def detections(norm: Column) -> Column:
    """Array of (s, e, p, label, confidence): what the rules find in a normal form; e and p are negated."""
    hits = F.filter(_table(), lambda r: F.contains(norm, r["keyword"]))
    return let(F.flatten(F.transform(hits, lambda r: _spans(norm, r))), _resolved)


def _phrase(norm: Column, total: Column, phrase: str, label: str) -> Column:
    """struct(n, first, last, label) of one base phrase."""
    spaces = lambda c: F.length(c) - F.length(F.replace(c, F.lit(" "), F.lit("")))
    width = len(phrase.split(" "))

    def places(parts: Column) -> Column:
        n = F.size(parts) - 1
        first = F.when(n > 0, spaces(F.element_at(parts, 1)))
        last = F.when(n > 0, total - (spaces(F.element_at(parts, -1)) - 1) - width)
        return F.struct(n.alias("n"), first.alias("first"), last.alias("last"), F.when(n > 0, F.lit(label)).alias("label"))

    return let(F.split(norm, f" {phrase}(?= )", -1), places)


def cued(text: Column) -> Column:
    """True if a cue word stands anywhere; nothing but ASCII letters matters, and these lower-case alike everywhere."""
    short = f"(?<![a-z0-9])(?:{'|'.join(SHORT_CUES)})(?![a-z])"
    return let(F.lower(text), lambda t: reduce(Column.__or__, [F.contains(t, F.lit(c)) for c in CUES]) | t.rlike(short))


def scan(docs: DataFrame, keep: list[str]) -> DataFrame:
    """The columns in ``keep``, n_words, n_base, first_word, last_word, base_labels, labels, score and the detections' spans."""
    text = F.coalesce(F.col("text"), F.lit(""))
    total = F.regexp_count(text, F.lit(RAW_WORD))
    join = lambda a: F.array_join(F.array_sort(F.array_distinct(a)), ",")

    def found(norm: Column) -> Column:
        base = F.array(*[_phrase(norm, total, p, label) for p, label in PHRASES.items()])
        return let(F.struct(base.alias("b"), detections(norm).alias("d")), summed)

    def summed(x: Column) -> Column:
        own = F.filter(F.transform(x["b"], lambda b: b["label"]), lambda v: v.isNotNull())
        by_rule = F.transform(x["d"], lambda d: d["label"])
        n = F.aggregate(x["b"], F.lit(0), lambda a, b: a + b["n"])
        score = F.greatest(F.aggregate(x["d"], F.lit(0.0), lambda a, d: F.greatest(a, d["confidence"])), F.when(n > 0, F.lit(0.7)).otherwise(0.0))
        ends = lambda field, f: f(F.transform(x["b"], lambda b: b[field])).cast("long")
        spans = F.transform(x["d"], lambda d: F.struct(d["s"].alias("start"), (-d["e"]).alias("end"), d["label"].alias("label"), d["confidence"].alias("confidence")))
        return F.struct(n.cast("long").alias("n_base"), ends("first", F.array_min).alias("first_word"), ends("last", F.array_max).alias("last_word"), join(own).alias("base_labels"), join(F.concat(own, by_rule)).alias("labels"), score.alias("score"), spans.alias("spans"))

    none = F.struct(F.lit(0).cast("long").alias("n_base"), F.lit(None).cast("long").alias("first_word"), F.lit(None).cast("long").alias("last_word"), F.lit("").alias("base_labels"), F.lit("").alias("labels"), F.lit(0.0).alias("score"), F.array().cast("array<struct<start:int,end:int,label:string,confidence:double>>").alias("spans"))
    rows = docs.select(*[F.col(c).alias(f"_in_{c}") for c in keep], total.cast("long").alias("n_words"), F.when(cued(text), let(normal_form(text), found)).otherwise(none).alias("_m"))
    return rows.select(*[F.col(f"_in_{c}").alias(c) for c in keep], "n_words", "_m.*")
