"""Quality rules by distribution divergence, in DataFrame expressions only.

A document's character classes and common words are counted and compared with
the reference of its language by the Jensen-Shannon distance (base 2, 0 to 1).
A document passes if it is no further from the reference than a fixed
distance.  Each comparison has a minimum length below which it isn't made:
short texts scatter too widely to be judged.  Languages without a reference
are compared with the general character reference and with no words.

All of it is one projection: no shuffle, each text is read once.

Cases: a null text counts as no words and fails the base rule (fewer than 20
words); an empty table gives an empty result; rows are judged one by one, so
repeated rows, ties and further columns change nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE_CLASS, let, words

LEAST_WORDS, REPEAT_WINDOW, MOST_REPEATED = 20, 8, 30
#: Guards: characters for the class comparison, words for the word comparison.
LEAST_CHARS, LEAST_COMMON_OF = 200, 60
#: The word distance is 0.411 for a text without any common word of its language and 0.363 for one in which they hold
#: a twentieth of their usual share, spread evenly; texts with less than that are no prose.
MOST_CHAR_DISTANCE, MOST_WORD_DISTANCE = 0.22, 0.36

# Shares of character classes in running prose - lower-case (or
# caseless) letters, upper-case letters, digits, white space, sentence
# punctuation, all other characters.
CHAR_REFERENCE = {
    "en": (0.785, 0.025, 0.005, 0.160, 0.022, 0.003),
    "de": (0.780, 0.050, 0.005, 0.140, 0.022, 0.003),
    "fr": (0.780, 0.022, 0.005, 0.165, 0.025, 0.003),
    "es": (0.785, 0.022, 0.005, 0.163, 0.022, 0.003),
    "": (0.780, 0.030, 0.007, 0.155, 0.024, 0.004),
}
# Frequent function words of each language, with equal weight.
COMMON_WORDS = {
    "en": ("the", "of", "and", "to", "in", "that", "is", "was", "for", "it", "with", "as", "be", "on", "by", "at"),
    "de": ("der", "die", "und", "in", "den", "von", "zu", "das", "mit", "sich", "des", "auf", "ist", "im", "dem", "nicht"),
    "fr": ("de", "la", "le", "et", "les", "des", "en", "un", "du", "une", "que", "est", "pour", "qui", "dans", "par"),
    "es": ("de", "la", "que", "el", "en", "y", "a", "los", "se", "del", "las", "un", "por", "con", "no", "una"),
}
#: Share of all words that the common words hold in prose.
COMMON_SHARE = 0.30


def js_distance(counts: Column, reference: Column) -> Column:
    """Distance of a histogram (array of counts) from a distribution (array of shares); null without counts."""

    def distance(pair: Column) -> Column:
        total = F.aggregate(pair["c"], F.lit(0.0), lambda a, x: a + x)
        half = lambda p, m: F.when(p > 0, 0.5 * p * F.log2(p / m)).otherwise(0.0)
        term = lambda p, q: half(p, (p + q) / 2) + half(q, (p + q) / 2)
        terms = F.zip_with(pair["c"], pair["r"], lambda c, q: term(c / total, q))
        return F.when(total > 0, F.sqrt(F.greatest(F.aggregate(terms, F.lit(0.0), lambda a, x: a + x), F.lit(0.0))))

    return let(F.struct(F.transform(counts, lambda c: c.cast("double")).alias("c"), reference.alias("r")), distance)


def char_counts(rest: Column, letters: Column) -> Column:
    """Counts of the six character classes, from the text without its lower-case letters and the number of those."""
    upper = F.regexp_count(rest, F.lit("\\p{Lu}"))
    digits = F.regexp_count(rest, F.lit("\\p{Nd}"))
    space = F.length(rest) - F.length(F.regexp_replace(rest, SPACE_CLASS, ""))
    stops = F.regexp_count(rest, F.lit("[.,;:!?'\"()\\-]"))
    seen = F.array(letters, upper, digits, space, stops)
    return let(seen, lambda c: F.concat(c, F.array(F.length(rest) + letters - F.aggregate(c, F.lit(0), lambda a, x: a + x))))


def _by_lang(lang: Column, table: dict, default) -> Column:
    out = F.lit(None) if default is None else default
    for key, value in table.items():
        out = F.when(lang == key, value).otherwise(out)
    return out


def char_reference(lang: Column) -> Column:
    lits = {k: F.array(*[F.lit(float(x)) for x in v]) for k, v in CHAR_REFERENCE.items()}
    return _by_lang(lang, {k: v for k, v in lits.items() if k}, lits[""])


def _equal_to(word: str):
    return lambda w: (w == word) | (w == word.capitalize())


def word_distance(w: Column, lang: Column) -> Column:
    """Distance of the common-word histogram (common words, then all others); null for languages without a list."""
    any_common = sorted({x for ws in COMMON_WORDS.values() for word in ws for x in (word, word.capitalize())})

    def histogram(common: Column) -> Column:
        def counted(listed: tuple) -> Column:
            per = [F.size(F.filter(common, _equal_to(x))) for x in listed]
            return let(F.array(*per), lambda c: F.concat(c, F.array(F.size(w) - F.aggregate(c, F.lit(0), lambda a, x: a + x))))

        return _by_lang(lang, {k: counted(v) for k, v in COMMON_WORDS.items()}, None)

    counts = let(F.filter(w, lambda x: x.isin(any_common)), histogram)
    size = len(next(iter(COMMON_WORDS.values())))
    reference = F.array(*[F.lit(COMMON_SHARE / size)] * size, F.lit(1 - COMMON_SHARE))
    return F.when(lang.isin(list(COMMON_WORDS)) & (F.size(w) >= LEAST_COMMON_OF), js_distance(counts, reference))


def repeated_words(w: Column) -> Column:
    """Words inside 8-word windows that occur twice or more in the array ``w`` (first occurrences included)."""
    size = REPEAT_WINDOW

    def covered(at: Column) -> Column:
        steps = F.transform(at, lambda p, i: F.least(F.lit(size), F.coalesce(F.get(at, i + 1) - p, F.lit(size))))
        return F.aggregate(steps, F.lit(0), lambda a, x: a + x)

    def repeats(s: Column) -> Column:
        twin = F.filter(s, lambda x, i: F.coalesce(F.get(s, i - 1)["h"] == x["h"], F.lit(False)) | F.coalesce(F.get(s, i + 1)["h"] == x["h"], F.lit(False)))
        return let(F.sort_array(F.transform(twin, lambda x: x["p"])), covered)

    def windows(h: Column) -> Column:
        ordered = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("p"))))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(let(ordered, repeats))

    starts = F.sequence(F.lit(1), F.size(w) - size + 1)
    return F.when(F.size(w) < size + 1, F.lit(0)).otherwise(let(F.transform(starts, lambda i: F.xxhash64(F.slice(w, i, size))), windows))


def measures(text: Column, lang: Column) -> Column:
    """struct of n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (all long), char_distance and word_distance."""
    text, lang = F.coalesce(text, F.lit("")), F.coalesce(lang, F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    dup = let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x)))
    by_word = let(words(text), lambda w: F.struct(F.size(w).alias("n"), repeated_words(w).alias("r"), word_distance(w, lang).alias("d")))
    n = F.length(text)
    # all that isn't a lower-case (or caseless) letter: about a quarter of a text
    by_char = let(
        F.regexp_replace(text, "[\\p{L}&&[^\\p{Lu}]]+", ""),
        lambda rest: F.struct(
            (n - F.length(rest) + F.length(F.regexp_replace(rest, SPACE_CLASS, ""))).alias("word_chars"),
            F.regexp_count(rest, F.lit("[#*$%&|<>]")).alias("n_symbols"),
            F.when(n >= LEAST_CHARS, js_distance(char_counts(rest, n - F.length(rest)), char_reference(lang))).alias("d"),
        ),
    )
    return let(
        F.struct(by_word.alias("w"), by_char.alias("c")),
        lambda m: F.struct(
            m["w"]["n"].cast("long").alias("n_words"),
            m["c"]["word_chars"].cast("long").alias("word_chars"),
            m["c"]["n_symbols"].cast("long").alias("n_symbols"),
            dup.cast("long").alias("n_dup_lines"),
            m["w"]["r"].cast("long").alias("n_repeat_words"),
            m["c"]["d"].alias("char_distance"),
            m["w"]["d"].alias("word_distance"),
        ),
    )


def judged(docs: DataFrame, keep: list[str]) -> DataFrame:
    """The columns in ``keep``, the measures, base_failed, kept, char_distance and word_distance."""
    rows = docs.select(*[F.col(c).alias(f"_in_{c}") for c in keep], measures(F.col("text"), F.col("lang")).alias("_m"))
    m = {c: F.col(f"_m.{c}") for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "char_distance", "word_distance")}
    failed = (m["n_words"] < LEAST_WORDS) | (100 * m["n_repeat_words"] > MOST_REPEATED * m["n_words"])
    near = (F.coalesce(m["char_distance"], F.lit(0.0)) <= MOST_CHAR_DISTANCE) & (F.coalesce(m["word_distance"], F.lit(0.0)) <= MOST_WORD_DISTANCE)
    first = [m[c].alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    return rows.select(*[F.col(f"_in_{c}").alias(c) for c in keep], *first, failed.alias("base_failed"), (~failed & near).alias("kept"), m["char_distance"].alias("char_distance"), m["word_distance"].alias("word_distance"))


def filtered(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are kept, unchanged."""
    wrapped = docs.select("text", "lang", F.struct(*docs.columns).alias("row"))
    return judged(wrapped, ["row"]).where("kept").select("row.*")
