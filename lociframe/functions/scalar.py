"""Column functions of the association pipeline; all stay in the JVM."""

from __future__ import annotations

from functools import reduce
from math import pi

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import EDGE_LOGP, SMALLEST_P, Z_975


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def snp_key(chrom, bp, ea, oa) -> Column:
    """``chr:bp_EA_OA`` without exponents or blanks."""
    return F.concat(_c(chrom).cast("long").cast("string"), F.lit(":"), _c(bp).cast("long").cast("string"), F.lit("_"), F.trim(_c(ea)), F.lit("_"), F.trim(_c(oa)))


def compress_allele(allele, longest: int = 10) -> Column:
    """Alleles over ``longest`` characters as a Murmur3 hash in hex."""
    a = _c(allele)
    return F.when(F.length(a) > longest, F.lower(F.hex(F.hash(a)))).otherwise(a)


def block_parts(name) -> Column:
    """struct(ancestry, chr, start, stop) of a block name."""
    p = F.split(_c(name), "[/-]")
    return F.struct(p[0].alias("ancestry"), p[1].cast("int").alias("chr"), p[2].cast("long").alias("start"), p[3].cast("long").alias("stop"))


def flat_block(name) -> Column:
    return F.regexp_replace(_c(name), "[/-]", "_")


def sub_first(text, pattern: str, new: str) -> Column:
    """Replace the first match only."""
    return F.regexp_replace(_c(text), f"^((?s:.*?)){pattern}", f"$1{new}")


def keep_two_dashes(text) -> Column:
    """Dashes after the second become underscores."""
    p = F.split(_c(text), "-")
    return F.when(F.size(p) > 3, F.concat(F.array_join(F.slice(p, 1, 3), "-"), F.lit("_"), F.array_join(F.slice(p, 4, 1_000_000), "_"))).otherwise(_c(text))


def before(text, mark: str) -> Column:
    return F.substring_index(_c(text), mark, 1)


def base_name(path, extension: str = "") -> Column:
    name = F.regexp_extract(F.regexp_replace(_c(path), "/{2,}", "/"), "([^/]+)$", 1)
    return F.regexp_replace(name, f"{extension}$", "") if extension else name


def fix_indel(pos1, pos2, ref, alt) -> Column:
    """struct(pos1, pos2, ref, alt): insertions and deletions without their anchor base; the deletion rule sees the new pos1."""
    p1, p2, r, a = map(_c, (pos1, pos2, ref, alt))
    ins, dele = (F.length(r) == 1) & (F.length(a) > 1), (F.length(r) > 1) & (F.length(a) == 1)
    first = F.when(ins | dele, p1 + 1).otherwise(p1)
    second = F.when(dele, first + F.length(r) - 2).when(ins, p2).otherwise(p2)
    rest = lambda x: F.substr(x, F.lit(2))
    return F.struct(first.alias("pos1"), second.alias("pos2"), F.when(ins, F.lit("-")).when(dele, rest(r)).otherwise(r).alias("ref"), F.when(ins, rest(a)).when(dele, F.lit("-")).otherwise(a).alias("alt"))


def variant_name(chrom, pos, a, b) -> Column:
    """``chr:pos_A_B`` with the alleles in order."""
    return F.concat(_c(chrom), F.lit(":"), _c(pos), F.lit("_"), F.least(_c(a), _c(b)), F.lit("_"), F.greatest(_c(a), _c(b)))


def annotation(extra, key: str) -> Column:
    """Value of a key in ``key=value;...``; null if it isn't there."""
    return F.element_at(F.str_to_map(_c(extra), F.lit(";"), F.lit("=")), key)


def flipped(ea, oa) -> Column:
    """True where the alleles are out of order (D and I stay as they are)."""
    return (_c(ea) > _c(oa)) & ~_c(ea).isin("D", "I")


def standard_alleles(ea, oa, eaf, beta, z) -> Column:
    """struct(ea, oa, eaf, beta, z) with the alleles in order and the effect turned with them."""
    f = flipped(ea, oa)
    turn = lambda x: F.when(f, -_c(x)).otherwise(_c(x))
    return F.struct(F.when(f, _c(oa)).otherwise(_c(ea)).alias("ea"), F.when(f, _c(ea)).otherwise(_c(oa)).alias("oa"), F.when(f, 1 - _c(eaf)).otherwise(_c(eaf)).alias("eaf"), turn(beta).alias("beta"), turn(z).alias("z"))


def z_score(beta, se) -> Column:
    return _c(beta) / F.when(_c(se) == 0, F.lit(1e-5)).otherwise(_c(se))


def p_from_log(lp) -> Column:
    """10^-LP, with the smallest positive double for 0."""
    p = F.pow(F.lit(10.0), -_c(lp))
    return F.when(p == 0, F.lit(SMALLEST_P)).otherwise(p)


def erfc(x: Column) -> Column:
    """Complementary error function by a Chebyshev fit: relative error below 1.2e-7."""
    # Coefficients of the rational fit, highest power first.
    terms = (0.17087277, -0.82215223, 1.48851587, -1.13520398, 0.27886807, -0.18628806, 0.09678418, 0.37409196, 1.00002368, -1.26551223)
    t = 1 / (1 + 0.5 * F.abs(x))
    poly = reduce(lambda acc, c: acc * t + c, terms[1:], F.lit(terms[0]))
    y = t * F.exp(poly - x * x)
    return F.when(x >= 0, y).otherwise(2 - y)


def erfc_sql(x: str) -> str:
    """The same for DuckDB, for x of 0 or more."""
    t = f"(1 / (1 + 0.5 * {x}))"
    poly = "0.17087277::DOUBLE"
    for c in (-0.82215223, 1.48851587, -1.13520398, 0.27886807, -0.18628806, 0.09678418, 0.37409196, 1.00002368, -1.26551223):
        poly = f"({poly} * {t} + ({c}::DOUBLE))"
    return f"({t} * exp({poly} - {x} * {x}))"


def two_sided_p(z) -> Column:
    return erfc(F.abs(_c(z)) / F.lit(2.0**0.5))


def odds_to_beta(odds, lower) -> Column:
    """struct(beta, se) from an odds ratio and its lower bound."""
    beta = F.log(_c(odds))
    return F.struct(beta.alias("beta"), ((F.log(_c(lower)) - beta) / -Z_975).alias("se"))


def odds_to_beta_rare(odds, upper) -> Column:
    """struct(beta, se) for rare variants: a zero ratio counts as 0.01 with no error."""
    o = F.when(_c(odds) == 0, F.lit(0.01)).otherwise(_c(odds))
    return F.struct(F.log(o).alias("beta"), F.when(o == 0.01, F.lit(0.0)).otherwise((F.log(_c(upper)) - F.log(o)) / 1.96).alias("se"))


def bayes_factor(z, se, prior_sd) -> Column:
    """Approximate log Bayes factor of one SNP."""
    r = _c(prior_sd) ** 2 / (_c(prior_sd) ** 2 + _c(se) ** 2)
    return (F.log(1 - r) + r * _c(z) ** 2) / 2


def abs_z_from_lbf(lbf, se, variance: float = 50.0) -> Column:
    """|z| that a log Bayes factor stands for; 0 where none does.

    With ln sqrt(1 - r) in place of ln (1 - r) this isn't the inverse of ``bayes_factor``; it is kept so, as the
    published results were made with it.
    """
    r = F.lit(variance) / (F.lit(variance) + _c(se) ** 2)
    return F.sqrt(F.greatest((2 * _c(lbf) - F.log(F.sqrt(1 - r))) / r, F.lit(0.0)))


def p_from_lbf(lbf, se, variance: float = 50.0) -> Column:
    """Two-sided p-value that a log Bayes factor stands for."""
    return two_sided_p(abs_z_from_lbf(lbf, se, variance))


def edge_weight(p) -> Column:
    """Weight of an edge from a p-value: scaled -log10 p, to the fourth, from 0.5 to 1."""
    lo, hi = EDGE_LOGP
    x = (F.least(F.greatest(-F.log10(_c(p)), F.lit(lo)), F.lit(hi)) - lo) / (hi - lo)
    return F.pow(x, F.lit(4.0)) * 0.5 + 0.5


def pixel(value, total, width: float, inverted: bool = False, margin: float = 0.0) -> Column:
    x = _c(value) / _c(total) * width
    return F.lit(width - margin) - x if inverted else x


def wald(beta, se) -> Column:
    """struct(estimate, low, high) as odds ratios."""
    b, s = _c(beta), _c(se)
    return F.struct(F.exp(b).alias("estimate"), F.exp(b - 1.96 * s).alias("low"), F.exp(b + 1.96 * s).alias("high"))


def keyword_class(text, rules: list[tuple[str, str]]) -> Column:
    """Label of the last rule (pattern, label) that matches, whatever the case; the text itself if none does."""
    out = _c(text)
    for pattern, label in rules:
        out = F.when(_c(text).rlike(f"(?i){pattern}"), F.lit(label)).otherwise(out)
    return out


def count_true(*flags) -> Column:
    return reduce(lambda a, b: a + b, [F.coalesce(_c(f).cast("int"), F.lit(0)) for f in flags])


def tidy_list(text, mark: str = ";") -> Column:
    """Distinct items of a delimited list in order; null for an empty one."""
    items = F.array_sort(F.array_distinct(F.transform(F.split(_c(text), mark), lambda x: F.trim(x))))
    joined = F.array_join(F.filter(items, lambda x: x != ""), mark)
    return F.when(joined != "", joined)


def log_gamma(x: Column) -> Column:
    """Logarithm of the gamma function for x above 0: Stirling's series at x + 8, stepped back; error below 1e-13 for the factor."""
    y = x + 8
    stirling = (y - 0.5) * F.log(y) - y + 0.5 * F.log(F.lit(2 * pi)) + 1 / (12 * y) - 1 / (360 * F.pow(y, F.lit(3.0))) + 1 / (1260 * F.pow(y, F.lit(5.0))) - 1 / (1680 * F.pow(y, F.lit(7.0)))
    return stirling - F.log(reduce(lambda acc, k: acc * (x + k), range(1, 8), x))


def _beta_fraction(x: Column, a: Column, b: Column, terms: int) -> Column:
    """The continued fraction of the incomplete beta function, from its ``terms``-th pair of terms upwards."""

    def step(acc: Column, k: Column) -> Column:
        even = k * (b - k) * x / ((a + 2 * k - 1) * (a + 2 * k))
        odd = -(a + k) * (a + b + k) * x / ((a + 2 * k) * (a + 2 * k + 1))
        return F.lit(1.0) + even / (F.lit(1.0) + odd / acc)

    pairs = F.aggregate(F.transform(F.sequence(F.lit(terms), F.lit(1), F.lit(-1)), lambda k: k.cast("double")), F.lit(1.0), step)
    return 1 - (a + b) * x / (a + 1) / pairs


def regularised_beta(x: Column, a: Column, b: Column, terms: int = 160) -> Column:
    """Regularised incomplete beta function I_x(a, b), 0 <= x <= 1.

    The fraction converges within about the root of the greater parameter; 160
    pairs of terms hold a relative error of 1e-10 up to parameters of 5 000.
    """

    def value(s: Column) -> Column:
        x, a, b = s["x"], s["a"], s["b"]
        front = F.exp(log_gamma(a + b) - log_gamma(a) - log_gamma(b) + a * F.log(x) + b * F.log(1 - x))
        low = front / a / _beta_fraction(x, a, b, terms)
        high = 1 - front / b / _beta_fraction(1 - x, b, a, terms)
        return F.when(x <= 0, F.lit(0.0)).when(x >= 1, F.lit(1.0)).when(x < (a + 1) / (a + b + 2), low).otherwise(high)

    # evaluated once a row and handed over as a lambda variable
    return F.transform(F.array(F.struct(x.alias("x"), a.alias("a"), b.alias("b"))), value)[0]


def f_test_p(f, between, within) -> Column:
    """Upper tail of the F distribution with ``between`` and ``within`` degrees of freedom; null where these aren't above 0."""
    d1, d2, value = _c(between).cast("double"), _c(within).cast("double"), _c(f).cast("double")
    return F.when((d1 > 0) & (d2 > 0), regularised_beta(d2 / (d2 + d1 * value), d2 / 2, d1 / 2))


def f_test_p_sql(f: str, between: str, within: str, terms: int = 160) -> str:
    """The same for DuckDB, over columns or constants."""

    def fraction(x: str, a: str, b: str) -> str:
        step = f"1 + k * ({b} - k) * {x} / (({a} + 2 * k - 1) * ({a} + 2 * k)) / (1 - ({a} + k) * ({a} + {b} + k) * {x} / (({a} + 2 * k) * ({a} + 2 * k + 1)) / acc)"
        return f"(1 - ({a} + {b}) * {x} / ({a} + 1) / list_reduce(list_transform(range({terms}, 0, -1), lambda k: CAST(k AS DOUBLE)), lambda acc, k: {step}, 1::DOUBLE))"

    front = "exp(lgamma(a + b) - lgamma(a) - lgamma(b) + a * ln(x) + b * ln(1 - x))"
    value = f"CASE WHEN x <= 0 THEN 0 WHEN x >= 1 THEN 1 WHEN x < (a + 1) / (a + b + 2) THEN {front} / a / {fraction('x', 'a', 'b')} ELSE 1 - {front} / b / {fraction('(1 - x)', 'b', 'a')} END"
    return f"(SELECT {value} FROM (SELECT CAST({within} AS DOUBLE) / ({within} + {between} * {f}) AS x, CAST({within} AS DOUBLE) / 2 AS a, CAST({between} AS DOUBLE) / 2 AS b) WHERE a > 0 AND b > 0)"
