"""Toxicity: a linear classifier of character n-grams scaled by naive Bayes log-count ratios.

A text's features are the distinct character n-grams of its words (runs of
ASCII letters, digits and what is beyond ASCII, lower-cased, between word
marks), by hash into 2^TABLE_BITS places; whether an n-gram occurs counts, not
how often, so one insult weighs the same in a short and a very long text.  For
each n-gram the log ratio of its shares in toxic and other texts is taken over
all labelled texts that may be learned from.  N-grams whose ratio is at least
LEAST_ERRORS standard errors away from zero are kept (the FEATURES clearest
ones at most), and logistic regression with a ridge on these, each multiplied
by its ratio, gives the weights.

The regression runs in numpy on the driver over a bounded sample: the SAMPLE
texts of each label that come first by hash, weighed so that each label has its
share in all labelled texts.  Of LEAST_ERRORS and RIDGES those are taken
that do best on a fifth of them left out.  The model is a table of weights by
hash of one size for any corpus; scoring is one pass over whole texts.

Cases: texts without words (null, empty, blank) score by the intercept alone;
null labels and labels without an id are ignored; equal texts are one example
with the mean of their labels (toxic from one half on); without labels of both
kinds every score is the share of label 1 (one half without any); repeated rows
and ties score alike; texts of any length are read whole; an empty table gives
an empty result; further columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage, give_back, prepare, summed_tables

#: Lengths of n-grams, word marks included.
SIZES = (3, 4, 5, 6)
TABLE_BITS = 20
SAMPLE = 3000
LEAST_ERRORS, FEATURES = (3.0, 4.0), 5_000
RIDGES = (1.0, 0.1, 0.01)
ROUNDS = 100
#: Up to so many examples (about 40 bytes each) are broadcast to the texts; more are joined by key.
MOST_BROADCAST = 400_000
#: Code points of a text that are read at a time.
PIECE = 1 << 17
#: ASCII letters and digits as they are (texts are lower-cased before), other ASCII characters a blank, the word mark.
FOLD = np.array([c if chr(c).isalnum() else 32 for c in range(128)], np.uint64)


def _window_places(points: np.ndarray) -> np.ndarray:
    """Places of the n-grams that start in ``points`` (folded code points), in no order, with repeats."""
    blanks = np.concatenate([[0], np.cumsum(points == 32)])
    out, h = [], np.zeros(len(points) + 1, np.uint64)
    with np.errstate(over="ignore"):
        for size in range(1, SIZES[-1] + 1):
            n = len(points) - size + 1
            if n <= 0:
                break
            h = h[:n] * np.uint64(0x100000001B3) + points[size - 1 :] + np.uint64(1)
            if size >= SIZES[0]:
                inner = blanks[size - 1 : size - 1 + n] == blanks[1 : 1 + n]  # a mark may only be at the ends
                out.append((h[inner] * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - TABLE_BITS)).astype(np.int32))
    return np.concatenate(out) if out else np.empty(0, np.int32)


def places(text: str | None, known: np.ndarray | None = None) -> np.ndarray:
    """Distinct places of a text's n-grams; with ``known`` (a number for each place, -1 for none) the numbers of those that it knows."""
    found = [np.empty(0, np.int32)]
    points = np.frombuffer(f" {text or ''} ".lower().encode("utf-32-le"), np.uint32)
    for lo in range(0, len(points), PIECE):
        piece = points[lo : lo + PIECE + SIZES[-1] - 1].astype(np.uint64)
        got = _window_places(np.where(piece < 128, FOLD[np.minimum(piece, 127).astype(np.int64)], piece))
        if known is not None:
            got = known[got]
            got = got[got >= 0]
        found.append(np.unique(got))
    return np.unique(np.concatenate(found)) if len(found) > 2 else found[-1]


def ratios(toxic: np.ndarray, other: np.ndarray, n_toxic: int, n_other: int) -> tuple[np.ndarray, np.ndarray]:
    """Log ratio of the n-grams' smoothed shares in the two kinds of texts, and how many standard errors it is from zero."""
    ratio = np.log((toxic + 1) / (n_toxic + 2)) - np.log((other + 1) / (n_other + 2))
    return ratio, np.abs(ratio) / np.sqrt(1 / (toxic + 1) + 1 / (other + 1))


def minimised(value_and_slope, x: np.ndarray, rounds: int = ROUNDS, kept: int = 8) -> np.ndarray:
    """Where a smooth convex function is least: limited-memory quasi-Newton steps with a line search, from ``x`` on."""
    value, slope = value_and_slope(x)
    moves: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(rounds):
        if np.abs(slope).max() < 1e-6:
            break
        way, shares = -slope, []
        for s, y in reversed(moves):
            shares.append((s @ way) / (s @ y))
            way = way - shares[-1] * y
        if moves:
            s, y = moves[-1]
            way = way * (s @ y) / (y @ y)
        for (s, y), share in zip(moves, reversed(shares), strict=True):
            way = way + (share - (y @ way) / (s @ y)) * s
        step = 1.0 if moves else min(1.0, 1 / np.abs(slope).sum())
        while True:
            after, after_slope = value_and_slope(x + step * way)
            if after <= value + 1e-4 * step * (slope @ way):
                break
            step /= 2
            if step < 1e-12:
                return x
        s, y = step * way, after_slope - slope
        if s @ y > 1e-14:
            moves = [*moves[1 - kept :], (s, y)]
        x, value, slope = x + s, after, after_slope
    return x


class Linear:
    """Logistic regression with a ridge over sparse binary rows, columns scaled by ``scale``."""

    def __init__(self, rows: list[np.ndarray], y: np.ndarray, share: np.ndarray, scale: np.ndarray, ridge: float, start: "Linear | None" = None):
        """``share``: weight of each row; ``start``: a solution to begin from."""
        at = np.concatenate(rows) if rows else np.empty(0, np.int64)
        of = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
        value, share, ridge = scale[at], share / share.sum(), ridge / len(rows)

        def value_and_slope(x: np.ndarray) -> tuple[float, np.ndarray]:
            w, bias = x[:-1], x[-1]
            logit = np.bincount(of, weights=value * w[at], minlength=len(rows)) + bias
            g = share * (1 / (1 + np.exp(-np.clip(logit, -500, 500))) - y)
            loss = share @ (np.logaddexp(0, logit) - y * logit) + ridge / 2 * (w @ w)
            return loss, np.append(np.bincount(at, weights=value * g[of], minlength=len(scale)) + ridge * w, g.sum())

        first = np.append(np.zeros(len(scale)), np.log((share @ y + 1e-9) / (share @ (1 - y) + 1e-9)))
        self.solution = minimised(value_and_slope, first if start is None else start.solution)
        self.weights, self.bias = self.solution[:-1] * scale, float(self.solution[-1])

    def logits(self, rows: list[np.ndarray]) -> np.ndarray:
        return np.array([self.bias + self.weights[r].sum() for r in rows])


class Model:
    """Weights of the n-grams kept, by place, and the intercept."""

    def __init__(self, kept: np.ndarray, weights: np.ndarray, bias: float):
        self.kept, self.weights, self.bias = kept, weights.astype(np.float64), bias

    def scorer(self):
        """A function from text to score."""
        known = numbered(self.kept)
        return lambda text: float(1 / (1 + np.exp(-np.clip(self.bias + self.weights[places(text, known)].sum(), -30, 30))))


def numbered(kept: np.ndarray) -> np.ndarray:
    """For each place its number among those kept, or -1."""
    out = np.full(1 << TABLE_BITS, -1, np.int32)
    out[kept] = np.arange(len(kept))
    return out


def text_key() -> Column:
    return F.xxhash64(F.coalesce("text", F.lit("")))


def examples(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(h, y, id): one row per distinct labelled text: its hash, mean label and least doc_id."""
    known = labels.where("toxic IS NOT NULL AND doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("_t_id")).agg(F.avg("toxic").alias("_t"))
    rows = docs.select("doc_id", text_key().alias("h")).join(known, F.col("doc_id") == F.col("_t_id"))
    return rows.groupBy("h").agg((F.avg("_t") >= 0.5).alias("y"), F.min("doc_id").alias("id"))


def counts(texts: DataFrame) -> list[np.ndarray]:
    """Of (text, y): the number of other and toxic texts that hold an n-gram of each place, over all rows."""

    def fill(batches):
        tables = [np.zeros(1 << TABLE_BITS, np.int32) for _ in range(2)]
        for batch in batches:
            for text, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                tables[int(y)][places(text)] += 1
        return tables

    return summed_tables(texts.select("text", "y"), fill, [1 << TABLE_BITS] * 2, kind=np.float32)


def _solved(rows: list[np.ndarray], y: np.ndarray, share: np.ndarray, ratio: np.ndarray, errors: np.ndarray) -> tuple[np.ndarray, Linear]:
    """(numbers of the n-grams kept, regression on them): the least clarity and the ridge that do best on a fifth left out."""
    held = np.arange(len(rows)) % 5 == 4
    both = len(set(y[~held])) == 2 and held.any()
    tried = []
    for least in LEAST_ERRORS:
        kept = np.flatnonzero(errors >= least)
        number = np.full(len(errors), -1)
        number[kept] = np.arange(len(kept))
        x = [(lambda r: r[r >= 0])(number[r]) for r in rows]
        part = lambda which: [r for r, w in zip(x, which, strict=True) if w]  # noqa: B023, E731
        linear = None
        for ridge in RIDGES:
            loss = 0.0
            if both:
                linear = Linear(part(~held), y[~held], share[~held], ratio[kept], ridge, linear)
                logit = linear.logits(part(held))
                loss = share[held] @ (np.logaddexp(0, logit) - y[held] * logit)
            tried.append((loss, len(tried), kept, x, ridge))
    _, _, kept, x, ridge = min(tried, key=lambda t: t[:2])
    return kept, Linear(x, y, share, ratio[kept], ridge)


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """The model; ``labels`` has doc_id and toxic."""
    prepare(docs.sparkSession)
    ids = cut_lineage(examples(docs, labels))
    n = {bool(r["y"]): r["count"] for r in ids.groupBy("y").count().collect()}
    if len(n) < 2:
        return Model(np.empty(0, np.int64), np.empty(0), {(): 0.0, (True,): 30.0, (False,): -30.0}[tuple(n)])
    # a small table of examples goes to the texts, a large one is joined by key
    few = F.broadcast(ids) if sum(n.values()) <= MOST_BROADCAST else ids
    texts = docs.select("doc_id", "text", text_key().alias("_t_h")).join(few, (F.col("doc_id") == F.col("id")) & (F.col("_t_h") == F.col("h"))).select("text", "y", "h")
    other, toxic = counts(texts)
    ratio, errors = ratios(toxic, other, n[True], n[False])
    clear = np.flatnonzero(errors >= LEAST_ERRORS[0])
    kept = np.sort(clear[np.argsort(-errors[clear], kind="stable")][:FEATURES])
    ratio, errors = ratio[kept], errors[kept]
    del other, toxic, clear
    give_back()  # the driver has little memory
    known = docs.sparkSession.sparkContext.broadcast(kept)
    # the texts that come first by hash; their number is bounded by a share of each label's
    place = F.pmod(F.xxhash64("h"), F.lit(1_000_003))
    chosen = texts.where(place <= F.when(F.col("y"), int(min(1.0, sample / n[True]) * 1_000_003)).otherwise(int(min(1.0, sample / n[False]) * 1_000_003))).dropDuplicates(["h"])

    def run(batches):
        number = numbered(known.value)
        for batch in batches:
            found = [places(t, number).tobytes() for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(1), batch.column(2), pa.array(found, pa.binary())], names=["y", "h", "x"])
        give_back()

    rows = chosen.select("text", "y", "h").mapInArrow(run, "y boolean, h long, x binary").orderBy("h").collect()
    known.unpersist()
    y = np.array([float(r["y"]) for r in rows])
    share = np.where(y == 1, n[True] / max(y.sum(), 1), n[False] / max((1 - y).sum(), 1))
    best, linear = _solved([np.frombuffer(r["x"], np.int32) for r in rows], y, share, ratio, errors)
    del rows
    give_back()
    return Model(kept[best], linear.weights, linear.bias)


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and score (0 to 1, higher: more toxic) of every row."""
    prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        score = shared.value.scorer()
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([score(t) for t in batch.column(1).to_pylist()], pa.float64())], names=["doc_id", "score"])
        give_back()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, score double")


def is_held_out(doc_id: Column) -> Column:
    """True for rows whose labels are never learned from; a null id is not held out (it has no labels)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every row; labels of held-out rows are not read."""
    held = is_held_out(F.col("doc_id"))
    rows = scored(docs, fit(docs, labels.where(~held)))
    return rows.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
