"""Quality classifier: random-indexing word vectors, pooled, under a small calibrated network.

Every token has a sparse random index vector drawn from its hash.  A word
vector is the sum of the index vectors of the tokens around a token, over all
documents: the sums and the tokens' counts stand in a table of TABLE_BITS
places by hash, so each token has a place, tokens that share one share a
vector, and the table has one size whatever the corpus.  A document is pooled
as the mean of its tokens' normalised vectors, weighted by rarity, beside the
mean of their own index vectors, their mean rarity and their variety.  A
two-layer network in numpy learns the label from a bounded sample of labelled
texts (``SAMPLE`` distinct ones by hash; a documented bound), and a
temperature fitted on texts that the network has not seen calibrates it.

Scoring is one pass over all documents, whole texts, with a model of bounded
size.  Only the text enters a score.

Cases: null and blank texts pool to zero and get the network's score of that;
labels that are null are ignored, texts with several labels take their mean;
without labels of both kinds every score is the share of label 1 (one half
without any); with fewer than five labelled texts there is none to calibrate
on and the temperature is 1; repeated rows and ties score alike; texts of any
length are read whole; columns of ``docs`` whose names clash with results pass
through ``accepted``; an empty table gives an empty result.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WordHashes, cut_lineage, give_back, mix, prepare, summed_tables

SAMPLE = 6000
WIDTH, NONZERO, REACH = 96, 4, 2
#: The table of word vectors has 2^TABLE_BITS places of WIDTH sums.
TABLE_BITS = 16
#: Characters of text that are pooled at a time.
PIECE = 1 << 17
HIDDEN, EPOCHS, RATE = 32, 200, 0.01
TOKEN = re.compile(rb"[A-Z]{2,}|[A-Za-z\x80-\xff]+|[0-9]+|[^\sA-Za-z0-9\x80-\xff]+|\n")


def tokens(text: str | None) -> list[bytes]:
    """Words (upper-case words apart), digit runs, runs of signs and line ends of a text."""
    return TOKEN.findall(text.encode()) if text else []


def index_places(hashes: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """(place, sign) of each of the NONZERO entries of the tokens' index vectors."""
    out = []
    for k in range(NONZERO):
        part = hashes >> np.uint64(16 * k)
        out.append(((part & np.uint64(0x7FFF)).astype(np.int64) % WIDTH, np.where(part & np.uint64(0x8000), 1, -1).astype(np.int32)))
    return out


def index_vectors(hashes: np.ndarray) -> np.ndarray:
    """Sparse ternary vectors from 64-bit hashes."""
    out = np.zeros((len(hashes), WIDTH), np.float32)
    for place, sign in index_places(hashes):
        np.add.at(out, (np.arange(len(hashes)), place), sign.astype(np.float32))
    return out


def table_places(hashes: np.ndarray, size: int) -> np.ndarray:
    """Place of each token in a table of ``size`` (a power of two) word vectors."""
    return (mix(hashes) & np.uint64(size - 1)).astype(np.int64)


class WordVectors:
    """The table's normalised vectors and shares of all tokens."""

    def __init__(self, counts: np.ndarray, sums: np.ndarray):
        self.vectors = np.empty(sums.shape, np.float16)
        for lo in range(0, len(sums), 4096):  # in pieces: the driver has little memory
            piece = sums[lo : lo + 4096]
            self.vectors[lo : lo + 4096] = piece / np.maximum(np.linalg.norm(piece, axis=1, keepdims=True), 1e-9)
        self.share = counts / max(counts.sum(), 1)

    def pooled(self, hashed: list[np.ndarray]) -> np.ndarray:
        """One row of features per document."""
        out = np.zeros((len(hashed), 2 * WIDTH + 2), np.float32)
        full = [i for i, h in enumerate(hashed) if len(h)]
        if not full:
            return out
        distinct, inverse = np.unique(np.concatenate([hashed[i] for i in full]), return_inverse=True)
        of = np.repeat(np.arange(len(full)), [len(hashed[i]) for i in full])
        own = index_vectors(distinct) / np.sqrt(NONZERO).astype(np.float32)
        at = table_places(distinct, len(self.share))
        weight = (1e-3 / (1e-3 + self.share[at])).astype(np.float32)
        rarity = -np.log(self.share[at] + 1e-7) / 10
        # (document, token) counts, so that each distinct token of a document is added once
        cell, n = np.unique(of * len(distinct) + inverse, return_counts=True)
        doc, tok = np.divmod(cell, len(distinct))
        total = np.bincount(doc, weights=n, minlength=len(full))
        got = np.zeros((len(full), out.shape[1]))
        for lo in range(0, len(doc), 20_000):
            d, t, k = doc[lo : lo + 20_000], tok[lo : lo + 20_000], n[lo : lo + 20_000]
            first = np.flatnonzero(np.r_[True, d[1:] != d[:-1]])
            got[d[first], :WIDTH] += np.add.reduceat(self.vectors[at[t]].astype(np.float32) * (k * weight[t])[:, None].astype(np.float32), first)
            got[d[first], WIDTH : 2 * WIDTH] += np.add.reduceat(own[t] * k[:, None].astype(np.float32), first)
            got[d[first], 2 * WIDTH] += np.add.reduceat(k * rarity[t], first)
            got[d[first], 2 * WIDTH + 1] += np.add.reduceat(np.ones(len(t)), first)
        out[full] = got / total[:, None]
        return out


def features(words: WordVectors, texts: list, hashes: WordHashes) -> np.ndarray:
    """One row of features per text; texts are pooled together up to PIECE characters, a longer one by itself."""
    ends = np.cumsum([len(t or "") for t in texts])
    rows, lo = [], 0
    while lo < len(texts):
        hi = max(int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + PIECE)), lo + 1)
        rows.append(words.pooled([hashes.of(tokens(t)) for t in texts[lo:hi]]))
        lo = hi
    return np.concatenate(rows) if rows else np.zeros((0, 2 * WIDTH + 2), np.float32)


class Network:
    """Two layers over standardised features, and a temperature."""

    def __init__(self, x: np.ndarray, y: np.ndarray, seed: int = 5):
        rng = np.random.default_rng(seed)
        self.prior = float(y.mean()) if len(y) else 0.5
        self.flat = len(np.unique(y)) < 2
        self.mean, self.scale, self.temperature = x.mean(0) if len(x) else 0.0, x.std(0) + 1e-3 if len(x) else 1.0, 1.0
        if self.flat:
            return
        order = rng.permutation(len(x))
        held, fit = order[: len(x) // 5], order[len(x) // 5 :]
        z = (x - self.mean) / self.scale
        self.w1, self.b1 = rng.normal(0, 1 / np.sqrt(z.shape[1]), (z.shape[1], HIDDEN)), np.zeros(HIDDEN)
        self.w2, self.b2 = rng.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN), 0.0
        state = [[np.zeros_like(p), np.zeros_like(p)] for p in self._parts()]
        for t in range(1, EPOCHS + 1):
            h = np.tanh(z[fit] @ self.w1 + self.b1)
            p = 1 / (1 + np.exp(-np.clip(h @ self.w2 + self.b2, -30, 30)))
            g = (p - y[fit]) / len(fit)
            gh = np.outer(g, self.w2) * (1 - h * h)
            grads = [z[fit].T @ gh + 1e-4 * self.w1, gh.sum(0), h.T @ g + 1e-4 * self.w2, g.sum()]
            new = []
            for part, grad, s in zip(self._parts(), grads, state, strict=True):
                s[0] = 0.9 * s[0] + 0.1 * grad
                s[1] = 0.999 * s[1] + 0.001 * grad * grad
                new.append(part - RATE * (s[0] / (1 - 0.9**t)) / (np.sqrt(s[1] / (1 - 0.999**t)) + 1e-8))
            self.w1, self.b1, self.w2, self.b2 = new
        if not len(held):
            return
        logit, target = self.logits(x[held]), y[held]
        grid = np.exp(np.linspace(np.log(0.5), np.log(8), 61))
        nll = [np.mean(np.logaddexp(0, logit / t) - target * logit / t) for t in grid]
        self.temperature = float(grid[int(np.argmin(nll))])

    def _parts(self):
        return [self.w1, self.b1, self.w2, np.asarray(self.b2, float)]

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.tanh((x - self.mean) / self.scale @ self.w1 + self.b1) @ self.w2 + self.b2

    def probability(self, x: np.ndarray) -> np.ndarray:
        if self.flat:
            return np.full(len(x), self.prior)
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -30, 30)))


def word_table(docs: DataFrame, bits: int = TABLE_BITS) -> tuple[np.ndarray, np.ndarray]:
    """Tokens at each place of the table, and the sum of the index vectors around them, over all documents."""
    places = 1 << bits

    def fill(batches):
        hashes = WordHashes()
        counts, sums = np.zeros(places, np.int64), np.zeros(places * WIDTH, np.int32)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                own = hashes.of(tokens(text))
                for lo in range(0, len(own), 50_000):
                    a = max(0, lo - REACH)  # a piece's first tokens meet the last ones before it
                    _add(own[a : lo + 50_000], lo - a, counts, sums)
        return [counts, sums]

    # sums beyond 2^24 are rounded to 24 bits
    counts, sums = summed_tables(docs.select("text"), fill, [places, places * WIDTH], kind=np.float32)
    return counts.astype(np.float64), sums.reshape(places, WIDTH)


def _add(own: np.ndarray, fresh: int, counts: np.ndarray, sums: np.ndarray) -> None:
    """Adds tokens from the ``fresh``-th on, and all pairs within reach whose later token is one of them."""
    at = table_places(own, len(counts))
    np.add.at(counts, at[fresh:], 1)
    entries = index_places(own)
    for k in range(1, REACH + 1):
        low = max(fresh - k, 0)  # pairs (i, i + k) with i + k >= fresh
        left, right = slice(low, len(own) - k), slice(low + k, len(own))
        if low + k >= len(own):
            continue
        for place, sign in entries:
            np.add.at(sums, at[right] * WIDTH + place[left], sign[left])
            np.add.at(sums, at[left] * WIDTH + place[right], sign[right])


def fit(docs: DataFrame, labels: DataFrame) -> tuple[WordVectors, Network]:
    """Fit on a bounded sample of the labelled rows: ``labels`` has doc_id and quality."""
    prepare(docs.sparkSession)
    known = labels.where("quality IS NOT NULL AND doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("_q_id")).agg(F.avg("quality").alias("_q"))
    ids = docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("h")).join(known, F.col("doc_id") == F.col("_q_id"))
    # equal texts are one example
    ids = cut_lineage(ids.groupBy("h").agg(F.avg("_q").alias("y"), F.min("doc_id").alias("_q_id")))
    share = min(1.0, SAMPLE / max(1, ids.count()))
    chosen = ids.where(F.pmod(F.xxhash64("h"), F.lit(1_000_003)) < int(share * 1_000_003) + 1)
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen.select("_q_id", "h", "y")), (F.col("doc_id") == F.col("_q_id")) & (F.xxhash64(F.coalesce("text", F.lit(""))) == F.col("h")))
    sample = cut_lineage(texts.select("text", "y", "h").dropDuplicates(["h"]))
    words = WordVectors(*word_table(docs))
    shared = docs.sparkSession.sparkContext.broadcast(words)

    def run(batches):
        hashes = WordHashes()
        for batch in batches:
            x = features(shared.value, batch.column(0).to_pylist(), hashes)
            yield pa.RecordBatch.from_arrays([batch.column(1), batch.column(2), pa.array([v.tobytes() for v in x], pa.binary())], names=["y", "h", "x"])
        give_back()

    rows = sample.mapInArrow(run, "y double, h long, x binary").orderBy("h").collect()
    shared.unpersist()
    x = np.frombuffer(b"".join(bytes(r["x"]) for r in rows), np.float32).reshape(len(rows), 2 * WIDTH + 2).astype(np.float64)
    network = Network(x, np.array([float(r["y"] >= 0.5) for r in rows]))
    del rows, x
    give_back()
    return words, network


def scored(docs: DataFrame, model: tuple[WordVectors, Network], keep: list[str], name: str = "score") -> DataFrame:
    """The columns in ``keep`` and a score (0 to 1, higher: better) of every row."""
    prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    read = docs.select(*keep) if "text" in keep else docs.select(*keep, "text")
    at = read.columns.index("text")
    schema = ", ".join(f"`{c}` {t}" for c, t in docs.select(*keep).dtypes) + f", `{name}` double"

    def run(batches):
        hashes = WordHashes()
        words, network = shared.value
        for batch in batches:
            score = network.probability(features(words, batch.column(at).to_pylist(), hashes))
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(keep))), pa.array(score, pa.float64())], names=[*keep, name])
        give_back()

    return read.mapInArrow(run, schema)


def is_held_out(doc_id: Column) -> Column:
    """True for rows whose labels are never learned from."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every row; labels of held-out rows are not read."""
    held = F.coalesce(is_held_out(F.col("doc_id")), F.lit(False))
    rows = scored(docs, fit(docs, labels.where(~held)), ["doc_id"])
    return rows.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def accepted(docs: DataFrame, labels: DataFrame, least: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that score ``least`` or more, unchanged."""
    held = F.coalesce(is_held_out(F.col("doc_id")), F.lit(False))
    name = "_q_score"
    while name in docs.columns:
        name += "_"
    return scored(docs, fit(docs, labels.where(~held)), docs.columns, name).where(F.col(name) >= least).select(*docs.columns)
