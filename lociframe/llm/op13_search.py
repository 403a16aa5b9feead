"""Ranked lexical search, reversed: documents stream past an index over the items.

Items (queries) are few, documents many.  The items' terms make an inverted
index (term -> items with the term's number of occurrences), which is
broadcast.  A first pass over all documents counts, for each indexed term, the
documents that hold it, and the totals of documents and terms; a second one
sends each document's term counts through the index, adds up the document's
score for every item that it shares a term with, and keeps each item's best
documents in a bounded heap per partition.  Heaps are merged in three levels,
so no task gathers more than FAN_IN heaps of an item at a time (up to FAN_IN^3
partitions).

The index is cut into blocks of about BLOCK postings (item, term), each with
passes of its own; only a block is on the driver or broadcast at a time, and a
block's size is counted as it is filled.  An item with more distinct terms than
that is a block of its own.

All scores are 64-bit integers but for the logarithm in a term's weight, so
they don't depend on how documents are dealt to tasks.

Cases: null and blank texts have no terms, and such documents are not counted
and never found; an item without terms finds nothing; equal rows of ``items``
are one item, different texts under one item_id are ranked each for itself;
repeated documents are ranked each for itself; equal scores go by ascending
doc_id, null last; texts of any length are read whole; empty tables give an
empty result; further columns are not read.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from .common import FAN_IN, cut_lineage, give_back, prepare, summed_tables

BEST = 20
#: Postings in a block of the index (about 100 bytes each with the term).
BLOCK = 500_000
#: ASCII letters lower-cased, digits and what is beyond ASCII as they are, all else a blank.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def terms(text: str | None) -> list[bytes]:
    return text.encode().translate(FOLD).split() if text else []


class Index:
    """Items of a block, their distinct terms, and for each term the items that hold it and how often."""

    def __init__(self, items: list[tuple]):
        held = [Counter(terms(text)) for _, text in items]
        self.ids = [i for i, _ in items]
        self.terms = {t: k for k, t in enumerate(sorted(set().union(*held)))}
        at = np.array([self.terms[t] for c in held for t in c], np.int64)
        of = np.repeat(np.arange(len(items)), [len(c) for c in held])
        times = np.array([n for c in held for n in c.values()], np.int64)
        order = np.argsort(at, kind="stable")
        self.items, self.times = of[order], times[order]
        self.start = np.searchsorted(at[order], np.arange(len(self.terms) + 1))

    def counts(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Indexed terms of a document, and how often it holds them."""
        found = Counter(map(self.terms.get, words))
        found.pop(None, None)
        return np.fromiter(found.keys(), np.int64, len(found)), np.fromiter(found.values(), np.int64, len(found))

    def scores(self, at: np.ndarray, parts: np.ndarray) -> np.ndarray:
        """Each item's score, from what each of the document's terms adds per occurrence in the item."""
        first, n = self.start[at], self.start[at + 1] - self.start[at]
        place = np.arange(n.sum()) + np.repeat(first - np.concatenate([[0], np.cumsum(n)[:-1]]), n)
        out = np.zeros(len(self.ids), np.int64)
        np.add.at(out, self.items[place], self.times[place] * np.repeat(parts, n))
        return out


def blocks(items: DataFrame, most: int) -> Iterator[Index]:
    """The index in blocks; items are read from the cluster one partition at a time."""
    held, postings = [], 0
    for row in items.select("item_id", "text").distinct().toLocalIterator():
        n = len(set(terms(row["text"])))
        if held and postings + n > most:
            yield Index(held)
            held, postings = [], 0
        if n:
            held.append((row["item_id"], row["text"]))
            postings += n
    if held:
        yield Index(held)


def statistics(docs: DataFrame, shared) -> tuple[int, int, np.ndarray]:
    """Documents with a term, all their terms, and the documents that hold each indexed term."""

    def fill(batches):
        index = shared.value
        totals, df = np.zeros(2, np.int64), np.zeros(len(index.terms), np.int64)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                if words := terms(text):
                    totals += (1, len(words))
                    df[index.counts(words)[0]] += 1
        return [totals, df]

    totals, df = summed_tables(docs.select("text"), fill, [2, len(shared.value.terms)])
    return int(totals[0]), int(totals[1]), df


def weights(n_docs: int, df: np.ndarray) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)


def _heaps(docs: DataFrame, shared, n_docs: int, n_terms: int, weight, best: int) -> DataFrame:
    """(item, score, doc_id, part): each partition's best documents of each item."""

    def run(batches):
        index, w = shared.value, weight.value
        # least score first, of equal ones the greatest id, null before all
        heaps: list[list[tuple]] = [[] for _ in index.ids]
        least = np.ones(len(heaps), np.int64)
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = terms(text)
                at, tf = index.counts(words)
                if not len(at):
                    continue
                m = 75 + (25 * len(words) * n_docs) // n_terms
                scores = index.scores(at, w[at] * ((1_000_000_000 * tf) // (1000 * tf + 12 * m)))
                mine = (doc_id is not None, -(doc_id or 0))
                for item in np.flatnonzero(scores >= least).tolist():
                    entry = (int(scores[item]), *mine)
                    if len(heaps[item]) < best:
                        heapq.heappush(heaps[item], entry)
                    else:
                        heapq.heappushpop(heaps[item], entry)
                    if len(heaps[item]) == best:
                        least[item] = heaps[item][0][0]
        rows = [(i, score, -less if known else None) for i, heap in enumerate(heaps) for score, known, less in heap]
        part = TaskContext.get().partitionId()
        columns = [pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.int32(), pa.int64(), pa.int64()))]
        yield pa.RecordBatch.from_arrays([*columns, pa.array([part] * len(rows), pa.int32())], names=["item", "score", "doc_id", "part"])
        give_back()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "item int, score long, doc_id long, part int")


def _merged(heaps: DataFrame, best: int) -> DataFrame:
    """(item, score, doc_id, rank): the best over all partitions."""
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    for share in (FAN_IN, FAN_IN * FAN_IN):
        near = Window.partitionBy("item", F.floor(F.col("part") / share)).orderBy(*order)
        heaps = heaps.withColumn("rank", F.row_number().over(near)).where(F.col("rank") <= best)
    return heaps.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).where(F.col("rank") <= best).drop("part")


def search(docs: DataFrame, items: DataFrame, best: int = BEST, block: int = BLOCK) -> DataFrame:
    """item_id, rank (from 1), doc_id and score of the ``best`` documents of each item with a score above 0."""
    spark = docs.sparkSession
    prepare(spark)
    item_type = dict(items.dtypes)["item_id"]
    schema = f"item_id {item_type}, rank int, doc_id long, score long"
    out, last = None, None
    for index in blocks(items, block):
        if last is not None:  # earlier blocks are done and leave memory before the next is used
            out = cut_lineage(last) if out is None else out.union(cut_lineage(last))
        shared = spark.sparkContext.broadcast(index)
        n_docs, n_terms, df = statistics(docs, shared)
        weight = spark.sparkContext.broadcast(weights(n_docs, df))
        names = spark.createDataFrame(list(enumerate(index.ids)), f"item int, item_id {item_type}")
        last = _merged(_heaps(docs, shared, n_docs, n_terms, weight, best), best).join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")
    if last is None:
        return spark.createDataFrame([], schema)
    return last if out is None else out.union(last)
