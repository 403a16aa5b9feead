"""N-gram Jaccard self-join with adaptive multi-match prefixes.

A document is the set of its distinct word n-grams (64-bit hashes).  Documents
with equal sets form one class; the join runs over classes.  All sets are
ordered alike, rare n-grams first, by a fixed-size count sketch of the whole
corpus (its counts set the order and nothing else, so its size is a matter of
speed).  If two sets of x and y n-grams reach the threshold, their prefixes of
``x - least overlap + l`` and ``y - least overlap + l`` n-grams share at least
``l``.  Each document takes the ``l`` from 1 to ``MOST_MATCHES`` of least
estimated cost: tokens to index plus candidates to verify, both from the
sketch.  A pair is compared at the smaller ``l`` of the two and verified on
whole sets only if that many prefix n-grams are shared, and their parity bits
(a lower bound on how far two sets differ) allow it.

Copies in great numbers are not expanded into pairs.  First every prefix
token's documents are checked against one of them (a star), and what is linked
becomes one component; the exact join then runs across components only.  So
the operator gives components, not all links inside of them.

Cases: null, empty and blank texts have an empty set and link with nothing;
shorter texts are one n-gram; repeated rows and equal texts are one class, and
so are ties; different texts under one doc_id are rows of their own; doc_id may
be any long or null (a component all of whose ids are null has a null id);
texts of any length are read whole; an empty table gives an empty result;
further columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WordHashes, connected_components, cut_lineage, give_back, lower_words, prepare, summed_tables, window_hashes

#: Counters in the order-giving sketch (4 bytes each).
SKETCH_BITS = 20
MOST_MATCHES = 4
#: Bits of the difference filter that goes along with candidates; sets of LONG or more n-grams have eight times as many.
PARITY, LONG = 512, 2000
#: Cost of verifying one candidate, in index entries.
VERIFY_COST = 8.0
#: Up to so many classes to verify (about 50 bytes each) are broadcast to the texts; more are joined by key.
MOST_BROADCAST = 400_000
#: A set that more than this many pairs name is dealt to several tasks.
PAIRS_A_SALT = 64
#: Documents of a prefix token that are paired in one group; a token with more of them is dealt to blocks of pairs.
TOKEN_BLOCK = 2_000


def sorted_set(text: str | None, size: int, hashes: WordHashes) -> np.ndarray:
    """Distinct n-gram hashes of a text, ascending."""
    return np.unique(window_hashes(hashes.of(lower_words(text)), size))


def least_overlap(n: int, percent: int) -> int:
    """Fewest n-grams that a set of n shares with any set within the threshold."""
    return -(-percent * n // 100)


def parity_bits(grams: np.ndarray) -> np.ndarray:
    """Bits (as longs) that say whether an odd number of n-grams falls on each place; more places for long texts.

    Two sets differ in at least as many n-grams as their bits differ.
    """
    places = PARITY if len(grams) < LONG else 8 * PARITY
    odd = np.bincount(((grams >> np.uint64(20)) & np.uint64(places - 1)).astype(np.int64), minlength=places) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def may_reach(x_n, y_n, x_parity, y_parity, percent: int):
    """False only for sets that differ in more n-grams than the threshold allows, judged by their sizes and parity bits."""
    differ = F.aggregate(F.zip_with(x_parity, y_parity, lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda a, b: a + b)
    apart = F.when(F.size(x_parity) == F.size(y_parity), differ).otherwise(0)
    return (F.least(x_n, y_n) * 100 >= F.greatest(x_n, y_n) * percent) & (apart * (100 + percent) <= (x_n + y_n) * (100 - percent))


def text_key() -> Column:
    return F.xxhash64(F.coalesce("text", F.lit("")))


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key().alias("text_key"), "text")


def count_sketch(rows: DataFrame, size: int) -> np.ndarray:
    """Counts of n-grams by the low bits of their hash, over all rows; a fixed number of counters."""

    def fill(batches):
        hashes, total = WordHashes(), np.zeros(1 << SKETCH_BITS, np.int64)
        mask = np.uint64((1 << SKETCH_BITS) - 1)
        for batch in batches:
            found = [sorted_set(t, size, hashes) for t in batch.column(0).to_pylist()]
            if found:
                total += np.bincount((np.concatenate(found) & mask).astype(np.int64), minlength=len(total))
        return [total]

    return summed_tables(rows.select("text"), fill, [1 << SKETCH_BITS])[0].astype(np.float32)


def prefix(grams: np.ndarray, counts: np.ndarray, noise: float, percent: int) -> tuple[int, np.ndarray]:
    """(l, ordered prefix for it) of a non-empty set."""
    n = len(grams)
    least = least_overlap(n, percent)
    seen = counts[(grams & np.uint64(len(counts) - 1)).astype(np.int64)].astype(np.float64)
    most = min(MOST_MATCHES, least)
    longest = n - least + most
    if longest < n:
        at = np.argpartition(seen, longest - 1)
        edge = seen[at[longest - 1]]
        at = np.flatnonzero(seen <= edge)
    else:
        at = np.arange(n)
    at = at[np.lexsort((grams[at], seen[at]))][:longest]
    cost = np.cumsum(np.maximum(seen[at] - noise, 0.0))
    matches = np.arange(1, most + 1)
    upto = cost[n - least + matches - 1]
    chosen = int(np.argmin(n - least + matches + VERIFY_COST * upto / matches**2)) + 1
    return chosen, grams[at[: n - least + chosen]]


def signatures(rows: DataFrame, counts: np.ndarray, size: int, percent: int) -> DataFrame:
    """(doc_id, text_key, n, f1, f2, l, prefix, parity): the set's size and 128-bit fingerprint, its prefix and parity bits."""
    shared = rows.sparkSession.sparkContext.broadcast((counts, float(np.median(counts))))
    schema = "doc_id long, text_key long, n long, f1 long, f2 long, l int, prefix array<long>, parity array<long>"
    names = ["doc_id", "text_key", "n", "f1", "f2", "l", "prefix", "parity"]

    def sign(batches):
        hashes = WordHashes()
        table, noise = shared.value
        odd = np.uint64(0x9E3779B97F4A7C15)
        for batch in batches:
            n, f1, f2, ls, prefixes, parity = [], [], [], [], [], []
            for text in batch.column(2).to_pylist():
                grams = sorted_set(text, size, hashes)
                n.append(len(grams))
                with np.errstate(over="ignore"):
                    f1.append(int(np.bitwise_xor.reduce(grams, initial=0).astype(np.int64)))
                    f2.append(int(np.add.reduce(grams * odd ^ (grams >> np.uint64(29)), dtype=np.uint64, initial=0).astype(np.int64)))
                l, p = prefix(grams, table, noise, percent) if len(grams) else (0, grams)
                ls.append(l)
                parity.append(parity_bits(grams))
                prefixes.append(p.view(np.int64))
            flat = np.concatenate(prefixes) if prefixes else np.empty(0, np.int64)
            offsets = np.concatenate([[0], np.cumsum([len(p) for p in prefixes])]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n, pa.int64()), pa.array(f1, pa.int64()), pa.array(f2, pa.int64()), pa.array(ls, pa.int32()), lists, pa.array(parity, pa.list_(pa.int64()))], names=names)
        give_back()

    return rows.mapInArrow(sign, schema)


def _small(table: DataFrame) -> DataFrame:
    """A checkpointed table, broadcast where it has few rows."""
    return F.broadcast(table) if table.count() <= MOST_BROADCAST else table


def with_ends(pairs: DataFrame, table: DataFrame) -> DataFrame:
    """The pairs (a, b) with the columns of ``table`` (by node) for both ends, as x_... and y_....

    A node that many pairs name is laid out once for every PAIRS_A_SALT of them.
    """
    n = pairs.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count("*").alias("n"))
    salts = _small(cut_lineage(n.where(F.col("n") > PAIRS_A_SALT).select("node", F.ceil(F.col("n") / PAIRS_A_SALT).cast("int").alias("salts"))))
    columns = [c for c in table.columns if c != "node"]
    laid = table.join(salts, "node", "left").withColumn("salt", F.explode(F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)) - 1)))
    for end, other, mark in (("a", "b", "x"), ("b", "a", "y")):
        dealt = pairs.join(salts.toDF(end, "salts"), end, "left").withColumn("salt", F.pmod(F.xxhash64(other), F.coalesce("salts", F.lit(1))).cast("int")).drop("salts")
        side = laid.select(F.col("node").alias(end), "salt", *[F.col(c).alias(f"{mark}_{c}") for c in columns])
        pairs = dealt.join(side, [end, "salt"]).drop("salt")
    return pairs


def verified(pairs: DataFrame, classes: DataFrame, rows: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs (a, b) of classes whose whole sets reach the threshold.

    Sets are made only for the rows that stand for a class of some pair.
    """
    prepare(rows.sparkSession)
    ends = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    need = cut_lineage(ends.join(classes.select("node", "text_key", F.col("doc_id").alias("rep_id")), "node"))
    found = rows.join(_small(need), "text_key").where(F.col("doc_id").eqNullSafe(F.col("rep_id"))).select("node", "text")

    def sets(batches):
        hashes, seen = WordHashes(), set()
        for batch in batches:
            fresh = []
            for i, node in enumerate(batch.column(0).to_pylist()):
                if node not in seen:  # a row that stands for its class may be repeated
                    seen.add(node)
                    fresh.append(i)
            part = batch.take(pa.array(fresh, pa.int64()))
            grams = [sorted_set(t, size, hashes).tobytes() for t in part.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(grams, pa.binary())], names=["node", "grams"])
        give_back()

    both = with_ends(pairs, found.mapInArrow(sets, "node long, grams binary"))

    def compare(batches):
        for batch in batches:
            good = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                same = len(x) + len(y) - len(np.union1d(x, y)) if len(x) and len(y) else 0
                good.append(100 * same >= percent * (len(x) + len(y) - same) and same > 0)
            kept = batch.filter(pa.array(good, pa.bool_()))
            yield pa.RecordBatch.from_arrays([kept.column(0), kept.column(1)], names=["a", "b"])

    return both.select("a", "b", "x_grams", "y_grams").mapInArrow(compare, "a long, b long").distinct()


def linked(docs: DataFrame, size: int = 3, percent: int = 90) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows, classes, components) of the join.

    rows: doc_id, text_key, n, f1 and f2 of every row; classes: f1, f2, n,
    node (a number), and doc_id and text_key of the row that stands for it
    (the least doc_id, null last); components: node and component of every
    node with a link.
    """
    prepare(docs.sparkSession)
    rows = _rows(docs)
    signed = cut_lineage(signatures(rows, count_sketch(rows, size), size, percent))
    rep = F.min(F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "text_key")).alias("rep")
    classes = signed.where("n > 0").groupBy("f1", "f2", "n").agg(rep, *[F.first(c).alias(c) for c in ("l", "prefix", "parity")])
    # numbers are given once and read from the checkpoint
    classes = cut_lineage(classes.select("f1", "f2", "n", "rep.doc_id", "rep.text_key", "l", "prefix", "parity", F.monotonically_increasing_id().alias("node")))
    lead = F.col("n") - F.expr(f"(n * {percent} + 99) div 100")
    # the first lead + 1 tokens of a prefix belong to l = 1, then one more to each further l
    tokens = classes.select("node", "n", "l", lead.alias("lead"), F.posexplode("prefix").alias("pos", "token"))
    at = F.greatest(F.lit(1), F.col("pos") - F.col("lead") + 1)
    tokens = tokens.select("token", "node", ((F.col("n") * 8 + F.col("l")) * 8 + at).alias("packed"))
    shared = tokens.groupBy("token").agg(F.count("*").alias("c")).where("c > 1").select("token")
    tokens = tokens.join(shared, "token").select("token", "node", F.expr("packed div 64").alias("n"), F.expr("CAST(packed div 8 % 8 AS INT)").alias("l"), F.expr("CAST(packed % 8 AS INT)").alias("at"))
    tokens = cut_lineage(tokens)
    bits = classes.select("node", "n", "parity")
    fits = lambda x, y: (F.least(x, y) * 100 >= F.greatest(x, y) * percent)
    # a token's hub: the document with most common n-grams in its prefix, which is nearest to what its copies share
    central = tokens.groupBy("node").agg(F.count("*").alias("shared"))
    hubs = tokens.join(central, "node").groupBy("token").agg(F.max(F.struct("shared", F.col("node").alias("hub"), F.col("n").alias("hub_n"))).alias("h")).select("token", "h.hub", "h.hub_n")
    star = tokens.join(hubs, "token").where((F.col("node") != F.col("hub")) & fits(F.col("n"), F.col("hub_n")))
    star = star.groupBy(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b"), "node").agg(F.count("*").alias("m")).where("m > 1")
    # one hub for each document: this round only has to join most copies, the next one is exact
    star = star.groupBy("node").agg(F.max_by(F.struct("a", "b"), F.struct("m", "a", "b")).alias("p")).select("p.a", "p.b").distinct()
    star = with_ends(cut_lineage(star), bits)
    star = star.where(may_reach(F.col("x_n"), F.col("y_n"), F.col("x_parity"), F.col("y_parity"), percent))
    star = cut_lineage(star.select("a", "b").distinct())
    links = cut_lineage(verified(star, classes, rows, size, percent))
    comp = connected_components(links)
    tokens = tokens.join(comp, "node", "left").withColumn("c", F.coalesce("component", "node")).drop("component")
    blocks = F.ceil(F.count("*") / TOKEN_BLOCK).cast("int")
    mixed = tokens.groupBy("token").agg(F.min("c").alias("lo"), F.max("c").alias("hi"), blocks.alias("blocks")).where("lo <> hi").select("token", "blocks")
    tokens = cut_lineage(tokens.join(mixed, "token").join(bits, ["node", "n"]))
    side = lambda t, mark, *more: t.select("token", *more, *[F.col(c).alias(f"{mark}_{c}") for c in ("node", "n", "l", "at", "c", "parity")])
    matches = F.least("x_l", "y_l")

    def met(x: DataFrame, y: DataFrame, keys: list[str]) -> DataFrame:
        both = x.join(y, [x[k] == y[k] for k in keys] + [(F.col("x_c") < F.col("y_c")) & may_reach(F.col("x_n"), F.col("y_n"), F.col("x_parity"), F.col("y_parity"), percent) & (F.col("x_at") <= matches) & (F.col("y_at") <= matches)])
        return both.select("x_node", "y_node", "x_n", "y_n", "x_l", "y_l")

    usual, crowded = tokens.where("blocks = 1"), tokens.where("blocks > 1")
    across = met(side(usual, "x"), side(usual, "y"), ["token"])
    if crowded.limit(1).count():
        # every pair of a token's blocks is a group of its own
        own, every = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
        across = across.union(met(side(crowded, "x", own.alias("i"), every.alias("j")), side(crowded, "y", own.alias("j"), every.alias("i")), ["token", "i", "j"]))
    across = across.select("x_node", "y_node", "x_n", "y_n", matches.alias("l")).groupBy("x_node", "y_node", "x_n", "y_n", "l").agg(F.count("*").alias("m")).where("m >= l")
    across = across.select(F.least("x_node", "y_node").alias("a"), F.greatest("x_node", "y_node").alias("b")).distinct()
    across = cut_lineage(across.join(star, ["a", "b"], "left_anti"))
    links = links.union(verified(across, classes, rows, size, percent))
    return signed.select("doc_id", "text_key", "n", "f1", "f2"), classes.select("f1", "f2", "n", "node", "doc_id", "text_key"), connected_components(links)


def components(docs: DataFrame, size: int = 3, percent: int = 90) -> DataFrame:
    """doc_id, n_shingles and component_id of every row: the least doc_id reachable by links, or the row's own."""
    rows, classes, comp = linked(docs, size, percent)
    named = classes.select("f1", "f2", "n", "node", "doc_id").join(comp, "node", "left").withColumn("c", F.coalesce("component", "node"))
    least = named.groupBy("c").agg(F.min("doc_id").alias("component_id"))
    named = named.join(least, "c").select("f1", "f2", "n", "component_id")
    out = rows.join(named, ["f1", "f2", "n"], "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def one_each(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs``, one of each group of linked documents: the one with the least doc_id (null last).

    Rows that repeat that doc_id and text are one document; one of them stays.
    Documents without any words are linked with nothing and all stay.
    """
    _, classes, comp = linked(docs, size, percent)
    named = classes.join(comp, "node", "left").withColumn("c", F.coalesce("component", "node"))
    chosen = named.groupBy("c").agg(F.min(F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "text_key")).alias("r")).select("r.text_key", F.col("r.doc_id").alias("rep_id"))
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col("doc_id").cast("long").alias("id"), text_key().alias("text_key"), F.coalesce(F.col("text").rlike("[^\\x20\\x09-\\x0D]"), F.lit(False)).alias("full"))
    kept = rows.where("full").join(chosen, "text_key").where(F.col("id").eqNullSafe(F.col("rep_id"))).dropDuplicates(["id", "text_key"])
    return kept.select("row.*").unionByName(rows.where("NOT full").select("row.*"))
