"""Embedding near-duplicates by product quantisation.

Coarse centroids split the unit vectors into inverted lists; the residual of
each vector is coded by sub-space.  A vector is a query in every list that can
hold a neighbour: a list is skipped only if the vector is further from the
plane between that list and its own than the link distance, so the probes are
sufficient, not sampled.  In a list, table lookups give the inner product with
each coded vector; its error is at most the stored length of the coding error,
so pairs below the threshold by more than that are dropped and all others are
compared exactly, in double precision.

Equal vectors are one class with a count and are not expanded into pairs.
Lists of any length are dealt in blocks of bounded size, and a block returns
link counts and a spanning forest of its links, never all pairs.

Codebooks are fitted on a bounded sample (``SAMPLE`` classes by hash); every
class is coded and searched.

Sufficient probes cost what the vectors demand: the more alike all distances
are, the more lists lie within reach (see the README for figures).

Cases: vectors that are null, of length zero or hold null or non-finite
components, and rows without label, link with nothing; vectors of different
length are not compared; vec_id may be any long, repeated or null (a null one
has no id to report, but its links count); repeated rows and ties are copies,
linked with one another; an empty table gives an empty result; vectors of any
length are compared whole; further columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import connected_components, cut_lineage, prepare

LINK = 0.93
SAMPLE, ROUNDS, SUBSPACES, CODES = 8192, 12, 8, 64
#: Vectors per list aimed at, and the least and most lists.
LIST_ROWS, LEAST_LISTS, MOST_LISTS = 8000, 4, 4096
BLOCK = 2048
#: Rows whose distances to all lists are held at a time.
ROWS_AT_ONCE = 512


def k_means(x: np.ndarray, k: int, rounds: int = ROUNDS, seed: int = 7) -> np.ndarray:
    """Centroids of the rows of x; empty clusters keep their place."""
    rng = np.random.default_rng(seed)
    c = x[rng.choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(rounds):
        near = np.argmin((c * c).sum(1) - 2 * x @ c.T, axis=1)
        sums = np.zeros_like(c)
        np.add.at(sums, near, x)
        n = np.bincount(near, minlength=len(c))
        c[n > 0] = sums[n > 0] / n[n > 0, None]
    return c


class Codec:
    """Coarse centroids and residual codebooks over vectors of one padded length."""

    def __init__(self, x: np.ndarray, lists: int):
        self.dim = x.shape[1]
        self.width = -(-self.dim // SUBSPACES)
        self.coarse = k_means(x, lists)
        square = (self.coarse**2).sum(1)
        self.gap = np.sqrt(np.maximum(square[:, None] + square - 2 * self.coarse @ self.coarse.T, 1e-30))
        rest = self._pad(x - self.coarse[self.nearest(x)])
        self.books = [k_means(rest[:, m * self.width : (m + 1) * self.width], CODES, seed=11 + m) for m in range(SUBSPACES)]

    def _pad(self, x: np.ndarray) -> np.ndarray:
        out = np.zeros((len(x), self.width * SUBSPACES))
        out[:, : x.shape[1]] = x
        return out

    def nearest(self, x: np.ndarray) -> np.ndarray:
        return np.argmin((self.coarse**2).sum(1) - 2 * x @ self.coarse.T, axis=1)

    def probes(self, x: np.ndarray, home: np.ndarray, reach: float) -> np.ndarray:
        """Boolean (row, list): lists that can hold a vector within ``reach`` of the row."""
        d = (x * x).sum(1)[:, None] - 2 * x @ self.coarse.T + (self.coarse**2).sum(1)
        out = (d - d[np.arange(len(x)), home][:, None]) / (2 * self.gap[home]) <= reach + 1e-6
        out[np.arange(len(x)), home] = True
        return out

    def code(self, x: np.ndarray, home: int) -> tuple[np.ndarray, np.ndarray]:
        """Codes of the rows of a list, and the length of each coding error."""
        rest = self._pad(x - self.coarse[home])
        codes, error = np.empty((len(x), SUBSPACES), np.uint8), np.zeros(len(x))
        for m, book in enumerate(self.books):
            part = rest[:, m * self.width : (m + 1) * self.width]
            codes[:, m] = near = np.argmin((book * book).sum(1) - 2 * part @ book.T, axis=1)
            error += ((part - book[near]) ** 2).sum(1)
        return codes, np.sqrt(error)

    def estimates(self, q: np.ndarray, codes: np.ndarray, home: int) -> np.ndarray:
        """Inner products of queries with coded vectors by table lookup."""
        out = np.repeat((q @ self.coarse[home])[:, None], len(codes), axis=1).astype(np.float32)
        padded = self._pad(q)
        for m, book in enumerate(self.books):
            table = (padded[:, m * self.width : (m + 1) * self.width] @ book.T).astype(np.float32)
            out += table[:, codes[:, m]]
        return out


def in_range(x: np.ndarray) -> np.ndarray:
    """Rows (none of zeros) divided by powers of two so that their greatest component is near one: squares neither over- nor underflow, and nothing is rounded."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(1, initial=0.0))[1][:, None])


def labels_of(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Least node of each node's component over links a-b among n nodes."""
    label = np.arange(n)
    while True:
        m = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, m)
        np.minimum.at(new, b, m)
        new = new[new]
        if np.array_equal(new, label):
            return label
        label = new


def _block(table: pa.Table, codec: Codec, link: float) -> pa.Table:
    """Link counts and a forest for the queries and stored vectors of one block."""
    role = table.column("stored").to_numpy()
    node, copies = table.column("node").to_numpy(), table.column("copies").to_numpy()
    flat = table.column("embedding").combine_chunks()
    size = table.column("size")[0].as_py()
    x = np.zeros((len(node), codec.dim))
    x[:, :size] = flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(node), size)
    x = in_range(x)
    norm = np.sqrt((x * x).sum(1))
    unit = x / norm[:, None]
    s, q = np.flatnonzero(role), np.flatnonzero(~role)
    out_node, out_links, out_a, out_b = [], [], [], []
    if len(s) and len(q):
        cell = table.column("cell")[0].as_py()
        codes, error = codec.code(unit[s], cell)
        forest_a, forest_b = np.empty(0, np.int64), np.empty(0, np.int64)
        _, index = np.unique(node, return_inverse=True)
        for at in range(0, len(q), 256):
            rows = q[at : at + 256]
            near = codec.estimates(unit[rows], codes, cell) >= (link - error - 1e-4)[None, :]
            i, j = np.nonzero(near)
            i, j = rows[i], s[j]
            keep = node[i] != node[j]
            i, j = i[keep], j[keep]
            exact = np.empty(len(i), bool)
            for k in range(0, len(i), 65536):
                a, b = i[k : k + 65536], j[k : k + 65536]
                exact[k : k + 65536] = np.einsum("ij,ij->i", x[a], x[b]) / (norm[a] * norm[b]) >= link
            i, j = i[exact], j[exact]
            links = np.bincount(i, weights=copies[j], minlength=len(node))[rows].astype(np.int64)
            found = links > 0
            out_node.append(node[rows][found])
            out_links.append(links[found])
            if len(i):
                label = labels_of(np.concatenate([forest_a, index[i]]), np.concatenate([forest_b, index[j]]), index.max() + 1)
                forest_a = np.flatnonzero(label != np.arange(len(label)))
                forest_b = label[forest_a]
        names = np.unique(node)
        out_a, out_b = names[forest_a], names[forest_b]
    a = np.concatenate([*out_node, out_a]) if len(out_node) or len(out_a) else np.empty(0, np.int64)
    n_links = np.concatenate([*out_links, np.zeros(len(out_a), np.int64)]) if len(out_node) or len(out_a) else np.empty(0, np.int64)
    b = np.concatenate([np.full(len(a) - len(out_b), -1, np.int64), np.asarray(out_b, np.int64)])
    is_edge = np.arange(len(a)) >= len(a) - len(out_b)
    return pa.table({"a": pa.array(a.astype(np.int64)), "b": pa.array(b), "links": pa.array(n_links.astype(np.int64)), "is_edge": pa.array(is_edge)})


def near_duplicates(vectors: DataFrame, link: float = LINK) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row."""
    spark = vectors.sparkSession
    prepare(spark)
    e = F.col("embedding")
    fine = e.isNotNull() & F.col("label").isNotNull() & F.forall(e, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))) & F.exists(e, lambda v: v != 0)
    key = [F.xxhash64("embedding").alias("h1"), F.xxhash64(F.lit(1), "embedding").alias("h2")]
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"), F.when(fine, e).alias("embedding"), F.coalesce(fine, F.lit(False)).alias("fine")).select("*", *key)
    classes = rows.where("fine").groupBy("label", "h1", "h2").agg(F.min("vec_id").alias("least"), F.count("*").alias("copies"), F.any_value("embedding").alias("embedding"))
    # numbers are given once and read from the checkpoint
    classes = cut_lineage(classes.withColumns({"size": F.size("embedding"), "node": F.monotonically_increasing_id()}))
    total, dim = classes.agg(F.count("*"), F.max("size")).first()
    single = rows.select("vec_id", F.when(F.col("fine"), F.col("label")).alias("label"), "h1", "h2")
    if not total:
        return single.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    share = min(1.0, SAMPLE / total)
    picked = classes.where(F.pmod("h1", F.lit(1_000_003)) < int(share * 1_000_003) + 1).select("h1", "embedding").orderBy("h1").limit(2 * SAMPLE).collect()
    sample = np.zeros((len(picked), dim))
    for i, r in enumerate(picked):
        sample[i, : len(r["embedding"])] = r["embedding"]
    sample = in_range(sample)
    sample /= np.sqrt((sample**2).sum(1))[:, None]
    shared = spark.sparkContext.broadcast(Codec(sample, int(min(MOST_LISTS, max(LEAST_LISTS, total // LIST_ROWS), len(sample)))))
    reach = float(np.sqrt(2 - 2 * link))

    def deal(batches):
        codec = shared.value
        for batch in batches:
            emb = batch.column(batch.schema.get_field_index("embedding"))
            x = np.zeros((batch.num_rows, codec.dim))
            for i, v in enumerate(emb.to_pylist()):
                x[i, : len(v)] = v
            x = in_range(x)
            x /= np.sqrt((x * x).sum(1))[:, None]
            for low in range(0, len(x), ROWS_AT_ONCE):
                piece = x[low : low + ROWS_AT_ONCE]
                home = codec.nearest(piece)
                row, cell = np.nonzero(codec.probes(piece, home, reach))
                for at in range(0, len(row), 4096):
                    r, c = row[at : at + 4096], cell[at : at + 4096]
                    part = batch.take(pa.array(low + r))
                    yield pa.RecordBatch.from_arrays([*part.columns, pa.array(c.astype(np.int32)), pa.array(c == home[r])], names=[*batch.schema.names, "cell", "home"])

    cols = classes.select("label", "size", "node", "copies", "embedding")
    kind = dict(vectors.dtypes)["embedding"]
    schema = f"label string, size int, node long, copies long, embedding {kind}, cell int, home boolean"
    dealt = cut_lineage(cols.mapInArrow(deal, schema))
    group = ["label", "size", "cell"]
    counts = dealt.groupBy(*group).agg(F.sum(F.col("home").cast("long")).alias("s"), F.count("*").alias("q"))
    blocks = lambda n: F.greatest(F.lit(1), F.ceil(F.col(n) / BLOCK)).cast("int")
    counts = counts.where("s > 0").select(*group, blocks("s").alias("sb"), blocks("q").alias("qb"))
    dealt = dealt.join(counts, group)
    own = lambda n: F.pmod(F.xxhash64("node"), F.col(n)).cast("int")
    up_to = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    base = [*group, "node", "copies", "embedding"]
    queries = dealt.select(*base, F.lit(False).alias("stored"), own("qb").alias("i"), up_to("sb").alias("j"))
    stored = dealt.where("home").select(*base, F.lit(True).alias("stored"), up_to("qb").alias("i"), own("sb").alias("j"))
    found = cut_lineage(queries.union(stored).groupBy(*group, "i", "j").applyInArrow(lambda t: _block(t, shared.value, link), "a long, b long, links long, is_edge boolean"))
    comp = connected_components(found.where("is_edge").select("a", "b"))
    links = found.where("NOT is_edge").groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    named = classes.select("label", "h1", "h2", "node", "least", "copies").join(links, "node", "left").join(comp, "node", "left").withColumn("c", F.coalesce("component", "node"))
    named = named.join(named.groupBy("c").agg(F.min("least").alias("component_id")), "c")
    named = named.select("label", "h1", "h2", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id", F.lit(True).alias("compared"))
    out = single.join(named, ["label", "h1", "h2"], "left")
    out = out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.when(F.col("compared"), F.col("component_id")).otherwise(F.col("vec_id")).alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.col("component_id").isNull()))
