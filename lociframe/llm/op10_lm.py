"""Cross-entropy difference under matched n-gram language models.

A target and a background bigram model are matched: one vocabulary of V words
(all that occur), one order, and the same shares of pair, word and uniform
probability whatever their sizes,
``p(w | v) = B * c(v, w) / c(v) + (1 - B) * ((1 - U) * c(w) / N + U / V)``,
the latter part alone after a context not seen.  A document is scored by what
the other documents say: its own counts are left out of each model that it is
part of.  The score is the mean over its words of the target's loss minus the
background's (in nats): below zero means closer to the target.

Counts cover every word of every document and keep every key (64-bit hashes),
so the tables grow with the corpus.  Documents are dealt to chunks of about
CHUNK_BYTES of text by hash of id and text; a chunk sends its distinct keys
with their counts to buckets by key, a bucket sums them over all chunks and
answers each chunk in the chunk's own order, and the chunk scores its
documents.  Numbers of chunks and buckets grow with the text.  A chunk writes a
row only for a bucket that holds some of its keys, so it writes no more rows
than it has distinct keys, however many buckets there are.  The totals (words
of either model, distinct words) are one row, broadcast.

Rows of one id and text that occur MANY_COPIES times or more are counted first
and are one row with a weight; what they score is laid out again at the end.

Cases: null and blank texts have no words and score 0; a target or background
without other documents leaves uniform models; repeated rows are documents of
their own and count as often as they occur, so each is known from the others;
ties have equal scores; an empty table gives an empty result; further columns
are not read; texts of any length are read whole.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WordHashes, cut_lineage, give_back, lower_words, mix, prepare

#: Shares of the pair probability, and of the uniform one in what remains.
BLEND, UNIFORM = 0.7, 0.02
START = np.uint64(0x51ED270B153A1D47)
#: Text of a chunk on average; a bucket holds the keys of twice that.
CHUNK_BYTES = 8 << 20
LEAST_CHUNKS = 8
#: Counts kept for each key of kind 0 (words and contexts) and 1 (pairs): of which keys of a word, in all documents or the target's.
TABLES = (((0, False), (0, True), (1, False), (1, True)), ((2, False), (2, True)))
COUNTED = "chunk long, bucket int, kind int, n int, keys binary, counts binary, target_words long, all_words long"
ANSWERED = "chunk long, bucket int, kind int, n int, counts binary"
_COUNTED = [("chunk", pa.int64()), ("bucket", pa.int32()), ("kind", pa.int32()), ("n", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary()), ("target_words", pa.int64()), ("all_words", pa.int64())]
_ANSWERED = [(name, kind) for name, kind in _COUNTED if name in ANSWERED]
TOTALS = ("target_words", "all_words", "vocabulary")
#: Rows of one id and text from so many on are counted before they are dealt; up to MOST_BROADCAST such texts are broadcast to the rows, more are joined by key.
MANY_COPIES, MOST_BROADCAST = 64, 100_000
#: Up to so many ids of the target (about 20 bytes each) are broadcast to the rows; more are joined by key.
MOST_IDS = 1_000_000
RUN = 10_000


def indices(text: str | None, hashes: WordHashes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys (64-bit hashes) of each word, of the word before it and of the pair."""
    w = hashes.of(lower_words(text))
    if not len(w):
        return (np.empty(0, np.uint64),) * 3
    before = np.concatenate([[START], w[:-1]])
    with np.errstate(over="ignore"):
        pair = mix(before * np.uint64(0x9E3779B97F4A7C15) + w)
    return w, before, pair


def _read(texts: list) -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray]]:
    """Words of each text; distinct keys (ascending) of words with contexts and of pairs; places in these of each word, context and pair."""
    hashes = WordHashes()
    found = [indices(t, hashes) for t in texts]
    n = np.array([len(f[0]) for f in found], np.int64)
    flat = [np.concatenate([f[i] for f in found]) for i in range(3)]
    words, at = np.unique(np.concatenate(flat[:2]), return_inverse=True)
    pairs, at_pair = np.unique(flat[2], return_inverse=True)
    return n, [words, pairs], [at[: len(flat[0])], at[len(flat[0]) :], at_pair]


def _planes(values: np.ndarray) -> bytes:
    """Integers (0 or more) as planes of bytes, lowest first, as many as the greatest needs."""
    width = (int(values.max(initial=0)).bit_length() + 7) // 8
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()


def _values(planes: bytes, n: int) -> np.ndarray:
    out = np.zeros((n, 8), np.uint8)
    if n:
        got = np.frombuffer(planes, np.uint8).reshape(-1, n)
        out[:, : len(got)] = got.T
    return out.reshape(-1).view("<u8")


def _packed_keys(keys: np.ndarray) -> bytes:
    """Ascending keys as the first one and the steps."""
    return keys[:1].tobytes() + _planes(np.diff(keys))


def _unpacked_keys(packed: bytes, n: int) -> np.ndarray:
    first = np.frombuffer(packed[:8], np.uint64)
    return np.cumsum(np.concatenate([first, _values(packed[8:], n - 1)]), dtype=np.uint64) if n else first


def _packed(counts: np.ndarray) -> bytes:
    return zlib.compress(_planes(counts.reshape(-1)), 1)


def _unpacked(counts: bytes, kind: int, n: int) -> np.ndarray:
    """Rows of counts of ``n`` keys, see TABLES."""
    return _values(zlib.decompress(counts), len(TABLES[kind]) * n).astype(np.int64).reshape(len(TABLES[kind]), n)


def _table(rows: list[tuple], schema: list[tuple]) -> pa.Table:
    columns = zip(*rows, strict=True) if rows else [[]] * len(schema)
    return pa.Table.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, schema, strict=True)], names=[name for name, _ in schema])


def _counted(rows: DataFrame, bits: int) -> DataFrame:
    """Each chunk's distinct keys and their counts by bucket (2^bits of them); its first row holds its numbers of words."""
    first = np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits) if bits else np.zeros(1, np.uint64)

    def count(docs: pa.Table) -> pa.Table:
        out = []
        n, kinds, places = _read(docs.column("text").to_pylist())
        chunk, copies = docs.column("chunk")[0].as_py(), docs.column("copies").to_numpy()
        in_target = docs.column("is_target").to_numpy(zero_copy_only=False).astype(bool)
        every, target = np.repeat(copies, n), np.repeat(np.where(in_target, copies, 0), n)
        totals, plain = (int(target.sum()), int(every.sum())), copies.max(initial=1) == 1

        def tally(at: np.ndarray, whole: bool, keys: int) -> np.ndarray:
            if plain:
                return np.bincount(at if whole else at[target > 0], minlength=keys)
            # sums in float64 are exact to 2^53
            return np.bincount(at, weights=every if whole else target, minlength=keys).astype(np.int64)

        for kind, keys in enumerate(kinds):
            if not len(keys):
                continue
            counts = np.stack([tally(places[of], whole, len(keys)) for of, whole in TABLES[kind]])
            at = np.searchsorted(first, keys, side="right") - 1
            buckets, starts = np.unique(at, return_index=True)
            for bucket, a, b in zip(buckets.tolist(), starts.tolist(), [*starts[1:].tolist(), len(keys)], strict=True):
                out.append((chunk, bucket, kind, b - a, _packed_keys(keys[a:b]), _packed(counts[:, a:b]), *(totals if not out else (0, 0))))
        give_back()
        return _table(out, _COUNTED)

    return rows.groupBy("chunk").applyInArrow(count, COUNTED)


def _summed(table: pa.Table, wanted: tuple[int, ...] = (0, 1)):
    """Of a bucket's rows, for each kind: the rows' places, the number of keys of each, the place of each key among the distinct ones, and their sums."""
    kinds, lengths, keys, counts = (table.column(c).to_pylist() for c in ("kind", "n", "keys", "counts"))
    for kind in wanted:
        rows = [r for r, k in enumerate(kinds) if k == kind]
        if not rows:
            continue
        distinct, at = np.unique(np.concatenate([_unpacked_keys(keys[r], lengths[r]) for r in rows]), return_inverse=True)
        every = np.concatenate([_unpacked(counts[r], kind, lengths[r]) for r in rows], axis=1)
        # sums in float64 are exact to 2^53
        yield kind, rows, [lengths[r] for r in rows], at, np.stack([np.bincount(at, weights=c, minlength=len(distinct)).astype(np.int64) for c in every])


def _answer(table: pa.Table) -> pa.Table:
    """A bucket's rows with the counts over all chunks in place of their own."""
    chunks, bucket = table.column("chunk").to_pylist(), table.column("bucket")[0].as_py()
    out = []
    for kind, rows, lengths, at, sums in _summed(table):
        end = 0
        for row, length in zip(rows, lengths, strict=True):
            out.append((chunks[row], bucket, kind, length, _packed(sums[:, at[end : end + length]])))
            end += length
    give_back()
    return _table(out, _ANSWERED)


def _total(table: pa.Table) -> pa.Table:
    """A bucket's distinct words, and the words of the chunks whose first row is here."""
    words = [pc.sum(table.column(c)).as_py() for c in TOTALS[:2]]
    vocabulary = sum(int((sums[1] > 0).sum()) for *_, sums in _summed(table, (0,)))
    give_back()
    return _table([(*words, vocabulary)], [(c, pa.int64()) for c in TOTALS])


def _losses(word: np.ndarray, context: np.ndarray, pair: np.ndarray, total: np.ndarray, vocabulary: int) -> np.ndarray:
    """One model's loss of each word in nats, from the counts of the word, its context and the pair, and of all words."""
    base = (1 - UNIFORM) * word / np.maximum(total, 1) + np.where(total > 0, UNIFORM, 1.0) / vocabulary
    follow = np.where(context > 0, pair / np.maximum(context, 1), base)
    return -np.log(BLEND * follow + (1 - BLEND) * base)


def _own(of: np.ndarray, places: np.ndarray) -> np.ndarray:
    """How often each word's key occurs in the word's own document."""
    _, at, n = np.unique(of * (int(places.max()) + 1) + places, return_inverse=True, return_counts=True)
    return n[at]


def _judge(docs: pa.Table, answers: pa.Table) -> pa.Table:
    n, kinds, places = _read(docs.column("text").to_pylist())
    found = [[] for _ in TABLES]
    for kind, _, length, counts in sorted(zip(*(answers.column(c).to_pylist() for c in ("kind", "bucket", "n", "counts")), strict=True), key=lambda r: r[:2]):
        found[kind].append(_unpacked(counts, kind, length))
    per = np.zeros((2, len(n)))
    if n.sum():
        of = np.repeat(np.arange(len(n)), n)
        *totals, vocabulary = (answers.column(c)[0].as_py() for c in TOTALS)
        inside = [docs.column("is_target").to_numpy(zero_copy_only=False).astype(bool), np.ones(len(n), bool)]
        words, pairs = (np.concatenate(f, axis=1) for f in found)
        if [words.shape[1], pairs.shape[1]] != [len(keys) for keys in kinds]:
            raise RuntimeError("a chunk's answers don't fit its keys")
        own = [_own(of, p) for p in places]
        for model in range(2):
            less = inside[model][of]
            word, context, pair = (t[p] - np.where(less, o, 0) for t, p, o in zip((words[model], words[2 + model], pairs[model]), places, own, strict=True))
            losses = _losses(word, context, pair, totals[model] - np.where(less, n[of], 0), vocabulary)
            per[model] = np.bincount(of, weights=losses, minlength=len(n)) / np.maximum(n, 1)
    give_back()
    return pa.table({"doc_id": docs.column("doc_id"), "n_words": n, "target_loss": per[0], "background_loss": per[1], "score": per[0] - per[1], "copies": docs.column("copies")})


def _counted_copies(rows: DataFrame, many: int) -> DataFrame:
    """Adds copies: 1, or the number of equal rows (doc_id, text_key) that one row now stands for, where there are ``many`` or more."""
    hot = cut_lineage(rows.groupBy("doc_id", "text_key").agg(F.count("*").alias("copies")).where(F.col("copies") >= many))
    n = hot.count()
    if not n:
        return rows.withColumn("copies", F.lit(1).cast("long"))
    near = hot.select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"), "copies")
    marked = rows.join(F.broadcast(near) if n <= MOST_BROADCAST else near, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_key") == F.col("_key")), "left").drop("_id", "_key")
    one = marked.where("copies IS NOT NULL").groupBy("doc_id", "text_key", "copies").agg(F.first("text").alias("text"))
    return marked.where("copies IS NULL").withColumn("copies", F.lit(1).cast("long")).unionByName(one)


def _dealt(docs: DataFrame, target: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> tuple[DataFrame, int]:
    """Rows by chunk, with weights and the target's marked, and the bits that number the buckets."""
    prepare(docs.sparkSession)
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    chunks = max(LEAST_CHUNKS, -(-size // chunk_bytes))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_key"), "text")
    wanted = target.select(F.col("doc_id").cast("long").alias("_lm_id")).where("_lm_id IS NOT NULL").distinct().withColumn("is_target", F.lit(True))
    wanted = cut_lineage(wanted)
    wanted = F.broadcast(wanted) if wanted.count() <= MOST_IDS else wanted
    rows = _counted_copies(rows, MANY_COPIES).join(wanted, F.col("doc_id") == F.col("_lm_id"), "left")
    # of several texts under one id each has a chunk of its own
    chunk = F.pmod(F.xxhash64("doc_id", "text_key"), F.lit(chunks)).alias("chunk")
    return rows.select("doc_id", "text", "copies", F.coalesce("is_target", F.lit(False)).alias("is_target"), chunk), (chunks // 2 - 1).bit_length()


def score(docs: DataFrame, target: DataFrame) -> DataFrame:
    """doc_id, n_words, target_loss, background_loss (per word) and score of every row of ``docs``.

    ``target``: doc_id of the rows whose texts make the target model; the
    background is all of ``docs``.
    """
    rows, bits = _dealt(docs, target)
    counted = _counted(rows, bits)
    answers = counted.groupBy("bucket").applyInArrow(_answer, ANSWERED)
    totals = counted.groupBy("bucket").applyInArrow(_total, ", ".join(f"{c} long" for c in TOTALS)).agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in TOTALS])
    # one row, put beside the answers: the texts are dealt out once for both of their readers
    answers = answers.crossJoin(F.broadcast(totals))
    judged = rows.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(_judge, "doc_id long, n_words long, target_loss double, background_loss double, score double, copies long")
    runs = judged.withColumn("_run", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(copies - 1) div {RUN}L"))))
    return runs.withColumn("_run", F.explode(F.sequence(F.col("_run") * RUN + 1, F.least(F.col("_run") * RUN + RUN, F.col("copies"))))).drop("_run", "copies")


def table_sizes(docs: DataFrame, target: DataFrame) -> DataFrame:
    """Number of distinct words, contexts and word pairs that the models count, by kind."""

    def sizes(table: pa.Table) -> pa.Table:
        out = []
        for kind, *_, sums in _summed(table):
            all_of = {"words": sums[1], "contexts": sums[3]} if kind == 0 else {"pairs": sums[1]}
            out += [(name, int((counts > 0).sum())) for name, counts in all_of.items()]
        return _table(out, [("kind", pa.string()), ("n", pa.int64())])

    return _counted(*_dealt(docs, target)).groupBy("bucket").applyInArrow(sizes, "kind string, n long").groupBy("kind").agg(F.sum("n").alias("n"))
