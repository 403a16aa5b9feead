"""BPE encoding and decoding by tree concatenation.

A long text is cut into leaves, the leaves are encoded in parallel threads,
and neighbours are joined pairwise up a binary tree.  At each join a window of
bytes around the cut is encoded again and grown until its first tokens equal
the left side's tokens at the window's start and its last tokens equal the
right side's at its end; only then are the three parts glued.  A token
sequence is the encoder's own exactly when all its neighbouring pairs are, and
the agreeing tokens carry that over both seams.  If no window agrees, the
window has grown to both whole sides and the join is a plain encoding.

The vocabulary file is the JSON of the tokenizers library; its merges are run
by a faster engine with the same rules (the tests hold it against that
library).  The file's path is a parameter; executors read it themselves.

Cases: null text encodes as the empty text (no ids, hash of no bytes); rows
are independent, so repeated rows, ties, empty tables and further columns
change nothing; a text of any length takes memory in proportion to itself.
"""

from __future__ import annotations

import hashlib
import json
from concurrent.futures import ThreadPoolExecutor
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import give_back, prepare

LEAF_BYTES = 1 << 15
WINDOW_BYTES = 96
AGREE = 3


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _byte_of_char() -> dict[str, int]:
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table = {chr(b): b for b in shown}
    hidden = (b for b in range(256) if b not in shown)
    return table | {chr(256 + k): b for k, b in enumerate(hidden)}


class ByteBpe:
    """Encoder and decoder over one tokenizers JSON file of the byte-level kind."""

    def __init__(self, path: str, leaf_bytes: int = LEAF_BYTES):
        import public_tokenizers
        import tiktoken

        with open(path) as f:
            spec = json.load(f)
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        table = _byte_of_char()
        ranks = {bytes(table[c] for c in k): v for k, v in spec["model"]["vocab"].items() if k not in special}
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
        vocab = spec["model"]["vocab"]
        made = [vocab["".join(m)] for m in merges]
        if made != sorted(made):
            raise ValueError("merge order and ids differ; this vocabulary needs another engine")
        self.engine = tiktoken.Encoding("file", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)
        self.bytes_of = {v: k for k, v in ranks.items()} | {v: k.encode() for k, v in special.items()}
        self.lengths = np.zeros(max(self.bytes_of) + 1, np.int64)
        for k, v in self.bytes_of.items():
            self.lengths[k] = len(v)
        self.leaf = leaf_bytes
        self.window = max([WINDOW_BYTES, *(4 * len(s.encode()) for s in special)])

    def plain(self, raw: bytes) -> np.ndarray:
        return self.engine.encode_to_numpy(raw.decode(), allowed_special="all").astype(np.uint32)

    def encode(self, text: str, pool: ThreadPoolExecutor | None = None) -> np.ndarray:
        if 4 * len(text) <= self.leaf:
            return self.engine.encode_to_numpy(text, allowed_special="all").astype(np.uint32)
        raw = text.encode()
        if len(raw) <= self.leaf:
            return self.plain(raw)
        cuts = [0]
        while len(raw) - cuts[-1] > self.leaf:
            at = cuts[-1] + self.leaf
            while raw[at] & 0xC0 == 0x80:
                at -= 1
            cuts.append(at)
        cuts.append(len(raw))
        spans = list(zip(cuts, cuts[1:], strict=False))
        leaves = list((pool.map if pool else map)(lambda s: self.plain(raw[s[0] : s[1]]), spans))
        while len(leaves) > 1:
            joined, over = [], []
            for i in range(0, len(leaves) - 1, 2):
                (a, m), (_, b) = spans[i], spans[i + 1]
                joined.append(self.join(raw, a, m, b, leaves[i], leaves[i + 1]))
                over.append((a, b))
            if len(leaves) % 2:
                joined.append(leaves[-1])
                over.append(spans[-1])
            leaves, spans = joined, over
        return leaves[0]

    def join(self, raw: bytes, a: int, m: int, b: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Tokens of raw[a:b] from those of raw[a:m] and raw[m:b]."""
        ends_l = a + np.cumsum(self.lengths[left])
        ends_r = m + np.cumsum(self.lengths[right])
        width = self.window
        while True:
            i = int(np.searchsorted(ends_l, m - width, side="right"))  # tokens of the left that stay
            while i and raw[ends_l[i - 1]] & 0xC0 == 0x80:
                i -= 1
            j = int(np.searchsorted(ends_r, m + width, side="left")) + 1  # tokens of the right that go
            while j < len(right) and ends_r[j - 1] < len(raw) and raw[ends_r[j - 1]] & 0xC0 == 0x80:
                j += 1
            start = a if i == 0 else int(ends_l[i - 1])
            stop = b if j >= len(right) else int(ends_r[j - 1])
            mid = self.plain(raw[start:stop])
            fits_l = i == 0 or (len(mid) > AGREE and np.array_equal(mid[:AGREE], left[i : i + AGREE]))
            fits_r = j >= len(right) or (len(mid) > AGREE and j >= AGREE and np.array_equal(mid[-AGREE:], right[j - AGREE : j]))
            if fits_l and fits_r:
                return np.concatenate([left[:i], mid, right[j:] if j < len(right) else right[:0]])
            width *= 2

    def decode(self, ids: np.ndarray) -> str:
        return b"".join(map(self.bytes_of.__getitem__, ids.tolist())).decode(errors="replace")


@lru_cache(maxsize=2)
def encoder(path: str | None = None) -> ByteBpe:
    return ByteBpe(path or default_path())


def encode_texts(docs: DataFrame, keep: list[str], path: str | None = None, with_ids: bool = True) -> DataFrame:
    """The columns in ``keep``, n_tokens, ids (array<int>, if asked for), ids_sha256 and decoded_sha256."""
    prepare(docs.sparkSession)
    src = docs.select(*[F.col(c) for c in keep], F.coalesce("text", F.lit("")).alias("_bpe_text"))
    schema = ", ".join(f"`{c}` {t}" for c, t in docs.select(*keep).dtypes)
    schema += ", n_tokens long, " + "ids array<int>, " * with_ids + "ids_sha256 string, decoded_sha256 string"

    def run(batches):
        bpe = encoder(path)
        with ThreadPoolExecutor(2) as pool:
            for batch in batches:
                count, ids, hashes, decoded = [], [], [], []
                for text in batch.column(len(keep)).to_pylist():
                    got = bpe.encode(text, pool)
                    count.append(len(got))
                    if with_ids:
                        ids.append(got.astype(np.int32))
                    hashes.append(hashlib.sha256(got.astype("<u4").tobytes()).hexdigest())
                    decoded.append(hashlib.sha256(bpe.decode(got).encode()).hexdigest())
                columns = [batch.column(i) for i in range(len(keep))] + [pa.array(count, pa.int64())]
                if with_ids:
                    columns.append(pa.array(ids, pa.list_(pa.int32())))
                columns += [pa.array(hashes, pa.string()), pa.array(decoded, pa.string())]
                names = [*keep, "n_tokens", *["ids"] * with_ids, "ids_sha256", "decoded_sha256"]
                yield pa.RecordBatch.from_arrays(columns, names=names)
        give_back()

    return src.mapInArrow(run, schema)


def decode_ids(coded: DataFrame, keep: list[str], path: str | None = None) -> DataFrame:
    """The columns in ``keep`` and the text of each row's ids; null ids decode to the empty text."""
    prepare(coded.sparkSession)
    schema = ", ".join(f"`{c}` {t}" for c, t in coded.select(*keep).dtypes) + ", text string"

    def run(batches):
        bpe = encoder(path)
        for batch in batches:
            texts = [bpe.decode(np.array(ids or [], np.uint32)) for ids in batch.column(len(keep)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(keep))), pa.array(texts, pa.string())], names=[*keep, "text"])

    return coded.select(*keep, "ids").mapInArrow(run, schema)
