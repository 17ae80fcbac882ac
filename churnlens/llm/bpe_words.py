"""Byte-level BPE encoding and decoding by a global distinct-word shuffle.

1. Texts are cut into pre-tokens.  A block of rows (``block_bytes`` of text at most, within
   one task) keeps its distinct words and, for every position of every text, the word's
   number in the block: positions stay where they are and a word leaves a block once,
   however often it stands there.  This is written to the shared folder once.
2. The blocks' words are dealt by a hash into buckets and shuffled; rows of a bucket
   stand together, and each distinct word of the corpus is encoded once, in one bucket.
3. The ids are joined back to the blocks, and each text is put together by position.

No word is hot: however frequent it is, it comes from a block once, so its share of the
shuffled rows is at most one over a block's vocabulary.  The number of buckets follows the
number of words, so a bucket's words fit in a task.  Decoding joins ids with the
token-byte table, which has one row for each rank of the vocabulary file and no more.
"""

from __future__ import annotations

import base64
from itertools import accumulate

import numpy as np
import pyarrow as pa
import regex
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlens.llm.common import byte_view, runs_of_rows
from churnlens.session import materialize

BLOCK_BYTES = 32 << 20
BUCKET_WORDS = 400_000
LEVEL = 5  # of compression
#: Texts above this many characters are matched match by match, so no list of all their words is made.
LONG_TEXT = 1 << 20


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and their ranks, from a file of base64 tokens and numbers."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, filter(None, map(bytes.strip, f)))}


_CODECS: dict[tuple[str, str], object] = {}


def _codec(path: str, pattern: str):
    """The file's encoder, made once in a worker."""
    if (path, pattern) not in _CODECS:
        import tiktoken
        _CODECS[path, pattern] = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=read_ranks(path), special_tokens={})
    return _CODECS[path, pattern]


def pack_numbers(x: np.ndarray) -> bytes:
    """Compressed 32-bit numbers, one byte plane after the other (small numbers pack best)."""
    planes = np.ascontiguousarray(x.astype("<u4", copy=False).view(np.uint8).reshape(-1, 4).T)
    return zstandard.ZstdCompressor(level=LEVEL).compress(planes)


def unpack_numbers(x: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(x), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").reshape(-1)


def pack_rising(x: np.ndarray) -> bytes:
    """Rising numbers by their steps."""
    return pack_numbers(np.diff(x, prepend=0))


def unpack_rising(x: bytes) -> np.ndarray:
    return np.cumsum(unpack_numbers(x), dtype=np.int64)


def pack_words(words: list[bytes]) -> bytes:
    sizes = pack_numbers(np.fromiter(map(len, words), np.int64, len(words)))
    return len(sizes).to_bytes(4, "little") + sizes + zstandard.ZstdCompressor(level=LEVEL).compress(b"".join(words))


def unpack_words(x: bytes) -> list[bytes]:
    n = int.from_bytes(x[:4], "little")
    sizes = unpack_numbers(x[4:4 + n]).tolist()
    flat = zstandard.ZstdDecompressor().decompress(x[4 + n:])
    ends = list(accumulate(sizes))
    return [flat[e - s:e] for s, e in zip(sizes, ends)]


def pre_tokens(docs: DataFrame, pattern: str, id_col: str, text_col: str, block_bytes: int) -> DataFrame:
    """One row per block: its ids and word counts per text, the word number at every position, and its
    distinct words, the most frequent first."""
    id_type = docs.schema[id_col].dataType.simpleString()

    class Block:
        """Rows of one block, batch after batch; only word numbers and distinct words are held."""

        def __init__(self):
            self.number, self.codes, self.sizes, self.ids, self.bytes = {}, [], [], [], 0

        def add(self, ids, texts, pat):
            number = self.number
            seen = number.setdefault
            self.ids.extend(ids)
            for t in texts:
                if not t:
                    c = np.zeros(0, np.uint32)
                elif len(t) > LONG_TEXT:
                    c = np.fromiter((seen(m.group(), len(number)) for m in pat.finditer(t)), np.uint32)
                else:
                    c = np.array([seen(w, len(number)) for w in pat.findall(t)], np.uint32)
                self.codes.append(c)
                self.sizes.append(len(c))

        def row(self, key, id_type):
            flat = np.concatenate(self.codes) if self.codes else np.zeros(0, np.uint32)
            self.codes = []
            order = np.argsort(-np.bincount(flat, minlength=len(self.number)), kind="stable")
            rank = np.empty(len(order), np.uint32)
            rank[order] = np.arange(len(order))
            names = list(self.number)
            words = [names[i].encode() for i in order]
            cols = {"_block": pa.array([key], pa.int64()), "_ids": pa.array([self.ids], pa.list_(id_type)),
                    "_sizes": pa.array([self.sizes], pa.list_(pa.int32())),
                    "_codes": pa.array([pack_numbers(rank[flat])], pa.binary()),
                    "_words": pa.array([pack_words(words)], pa.binary()), "_n": pa.array([len(words)], pa.int64())}
            return pa.RecordBatch.from_arrays(list(cols.values()), names=list(cols))

    def run(batches):
        pat, part, k, now, kind = regex.compile(pattern), TaskContext.get().partitionId(), 0, Block(), None
        for batch in batches:
            kind = batch.schema.field("_id").type
            _, offsets = byte_view(batch.column("_text"))
            for a, b in runs_of_rows(offsets, min(block_bytes, 4 << 20)):
                size = int(offsets[b] - offsets[a])
                if now.sizes and now.bytes + size > block_bytes:
                    yield now.row((part << 32) + k, kind)
                    k, now = k + 1, Block()
                now.add(batch.column("_id").slice(a, b - a).to_pylist(), batch.column("_text").slice(a, b - a).to_pylist(), pat)
                now.bytes += size
        if now.sizes:
            yield now.row((part << 32) + k, kind)

    return docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).mapInArrow(
        run, f"_block bigint, _ids array<{id_type}>, _sizes array<int>, _codes binary, _words binary, _n bigint")


def deal_words(blocks: DataFrame, buckets: int) -> DataFrame:
    """Each block's words by bucket: their numbers in the block and the words."""

    def run(batches):
        for batch in batches:
            for key, words in zip(batch.column("_block").to_pylist(), batch.column("_words")):
                words = unpack_words(words.as_py())
                h = np.fromiter((xxhash.xxh64_intdigest(w) for w in words), np.uint64, len(words)) % np.uint64(buckets)
                order = np.argsort(h, kind="stable")
                edges = np.flatnonzero(np.diff(h[order])) + 1
                for at in np.split(order, edges) if len(order) else ():
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([int(h[at[0]])], pa.int64()), pa.array([key], pa.int64()),
                         pa.array([pack_rising(at)], pa.binary()), pa.array([pack_words([words[i] for i in at])], pa.binary())],
                        names=["_bucket", "_block", "_at", "_words"])

    return blocks.select("_block", "_words").mapInArrow(run, "_bucket bigint, _block bigint, _at binary, _words binary")


def encode_words(dealt: DataFrame, path: str, pattern: str) -> DataFrame:
    """Ids of the dealt words; within a bucket each distinct word is encoded once."""

    def run(batches):
        codec, bucket, known = _codec(path, pattern), None, {}
        for batch in batches:
            for i in range(batch.num_rows):
                if batch.column("_bucket")[i].as_py() != bucket:
                    bucket, known = batch.column("_bucket")[i].as_py(), {}
                ids = []
                for w in unpack_words(batch.column("_words")[i].as_py()):
                    got = known.get(w)
                    if got is None:
                        got = known[w] = codec.encode_ordinary(w.decode())
                    ids.append(got)
                sizes = np.fromiter(map(len, ids), np.int64, len(ids))
                flat = np.fromiter((x for y in ids for x in y), np.int64, int(sizes.sum()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("_block").slice(i, 1), batch.column("_at").slice(i, 1),
                     pa.array([pack_numbers(sizes)], pa.binary()), pa.array([pack_numbers(flat)], pa.binary())],
                    names=["_block", "_at", "_sizes", "_ids"])

    return dealt.repartition("_bucket").sortWithinPartitions("_bucket") \
        .mapInArrow(run, "_block bigint, _at binary, _sizes binary, _ids binary")


def _gather(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Places start, start + 1, ... of each of the given stretches, one after the other."""
    total = int(sizes.sum())
    shift = np.repeat(starts - np.concatenate(([0], np.cumsum(sizes)[:-1])), sizes)
    return shift + np.arange(total)


class TokenTable:
    """Bytes of every rank of a vocabulary file, for joining ids with them."""

    def __init__(self, path: str):
        ranks = read_ranks(path)
        table = [b""] * (max(ranks.values(), default=-1) + 1)
        self.known = np.zeros(len(table), bool)
        for token, k in ranks.items():
            table[k], self.known[k] = token, True
        self.size = np.fromiter(map(len, table), np.int64, len(table))
        self.start = np.concatenate(([0], np.cumsum(self.size)[:-1])) if len(table) else self.size
        self.flat = np.frombuffer(b"".join(table), np.uint8)

    def has(self, ids: np.ndarray) -> bool:
        return bool((ids >= 0).all() and (ids < len(self.known)).all() and self.known[ids].all())

    def join(self, ids: np.ndarray, edges: np.ndarray) -> pa.Array:
        """Bytes of each run of ids (``edges``: n+1 places), all of them in the table."""
        sizes = self.size[ids]
        flat = self.flat[_gather(self.start[ids], sizes)]
        ends = np.concatenate(([0], np.cumsum(sizes)))[edges]
        return pa.Array.from_buffers(pa.large_binary(), len(edges) - 1, [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(flat)])


def encode(docs: DataFrame, ranks_path: str, pattern: str, *, id_col: str = "doc_id", text_col: str = "text",
           block_bytes: int = BLOCK_BYTES, bucket_words: int = BUCKET_WORDS, decoded: bool = False) -> DataFrame:
    """One row per input row: id and ``ids`` (array<int>), each match of ``pattern`` encoded separately; with
    ``decoded`` also ``bytes``, what ``decode`` makes of the ids, joined in the same task.

    Null and empty texts have no ids.  Repeated rows and null ids give a row each; other columns are
    not read.  An empty table gives an empty result."""
    id_type = docs.schema[id_col].dataType.simpleString()
    blocks = materialize(pre_tokens(docs, pattern, id_col, text_col, block_bytes), "bpe-blocks")
    total = blocks.agg(F.sum("_n")).first()[0] or 0
    found = encode_words(deal_words(blocks, max(1, -(-total // bucket_words))), ranks_path, pattern)
    # at most one entry per bucket and no more than the block has words
    back = found.groupBy("_block").agg(F.collect_list(F.struct("_at", "_sizes", "_ids")).alias("_found"))
    whole = blocks.select("_block", F.col("_ids").alias("_doc"), F.col("_sizes").alias("_words"), "_codes", "_n") \
        .join(back, "_block", "left")

    def run(batches):
        table = TokenTable(ranks_path) if decoded else None
        for batch in batches:
            for row in range(batch.num_rows):
                n = batch.column("_n")[row].as_py()
                sizes, parts = np.zeros(n, np.int64), []
                for f in batch.column("_found")[row].as_py() or []:
                    at, m = unpack_rising(f["_at"]), unpack_numbers(f["_sizes"]).astype(np.int64)
                    sizes[at] = m
                    parts.append((at, m, unpack_numbers(f["_ids"])))
                starts = np.concatenate(([0], np.cumsum(sizes)[:-1])) if n else sizes
                flat = np.zeros(int(sizes.sum()), np.int32)
                for at, m, ids in parts:
                    flat[_gather(starts[at], m)] = ids
                codes = unpack_numbers(batch.column("_codes")[row].as_py())
                doc = batch.column("_doc")[row].values
                ends = np.concatenate(([0], np.cumsum(batch.column("_words")[row].values.to_numpy(zero_copy_only=False))))
                for a, b in runs_of_rows(ends, 1 << 18):
                    c = codes[ends[a]:ends[b]]
                    out = flat[_gather(starts[c], sizes[c])]
                    edge = np.concatenate(([0], np.cumsum(sizes[c])))[ends[a:b + 1] - ends[a]]
                    cols = [doc.slice(a, b - a), pa.ListArray.from_arrays(pa.array(edge, pa.int32()), pa.array(out, pa.int32()))]
                    if table:
                        cols.append(table.join(out, edge).cast(pa.binary()))
                    yield pa.RecordBatch.from_arrays(cols, names=["_id", "ids", "bytes"][:len(cols)])

    got = whole.mapInArrow(run, f"_id {id_type}, ids array<int>" + ", bytes binary" * decoded)
    return got.select(F.col("_id").alias(id_col), *got.columns[1:])


def decode(tokens: DataFrame, ranks_path: str, *, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``tokens`` with ``bytes``: the ids' bytes, joined with the token-byte table inside each task (its
    size is that of the vocabulary file).  Null ids give null, as does an id that the table lacks."""
    types = {f.name: f.dataType.simpleString() for f in tokens.schema.fields}

    def run(batches):
        table = TokenTable(ranks_path)
        for batch in batches:
            out = []
            for x in batch.column("ids"):
                ids = None
                if x.is_valid and not x.values.null_count:
                    ids = x.values.to_numpy(zero_copy_only=False).astype(np.int64)
                known = ids is not None and table.has(ids)
                out.append(table.join(ids, np.array([0, len(ids)]))[0].as_py() if known else None)
            yield pa.RecordBatch.from_arrays([batch.column("_id"), batch.column("ids"), pa.array(out, pa.binary())],
                                             names=["_id", "ids", "bytes"])

    got = tokens.select(F.col(id_col).alias("_id"), F.col(ids_col).alias("ids")) \
        .mapInArrow(run, f"_id {types[id_col]}, ids {types[ids_col]}, bytes binary")
    return got.select(F.col("_id").alias(id_col), F.col("ids").alias(ids_col), "bytes")
