"""Alignment of two tokenizers over a corpus, with corpus-wide counts of the id pairs that they link.

Both token sequences of a text cut the same bytes.  Where both have a boundary a group ends; an A token and a
B token are linked where their bytes overlap.  A blank between two visible characters is a boundary of
both (the pre-token pattern of A starts a token there, and no piece of B goes on over it), so a text falls into
segments that are aligned once per distinct segment.

The count of a pair is the number of documents that hold it linked:

1. A first pass encodes and aligns the documents in blocks of about ``BLOCK_CHARS`` characters and writes each block
   with its segments' ids, its distinct pairs and in how many of its documents each occurs.
2. The distinct pairs of all blocks are dealt to parts by A id, some ``PART_KEYS`` each, and every part
   gets a minimal perfect hash with its keys kept for verification.
3. Blocks are dealt to branches.  For a part and a branch one task adds the branch's counts into a dense vector
   indexed by the hash; the vectors are summed as a tree, ``FAN`` at a time.  All pairs of an A id are in one
   part, so the part knows the highest count of each A id.
4. The blocks' pairs are looked up by the same hashes, and a second pass aligns every block's documents
   again, from the ids that the first pass wrote, and adds up the counts of their links.

No table is broadcast and nothing but numbers of rows reaches the driver; a task holds a block, or a part with
the pairs of one branch.  A block may be any mixture of documents, so a hot source or text is spread by
where its rows lie.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from math import ceil

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlens.llm.perfect_hash import PerfectHash
from churnlens.session import materialize

BLOCK_CHARS = 8 << 20
#: Documents in a block at most, so that many short ones make no long list.
BLOCK_ROWS = 16_384
PART_KEYS = 65_536
#: Blocks in a branch (about), and vectors that are summed at once.
BRANCH_BLOCKS = 64
FAN = 8
#: The last character whose class in the pattern is the same in all versions of Unicode (Latin, its marks and signs).
SETTLED = "\u036f"
# Fixed value: the pattern of byte-level pre-tokenizers.
BYTE_LEVEL_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_BETWEEN = re.compile(r"(?<=\S) (?=\S)")


# ---- two tokenizers -----------------------------------------------------------------------------------

def byte_characters() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable Latin-1 for itself,
    the others by characters from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Vocabulary:
    """Bytes and decimal ids of a tokenizer's tokens, to be taken by arrays of ids."""

    def __init__(self, tokens: list[bytes]):
        self.bytes = pa.array(tokens, pa.large_binary())
        self.lengths = np.array([len(t) for t in tokens], np.int64)
        self.names = pa.array([str(i) for i in range(len(tokens))], pa.string())
        self.dtype = np.uint16 if len(tokens) <= 1 << 16 else np.int32

    def joined(self, ids: np.ndarray) -> bytes:
        return self.bytes.take(pa.array(ids)).buffers()[2].to_pybytes() if len(ids) else b""


class Tokenizers:
    """A byte-level tokenizer file (``.json``) and a SentencePiece file (``.model``) with byte pieces, which
    normalises nothing but puts a blank before the text."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer
        self.a = Tokenizer.from_file(path_a)
        self.a.no_truncation()
        self.a.no_padding()
        self.a.encode_special_tokens = True  # their strings inside a text are plain text
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        chars = byte_characters()
        self.words_a = Vocabulary([bytes(chars[c] for c in t) if all(c in chars for c in t) else t.encode()
                                   for t in ((self.a.id_to_token(i) or "") for i in range(self.a.get_vocab_size()))])
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.words_b = Vocabulary([bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("\u2581", " ").encode()
                                   for i, p in enumerate(pieces)])
        self.quick = self._quick(path_a)
        #: Merges never reach over a blank after a visible character if no piece holds one there.
        self.cuts = not any(re.search("[^\u2581]\u2581", p) for p in pieces)

    def _quick(self, path_a: str):
        """A's vocabulary as ranks, if its merges are the ranks' order and nothing is done before its pattern.

        Merging by ranks then gives A's ids, three times as fast; it is used for texts of characters before
        ``SETTLED``, whose classes in the pattern are the same in all versions of Unicode."""
        import tiktoken
        with open(path_a, encoding="utf-8") as f:
            spec = json.load(f)
        model, before = spec["model"], spec.get("pre_tokenizer") or {}
        if spec.get("normalizer") or model.get("type") != "BPE" or model.get("dropout") or model.get("ignore_merges") \
                or before.get("type") != "ByteLevel" or before.get("add_prefix_space") or not before.get("use_regex", True):
            return None
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        ids = [model["vocab"].get(a + b, -1) for a, b in merges]
        chars = byte_characters()
        single = {t: i for t, i in model["vocab"].items() if len(t) == 1}
        if set(single) != set(chars) or ids != sorted(set(ids)) or ids[:1] != [256] or sorted(single.values()) != list(range(256)):
            return None
        made = set(ids)
        ranks = {bytes(chars[c] for c in t): i for t, i in model["vocab"].items() if len(t) == 1 or i in made}
        return tiktoken.Encoding("a", pat_str=BYTE_LEVEL_PATTERN, mergeable_ranks=ranks, special_tokens={})

    def segments(self, text: str) -> list[str]:
        """Parts of the text that both tokenizers encode apart from each other; the blanks between them are left out."""
        if not self.cuts:
            return [text]
        words = text.split(" ")
        return words if words == text.split() else _BETWEEN.split(text)

    def encode(self, segments: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Ids by A of each segment with a blank before it, and by B of the segment."""
        ids = [e.ids for e in self.a.encode_batch_fast([" " + x for x in segments], add_special_tokens=False)] if segments else []
        return [(np.array(a, np.int64), np.array(b, np.int64)) for a, b in zip(ids, self.b.encode(segments, num_threads=1))]

    def encode_joined(self, segments: list[str], settled: bool) -> tuple[np.ndarray, np.ndarray]:
        """The same for plain segments, one after the other in one array each; ``settled`` ones by ranks."""
        a, b = [], []
        for i in range(0, len(segments), 256):
            text = " ".join(segments[i:i + 256])
            a.append(np.array(self.quick.encode_ordinary(" " + text) if settled else
                              self.a.encode_batch_fast([" " + text], add_special_tokens=False)[0].ids, np.int64))
            b.append(np.array(self.b.encode(text), np.int64))
        return np.concatenate(a or [_NONE]), np.concatenate(b or [_NONE])


_NONE = np.zeros(0, np.int64)


@lru_cache(maxsize=4)
def _tokenizers(path_a: str, path_b: str) -> Tokenizers:
    return Tokenizers(path_a, path_b)


class Segments:
    """The distinct segments of some texts, encoded.

    ``parts`` has the segments' numbers of every distinct text, ``a`` and ``b`` the ids of all segments one after
    the other and ``lengths`` the bytes of each with its blank: 0, and no ids, where the tokens' bytes are not its own."""

    def __init__(self, texts: list[str | None], tokenizers: Tokenizers):
        self.tokenizers = tokenizers
        distinct = dict.fromkeys(t for t in texts if t)
        parts = [tokenizers.segments(t) for t in distinct]
        words = pa.array([s for p in parts for s in p], pa.large_string()).dictionary_encode()
        names = words.dictionary.to_pylist()
        # a segment can be encoded beside others if it is one there too: no blank at its ends (inside a
        # text it has none), nor the character that stands for a blank
        odd = pc.match_substring(words.dictionary, "\u2581").to_numpy(zero_copy_only=False).astype(bool)
        ends = {s for p in parts for s in (p[0], p[-1]) if s[0].isspace() or s[-1].isspace()}
        if ends:
            odd |= pc.is_in(words.dictionary, pa.array(list(ends), pa.large_string())).to_numpy(zero_copy_only=False)
        if not tokenizers.cuts:
            odd[:] = True
        kind = np.where(odd, 2, 1)  # the settled ones come first, the odd ones last
        if tokenizers.quick:
            late = pc.match_substring_regex(words.dictionary, f"[^\\x00-{SETTLED}]").to_numpy(zero_copy_only=False).astype(bool)
            kind[~odd & ~late] = 0
        order = np.argsort(kind, kind="stable")
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        names = [names[i] for i in order]
        at = place[words.indices.to_numpy()] if names else _NONE
        stops = np.cumsum([len(p) for p in parts])
        self.parts = {t: at[e - len(p):e] for t, p, e in zip(distinct, parts, stops)}
        self.lengths = pc.binary_length(words.dictionary).to_numpy()[order].astype(np.int64) + 1
        self._encode(names, int((kind == 0).sum()), int((~odd).sum()))

    def _encode(self, names: list[str], n_settled: int, n_plain: int) -> None:
        t, plain, first = self.tokenizers, names[:n_plain], n_plain
        both = [t.encode_joined(names[:n_settled], True), t.encode_joined(names[n_settled:n_plain], False)]
        a, b = (np.concatenate(x) for x in zip(*both))
        text = "".join(" " + s for s in plain).encode()
        if t.words_a.joined(a) == text == t.words_b.joined(b):
            a, b = [a], [b]
        else:  # some segment's bytes are lost; each is looked at by itself
            a, b, first = [], [], 0
        for s in range(first, len(names), 1024):
            for i, (x, y) in enumerate(t.encode(names[s:s + 1024]), s):
                if t.words_a.joined(x) == b" " + names[i].encode() == t.words_b.joined(y):
                    a.append(x)
                    b.append(y)
                else:
                    self.lengths[i] = 0
        self.a, self.b = np.concatenate(a or [_NONE]), np.concatenate(b or [_NONE])


class Aligned:
    """Links and groups of encoded segments: all their bytes, one after the other, cut at the ends of the tokens."""

    def __init__(self, tokenizers: Tokenizers, a: np.ndarray, b: np.ndarray, lengths: np.ndarray):
        self.tokenizers, self.a, self.b, self.fits, n = tokenizers, a, b, lengths > 0, len(lengths)
        ends = np.cumsum(lengths)
        end_a, end_b = np.cumsum(tokenizers.words_a.lengths[a]), np.cumsum(tokenizers.words_b.lengths[b])
        # each stretch between two ends of either is one link
        stops = np.union1d(end_a, end_b)
        i, j = np.searchsorted(end_a, stops), np.searchsorted(end_b, stops)
        both = (end_a[i] == stops) & (end_b[j] == stops) if len(stops) else np.zeros(0, bool)
        if not np.isin(ends[self.fits], stops[both]).all():
            raise ValueError("a segment does not end with a token of both tokenizers")
        self.group_a, self.group_b = i[both] + 1, j[both] + 1  # tokens up to the end of each group
        seg = np.searchsorted(ends, stops)
        self.n_a = np.bincount(np.searchsorted(ends, end_a), minlength=n)
        self.n_b = np.bincount(np.searchsorted(ends, end_b), minlength=n)
        self.n_groups = np.bincount(seg[both], minlength=n)
        links = np.bincount(seg, minlength=n)
        self.ends = np.cumsum(links)
        self.starts = self.ends - links
        #: distinct pairs of all segments, and for each link the number of its pair
        self.pairs, self.local = np.unique((a[i].astype(np.int64) << 32) | b[j], return_inverse=True)

    def pairs_of(self, segments: np.ndarray) -> np.ndarray:
        """Numbers of the pairs that some segments link (with repeats)."""
        n = self.ends[segments] - self.starts[segments]
        return self.local[np.arange(n.sum()) + np.repeat(self.starts[segments] - (np.cumsum(n) - n), n)]

    def summed(self, per_pair: np.ndarray) -> np.ndarray:
        """For every segment the sum over its links of a value of ``pairs``."""
        run = np.concatenate(([0], np.cumsum(per_pair[self.local])))
        return run[self.ends] - run[self.starts]

    def groups(self) -> list[str]:
        """The groups of every segment as text: ids of A, a bar, ids of B, a semicolon between groups."""
        def lists(ids, words, ends):
            offsets = pa.array(np.concatenate(([0], ends)), pa.int32())
            return pc.binary_join(pa.ListArray.from_arrays(offsets, words.names.take(pa.array(ids))), ",")
        each = pc.binary_join_element_wise(lists(self.a, self.tokenizers.words_a, self.group_a),
                                           lists(self.b, self.tokenizers.words_b, self.group_b), "|")
        offsets = pa.array(np.concatenate(([0], np.cumsum(self.n_groups))), pa.int32())
        return pc.binary_join(pa.ListArray.from_arrays(offsets, each), ";").to_pylist()


def pack(numbers: np.ndarray) -> bytes:
    """Non-negative numbers in as few whole bytes each as the largest needs, which the first byte tells."""
    width = max(1, (int(numbers.max(initial=0)).bit_length() + 7) // 8)
    raw = np.ascontiguousarray(numbers, "<i8").view(np.uint8).reshape(-1, 8)[:, :width]
    return bytes([width]) + raw.tobytes()


def unpack(packed: bytes) -> np.ndarray:
    raw = np.frombuffer(packed, np.uint8, offset=1).reshape(-1, packed[0])
    out = np.zeros((len(raw), 8), np.uint8)
    out[:, :packed[0]] = raw
    return out.view("<i8").ravel()


# ---- tables -------------------------------------------------------------------------------------------

def _blocks(docs: DataFrame, id_col: str, text_col: str, files: tuple[str, str], block_chars: int) -> DataFrame:
    """The documents with their block's number and their segments (null: no tokens); a block's first row
    has its pairs, their documents, and the ids and lengths of its segments."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizers, held, chars, rows = _tokenizers(*files), [], 0, 0
        number = TaskContext.get().partitionId() << 32

        def done() -> pa.RecordBatch:
            table = pa.Table.from_batches(held).combine_chunks()
            texts, n = table.column("_text").to_pylist(), table.num_rows
            got = Segments(texts, tokenizers)
            aligned = Aligned(tokenizers, got.a, got.b, got.lengths)
            parts = {t: p for t, p in got.parts.items() if aligned.fits[p].all()}
            docs = np.zeros(len(aligned.pairs), np.int64)
            for t, times in Counter(t for t in texts if t in parts).items():
                docs[aligned.pairs_of(parts[t])] += times  # a pair that a text repeats is added to once
            some = docs > 0
            own = [aligned.pairs[some].tobytes(), docs[some].tobytes(), pack(got.a), pack(got.b), pack(got.lengths)]
            packed = {t: pack(p) for t, p in parts.items()}
            return pa.RecordBatch.from_arrays(
                [pa.array([number] * n, pa.int64()), table.column("_id").chunk(0),
                 pa.array([packed.get(t) for t in texts], pa.binary()),
                 *[pa.array([x] + [None] * (n - 1), pa.binary()) for x in own]],
                names=["_block", "_id", "_parts", "_pairs", "_docs", "_a", "_b", "_lengths"])

        for batch in batches:
            sizes = pc.fill_null(pc.utf8_length(batch.column("_text")), 0).to_numpy()
            a = 0
            for i, size in enumerate(sizes):
                chars, rows = chars + int(size), rows + 1
                if chars >= block_chars or rows >= BLOCK_ROWS:
                    held.append(batch.slice(a, i + 1 - a))
                    yield done()
                    held, chars, rows, number, a = [], 0, 0, number + 1, i + 1
            if a < batch.num_rows:
                held.append(batch.slice(a))
        if held:
            yield done()

    narrow = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    got = narrow.mapInArrow(run, f"_block bigint, _id {id_type}, _parts binary, _pairs binary, _docs binary, "
                                "_a binary, _b binary, _lengths binary")
    return materialize(got, "align-blocks")


def _requests(blocks: DataFrame, parts: int, branches: int) -> DataFrame:
    """Per block and part: the branch of the block, and its pairs and documents there."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                pairs, docs = np.frombuffer(r["_pairs"], np.int64), np.frombuffer(r["_docs"], np.int64)
                part = (pairs >> 32) % parts
                which = np.unique(part)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(which, pa.int64()), pa.array([r["_branch"]] * len(which), pa.int64()),
                     pa.array([r["_block"]] * len(which), pa.int64()),
                     pa.array([pairs[part == p].tobytes() for p in which], pa.binary()),
                     pa.array([docs[part == p].tobytes() for p in which], pa.binary())],
                    names=["_part", "_branch", "_block", "_pairs", "_docs"])

    some = blocks.where("_pairs is not null").select("_block", "_pairs", "_docs") \
        .withColumn("_branch", F.pmod(F.xxhash64("_block"), F.lit(branches)))
    return some.mapInArrow(run, "_part bigint, _branch bigint, _block bigint, _pairs binary, _docs binary")


def _distinct_pairs(blocks: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x in batch.column("_pairs"):
                yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(x.as_py(), np.int64))], names=["_pair"])

    pairs = blocks.where("_pairs is not null").select("_pairs").mapInArrow(run, "_pair bigint")
    return materialize(pairs.distinct(), "align-pairs")


def _hashes(pairs: DataFrame, parts: int) -> DataFrame:
    """One row per part: the minimal perfect hash of its pairs."""
    def run(table: pa.Table) -> pa.Table:
        keys = np.sort(table.column("_pair").to_numpy())  # the hash does not depend on the rows' order
        sizes, bits, keys = PerfectHash.build(keys).pack()
        return pa.table({"_part": table.column("_part").slice(0, 1), "_sizes": pa.array([sizes], pa.binary()),
                         "_bits": pa.array([bits], pa.binary()), "_keys": pa.array([keys], pa.binary())})

    dealt = pairs.select((F.shiftright("_pair", 32) % parts).alias("_part"), "_pair")
    return materialize(dealt.groupBy("_part").applyInArrow(run, "_part bigint, _sizes binary, _bits binary, _keys binary"),
                       "align-hashes")


def _numbers(hashed: dict, pairs: np.ndarray) -> np.ndarray:
    n = PerfectHash.unpack(hashed["_sizes"], hashed["_bits"], hashed["_keys"]).number(pairs)
    if (n < 0).any():
        raise ValueError("a linked pair has no place in the hash")
    return n


def _counted(requests: DataFrame, hashes: DataFrame, branches: int) -> DataFrame:
    """The hashes with the count of every pair, and whether it is the highest of the pair's A id."""
    seats = hashes.withColumn("_branch", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(branches - 1).cast("bigint"))))
    schema = "_part bigint, _branch bigint, _vector binary"
    empty = pa.schema([("_part", pa.int64()), ("_branch", pa.int64()), ("_vector", pa.binary())]).empty_table()

    def add(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return empty
        one = right.to_pylist()[0]
        pairs = np.frombuffer(b"".join(left.column("_pairs").to_pylist()), np.int64)
        docs = np.frombuffer(b"".join(left.column("_docs").to_pylist()), np.int64)
        vector = np.zeros(len(one["_keys"]) // 8, np.int64)
        np.add.at(vector, _numbers(one, pairs), docs)
        return pa.table({"_part": pa.array([one["_part"]]), "_branch": pa.array([one["_branch"]]),
                         "_vector": pa.array([vector.tobytes()], pa.binary())})

    def total(table: pa.Table) -> pa.Table:
        vector = sum(np.frombuffer(v.as_py(), np.int64) for v in table.column("_vector"))
        return pa.table({"_part": table.column("_part").slice(0, 1), "_branch": table.column("_branch").slice(0, 1),
                         "_vector": pa.array([vector.tobytes()], pa.binary())})

    vectors = requests.groupBy("_part", "_branch").cogroup(seats.groupBy("_part", "_branch")).applyInArrow(add, schema)
    while branches > 1:
        vectors = vectors.withColumn("_branch", F.floor(F.col("_branch") / FAN).cast("bigint")) \
            .groupBy("_part", "_branch").applyInArrow(total, schema)
        branches = ceil(branches / FAN)

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = []
            for keys, vector in zip(batch.column("_keys"), batch.column("_vector")):
                a, count = np.frombuffer(keys.as_py(), np.int64) >> 32, np.frombuffer(vector.as_py(), np.int64)
                ids, where = np.unique(a, return_inverse=True)
                top = np.zeros(len(ids), np.int64)
                np.maximum.at(top, where, count)
                marks.append((count == top[where]).tobytes())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(marks, pa.binary())], names=[*batch.schema.names, "_best"])

    told = hashes.join(vectors.select("_part", "_vector"), "_part") \
        .select("_part", "_sizes", "_bits", "_keys", "_vector") \
        .mapInArrow(best, "_part bigint, _sizes binary, _bits binary, _keys binary, _vector binary, _best binary")
    return materialize(told, "align-counts")


def _answers(requests: DataFrame, counted: DataFrame, branches: int) -> DataFrame:
    """Per block and part: its pairs with their counts and whether each is the highest of its A id."""
    seats = counted.withColumn("_branch", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(branches - 1).cast("bigint"))))

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        counts, marks, wanted = [], [], left.column("_pairs").to_pylist()
        if wanted:
            one = right.to_pylist()[0]
            number = _numbers(one, np.frombuffer(b"".join(wanted), np.int64))
            count = np.frombuffer(one["_vector"], np.int64)[number]
            best = np.frombuffer(one["_best"], np.bool_)[number]
            at = 0
            for w in wanted:
                n = len(w) // 8
                counts.append(count[at:at + n].tobytes())
                marks.append(best[at:at + n].tobytes())
                at += n
        return pa.table({"_block": left.column("_block"), "_pairs": pa.array(wanted, pa.binary()),
                         "_counts": pa.array(counts, pa.binary()), "_best": pa.array(marks, pa.binary())})

    keys = ["_part", "_branch"]
    got = requests.select(*keys, "_block", "_pairs").groupBy(*keys).cogroup(seats.groupBy(*keys))
    return got.applyInArrow(run, "_block bigint, _pairs binary, _counts binary, _best binary")


def align_tokens(docs: DataFrame, path_a: str, path_b: str, *, id_col: str = "doc_id", text_col: str = "text",
                 groups: bool = False, block_chars: int = BLOCK_CHARS, part_keys: int = PART_KEYS,
                 branch_blocks: int = BRANCH_BLOCKS) -> DataFrame:
    """One row per input row: id, ``n_a`` and ``n_b`` (tokens), ``n_groups``, ``n_links``, ``n_best`` (links whose
    count is the highest of their A id, ties included), ``count_sum`` (counts of the links added up) and
    ``groups_sha256`` (of ``a1,a2|b1;...``); with ``groups`` also that text.

    A encodes the text with a blank before it, B the text itself.  Texts that are null or empty, or whose
    tokens' bytes are not the blank and the text (U+2581 inside), have no tokens: zeros and an empty
    digest, and they count for no pair.  Rows that repeat id and text are documents of their own; ids may
    be null.  Other columns are not read."""
    files = (path_a, path_b)
    blocks = _blocks(docs, id_col, text_col, files, block_chars)
    pairs = _distinct_pairs(blocks)
    n_pairs, n_blocks = pairs.count(), blocks.where("_pairs is not null").count()
    parts, branches = max(1, ceil(n_pairs / part_keys)), max(1, ceil(n_blocks / branch_blocks))
    requests = _requests(blocks, parts, branches)
    counted = _counted(requests, _hashes(pairs, parts), branches)
    answers = _answers(requests, counted, branches)

    id_type = docs.schema[id_col].dataType.simpleString()
    numbers = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        tokenizers, parts = _tokenizers(*files), left.column("_parts").to_pylist()
        a_ids, b_ids, lengths = (next(unpack(x) for x in left.column(c).to_pylist() if x is not None) for c in ("_a", "_b", "_lengths"))
        aligned = Aligned(tokenizers, a_ids, b_ids, lengths)
        keys = np.frombuffer(b"".join(right.column("_pairs").to_pylist()), np.int64)
        order = np.argsort(keys)
        at = np.searchsorted(aligned.pairs, keys[order])
        if not np.array_equal(aligned.pairs[at], keys[order]):
            raise ValueError("a block's pairs are not the ones that were looked up")

        def told(column, dtype):
            """What was looked up for the pairs, summed over each segment's links (pairs of no document have no part)."""
            values = np.zeros(len(aligned.pairs), np.int64)
            values[at] = np.frombuffer(b"".join(right.column(column).to_pylist()), dtype)[order]
            return aligned.summed(values)

        count, best, named = told("_counts", np.int64), told("_best", np.bool_), aligned.groups()
        rows, known = [], {None: ([0] * 6, "", "")}
        for packed in parts:
            if packed not in known:
                p = unpack(packed)
                n_a, n_b, n_groups = (int(x[p].sum()) for x in (aligned.n_a, aligned.n_b, aligned.n_groups))
                text = ";".join([named[i] for i in p])
                known[packed] = ([n_a, n_b, n_groups, n_a + n_b - n_groups, int(best[p].sum()), int(count[p].sum())],
                                 hashlib.sha256(text.encode()).hexdigest(), text if groups else None)
            rows.append(known[packed])
        cols = {"_id": left.column("_id")}
        for i, name in enumerate(numbers):
            cols[name] = pa.array([r[0][i] for r in rows], pa.int64())
        cols["groups_sha256"] = pa.array([r[1] for r in rows], pa.string())
        if groups:
            cols["groups"] = pa.array([r[2] for r in rows], pa.string())
        return pa.table(cols)

    schema = f"_id {id_type}, " + ", ".join(f"{n} bigint" for n in numbers) + ", groups_sha256 string" + \
        (", groups string" if groups else "")
    got = blocks.drop("_pairs", "_docs").groupBy("_block").cogroup(answers.groupBy("_block")).applyInArrow(run, schema)
    return got.withColumnRenamed("_id", id_col)
