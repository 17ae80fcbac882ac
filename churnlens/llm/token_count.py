"""Token counts of whole texts, long ones by overlapping chunks that resynchronise.

Texts up to ``chunk`` characters are cut at their single blanks, and the distinct parts of a batch are
encoded (SentencePiece files: the whole texts).  A longer one is cut into
chunks that overlap; each is encoded with offsets and neighbours are spliced at a
place inside their overlap that is proven stable.  A place is a candidate when a
visible character stands before it and exactly one white space followed by a visible
character stands after it, or a letter before it and a full-width punctuation mark after
it: the pre-token pattern cannot match across a change from a visible character to white
space, nor from a letter to such a mark, so whatever stands left of the place has no
influence on the tokens right of it and the other way round, and no added token
holds white space.  (SentencePiece files: single blanks only.)  It is proven when no token of either encoding lies across it
and both encodings give the same ids between it and the end of the overlap's
agreed stretch.  Where an overlap holds no such place, it is widened (doubled), and where the whole
chunk holds none, the chunk is.
"""

from __future__ import annotations

import os
import re
from bisect import bisect_right
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlens.llm.common import byte_view

CHUNK_CHARS = 32_768
OVERLAP_CHARS = 256
#: Ids compared on each side of a splice.
AGREE = 8
# Marks that end a run of letters in pre-token patterns and begin no contraction.
_MARKS = "\u3002\uff01\uff1f\uff0c\u3001\uff1b\uff1a"
_PLACE, _BLANK = re.compile(rf"[ \n\t\r{_MARKS}]"), re.compile(" ")


class Encoded:
    """Ids of a chunk and their places ``(start, end)``, which rise; ``base`` is where the chunk begins."""

    __slots__ = ("ids", "places", "base")

    def __init__(self, ids: list[int], places: list[tuple[int, int]], base: int = 0):
        self.ids, self.places, self.base = ids, places, base

    def until(self, x: int) -> int:
        """Number of tokens that end at or before place ``x`` of the text."""
        return bisect_right(self.places, x - self.base, key=lambda p: p[1])

    def parts(self, x: int) -> bool:
        """No token lies across ``x``."""
        i = self.until(x)
        return i == len(self.places) or self.places[i][0] >= x - self.base


class TokenizerFile:
    """A tokenizer file behind one interface: ``counts`` of texts, ``offsets`` of one text."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.sentencepiece = path.endswith(".model")
        if self.sentencepiece:
            import sentencepiece
            self.lib = sentencepiece.SentencePieceProcessor(model_file=path)
        else:
            from tokenizers import Tokenizer
            self.lib = Tokenizer.from_file(path)
            self.lib.no_truncation()
            self.lib.no_padding()

    def counts(self, texts: list[str]) -> list[int]:
        if self.sentencepiece:
            return [len(x) for x in self.lib.encode(texts, num_threads=1)] if texts else []
        return [len(x) for x in self.lib.encode_batch_fast(texts, add_special_tokens=False)]

    def offsets(self, text: str) -> Encoded:
        if self.sentencepiece:
            pieces = self.lib.encode(text, return_type="proto").pieces
            return Encoded([p.id for p in pieces], [(p.begin, p.end) for p in pieces])
        e = self.lib.encode(text, add_special_tokens=False)
        return Encoded(e.ids, e.offsets)


def candidates(text: str, a: int, b: int, blanks_only: bool = False) -> Iterator[int]:
    """Places x in (a, b) where a pre-token ends whatever stands on either side of its neighbours: a visible character,
    then one white space, then a visible character; or a letter before a full-width punctuation mark."""
    for m in (_BLANK if blanks_only else _PLACE).finditer(text, a + 1, b - 1):
        x = m.start()
        before, after = text[x - 1], text[x + 1]
        if m.group() in _MARKS:
            if before.isalpha():
                yield x
        elif before != " " != after and before.isprintable() and after.isprintable():
            yield x


def splice(left: Encoded, right: Encoded, places: Iterable[int]) -> int | None:
    """The first place where both encodings have a token boundary and agree on the ids that follow."""
    for x in places:
        if left.parts(x) and right.parts(x):
            i, j = left.until(x), right.until(x)
            la, ra = left.ids[i:i + AGREE], right.ids[j:j + AGREE]
            n = max(1, min(len(la), len(ra)) - 2)  # the last tokens of a chunk may be cut by its end
            if la and ra and la[:n] == ra[:n]:
                return x
    return None


def chunked_ids(text: str, encode: Callable[[str], Encoded], chunk: int = CHUNK_CHARS,
                overlap: int = OVERLAP_CHARS, blanks_only: bool = False) -> list[int]:
    """Ids of ``text``, the same as encoding it whole, from chunks of about ``chunk`` characters.

    Where a chunk has no place to splice at it is made twice as long, so that a text without any is
    encoded at most twice over."""
    n, out = len(text), []
    start, end = 0, min(chunk, n)
    current = encode(text[:end])
    taken = 0  # place up to which tokens are in ``out``
    while end < n:
        width, x, follow = overlap, None, None
        while True:
            begin = max(end - width, taken)
            places = list(candidates(text, max(begin, taken) + 1, end - min(overlap // 4, width // 4), blanks_only))
            if places:
                stop = min(end + chunk, n)
                follow = encode(text[begin:stop])
                follow.base = begin
                # half of the overlap lies before the place, so that tokens on both sides are seen by both
                x = splice(current, follow, places)
                if x is not None:
                    break
            if begin > taken:  # no place, or none that is proven: look further back
                width *= 2
                continue
            end = min(end + max(chunk, end - taken), n)  # nothing left of the chunk to fall back on: lengthen it instead
            current = encode(text[taken:end])
            current.base = taken
            if end == n:
                break
            width = overlap
        if x is None:
            break
        out.extend(current.ids[current.until(taken) if taken else 0:current.until(x)])
        taken, current, end = x, follow, stop
    out.extend(current.ids[current.until(taken) if taken else 0:])
    return out


_BETWEEN = re.compile(r"(?<=\S) (?=\S)")


def part_counts(texts: list[str], counts: Callable[[list[str]], list[int]]) -> np.ndarray:
    """Token counts of non-empty texts: they are cut at all blanks between visible characters, where a pre-token begins
    whatever stands beside it, and every distinct part is encoded once."""
    parts = []
    for t in texts:
        words = t.split(" ")
        parts.append(words if words == t.split() else _BETWEEN.split(t))

    def each(names: list[str]) -> np.ndarray:
        return np.array([n for s in range(0, len(names), 1024) for n in counts(names[s:s + 1024])], np.int64)

    words = pa.array([w for p in parts for w in p], pa.large_string()).dictionary_encode()
    first = pa.array([p[0] for p in parts], pa.large_string()).dictionary_encode()
    inner = each([" " + w for w in words.dictionary.to_pylist()])[words.indices.to_numpy()]
    starts = np.cumsum([0, *(len(p) for p in parts)])[:-1]
    # only a text's first part has no blank before it
    return np.add.reduceat(inner, starts) - inner[starts] + each(first.dictionary.to_pylist())[first.indices.to_numpy()]


_LOADED: dict[str, TokenizerFile] = {}


def _slices(sizes: list[int], most: int = 8 << 20) -> Iterator[tuple[int, int]]:
    """Runs of texts of about ``most`` characters."""
    a, total = 0, 0
    for i, size in enumerate(sizes):
        total += size
        if total >= most:
            yield a, i + 1
            a, total = i + 1, 0
    if a < len(sizes):
        yield a, len(sizes)


def _tokenizer(path: str) -> TokenizerFile:
    if path not in _LOADED:
        _LOADED[path] = TokenizerFile(path)
    return _LOADED[path]


def count_tokens(docs: DataFrame, tokenizer_path: str, *, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = 512, chunk: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS) -> DataFrame:
    """One row per input row: id, ``n_bytes`` (UTF-8), ``n_tokens``, ``over_limit`` (more than ``limit``).

    Null and empty texts have zero of both.  Repeated rows and null ids give a row each.
    SentencePiece files (``.model``) rewrite white space at a chunk's start, so there a long text with
    other white space than single blanks inside is encoded whole, in memory that grows with its length.
    Only the id and the text are read, so other columns may have any name.  A row is
    counted where it lies: there is no shuffle, and a lost task is run again alone.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    narrow = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    schema = pa.schema([("n_tokens", pa.int64())])

    def run(batches):
        tok = _tokenizer(tokenizer_path)
        for batch in batches:
            texts = batch.column("_text").to_pylist()
            known = {t: 0 for t in texts}  # a text that a batch repeats is encoded once
            short = [t for t in known if t and len(t) <= chunk]
            for a, b in _slices([len(t) for t in short]):
                found = tok.counts(short[a:b]) if tok.sentencepiece else part_counts(short[a:b], tok.counts).tolist()
                known.update(zip(short[a:b], found))
            for t in known:
                if t and len(t) > chunk:
                    whole = tok.sentencepiece and t != " ".join(t.split())
                    known[t] = tok.counts([t])[0] if whole else len(chunked_ids(t, tok.offsets, chunk, overlap, tok.sentencepiece))
            counts = np.array([known[t] for t in texts], np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), pa.array(np.diff(byte_view(batch.column("_text"))[1])),
                 pa.array(counts, schema.field(0).type)], names=["_id", "n_bytes", "n_tokens"])

    got = narrow.mapInArrow(run, f"_id {id_type}, n_bytes bigint, n_tokens bigint")
    return got.select(F.col("_id").alias(id_col), "n_bytes", "n_tokens",
                      (F.col("n_tokens") > limit).alias("over_limit"))

