"""Benchmark decontamination with one Aho-Corasick automaton over the normalised items.

Texts are normalised to lower-cased words joined by single blanks, where a word is a
run of bytes that are ASCII letters, digits or non-ASCII.  The patterns are the
windows of ``window`` consecutive words of every item (a shorter item is one window),
enclosed in blanks so that a match starts and ends at word borders.  Each text is
scanned once; a match gives its last word, its length in words gives the first, and
word borders kept from the normalisation map both back to places in the original.

The automaton holds every distinct window, with the items that have it.  Its size
follows the benchmark, not the corpus.  Items are taken in groups of at most
``pattern_bytes`` of normalised text; a larger benchmark is scanned group by group,
so the automaton in a task's memory stays bounded whatever the benchmark's size.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlens.llm.common import byte_view

WINDOW = 10
#: Normalised item text in one automaton; a window of ten words takes about 60 bytes of nodes per byte.
PATTERN_BYTES = 1 << 20

_WORD = bytes(b for b in range(256) if 0x30 <= b <= 0x39 or 0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A or b >= 0x80)
_FOLD = bytes((b | 0x20 if 0x41 <= b <= 0x5A else b) if b in _WORD else 0x20 for b in range(256))
_IS_WORD = np.array([b in _WORD for b in range(256)])


def words(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


def windows(item: bytes, size: int) -> set[bytes]:
    w = words(item)
    if not w:
        return set()
    return {b" ".join(w[i:i + size]) for i in range(max(1, len(w) - size + 1))}


def word_spans(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and end byte of each word of a UTF-8 text."""
    edge = np.diff(np.concatenate(([0], _IS_WORD[text].view(np.int8), [0])))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


class Matcher:
    """The automaton of one group of items: ``scan`` gives word ranges and items of a text."""

    def __init__(self, items: list[tuple[object, str | None]], size: int):
        owners: dict[bytes, set[int]] = {}
        for k, (_, text) in enumerate(items):
            for w in windows((text or "").encode(), size):
                owners.setdefault(w, set()).add(k)
        self.auto = ahocorasick.Automaton()
        for w, ks in owners.items():
            # one character per byte, so that places in the scanned string are byte places
            self.auto.add_word(f" {w.decode('latin-1')} ", (w.count(b" ") + 1, tuple(ks)))
        self.any = bool(owners)
        if self.any:
            self.auto.make_automaton()

    def scan(self, text: bytes) -> tuple[int, list[tuple[int, int]], set[int]]:
        """Number of words, hit word ranges [a, b) in order of their ends, and matched items."""
        w = text.translate(_FOLD).split()
        if not w or not self.any:
            return len(w), [], set()
        flat = f" {b' '.join(w).decode('latin-1')} "
        ends, found, items = [], [], set()
        for at, (n, ks) in self.auto.iter(flat):
            ends.append(at)
            found.append(n)
            items.update(ks)
        if not ends:
            return len(w), [], items
        blanks = np.flatnonzero(np.frombuffer(flat.encode("latin-1"), np.uint8) == 0x20)
        last = np.searchsorted(blanks, ends)  # the k-th blank (from 0) closes word k-1
        return len(w), [(int(e) - n, int(e)) for e, n in zip(last, found)], items


def merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _groups(items: DataFrame, most: int) -> Iterator[list[tuple[object, str | None]]]:
    """Items in groups of at most ``most`` bytes of text, fetched partition by partition."""
    group, held = [], 0
    for r in items.toLocalIterator():
        n = len((r["_text"] or "").encode())
        if group and held + n > most:
            yield group
            group, held = [], 0
        group.append((r["_item"], r["_text"]))
        held += n
    if group:
        yield group


def decontaminate(docs: DataFrame, items: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW,
                  pattern_bytes: int = PATTERN_BYTES) -> DataFrame:
    """One row per input row: id, ``n_words``, ``n_hit`` (words inside a window's occurrence),
    ``items`` (array of matched item ids), ``spans`` (array of the hit places as half-open byte
    ranges ``(start, end)`` of the original UTF-8 text, hit words and what lies between them).

    A null text has no words; an item without words has no window; no items means no hits.
    Repeated items each count; repeated rows and null ids give a row each.  Other columns are
    not read.  There is no shuffle for one group of items; each further group adds a scan of the
    rows that carries the hits so far.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    item_type = items.schema[item_col].dataType.simpleString()
    frame = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"),
                        F.lit(0).cast("bigint").alias("n_words"),
                        F.lit(None).cast(f"array<{item_type}>").alias("items"),
                        F.lit(None).cast("array<struct<a:bigint,b:bigint>>").alias("hits"))
    named = items.select(F.col(item_col).alias("_item"), F.col(item_text_col).alias("_text"))
    groups = list(_groups(named, pattern_bytes)) or [[]]
    for k, group in enumerate(groups):
        frame = _scan(frame, group, window, id_type, item_type, last=k == len(groups) - 1)
    return frame.select(
        F.col("_id").alias(id_col), "n_words",
        F.aggregate("hits", F.lit(0).cast("bigint"), lambda n, h: n + h["b"] - h["a"]).alias("n_hit"), "items", "spans")


def _scan(frame: DataFrame, group, window: int, id_type: str, item_type: str, last: bool) -> DataFrame:
    names = [k for k, _ in group]

    def run(batches):
        matcher = Matcher(group, window)
        for batch in batches:
            data, offsets = byte_view(batch.column("_text"))
            raw = data.tobytes()
            n_words, item_lists, hits, spans = [], [], [], []
            before = zip(batch.column("items").to_pylist(), batch.column("hits").to_pylist())
            for i, (had_items, had_hits) in enumerate(before):
                n, found, ks = matcher.scan(raw[offsets[i]:offsets[i + 1]])
                n_words.append(n)
                item_lists.append((had_items or []) + [names[k] for k in sorted(ks)])
                found = merged(found + [(h["a"], h["b"]) for h in had_hits or []])
                hits.append([{"a": a, "b": b} for a, b in found])
                if found:
                    starts, ends = word_spans(data[offsets[i]:offsets[i + 1]])
                    spans.append([{"start": int(starts[a]), "end": int(ends[b - 1])} for a, b in found])
                else:
                    spans.append([])
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), pa.nulls(len(n_words), pa.string()) if last else batch.column("_text"),
                 pa.array(n_words, pa.int64()),
                 pa.array(item_lists, batch.schema.field("items").type),
                 pa.array(hits, pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))),
                 pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))],
                names=["_id", "_text", "n_words", "items", "hits", "spans"])

    return frame.select("_id", "_text", "n_words", "items", "hits").mapInArrow(
        run, f"_id {id_type}, _text string, n_words bigint, items array<{item_type}>, "
             "hits array<struct<a:bigint,b:bigint>>, spans array<struct<start:bigint,end:bigint>>")
