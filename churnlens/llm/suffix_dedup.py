"""Removal of long repeated passages by longest-previous-factor arrays.

A place of a text is a copy if the ``window`` bytes that start there also start at an
earlier place of the corpus (longest previous factor of at least ``window``).  In
suffix order, truncated at ``window`` bytes, the best earlier match of a place is its
previous or its next smaller place; equally the best later match is its previous or
next larger one.  So one suffix array of all places would answer the question; here it
is cut into many small ones that hold every pair that can match:

1. Each window's anchor is the place of the least hash of its byte 16-grams within its first
   ``reach`` bytes, the last of equals.  Equal windows have their anchors at the same
   offset, and neighbouring windows share one, so a stretch of windows becomes a row: its
   anchor's key (a hash of the bytes from the anchor on that all these windows hold)
   and a digest of all bytes that the stretch covers.
2. Stretches with equal digests that one batch of texts has are copies at once: the first stands
   for them, so a passage that many texts share leaves a batch once.  The others and the rows
   that are left are shuffled by key.  A key met once: no copies.  Rows with equal digests are
   copies of each other in whole, and are settled; one of them stays as their proxy.
   What is left are keys with several digests, at the ends of repeated passages.
3. The bytes of those stretches are fetched by a join with the texts and grouped by key;
   suffix array, previous and next smaller (and larger) places decide each window.
   A key with more than ``most`` stretches is not collected in one task: each of
   its windows becomes a row with the window's digest, and equal ones are found by sorting.
4. Copied windows are gathered per text, and the bytes that they cover go.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from churnlens.llm.common import byte_view
from churnlens.session import materialize

WINDOW = 400
GRAM = 16
REACH = 256
PIECE = 1 << 19       # window starts of a text that are hashed at once
BATCH_BYTES = 2 << 20  # bytes under one suffix array
MOST_STRETCHES = 4096  # of one key in one task


# ---------------------------------------------------------------- anchors

def stretches(x: np.ndarray, window: int, reach: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and last window start and the anchor of each stretch of windows of a text."""
    out = []
    for s in range(0, max(len(x) - window + 1, 0), PIECE):
        part = x[s:s + PIECE + window - 1]
        lo, hi, at = _stretches(part, window, reach - gram + 1, gram)
        out.append((lo + s, hi + s, at + s))
    if not out:
        return (np.zeros(0, np.int64),) * 3
    return tuple(np.concatenate(v) for v in zip(*out))


def _stretches(x, window, span, gram):
    h, width, power = x.astype(np.uint64) + np.uint64(1), 1, 0x9E3779B97F4A7C15
    while width < gram:
        h = h[:-width] * np.uint64(power) + h[width:]
        power, width = (power * power + 2) % (1 << 64), 2 * width
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    low = np.uint64((1 << 24) - 1)  # the place in the low bits makes the last of equals the least
    least = (h & ~low) | (low - np.arange(len(h), dtype=np.uint64))
    size = 1
    while 2 * size <= span:
        least, size = np.minimum(least[:-size], least[size:]), 2 * size
    if size < span:
        least = np.minimum(least[:len(least) - (span - size)], least[span - size:])
    at = (low - (least & low)).astype(np.int64)[:len(x) - window + 1]
    lo = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
    return lo, np.append(lo[1:], len(at)) - 1, at[lo]


def anchor_rows(text: bytes, x: np.ndarray, window: int, reach: int, gram: int):
    """(key, digest in 64 + 32 bits, lo, hi, anchor, repeats) of each stretch.  A stretch of one window that
    repeats from byte to byte (a run of one character) is one row with its number of repeats."""
    lo, hi, at = stretches(x, window, reach, gram)
    n, common = len(lo), window - (reach - gram)
    key = np.fromiter((xxhash.xxh3_64_intdigest(text[a:a + common]) for a in at.tolist()), np.uint64, n)
    full = b"".join(xxhash.xxh3_128_digest(text[a:b + window], seed=p - a)
                    for a, b, p in zip(lo.tolist(), hi.tolist(), at.tolist()))
    full = np.frombuffer(full, np.uint64).reshape(n, 2)
    again = np.zeros(n, bool)
    if n > 1:
        again[1:] = (lo == hi)[1:] & (lo == hi)[:-1] & (lo[1:] == lo[:-1] + 1) & (full[1:] == full[:-1]).all(1)
    first = np.flatnonzero(~again)
    repeats = np.diff(np.append(first, n))
    return (key[first].view(np.int64), full[first, 0].view(np.int64), (full[first, 1] & np.uint64(0x7FFFFFFF)).astype(np.int32),
            lo[first].astype(np.int64), hi[first].astype(np.int64), at[first].astype(np.int64), repeats.astype(np.int32))


# ---------------------------------------------------------------- suffix arrays

def _dense(order: np.ndarray, differs: np.ndarray) -> np.ndarray:
    rank = np.empty(len(order), np.int64)
    rank[order] = np.concatenate(([0], np.cumsum(differs)))
    return rank


def _ranks(key: np.ndarray) -> np.ndarray:
    order = np.argsort(key)
    s = key[order]
    return _dense(order, s[1:] != s[:-1])


def suffix_order(x: np.ndarray, starts: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts in suffix order, truncated at ``window`` bytes (equal ones by place), and the number of its class
    for each.  Prefix doubling over all places; every start has ``window`` bytes."""
    if window >= 8:
        word, width = x.astype(np.uint64), 1
        while width < 8:
            word, width = (word[:-width] << np.uint64(8 * width)) | word[width:], 2 * width
        rank = _ranks(word)
    else:
        rank, width = x.astype(np.int64), 1
    while 2 * width <= window:
        rank = _ranks(rank[:-width] * np.int64(len(x) + 256) + rank[width:])
        width *= 2
    key = rank[starts] * np.int64(len(x) + 256) + rank[starts + window - width]
    order = np.argsort(key, kind="stable")
    s = key[order]
    return order, np.concatenate(([0], np.cumsum(s[1:] != s[:-1]))) if len(s) else s


def nearest_before(value: np.ndarray, group: np.ndarray) -> np.ndarray:
    """Index of the previous smaller value within the same run of ``group``, or -1.  Each round jumps over what
    the element before has jumped already, so a few rounds do."""
    i = np.arange(len(value))
    j = i - 1
    while True:
        inside = j >= 0
        inside[inside] = group[j[inside]] == group[i[inside]]
        larger = inside.copy()
        larger[inside] = value[j[inside]] > value[i[inside]]
        if not larger.any():
            return np.where(inside, j, -1)
        j = np.where(larger, j[j], np.where(inside, j, -1))


def matches(x: np.ndarray, starts: np.ndarray, place: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Whether each start's longest previous (and longest next) factor has ``window`` bytes at least; ``place``
    orders the starts."""
    earlier, later = np.zeros(len(starts), bool), np.zeros(len(starts), bool)
    if not len(starts):
        return earlier, later
    order, group = suffix_order(x, starts, window)
    value = place[order]
    back = slice(None, None, -1)
    earlier[order] = (nearest_before(value, group) >= 0) | (nearest_before(value[back], group[back]) >= 0)[back]
    later[order] = (nearest_before(-value, group) >= 0) | (nearest_before(-value[back], group[back]) >= 0)[back]
    return earlier, later


# ---------------------------------------------------------------- the job

def _ids(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows that repeat both id and text share (_id, _h): they are copies of each other all the same."""
    return docs.select(F.col(id_col).alias("_id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("_h"),
                       F.col(text_col).alias("_text"))


def _anchors(rows: DataFrame, id_type: str, window: int, reach: int, gram: int, keep_first: bool) -> DataFrame:
    names = ["_k", "_f", "_g", "_lo", "_hi", "_at", "_rep"]

    def run(batches):
        for batch in batches:
            data, offsets = byte_view(batch.column("_text"))
            ids, texts = batch.column("_id").to_pylist(), batch.column("_h").to_pylist()
            held, owner, size = [], [], 0
            for i in range(len(offsets) - 1):
                x = data[offsets[i]:offsets[i + 1]]
                if len(x) < window:
                    continue
                held.append(anchor_rows(x.tobytes(), x, window, reach, gram))
                owner.append(np.full(len(held[-1][0]), i))
                size += len(owner[-1])
                if size > 50_000:
                    yield _out(batch, ids, texts, held, owner)
                    held, owner, size = [], [], 0
            if held:
                yield _out(batch, ids, texts, held, owner)

    def _out(batch, ids, texts, held, owner):
        at = np.concatenate(owner)
        cols = dict(zip(names, (np.concatenate(v) for v in zip(*held))))
        # texts of the batch in corpus order
        said = sorted(set(at.tolist()), key=lambda i: ((x := ids[i]) is None, x if x is not None else 0, texts[i]))
        place = np.zeros(batch.num_rows, np.int64)
        for n, i in enumerate(said):  # rows that repeat id and text share a place
            place[i] = n if not n or (ids[i], texts[i]) != (ids[said[n - 1]], texts[said[n - 1]]) else place[said[n - 1]]
        order = np.lexsort((cols["_lo"], place[at], cols["_g"], cols["_f"], cols["_k"]))
        same = np.zeros(len(at), bool)
        same[1:] = np.logical_and.reduce([cols[c][order][1:] == cols[c][order][:-1] for c in ("_k", "_f", "_g")])
        first = np.flatnonzero(~same)
        size = np.diff(np.append(first, len(at)))
        proxy = order[np.repeat(first, size)]
        told = np.empty(len(at), bool)  # settled: a copy of the batch's first
        told[order] = same & ((place[at][order] != place[at][proxy]) | (cols["_lo"][order] != cols["_lo"][proxy])
                              | (not keep_first))
        more = np.empty(len(at), bool)
        more[order] = np.repeat(size > 1, size)
        spread = np.arange(len(at)).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        cols["_k"] = np.where(told, cols["_k"] ^ spread.view(np.int64), cols["_k"])  # they need not meet anything
        rows_at = pa.array(at)
        return pa.RecordBatch.from_arrays(
            [batch.column("_id").take(rows_at), batch.column("_h").take(rows_at), *map(pa.array, cols.values()),
             pa.array(told), pa.array(more)], names=["_id", "_h", *names, "_told", "_more"])

    return rows.mapInArrow(run, f"_id {id_type}, _h bigint, _k bigint, _f bigint, _g int, _lo bigint, _hi bigint, "
                                "_at bigint, _rep int, _told boolean, _more boolean")


def copied_windows(rows: DataFrame, *, window: int = WINDOW, reach: int = REACH, gram: int = GRAM,
                   keep_first: bool = True, most: int = MOST_STRETCHES) -> DataFrame:
    """(_id, _h, _lo, _hi): stretches of window starts of a text that have an earlier copy (``keep_first``) or
    any other copy."""
    id_type = rows.schema["_id"].dataType.simpleString()
    order = [F.col("_id").isNull(), "_id", "_h", "_lo"]
    by_key = Window.partitionBy("_k").orderBy("_f", "_g", *order)
    whole = Window.partitionBy("_k")
    full, me = F.struct("_f", "_g"), F.struct("_id", "_h", "_lo")
    by_digest = Window.partitionBy("_k", "_f", "_g").orderBy(*order)  # the same shuffle and sort serve all three
    prev, nxt = (F.coalesce(full == f(full).over(by_key), F.lit(False)) for f in (F.lag, F.lead))
    told = _anchors(rows, id_type, window, reach, gram, keep_first) \
        .withColumn("_after", prev).withColumn("_before", nxt) \
        .withColumn("_later", ~me.eqNullSafe(F.first(me).over(by_digest))) \
        .withColumn("_many", F.min(full).over(whole) != F.max(full).over(whole)) \
        .select("_k", "_id", "_h", "_lo", "_hi", "_at", "_rep",
                (F.col("_told") | F.col("_later" if keep_first else "_more") | (
                    F.lit(False) if keep_first else F.col("_after") | F.col("_before") | (F.col("_rep") > 1))).alias("_copy"),
                (~F.col("_told") & ~F.col("_after") & F.col("_many")).alias("_open")) \
        .where("_copy or _open or _rep > 1")
    told = materialize(told, "passage-stretches")
    end = F.col("_hi") + F.col("_rep") - 1
    settled = told.where("_copy").select("_id", "_h", "_lo", end.alias("_hi"))
    if keep_first:  # within a run of one character all starts but the first have an earlier copy
        settled = settled.unionAll(told.where("not _copy and _rep > 1")
                                   .select("_id", "_h", (F.col("_lo") + 1).alias("_lo"), end.alias("_hi")))
    opened = told.where("_open")
    crowded = opened.groupBy("_k").agg(F.count(F.lit(1)).alias("_n")) \
        .select("_k", (F.col("_n") > most).alias("_crowd"))
    per_text = opened.join(crowded, "_k").groupBy("_id", "_h").agg(  # as many as the text has stretches
        F.collect_list(F.struct("_k", "_lo", "_hi", "_crowd")).alias("_open"))
    return settled.unionAll(_decide(_bodies(rows, per_text, id_type, window), id_type, window, keep_first))


def _bodies(rows: DataFrame, per_text: DataFrame, id_type: str, window: int) -> DataFrame:
    """Bytes of the open stretches; windows of crowded keys as digests, one row each."""
    texts = rows.where(F.octet_length("_text") >= window).withColumnRenamed("_id", "_i").withColumnRenamed("_h", "_j")
    joined = per_text.join(texts, F.col("_id").eqNullSafe(F.col("_i")) & (F.col("_h") == F.col("_j"))) \
        .select("_id", "_h", "_open", "_text")

    def run(batches):
        for batch in batches:
            data, offsets = byte_view(batch.column("_text"))
            rows_at, key, lo, hi, body, single, held = [], [], [], [], [], [], 0
            for i, opened in enumerate(batch.column("_open").to_pylist()):
                text = data[offsets[i]:offsets[i + 1]].tobytes()
                for s in opened:
                    if s["_crowd"]:
                        for a in range(s["_lo"], s["_hi"] + 1):
                            d = xxhash.xxh3_128_digest(text[a:a + window])
                            rows_at.append(i), key.append(int.from_bytes(d[:8], "little", signed=True))
                            lo.append(a), hi.append(a), body.append(d), single.append(True)
                            held += 40
                    else:
                        b = text[s["_lo"]:s["_hi"] + window]
                        rows_at.append(i), key.append(s["_k"])
                        lo.append(s["_lo"]), hi.append(s["_hi"]), body.append(b), single.append(False)
                        held += len(b)
                    if held > 4 << 20:
                        yield _out(batch, rows_at, key, lo, hi, body, single)
                        rows_at, key, lo, hi, body, single, held = [], [], [], [], [], [], 0
            if rows_at:
                yield _out(batch, rows_at, key, lo, hi, body, single)

    def _out(batch, rows_at, key, lo, hi, body, single):
        at = pa.array(rows_at, pa.int64())
        return pa.RecordBatch.from_arrays(
            [batch.column("_id").take(at), batch.column("_h").take(at), pa.array(key, pa.int64()), pa.array(lo, pa.int64()),
             pa.array(hi, pa.int64()), pa.array(body, pa.binary()), pa.array(single)],
            names=["_id", "_h", "_k", "_lo", "_hi", "_body", "_single"])

    return joined.mapInArrow(run, f"_id {id_type}, _h bigint, _k bigint, _lo bigint, _hi bigint, _body binary, _single boolean")


def _decide(bodies: DataFrame, id_type: str, window: int, keep_first: bool) -> DataFrame:
    schema = f"_id {id_type}, _h bigint, _lo bigint, _hi bigint"
    names = ["_id", "_h", "_lo", "_hi"]

    def arrays(batches):
        """Whole keys of some BATCH_BYTES at a time (rows come sorted by key and then in corpus order)."""
        held, size = [], 0
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("_k", "_id", "_h", "_lo", "_hi", "_body"))):
                if keep_first and held and row[:4] == held[-1][:4]:
                    continue  # a row that repeats id and text
                if size > BATCH_BYTES and held and row[0] != held[-1][0]:
                    yield decide(held)
                    held, size = [], 0
                held.append(row)
                size += len(row[-1])
        if held:
            yield decide(held)

    def decide(held):
        x = np.frombuffer(b"".join(r[5] for r in held), np.uint8)
        sizes = np.array([len(r[5]) for r in held])
        counts = sizes - window + 1
        base = np.concatenate(([0], np.cumsum(sizes)[:-1]))
        first = np.concatenate(([0], np.cumsum(counts)[:-1]))
        starts = np.repeat(base - first, counts) + np.arange(int(counts.sum()))
        # places in corpus order: by id, text and start, whatever key the stretch is under
        rank = {k: n for n, k in enumerate(sorted({(r[1] is None, r[1] if r[1] is not None else 0, r[2]) for r in held}))}
        text = np.array([rank[(r[1] is None, r[1] if r[1] is not None else 0, r[2])] for r in held])
        inner = np.repeat(np.array([r[3] for r in held]) - first, counts) + np.arange(len(starts))
        place = np.empty(len(starts), np.int64)
        place[np.lexsort((inner, np.repeat(text, counts)))] = np.arange(len(starts))
        earlier, later = matches(x, starts, place, window)
        hit = earlier if keep_first else earlier | later
        out = [[], [], [], []]
        for r, f, n in zip(held, first.tolist(), counts.tolist()):
            m = hit[f:f + n]
            if m.any():
                edge = np.diff(np.concatenate(([0], m.view(np.int8), [0])))
                for a, b in zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist()):
                    for col, v in zip(out, (r[1], r[2], r[3] + a, r[3] + b - 1)):
                        col.append(v)
        return out

    def run(batches):
        types = []

        def seen():
            for batch in batches:
                types[:] = [batch.schema.field("_id").type, pa.int64(), pa.int64(), pa.int64()]
                yield batch

        for out in arrays(seen()):
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out, types)], names=names)

    order = [F.col("_id").isNull(), "_id", "_h", "_lo"]
    by_array = bodies.where("not _single").repartition("_k").sortWithinPartitions("_k", *order).mapInArrow(run, schema)
    same, me = Window.partitionBy("_k", "_body").orderBy(*order), F.struct("_id", "_h", "_lo")
    singles = bodies.where("_single").select(
        *names, F.lag("_lo").over(same).isNotNull().alias("_after"), F.lead("_lo").over(same).isNotNull().alias("_before"),
        (~me.eqNullSafe(F.first(me).over(same))).alias("_later"))
    singles = singles.where("_later" if keep_first else "_after or _before").select(*names)
    return by_array.unionAll(singles)



def remove_passages(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                    reach: int = REACH, gram: int = GRAM, keep_first: bool = True,
                    most: int = MOST_STRETCHES) -> DataFrame:
    """One row per input row: id, ``n_bytes``, ``spans`` (array of the maximal removed byte ranges
    ``(start, end)``, half-open) and ``kept`` (the other bytes).

    A byte goes if a ``window``-byte string that covers it has a copy: an earlier one (``keep_first``: the
    first stays) or any other one.  Earlier is by id (null last), then by the text's hash, then by place; texts
    are judged as they come in, copies may overlap and lie in the same text, and never go across texts.  Null
    is empty; texts shorter than the window lose nothing.  Rows that repeat both id and text: without
    ``keep_first`` all copies go; with it they get the same result, as one row."""
    rows = _ids(docs, id_col, text_col)
    id_type = rows.schema["_id"].dataType.simpleString()
    copied = copied_windows(rows, window=window, reach=reach, gram=gram, keep_first=keep_first, most=most)
    per_text = copied.groupBy("_id", "_h").agg(F.collect_set(F.struct("_lo", "_hi")).alias("_cut")) \
        .withColumnRenamed("_id", "_i").withColumnRenamed("_h", "_j")
    joined = rows.join(per_text, F.col("_id").eqNullSafe(F.col("_i")) & (F.col("_h") == F.col("_j")), "left") \
        .select("_id", "_text", "_cut")

    def run(batches):
        span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            data, offsets = byte_view(batch.column("_text"))
            spans, kept = [], []
            for i, cut in enumerate(batch.column("_cut").to_pylist()):
                x, here = data[offsets[i]:offsets[i + 1]], []
                for a, b in sorted((c["_lo"], c["_hi"] + window) for c in cut or []):
                    if here and a <= here[-1][1]:
                        here[-1][1] = max(b, here[-1][1])
                    else:
                        here.append([a, b])
                raw, at, out = x.tobytes(), 0, []
                for a, b in here:
                    out.append(raw[at:a])
                    at = b
                kept.append(b"".join([*out, raw[at:]]))
                spans.append([{"start": a, "end": b} for a, b in here])
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), pa.array(np.diff(offsets)), pa.array(spans, span), pa.array(kept, pa.binary())],
                names=["_id", "n_bytes", "spans", "kept"])

    got = joined.mapInArrow(run, f"_id {id_type}, n_bytes bigint, spans array<struct<start:bigint,end:bigint>>, kept binary")
    return got.select(F.col("_id").alias(id_col), "n_bytes", "spans", "kept")

