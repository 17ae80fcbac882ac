"""Document quality from a byte-level convolutional network, trained and run in numpy.

Bytes are embedded, ``filters`` learned filters of ``width`` bytes run at every
``stride``-th byte, and their rectified responses are max-pooled over overlapping
chunks of ``chunk`` bytes that cover the whole document.  The chunk maxima are
combined into one vector by their maximum, mean and minimum over chunks, and a logistic
layer turns that into one probability.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlens.llm.common import byte_view, runs_of_rows

#: Labelled rows of each class that training takes at most, and chunks of each such row (evenly spread).
ROWS_PER_CLASS = 2000
TRAIN_CHUNKS = 12
BLOCK_BYTES = 1 << 20
CHUNK, STEP = 512, 448  # chunk length and distance: 64 bytes overlap


@dataclass
class Net:
    embed: np.ndarray    # 256 × e
    kernel: np.ndarray   # (width · e) × filters
    bias: np.ndarray     # filters
    out: np.ndarray      # 3 · filters: for the maximum, the mean and the minimum over chunks
    out_bias: float
    width: int = 8
    stride: int = 4

    @staticmethod
    def fresh(embed: int = 8, width: int = 8, stride: int = 4, filters: int = 40, seed: int = 3) -> Net:
        r = np.random.default_rng(seed)
        return Net(r.normal(0, 0.5, (256, embed)).astype(np.float32),
                   r.normal(0, 1 / np.sqrt(width * embed), (width * embed, filters)).astype(np.float32),
                   np.zeros(filters, np.float32), r.normal(0, 0.1, 3 * filters).astype(np.float32), 0.0, width, stride)

    def columns(self, chunks: np.ndarray) -> np.ndarray:
        """chunks: m × CHUNK bytes → m × positions × (width · e) windows of embedded bytes."""
        x = self.embed[chunks]
        v = np.lib.stride_tricks.sliding_window_view(x, self.width, axis=1)[:, ::self.stride]
        return v.transpose(0, 1, 3, 2).reshape(len(chunks), -1, self.kernel.shape[0])

    def pooled(self, chunks: np.ndarray) -> np.ndarray:
        """Max-pooled rectified filter responses of each chunk."""
        z = self.columns(chunks) @ self.kernel
        return np.maximum(z.max(1) + self.bias, 0)

    def combine(self, pooled: np.ndarray, edges: np.ndarray) -> np.ndarray:
        """Document vectors from chunk rows; edges: n+1 row offsets, no document without a row."""
        count = np.diff(edges)[:, None]
        return np.concatenate((np.maximum.reduceat(pooled, edges[:-1]),
                               np.add.reduceat(pooled, edges[:-1]) / count,
                               np.minimum.reduceat(pooled, edges[:-1])), axis=1)

    def probability(self, vectors: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(vectors @ self.out + self.out_bias, -40, 40)))


def chunk_starts(n: int) -> np.ndarray:
    """Starts of the overlapping chunks of a text of n bytes: every STEP bytes, at least one."""
    return np.arange(0, max(n - (CHUNK - STEP), 1), STEP)


def chunk_rows(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Chunks of all texts, zero-padded at a text's end, and the n+1 row offsets of the texts."""
    starts = [chunk_starts(int(n)) for n in np.diff(offsets)]
    edges = np.concatenate(([0], np.cumsum([len(s) for s in starts]))).astype(np.int64)
    at = np.concatenate([s + o for s, o in zip(starts, offsets[:-1])])
    end = np.repeat(offsets[1:], np.diff(edges))
    place = at[:, None] + np.arange(CHUNK)
    inside = place < end[:, None]
    padded = data if len(data) else np.zeros(1, np.uint8)
    return np.where(inside, padded[np.minimum(place, len(padded) - 1)], 0).astype(np.uint8), edges


def score_bytes(net: Net, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Probability for each text; every byte of every text lies in some chunk."""
    out = np.zeros(len(offsets) - 1)
    for a, b in runs_of_rows(offsets, BLOCK_BYTES):
        lo, hi = int(offsets[a]), int(offsets[b])
        if b == a + 1 and hi - lo > BLOCK_BYTES:
            out[a] = net.probability(_long(net, data[lo:hi]))[0]
            continue
        rows, edges = chunk_rows(data[lo:hi], offsets[a:b + 1] - lo)
        pooled = np.concatenate([net.pooled(rows[k:k + 256]) for k in range(0, len(rows), 256)])
        out[a:b] = net.probability(net.combine(pooled, edges))
    return out


def _long(net: Net, text: np.ndarray) -> np.ndarray:
    """Vector of one long text, a block of whole chunks at a time."""
    starts, total = chunk_starts(len(text)), np.zeros(net.kernel.shape[1])
    most, least = total.copy(), np.full_like(total, np.inf)
    for k in range(0, len(starts), 2048):
        s = starts[k:k + 2048]
        part = text[s[0]:s[-1] + CHUNK]
        place = (s - s[0])[:, None] + np.arange(CHUNK)
        rows = np.where(place < len(part), part[np.minimum(place, len(part) - 1)], 0).astype(np.uint8)
        pooled = np.concatenate([net.pooled(rows[i:i + 256]) for i in range(0, len(rows), 256)])
        most, least, total = np.maximum(most, pooled.max(0)), np.minimum(least, pooled.min(0)), total + pooled.sum(0)
    return np.concatenate((most, total / len(starts), least))[None]


def fit(texts: list[bytes], labels: np.ndarray, *, epochs: int = 14, least_steps: int = 800, batch: int = 32,
        rate: float = 5e-3, seed: int = 5) -> Net:
    """Train by back-propagation with Adam: the loss reaches each filter through the place that won the
    pooling.  Classes weigh as often as they are labelled, so the output is a probability."""
    net, rng = Net.fresh(), np.random.default_rng(seed)
    names = ("embed", "kernel", "bias", "out")
    first = {k: np.zeros_like(getattr(net, k)) for k in names} | {"out_bias": 0.0}
    second = {k: np.zeros_like(getattr(net, k)) for k in names} | {"out_bias": 0.0}
    step, e, f = 0, net.embed.shape[1], net.kernel.shape[1]
    rows = []
    for t in texts:
        x = np.frombuffer(t, np.uint8)
        r, _ = chunk_rows(x, np.array([0, len(x)]))
        rows.append(r[np.unique(np.linspace(0, len(r) - 1, min(len(r), TRAIN_CHUNKS)).astype(int))])
    epochs = max(epochs, -(-least_steps * batch // max(len(texts), 1)))  # few rows are gone through more often
    for epoch in range(epochs):
        pace = rate * (1 - epoch / epochs)
        order = rng.permutation(len(texts))
        for k in range(0, len(order), batch):
            ids = order[k:k + batch]
            chunks = np.concatenate([rows[i] for i in ids])
            edges = np.concatenate(([0], np.cumsum([len(rows[i]) for i in ids])))
            cols = net.columns(chunks)
            z = cols @ net.kernel
            best = z.argmax(1)                                     # m × filters: the winning places
            peak = np.take_along_axis(z, best[:, None], 1)[:, 0] + net.bias
            pooled = np.maximum(peak, 0)
            vec = net.combine(pooled, edges)
            p = net.probability(vec)
            d = ((p - labels[ids]) / len(ids)).astype(np.float32)
            g_vec = d[:, None] * net.out
            doc = np.repeat(np.arange(len(ids)), np.diff(edges))
            g = g_vec[doc, f:2 * f] / np.diff(edges)[doc][:, None]
            for part, end in ((g_vec[:, :f], vec[:, :f]), (g_vec[:, 2 * f:], vec[:, 2 * f:])):
                won = (pooled == end[doc]) & (pooled > 0)          # ties share what comes back
                g = g + part[doc] * won / np.maximum(np.add.reduceat(won.astype(np.float32), edges[:-1])[doc], 1)
            g = (g * (peak > 0)).astype(np.float32)                # m × filters
            win = np.take_along_axis(cols, best[:, :, None], 1)    # m × filters × (width · e)
            grad = {"kernel": np.einsum("mf,mfw->wf", g, win), "bias": g.sum(0),
                    "out": vec.T @ d, "out_bias": float(d.sum())}
            back = (g[:, :, None] * net.kernel.T[None]).reshape(-1, e)   # one row per embedded byte
            byte = np.take_along_axis(chunks, (best[:, :, None] * net.stride + np.arange(net.width))
                                      .reshape(len(chunks), -1), 1).reshape(-1)
            grad["embed"] = np.stack([np.bincount(byte, back[:, j], 256) for j in range(e)], 1)
            step += 1
            for name, gr in grad.items():
                first[name] = 0.9 * first[name] + 0.1 * gr
                second[name] = 0.999 * second[name] + 0.001 * np.square(gr)
                move = pace * (first[name] / (1 - 0.9 ** step)) / (np.sqrt(second[name] / (1 - 0.999 ** step)) + 1e-8)
                value = getattr(net, name) - move
                setattr(net, name, float(value) if name == "out_bias" else value.astype(np.float32))
    return net


def train(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", rows_per_class: int = ROWS_PER_CLASS) -> Net | None:
    """Fit on labelled texts: at most ``rows_per_class`` of each label, those with the smallest hash of
    their id, and at most TRAIN_CHUNKS chunks of each.  Prior odds are put back afterwards, so the
    output is calibrated to the labels' own shares.  None if a label is missing altogether."""
    marks = labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_y")) \
        .where(F.col("_y").isin(0, 1)).dropna().dropDuplicates(["_id"])
    shares = {r["_y"]: r["n"] for r in marks.groupBy("_y").agg(F.count(F.lit(1)).alias("n")).collect()}
    if set(shares) != {0, 1}:
        return None
    chosen = F.lit(False)
    for y, n in shares.items():
        cut = int(-2**63 + min(1.0, rows_per_class / n) * (2**64 - 1))
        chosen = chosen | ((F.col("_y") == y) & (F.xxhash64("_id") <= F.lit(min(cut, 2**63 - 1))))
    marks = marks.where(chosen)  # bounded: about rows_per_class of each label
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")) \
        .join(F.broadcast(marks), "_id")

    def run(batches):
        for batch in batches:
            data, offsets = byte_view(batch.column("_text"))
            kept = []
            for i in range(len(offsets) - 1):
                x = data[offsets[i]:offsets[i + 1]]
                s = chunk_starts(len(x))
                s = s[np.unique(np.linspace(0, len(s) - 1, min(len(s), TRAIN_CHUNKS)).astype(int))]
                # neighbouring chunks would overlap when put together again, so each keeps STEP bytes
                kept.append(x.tobytes() if len(x) <= CHUNK + (TRAIN_CHUNKS - 1) * STEP
                            else b"".join(x[a:a + STEP].tobytes() for a in s))
            yield pa.RecordBatch.from_arrays([batch.column("_id").cast(pa.string()), batch.column("_y"),
                                              pa.array(kept, pa.binary())], names=["id", "y", "x"])

    got = sorted((r["id"], bytes(r["x"]), r["y"]) for r in
                 texts.mapInArrow(run, "id string, y int, x binary").dropDuplicates(["id"]).toLocalIterator())
    if {y for *_, y in got} != {0, 1}:
        return None
    y = np.array([y for *_, y in got], np.float32)
    net = fit([x for _, x, _ in got], y)
    prior = np.log(shares[1] / shares[0]) - np.log(y.sum() / (len(y) - y.sum()))
    net.out_bias += float(prior)
    return net


def score(docs: DataFrame, net: Net | None, *, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """``docs`` with the probability that the text is good in ``score_col`` (all columns and rows kept,
    in place; a column of that name is replaced).  A null text scores as an empty one; without a model
    every score is 1.  No shuffle; the model is some 10 kB, fixed by its shape."""
    names = [c for c in docs.columns if c.lower() != score_col.lower()]
    frame = docs.select(*[F.col(f"`{c}`") for c in names])
    text_at = names.index(text_col)
    inner = [f"c{i}" for i in range(len(names))]

    def run(batches):
        for batch in batches:
            data, offsets = byte_view(batch.column(text_at))
            p = score_bytes(net, data, offsets) if net else np.ones(len(offsets) - 1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(p, pa.float64())], names=[*inner, "s"])

    schema = ", ".join(f"c{i} {frame.schema[c].dataType.simpleString()}" for i, c in enumerate(names))
    got = frame.toDF(*inner).mapInArrow(run, f"{schema}, s double")
    return got.select(*[F.col(i).alias(c) for i, c in zip(inner, names)], F.col("s").alias(score_col))
