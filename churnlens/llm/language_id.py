"""Language identification with error-correcting output codes over byte n-grams.

Every language has a codeword; a binary logistic classifier on hashed byte bigrams
and trigrams of the whole text predicts each bit.  Decoding is loss-weighted: the
logistic loss of each bit's margin against a codeword, weighted by how well that bit
was learned for that language, summed over bits; the codeword with the least loss
wins and a small lead over the second flags the answer as ambiguous.

Codes: up to seven languages take the exhaustive code (all splits of the languages in
two groups); more take random balanced columns, the draw with the largest least
distance between codewords.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlens.llm.common import byte_view, runs_of_rows

#: Rows a language gives to the classifiers at most (those with the smallest hash of id and text).
ROWS_PER_LANGUAGE = 400
BUCKET_BITS = 11  # hashed features: 2^11 for bigrams and 2^12 for trigrams
BLOCK_BYTES = 2 << 20
EXHAUSTIVE_UP_TO = 7

# bytes are folded to lower-case letters; everything ASCII that is no letter is a blank
_FOLD = np.full(256, 0x20, np.uint8)
_FOLD[0x61:0x7B] = np.arange(0x61, 0x7B)
_FOLD[0x41:0x5B] = np.arange(0x61, 0x7B)
_FOLD[0x80:] = np.arange(0x80, 0x100)


def features(data: np.ndarray, offsets: np.ndarray, bits: int = BUCKET_BITS) -> np.ndarray:
    """Square-root frequencies of hashed byte n-grams, unit length, one row per text (all of it)."""
    n, two, three = len(offsets) - 1, 1 << bits, 2 << bits
    out = np.zeros((n, two + three), np.float32)
    for a, b in runs_of_rows(offsets, BLOCK_BYTES):
        lo, hi = int(offsets[a]), int(offsets[b])
        for s in range(lo, max(hi, lo + 1), BLOCK_BYTES):  # a longer text is taken in slices
            e = min(s + BLOCK_BYTES, hi)
            _count(out, data[s:min(e + 2, hi)], e - s, np.clip(offsets[a:b + 1] - s, 0, None), a, two, three)
    out = np.sqrt(out)
    norm = np.sqrt((out * out).sum(1, keepdims=True))
    return np.divide(out, norm, out=out, where=norm > 0)


def _count(out, raw, size, edges, row, two, three) -> None:
    x = _FOLD[raw].astype(np.uint32)
    if len(x) < 2 or size < 1:
        return
    width = out.shape[1]
    rows = len(edges) - 1
    owner = np.repeat(np.arange(rows), np.diff(np.clip(edges, 0, size)))
    left = np.repeat(edges[1:], np.diff(np.clip(edges, 0, size))) - np.arange(size)  # bytes left in the text
    for gram, base, top in ((2, 0, two), (3, two, three)):
        m = min(size, len(x) - gram + 1)
        if m <= 0:
            continue
        code = x[:m].copy()
        for k in range(1, gram):
            code = (code << np.uint32(8)) | x[k:m + k]
        # a gram of blanks only says nothing, and one across two texts belongs to neither
        blank = np.uint32(int.from_bytes(b" " * gram, "big"))
        ok = (code != blank) & (left[:m] >= gram)
        h = (code * np.uint32(2654435761)) >> np.uint32(32 - int(top).bit_length() + 1)
        cell = owner[:m] * width + base + h.astype(np.int64)
        out[row:row + rows] += np.bincount(cell[ok], minlength=rows * width).reshape(rows, width).astype(np.float32)


def codewords(n: int, seed: int = 11) -> np.ndarray:
    """n codewords of ±1: exhaustive for few, otherwise the best of some random codes."""
    if n <= EXHAUSTIVE_UP_TO:
        cols = [[1 if (c >> k) & 1 else -1 for k in range(n)] for c in range(1, 1 << max(n - 1, 0))]
        return np.array(cols, np.int8).T if cols else np.ones((n, 0), np.int8)
    rng, best, least = np.random.default_rng(seed), None, -1
    length = int(np.ceil(15 * np.log2(n)))
    for _ in range(50):
        code = np.where(rng.permuted(np.tile(np.arange(n) % 2, (length, 1)), axis=1) == 1, 1, -1).T.astype(np.int8)
        gap = (length - code.astype(int) @ code.T.astype(int)) // 2
        gap = int(gap[~np.eye(n, dtype=bool)].min())
        if gap > least:
            best, least = code, gap
    return best


@dataclass
class Model:
    languages: list[str]
    code: np.ndarray     # languages × bits, ±1
    weights: np.ndarray  # features × bits
    bias: np.ndarray
    trust: np.ndarray    # languages × bits, rows sum to one

    def decode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Best language, its probability and its lead over the second for each feature row."""
        if len(self.languages) == 1:
            n = len(x)
            return np.zeros(n, int), np.ones(n), np.ones(n)
        margin = x @ self.weights + self.bias
        loss = np.logaddexp(0, -margin[:, None, :] * self.code[None])
        total = (loss * self.trust[None]).sum(2) * self.code.shape[1]
        p = np.exp(total.min(1, keepdims=True) - total)
        p /= p.sum(1, keepdims=True)
        order = np.sort(p, axis=1)
        return total.argmin(1), order[:, -1], order[:, -1] - order[:, -2]


def fit(x: np.ndarray, y: list[str], steps: int = 150, rate: float = 0.15, decay: float = 3e-4) -> Model:
    """One logistic classifier per bit, all at once, by accelerated gradient steps with class weights."""
    languages = sorted(set(y))
    index = np.array([languages.index(v) for v in y])
    code = codewords(len(languages))
    target = code[index].astype(np.float32)
    share = 1.0 / np.maximum(np.bincount(index, minlength=len(languages)), 1)
    weight = (share[index] / share[index].sum()).astype(np.float32)[:, None]
    w = np.zeros((x.shape[1], code.shape[1]), np.float32)
    b = np.zeros(code.shape[1], np.float32)
    m1, m2 = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, steps + 1):
        z = x @ w + b
        g = -target * weight / (1 + np.exp(np.clip(target * z, -30, 30)))
        gw, gb = x.T @ g + decay * w, g.sum(0)
        m1 = 0.9 * m1 + 0.1 * gw
        m2 = 0.999 * m2 + 0.001 * gw * gw
        w -= rate * (m1 / (1 - 0.9 ** t)) / (np.sqrt(m2 / (1 - 0.999 ** t)) + 1e-8)
        b -= rate * gb
    right = (np.sign(x @ w + b) == target).astype(float)
    trust = np.array([right[index == k].mean(0) if (index == k).any() else np.ones(code.shape[1])
                      for k in range(len(languages))]) + 1e-3
    trust /= np.maximum(trust.sum(1, keepdims=True), 1e-9)
    return Model(languages, code, w, b, trust)


def train(docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang",
          rows_per_language: int = ROWS_PER_LANGUAGE) -> Model | None:
    """Fit on at most ``rows_per_language`` rows of each non-null language, those with the smallest
    hash of their text (repeated texts count once); None if there are none.  Every language with a
    text gives one at least.  The choice needs the distinct hashes counted: no sort, and the driver gets
    only the chosen rows' feature vectors."""
    known = docs.select(F.col(lang_col).cast("string").alias("_lang"), F.col(text_col).alias("_text")) \
        .where(F.col("_lang").isNotNull() & F.col("_text").isNotNull())
    keyed = known.withColumn("_h", F.xxhash64("_text"))
    # hashes are even over their range, so a cut per language comes from its count of texts alone (copies
    # count once, as they are picked once): half as many again as wanted, the smallest hash in any case
    texts = keyed.select("_lang", "_h").distinct()  # combined before the shuffle
    counts = {r["_lang"]: (r["n"], r["least"]) for r in
              texts.groupBy("_lang").agg(F.count(F.lit(1)).alias("n"), F.min("_h").alias("least")).collect()}
    if not counts:
        return None
    chosen = F.lit(False)
    for lang, (n, least) in counts.items():
        share = min(1.0, 1.5 * rows_per_language / n)
        cut = max(int(-2**63 + share * (2**64 - 1)), least)
        chosen = chosen | ((F.col("_lang") == lang) & (F.col("_h") <= F.lit(min(cut, 2**63 - 1))))
    # a text that many rows repeat is one row here, so the driver's share stays bounded
    picked = keyed.where(chosen).groupBy("_lang", "_h").agg(F.first("_text").alias("_text"))

    def run(batches):
        for batch in batches:
            data, offsets = byte_view(batch.column("_text"))
            for a, b in runs_of_rows(offsets, BLOCK_BYTES):
                f = features(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a]).astype(np.float16)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("_lang").slice(a, b - a), batch.column("_h").slice(a, b - a),
                     pa.array([r.tobytes() for r in f], pa.binary())], names=["_lang", "_h", "f"])

    by_lang: dict[str, list] = {}
    for r in picked.mapInArrow(run, "_lang string, _h bigint, f binary").toLocalIterator():
        by_lang.setdefault(r["_lang"], []).append((r["_h"], bytes(r["f"])))
    rows = [(lang, f) for lang in sorted(by_lang) for _, f in sorted(set(by_lang[lang]))[:rows_per_language]]
    x = np.stack([np.frombuffer(f, np.float16) for _, f in rows]).astype(np.float32)
    return fit(x, [lang for lang, _ in rows])


def identify(docs: DataFrame, model: Model | None, *, id_col: str = "doc_id", text_col: str = "text",
             ambiguous_lead: float = 0.2) -> DataFrame:
    """One row per input row: id, ``lang_pred`` (``und`` if the text is null or has no letter, or if
    there is no model), ``score`` (0 to 1, 0 for ``und``), ``ambiguous`` (lead over the second language
    under ``ambiguous_lead``; true for ``und``).  Repeated rows and null ids give a row each; only id
    and text are read.  No shuffle; the model is a few hundred kB, fixed by its feature count."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        for batch in batches:
            data, offsets = byte_view(batch.column("_text"))
            n = len(offsets) - 1
            pred, score, lead = ["und"] * n, np.zeros(n), np.zeros(n)
            for a, b in runs_of_rows(offsets, BLOCK_BYTES) if model else ():
                part, edges = data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a]
                best, p, gap = model.decode(features(part, edges))
                for k in range(b - a):
                    if _has_letter(part[edges[k]:edges[k + 1]]):
                        pred[a + k], score[a + k], lead[a + k] = model.languages[best[k]], p[k], gap[k]
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), pa.array(pred, pa.string()), pa.array(np.clip(score, 0, 1)),
                 pa.array(lead < ambiguous_lead)], names=["_id", "lang_pred", "score", "ambiguous"])

    got = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")) \
        .mapInArrow(run, f"_id {id_type}, lang_pred string, score double, ambiguous boolean")
    return got.select(F.col("_id").alias(id_col), "lang_pred", "score", "ambiguous")


_LETTER = np.zeros(256, bool)
_LETTER[0x41:0x5B] = _LETTER[0x61:0x7B] = True


def _has_letter(raw: np.ndarray) -> bool:
    for s in range(0, len(raw), 4096):
        if _LETTER[raw[s:s + 4096]].any():
            return True
    return bool((raw >= 0x80).any()) and any(c.isalpha() for c in raw.tobytes().decode("utf-8", "replace"))
