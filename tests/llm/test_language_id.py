"""Codes, features and held-out accuracy of language identification."""

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from churnlens.llm import language_id as L
from churnlens.llm.common import byte_view, learnable
from churnlens.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def test_codewords_are_far_apart():
    for n in (2, 3, 4, 7, 12, 40):
        code = L.codewords(n).astype(int)
        gap = (code.shape[1] - code @ code.T) // 2
        assert code.shape[0] == n and gap[~np.eye(n, dtype=bool)].min() >= max(1, min(n, 7) // 2)


def test_features_do_not_depend_on_batches(monkeypatch):
    texts = ["Hello there", "", "ß" * 50, "a", "the " * 4000, "x1y2z3" * 300]
    data, offsets = byte_view(pa.array(texts))
    whole = L.features(data, offsets)
    monkeypatch.setattr(L, "BLOCK_BYTES", 97)
    assert np.allclose(whole, L.features(data, offsets), atol=1e-5)
    for i, t in enumerate(texts):
        assert np.allclose(whole[i], L.features(*byte_view(pa.array([t])))[0], atol=1e-5)


def test_held_out_accuracy(spark):
    got = QUERIES["op1_language_id"](spark, SF).where("held_out").collect()
    t = pq.read_table(f"{SF}/documents.parquet")
    lang = dict(zip(t["doc_id"].to_pylist(), t["lang"].to_pylist()))
    pairs = [(lang[r.doc_id], r.lang_pred) for r in got if lang[r.doc_id]]
    assert len(pairs) > 100 and np.mean([a == b for a, b in pairs]) > 0.97
    assert all(0 <= r.score <= 1 for r in got)


def test_odd_rows(spark):
    rows = [(i, "the and of that", "en", 1) for i in range(6)] + [(i, "der und die ich", "de", 1) for i in range(6, 12)]
    rows += [(50, None, "en", 1), (51, "", "de", 1), (52, "12 !!", None, 1), (None, "the that", None, 1), (53, "日本", None, 1)]
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string, score int")
    model = L.train(d.where(learnable()))
    got = {r.doc_id: r for r in L.identify(d, model).collect()}
    assert [got[k].lang_pred for k in (50, 51, 52)] == ["und"] * 3 and got[53].lang_pred in ("de", "en")
    assert got[None].lang_pred == "en" and got[8].lang_pred == "de" and got[50].ambiguous
    assert L.train(d.limit(0)) is None
    assert {r.lang_pred for r in L.identify(d, None).collect()} == {"und"}
    assert L.identify(d.limit(0), model).count() == 0
    one = L.train(d.where("lang = 'en'"))
    assert {r.lang_pred for r in L.identify(d.where("doc_id < 12"), one).collect()} == {"en"}


def test_languages_of_many_copies_are_learned(spark):
    letters = "abcdefghijkl"
    copies = spark.createDataFrame([(f"l{c}", f"{c}{c} {c}o {c * 3} ") for c in letters], "lang string, text string") \
        .crossJoin(spark.range(1000).select(F.col("id").alias("doc_id")))
    twenty = spark.range(10000).select(F.lit("en").alias("lang"), F.concat(F.lit("the and of that "), F.col("id") % 20).alias("text"),
                                       (F.col("id") + 1000).alias("doc_id"))
    model = L.train(copies.unionByName(twenty))
    assert model.languages == ["en"] + [f"l{c}" for c in letters]
    got = L.identify(copies.where("doc_id = 0").drop("lang").withColumn("doc_id", F.col("text")), model).collect()
    assert all(r.lang_pred == "l" + r.doc_id[0] for r in got) and len(got) == 12
    last = copies.orderBy(F.xxhash64("text").desc()).first()["lang"]  # its only hash is high in the range
    assert L.train(copies.where(F.col("lang") == last)).languages == [last]
    assert L.train(twenty, rows_per_language=1).languages == ["en"]


@pytest.mark.parametrize("n", [1])
def test_one_language_has_an_empty_code(n):
    assert L.codewords(n).shape == (1, 0)
