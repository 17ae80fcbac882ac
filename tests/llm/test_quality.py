"""Gradient, coverage and held-out accuracy of the quality network."""

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq

from churnlens.llm import quality as Q
from churnlens.llm.common import byte_view
from churnlens.llm.queries import QUERIES

SF = "/root/testdata/sf0.1"


def test_chunks_cover_every_byte():
    for n in (0, 1, 64, 511, 512, 513, 960, 961, 5000):
        s = Q.chunk_starts(n)
        assert len(s) >= 1 and s[-1] + Q.CHUNK >= n
        assert (np.diff(s) == Q.STEP).all()


def test_scores_do_not_depend_on_batches(monkeypatch):
    net = Q.Net.fresh()
    texts = ["", "a", "word " * 2000, "é" * 700, "x" * 513]
    data, offsets = byte_view(pa.array(texts))
    whole = Q.score_bytes(net, data, offsets)
    monkeypatch.setattr(Q, "BLOCK_BYTES", 600)
    assert np.allclose(whole, Q.score_bytes(net, data, offsets), atol=1e-6)
    one = [Q.score_bytes(net, *byte_view(pa.array([t])))[0] for t in texts]
    assert np.allclose(whole, one, atol=1e-6)


def test_last_byte_counts():
    net = Q.Net.fresh()
    a, b = (Q.score_bytes(net, *byte_view(pa.array(["a" * 99_990 + end])))[0] for end in ("a" * 10, "!#" * 5))
    assert a != b


def test_held_out_accuracy(spark):
    got = {r.doc_id: r for r in QUERIES["op3_quality"](spark, SF).where("held_out").collect()}
    t = pq.read_table(f"{SF}/labels.parquet").to_pydict()
    pairs = [(q, got[i].predicted) for i, q in zip(t["doc_id"], t["quality"]) if i in got]
    assert np.mean([a == b for a, b in pairs]) > 0.95
    assert np.mean([b for a, b in pairs if a == 1]) > 0.97


def test_odd_rows(spark):
    d = spark.createDataFrame([(1, None, 1.0, "k"), (2, "", 2.0, "k"), (None, "fine words", 3.0, None), (2, "", 2.0, "k")],
                              "doc_id long, text string, score double, `a.b` string")
    got = Q.score(d, Q.Net.fresh()).collect()
    assert len(got) == 4 and set(got[0].asDict()) == {"doc_id", "text", "a.b", "score"}
    by = {r.doc_id: r.score for r in got}
    assert by[1] == by[2] and all(0 <= v <= 1 for v in by.values())
    assert {r.score for r in Q.score(d, None).collect()} == {1.0}
    assert Q.score(d.limit(0), None).count() == 0
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert Q.train(d, none) is None
    marks = spark.createDataFrame([(1, 1), (2, 0), (2, 0), (None, 1), (9, None)], "doc_id long, quality int")
    assert Q.train(d, marks) is not None
