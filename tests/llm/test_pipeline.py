"""Each stage against brute force on its own input, and odd rows through all stages."""

import hashlib

import public_tokenizers
import pytest
import tiktoken

import corpus_pipeline as C
from churnlens.llm import bpe_words, decontaminate, simhash
from churnlens.llm.common import read_table
from churnlens.llm.queries import quality_net, tokenizer_file
from churnlens.llm.quality import score
from churnlens.session import materialize
from test_fuzzy_lines import brute as brute_lines
from test_simhash import brute_components

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def outputs(spark, tmp_path_factory):
    docs, out = read_table(spark, SF, "documents"), []
    top = tmp_path_factory.mktemp("stages")
    out.append(docs)
    for name, stage in C.STAGES:
        stage(spark, docs, SF).write.parquet(str(top / name))
        docs = spark.read.parquet(str(top / name))
        out.append(docs)
    return out


def rows(df):
    return {r.doc_id: r for r in df.collect()}


def test_columns_and_counts(outputs):
    for before, after in zip(outputs[:-2], outputs[1:-1]):
        assert after.columns == before.columns and after.dtypes == before.dtypes
    n = [x.count() for x in outputs]
    assert n[0] >= n[1] == n[2] > n[3] >= n[4] == n[5] > 0


def test_quality(spark, outputs):
    net = quality_net(spark, SF, outputs[0])
    good = {r.doc_id for r in score(outputs[0], net).collect() if r.score >= 0.3}
    assert set(rows(outputs[1])) == good


def test_line_dedup(outputs):
    before, after = rows(outputs[1]), rows(outputs[2])
    want = brute_lines([(i, r.text) for i, r in before.items()])
    for (i, text), gone in want.items():
        assert after[i].text == "\n".join(x for p, x in enumerate(text.split("\n")) if p not in gone)
        assert after[i].n_chars == len(after[i].text)


def test_simhash(outputs):
    before, after = rows(outputs[2]), rows(outputs[3])
    ids = sorted(before)
    comp = brute_components([simhash.fingerprint(before[i].text.encode()) for i in ids], ids, 3)
    assert set(after) == {i for i, c in zip(ids, comp) if i == c}


def test_decontamination(spark, outputs):
    items = [(r.item_id, r.text) for r in read_table(spark, SF, "benchmark").collect()]
    m = decontaminate.Matcher(items, 10)
    assert set(rows(outputs[4])) == {i for i, r in rows(outputs[3]).items() if not m.scan(r.text.encode())[1]}


def test_bpe(outputs):
    lib = tiktoken.Encoding("lib", pat_str=public_tokenizers.PATTERN, special_tokens={},
                            mergeable_ranks=bpe_words.read_ranks(tokenizer_file("byte_bpe_multi_50k.tiktoken")))
    before = rows(outputs[4])
    for i, r in rows(outputs[5]).items():
        assert r.ids == lib.encode_ordinary(before[i].text) and r.n_tokens == len(r.ids)
        assert r.decoded_sha256 == hashlib.sha256(before[i].text.encode()).hexdigest()


def test_odd_rows(spark, outputs):
    text = "some words that are read by every stage and that are as good as any others here"
    extra = [(None, None, None, None, None, "x", None), (None, text, "en", "s", 5, "x", 1), (900, "", "en", "s", 0, None, 2),
             (901, text, "en", "s", 5, "y", 3), (901, text, "en", "s", 5, "y", 3), (902, text + " " + text, None, None, None, None, 4),
             (903, "word " * 30000, "en", "s", 1, None, 5)]
    docs = spark.createDataFrame(extra, "doc_id long, text string, lang string, source string, n_chars int, score string, _id long")
    for name, stage in C.STAGES[1:4]:
        out = stage(spark, docs, SF)
        assert out.dtypes == docs.dtypes, name
        assert stage(spark, docs.limit(0), SF).count() == 0, name
        got = out.collect()
        if name == "line_dedup":
            assert len(got) == 7
        if name == "simhash":  # text thrice and twice over; the three empty or null rows are one group
            assert sorted((r.doc_id for r in got), key=str)[:1] and sum(r.doc_id == 901 for r in got) <= 1
        if name == "decontamination":
            assert len(got) == 7
    assert C.byte_bpe(spark, docs, SF).count() == 7
    assert C.quality(spark, docs.limit(0), SF).count() == 0
    assert C.quality(spark, docs, SF).dtypes == docs.dtypes


def test_run(spark, outputs):
    got = C.run(spark, SF)
    assert {(r.doc_id, r.ids_sha256) for r in got.collect()} == {(r.doc_id, r.ids_sha256) for r in outputs[5].collect()}


def test_columns_with_the_stages_own_names(spark, outputs):
    docs = outputs[1].limit(20).selectExpr("*", "'keep' || doc_id as _ROW_number", "'also' as _quality_score")
    docs = materialize(docs, "own-names")
    for stage in (C.quality, C.simhash):
        got = stage(spark, docs, SF)
        assert got.dtypes == docs.dtypes
        rows_ = got.collect()
        assert rows_ and all(r["_ROW_number"] == f"keep{r.doc_id}" and r["_quality_score"] == "also" for r in rows_)


def test_larger_inputs_get_more_partitions(spark, tmp_path):
    key, own = "spark.sql.shuffle.partitions", "churnlens.shuffle.partitions"
    old = spark.conf.get(key)
    try:
        spark.conf.set(own, old)  # as if the library had set it
        spark.range(1).write.parquet(str(tmp_path / "documents.parquet"))
        sizes = []
        for mb in (1, 3000):
            with open(tmp_path / "documents.parquet" / "_pad", "wb") as f:
                f.truncate(mb << 20)
            read_table(spark, str(tmp_path), "documents")
            sizes.append(int(spark.conf.get(key)))
        assert sizes[1] == 63 > sizes[0]
        read_table(spark, SF, "benchmark", sized=False)
        assert int(spark.conf.get(key)) == sizes[1]
    finally:
        spark.conf.set(key, old)
        spark.conf.unset(own)
