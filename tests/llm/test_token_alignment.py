"""Alignment and counts against whole-text encodings and all overlapping pairs."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from churnlens.llm.perfect_hash import PerfectHash
from churnlens.llm.queries import QUERIES, tokenizer_file
from churnlens.llm.token_alignment import align_tokens

A, B = tokenizer_file("byte_bpe_50k.json"), tokenizer_file("piece_bpe_32k.model")


def brute(rows):
    import sentencepiece
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(A)
    tok.encode_special_tokens = True
    sp = sentencepiece.SentencePieceProcessor(model_file=B)
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    chars = {chr(b): b for b in plain}
    chars.update({chr(256 + n): b for n, b in enumerate(b for b in range(256) if b not in plain)})

    def ends(parts):
        return np.cumsum([len(p) for p in parts]).tolist()

    docs = []
    for _, text in rows:
        if not text:
            docs.append(None)
            continue
        a, b = tok.encode(" " + text, add_special_tokens=False).ids, sp.encode(text)
        ba = [bytes(chars[c] for c in tok.id_to_token(i)) for i in a]
        bb = [bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i) else sp.id_to_piece(i).replace("▁", " ").encode() for i in b]
        if not b"".join(ba) == b"".join(bb) == (" " + text).encode():
            docs.append(None)
            continue
        ea, eb = ends(ba), ends(bb)
        links = [(i, j) for i in range(len(a)) for j in range(len(b))
                 if max(ea[i] - len(ba[i]), eb[j] - len(bb[j])) < min(ea[i], eb[j])]
        cuts = sorted(set(ea) & set(eb))
        groups = [([x for x, e in zip(a, ea) if lo < e <= hi], [x for x, e in zip(b, eb) if lo < e <= hi])
                  for lo, hi in zip([0, *cuts], cuts)]
        docs.append((a, b, links, groups))
    count = Counter(p for d in docs if d for p in {(d[0][i], d[1][j]) for i, j in d[2]})
    top = defaultdict(int)
    for (x, _), n in count.items():
        top[x] = max(top[x], n)
    out = []
    for (name, _), d in zip(rows, docs):
        if d is None:
            out.append((name, 0, 0, 0, 0, 0, 0, "", ""))
            continue
        a, b, links, groups = d
        n = [count[a[i], b[j]] for i, j in links]
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((name, len(a), len(b), len(groups), len(links), sum(c == top[a[i]] for c, (i, _) in zip(n, links)),
                    sum(n), hashlib.sha256(text.encode()).hexdigest(), text))
    return out


ODD = [None, "", " ", "  ", "a  b", " lead", "trail ", "tab\tand\nline \n x", "▁", "a▁b c", "x ▁ y", "<|endoftext|> is <s> text </s><unk>",
       "<0x41>", "naïve café — “quotes” 漢字かな 한국어", "é́ a", "emoji 👩‍👩‍👧 🙂", "\x00 \x1f a", "a b 　 c d",
       "don't we'll I'm", "1234567 89 ۱۲۳", "x" * 500, "漢" * 300, "no-break  blank", "᠎ x ᠎", "a \x85 b", "ﬁ ligature ﬁ"]


def texts(seed, n):
    r = random.Random(seed)
    words = ["the", "The", "token", "tokenizer,", "aligned.", "über", "schön", "naïve", "foo_bar", "3.14", "x=y;", "(a)", "日本", "don't", "\n", ""]
    return [" ".join(r.choice(words) for _ in range(r.randrange(1, 40))) for _ in range(n)]


@pytest.mark.parametrize("settings", [{}, {"block_chars": 300, "part_keys": 40, "branch_blocks": 1}])
def test_against_whole_texts(spark, settings):
    own = texts(1, 60)
    rows = [(i, t) for i, t in enumerate(ODD + own + own[:20] + [own[0]] * 30)] + [(3, "a  b"), (None, "no id"), (None, None)]
    df = spark.createDataFrame([(*r, "x", 0) for r in rows], "doc_id long, text string, n_a string, _block int").repartition(3)
    got = [tuple(r) for r in align_tokens(df, A, B, groups=True, **settings).collect()]
    assert sorted(got, key=str) == sorted(brute(rows), key=str)


def test_long_text_and_long_word(spark):
    rows = [(1, " ".join(texts(2, 120))), (2, "z9" * 3000), (3, "one " * 900)]
    got = align_tokens(spark.createDataFrame(rows, "doc_id long, text string"), A, B, groups=True)
    assert sorted(map(tuple, got.collect())) == sorted(brute(rows))


def test_empty_table(spark):
    assert align_tokens(spark.createDataFrame([], "doc_id string, text string"), A, B).count() == 0
    none = align_tokens(spark.createDataFrame([("a", None)], "doc_id string, text string"), A, B).collect()
    assert [tuple(r) for r in none] == [("a", 0, 0, 0, 0, 0, 0, "")]


@pytest.mark.parametrize("n", [0, 1, 2, 1000, 70_000])
def test_hash_is_minimal_perfect_and_verified(n):
    keys = np.unique(np.random.default_rng(n).integers(0, 1 << 48, n))
    h = PerfectHash.unpack(*PerfectHash.build(keys).pack())
    assert sorted(h.number(keys).tolist()) == list(range(len(keys)))
    other = np.setdiff1d(np.arange(5000, dtype=np.int64), keys)
    assert (h.number(other) == -1).all()


def test_registered_query(spark, tmp_path):
    rows = list(enumerate(texts(5, 25) + ODD))
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = QUERIES["op12_token_alignment"](spark, str(tmp_path))
    assert got.dtypes == [(c, "bigint") for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")] + \
        [("groups_sha256", "string")]
    assert sorted(map(tuple, got.collect())) == sorted(r[:8] for r in brute(rows))


def test_ranks_give_the_tokenizers_ids():
    from churnlens.llm.token_alignment import Tokenizers
    t = Tokenizers(A, B)
    r = random.Random(3)
    chars = [chr(c) for c in range(1, 0x370)]
    some = [" " + "".join(r.choice(chars) for _ in range(r.randrange(1, 60))) for _ in range(3000)]
    some += [" " + "".join(r.choice("ab'stlve 1é \n,.") for _ in range(40)) for _ in range(3000)]
    some += [x.decode() for x in t.words_a.bytes.to_pylist() if x.isascii()]
    want = [e.ids for e in t.a.encode_batch_fast(some, add_special_tokens=False)]
    assert t.quick and [t.quick.encode_ordinary(x) for x in some] == want
