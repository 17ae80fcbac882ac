"""Trees, proofs and folds against a plain recursive version."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from churnlens.llm.merkle import Parent, build, fold_proofs

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def h(s):
    return hashlib.sha256(s.encode()).hexdigest()


def leaf(row):
    return h("".join("-" if x is None else f"{len(str(x).encode())}:{x}" for x in row))


def tree(nodes, arity):
    """Last node, and for every node the runs (left siblings, right siblings) on its way up."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, p in enumerate(at):
            run = nodes[p // arity * arity:p // arity * arity + arity]
            paths[i].append((run[:p % arity], run[p % arity + 1:]))
            at[i] = p // arity
        nodes = [h("".join(nodes[i:i + arity])) for i in range(0, len(nodes), arity)]
    return nodes[0], paths


def brute(rows, arity, changed=lambda r: r):
    def key(r):
        return (r[1] is not None, (r[1] or "").encode(), r[0] is not None, r[0] or 0, leaf(r))
    rows = sorted(rows, key=key)
    groups = sorted({r[1] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    parts = {g: tree([leaf(r) for r in rows if r[1] == g], arity) for g in groups}
    root, above = tree([parts[g][0] for g in groups], arity)
    out, seen = [], dict.fromkeys(groups, 0)
    for r in rows:
        sub, paths = parts[r[1]]
        path = paths[seen[r[1]]] + above[groups.index(r[1])]
        seen[r[1]] += 1
        value = leaf(changed(r))
        for left, right in path:
            value = h("".join(left) + value + "".join(right))
        proof = h("".join(x for left, right in path for x in left + right))
        out.append((r[0], leaf(r), sub, root, proof, value, value == root))
    return out


def lowered(r):
    if r[0] is None or r[4] is None or zlib.crc32(str(r[0]).encode()) % 5:
        return r
    return r[:4] + ("".join(c.lower() if "A" <= c <= "Z" else c for c in r[4]),)


ROWS = [(i * 7 % 211 - 3, s, "en" if i % 3 else None, i, f"Text Ä {i} É" if i % 4 else "all lower")
        for i in range(150) for s in [["a", "hot", "hot", "é", "z", None, ""][i % 7]]]
ROWS += [(5, "hot", None, None, None), (5, "hot", None, None, None), (None, None, None, None, None), (None, "hot", "x", 1, ""),
         (10 ** 15, "one", "en", 3, "Only Row"), (12, "hot", "en", 1, "A" * 300_000), (12, "hot", "en", 1, "A" * 300_000)]


@pytest.mark.parametrize("arity,levels", [(2, 2), (3, 1), (16, 3)])
def test_against_plain_tree(spark, arity, levels):
    df = spark.createDataFrame([r + ("x", b"y") for r in ROWS], SCHEMA + ", leaf string, _group binary").repartition(5)
    low = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    m = build(df, arity=arity, levels=levels, changes={"text": low}, changed_where=F.crc32(F.col("doc_id").cast("string")) % 5 == 0)
    got = [tuple(r) for r in fold_proofs(m).collect()]
    want = brute(ROWS, arity, lowered)
    assert sorted(got, key=str) == sorted(want, key=str)
    assert {r[3] for r in got} == {m.root}
    assert any(not r[6] for r in got)


def test_siblings_rebuild_the_root(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    got = fold_proofs(build(df, arity=4, levels=1), siblings=True).collect()
    assert all(h(r.siblings) == r.proof_sha256 and r.verified for r in got)


def test_single_row_and_empty_table(spark):
    one = spark.createDataFrame(ROWS[:1], SCHEMA)
    (r,) = fold_proofs(build(one)).collect()
    assert r.leaf == r.subroot == r.root == r.folded_root == leaf(ROWS[0]) and r.proof_sha256 == h("")
    none = build(spark.createDataFrame([], SCHEMA))
    assert none.root is None and fold_proofs(none).count() == 0


def test_resumed_state_needs_right_siblings_only():
    children = [h(str(i)).encode() for i in range(16)]
    p = Parent(children)
    for slot in (0, 7, 15):
        new = children[:slot] + [h("new").encode()] + children[slot + 1:]
        assert p.fold(slot, new[slot]) == hashlib.sha256(b"".join(new)).hexdigest().encode()


def test_registered_query(spark, tmp_path):
    from churnlens.llm.queries import QUERIES
    spark.createDataFrame(ROWS, SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    got = QUERIES["op13_merkle"](spark, str(tmp_path))
    assert got.dtypes == [("doc_id", "bigint"), *[(c, "string") for c in ("leaf", "subroot", "root", "proof_sha256", "folded_root")],
                          ("verified", "boolean")]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(brute(ROWS, 16, lowered), key=str)
