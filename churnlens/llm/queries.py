"""Registered queries of the corpus operators (name → callable) and their DuckDB twins."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from churnlens.llm.common import make_importable, read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        @wraps(fn)
        def query(spark, sf_dir):
            make_importable(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = query
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def tokenizer_file(name: str) -> str:
    """Place of a public vocabulary file, as the installed package gives it."""
    import public_tokenizers
    return public_tokenizers.path(name)


@register("op5_token_counts")
def op5(spark, sf_dir):
    from churnlens.llm.token_count import count_tokens
    return count_tokens(read_table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"))


@register("op1_language_id")
def op1(spark, sf_dir):
    from churnlens.llm.common import held_out, learnable
    from churnlens.llm.language_id import identify, train
    docs = read_table(spark, sf_dir, "documents")
    model = train(docs.where(learnable()))
    return identify(docs, model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "ambiguous")


#: Words of a text or item, as DuckDB has them, and the windows of ten.
_OP2_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
lengths AS (SELECT DISTINCT least(len(w), 10) AS n FROM b WHERE len(w) > 0),
wins AS (SELECT DISTINCT item_id, array_to_string(w[i:i + 9], ' ') AS win, least(len(w), 10) AS n
         FROM (SELECT item_id, w, unnest(generate_series(1, greatest(1, len(w) - 9))) AS i FROM b WHERE len(w) > 0)),
dw AS (SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i FROM d, lengths WHERE len(w) >= n),
hits AS (SELECT dw.doc_id, dw.i, wins.n, wins.item_id
         FROM (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS win FROM dw) dw
         JOIN wins ON dw.win = wins.win AND dw.n = wins.n),
hw AS (SELECT doc_id, count(DISTINCT k) AS n_hit
       FROM (SELECT doc_id, unnest(generate_series(i, i + n - 1)) AS k FROM hits) GROUP BY doc_id),
hi AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS ids
       FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(len(d.w), 0) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hw USING (doc_id) LEFT JOIN hi USING (doc_id)"""


@register("op2_decontaminate", sql=_OP2_SQL)
def op2(spark, sf_dir):
    from pyspark.sql import functions as F

    from churnlens.llm.decontaminate import decontaminate
    got = decontaminate(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark", sized=False))
    named = F.array_sort(F.array_distinct(F.transform("items", lambda x: x.cast("string"))))
    return got.select("doc_id", "n_words", "n_hit", F.size(named).cast("bigint").alias("n_items"),
                      F.sha2(F.array_join(named, ","), 256).alias("items_sha256"),
                      (F.col("n_hit") > 0).alias("contaminated"))


def quality_net(spark, sf_dir, docs):
    """The quality network, learned from the labelled rows outside the held-out fold."""
    from churnlens.llm.common import learnable
    from churnlens.llm.quality import train
    return train(docs.where(learnable()), read_table(spark, sf_dir, "labels", sized=False).where(learnable()))


#: A document is good from this probability on.
QUALITY_THRESHOLD = 0.3


@register("op3_quality")
def op3(spark, sf_dir):
    from pyspark.sql import functions as F

    from churnlens.llm.common import held_out
    from churnlens.llm.quality import score
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    got = score(docs, quality_net(spark, sf_dir, docs))
    return got.select("doc_id", held_out().alias("held_out"), "score",
                      (F.col("score") >= QUALITY_THRESHOLD).cast("int").alias("predicted"))


@register("op4_html_text")
def op4(spark, sf_dir):
    from churnlens.llm.html_text import extract
    return extract(read_table(spark, sf_dir, "pages"))


@register("op9_simhash")
def op9(spark, sf_dir):
    from churnlens.llm.simhash import simhash_dedup
    return simhash_dedup(read_table(spark, sf_dir, "documents"), shingle=3, max_bits=3)


def bpe_digest(docs, ranks_path, pattern):
    """Counts and digests of the ids and of the bytes that they decode to."""
    from pyspark.sql import functions as F

    from churnlens.llm.bpe_words import encode
    got = encode(docs, ranks_path, pattern, decoded=True)
    return got.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"),
                      F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
                      F.sha2(F.col("bytes"), 256).alias("decoded_sha256"))


@register("op8_byte_bpe")
def op8(spark, sf_dir):
    import public_tokenizers
    return bpe_digest(read_table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_multi_50k.tiktoken"),
                      public_tokenizers.PATTERN)


#: Links by plain comparison of all pairs; components by following links from every vector.
_OP7_SQL = """
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
u AS (SELECT vec_id, e, sqrt(list_inner_product(e, e)) AS n FROM v
      WHERE e IS NOT NULL AND len(e) > 0 AND len([x FOR x IN e IF x IS NULL OR NOT isfinite(x)]) = 0
        AND len([x FOR x IN e IF x <> 0]) > 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b
          ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
          AND list_inner_product(a.e, b.e) / (a.n * b.n) >= 0.95),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
low AS (SELECT a, min(b) AS m FROM reach GROUP BY a),
deg AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT v.vec_id, CAST(coalesce(deg.n, 0) AS BIGINT) AS n_links,
       least(v.vec_id, coalesce(low.m, v.vec_id)) AS component_id,
       v.vec_id = least(v.vec_id, coalesce(low.m, v.vec_id)) AS kept
FROM v LEFT JOIN low ON v.vec_id = low.a LEFT JOIN deg ON v.vec_id = deg.a"""


@register("op7_embedding_join", sql=_OP7_SQL)
def op7(spark, sf_dir):
    from churnlens.llm.embedding_join import embedding_dedup
    return embedding_dedup(read_table(spark, sf_dir, "embeddings"))


@register("op10_fuzzy_lines")
def op10(spark, sf_dir):
    from churnlens.llm.fuzzy_lines import line_report
    return line_report(read_table(spark, sf_dir, "documents"))


@register("op6_suffix_dedup")
def op6(spark, sf_dir):
    from pyspark.sql import functions as F

    from churnlens.llm.suffix_dedup import remove_passages
    got = remove_passages(read_table(spark, sf_dir, "documents"), keep_first=False)
    removed = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["start"])
    return got.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("bigint").alias("n_spans"),
                      F.sha2("kept", 256).alias("kept_sha256"))


#: The tree level by level: a recursive step hashes every sixteen nodes of a tree that still has several, and
#: carries finished trees on unchanged. crc32 is folded over the digits with a table that eight shifts make.
_OP13_SQL = """
WITH RECURSIVE bits(i, k, v) AS (
  SELECT i, 0, i FROM range(256) t(i) UNION ALL
  SELECT i, k + 1, CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END FROM bits WHERE k < 8),
tab AS (SELECT list(v ORDER BY i) AS t FROM bits WHERE k = 8),
d AS (SELECT row_number() OVER () AS rid, doc_id, source, lang, n_chars, text,
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low FROM documents),
digits(rid, s, c) AS (
  SELECT rid, CAST(doc_id AS VARCHAR), CAST(4294967295 AS BIGINT) FROM d WHERE doc_id IS NOT NULL UNION ALL
  SELECT rid, s[2:], xor(c // 256, t[1 + xor(c % 256, ascii(s[1]))]) FROM digits, tab WHERE len(s) > 0),
crc AS (SELECT rid, xor(c, 4294967295) % 5 = 0 AS tampered FROM digits WHERE len(s) = 0),
head AS (SELECT d.*, coalesce(tampered, false) AS tampered, concat(
    coalesce(concat(strlen(CAST(doc_id AS VARCHAR)), ':', doc_id), '-'), coalesce(concat(strlen(source), ':', source), '-'),
    coalesce(concat(strlen(lang), ':', lang), '-'),
    coalesce(concat(strlen(CAST(n_chars AS VARCHAR)), ':', n_chars), '-')) AS h FROM d LEFT JOIN crc USING (rid)),
leaf AS (SELECT rid, doc_id, coalesce('=' || source, '-') AS g,
    sha256(concat(h, coalesce(concat(strlen(text), ':', text), '-'))) AS dig,
    sha256(concat(h, CASE WHEN text IS NULL THEN '-' ELSE concat(strlen(text), ':', CASE WHEN tampered THEN low ELSE text END) END)) AS seen
  FROM head),
up(lev, g, pos, dig, n) AS (
  SELECT 0, g, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, dig) - 1, dig, count(*) OVER (PARTITION BY g) FROM leaf
  UNION ALL
  SELECT lev, g, p, dig, count(*) OVER (PARTITION BY g) FROM (
    SELECT lev + 1 AS lev, g, pos // 16 AS p, sha256(string_agg(dig, '' ORDER BY pos)) AS dig FROM up WHERE n > 1
    GROUP BY lev, g, pos // 16)),
subroot AS (SELECT g, dig, lev FROM up WHERE n = 1),
top(lev, pos, dig, n) AS (
  SELECT 0, row_number() OVER (ORDER BY g) - 1, dig, count(*) OVER () FROM subroot
  UNION ALL
  SELECT lev, p, dig, count(*) OVER () FROM (
    SELECT lev + 1 AS lev, pos // 16 AS p, sha256(string_agg(dig, '' ORDER BY pos)) AS dig FROM top WHERE n > 1
    GROUP BY lev, pos // 16)),
place AS (SELECT g, row_number() OVER (ORDER BY g) - 1 AS pos FROM subroot),
steps AS (
  SELECT lev, g, pos, n, string_agg(dig, '' ORDER BY pos) OVER r AS dig, list(dig) OVER r AS run,
         row_number() OVER (PARTITION BY lev, g, pos // 16 ORDER BY pos) AS slot
  FROM (SELECT lev, g, pos, dig, n FROM up WHERE n > 1 UNION ALL SELECT 1000 + lev, '', pos, dig, n FROM top WHERE n > 1)
  WINDOW r AS (PARTITION BY lev, g, pos // 16 ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)),
walk(rid, g, lev, pos, cur, sib) AS (
  SELECT l.rid, l.g, 0, u.pos, l.seen, '' FROM (
      SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, dig) - 1 AS pos FROM leaf) l
    JOIN up u ON u.lev = 0 AND u.g = l.g AND u.pos = l.pos
  UNION ALL
  SELECT w.rid, w.g, CASE WHEN s.pos IS NULL THEN 1000 ELSE w.lev + 1 END,
    CASE WHEN s.pos IS NULL THEN p.pos ELSE w.pos // 16 END,
    CASE WHEN s.pos IS NULL THEN w.cur ELSE sha256(concat(array_to_string(s.run[:s.slot - 1], ''), w.cur, array_to_string(s.run[s.slot + 1:], ''))) END,
    CASE WHEN s.pos IS NULL THEN w.sib ELSE concat(w.sib, array_to_string(s.run[:s.slot - 1], ''), array_to_string(s.run[s.slot + 1:], '')) END
  FROM walk w LEFT JOIN steps s ON s.lev = w.lev AND s.g = (CASE WHEN w.lev < 1000 THEN w.g ELSE '' END) AND s.pos = w.pos
    LEFT JOIN place p ON p.g = w.g
  WHERE w.lev < 1000 OR s.pos IS NOT NULL),
ends AS (SELECT rid, arg_max(cur, lev) AS cur, arg_max(sib, lev) AS sib FROM walk WHERE lev >= 1000 GROUP BY rid),
root AS (SELECT dig FROM top WHERE n = 1)
SELECT l.doc_id, l.dig AS leaf, sr.dig AS subroot, root.dig AS root, sha256(e.sib) AS proof_sha256, e.cur AS folded_root,
  e.cur = root.dig AS verified
FROM leaf l JOIN subroot sr ON sr.g = l.g JOIN ends e ON e.rid = l.rid, root"""


@register("op13_merkle", sql=_OP13_SQL)
def op13(spark, sf_dir):
    from pyspark.sql import functions as F

    from churnlens.llm.common import held_out
    from churnlens.llm.merkle import build, fold_proofs
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    lowered = F.translate("text", upper, upper.lower())
    # the rows whose crc32 five divides are the ones whose text is seen in lower case
    return fold_proofs(build(read_table(spark, sf_dir, "documents"), changes={"text": lowered}, changed_where=held_out()))


#: All pairs of a query and another vector, best products first.
_OP11_SQL = """
WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
u AS (SELECT vec_id, e FROM v
      WHERE vec_id IS NOT NULL AND e IS NOT NULL AND len(e) > 0 AND len([x FOR x IN e IF x <> 0]) > 0
        AND len([x FOR x IN e IF x IS NULL OR NOT isfinite(x)]) = 0),
near AS (SELECT a.vec_id AS query_id, b.vec_id, list_inner_product(a.e, b.e) + 0.0 AS score
         FROM u a JOIN u b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) WHERE a.vec_id % 20 = 0),
ranked AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
                  vec_id, score FROM near)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20"""


@register("op11_vp_tree", sql=_OP11_SQL)
def op11(spark, sf_dir):
    from pyspark.sql import functions as F

    from churnlens.llm.vp_tree import nearest
    return nearest(read_table(spark, sf_dir, "embeddings"), where=F.col("vec_id") % 20 == 0, k=20, factor=1.0)


@register("op12_token_alignment")
def op12(spark, sf_dir):
    from churnlens.llm.token_alignment import align_tokens
    return align_tokens(read_table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"),
                        tokenizer_file("piece_bpe_32k.model"))
