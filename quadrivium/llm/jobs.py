"""The registered queries: operators applied to the driver's tables, and the SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quadrivium.llm import byte_bpe, quality
from quadrivium.llm.bloom_lm import score_documents
from quadrivium.llm.common import held_out
from quadrivium.llm.embedding_dedup import near_vectors
from quadrivium.llm.exact_dedup import exact_dedup
from quadrivium.llm.line_dedup import dedup_lines
from quadrivium.llm.near_dedup import near_duplicates
from quadrivium.llm.packing import pack_documents
from quadrivium.llm.phrases import collocations
from quadrivium.llm.secrets import secret_digests
from quadrivium.llm.spelling import spelling_variants
from quadrivium.llm.token_files import round_trip
from quadrivium.llm.unigram_counts import count_tokens


def vocabulary(name: str) -> str:
    """The place of a public vocabulary file, the default of every tokenizer parameter here."""
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


def op1_bloom_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents"))


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), words=2, percent=80)


def op5_lattice_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"), 0.98)


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.round_trip(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_multi_50k.tiktoken"))


def op7_linked_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_digests(table(spark, sf_dir, "documents"))


def op8_compression_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = quality.score(docs, quality.fit(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", held_out("doc_id", quality.FOLDS).alias("held_out"), "score", "predicted")


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents"), shortest=6, least=5, ratio=5, typo_every=199)


def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = dedup_lines(table(spark, sf_dir, "documents"), least=20, min_docs=3)
    return lines.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"), depth=3, least=10, top=2000, share=50)


QUERIES = {
    "op1_bloom_language_model": op1_bloom_language_model,
    "op2_best_fit_packing": op2_best_fit_packing,
    "op3_exact_dedup": op3_exact_dedup,
    "op4_near_duplicates": op4_near_duplicates,
    "op5_lattice_near_vectors": op5_lattice_near_vectors,
    "op6_byte_bpe": op6_byte_bpe,
    "op7_linked_secrets": op7_linked_secrets,
    "op8_compression_quality": op8_compression_quality,
    "op9_token_files": op9_token_files,
    "op10_token_counts": op10_token_counts,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_line_dedup": op12_line_dedup,
    "op13_collocations": op13_collocations,
}

SQL = {
    "op3_exact_dedup": """
        WITH t AS (
          SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS body
          FROM documents)
        SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id = max(doc_id) OVER w AS kept, sha256(body) AS text_sha256
        FROM t WINDOW w AS (PARTITION BY body)""",
    "op4_near_duplicates": r"""
        WITH RECURSIVE w AS (
          SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                            '[^\x20\x09-\x0D]+') AS ws FROM documents),
        g AS (
          SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) > 1 THEN list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1])
                                              ELSE ws END) AS gram FROM w),
        sizes AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
        common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM g a JOIN g b ON a.gram = b.gram AND a.doc_id <> b.doc_id GROUP BY ALL),
        links AS (
          SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * k >= 80 * (x.n + y.n - k)),
        reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
        SELECT r.a AS doc_id, coalesce(any_value(s.n), 0) AS n_shingles, min(r.b) AS component_id, r.a = min(r.b) AS kept
        FROM reach r LEFT JOIN sizes s ON s.doc_id = r.a GROUP BY r.a""",
    "op5_lattice_near_vectors": """
        WITH RECURSIVE good AS (
          SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
          WHERE label IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
            AND list_sum(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE)) > 0),
        links AS (
          SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b ON a.label = b.label AND a.vec_id <> b.vec_id
          WHERE list_cosine_similarity(a.v, b.v) >= 0.98),
        reach AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
        counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
        SELECT e.vec_id, coalesce(max(c.n), 0) AS n_links, min(r.b) AS component_id, e.vec_id = min(r.b) AS kept
        FROM embeddings e JOIN reach r ON r.a = e.vec_id LEFT JOIN counts c ON c.a = e.vec_id GROUP BY e.vec_id""",
    "op12_line_dedup": r"""
        WITH l AS (
          SELECT doc_id, t.p AS p, t.line AS line,
                 translate(regexp_replace(t.line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
          FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
               LATERAL (SELECT unnest(ls) AS line, unnest(range(len(ls))) AS p) t),
        k AS (SELECT key, max(doc_id) AS keep FROM l WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
        m AS (SELECT l.*, k.key IS NOT NULL AND l.doc_id <> k.keep AS gone FROM l LEFT JOIN k ON l.key = k.key)
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY p) FILTER (NOT gone), '')) AS kept_sha256
        FROM m GROUP BY doc_id""",
    "op13_collocations": r"""
        WITH w AS (
          SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws
          FROM (SELECT lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                       'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)),
        f AS (
          SELECT lang, 1 AS k, g AS phrase, count(*) AS c FROM (SELECT lang, unnest(ws) AS g FROM w) GROUP BY ALL
          UNION ALL
          SELECT lang, 2, g, count(*) FROM (
            SELECT lang, unnest(list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1])) AS g FROM w WHERE len(ws) > 1) GROUP BY ALL
          UNION ALL
          SELECT lang, 3, g, count(*) FROM (
            SELECT lang, unnest(list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2])) AS g
            FROM w WHERE len(ws) > 2) GROUP BY ALL),
        cand AS (SELECT lang, k, phrase, c AS a, string_split(phrase, ' ') AS p FROM f WHERE k > 1 AND c >= 10),
        cuts AS (
          SELECT lang, phrase, a, 1 AS cut, p[1] AS lp, array_to_string(p[2:], ' ') AS rp FROM cand
          UNION ALL SELECT lang, phrase, a, 2, p[1] || ' ' || p[2], p[3] FROM cand WHERE k = 3),
        scored AS (
          SELECT u.lang, u.phrase, u.a, u.cut, x.c AS l, y.c AS r,
                 (1000000::HUGEINT * u.a * u.a) // (x.c::HUGEINT * y.c) AS score
          FROM cuts u JOIN f x ON x.lang = u.lang AND x.phrase = u.lp JOIN f y ON y.lang = u.lang AND y.phrase = u.rp),
        best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
        over AS (
          SELECT lang, s AS phrase, max(a) AS of FROM (
            SELECT lang, a, unnest([p[1] || ' ' || p[2], p[2] || ' ' || p[3]]) AS s FROM cand WHERE k = 3) GROUP BY ALL),
        kept AS (SELECT b.* FROM best b LEFT JOIN over o USING (lang, phrase) WHERE o.of IS NULL OR 100 * o.of < 50 * b.a),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept),
        totals AS (SELECT lang, sum(c)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang)
        SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000""",
}
