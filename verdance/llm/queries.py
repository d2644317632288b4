"""The registered queries of this package and the SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from verdance.llm import archive, bytebpe, collocations, decontaminate, exactcopies, language, nearcopies, pagetext, personal, quality, sharding, tokencount, whitening
from verdance.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencount.count_tokens(table(spark, sf_dir, "documents"))


def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearcopies.near_duplicates(table(spark, sf_dir, "documents"))


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"))


def shards_by_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every slot of the stored map before and after evening out bytes."""
    return sharding.rebalanced(table(spark, sf_dir, "documents"))


def op5_exact_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exactcopies.exact_duplicates(table(spark, sf_dir, "documents"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bytebpe.encode(table(spark, sf_dir, "documents"), with_ids=False)


def op9_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pagetext.main_text(table(spark, sf_dir, "pages"))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive.archived(table(spark, sf_dir, "pages"))


def op11_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal.personal_data(table(spark, sf_dir, "documents"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_language_id,
        op2_token_counts,
        op3_near_duplicates,
        op4_sharding,
        shards_by_bytes,
        op5_exact_duplicates,
        op6_quality,
        op7_decontamination,
        op8_byte_bpe,
        op9_page_text,
        op10_warc,
        op11_personal_data,
        op12_whitening,
        op13_collocations,
        pipeline,
    )
}

ORACLE: dict[str, str] = {
    "op5_exact_duplicates": r"""
        WITH n AS (
          SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents
        ), g AS (
          SELECT norm, min(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY norm
        )
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256
        FROM n JOIN g USING (norm)
    """,
    "op7_decontamination": r"""
        WITH dw AS (
          SELECT doc_id, list_filter(string_split_regex(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w FROM documents
        ), iw AS (
          SELECT item_id, list_filter(string_split_regex(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w FROM benchmark
        ), i AS (
          SELECT DISTINCT item_id, least(len(w), 5) AS k,
                 unnest(list_transform(range(1, len(w) - least(len(w), 5) + 2), lambda p: list_slice(w, p, p + least(len(w), 5) - 1))) AS s
          FROM iw WHERE len(w) > 0
        ), sizes AS (SELECT DISTINCT k FROM i
        ), d AS (
          SELECT DISTINCT doc_id, k, unnest(list_transform(range(1, len(w) - k + 2), lambda p: list_slice(w, p, p + k - 1))) AS s
          FROM dw JOIN sizes ON len(w) >= k
        ), n AS (SELECT item_id, count(*) AS item_shingles FROM i GROUP BY item_id
        ), hit AS (SELECT doc_id, item_id, count(*) AS shared_shingles FROM d JOIN i USING (k, s) GROUP BY doc_id, item_id
        )
        SELECT doc_id, item_id, item_shingles, shared_shingles, shared_shingles / item_shingles AS containment
        FROM hit JOIN n USING (item_id) WHERE 100 * shared_shingles >= 80 * item_shingles
    """,
    "op13_collocations": r"""
        WITH pieces AS (
          SELECT coalesce(lang, 'und') AS lang,
                 unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
          FROM documents
        ), words AS (
          SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces
        ), grams AS (
          SELECT lang, k.k, unnest(list_transform(range(1, len(w) - k.k + 2), lambda i: array_to_string(list_slice(w, i, i + k.k - 1), ' '))) AS phrase
          FROM words, (SELECT unnest([1, 2, 3, 4]) AS k) k WHERE len(w) >= k.k
        ), f AS (
          SELECT lang, k, phrase, count(*) AS a FROM grams GROUP BY lang, k, phrase
        ), n AS (
          SELECT lang, sum(a)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang
        ), candidates AS (
          SELECT lang, k, phrase, a, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND a >= 30
        ), longer AS (
          SELECT lang, phrase, max(a) AS longer FROM (
            SELECT lang, a, unnest(list_transform(range(1, c.k - s.s + 2), lambda i: array_to_string(list_slice(w, i, i + s.s - 1), ' '))) AS phrase
            FROM candidates c, (SELECT unnest([2, 3]) AS s) s WHERE c.k > s.s
          ) GROUP BY lang, phrase
        ), cut AS (
          SELECT lang, phrase, a, cut.cut, array_to_string(list_slice(w, 1, cut.cut), ' ') AS p, array_to_string(list_slice(w, cut.cut + 1, k), ' ') AS q
          FROM candidates, (SELECT unnest([1, 2, 3]) AS cut) cut WHERE cut.cut < k
        ), scored AS (
          SELECT c.lang, c.phrase, c.a, x.a AS l, y.a AS r, (2000000::HUGEINT * c.a // (x.a + y.a))::BIGINT AS score,
                 row_number() OVER (PARTITION BY c.lang, c.phrase ORDER BY 2000000::HUGEINT * c.a // (x.a + y.a), c.cut) AS first
          FROM cut c JOIN f x ON x.lang = c.lang AND x.phrase = c.p JOIN f y ON y.lang = c.lang AND y.phrase = c.q
        ), kept AS (
          SELECT s.* FROM scored s LEFT JOIN longer USING (lang, phrase) WHERE first = 1 AND (longer IS NULL OR 100 * longer < 80 * s.a)
        )
        SELECT * FROM (
          SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank, phrase, a, l, r, n, score
          FROM kept JOIN n USING (lang)
        ) WHERE rank <= 2000
    """,
}
