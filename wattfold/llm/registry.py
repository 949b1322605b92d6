"""One query per operator with production parameters, and its SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattfold.llm import (
    collision,
    host_paths,
    jaccard,
    lines,
    maxscore,
    mixing,
    packing,
    quality,
    sharding,
    spelling,
    term_stages,
    token_counts,
    toxicity,
)
from wattfold.llm.common import table
from wattfold.session import scratch_dir

SHARDS = 8


def op1_raked_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang")
    return mixing.mix(docs).select(
        "doc_id", "topic", "tokens", F.round("probability", 6).alias("probability"), "kept"
    )


def op2_differencing_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    packed = packing.assign(packing.digests(packing.cut(docs)))
    return packed.select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"
    )


def op3_fuzzy_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return lines.dedup_lines(docs)


def op4_best_fit_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return sharding.shard(docs, SHARDS).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op5_collision_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return collision.nearest(rows, rows.where(F.col("vec_id") % 100 == 0), k=10)


def op6_gru_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model, keep_text=False).select(
        "doc_id",
        toxicity.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op7_maxscore_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = maxscore.quantised(table(spark, sf_dir, "embeddings"))
    return maxscore.top_products(rows, rows.where(F.col("vec_id") % 50 == 0), k=5)


OP7_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS vec
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, v.vec_id,
         CAST(list_inner_product(q.vec, v.vec) AS BIGINT) AS score
  FROM v AS q JOIN v ON q.vec_id % 50 = 0 AND q.vec_id <> v.vec_id
), ranked AS (
  SELECT query_id,
         CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
         vec_id, score
  FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""


def op8_host_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return host_paths.extract(pages).select("page_id", "url", "text", "n_chars")


def op9_digest_cached_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = token_counts.count_tokens(docs, f"{scratch_dir(spark, 'token-cache')}/counts")
    return counted.select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 512).alias("over_limit")
    )


def op10_ngram_product_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return jaccard.join_components(docs)


def op11_term_stage_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return term_stages.top_documents(docs, table(spark, sf_dir, "benchmark"), k=10)


def op12_kd_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op13_certified_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return quality.judge(docs, table(spark, sf_dir, "labels")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = {
        name: f for name, f in globals().items() if name.startswith("op") and name[2].isdigit()
    }
    found = dict(sorted(found.items(), key=lambda x: int(x[0][2:].split("_")[0])))
    return found | {"pipeline": pipeline}


def oracle_sql() -> dict[str, str]:
    return {
        "op1_raked_mix": mixing.mix_sql(),
        "op7_maxscore_topk": OP7_SQL,
        "op11_term_stage_ranking": term_stages.SQL,
        "op13_certified_quality_rules": quality.sql(),
    }
