"""One query per corpus operator over whole tables, and the pipeline's."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ballast.functions.sizing import staged
from ballast.llm import (
    block_naming,
    byte_cnn,
    host_trust,
    oracle,
    order_minhash,
    packing,
    pfair,
    prefix_trie,
    pu_quality,
    rns_negatives,
    secret_ledger,
    subword_toxicity,
    suffix_tree,
    target_ratio,
)
from ballast.llm.shared import id_bucket


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_secret_ledger(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    ledger = staged(secret_ledger.scan_unseen(docs, "text"), "ledger")
    found = secret_ledger.findings_by_path(docs, "text", ledger)
    base = F.filter("findings", lambda x: x["kind"].isin([r.kind for r in secret_ledger.BASE]))

    def of(kind: str):
        return F.size(F.filter("findings", lambda x: x["kind"] == kind)).cast("bigint")

    return found.select(
        "doc_id",
        of("assign").alias("n_assign"),
        of("access").alias("n_access"),
        of("hex").alias("n_hex"),
        F.sha2(secret_ledger.span_text(base).cast("binary"), 256).alias("base_sha256"),
        secret_ledger.span_text(F.col("findings")).alias("spans"),
    )


def op2_sum_of_squares_packing(spark: SparkSession, folder: str) -> DataFrame:
    pieces = packing.pack(
        _table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json")
    )
    return pieces.select(
        "doc_id",
        "start",
        "length",
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
    )


def op3_order_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return order_minhash.classes(_table(spark, folder, "documents")).drop("row_id")


def op4_host_trust(spark: SparkSession, folder: str) -> DataFrame:
    return host_trust.judge(_table(spark, folder, "pages")).select(
        "page_id", "host", "path", "rule", "verdict"
    )


def op5_block_naming(spark: SparkSession, folder: str) -> DataFrame:
    return block_naming.copies(_table(spark, folder, "documents")).drop("row_id")


def op6_byte_cnn(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    held_out = id_bucket(F.col("doc_id"), 4) == 2
    net = byte_cnn.fit(docs, ~held_out)
    return byte_cnn.predict(docs.select("doc_id", "text"), net).select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score"
    )


def op7_target_ratio(spark: SparkSession, folder: str) -> DataFrame:
    trusted = _table(spark, folder, "labels").filter("quality = 1 and toxic = 0")
    return target_ratio.judge(_table(spark, folder, "documents"), trusted)


def op8_pfair_mixture(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    return pfair.schedule(docs, pfair.tempered(docs)).drop("row_id")


def op9_suffix_tree(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_tree.scores(
        _table(spark, folder, "documents"), id_bucket(F.col("doc_id"), 10) == 0
    )


def op10_pu_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    held_out = id_bucket(F.col("doc_id"), 5) == 0
    scorer = pu_quality.fit(docs, _table(spark, folder, "labels"), ~held_out)
    return pu_quality.score(docs, scorer).select(
        "doc_id",
        held_out.alias("held_out"),
        "score",
        (F.col("score") >= pu_quality.THRESHOLD).cast("int").alias("predicted"),
    )


def op11_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    found = prefix_trie.sequences(_table(spark, folder, "conversations"))
    head = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 4).cast("int")
    return prefix_trie.nodes(prefix_trie.spliced(found, 20, 3, head))


def op12_subword_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    held_out = id_bucket(F.col("doc_id"), 3) == 1
    model = subword_toxicity.fit(docs, _table(spark, folder, "labels"), ~held_out)
    return subword_toxicity.score(docs, model).select(
        "doc_id",
        held_out.alias("held_out"),
        "score",
        (F.col("score") >= subword_toxicity.THRESHOLD).cast("int").alias("predicted"),
    )


def op13_rns_negatives(spark: SparkSession, folder: str) -> DataFrame:
    vectors = _table(spark, folder, "embeddings").withColumn(
        "label",
        F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")),
    )
    return rns_negatives.mine(vectors, F.col("vec_id") % 100 == 0).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )


def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, folder)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        f.__name__: f
        for f in (
            op1_secret_ledger,
            op2_sum_of_squares_packing,
            op3_order_minhash,
            op4_host_trust,
            op5_block_naming,
            op6_byte_cnn,
            op7_target_ratio,
            op8_pfair_mixture,
            op9_suffix_tree,
            op10_pu_quality,
            op11_prefix_trie,
            op12_subword_toxicity,
            op13_rns_negatives,
            pipeline,
        )
    }


def oracle_sql() -> dict[str, str]:
    return oracle.oracle_sql()
