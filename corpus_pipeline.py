"""Raw documents to packed training sequences, by five of the corpus operators.

Each stage reads what its predecessor wrote. Documents without a recognised language
go, then exact copies, then all but one of each class of near duplicates; what is left
is put in the order of the mixture, and packed in that order.

The mixture's decisions are the order of rows: the stage sorts its rows by slot, so each
file, and each run of rows within one, holds the sources in their target proportions.
The packing stage reads such runs and packs each as it comes.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ballast.functions.sizing import staged
from ballast.llm import block_naming, byte_cnn, order_minhash, packing, pfair
from ballast.llm.shared import free_name, id_bucket

# A text that no language explains better than this is rejected.
LEAST_SCORE = 0.35
# Rows that are read, and that go to a Python worker, at a time, unless the application chose
# a number: whole texts are some kilobytes each, and workers and executors hold a few such
# batches.
BATCHES = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.parquet.columnarReaderBatchSize": "1000",
}
# Packing's workers stand beside an executor that the stages before have filled, so they
# tokenise, hand on and keep little at a time.
PACKING = {"slice_bytes": 250_000, "out_bytes": 1_000_000, "kept_words": 50_000}


def _bounded(spark: SparkSession) -> None:
    for key, rows in BATCHES.items():
        if not spark.sparkContext.getConf().contains(key):
            spark.conf.set(key, rows)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents whose text has a letter and a language the model is sure of.
    The model learns from rows with a language that are not held out."""
    _bounded(spark)
    net = byte_cnn.fit(docs, id_bucket(F.col("doc_id"), 4) != 2)
    lang, score = free_name(docs, "_lang"), free_name(docs, "_score")
    judged = byte_cnn.predict(docs, net, lang_pred=lang, score=score)
    known = (F.col(lang) != byte_cnn.UNKNOWN) & (F.col(score) >= LEAST_SCORE)
    return judged.filter(known).drop(lang, score)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the first of each group of equal texts."""
    _bounded(spark)
    return block_naming.drop_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the first of each class of near duplicates."""
    _bounded(spark)
    return order_minhash.drop_near(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order in which the sources' blocks are scheduled."""
    _bounded(spark)
    return pfair.mixed(docs, pfair.tempered(docs))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, with their ids."""
    _bounded(spark)
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), **PACKING)


STAGES = [
    ("language", language),
    ("exact_copies", exact_copies),
    ("near_copies", near_copies),
    ("mixture", mixture),
    ("packing", packed),
]

# Language and packing need a trained network and a tokenizer, which SQL has not.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    name, stage = STAGES[-1]
    return stage(spark, docs, sf_dir)
