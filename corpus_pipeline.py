"""Corpus pipeline over ``documents``.

Each stage takes (spark, docs, sf_dir) and gets all rows its predecessor kept;
all but the last return the columns of documents.  ``run`` writes the result
of each stage as Parquet under spark.checkpoint.dir and rereads it.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickforge.llm import bpe, decontam, langid, simhash, suffix_dedup
from tickforge.llm.common import prepare, saved


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a letter and one language in at least half of their
    letters; learnt from those that are not held out.  Null and empty texts go."""
    model = langid.train(docs, ~langid.held_out() & F.col("doc_id").isNotNull())
    return langid.accepted(docs, model)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group (three words, three bits)."""
    return simhash.one_per_group(docs, shingle_words=3, radius=3)


#: Bytes of a repeated string that stage three removes.  The passages to catch
#: have over 50 words; the shortest seen of 51 words has 285 bytes.
PASSAGE_BYTES = 260


def repeat_removal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without byte strings of PASSAGE_BYTES that start anywhere else
    too; n_chars is that of the new text."""
    cut = suffix_dedup.without_repeats(docs, length=PASSAGE_BYTES)
    kind = docs.schema["n_chars"].dataType
    return cut.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars"))
                          .otherwise(F.length("text")).cast(kind))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item (five words, 0.8)."""
    return decontam.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every document left."""
    return bpe.digests(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("language_id", language_id),
    ("simhash_near_dedup", near_dedup),
    ("suffix_array_dedup", repeat_removal),
    ("benchmark_decontamination", decontamination),
    ("byte_bpe", byte_bpe),
]

#: Hashes of words and the model of stage one have no SQL form; the tests hold
#: the rows against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    prepare(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
