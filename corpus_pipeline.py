"""The corpus pipeline: documents through five operators, each stage written before the next one.

    run(spark, sf_dir) -> DataFrame of doc_id, n_tokens, ids_sha256, decoded_sha256

Each stage takes all rows that the one before it kept. All but the last return the columns of
documents. Extra columns pass through; null texts count as empty.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tallyfold.llm import decontaminate, secrets, sentencepiece_codec, simhash, toxicity
from tallyfold.llm.common import ship
from tallyfold.sources.tables import drop_folder, scope, shared_dir

PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")
RANKS, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on this stage's labelled rows, does not reject."""
    ship(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.not_toxic(docs, labels)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the least id."""
    ship(spark)
    return simhash.one_of_each(docs, shingle=4, radius=4)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth of the words are benchmark passages."""
    ship(spark)
    return decontaminate.decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, found secrets replaced by a mask."""
    ship(spark)
    return secrets.redacted(docs, RANKS, PATTERN)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the encoded and the decoded text."""
    ship(spark)
    encoded = sentencepiece_codec.encode_and_decode(docs.select("doc_id", "text"), PIECE_MODEL)
    return encoded.select("doc_id", "codec.n_tokens", "codec.ids_sha256", "codec.decoded_sha256")


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_duplicates),
    ("benchmark_decontamination", drop_contaminated),
    ("secret_scan", mask_secrets),
    ("sentencepiece", encode),
]

#: A trained classifier, XXH64 and merges can't be written in SQL; tests hold the stages against
#: brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows. A stage's own tables go when its rows are written, and these when the
    next stage's are."""
    docs, last = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        folder = shared_dir(spark)
        with scope(spark):
            stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        if last is not None:
            drop_folder(spark, last)
        last = folder
    return docs
