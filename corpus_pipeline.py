"""From raw documents to token ids: every stage works on all that its predecessor kept.

A stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is written as Parquet and
read again as the next stage's ``docs``. All but the last return the columns of ``documents``; a
stage that cuts texts sets ``n_chars`` to what is left. Empty tables pass through as empty tables;
what happens to nulls, ties and repeated rows is stated by each stage's operator.
"""

from __future__ import annotations

import hashlib

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidestock.llm import chosen_path, decontaminate, line_dedup, piece_codec, quality_rules
from tidestock.session import staged


def _counted(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast(dict(docs.dtypes)["n_chars"])) if "n_chars" in docs.columns else docs


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the certified cutoffs of their language."""
    return quality_rules.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without lines that an earlier line equals within one edit; documents that lose all their text go."""
    cut, _, removed = line_dedup.dedup_lines(docs)
    left = (F.col(removed) == 0) | F.col("text").rlike("[^ \\t\\n\\x0B\\f\\r]")
    return _counted(cut.where(left).select(*docs.columns))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least id of each near-duplicate class."""
    return chosen_path.keep_one(docs)


def benchmark_spans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages cut out; documents that consist largely of them go."""
    return _counted(decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids, and the hash of the text that they decode to."""

    def finish(codec, ids):
        return len(ids), ids, hashlib.sha256(codec.decode(ids).encode()).hexdigest()

    return piece_codec.encoded(
        docs, public_tokenizers.path("piece_bpe_32k.model"), finish, "n_tokens long, ids array<int>, decoded_sha256 string"
    )


STAGES = [
    ("quality rules", quality), ("line dedup", lines), ("n-gram Jaccard join", near_copies),
    ("benchmark decontamination", benchmark_spans), ("SentencePiece encoding and decoding", tokens),
]

#: Binomial tests, components and token ids are beyond SQL; a test holds the rows against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number + 1 < len(STAGES):
            docs = staged(docs, f"pipeline-{number}")
    return docs
