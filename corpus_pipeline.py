"""Documents on their way to training: two quality filters, near copies, personal data, packing.

Each stage takes ``(spark, docs, sf_dir)`` and returns a frame, which is written and read again
as the next stage's ``docs``. Stages but the last keep the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultline.llm import attention_quality, ngram_quality, packing, personal, simhash
from vaultline.sources.scratch import keep

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def _others(docs: DataFrame) -> list:
    """The columns that an operator has to carry besides id and text; the text goes under another name."""
    return [F.col("doc_id").alias("__doc_id"), F.col("text").alias("__text")] + [
        F.col(name).alias(f"__{name}") for name in docs.columns if name not in ("doc_id", "text")
    ]


def _as_before(docs: DataFrame, found: DataFrame) -> DataFrame:
    return found.select(*[F.col(f"__{name}").alias(name) for name in docs.columns])


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the plain rules and the n-gram classifier."""
    classifier = ngram_quality.train(docs, _labels(spark, sf_dir))
    return _as_before(docs, ngram_quality.judge(docs, classifier, *_others(docs)).where("kept"))


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the attention network scores as good.

    It is fitted on the documents of the folder: those that came here hold hardly any bad ones to learn from.
    """
    network = attention_quality.train(_documents(spark, sf_dir), _labels(spark, sf_dir))
    scored = attention_quality.score(docs, network, *_others(docs))
    return _as_before(docs, scored.where(F.col("score") >= attention_quality.GOOD_FROM))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that with the smallest id."""
    return simhash.first_of_groups(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data in their texts replaced by its kind; ``n_chars`` follows."""
    found = personal.find(docs, *_others(docs))
    clean = F.when(F.size("spans") > 0, personal.redacted(F.col("__text"), F.col("spans"))).otherwise(F.col("__text"))
    found = found.withColumn("__text", clean)
    if "n_chars" in docs.columns:
        changed = F.when(F.size("spans") > 0, F.length("__text").cast("long")).otherwise(F.col("__n_chars"))
        found = found.withColumn("__n_chars", changed)
    return _as_before(docs, found)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of at most 2048 tokens."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), special=True)


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality_rules),
    ("quality classifier", quality_classifier),
    ("near duplicates", near_duplicates),
    ("personal data", personal_data),
    ("packing", packed),
]

#: Learned models decide in the first two stages, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs = _documents(spark, sf_dir)
    for at, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if at < len(STAGES) - 1:
            docs = keep(docs, name.replace(" ", "-"))
    return docs
