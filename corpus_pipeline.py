"""The corpus pipeline: documents are filtered, de-duplicated, cleaned of secrets and packed.

Every stage works on all that its predecessor kept, written as Parquet and read back. All but the last
return the columns of ``documents``; null texts count as empty.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brickrow.llm import jaccard_join, packing, quality_classifier, secret_scan, toxicity
from brickrow.llm.common import keep_rows, shared_path, table

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the toxicity model does not reject."""
    given = spark.sparkContext.broadcast(toxicity.fit(docs, table(spark, sf_dir, "labels")))

    def start():
        known: dict = {}
        return lambda texts: np.array([score < toxicity.THRESHOLD for score, _ in given.value.score(texts, known)], bool)

    return keep_rows(docs, start, toxicity.STEP)


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the quality model does not reject."""
    model = quality_classifier.fit(docs, table(spark, sf_dir, "labels"))
    accept = lambda texts: model.score(texts)[0] >= quality_classifier.THRESHOLD
    return keep_rows(docs, lambda: accept, quality_classifier.STEP)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies: the one with the smallest id."""
    return jaccard_join.representatives(docs)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced by a mark, and ``n_chars`` of the text that is left."""
    clean = secret_scan.redact(docs, secret_scan.fit(docs))
    # Columns by place, as further ones may differ from these in case alone.
    names = [f"c{i}" for i in range(len(docs.columns))]
    text, size = (F.col(names[docs.columns.index(c)]) for c in ("text", "n_chars"))
    counted = F.when(text.isNull(), size).otherwise(F.length(text).cast("long"))
    return clean.toDF(*names).withColumn(names[docs.columns.index("n_chars")], counted).toDF(*docs.columns)


def pack_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their places in sequences of 2048 tokens."""
    # Workers share an executor's memory with the other stages, so they keep fewer words.
    return packing.pack(docs, TOKENIZER, kept_words=200_000)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("quality_classifier", keep_quality),
    ("ngram_jaccard_join", keep_one_of_each),
    ("secret_scans", redact_secrets),
    ("best_fit_packing", pack_documents),
]

#: Models are learned and spans decoded on the way, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = shared_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
