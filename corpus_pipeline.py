"""From raw documents to packed sequences: five stages over the ``documents`` table.

Every stage takes ``(spark, docs, sf_dir)`` and works on all that the stage before it kept; its
result is written and read again before the next one.  All but the last return the columns
of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bikelake.llm import langid, mixing, ngram_join, packing, quality
from bikelake.llm.common import ship_package, small_batches, table, written


def _ready(spark: SparkSession) -> None:
    """Before a stage that hands whole texts to Python."""
    ship_package(spark)
    small_batches(spark)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents whose language is not known: no letters, or too far from every centroid."""
    _ready(spark)
    model = langid.train(docs.filter(~langid.folds("doc_id", 3, 1)))
    return docs.filter(~langid.classifier(model)(F.col("text"))["rejected"])


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that score below the cut."""
    _ready(spark)
    labels = table(spark, sf_dir, "labels").filter(~langid.folds("doc_id", 4, 2))
    model = quality.train(docs, labels)
    return docs.filter(quality.scorer(model)(F.col("text")) >= quality.SHOWN_AT)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each component of the n-gram similarity join."""
    _ready(spark)
    return ngram_join.keep_one(spark, docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bring all documents into the order that mixes the sources to their target weights."""
    return mixing.mix(spark, docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack neighbours in the mixed order into sequences."""
    _ready(spark)
    return packing.pack(spark, docs, in_order=True)


STAGES = [
    ("language_id", language_id),
    ("quality_classifier", quality_classifier),
    ("near_duplicates", near_duplicates),
    ("source_mixing", source_mixing),
    ("best_fit_packing", best_fit_packing),
]

#: The stages learn models and pack by local search, which SQL cannot express; the result is
#: tested against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; the packed pieces."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(spark, stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
