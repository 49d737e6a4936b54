"""A corpus pipeline: quality classifier, line dedup, near-dedup, packing.

``STAGES`` are (name, function) pairs; a function takes (spark, docs, sf_dir) and
returns a DataFrame, which is written as Parquet and read again as the next one's
``docs``. All but the last return the columns of documents.

Defined cases, in every stage: further columns of ``docs`` do not go on, whatever
their names; the columns of documents must be there. Null texts are scored and
packed like empty ones (which have no piece). Repeated rows share the classifier's
decision and lose the same lines; near-dedup keeps one of them, the one of the
least id (null ids last). Texts without words stay, once for each id, and all of
null ids. Ties and long texts: as in the operators. Empty tables give empty ones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.llm.common import written
from stratum.llm.line_dedup import drop_common_lines
from stratum.llm.near_dedup import drop_near_copies
from stratum.llm.packing import best_fit, word_count
from stratum.llm.quality_classifier import HELD_OUT, fit, score

MIN_SCORE = 0.3
DOCUMENT = ["doc_id", "text", "lang", "source", "n_chars"]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(f"NOT ({HELD_OUT})")
    model = fit(docs, labels)
    return score(docs, model, "__score").where(F.col("__score") >= MIN_SCORE).select(DOCUMENT)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that at least 10 of the kept documents hold leave every document."""
    return drop_common_lines(docs, min_docs=10).withColumn("n_chars", F.char_length("text").cast("long")).select(DOCUMENT)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return drop_near_copies(docs, threshold=0.8).select(DOCUMENT)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The kept documents' pieces in bins."""
    return best_fit(docs.select("doc_id", word_count().alias("n_tokens")))


STAGES = [
    ("quality classifier", quality),
    ("line dedup", line_dedup),
    ("MinHash near-dedup", near_dedup),
    ("best-fit packing", packing),
]

#: A fitted model and a best-fit order are beyond SQL; tests/llm/test_pipeline.py compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"), texts=True)
    return docs
