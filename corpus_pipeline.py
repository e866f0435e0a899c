"""Corpus pipeline: five stages over the documents, each written and read again.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last
return the columns of documents.  Learned and counted facts come from the
stage's own input and from the tables in ``sf_dir``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tollgate.llm import decontaminate, jaccard_join, packing, rff_quality, secrets
from tollgate.llm.common import doc_hash_remainder, materialize, read


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier doesn't reject."""
    model, _ = rff_quality.train(docs, read(spark, sf_dir, "labels"), doc_hash_remainder(F.col("doc_id"), 5) != 0)
    return rff_quality.keep_good(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest document of each group linked by five-word shingles at 0.8."""
    return jaccard_join.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.drop_contaminated(docs, read(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, live secrets masked; n_chars follows the text."""
    repo = F.concat_ws("/", "source", "lang")
    out = secrets.redact(docs, F.col("source"), repo)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents, placed in sequences."""
    return packing.pack(docs)


STAGES = [("quality classifier", quality), ("n-gram Jaccard join", near_duplicates), ("benchmark decontamination", decontamination),
          ("secret scans", secret_scan), ("best-fit packing", pack)]

#: SQL can express neither the classifier nor the tokenizer; tests compare with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs
