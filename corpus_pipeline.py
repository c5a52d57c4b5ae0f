"""A training corpus from raw documents: quality, exact and near copies, benchmark passages, source mix.

Each stage takes (spark, docs, sf_dir) and gets the rows that the stage before it wrote; all but the last return rows of
docs with all their columns. The last returns a row for each reading of a document in the mix. Null texts and ids,
empty texts, repeated rows and extra columns are handled as the operators say; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from terraflux.llm import decontamination, exact_dedup, mixing, near_dedup, quality
from terraflux.llm.common import table
from terraflux.sources.scratch import drop, scratch, step_scratch

#: The columns of documents.
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go; it learns from the labelled documents among those given."""
    return quality.drop_low_quality(docs, table(spark, sf_dir, "labels"))


def keep_one_copy(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of texts that are equal without white space stays."""
    return exact_dedup.drop_copies(docs)


def keep_one_near_copy(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: five-word shingles, similarity of 0.8 or more."""
    return near_dedup.drop_near_copies(docs)


def keep_clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that benchmark passages make up a twentieth of, or more, go."""
    return decontamination.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The readings that fill the token budget by the weights of domains, languages and sources."""
    return mixing.mix(docs)


STAGES = [
    ("quality", keep_quality),
    ("exact_dedup", keep_one_copy),
    ("near_dedup", keep_one_near_copy),
    ("decontamination", keep_clean),
    ("mixing", mix_sources),
]

#: The classifier is trained, which SQL does not express; tests hold what each stage keeps against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each stage's rows are written before the next begins; its working tables, and the rows that it was given, go then."""
    docs, given = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        path = scratch(spark, f"pipeline-{name}")
        with step_scratch(spark, f"pipeline-work-{name}"):
            kept = stage(spark, docs, sf_dir)
            kept.write.parquet(path)
        if given:
            drop(spark, given)
        docs, given = spark.read.schema(kept.schema).parquet(path), path
    return STAGES[-1][1](spark, docs, sf_dir)
