"""The corpus pipeline: five stages, each written and read again as the next one's documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidelog.llm.common import stored, table
from tidelog.llm.decontaminate import drop_contaminated
from tidelog.llm.mixing import read_by_mix
from tidelog.llm.secrets import redact_secrets
from tidelog.llm.simhash import keep_one_per_component
from tidelog.llm.toxicity import fit_on, score_toxicity


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.5 or more go. The model is fitted on the labelled rows of the stage's own input."""
    model = fit_on(docs, table(spark, sf_dir, "labels"))
    return score_toxicity(docs, model).where("__toxicity < 0.5").drop("__toxicity")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by SimHash (three-word shingles, two bits at most) the one with the least id stays."""
    return keep_one_per_component(docs, distance=2, words=3)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents stay; secrets in them are replaced by a mark."""
    return redact_secrets(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix reads, in the order it first reads them, with the words it takes and all its readings; also those without id."""
    return read_by_mix(docs)


STAGES = [
    ("toxicity", toxicity),
    ("simhash_near_dedup", near_duplicates),
    ("benchmark_decontamination", decontamination),
    ("secret_scan", secrets),
    ("source_mixing", mixing),
]

#: No SQL: the toxicity stage is a fitted kernel machine and fingerprints hash with XXH64.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
