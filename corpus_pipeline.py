"""From raw documents to packed training sequences: five stages, each over all that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from uptake.llm import mixing, near, packing, secrets, toxicity
from uptake.llm.common import free_name, table, written
from uptake.sources.shared import remove, scratch


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score stays below the threshold.

    Null and empty texts have no evidence and get the score of the curve's offset; equal texts share their fate, so repeated rows
    stay or go together; without usable labels every row stays.
    """
    model = toxicity.fit(toxicity.training_rows(docs, table(spark, sf_dir, "labels")))
    name = free_name(docs, "_score")
    return toxicity.score(docs, model, name).where(f"`{name}` < {toxicity.THRESHOLD}").select(*[f"`{c}`" for c in docs.columns])


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of SimHash fingerprints of three-word shingles within two bits: the one with the smallest id.

    A null id is the smallest; all null and empty texts are one component; of repeated rows one stays.
    """
    return near.one_of_each(docs)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with the names of secrets' kinds in place of secrets; null texts stay null."""
    return secrets.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often, and as much of the last time, as their source's target takes them.

    Null and empty texts have size 0 and stay once; a null source is a source of its own.
    """
    return mixing.mixed_rows(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents, placed in sequences; a null or empty text is its end token alone."""
    return packing.packed(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near-dedup", drop_near_copies),
    ("secrets", redact_secrets),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: SQL can express neither the fingerprints nor the automaton nor the tokens; tests/llm has brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces. Once a stage's result is written, its intermediates and the result before it are deleted."""
    docs, before = table(spark, sf_dir, "documents"), None
    for k, (name, stage) in enumerate(STAGES):
        if k == len(STAGES) - 1:
            return stage(spark, docs, sf_dir)
        with scratch(spark) as made:
            docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
            kept = made.keep_last()
        if before:
            remove(spark, before)
        before = kept
    return docs
