"""The corpus pipeline: from raw documents to token ids in training order.

``STAGES`` are (name, function) pairs; a function takes (spark, docs, sf_dir)
and returns the next stage's documents, the last one the encoded documents.
``run`` applies them to the table ``documents``; what a stage keeps is written
to the shared folder and read again by the next.

A learned model decides in the first stage, so SQL cannot express ``run``; the
tests hold every stage against a brute-force version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riverlens.llm import bpe, linededup, mixing, neardup, queries, toxicity
from riverlens.llm.common import cut
from riverlens.sources.tables import read_table


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the severity model, fitted on the labels, does not reject."""
    grades = toxicity.label_grades(read_table(spark, sf_dir, "labels"))
    return toxicity.keep_clean(docs, toxicity.fit(docs, grades))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents; of each cross-site line only the first occurrence is left."""
    return linededup.remove_boilerplate(docs)


def dedup_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each near-duplicate class."""
    return neardup.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The training stream: documents as often as the mix takes them, in order of position."""
    return mixing.mix(docs)


def encode_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document of the stream, with digests of the ids and of their decoding.

    ``docs`` is the written stream; ``position`` is a row's place in it, and the rows are sorted by it.
    Workers outlive the stage, so they remember less here than in a job of its own.
    """
    return bpe.round_trip(mixing.stream_order(docs), *queries.tokenizer(), with_ids=True, memory=40_000,
                          carried=["position"])


STAGES = [
    ("toxicity", reject_toxic),
    ("line_dedup", dedup_lines),
    ("near_dedup", dedup_near),
    ("mix", mix_sources),
    ("bpe", encode_texts),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
