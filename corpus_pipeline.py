"""A corpus from raw documents to packed training sequences: STAGES, each an operator of ebbtide.llm.

Every stage takes (spark, docs, sf_dir) and gives documents with their columns, the last one packed pieces. A
stage reads all rows that its predecessor stored.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from ebbtide.llm import exact_dedup, mixing, packing, simhash, toxicity
from ebbtide.llm.common import ROW, read, stored_rows
from ebbtide.session import materialise


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labels at hand, does not call toxic."""
    rows = stored_rows(docs, "documents")
    model = toxicity.fit(docs, read(spark, sf_dir, "labels"))
    toxic = toxicity.score(rows, model, ROW).filter("predicted = 1").select(ROW)
    return rows.join(materialise(toxic, "toxic"), ROW, "left_anti").drop(ROW)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return simhash.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or left out so that the sources take their shares."""
    return mixing.mix(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents, each with its place in a sequence."""
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("simhash_near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: Trees and token ids are beyond SQL; tests compare the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``, each stored before the next reads it."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
