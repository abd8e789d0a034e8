"""From raw documents to packed training sequences, in four stages.

Each stage reads what the stage before it kept, written as Parquet, and calls one operator:
language ID drops what is none of the languages, near-duplicate removal keeps one document of
each group, decontamination takes passages of the benchmark out, packing fills sequences.
All but the last return the columns of ``documents``.

A stage gives an empty result for an empty table, takes nulls and repeated rows as its operator
says, and passes further columns on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from auditweave.llm import decontamination, language_id, packing, simhash
from auditweave.llm.common import id_remainder, load, short_batches
from auditweave.llm.queries import tokenizer_json
from auditweave.sources.shelf import pin


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    short_batches(spark)
    model = language_id.train(docs, id_remainder("doc_id", 5) != 0)
    return language_id.keep_identified(docs, model)


def remove_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    short_batches(spark)
    return simhash.keep_one(docs)


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    short_batches(spark)
    return decontamination.decontaminate(docs, load(spark, sf_dir, "benchmark"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    short_batches(spark)
    return packing.pack(docs, tokenizer_json())


STAGES = [
    ("language_id", identify_language),
    ("simhash_near_dedup", remove_near_duplicates),
    ("benchmark_decontamination", remove_benchmark),
    ("mixture_packing", pack_sequences),
]

#: Language models and fingerprints by XXH64 are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = pin(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
