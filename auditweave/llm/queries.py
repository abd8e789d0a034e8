"""The registered queries: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from auditweave.llm import decontamination, fill_in_middle, html_text, language_id, language_model, licenses, line_dedup, nearest, packing, prefix_trie, simhash, statements, token_counts, warc
from auditweave.llm.common import id_remainder, load
from auditweave.sources.shelf import pin


def tokenizer_json() -> str:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return Path(path).read_text(encoding="utf-8")


def op1_html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(load(spark, sf_dir, "pages"))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(load(spark, sf_dir, "documents"))


def op3_warc_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = load(spark, sf_dir, "pages")
    stored = warc.records(*warc.write_archive(pages), full=False)
    page_type = pages.schema["page_id"].dataType.simpleString()
    return warc.resolve(pin(warc.parse(stored), "records"), page_type).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op4_mixture_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(load(spark, sf_dir, "documents"), tokenizer_json())


def op5_maxent_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.score_texts(load(spark, sf_dir, "documents"))


def op6_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.find_overlaps(
        load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark")
    )
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("item_ids"), ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op7_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(load(spark, sf_dir, "documents"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(load(spark, sf_dir, "documents"), tokenizer_json())


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    model = language_id.train(docs, id_remainder("doc_id", 5) != 0)
    found = language_id.identify(docs, model)
    held_out = (id_remainder("doc_id", 5) == 0).alias("held_out")
    return found.select("doc_id", held_out, "lang_pred", "score", "rejected")


def op10_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = load(spark, sf_dir, "embeddings")
    return nearest.nearest(table, table.where(F.col("vec_id") % 20 == 0))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = load(spark, sf_dir, "conversations")
    return prefix_trie.build(conversations, prefix_trie.shared_heads)


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_in_middle.transform(load(spark, sf_dir, "documents"))
    back = fill_in_middle.restored(F.col("output"), F.col("form"))
    return made.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(back, 256).alias("restored_sha256"),
    )


def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    return line_dedup.apply(docs, line_dedup.keep_bitmaps(docs), with_text=False)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_html_main_text,
        op2_license_scan,
        op3_warc_archive,
        op4_mixture_packing,
        op5_maxent_scoring,
        op6_benchmark_decontamination,
        op7_simhash_near_dedup,
        op8_token_counts,
        op9_language_id,
        op10_nearest_neighbours,
        op11_prefix_trie,
        op12_fill_in_middle,
        op13_line_dedup,
    )
}

#: DuckDB statements of the queries that SQL can express.
ORACLES: dict[str, str] = {
    "op3_warc_archive": statements.WARC,
    "op6_benchmark_decontamination": statements.DECONTAMINATION,
    "op11_prefix_trie": statements.PREFIX_TRIE,
    "op12_fill_in_middle": statements.FILL_IN_MIDDLE,
    "op13_line_dedup": statements.LINE_DEDUP,
}
