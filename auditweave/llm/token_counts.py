"""Token counts by a map-side two-tier lookup.

Tier one is a broadcast table of the lengths, in tokens, of the corpus's most frequent text
pieces. Tier two is a cache in each Python worker, which encodes what the table misses and
keeps it from task to task. No piece of text is shuffled: the frequent pieces are found from
one bounded summary per task, and merging those is all that moves.
"""

from __future__ import annotations

import pickle
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auditweave.llm.common import pick
from auditweave.llm.pretokens import LONGEST_KEPT, PieceCache, pieces

#: Pieces in the broadcast table, and in each task's summary.
TABLE_SIZE = 32_768
#: Texts encoded at once.
BATCH = 64
#: Summaries that one merge takes, and how many merges follow each other: the driver gets one
#: summary per MERGED ** MERGES tasks, so a few for a million tasks.
MERGED = 64
MERGES = 3


def _top(counts: Counter, size: int) -> bytes:
    return pickle.dumps(counts.most_common(size))


def _summaries(size: int):
    def run(batches):
        from pyspark import TaskContext

        counts: Counter = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                counts.update(pieces(text)[1:] if text else [])
            if len(counts) > 16 * size:  # lossy, but no result depends on the summary
                counts = Counter(dict(counts.most_common(4 * size)))
        counts = Counter({p: n for p, n in counts.items() if len(p) <= LONGEST_KEPT})
        yield pa.RecordBatch.from_pydict(
            {"place": [TaskContext.get().partitionId()], "top": [_top(counts, size)]}
        )

    return run


def _merge(size: int):
    def run(table: pa.Table) -> pa.Table:
        counts: Counter = Counter()
        for blob in table.column("top"):
            counts.update(dict(pickle.loads(blob.as_py())))
            if len(counts) > 16 * size:
                counts = Counter(dict(counts.most_common(4 * size)))
        place = table.column("place")[0].as_py() // MERGED
        return pa.table({"place": [place], "top": [_top(counts, size)]})

    return run


def frequent_pieces(docs: DataFrame, size: int = TABLE_SIZE) -> list[str]:
    """The ``size`` most frequent pieces of ``text`` by all rows, commonest first."""
    merged = pick(docs, "text").mapInArrow(_summaries(size), "place bigint, top binary")
    for _ in range(MERGES):
        parts = merged.groupBy(F.floor(F.col("place") / MERGED))
        merged = parts.applyInArrow(_merge(size), "place bigint, top binary")
    counts: Counter = Counter()
    for row in merged.collect():
        counts.update(dict(pickle.loads(row.top)))
    return [p for p, _ in sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:size]]


def count_tokens(
    docs: DataFrame, tokenizer_json: str, limit: int = 1024, table_size: int = TABLE_SIZE
) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_bytes, n_tokens, over_limit.

    ``tokenizer_json`` is the content of a tokenizer file of the tokenizers library with a
    byte-level pre-tokenizer; counts are what that library gives without added special
    tokens. Null and empty texts have 0 tokens. Repeated rows and rows without an id each
    give a row. An empty table gives an empty result. Other columns are left out.
    """
    from tokenizers import Tokenizer

    spark = docs.sparkSession
    rows = pick(docs, "doc_id", "text")
    frequent = frequent_pieces(docs, table_size)
    codes = Tokenizer.from_str(tokenizer_json).encode_batch_fast(
        [" " + p for p in frequent], add_special_tokens=False
    )
    table = spark.sparkContext.broadcast(
        {"json": tokenizer_json, "lengths": {p: len(c.ids) for p, c in zip(frequent, codes)}}
    )

    def run(batches):
        state = table.value  # one object per worker, so the cache outlives the task
        if "cache" not in state:
            state["cache"] = PieceCache(state["json"], True, state["lengths"])
        for batch in batches:
            for i in range(0, batch.num_rows, BATCH):
                part = batch.slice(i, BATCH)
                texts = part.column(1).to_pylist()
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array([len(t.encode()) if t else 0 for t in texts], pa.int64()),
                        pa.array([sum(v) for v in state["cache"].batch(texts)], pa.int64()),
                    ],
                    ["doc_id", "n_bytes", "n_tokens"],
                )

    kind = rows.schema["doc_id"].dataType.simpleString()
    counted = rows.mapInArrow(run, f"doc_id {kind}, n_bytes bigint, n_tokens bigint")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
