"""Mixture-controlled packing by deficit round-robin over source queues.

Each source is a queue of equal chunks of ``chunk`` tokens; a window takes ``window`` tokens.
Round-robin goes round by round: in each round a source's deficit grows by its share of a
window, it sends as many chunks as the deficit pays for, and the rest is carried on. With
equal chunks the deficit after any round is (rounds x share x window) modulo the chunk, so
the round in which the k-th chunk of a source leaves follows from k and the share alone.
That is how deficits pass from window to window and from partition to partition without a
task that sees all rows: the rounds order the chunks, and a distributed running sum places
them in windows.

A task cuts the documents it reads into chunks source by source. What is left of a source
at the end of a task, less than a chunk, carries its ids. A running sum joins what all tasks
left of a source, it is cut into chunks again, and these go to the end of the source's queue.
Less than a chunk per source then remains, whatever the number of tasks; it goes behind the
chunks, where it is cut at window borders. So all windows but the last are full.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from auditweave.llm.common import pick
from auditweave.llm.pretokens import PieceCache
from auditweave.operators.ordering import running_offset
from auditweave.sources.shelf import pin

WINDOW = 2048
CHUNK = 256
BATCH = 64
#: Text pieces that a worker keeps.
ROOM = 500_000


def _cutter(state, window: int, chunk: int, end_id: int, keep_ids: bool, names: list[str]):
    def run(batches):
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        have = state.value
        if "cache" not in have:
            have["cache"] = PieceCache(have["json"], lengths=False, room=ROOM)
        end = np.array([end_id], "<u4").tobytes()
        sent: dict[str, int] = {}  # full chunks of a source so far
        open_: dict[str, list] = {}  # pieces of its chunk that is not full yet, ids as bytes
        size: dict[str, int] = {}

        def close(source):
            k = sent.get(source, 0)
            at = 0
            for doc, start, ids, total in open_.pop(source, []):
                n = len(ids) // 4
                out.append(
                    (doc, start, n, zlib.crc32(ids), total, source, part, k, at)
                    + ((ids if keep_ids else None),)
                )
                at += n
            sent[source] = k + 1
            size[source] = 0

        def table(rows):
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), types)], names
            )

        types = [None, *[pa.int64()] * 4, pa.string(), pa.int64(), pa.int64(), pa.int64()]
        types += [pa.binary()]
        for batch in batches:
            types[0] = batch.schema.field(0).type
            for i in range(0, batch.num_rows, BATCH):
                piece = batch.slice(i, BATCH)
                out: list[tuple] = []
                for doc, source, codes in zip(
                    piece.column(0).to_pylist(),
                    piece.column(1).to_pylist(),
                    have["cache"].batch(piece.column(2).to_pylist()),
                ):
                    codes.append(end)
                    ids = b"".join(codes)
                    total, start = len(ids) // 4, 0
                    while start < total:
                        n = min(chunk - size.get(source, 0), total - start)
                        open_.setdefault(source, []).append(
                            (doc, start, ids[4 * start : 4 * (start + n)], total)
                        )
                        size[source] = size.get(source, 0) + n
                        start += n
                        if size[source] == chunk:
                            close(source)
                if out:
                    yield table(out)
        rest = []
        for source, held in open_.items():
            at = 0
            for doc, start, ids, total in held:
                n = len(ids) // 4
                rest.append((doc, start, n, None, total, source, part, -1, at, ids))
                at += n
        if rest:
            yield table(rest)

    return run


def _split_rest(window: int):
    """Cuts pieces at places that are multiples of ``window``."""

    def run(batches):
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                ids = np.frombuffer(row["ids"], "<u4")
                at = 0
                while at < len(ids):
                    n = min(window - (row["pos"] + at) % window, len(ids) - at)
                    cut = ids[at : at + n]
                    rows.append(
                        row
                        | {
                            "start": row["start"] + at,
                            "length": n,
                            "ids_crc32": zlib.crc32(cut.tobytes()),
                            "pos": row["pos"] + at,
                            "ids": cut.tobytes(),
                        }
                    )
                    at += n
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=batch.schema)

    return run


def pack(
    docs: DataFrame,
    tokenizer_json: str,
    window: int = WINDOW,
    chunk: int = CHUNK,
    end_id: int = 1,
    mixture: dict[str, float] | None = None,
    with_ids: bool = False,
) -> DataFrame:
    """Packs every token of ``docs`` (doc_id, source, text) into sequences of ``window``.

    A document is its ids, without added special tokens, then ``end_id``; a null or empty
    text is the end id alone. Per piece: doc_id, source, start, length, ids_crc32,
    doc_tokens, sequence_id, offset, and its ids as little-endian 32-bit numbers on request.

    ``mixture`` gives target weights by source, by default the sources' own shares, so that
    all queues end together. A source without a weight comes after the others; when a queue
    ends early the others go on at their shares. A null source is the source "". ``chunk``
    must divide ``window``. Repeated rows are packed as often as they occur, also under one
    id; an empty table gives an empty result; further columns are left out.
    """
    if window % chunk:
        raise ValueError("chunk must divide window")
    spark = docs.sparkSession
    rows = pick(docs, "doc_id", "source", "text").select(
        "doc_id", F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source"), "text"
    )
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = (
        f"doc_id {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
        "source string, part bigint, k bigint, at bigint, ids binary"
    )
    names = [c.split()[0] for c in schema.split(", ")]
    state = spark.sparkContext.broadcast({"json": tokenizer_json})
    # written once: which task read which rows must not change between the steps below
    cut = pin(rows.mapInArrow(_cutter(state, window, chunk, end_id, with_ids, names), schema), "cut")
    full = cut.where("k >= 0")

    # number of full chunks by source and task; a source has one row per task here
    held = full.groupBy("source", "part").agg((F.max("k") + 1).alias("chunks"))
    before = W.partitionBy("source").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    bases = held.withColumn("base", F.coalesce(F.sum("chunks").over(before), F.lit(0)))
    queues = held.groupBy("source").agg(F.sum("chunks").alias("queue"))
    # what tasks have left of a source, one behind the other, is cut into chunks again
    left = running_offset(cut.where("k < 0"), ["source", "part", "at"], "length", "pos")
    ends = left.groupBy("source").agg(
        F.min("pos").alias("first"), F.floor(F.sum("length") / chunk).alias("more")
    )
    left = left.join(ends, "source").withColumn("pos", F.col("pos") - F.col("first")).drop("first")
    left = pin(left.mapInArrow(_split_rest(chunk), left.schema), "left")
    tails = queues.select("source", F.col("queue").alias("tail"))
    again = (
        left.where(F.col("pos") < F.col("more") * chunk)
        .join(tails, "source", "left")
        .withColumns(
            {
                "number": F.coalesce("tail", F.lit(0)) + F.floor(F.col("pos") / chunk),
                "at": F.col("pos") % chunk,
                "ids": F.col("ids") if with_ids else F.lit(None).cast("binary"),
            }
        )
    )
    queues = (
        queues.unionByName(ends.select("source", F.col("more").alias("queue")))
        .groupBy("source")
        .agg(F.sum("queue").alias("queue"))
    )
    if mixture is None:
        weight = F.col("queue").cast("double")
    else:
        pairs = [x for s, w in mixture.items() for x in (F.lit(s), F.lit(float(w)))]
        weight = F.coalesce(F.try_element_at(F.create_map(*pairs), F.col("source")), F.lit(0.0))
    queues = queues.withColumn("weight", weight)
    total = queues.agg(F.sum("weight")).first()[0] or 1.0
    shares = queues.select("source", (F.col("weight") / total).alias("share"))
    credit = F.col("share") * window
    numbered = full.join(bases.select("source", "part", "base"), ["source", "part"]).withColumn(
        "number", F.col("base") + F.col("k")
    )
    piece = ["doc_id", "source", "start", "length", "ids_crc32", "doc_tokens", "ids", "number", "at"]
    rounds = (
        numbered.select(*piece)
        .unionByName(again.select(*piece))
        .join(shares, "source")
        .withColumn(
            "round",
            F.when(
                F.col("share") > 0, F.ceil((F.col("number") + 1) * chunk / credit) - 1
            ).otherwise(F.lit(1 << 60)),
        )
    )
    out = ["doc_id", "source", "start", "length", "ids_crc32", "doc_tokens", "pos", "ids"]
    placed = running_offset(rounds, ["round", "source", "number", "at"], "length", "pos").select(*out)
    # the last pieces of each source follow
    filled = queues.agg(F.sum("queue")).first()[0] or 0
    last = left.where(F.col("pos") >= F.col("more") * chunk).withColumnRenamed("pos", "at_source")
    behind = (
        running_offset(last, ["source", "at_source"], "length", "pos")
        .withColumn("pos", F.col("pos") + filled * chunk)
        .select(*out)
    )
    behind = behind.mapInArrow(_split_rest(window), behind.schema)
    packed = placed.unionByName(behind).select(
        "doc_id",
        "source",
        "start",
        "length",
        "ids_crc32",
        "doc_tokens",
        F.floor(F.col("pos") / window).cast("long").alias("sequence_id"),
        (F.col("pos") % window).alias("offset"),
        "ids",
    )
    return packed if with_ids else packed.drop("ids")
