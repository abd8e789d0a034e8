"""Removal of lines that many documents share, as bitmaps of the lines to keep.

Every line of some length becomes a row of its hash, document and position. The rows are
partitioned by ranges of (hash, document) and sorted by hash, document (largest first) and
position, so a task streams over the documents that hold a line: the first one keeps it, and
once enough documents have come the others lose it. A line that a third of all documents hold
spreads over as many ranges as its rows need. What a range cannot decide alone are its first
and its last line; two summary rows a range settle them.

The result is a small table: per document with lost lines one compressed bitmap. Texts are
not shuffled to find it; only ``apply`` brings texts and bitmaps together.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from auditweave.llm.common import pick
from auditweave.sources.shelf import pin

#: Code points that a line needs, and documents that must share it.
MIN_CHARS = 40
MIN_DOCS = 5
#: ASCII letters to lower case.
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_WHITE = b" \t\n\v\f\r"
_CONTINUED = bytes(range(0x80, 0xC0))
#: Rows of one output batch.
_OUT_ROWS = 50_000

#: What tells the rows of a table apart: a text's id, hash and length.
KEY = ["doc_id", "text_hash", "text_bytes"]


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return pick(docs, "doc_id", "text").select(
        "doc_id",
        text.alias("text"),
        F.xxhash64(text).alias("text_hash"),
        F.octet_length(text).alias("text_bytes"),
    )


def line_key(line: bytes) -> bytes:
    """What makes lines equal; the line's letters are in lower case already."""
    return line.strip(_WHITE)


def _hasher(min_chars: int, schema: pa.Schema):
    """Batches of texts to batches of (KEY, position, hash in two numbers)."""

    def run(batches):
        import xxhash

        digest = xxhash.xxh3_128_digest
        for batch in batches:
            rows: list[int] = []
            places: list[int] = []
            hashes: list[bytes] = []

            def flush():
                halves = np.frombuffer(b"".join(hashes), "<i8").reshape(-1, 2)
                take = pa.array(rows, pa.int64())
                columns = [batch.column(batch.schema.get_field_index(k)).take(take) for k in KEY]
                columns += [pa.array(places, pa.int32())]
                columns += [pa.array(np.ascontiguousarray(halves[:, i])) for i in (0, 1)]
                out = pa.RecordBatch.from_arrays(columns, schema=schema)
                for held in (rows, places, hashes):
                    held.clear()
                return out

            texts = batch.column(batch.schema.get_field_index("text"))
            for i in range(len(texts)):
                text = texts[i].as_py()
                for place, line in enumerate(text.encode().translate(_LOWER).split(b"\n")):
                    if len(line) < min_chars:
                        continue
                    line = line_key(line)
                    if len(line) < min_chars:
                        continue
                    if len(line.translate(None, _CONTINUED)) < min_chars:
                        continue
                    rows.append(i)
                    places.append(place)
                    hashes.append(digest(line))
                    if len(rows) >= _OUT_ROWS:
                        yield flush()
            if rows:
                yield flush()

    return run


def line_rows(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """A row (KEY, pos, h1, h2) for every line of at least ``min_chars`` code points."""
    keyed = _keyed(docs)
    schema = T.StructType(
        [keyed.schema[k] for k in KEY]
        + [T.StructField("pos", T.IntegerType())]
        + [T.StructField(h, T.LongType()) for h in ("h1", "h2")]
    )
    return keyed.mapInArrow(_hasher(min_chars, _arrow(schema)), schema)


def _arrow(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def _changed(column: pa.Array, before: list) -> np.ndarray:
    """Where a value differs from the one before it; ``before`` holds the last one seen."""
    old = pa.concat_arrays([pa.array(before, column.type), column.slice(0, len(column) - 1)])
    equal = pc.fill_null(pc.equal(column, old), False)
    equal = pc.or_(equal, pc.and_(pc.is_null(column), pc.is_null(old)))
    return ~equal.to_numpy(zero_copy_only=False)


def _streamer(min_docs: int, schema: pa.Schema):
    """Over one sorted range: rows to drop, rows still open, and summaries of two runs.

    A run is the rows of one hash. kind "drop": the line goes. kind "open": it goes if its hash
    turns out to be in enough documents and its document is not the first. kind "run": of the
    range's first and of its last run the number of documents here, the first and the last one.
    """
    row_fields = [*KEY, "pos", "h1", "h2"]

    def rows(batch, mask, kind):
        part = batch.filter(pa.array(mask))
        columns = [part.column(part.schema.get_field_index(c)) for c in row_fields]
        columns.append(pa.array([kind] * len(part), pa.string()))
        columns += [pa.nulls(len(part), f.type) for f in list(schema)[len(columns) :]]
        return pa.RecordBatch.from_arrays(columns, schema=schema)

    def summary(at: dict, n_docs: int, first_doc):
        values = {**at, "kind": "run", "n_docs": n_docs, "first_doc": first_doc}
        values["last_doc"] = values.pop("doc_id")
        columns = [pa.array([values.get(f.name)], f.type) for f in schema]
        return pa.RecordBatch.from_arrays(columns, schema=schema)

    def run(batches):
        last: dict = {}  # hash and document of the row before
        n_docs, first_doc, in_first = 0, None, True  # of the run that goes on
        held: list[pa.RecordBatch] = []  # its rows that wait for enough documents
        for batch in batches:
            n = len(batch)
            if n == 0:
                continue
            col = {c: batch.column(batch.schema.get_field_index(c)) for c in ("h1", "h2", "doc_id")}

            def at(i):
                return {c: col[c][int(i)].as_py() for c in col}

            began = not last
            if began:
                last, first_doc = at(0), at(0)["doc_id"]
            new_run = _changed(col["h1"], [last["h1"]]) | _changed(col["h2"], [last["h2"]])
            new_doc = _changed(col["doc_id"], [last["doc_id"]]) | new_run
            new_doc[0] |= began
            starts = np.flatnonzero(new_run)
            segment = np.cumsum(new_run)  # 0: the run that goes on
            counted = np.cumsum(new_doc)
            place = counted - np.concatenate([[-n_docs], counted[starts] - 1])[segment]
            ends = np.concatenate([starts, [n]]) - 1
            totals = np.where(ends >= 0, place[ends], n_docs)
            total = totals[segment]
            if held and totals[0] >= min_docs:
                for part in held:
                    yield rows(part, np.ones(len(part), bool), "drop")
                held = []
            if len(starts):
                held = []
            opening = (segment == 0) & in_first
            late = ~opening & (place > 1)
            if opening.any():
                yield rows(batch, opening, "open")
            gone = late & (total >= min_docs)
            if gone.any():
                yield rows(batch, gone, "drop")
            wait = late & (total < min_docs) & (segment == segment[-1])
            if wait.any():
                held.append(batch.filter(pa.array(wait)))
            if len(starts):
                if in_first:
                    yield summary(at(ends[0]) if ends[0] >= 0 else last, int(totals[0]), first_doc)
                    in_first = False
                first_doc = at(starts[-1])["doc_id"]
            n_docs, last = int(place[-1]), at(n - 1)
        if last:
            for part in held:
                yield rows(part, np.ones(len(part), bool), "open")
            yield summary(last, n_docs, first_doc)

    return run


def _packer(schema: pa.Schema):
    """Positions of lost lines to a bitmap of kept ones, packed and deflated."""

    def run(batches):
        for batch in batches:
            positions = batch.column(batch.schema.get_field_index("lost"))
            maps = []
            for i in range(len(batch)):
                lost = np.asarray(positions[i].values)
                keep = np.ones(int(lost.max()) // 8 * 8 + 8, bool)
                keep[lost] = False
                maps.append(zlib.compress(np.packbits(keep, bitorder="little").tobytes()))
            columns = [batch.column(batch.schema.get_field_index(k)) for k in KEY]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(maps, pa.binary())], schema=schema)

    return run


def keep_bitmaps(
    docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS
) -> DataFrame:
    """Which lines of ``docs`` (doc_id, text) stay, as one bitmap per text that loses some.

    A line's key is the line without ASCII white space at both ends, ASCII letters in lower
    case. A key of at least ``min_chars`` code points found in at least ``min_docs`` documents
    loses all its lines but those in the largest doc_id that holds it. Returns doc_id,
    text_hash, text_bytes and keep: a deflated bitmap, lowest bit first, of the lines up to the
    last one that goes; later lines stay, as do all lines of a text without a row here.

    Rows of one doc_id are one document. All null doc_ids are one document, smaller than any
    other. Null and empty texts are one empty line and never get a row. Equal rows share a row.
    Further columns take no part; an empty table gives an empty one.
    """
    lines = line_rows(docs, min_chars)
    largest = F.col("doc_id").desc_nulls_last()
    order = [F.col("h1"), F.col("h2"), largest, F.col("text_hash"), F.col("text_bytes"), F.col("pos")]
    ranged = lines.repartitionByRange(*order).sortWithinPartitions(*order)
    doc_type = lines.schema["doc_id"].dataType
    schema = T.StructType(
        [T.StructField(f.name, f.dataType) for f in lines.schema]
        + [
            T.StructField("kind", T.StringType()),
            T.StructField("n_docs", T.LongType()),
            T.StructField("first_doc", doc_type),
            T.StructField("last_doc", doc_type),
        ]
    )
    streamed = pin(ranged.mapInArrow(_streamer(min_docs, _arrow(schema)), schema), "lines")
    # a hash lies in as many ranges as it has summaries, and there are two a range at most
    runs = streamed.where("kind = 'run'")
    along = W.partitionBy("h1", "h2").orderBy(
        F.col("first_doc").desc_nulls_last(), F.col("last_doc").desc_nulls_last(), F.col("n_docs").desc()
    )
    shared = F.lag("last_doc").over(along).eqNullSafe(F.col("first_doc")) & (
        F.row_number().over(along) > 1
    )
    runs = runs.withColumn("again", shared.cast("long")).withColumn("no", F.row_number().over(along))
    spread = (
        runs.groupBy("h1", "h2")
        .agg(
            (F.sum("n_docs") - F.sum("again")).alias("total"),
            F.min_by(F.struct("first_doc"), "no").alias("keeper"),
        )
        .where(F.col("total") >= min_docs)
        .select("h1", "h2", F.col("keeper.first_doc").alias("keeper"))
    )
    late = (
        streamed.where("kind = 'open'")
        .join(F.broadcast(spread), ["h1", "h2"])
        .where(~F.col("doc_id").eqNullSafe(F.col("keeper")))
    )
    dropped = streamed.where("kind = 'drop'").select(*KEY, "pos").unionByName(late.select(*KEY, "pos"))
    lost = dropped.groupBy(*KEY).agg(F.collect_set("pos").alias("lost"))
    out = T.StructType([*(lost.schema[k] for k in KEY), T.StructField("keep", T.BinaryType())])
    return lost.mapInArrow(_packer(_arrow(out)), out)


def _applier(with_text: bool, schema: pa.Schema):
    def run(batches):
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text"))
            keeps = batch.column(batch.schema.get_field_index("keep"))
            n_lines, n_dropped, kept, digests = [], [], [], []
            for i in range(len(batch)):
                raw = texts[i].as_py().encode()
                keep = keeps[i].as_py()
                lines, dropped = raw.count(b"\n") + 1, 0
                if keep is not None:
                    bits = np.unpackbits(np.frombuffer(zlib.decompress(keep), np.uint8), bitorder="little")
                    parts = raw.split(b"\n")
                    gone = set(np.flatnonzero(bits[: len(parts)] == 0).tolist())
                    dropped = len(gone)
                    raw = b"\n".join(x for j, x in enumerate(parts) if j not in gone)
                n_lines.append(lines)
                n_dropped.append(dropped)
                digests.append(hashlib.sha256(raw).hexdigest())
                if with_text:
                    kept.append(raw.decode())
            columns = [
                batch.column(batch.schema.get_field_index("doc_id")),
                pa.array(n_lines, pa.int64()),
                pa.array(n_dropped, pa.int64()),
                pa.array(digests, pa.string()),
            ]
            if with_text:
                columns.append(pa.array(kept, pa.string()))
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return run


def apply(docs: DataFrame, bitmaps: DataFrame, with_text: bool = True) -> DataFrame:
    """``docs`` without the lines that ``bitmaps`` (of ``keep_bitmaps``) leave out.

    Returns per row doc_id, n_lines (before), n_dropped, kept_sha256 and, ``with_text``, kept.
    """
    keyed = _keyed(docs)
    maps = bitmaps.select(*[F.col(k).alias(f"_{k}") for k in KEY], "keep")
    on = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in KEY]
    joined = keyed.join(maps, on, "left").select("doc_id", "text", "keep")
    fields = [
        keyed.schema["doc_id"],
        T.StructField("n_lines", T.LongType()),
        T.StructField("n_dropped", T.LongType()),
        T.StructField("kept_sha256", T.StringType()),
    ]
    if with_text:
        fields.append(T.StructField("kept", T.StringType()))
    schema = T.StructType(fields)
    return joined.mapInArrow(_applier(with_text, _arrow(schema)), schema)
