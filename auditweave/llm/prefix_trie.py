"""Trie of the prefixes that conversations share.

A turn becomes an id of its role and text. The ids of a conversation stand side by side in
columns, a block of eight turns to a row, and one ``GROUP BY block, prior, ROLLUP(t0, ..., t7)``
aggregates all prefixes of all conversations at once; ``grouping_id`` tells how long each is.
A longer conversation goes on in further rows, keyed by the node that the block before ends in.

* A node is known by its depth and two sums of hashes over (position, turn id). Sums can be
  taken in any order and continued from block to block, so a conversation of any length is
  never gathered in one task.
* Equal conversations become one row with a count before anything else. Sums over subtrees
  are a second ROLLUP: every node is owned by the smallest conversation through it, every owner
  brings the total of its nodes, and what it owns above a node is taken off again.
* Positions come from one global order, whose rows are numbered range by range, so neither a
  long conversation nor a frequent first turn ends up in one task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from auditweave.llm.common import pick
from auditweave.operators.ordering import number_unique, sorted_table
from auditweave.sources.shelf import pin

#: Turns side by side in a row.
BLOCK = 8
#: Ids joined to one text when the ids of equal conversations are listed.
CHUNK = 4096
_ID_BYTES = 16
_WORDS = r"[^\x20\x09-\x0D]+"
_SUM = "decimal(38,0)"


def turn_id(role: Column, text: Column) -> Column:
    """16 bytes of the SHA-256 of role and text, then the number of the text's words."""
    whole = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    digest = F.substring(F.sha2(whole, 256), 1, 2 * _ID_BYTES)
    words = F.lpad(F.hex(F.regexp_count(text, F.lit(_WORDS)).cast("long")), 10, "0")
    return F.unhex(F.concat(digest, words))


def _words(item: Column) -> Column:
    return F.conv(F.hex(F.substring(item, _ID_BYTES + 1, 5)), 16, 10).cast("long")


def _lane(lane: int, pos: Column, item: Column) -> Column:
    return F.xxhash64(F.lit(lane), pos.cast("long"), item).cast(_SUM)


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, no, item): turns in a global order by conversation, then turn, null first.

    Equal turn numbers are ordered by role, then by turn id.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turns = pick(conversations, "conv_id", "turn", "role", "text")
    turns = turns.where("conv_id IS NOT NULL").select(
        "conv_id", "turn", role.alias("role"), turn_id(role, text).alias("item")
    )
    numbered = number_unique(turns, ["conv_id", "turn", "role", "item"], "no")
    return numbered.select("conv_id", "no", "item")


def as_they_are(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """Every conversation keeps its own turns."""
    none = F.array().cast("array<binary>")
    return convs.select("*", F.lit(0).alias("skip"), none.alias("head"))


def shared_heads(
    turns: DataFrame, convs: DataFrame, family: int = 20, most: int = 3
) -> DataFrame:
    """Conversation c begins with the first h turns of c - c % ``family`` instead of its own h.

    h is crc32 of the id as text, modulo ``most`` + 1. Where that conversation has fewer turns,
    it begins with all of them, and with none if there is no such conversation.
    """
    first = W.partitionBy("conv_id").orderBy("no")
    heads = (
        turns.where(F.col("conv_id") % family == 0)
        .withColumn("rank", F.row_number().over(first))
        .where(F.col("rank") <= most)
        .groupBy(F.col("conv_id").alias("base"))
        .agg(F.sort_array(F.collect_list(F.struct("rank", "item"))).alias("first_items"))
    )
    skip = F.crc32(F.col("conv_id").cast("string").cast("binary")) % (most + 1)
    whole = convs.withColumn("skip", skip.cast("int")).withColumn(
        "base", F.col("conv_id") - F.col("conv_id") % family
    )
    items = F.coalesce(F.col("first_items.item"), F.array().cast("array<binary>"))
    return whole.join(heads, "base", "left").select(
        *convs.columns, "skip", F.slice(items, F.lit(1), F.col("skip")).alias("head")
    )


def _blocks(turns: DataFrame, plan: DataFrame) -> DataFrame:
    """(conv_id, block, t0.., a, b, filled): turns in rows of BLOCK, with their sums of hashes."""
    own = turns.join(plan.select("conv_id", "first", "skip", F.size("head").alias("kept")), "conv_id")
    pos = F.col("no") - F.col("first") - F.col("skip")
    own = own.where(pos >= 0).select("conv_id", (pos + F.col("kept")).alias("pos"), "item")
    heads = plan.select("conv_id", F.posexplode("head").alias("pos", "item"))
    seq = own.unionByName(heads.withColumn("pos", F.col("pos").cast("long")))
    slot = F.col("pos") % BLOCK
    blocks = seq.groupBy("conv_id", F.floor(F.col("pos") / BLOCK).alias("block")).agg(
        *[F.max(F.when(slot == i, F.col("item"))).alias(f"t{i}") for i in range(BLOCK)],
        *[
            F.sum(_lane(lane, F.col("pos"), F.col("item"))).cast(_SUM).alias(out)
            for lane, out in enumerate("ab")
        ],
        F.count("*").alias("filled"),
    )
    # a conversation without turns still is a member of the root
    nothing = plan.where((F.size("head") == 0) & (F.col("n") <= F.col("skip"))).select(
        "conv_id",
        F.lit(0).cast("long").alias("block"),
        *[F.lit(None).cast("binary").alias(f"t{i}") for i in range(BLOCK)],
        *[F.lit(0).cast(_SUM).alias(out) for out in "ab"],
        F.lit(0).cast("long").alias("filled"),
    )
    return blocks.unionByName(nothing)


def running_sums(table: DataFrame, sums: dict[str, str]) -> DataFrame:
    """Adds to a ``sorted_table`` the sums over all rows before a row, {column: name}.

    One row per range crosses ranges, so the broadcast is as small as the number of ranges.
    """
    before = (W.unboundedPreceding, -1)
    zero = F.lit(0).cast(_SUM)
    ranges = table.groupBy("_range").agg(*[F.sum(c).alias(f"_t_{c}") for c in sums])
    along = W.orderBy("_range").rowsBetween(*before)
    ranges = ranges.select(
        "_range", *[F.coalesce(F.sum(f"_t_{c}").over(along), zero).alias(f"_o_{c}") for c in sums]
    )
    inside = W.partitionBy("_range").orderBy("_place").rowsBetween(*before)
    return table.join(F.broadcast(ranges), "_range").withColumns(
        {
            name: (F.coalesce(F.sum(c).over(inside), zero) + F.col(f"_o_{c}")).cast(_SUM)
            for c, name in sums.items()
        }
    ).drop(*[f"_o_{c}" for c in sums])


def _with_prior(blocks: DataFrame) -> DataFrame:
    """Adds pa and pb, the sums over all earlier blocks: the key of the prior block's node."""
    zero = F.lit(0).cast(_SUM)
    short = blocks.where(F.col("n_turns") <= BLOCK).withColumns({"pa": zero, "pb": zero})
    long = sorted_table(blocks.where(F.col("n_turns") > BLOCK), ["rep", "block"])
    long = running_sums(long, {"a": "ra", "b": "rb"}).drop("_range", "_place")
    start = long.where("block = 0").select(
        "rep", F.col("ra").alias("sa"), F.col("rb").alias("sb")
    )
    long = long.join(start, "rep").withColumns(
        {"pa": (F.col("ra") - F.col("sa")).cast(_SUM), "pb": (F.col("rb") - F.col("sb")).cast(_SUM)}
    )
    return short.unionByName(long.drop("ra", "rb", "sa", "sb"))


def _rollup(rows: DataFrame, aggregates: str) -> DataFrame:
    """All prefixes of the rows' turns at once: depth, the turns, their number and aggregates."""
    turns = ", ".join(f"t{i}" for i in range(BLOCK))
    found = rows.sparkSession.sql(
        f"""
        SELECT block, pa, pb, {turns}, {BLOCK} - bit_count(grouping_id()) AS used, {aggregates}
        FROM {{rows}} GROUP BY block, pa, pb, ROLLUP({turns})
        """,
        rows=rows,
    )
    # shorter conversations leave columns empty; a further block's empty prefix is the node before
    last = F.lit(None).cast("binary")
    for i in range(BLOCK):
        last = F.when(F.col("used") == i + 1, F.col(f"t{i}")).otherwise(last)
    here = last.isNotNull() | ((F.col("used") == 0) & (F.col("block") == 0))
    return found.where(here).withColumn("item", last)


def _nodes(rows: DataFrame) -> DataFrame:
    found = _rollup(rows, "sum(n_copies) AS n_convs, min(struct(rep, n_turns)) AS owner")
    columns = {}
    for lane, (prior, out) in enumerate((("pa", "fa"), ("pb", "fb"))):
        total, before = F.col(prior), F.col(prior)
        for i in range(BLOCK):
            one = _lane(lane, F.col("block") * BLOCK + i, F.col(f"t{i}"))
            total = total + F.when(F.col("used") > i, one).otherwise(F.lit(0).cast(_SUM))
            before = before + F.when(F.col("used") > i + 1, one).otherwise(F.lit(0).cast(_SUM))
        columns |= {out: total.cast(_SUM), f"parent_{out}": before.cast(_SUM)}
    words = F.when(F.col("item").isNotNull(), _words(F.col("item"))).otherwise(F.lit(0))
    return found.select(
        F.col("owner.rep").alias("conv_id"),
        (F.col("block") * BLOCK + F.col("used")).cast("long").alias("depth"),
        F.col("owner.n_turns").alias("n_turns"),
        "n_convs",
        ((F.col("n_convs") - 1) * words).cast(_SUM).alias("saving"),
        *[c.alias(name) for name, c in columns.items()],
    )


def _digests(schema: pa.Schema):
    """Streams over sorted chunks; a group of any size needs one hash state."""

    def run(batches):
        key, state = None, None
        for batch in batches:
            keys, digests = [], []
            for k, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if k == key:
                    state.update(b"," + ids.encode())
                    continue
                if state is not None:
                    keys.append(key)
                    digests.append(state.hexdigest())
                key, state = k, hashlib.sha256(ids.encode())
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.string()), pa.array(digests, pa.string())], schema=schema
            )
        if state is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array([key]), pa.array([state.hexdigest()])], schema=schema
            )

    return run


def _class_key(depth: str, fa: str = "fa", fb: str = "fb") -> Column:
    return F.concat_ws(":", *[F.col(c).cast("string") for c in (depth, fa, fb)])


def _ends(ends: DataFrame) -> DataFrame:
    """(end_key, ends_sha256): SHA-256 of the sorted ids of equal conversations.

    The ids are sorted by all tasks and joined in chunks; only chunks of a group meet in a task,
    where they pass through one hash state. A SHA-256 cannot be split further than that.
    """
    placed = sorted_table(
        ends.select(_class_key("n_turns").alias("end_key"), "conv_id"), ["end_key", "conv_id"]
    )
    ids = F.transform(F.sort_array(F.collect_list("conv_id")), lambda c: c.cast("string"))
    chunks = placed.groupBy(
        "end_key", "_range", F.floor(F.col("_place") / CHUNK).alias("chunk")
    ).agg(F.array_join(ids, ",").alias("ids"))
    order = ["end_key", "_range", "chunk"]
    schema = "end_key string, ends_sha256 string"
    arrow = pa.schema([("end_key", pa.string()), ("ends_sha256", pa.string())])
    streams = chunks.repartition("end_key").sortWithinPartitions(*order).select("end_key", "ids")
    return streams.mapInArrow(_digests(arrow), schema)


def build(
    conversations: DataFrame, arrange: Callable[[DataFrame, DataFrame], DataFrame] = as_they_are
) -> DataFrame:
    """The trie of ``conversations`` (conv_id, turn, role, text), one row per node.

    A node is a distinct sequence of first turns (role, text); its members are the conversations
    that begin with it. Returns conv_id (smallest member), depth, parent_conv_id (null at the
    root), n_convs, n_children, n_leaves, saved_tokens and ends_sha256 (of the sorted ids of the
    members that end there, joined by commas). (conv_id, depth) is a node's key. n_leaves counts
    the childless nodes of the subtree, a node being in its own; saved_tokens sums over it what
    a node's words would cost in all members but one.

    ``arrange`` may give conversations other beginnings, see ``shared_heads``.

    Turns are ordered by turn, null first, then by role and the digest of role and text, so
    ties and repeated rows have a place. Null role or text is empty; rows without conv_id belong
    to no conversation. Further columns take no part. An empty table gives no rows.
    """
    turns = numbered_turns(conversations)
    convs = turns.groupBy("conv_id").agg(F.min("no").alias("first"), F.count("*").alias("n"))
    blocks = pin(_blocks(turns, arrange(turns, pin(convs, "conversations"))), "turn_blocks")
    ends = pin(
        blocks.groupBy("conv_id").agg(
            F.sum("filled").alias("n_turns"),
            F.sum("a").cast(_SUM).alias("fa"),
            F.sum("b").cast(_SUM).alias("fb"),
        ),
        "ends",
    )
    classes = ends.groupBy("n_turns", "fa", "fb").agg(
        F.min("conv_id").alias("rep"), F.count("*").alias("n_copies")
    )
    rows = blocks.withColumnRenamed("conv_id", "rep").drop("filled")
    rows = pin(_with_prior(rows.join(classes.drop("fa", "fb"), "rep")).drop("a", "b"), "prefixes")

    nodes = running_sums(
        sorted_table(_nodes(rows), ["conv_id", "depth"]), {"saving": "saved_before"}
    ).drop("_range", "_place")
    nodes = pin(nodes, "nodes")
    owners = nodes.groupBy("conv_id").agg(
        F.min(F.struct("depth", "parent_fa", "parent_fb", "saved_before")).alias("top"),
        F.max(F.struct("depth", "n_convs", "n_turns")).alias("end"),
        F.sum("saving").cast(_SUM).alias("owned"),
    )
    parents = nodes.select(
        F.col("conv_id").alias("parent_conv_id"),
        (F.col("depth") + 1).alias("depth"),
        F.col("fa").alias("parent_fa"),
        F.col("fb").alias("parent_fb"),
    )
    owners = owners.select(
        "conv_id",
        F.col("top.*"),
        "owned",
        F.col("end.n_convs").alias("end_convs"),
        (F.col("end.depth") == F.col("end.n_turns")).alias("whole"),
    )
    owners = owners.join(parents, ["depth", "parent_fa", "parent_fb"], "left")
    owners = pin(owners.drop("parent_fa", "parent_fb"), "owners")

    # the owners' totals and leaves, summed over all their prefixes
    leaf = F.col("whole") & (F.col("end_convs") == F.col("n_copies"))
    below = rows.join(
        owners.select(F.col("conv_id").alias("rep"), "owned", "end_convs", "whole"), "rep"
    ).withColumn("leaf", leaf.cast("long"))
    totals = _rollup(below, "min(rep) AS conv_id, sum(owned) AS total, sum(leaf) AS n_leaves")
    totals = totals.select(
        "conv_id",
        (F.col("block") * BLOCK + F.col("used")).cast("long").alias("depth"),
        "total",
        "n_leaves",
    )
    branches = (
        owners.where("depth > 0")
        .groupBy(F.col("parent_conv_id").alias("conv_id"), (F.col("depth") - 1).alias("depth"))
        .agg(F.count("*").alias("branches"))
    )
    tops = owners.select(
        "conv_id",
        F.col("depth").alias("top_depth"),
        F.col("saved_before").alias("saved_above"),
        "parent_conv_id",
    )
    whole = (
        nodes.join(totals, ["conv_id", "depth"])
        .join(branches, ["conv_id", "depth"], "left")
        .join(tops, "conv_id")
        .withColumn("end_key", _class_key("depth"))
        .join(_ends(ends), "end_key", "left")
    )
    goes_on = (F.col("depth") < F.col("n_turns")).cast("long")
    return whole.select(
        "conv_id",
        "depth",
        F.when(F.col("depth") > F.col("top_depth"), F.col("conv_id"))
        .otherwise(F.col("parent_conv_id"))
        .alias("parent_conv_id"),
        "n_convs",
        (goes_on + F.coalesce("branches", F.lit(0))).cast("long").alias("n_children"),
        "n_leaves",
        (F.col("total") - (F.col("saved_before") - F.col("saved_above")))
        .cast("long")
        .alias("saved_tokens"),
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )
