"""SimHash near-duplicates through a Gray-order hierarchical index.

Every document gets a 64-bit fingerprint. Equal fingerprints become one entry at once, so a
group of copies of any size is one entry. Entries link when few bits differ.

The index. Two entries that differ in at most ``max_bits`` bits agree in at least one of
``max_bits + 1`` blocks of bits. So the uppermost nodes are masked patterns: the bits of one
block, for each block in turn, and only entries below the same node can be linked there. Below
such a node the other bits are sorted by Gray rank, which puts entries with few differing
bits next to each other, and every run of 2, 4, 8, ... neighbours is a node that holds the
bits all its entries share. The bits in which the shared patterns of two nodes differ are a
lower bound for all their entries; going down from node to node adds differing bits, and a
pair of nodes beyond ``max_bits`` is pruned with everything below it. A pair whose entries
are all in one component already is pruned too, so a large group of near copies costs
nearly linear work and yields links in proportion to its entries, never all its pairs.

A node with more than ``hot`` entries is factored once more: the bits outside its block are
cut into blocks again and agreement in one of them makes the lower node. Any link is kept.

Links become components by alternating large-star and small-star steps on tables.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auditweave.llm.common import pick, plain_words
from auditweave.sources.shelf import pin

BITS = 64
MAX_BITS = 3
SHINGLE = 3
#: Entries below one masked pattern, beyond which the pattern is refined.
HOT = 20_000
#: Entries and node pairs that a worker handles at once.
LOAD = 200_000
SPREAD = 1_000_000

_SEED = 42


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Bit-wise majority of the XXH64 of all shingles; 0 for a text without words."""
    words = plain_words(text)
    if not words:
        return 0
    row = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([np.zeros(1, np.int64), ends[:-1] + 1])
    k = min(shingle, len(words))
    digest = xxhash.xxh64_intdigest
    total = len(words) - k + 1
    ones = np.zeros(BITS, np.int64)
    for at in range(0, total, LOAD):
        a = starts[at : min(at + LOAD, total)].tolist()
        b = ends[at + k - 1 : at + k - 1 + len(a)].tolist()
        h = np.array([digest(row[i:j], _SEED) for i, j in zip(a, b)], ">u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    bits = (2 * ones > total).astype(np.uint8)
    return int.from_bytes(np.packbits(bits).tobytes(), "big")


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """Place of each code in the reflected Gray sequence."""
    out = codes.copy()
    for s in (1, 2, 4, 8, 16, 32):
        out ^= out >> np.uint64(s)
    return out


def _count_bits(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x)


def _roots(parent: np.ndarray, at: np.ndarray) -> np.ndarray:
    root = parent[at]
    while True:
        up = parent[root]
        if (up == root).all():
            return root
        root = up


def _unite(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Joins the sets of a[i] and b[i]; the least place is the root."""
    while len(a):
        ra, rb = _roots(parent, a), _roots(parent, b)
        low, high = np.minimum(ra, rb), np.maximum(ra, rb)
        apart = low != high
        a, b, low, high = a[apart], b[apart], low[apart], high[apart]
        np.minimum.at(parent, high, low)


def group_links(codes: np.ndarray, groups: np.ndarray, max_bits: int = MAX_BITS) -> np.ndarray:
    """Component root (a place) of each entry, linking only inside equal ``groups``.

    ``groups`` is sorted, and ``codes`` are in Gray order inside each group. Two entries are
    in one component exactly if steps of at most ``max_bits`` bits lead from one to the other.
    """
    n = len(codes)
    parent = np.arange(n)
    if n < 2:
        return parent
    # Gray neighbours first: most members of a group of near copies meet here
    near = np.flatnonzero(
        (groups[1:] == groups[:-1]) & (_count_bits(codes[1:] ^ codes[:-1]) <= max_bits)
    )
    _unite(parent, near, near + 1)

    # nodes of level h: runs of 2**h entries from each group's first
    firsts = np.flatnonzero(np.concatenate([[True], groups[1:] != groups[:-1]]))
    sizes = np.diff(np.append(firsts, n))
    levels = [(codes, codes, firsts, sizes)]  # bits all have, bits any has, first node, nodes
    while levels[-1][3].max() > 1:
        every, some, first, count = levels[-1]
        up = (count + 1) // 2
        up_first = np.concatenate([[0], np.cumsum(up)[:-1]])
        owner = np.repeat(np.arange(len(count)), up)
        left = first[owner] + 2 * (np.arange(up.sum()) - up_first[owner])
        right = np.minimum(left + 1, first[owner] + count[owner] - 1)
        levels.append((every[left] & every[right], some[left] | some[right], up_first, up))

    top = len(levels) - 1
    wide = np.flatnonzero(sizes > 1)
    stack = [(top, wide, levels[top][2][wide], levels[top][2][wide])]
    while stack:
        level, group, a, b = stack.pop()
        if len(group) > LOAD:
            half = len(group) // 2
            stack.append((level, group[half:], a[half:], b[half:]))
            stack.append((level, group[:half], a[:half], b[:half]))
            continue
        every, some, _, _ = levels[level]
        # differing bits of the shared patterns: set in all of one, in none of the other
        apart = _count_bits((every[a] & ~some[b]) | (every[b] & ~some[a]))
        if level == 0:
            linked = (apart <= max_bits) & (a < b)
            _unite(parent, a[linked], b[linked])
            continue
        open_ = apart <= max_bits
        if level <= 6:  # one component already?
            open_ &= ~_settled(parent, levels, level, group, a, b, open_)
        group, a, b = group[open_], a[open_], b[open_]
        if not len(group):
            continue
        _, _, here, _ = levels[level]
        _, _, first, count = levels[level - 1]
        la, lb = a - here[group], b - here[group]
        kids = []
        for i in (0, 1):
            for j in (0, 1):
                ka, kb = 2 * la + i, 2 * lb + j
                fits = (ka < count[group]) & (kb < count[group]) & (ka <= kb)
                g = group[fits]
                kids.append((g, first[g] + ka[fits], first[g] + kb[fits]))
        stack.append(
            (level - 1, *(np.concatenate([k[x] for k in kids]) for x in range(3)))
        )
    return _roots(parent, np.arange(n))


def _settled(parent, levels, level, group, a, b, wanted) -> np.ndarray:
    """Whether all entries below nodes a[i] and b[i] are in one component."""
    out = np.zeros(len(a), bool)
    at = np.flatnonzero(wanted)
    if not len(at):
        return out
    entries, sizes = levels[0][2], levels[0][3]
    here = levels[level][2]
    root = None
    same = np.ones(len(at), bool)
    for node in (a[at], b[at]):
        begin = (node - here[group[at]]) << level
        for i in range(1 << level):
            if not same.any():
                return out
            inside = begin + i < sizes[group[at]]
            place = entries[group[at]] + np.minimum(begin + i, sizes[group[at]] - 1)
            now = _roots(parent, place)
            if root is None:
                root = now
            else:
                same &= (now == root) | ~inside
    out[at[same]] = True
    return out


def _links(max_bits: int):
    """Stars (root, entry) below each masked pattern of a sorted partition."""

    def solve(keys: np.ndarray, codes: np.ndarray) -> pa.RecordBatch:
        order = np.lexsort((gray_rank(codes), keys[:, 1], keys[:, 0]))
        keys, codes = keys[order], codes[order]
        new = np.concatenate([[True], (keys[1:] != keys[:-1]).any(axis=1)])
        root = group_links(codes, np.cumsum(new), max_bits)
        other = np.flatnonzero(root != np.arange(len(root)))
        return pa.RecordBatch.from_arrays(
            [
                pa.array(codes[root[other]].view(np.int64)),
                pa.array(codes[other].view(np.int64)),
            ],
            ["a", "b"],
        )

    def run(batches):
        held_keys, held_codes = np.empty((0, 2), np.int64), np.empty(0, np.uint64)
        for batch in batches:
            keys = np.stack([batch.column(0).to_numpy(), batch.column(1).to_numpy()], axis=1)
            codes = batch.column(2).to_numpy().view(np.uint64)
            held_keys = np.concatenate([held_keys, keys])
            held_codes = np.concatenate([held_codes, codes])
            if len(held_codes) < SPREAD // 4:
                continue
            # the last group may go on in the next batch
            last = (held_keys == held_keys[-1]).all(axis=1)
            if not last.all():
                yield solve(held_keys[~last], held_codes[~last])
                held_keys, held_codes = held_keys[last], held_codes[last]
        if len(held_codes):
            yield solve(held_keys, held_codes)

    return run


def _blocks(width: int, count: int) -> list[tuple[int, int]]:
    """(shift, size) of ``count`` blocks that cover ``width`` bits."""
    edges = [width * i // count for i in range(count + 1)]
    return [(lo, hi - lo) for lo, hi in zip(edges, edges[1:])]


def _masked(column, shift: int, size: int):
    return F.shiftrightunsigned(column, shift).bitwiseAND(F.lit((1 << size) - 1))


def link_fingerprints(codes: DataFrame, max_bits: int = MAX_BITS, hot: int = HOT) -> DataFrame:
    """Links (a, b) between distinct 64-bit ``code`` values, enough for all components."""
    blocks = _blocks(BITS, max_bits + 1)
    keyed = codes.select(
        "code",
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(i).cast("long").alias("block"), _masked(F.col("code"), *b).alias("bits"))
                    for i, b in enumerate(blocks)
                ]
            )
        ).alias("node"),
    ).select("node.block", "node.bits", "code")
    # at most one row per block and pattern, so few that the crowded ones may be broadcast
    crowded = keyed.groupBy("block", "bits").count().where(F.col("count") > hot).drop("count")
    marked = keyed.join(
        F.broadcast(crowded.withColumn("crowded", F.lit(True))), ["block", "bits"], "left"
    )
    # the bits outside the block, in order, cut into blocks once more
    finer = []
    for i, (shift, size) in enumerate(blocks):
        low = F.col("code").bitwiseAND(F.lit((1 << shift) - 1)) if shift else F.lit(0)
        high = F.shiftrightunsigned("code", shift + size) if shift + size < BITS else F.lit(0)
        rest = F.shiftleft(high.cast("long"), shift).bitwiseOR(low.cast("long"))
        subs = [
            (_masked(rest, *b) + F.lit((j + 1) << 56)) for j, b in enumerate(_blocks(BITS - size, max_bits + 1))
        ]
        finer.append(F.when(F.col("block") == i, F.array(*subs)))
    sub = F.when(F.col("crowded").isNull(), F.array(F.lit(0).cast("long"))).otherwise(
        F.coalesce(*finer)
    )
    nodes = marked.withColumn("sub", F.explode(sub)).select(
        F.shiftleft("block", 32).bitwiseOR(F.col("bits")).alias("node"), "sub", "code"
    )
    return (
        nodes.repartition("node", "sub")
        .sortWithinPartitions("node", "sub")
        .mapInArrow(_links(max_bits), "a bigint, b bigint")
    )


def components(links: DataFrame) -> DataFrame:
    """(node, component): the least node of each component, for nodes with a link.

    Alternates large-star and small-star steps on written tables until nothing changes; all
    steps are aggregates and joins, and the links never grow in number.
    """
    edges = pin(
        links.select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v"))
        .where("u < v")
        .distinct(),
        "links",
    )
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        # large star: larger neighbours go to the least one
        large = (
            both.where("v > u").join(least, "u").select(F.col("m").alias("u"), "v").distinct()
        )
        # small star: the smaller neighbours and the node itself go to the least one
        down = large.select(F.col("v").alias("x"), F.col("u").alias("y")).where("x > y")
        low = down.groupBy("x").agg(F.min("y").alias("m"))
        small = (
            down.join(low, "x")
            .select(F.explode(F.array("x", "y")).alias("v"), F.col("m").alias("u"))
            .where("u < v")
            .distinct()
        )
        after = pin(small.select("u", "v"), "links")
        changed = after.exceptAll(edges).limit(1).count() or edges.exceptAll(after).limit(1).count()
        edges = after
        if not changed:
            break
    return edges.select(F.col("v").alias("node"), F.col("u").alias("component"))


def _marked(rows: DataFrame, shingle: int) -> DataFrame:
    """The written rows with ``code``, the fingerprint of their last column, in its place."""
    kept = rows.columns[:-1]

    def run(batches):
        for batch in batches:
            codes = [fingerprint(t.as_py(), shingle) for t in batch.column(len(kept))]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(np.array(codes, np.uint64).view(np.int64))],
                [*kept, "code"],
            )

    kinds = [f"{c} {rows.schema[c].dataType.simpleString()}" for c in kept]
    return pin(rows.mapInArrow(run, ", ".join([*kinds, "code bigint"])), "fingerprints")


def _classed(entries: DataFrame, max_bits: int, hot: int) -> DataFrame:
    """``entries``, a row per distinct ``code``, with the ``component`` of the code."""
    found = components(link_fingerprints(entries.select("code"), max_bits, hot))
    return entries.join(found, entries.code == found.node, "left").select(
        *[entries[c] for c in entries.columns], F.coalesce("component", "code").alias("component")
    )


def near_duplicates(
    docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS, hot: int = HOT
) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, fingerprint, component_id.

    Words are runs between ASCII white space, ASCII letters in lower case; shingles are
    ``shingle`` words, repeats included; a text with fewer words is one shingle, a text without
    words (also a null one) has fingerprint zero, which links like any other. A bit is 1 if
    more than half of the shingles' XXH64 have it. ``component_id`` is the least doc_id that
    can be reached over links of at most ``max_bits`` differing bits; null if no document of
    the component has an id. Repeated rows each give a row; an empty table an empty result.
    """
    marked = _marked(pick(docs, "doc_id", "text"), shingle)
    entries = pin(marked.groupBy("code").agg(F.min("doc_id").alias("first_id")), "entries")
    classed = _classed(entries, max_bits, hot)
    named = classed.join(
        classed.groupBy("component").agg(F.min("first_id").alias("component_id")), "component"
    ).select("code", "component_id")
    return marked.join(named, "code").select(
        "doc_id",
        F.lpad(F.lower(F.hex("code")), 16, "0").alias("fingerprint"),
        "component_id",
    )


def keep_one(
    docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS, hot: int = HOT
) -> DataFrame:
    """One row of ``docs`` for each component.

    All columns stay. Rows are told apart by themselves, not by their id: of a component's rows
    the one with the least doc_id stays, rows without an id last, of equal ids the one with the
    least fingerprint, then hash of the text, then hash of all columns.
    """
    names = docs.columns
    flat = docs.toDF(*[f"c{i}" for i in range(len(names))])
    hashed = [f.name for f in flat.schema if "map<" not in f.dataType.simpleString()]
    # written once: the number of a row must not change between the steps below
    flat = pin(flat.withColumn("row", F.monotonically_increasing_id()), "rows")
    text = flat[f"c{names.index('text')}"]
    rows = flat.select(
        flat[f"c{names.index('doc_id')}"].alias("doc_id"),
        F.xxhash64(text).alias("text_hash"),
        F.xxhash64(*hashed).alias("row_hash"),
        "row",
        text.alias("text"),
    )
    marked = _marked(rows, shingle)
    unnamed = F.isnull("doc_id").alias("unnamed")
    least = F.min(F.struct(unnamed, "doc_id", "code", "text_hash", "row_hash", "row"))
    firsts = pin(marked.groupBy("code").agg(least.alias("first")), "entries")
    classed = _classed(firsts.select("code"), max_bits, hot)
    kept = (
        firsts.join(classed, "code")
        .groupBy("component")
        .agg(F.min("first").alias("first"))
        .select("first.row")
    )
    return flat.join(kept, "row", "left_semi").drop("row").toDF(*names)
