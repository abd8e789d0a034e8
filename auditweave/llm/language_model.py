"""Scores of a hashed maximum-entropy language model, and of an add-one unigram model.

P(word | history) = P(class | history) x P(word | class). The class factor is a softmax over a
few dozen classes with hashed features of the history: the word before, the one before that
(a skip), the pair of both, and the third before (a skip). It is trained by distributed
gradient updates: each update sums the gradient of one slice of the training documents over
all tasks, and the slices together are all training documents. They are gone through again
until the loss on held-out documents stops falling. The buckets that features are hashed to
follow the corpus: their number grows with the root of its tokens. The word factor is add-one
counts within the class, where each class also has one word never seen.

Words that are frequent in the training documents are looked up in a broadcast table of a bounded
size. The counts of all others come by a join, so that all words of the corpus count, and what is
gathered grows with it.

A class is a frequent word, or a frequent ending of words; all other endings share one.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auditweave.llm.common import id_remainder, pick, plain_words
from auditweave.sources.shelf import pin, shelf_of

#: Words in the broadcast table, at most.
FREQUENT = 262_144
CLASSES = 32
#: Classes that are one word, the end of a text among them.
WORD_CLASSES = 8
#: Buckets of features: the power of two from so many times the root of the training tokens up.
ROOTS = 8
LEAST_BUCKETS = 1 << 14
#: Updates by which all training documents are gone through once.
UPDATES = 2
#: A further time must lower the held-out loss by this share.
FALL = 0.001
STEP = 0.5
#: Weight of the class's overall share against a feature's own counts, in the start and in steps.
SMOOTHING = 50.0
DAMPING = 400.0
#: How far the start from counts trusts each of the four overlapping features.
START = 0.45
#: No word holds a space.
END = b" end"
#: Tokens handled at once, and words counted before a task passes them on.
LOAD = 131_072
HELD_WORDS = 400_000
#: Parts in which gradients are summed.
BLOCKS = 16

_ODD = [np.uint32(x) for x in (0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35, 0x27D4EB2F)]


def _count_words(batches):
    counts: Counter = Counter()
    ends = 0

    def table():
        words = list(counts)
        return pa.RecordBatch.from_arrays(
            [pa.array(words, pa.binary()), pa.array([counts[w] for w in words], pa.int64())],
            ["word", "n"],
        )

    for batch in batches:
        for text in batch.column(0):
            counts.update(plain_words(text.as_py()))
            ends += 1
            if len(counts) > HELD_WORDS:
                yield table()
                counts.clear()
    if ends:
        counts[END] = ends
        yield table()


def count_words(docs: DataFrame) -> DataFrame:
    """(word, n) over all texts of ``docs``, the end of each text included."""
    rows = pick(docs, "text").mapInArrow(_count_words, "word binary, n bigint")
    return rows.groupBy("word").agg(F.sum("n").alias("n"))


def _frequent(counts: DataFrame, most: int) -> list[tuple[bytes, int]]:
    """The most frequent words with their counts: all from a least count up, ``most`` at most."""
    step = F.floor(F.log2("n") * 8)
    steps = counts.groupBy(step.alias("step")).agg(F.count("*").alias("words")).collect()
    total, least = 0, None
    for row in sorted(steps, key=lambda r: -r.step):
        total += row.words
        if total > most:
            break
        least = row.step
    if least is None:
        return []
    rows = counts.where(step >= least).select("word", "n").toArrow()
    return sorted(zip(*(c.to_pylist() for c in rows.columns)), key=lambda x: (-x[1], x[0]))


def _classes(frequent, endings) -> dict:
    """Classes by word and by ending, and each class's sum of counts plus one."""
    own = [END, *[w for w, _ in frequent if w != END][: WORD_CLASSES - 1]]
    left = {bytes(r.ending): r.mass for r in endings}
    known = dict(frequent)
    mass = np.ones(CLASSES)  # one word never seen in each class
    for i, w in enumerate(own):
        if w in known:
            mass[i] += known[w] + 1
            left[w[-2:]] -= known[w] + 1
    ranked = sorted(left, key=lambda e: (-left[e], e))
    named = ranked[: CLASSES - len(own) - 1]
    ending = {e: len(own) + i for i, e in enumerate(named)}
    for e, m in left.items():
        mass[ending.get(e, CLASSES - 1)] += m
    return {"words": {w: i for i, w in enumerate(own)}, "endings": ending, "mass": mass}


def _encoder(shared):
    """Texts to class and hash per token, with what the frequent words come to."""

    def run(batches):
        from pyspark import TaskContext

        state = shared.value
        if "table" not in state:
            words, endings = state["words"], state["endings"]
            names = [w for w, _ in state["frequent"]]
            state["table"] = {w: i for i, w in enumerate(names)}
            state["log"] = np.log10([n + 1.0 for _, n in state["frequent"]] + [1.0])
            state["class"] = np.array(
                [words.get(w, endings.get(w[-2:], CLASSES - 1)) for w in names] + [0], np.uint8
            )
            state["hash"] = np.array([zlib.crc32(w) for w in names] + [0], np.uint32)
        table, logs, classes = state["table"], state["log"], state["class"]
        hashes, words, endings = state["hash"], state["words"], state["endings"]
        row = TaskContext.get().partitionId() << 33
        schema = pa.schema(
            [
                ("row", pa.int64()),
                ("doc_id", pa.int64()),
                ("held_out", pa.bool_()),
                ("n_tokens", pa.int64()),
                ("n_frequent", pa.int64()),
                ("log_frequent", pa.float64()),
                ("classes", pa.binary()),
                ("hashes", pa.binary()),
                ("rare", pa.list_(pa.binary())),
            ]
        )
        for batch in batches:
            schema = schema.set(1, pa.field("doc_id", batch.schema.field(0).type))
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                out = []
                for doc, held, text in zip(*(c.to_pylist() for c in part.columns)):
                    tokens = plain_words(text)
                    tokens.append(END)
                    place = np.fromiter(map(table.get, tokens, repeat(-1)), np.int64, len(tokens))
                    cls, hsh = classes[place], hashes[place]
                    missed = np.flatnonzero(place < 0)
                    rare = [tokens[i] for i in missed.tolist()]
                    if rare:
                        cls[missed] = [
                            words.get(w, endings.get(w[-2:], CLASSES - 1)) for w in rare
                        ]
                        hsh[missed] = [zlib.crc32(w) for w in rare]
                    out.append(
                        (
                            row,
                            doc,
                            held,
                            len(tokens),
                            len(tokens) - len(rare),
                            float(logs[place].sum()),
                            cls.tobytes(),
                            hsh.tobytes(),
                            rare,
                        )
                    )
                    row += 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema
                )

    return run


def _buckets(tokens: int) -> int:
    return max(LEAST_BUCKETS, 1 << math.ceil(math.log2(ROOTS * math.sqrt(tokens) + 1)))


def _features(hashes: np.ndarray, starts: np.ndarray, buckets: int) -> list[np.ndarray]:
    """Buckets of the history of each token; histories end where texts begin."""
    ids = hashes + np.uint32(1)
    back = [ids]
    for _ in range(3):
        shifted = np.concatenate([np.zeros(1, np.uint32), back[-1][:-1]])
        shifted[starts] = 0
        back.append(shifted)
    _, one, two, three = back
    mixed = (
        one * _ODD[0],
        two * _ODD[1] + np.uint32(0x5BD1E995),
        (one * _ODD[2]) ^ (two * _ODD[3] + np.uint32(0x165667B1)),
        three * _ODD[3] + np.uint32(0x2545F491),
    )
    bits = np.uint32(32 - (buckets.bit_length() - 1))
    return [(m ^ (m >> np.uint32(15))) * _ODD[0] >> bits for m in mixed]


def _loads(batch, class_at: int, hash_at: int, buckets: int):
    """(first row, last row, classes, features, starts) of texts, some tokens at a time."""
    classes = [np.frombuffer(x, np.uint8) for x in batch.column(class_at).to_pylist()]
    hashes = [np.frombuffer(x, np.uint32) for x in batch.column(hash_at).to_pylist()]
    first = 0
    while first < len(classes):
        last, size = first, 0
        while last < len(classes) and size < LOAD:
            size += len(classes[last])
            last += 1
        sizes = np.array([len(c) for c in classes[first:last]])
        starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        cls = np.concatenate(classes[first:last])
        features = _features(np.concatenate(hashes[first:last]), starts, buckets)
        yield first, last, cls, features, starts
        first = last


def _logits(weights: np.ndarray, bias: np.ndarray, features: list[np.ndarray]) -> np.ndarray:
    z = weights[features[0]]
    for f in features[1:]:
        z += weights[f]
    z += bias
    z -= z.max(axis=1, keepdims=True)
    return z


def _summed(parts: DataFrame, buckets: int) -> np.ndarray:
    """The sum of all tasks' (block, values) rows, as an array (buckets, classes).

    Each block is summed by one task as rows stream in, whatever their number, and the
    driver gets one row per block.
    """

    def run(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                values = np.frombuffer(raw, np.float32)
                if block in sums:
                    sums[block] += values
                else:
                    sums[block] = values.astype(np.float64)
        if sums:
            values = [v.astype(np.float32).tobytes() for v in sums.values()]
            yield pa.RecordBatch.from_pydict({"block": list(sums), "sums": values})

    out = np.zeros((BLOCKS, buckets * CLASSES // BLOCKS), np.float32)
    with shelf_of(parts.sparkSession).cleaning():
        rows = parts.repartition(BLOCKS, "block").mapInArrow(run, "block bigint, sums binary")
        found = rows.collect()
    while found:
        row = found.pop()
        out[row.block] += np.frombuffer(row.sums, np.float32)
    return out.reshape(buckets, CLASSES)


def _blocks(total: np.ndarray):
    cut = total.astype(np.float32, copy=False).reshape(BLOCKS, -1)
    for block, values in enumerate(cut):  # one at a time: a batch has no more than one block
        yield pa.RecordBatch.from_pydict({"block": [block], "values": [values.tobytes()]})


def _feature_counts(buckets: int):
    def run(batches):
        total = np.zeros(buckets * CLASSES, np.uint32)
        for batch in batches:
            for _, _, cls, features, _ in _loads(batch, 0, 1, buckets):
                for f in features:
                    np.add.at(total, f.astype(np.int64) * CLASSES + cls, np.uint32(1))
        yield from _blocks(total)

    return run


def _gradient(model):
    def run(batches):
        weights, bias = model.value
        total = np.zeros(weights.shape[::-1], np.float32)
        for batch in batches:
            for _, _, cls, features, _ in _loads(batch, 0, 1, len(weights)):
                p = np.exp(_logits(weights, bias, features))
                p /= -p.sum(axis=1, keepdims=True)
                p[np.arange(len(p)), cls] += 1
                places, size = np.concatenate(features).astype(np.int64), len(weights)
                if size <= 4 * LOAD:
                    found = slice(None)
                else:  # most buckets have no token of this load
                    found, places = np.unique(places, return_inverse=True)
                    size = len(found)
                for row, own in zip(total, np.ascontiguousarray(p.T)):
                    row[found] += np.bincount(places, np.tile(own, len(features)), size)
        yield from _blocks(np.ascontiguousarray(total.T))

    return run


def _loss(docs: DataFrame, model) -> float | None:
    """Mean of the class factor's negative logarithm over all tokens; None without any."""

    def run(batches):
        weights, bias = model.value
        total, tokens = 0.0, 0
        for batch in batches:
            for _, _, cls, features, _ in _loads(batch, 0, 1, len(weights)):
                z = _logits(weights, bias, features)
                chosen = z[np.arange(len(z)), cls] - np.log(np.exp(z).sum(axis=1))
                total, tokens = total - float(chosen.sum(dtype=np.float64)), tokens + len(cls)
        yield pa.RecordBatch.from_pydict({"total": [total], "tokens": [tokens]})

    rows = docs.select("classes", "hashes").mapInArrow(run, "total double, tokens bigint")
    row = rows.agg(F.sum("total").alias("total"), F.sum("tokens").alias("tokens")).first()
    return row.total / row.tokens if row.tokens else None


def _train(codes: DataFrame, updates: int, tokens: int):
    """Weights and bias of the class softmax, from the training documents of ``codes``.

    All of them are gone through by ``updates`` updates, again and again until the loss on
    held-out documents (on all, if none is held out) stops falling.
    """
    context, buckets = codes.sparkSession.sparkContext, _buckets(tokens)
    # a task sums what it reads: more tasks than cores would only make more sums
    learn = codes.where(~F.col("held_out")).coalesce(context.defaultParallelism)
    watched = codes.where("held_out")
    shape = "block bigint, values binary"
    counted = learn.select("classes", "hashes").mapInArrow(_feature_counts(buckets), shape)
    seen = _summed(counted, buckets)
    by_class = seen.sum(axis=0, dtype=np.float64) + 1.0
    share = (by_class / by_class.sum()).astype(np.float32)
    by_feature = seen.sum(axis=1, keepdims=True)
    bias = np.log(share)
    # the start: what the counts of each feature say alone, damped as the features overlap
    own = seen  # in place, as all these have a value per bucket and class
    own += SMOOTHING * share
    own /= by_feature + SMOOTHING
    weights = np.log(own)
    weights -= bias
    weights *= START
    scale = own
    scale *= by_feature
    scale += DAMPING * share
    best = context.broadcast((weights, bias))
    least = _loss(watched, best)
    if least is None:
        watched = codes
        least = _loss(watched, best)
    falling = least is not None
    while falling:
        model = best
        for i in range(updates):
            part = learn.where(F.pmod(F.xxhash64("row"), F.lit(updates)) == i)
            slope = _summed(
                part.select("classes", "hashes").mapInArrow(_gradient(model), shape), buckets
            )
            if model is not best:
                model.destroy()
            slope *= STEP * updates
            slope /= scale
            weights += np.clip(slope, -1, 1, out=slope)
            model = context.broadcast((weights, bias))
        loss = _loss(watched, model)
        falling = loss < (1 - FALL) * least
        worse = best if loss < least else model
        if loss < least:
            best, least = model, loss
        if worse is not best:
            worse.destroy()
    return best


def _score(model, log_mass: np.ndarray):
    def run(batches):
        weights, bias = model.value
        for batch in batches:
            out = np.zeros(batch.num_rows)
            for first, last, cls, features, starts in _loads(batch, 1, 2, len(weights)):
                z = _logits(weights, bias, features)
                chosen = z[np.arange(len(z)), cls] - np.log(np.exp(z).sum(axis=1))
                value = chosen / math.log(10) - log_mass[cls]
                out[first:last] = np.add.reduceat(value, starts)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(out)], ["row", "log_class"]
            )

    return run


def score_texts(
    docs: DataFrame, modulus: int = 7, held_out: int = 2, updates: int = UPDATES
) -> DataFrame:
    """Scores every row of ``docs`` (doc_id, text) by models of those that are not held out.

    Held out are the rows whose crc32(doc_id as text) modulo ``modulus`` is ``held_out``. Words
    are runs between ASCII white space, ASCII letters in lower case; a text ends with one more
    token. Gives doc_id, held_out, n_tokens, n_known (tokens that the training documents have),
    train_tokens, base_score (log10 probability by add-one counts) and score (by the model).
    ``updates`` updates go through all training documents once; that is repeated until the loss
    on the held-out documents falls no more.

    A null text is empty and is its end alone; a null id counts as empty text. Repeated rows
    are learned from as often as they occur, and each gives a row. If all rows are held out,
    no word is known and the classes are equally likely but for their unseen word. An empty
    table gives an empty result.
    """
    rows = pick(docs, "doc_id", "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    rows = rows.select("doc_id", (id_remainder("doc_id", modulus) == held_out).alias("held"), "text")
    counts = pin(count_words(rows.where("NOT held")), "words")
    total = counts.agg(F.sum("n").alias("n"), F.count("*").alias("v")).first()
    tokens, kinds = total.n or 0, total.v
    frequent = _frequent(counts, FREQUENT)
    ending = F.substring("word", -2, 2)
    ending = F.when(F.octet_length("word") < 2, F.col("word")).otherwise(ending)
    endings = (  # at most 65,793 rows
        counts.groupBy(ending.alias("ending")).agg(F.sum(F.col("n") + 1).alias("mass")).collect()
    )
    classes = _classes(frequent, endings)
    shared = docs.sparkSession.sparkContext.broadcast(
        {"frequent": frequent, "words": classes["words"], "endings": classes["endings"]}
    )
    mass = classes["mass"]
    del frequent, endings, classes  # the driver needs the room for the weights
    codes = pin(
        rows.mapInArrow(
            _encoder(shared),
            f"row bigint, doc_id {kind}, held_out boolean, n_tokens bigint, n_frequent bigint, "
            "log_frequent double, classes binary, hashes binary, rare array<binary>",
        ),
        "codes",
    )
    model = _train(codes, updates, tokens)
    scored = codes.select("row", "classes", "hashes").mapInArrow(
        _score(model, np.log10(mass)), "row bigint, log_class double"
    )
    # both read the same files: brought together by the row's number
    rare = (
        codes.select("row", F.explode("rare").alias("word"))
        .join(counts, "word")
        .groupBy("row")
        .agg(F.count("*").alias("n_rare"), F.sum(F.log10(F.col("n") + 1)).alias("log_rare"))
    )
    whole = codes.select("row", "doc_id", "held_out", "n_tokens", "n_frequent", "log_frequent")
    log_counts = F.col("log_frequent") + F.coalesce("log_rare", F.lit(0.0))
    return (
        whole.join(scored, "row")
        .join(rare, "row", "left")
        .select(
            "doc_id",
            "held_out",
            "n_tokens",
            (F.col("n_frequent") + F.coalesce("n_rare", F.lit(0))).alias("n_known"),
            F.lit(tokens).cast("long").alias("train_tokens"),
            (log_counts - F.col("n_tokens") * math.log10(tokens + kinds + 1)).alias("base_score"),
            (log_counts + F.col("log_class")).alias("score"),
        )
    )
