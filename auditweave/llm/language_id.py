"""Language identification with interpolated Kneser-Ney character models.

One model per language over character sequences inside words: a letter, or the end of a word,
given up to three characters before it. The n-grams of all languages lie together in arrays
sorted by their hash, with one column of log probabilities per language, so one look-up
gives a character's cost in every language. A text gets the language of the lowest cross-entropy per
character. How sure that is, and beyond which cross-entropy a text is rejected as none of
the languages, is calibrated on training documents that the models have not seen. For
rejection each stretch of a text counts in the language that explains it best, so a text that
goes on in another of the languages is none that no language explains.

Models are fitted on a bounded sample of labelled documents; prediction reads whole texts.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auditweave.llm.common import pick
from auditweave.sources.shelf import pin

ORDER = 4
#: Labelled documents per language that the fit reads, on average, if there are as many.
SAMPLE_PER_LANGUAGE = 3000
#: One in so many of them calibrates instead of training.
CALIBRATE_EVERY = 4
#: Characters handled at once, at most one text beyond.
BATCH_CHARS = 250_000
#: A text's cross-entropy is taken to settle within so many characters.
SETTLED = 200
#: Symbols of a stretch, which counts in the language that explains it best.
STRETCH = 100
#: Share of the texts in a language that rejection is to spare, by length.
SPARED = 0.99999
#: The uppermost share of the deviations, from which the quantile ``SPARED`` is drawn out.
TAIL = 0.1
#: Documents of a length that calibrate by themselves; fewer go with all others.
ENOUGH = 50

_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]
_ODD.append(np.uint64(0xD6E8FEB86659FD93))


def letter_table() -> np.ndarray:
    """By code point: its lower-case letter, or 0 for what is no letter."""
    table = np.zeros(0x110000, np.uint32)
    for cp in range(0x110000):
        c = chr(cp)
        if c.isalpha():
            low = c.lower()
            table[cp] = ord(low) if len(low) == 1 else cp
    return table


def symbols(texts: list[str], letters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts' letters in a row, 0 between words, and where each text begins.

    Every text ends with 0 if it has a letter and is empty otherwise.
    """
    raw = "\n".join(texts) + "\n"
    points = np.frombuffer(raw.encode("utf-32-le", "surrogatepass"), "<u4")
    sign = letters[points]
    before = np.concatenate([np.zeros(1, np.uint32), sign[:-1]])
    kept = (sign != 0) | (before != 0)
    sizes = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    place = np.concatenate([np.zeros(1, np.int64), np.cumsum(kept)])
    starts = place[np.concatenate([np.zeros(1, np.int64), np.cumsum(sizes)])]
    return sign[kept], starts


def contexts(sign: np.ndarray) -> list[np.ndarray]:
    """The symbols 1, 2 and 3 places before each, 0 from the word's beginning back."""
    out = []
    cut = np.zeros(len(sign), bool)
    for k in range(1, ORDER):
        back = np.zeros(len(sign), np.uint32)
        back[k:] = sign[:-k]
        back[cut] = 0
        out.append(back)
        cut = back == 0
    return out


def _hash(parts: list[np.ndarray], order: int) -> np.ndarray:
    h = np.full(len(parts[0]), order, np.uint64)
    for p, odd in zip(parts, _ODD):
        h = (h + p.astype(np.uint64)) * odd
        h ^= h >> np.uint64(29)
    return h


class HashTable:
    """Rows of numbers under 64-bit keys, as arrays sorted by key with a coarse index."""

    def __init__(self, keys: np.ndarray, rows: np.ndarray):
        order = np.argsort(keys)
        # a last key that no search passes
        self.keys = np.append(keys[order], np.uint64(2**64 - 1))
        self.rows = np.ascontiguousarray(rows[order], np.float32)
        bits = max(1, min(22, int(len(keys)).bit_length() + 1))
        self.shift = np.uint64(64 - bits)
        edges = np.arange(1 << bits, dtype=np.uint64) << self.shift
        self.start = np.searchsorted(self.keys, edges).astype(np.int32)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row number per key, and whether the key is there."""
        at = self.start[keys >> self.shift]
        behind = np.flatnonzero(self.keys[at] < keys)
        while len(behind):
            at[behind] += 1
            behind = behind[self.keys[at[behind]] < keys[behind]]
        found = self.keys[at] == keys
        found &= at < len(self.rows)
        return at, found


def fit_tables(grams: pd.DataFrame, languages: list[str]) -> dict:
    """Interpolated Kneser-Ney tables from counts of (lang, c3, c2, c1, w)."""
    names = ["c3", "c2", "c1", "w"]
    width = len(languages)
    at = {lang: i for i, lang in enumerate(languages)}
    counts = grams.rename(columns={"n": "count"})
    levels = {ORDER: counts}
    for k in range(ORDER - 1, 0, -1):  # continuation counts: distinct symbols before
        cols = names[ORDER - k :]
        levels[k] = (
            levels[k + 1].groupby(["lang", *cols], as_index=False).size().rename(
                columns={"size": "count"}
            )
        )
    n_symbols = counts.w.nunique() + 1
    tables: dict = {"languages": languages, "unseen": -math.log(n_symbols), "grams": {}, "backoff": {}}
    lower = None  # probabilities of the order below, by its n-gram
    for k in range(1, ORDER + 1):
        cols = names[ORDER - k :]
        ctx = cols[:-1]
        level = levels[k]
        every = level[cols].drop_duplicates().reset_index(drop=True)
        probs = np.empty((len(every), width))
        if ctx:
            ctx_keys = every[ctx].drop_duplicates().reset_index(drop=True)
            below = every.merge(lower, on=cols[1:], how="left")
            base = below[[f"p{i}" for i in range(width)]].to_numpy()
            back = np.ones((len(ctx_keys), width))
        else:
            base = np.full((len(every), width), 1.0 / n_symbols)
            back = np.ones((1, width))
        for lang, i in at.items():
            mine = level[level.lang == lang]
            n1, n2 = int((mine["count"] == 1).sum()), int((mine["count"] == 2).sum())
            discount = n1 / (n1 + 2 * n2) if n1 and n2 else 0.5
            own = every.merge(mine[[*cols, "count"]], on=cols, how="left")["count"].fillna(0)
            if ctx:
                sums = mine.groupby(ctx)["count"].agg(["sum", "size"]).reset_index()
                per_gram = every.merge(sums, on=ctx, how="left")
                per_ctx = ctx_keys.merge(sums, on=ctx, how="left")
                left = np.where(per_ctx["sum"].isna(), 1.0, discount * per_ctx["size"] / per_ctx["sum"])
                back[:, i] = left
                total, kinds = per_gram["sum"].to_numpy(), per_gram["size"].to_numpy()
            else:
                total = np.full(len(every), float(mine["count"].sum()) or np.nan)
                kinds = np.full(len(every), len(mine))
                back[0, i] = 1.0 if np.isnan(total[0]) else discount * len(mine) / total[0]
            none = np.isnan(total)
            share = np.maximum(own.to_numpy() - discount, 0) / np.where(none, 1, total)
            rest = np.where(none, 1.0, discount * kinds / np.where(none, 1, total))
            probs[:, i] = share + rest * base[:, i]
        lower = every.copy()
        for i in range(width):
            lower[f"p{i}"] = probs[:, i]
        parts = [every[c].to_numpy(np.uint32) for c in reversed(cols)]
        tables["grams"][k] = HashTable(_hash(parts, k), np.log(probs))
        if ctx:
            parts = [ctx_keys[c].to_numpy(np.uint32) for c in reversed(ctx)]
            tables["backoff"][k] = HashTable(_hash(parts, k), np.log(back))
        else:
            tables["backoff"][k] = np.log(back[0]).astype(np.float32)
    return tables


def log_probs(tables: dict, sign: np.ndarray) -> np.ndarray:
    """Log probability of each symbol in each language."""
    back = contexts(sign)
    out = np.zeros((len(sign), len(tables["languages"])), np.float32)
    rest = np.arange(len(sign))
    parts = [sign, *back]
    for k in range(ORDER, 0, -1):
        grams = tables["grams"][k]
        at, found = grams.find(_hash(parts[:k], k))
        out[rest[found]] += grams.rows[at[found]]
        if found.all():
            return out
        rest = rest[~found]
        parts = [p[~found] for p in parts[:k]]
        if k > 1:
            table = tables["backoff"][k]
            at, found = table.find(_hash(parts[1:k], k))
            out[rest[found]] += table.rows[at[found]]
        else:
            out[rest] += tables["backoff"][1] + np.float32(tables["unseen"])
    return out


def _distinct(sign: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Symbols of each text in words not counted before in it: a repeated word tells nothing new."""
    ends = np.flatnonzero(sign == 0)
    heads = np.concatenate([[0], ends[:-1] + 1])
    sizes = ends + 1 - heads
    place = np.arange(len(sign)) - np.repeat(heads, sizes)
    word = np.add.reduceat(_hash([sign, place], 0), heads)
    text = np.searchsorted(starts, heads, side="right") - 1
    once = np.unique(_hash([word, text], 0), return_index=True)[1]
    return np.bincount(text[once], sizes[once], len(starts) - 1).astype(np.int64)


def _costs(tables: dict, texts: list[str | None], letters: np.ndarray):
    """Per text its number of symbols, its cost per symbol in each language (nats), the
    cost where each stretch counts in its best language, and the number of symbols in distinct words."""
    width = len(tables["languages"])
    n = np.zeros(len(texts), np.int64)
    cost = np.zeros((len(texts), width))
    mixed = np.zeros(len(texts))
    fresh = np.zeros(len(texts), np.int64)
    first = 0
    while first < len(texts):
        last, size = first, 0
        while last < len(texts) and size < BATCH_CHARS:
            size += len(texts[last] or "")
            last += 1
        sign, starts = symbols([t or "" for t in texts[first:last]], letters)
        some = np.diff(starts)
        n[first:last] = some
        if len(sign):
            sums = np.concatenate(
                [np.zeros((1, width)), np.cumsum(log_probs(tables, sign), axis=0, dtype=float)]
            )
            cost[first:last] = -(sums[starts[1:]] - sums[starts[:-1]])
            # a text's last stretch takes up what is left, so none is short in a long text
            pieces = np.maximum(some // STRETCH, 1)
            owner = np.repeat(np.arange(len(some)), pieces)
            owner = owner[np.repeat(some > 0, pieces)]
            pieces = np.where(some > 0, pieces, 0)
            head = np.cumsum(pieces) - pieces
            begin = starts[owner] + STRETCH * (np.arange(len(owner)) - head[owner])
            stop = np.append(begin[1:], starts[-1])
            best = -(sums[stop] - sums[begin]).max(axis=1)
            mixed[first:last] = np.bincount(owner, best, len(some))
            fresh[first:last] = _distinct(sign, starts)
        first = last
    per = np.maximum(n, 1)
    return n, cost / per[:, None], mixed / per, fresh


def _count_grams(batches):
    letters = letter_table()
    for batch in batches:
        texts, langs = batch.column(1).to_pylist(), batch.column(0).to_pylist()
        for lang in sorted(set(langs)):
            sign, _ = symbols([t or "" for t, x in zip(texts, langs) if x == lang], letters)
            if not len(sign):
                continue
            c1, c2, c3 = (c.astype(np.int64) for c in contexts(sign))
            keys = np.stack([(c3 << 21) | c2, (c1 << 21) | sign], axis=1)
            grams, n = np.unique(keys, axis=0, return_counts=True)
            yield pa.RecordBatch.from_pydict(
                {"lang": [lang] * len(n), "hi": grams[:, 0], "lo": grams[:, 1], "n": n}
            )


def _sample(labelled: DataFrame, per_language: int) -> DataFrame:
    """(lang, text, later): about ``per_language`` documents of each language.

    They are chosen by a hash of id and text, so neither null nor repeated ids matter, and equal
    documents count once. ``later`` marks those to calibrate with. The document of a language's
    least hash is always chosen, and never for later: every language is learned.
    """
    drawn = labelled.select("lang", "text", F.xxhash64("doc_id", "text").alias("draw"))
    chance = F.pmod(F.xxhash64("draw", F.lit("sample")), F.lit(1_000_000))
    sizes = drawn.groupBy("lang").agg(F.count("*").alias("size"), F.min(chance).alias("least"))
    picked = first = F.lit(False)
    for r in sizes.collect():
        mine = F.col("lang") == r.lang
        share = min(1.0, per_language / r["size"])
        picked = picked | (mine & ((chance < share * 1_000_000) | (chance == r.least)))
        first = first | (mine & (chance == r.least))
    later = F.pmod(F.xxhash64("draw", F.lit("calibrate")), F.lit(CALIBRATE_EVERY)) == 0
    chosen = drawn.where(picked).groupBy("lang", "draw").agg(F.any_value("text").alias("text"))
    return chosen.select("lang", "text", (later & ~first).alias("later"))


def train(docs: DataFrame, learn_from: Column, per_language: int = SAMPLE_PER_LANGUAGE):
    """The models as a broadcast, from rows of ``docs`` where ``learn_from`` holds.

    Rows without a lang or a text teach nothing. Without any labelled row there are no
    languages, and every prediction is ``und``.
    """
    spark = docs.sparkSession
    rows = docs.where(learn_from & F.col("lang").isNotNull() & F.col("text").isNotNull())
    rows = pin(_sample(pick(rows, "doc_id", "lang", "text"), per_language), "language-sample")
    grams = (
        rows.where("NOT later")
        .select("lang", "text")
        .mapInArrow(_count_grams, "lang string, hi bigint, lo bigint, n bigint")
        .groupBy("lang", "hi", "lo")
        .agg(F.sum("n").alias("n"))
        .toPandas()  # bounded by the sample
    )
    mask = (1 << 21) - 1
    grams = grams.assign(
        c3=grams.hi // (1 << 21), c2=grams.hi % (1 << 21), c1=grams.lo // (1 << 21), w=grams.lo & mask
    ).drop(columns=["hi", "lo"])
    languages = sorted(grams.lang.unique())
    if not languages:
        return spark.sparkContext.broadcast({"languages": []})
    tables = fit_tables(grams, languages)
    plain = _portable(tables)
    first = spark.sparkContext.broadcast(dict(plain))

    def measure(batches):
        state = _ready(first.value)
        for batch in batches:
            _, cost, mixed, n = _costs(state["tables"], batch.column(1).to_pylist(), state["letters"])
            cost = pa.array(list(cost), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_pydict(
                {"lang": batch.column(0), "n": n, "cost": cost, "mixed": mixed}
            )

    seen = (
        rows.where("later")
        .select("lang", "text")
        .mapInArrow(measure, "lang string, n bigint, cost array<double>, mixed double")
        .where("n > 0")
        .toPandas()  # bounded by the sample
    )
    return spark.sparkContext.broadcast(plain | _calibrated(seen, languages))


def _calibrated(seen: pd.DataFrame, languages: list[str]) -> dict:
    """Temperature of the score, and the limits of rejection, from unseen documents.

    A limit is a mean by language and a reach for short and for long texts. Documents that
    another language explains better than their label's are left out of the limits.
    """
    at = {lang: i for i, lang in enumerate(languages)}
    seen = seen[seen.lang.isin(languages)]
    means, reach = np.full(len(languages), np.inf), np.full(2, np.inf)
    temperature = 0.1
    if len(seen):
        cost = np.stack(list(seen.cost))
        truth = seen.lang.map(at).to_numpy()
        temperature = min(
            (0.01, 0.02, 0.05, 0.1, 0.2, 0.5, 1.0),
            key=lambda t: -np.log(_softmax(cost, t)[np.arange(len(cost)), truth] + 1e-9).mean(),
        )
        agrees = cost.argmin(axis=1) == truth
        truth, n, mixed = truth[agrees], seen.n.to_numpy()[agrees], seen.mixed.to_numpy()[agrees]
        for i in set(truth.tolist()):
            means[i] = np.median(mixed[truth == i])
        far = (mixed - means[truth]) * np.sqrt(np.minimum(n, SETTLED))
        for k, those in enumerate((n < SETTLED, n >= SETTLED)):
            if len(far):
                reach[k] = _high(far[those] if those.sum() >= ENOUGH else far)
    return {"temperature": float(temperature), "means": means, "reach": reach}


def _high(far: np.ndarray) -> float:
    """The quantile ``SPARED`` of ``far``, by an exponential tail beyond its last ``TAIL``."""
    edge = np.quantile(far, 1 - TAIL)
    beyond = far[far >= edge] - edge
    return float(edge + max(beyond.mean(), 0.1) * math.log(TAIL / (1 - SPARED)))


def _softmax(cost: np.ndarray, temperature: float) -> np.ndarray:
    z = -(cost - cost.min(axis=1, keepdims=True)) / temperature
    e = np.exp(z)
    return e / e.sum(axis=1, keepdims=True)


def _portable(tables: dict) -> dict:
    """Tables as plain arrays, so that a worker needs no class to load the broadcast."""
    plain = {k: tables[k] for k in ("languages", "unseen")}
    for name in ("grams", "backoff"):
        for k, t in tables[name].items():
            plain[name, k] = (t.keys[:-1], t.rows) if isinstance(t, HashTable) else t
    return plain


def _ready(state: dict) -> dict:
    """Tables and letters in a worker, made once from the broadcast ``state``."""
    if "tables" not in state:
        tables = {k: state[k] for k in ("languages", "unseen")} | {"grams": {}, "backoff": {}}
        for name in ("grams", "backoff"):
            for k in range(1, ORDER + 1):
                t = state[name, k]
                tables[name][k] = HashTable(*t) if isinstance(t, tuple) else t
        state["letters"] = letter_table()
        state["tables"] = tables
    return state


def _decide(state: dict, texts: list[str | None]):
    """Language, score and rejection of each text."""
    if not state["languages"]:
        # nothing was learned to reject by
        none = [not any(c.isalpha() for c in t or "") for t in texts]
        return ["und"] * len(texts), [0.0] * len(texts), none
    ready = _ready(state)
    n, cost, mixed, fresh = _costs(ready["tables"], texts, ready["letters"])
    best = cost.argmin(axis=1)
    rows = np.arange(len(texts))
    score = _softmax(cost, state["temperature"])[rows, best]
    reach = state["reach"][(fresh >= SETTLED).astype(int)]
    far = mixed > state["means"][best] + reach / np.sqrt(np.clip(fresh, 1, SETTLED))
    none = n == 0
    langs = [
        "und" if x else state["languages"][b] for b, x in zip(best.tolist(), none.tolist())
    ]
    return langs, np.where(none, 0.0, score).tolist(), (none | far).tolist()


def identify(docs: DataFrame, model) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, lang_pred, score, rejected.

    ``lang_pred`` is the language of the lowest cross-entropy per character, of equals the
    first by name, and ``und`` for a null text or one without a letter. ``score`` is between
    0 and 1, and 0 for ``und``. ``rejected`` holds for texts without a letter, and where
    the languages explain the text worse than ``SPARED`` of the texts in that language and of
    about that length, where a repeated word counts once; if no language was learned, only for texts without a letter. Repeated rows and rows
    without an id each give a row; an empty table gives an empty result.
    """
    rows = pick(docs, "doc_id", "text")

    def run(batches):
        for batch in batches:
            langs, score, rejected = _decide(model.value, batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(langs, pa.string()),
                    pa.array(score, pa.float64()),
                    pa.array(rejected, pa.bool_()),
                ],
                ["doc_id", "lang_pred", "score", "rejected"],
            )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(
        run, f"doc_id {kind}, lang_pred string, score double, rejected boolean"
    )


def keep_identified(docs: DataFrame, model) -> DataFrame:
    """The rows of ``docs`` that are not rejected, with all their columns unchanged."""
    names = docs.columns
    text_at = names.index("text")
    flat = docs.toDF(*[f"c{i}" for i in range(len(names))])

    def run(batches):
        for batch in batches:
            _, _, rejected = _decide(model.value, batch.column(text_at).to_pylist())
            yield batch.filter(pa.array([not r for r in rejected], pa.bool_()))

    return flat.mapInArrow(run, flat.schema).toDF(*names)
