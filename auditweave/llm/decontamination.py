"""Benchmark decontamination with a generalised suffix automaton.

The automaton holds every word sequence that occurs in an item of the benchmark. A document's
words stream through it; the automaton's state and length are, at each word, the longest
sequence ending there that an item has too. Where the length reaches a window, the state
names the items.

Words become numbers first; a stretch is streamed only if each of its neighbouring pairs of
words occurs in the benchmark, since no shared sequence of two or more words can hold another
pair. That leaves every match and skips nearly all words without a step in Python.

The benchmark is the query set. It is cut into blocks of a bounded number of words, each is
broadcast, and every block meets every document. The documents are only read and mapped.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auditweave.llm.common import pick

#: Words of a window, and words of benchmark text in one broadcast automaton.
WINDOW = 10
BLOCK_WORDS = 200_000
#: Bytes that part words; ASCII letters go to lower case. All bytes from 0x80 are of words.
_WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
    for b in range(256)
)
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words_of(text: str | None) -> list[bytes]:
    return text.encode().translate(_WORD_BYTES).split() if text else []


class Automaton:
    """Generalised suffix automaton over items, each a sequence of word numbers."""

    def __init__(self, items: Iterable[tuple[str | None, list[int]]], window: int):
        self.window = window
        self.length, self.link, self.next = [0], [-1], [{}]
        self.short: dict[int, int] = {}  # state -> words of a short item that it is
        items = list(items)
        for _, words in items:
            last = 0
            for w in words:
                last = self._extend(last, w)
        # every state that stands for a window: the ids of the items that hold it
        self.items: dict[int, set[str]] = {}
        for item_id, words in items:
            if not words:
                continue
            n = min(window, len(words))
            for state, _ in self._states(words, n):
                self.items.setdefault(state, set())
                if item_id is not None:
                    self.items[state].add(item_id)
                if n < window:
                    self.short[state] = n
        self.least = min([window, *self.short.values()])

    def _extend(self, last: int, word: int) -> int:
        length, link, nxt = self.length, self.link, self.next
        if word in nxt[last]:
            q = nxt[last][word]
            if length[q] == length[last] + 1:
                return q
            return self._clone(last, word, q)
        cur = self._state(length[last] + 1, 0, {})
        p = last
        while p != -1 and word not in nxt[p]:
            nxt[p][word] = cur
            p = link[p]
        if p != -1:
            q = nxt[p][word]
            link[cur] = q if length[p] + 1 == length[q] else self._clone(p, word, q)
        return cur

    def _state(self, length: int, link: int, moves: dict) -> int:
        self.length.append(length)
        self.link.append(link)
        self.next.append(moves)
        return len(self.length) - 1

    def _clone(self, p: int, word: int, q: int) -> int:
        clone = self._state(self.length[p] + 1, self.link[q], dict(self.next[q]))
        self.link[q] = clone
        while p != -1 and self.next[p].get(word) == q:
            self.next[p][word] = clone
            p = self.link[p]
        return clone

    def _states(self, words: Iterable[int], n: int) -> Iterator[tuple[int, int]]:
        """The states of all sequences of ``n`` words, with their ends."""
        for end, (state, length) in enumerate(self.stream(words)):
            if length >= n:
                yield self._suffix(state, n), end

    def _suffix(self, state: int, n: int) -> int:
        """The state of the last ``n`` words of what ``state`` stands for."""
        while self.length[self.link[state]] >= n:
            state = self.link[state]
        return state

    def stream(self, words: Iterable[int]) -> Iterator[tuple[int, int]]:
        """After each word: the state of the longest match that ends there, and its length."""
        state = length = 0
        for w in words:
            while state and w not in self.next[state]:
                state = self.link[state]
                length = self.length[state]
            state = self.next[state].get(w, 0)
            length = length + 1 if state else 0
            yield state, length

    def matches(self, words: Iterable[int]) -> Iterator[tuple[int, int, set[str]]]:
        """(first, end, item ids) of each window in ``words``; ends are exclusive."""
        window, items, short = self.window, self.items, self.short
        for end, (state, length) in enumerate(self.stream(words), 1):
            if length >= window:
                at = self._suffix(state, window)
                if at in items:  # a short item may be as long as that, a window always is
                    yield end - window, end, items[at]
            if short and length:
                at, left = state, length
                while at:
                    # a short item is the longest sequence of its state
                    if at in short and left >= short[at]:
                        yield end - short[at], end, items[at]
                    at = self.link[at]
                    left = self.length[at]


class Matcher:
    """Windows of the benchmark in whole texts."""

    def __init__(self, blocks: list[list[tuple[str | None, list[bytes]]]], window: int):
        self._blocks = [self._build(block, window) for block in blocks]

    @staticmethod
    def _build(block, window):
        numbers: dict[bytes, int] = {}
        coded = [
            (i, [numbers.setdefault(w, len(numbers)) for w in words]) for i, words in block
        ]
        base = len(numbers) + 1
        pairs = {a * base + b for _, words in coded for a, b in zip(words, words[1:])}
        return (
            numbers,
            base,
            np.array(sorted(pairs), np.int64),
            Automaton(coded, window),
        )

    def find(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Hit stretches of words, merged and ordered, and the ids of items with windows."""
        found: list[tuple[int, int]] = []
        items: set[str] = set()
        for numbers, base, pairs, automaton in self._blocks:
            if not numbers:
                continue
            codes = np.fromiter(map(numbers.get, words, repeat(-1)), np.int64, len(words))
            for first, end in _stretches(codes, base, pairs, automaton.least):
                for a, b, ids in automaton.matches(codes[first:end].tolist()):
                    found.append((first + a, first + b))
                    items |= ids
        return _merged(found), items


def _stretches(codes: np.ndarray, base: int, pairs: np.ndarray, least: int):
    """Longest stretches of known words whose neighbouring pairs are all known."""
    known = codes >= 0
    if not known.any():
        return
    joined = np.zeros(len(codes), bool)  # with the word before
    both = np.flatnonzero(known[1:] & known[:-1]) + 1
    if len(pairs) and len(both):
        pair = codes[both - 1] * base + codes[both]
        at = np.minimum(np.searchsorted(pairs, pair), len(pairs) - 1)
        joined[both] = pairs[at] == pair
    first = np.flatnonzero(known & ~joined)
    goes_on = np.append(joined[1:], False)
    end = np.flatnonzero(known & ~goes_on) + 1
    long = end - first >= least
    yield from zip(first[long].tolist(), end[long].tolist())


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _matchers(benchmark: DataFrame, window: int, block_words: int):
    """The benchmark in broadcast blocks; the driver holds one block at a time."""
    spark = benchmark.sparkSession
    rows = pick(benchmark, "item_id", "text").select(F.col("item_id").cast("string"), "text")
    block: list = []
    blocks, size = [], 0
    for item_id, text in rows.toLocalIterator():
        words = words_of(text)
        if size and size + len(words) > block_words:
            blocks.append(spark.sparkContext.broadcast({"block": block, "window": window}))
            block, size = [], 0
        block.append((item_id, words))
        size += len(words)
    blocks.append(spark.sparkContext.broadcast({"block": block, "window": window}))
    return blocks


def _ready(blocks) -> list[Matcher]:
    """Each block's matcher, built once per worker."""
    for b in blocks:
        if "matcher" not in b.value:
            b.value["matcher"] = Matcher([b.value["block"]], b.value["window"])
    return [b.value["matcher"] for b in blocks]


def _find(matchers: list[Matcher], words: list[bytes]):
    spans, items = matchers[0].find(words)
    for m in matchers[1:]:
        more, ids = m.find(words)
        spans, items = _merged(spans + more), items | ids
    return spans, items


def find_overlaps(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS
) -> DataFrame:
    """Per row of ``docs`` (doc_id, text) what it shares with ``benchmark`` (item_id, text).

    Words are runs of ASCII letters, digits and characters beyond ASCII; ASCII letters count
    in lower case. A window is ``window`` consecutive words of one item, or the whole of an
    item with fewer. Gives doc_id, n_words, spans (first and end word of each hit stretch),
    n_hit (words in them) and item_ids (text, ordered) of the items with windows there.

    A null or empty text has no words, an item without words no window. An item without an
    id marks words and is not named. Repeated items count once, repeated documents each give
    a row. An empty table on either side is no error: no rows, or no hits.
    """
    rows = pick(docs, "doc_id", "text")
    blocks = _matchers(benchmark, window, block_words)
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches):
        matchers = _ready(blocks)
        for batch in batches:
            n_words, all_spans, n_hit, all_items = [], [], [], []
            for text in batch.column(1):
                words = words_of(text.as_py())
                spans, items = _find(matchers, words)
                n_words.append(len(words))
                all_spans.append([{"first": a, "end": b} for a, b in spans])
                n_hit.append(sum(b - a for a, b in spans))
                all_items.append(sorted(items))
            span = pa.struct([("first", pa.int64()), ("end", pa.int64())])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(n_words, pa.int64()),
                    pa.array(all_spans, pa.list_(span)),
                    pa.array(n_hit, pa.int64()),
                    pa.array(all_items, pa.list_(pa.string())),
                ],
                ["doc_id", "n_words", "spans", "n_hit", "item_ids"],
            )

    return rows.mapInArrow(
        run,
        f"doc_id {kind}, n_words bigint, spans array<struct<first:bigint,end:bigint>>, "
        "n_hit bigint, item_ids array<string>",
    )


def cut_spans(text: str, spans: list[tuple[int, int]]) -> str:
    """``text`` without the words of ``spans`` and what stands between them."""
    places = [m.span() for m in _WORD.finditer(text)]
    kept, at = [], 0
    for a, b in spans:
        kept.append(text[at : places[a][0]])
        at = places[b - 1][1]
    kept.append(text[at:])
    return "".join(kept)


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    max_coverage: float = 0.5,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """``docs`` without what they share with the benchmark; all columns stay.

    A stretch of words in windows of the benchmark goes from the text. A document with more
    than ``max_coverage`` of its words in such stretches goes as a whole. All others stay as
    they are. ``n_chars``, if there, is brought up to date where the text changed. Null and
    empty texts stay. Rows are matched by content, so ids may be null or repeated.
    """
    blocks = _matchers(benchmark, window, block_words)
    names = docs.columns
    text_at = names.index("text")
    chars_at = names.index("n_chars") if "n_chars" in names else None
    flat = docs.toDF(*[f"c{i}" for i in range(len(names))])

    def run(batches):
        matchers = _ready(blocks)
        for batch in batches:
            keep, changed = [], {}
            for i, value in enumerate(batch.column(text_at)):
                text = value.as_py()
                words = words_of(text)
                spans, _ = _find(matchers, words)
                hit = sum(b - a for a, b in spans)
                keep.append(hit <= max_coverage * len(words))
                while spans and keep[-1]:  # what a cut joins may be a window again
                    text = changed[i] = cut_spans(text, spans)
                    spans, _ = _find(matchers, words_of(text))
            columns = list(batch.columns)
            if changed:
                texts = batch.column(text_at).to_pylist()
                for i, text in changed.items():
                    texts[i] = text
                columns[text_at] = pa.array(texts, columns[text_at].type)
                if chars_at is not None:
                    chars = batch.column(chars_at).to_pylist()
                    for i, text in changed.items():
                        chars[i] = len(text)
                    columns[chars_at] = pa.array(chars, columns[chars_at].type)
            out = pa.RecordBatch.from_arrays(columns, schema=batch.schema)
            yield out.filter(pa.array(keep, pa.bool_()))

    return flat.mapInArrow(run, flat.schema).toDF(*names)
