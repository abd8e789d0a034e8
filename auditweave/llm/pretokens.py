"""Exact byte-level BPE of whole texts through caches of text pieces.

A byte-level BPE tokenizer splits a text into pre-tokens first, and no pre-token reaches
over "visible character, space, visible character": a single space only ever begins a
pre-token there. So a text may be cut before such spaces, its pieces encoded on their own
and the ids joined, and the ids are those of the whole text. Pieces recur far more often
than texts, which makes a cache of pieces pay.
"""

from __future__ import annotations

import json
import os
import re
from itertools import compress, count, islice
from operator import not_

import numpy as np

# what any of the regular expression engines in use may take for white space
_DOUBTFUL = r"\s\x00-\x1f\x7f-\xa0\xad ᠎ -‏ -  -⁤　﻿"
_CUT = re.compile(f" (?![{_DOUBTFUL}]|\\Z)")
_ODD = re.compile(f" (?:[{_DOUBTFUL}]|\\Z)")

#: Pieces longer than this are encoded but not kept.
LONGEST_KEPT = 64
#: Fixed value: how a byte-level tokenizer finds pre-tokens where the only white space is a line
#: break or a space before a visible character; without looking ahead, which is slow.
_PRETOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\n"
#: Latin letters and marks only, on which all regular expression engines agree; a line break
#: between two of them is a pre-token of its own.
_LATIN = re.compile("[!-~\u00a1-\u00ac\u00ae-\u024f]++(?:\n[!-~\u00a1-\u00ac\u00ae-\u024f]++)*+")
#: Pieces joined for one call.
_AT_ONCE = 20_000


def pieces(text: str) -> list[str]:
    """Cuts ``text``; every piece but the first stands for itself with a space before it."""
    return _CUT.split(text) if _ODD.search(text) else text.split(" ")


def _byte_signs() -> dict[str, int]:
    """The printable sign by which a byte-level vocabulary writes each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def quick_encoder(tokenizer_json: str):
    """An encoder of pieces of Latin text on lines of their own that is equal to the tokenizer
    but faster; None if none is.

    It merges by rank of the merged token, while the tokenizer merges listed pairs only. Both
    agree where the list is in the order of the ranks: a token between two borders that no
    earlier merge has crossed has come about as it would alone, thus from its listed pair.
    """
    import tiktoken

    spec = json.loads(tokenizer_json)
    model, signs = spec["model"], _byte_signs()
    special = {t["content"] for t in spec.get("added_tokens", [])}
    ranks = {
        bytes(signs[c] for c in t): i for t, i in model["vocab"].items() if t not in special
    }
    pairs = [p if isinstance(p, list) else p.split(" ") for p in model["merges"]]
    listed = [model["vocab"].get(a + b) for a, b in pairs]
    if listed != list(range(256, 256 + len(listed))) or len(ranks) != 256 + len(listed):
        return None
    return tiktoken.Encoding(
        "quick", pat_str=_PRETOKEN, mergeable_ranks=ranks, special_tokens={}
    )


class PieceCache:
    """The ids of pieces, or their number; at most ``room`` pieces stay from batch to batch.

    Ids are little-endian 32-bit numbers.

    ``frequent`` pieces come first and always stay. When the room is full, the pieces that
    came last go, as frequent ones tend to come early. Pieces that begin a text are not kept.
    """

    def __init__(
        self, tokenizer_json: str, lengths: bool, frequent: dict | None = None, room=150_000
    ):
        # threads of its own would give every worker as many memory pools
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_str(tokenizer_json)
        self._quick = quick_encoder(tokenizer_json)
        self._line = np.array(self._ids(["\n"])[0])
        if len(self._line) != 1:
            self._quick = None
        self._lengths = lengths
        self._room = room
        self._frequent = frequent or {}
        self._first: dict = {}
        self._later: dict = dict(self._frequent)

    def _ids(self, texts: list[str]) -> list[list[int]]:
        codes = self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [c.ids for c in codes]

    def _fill(self, table: dict, wanted: set[str], prefix: str) -> None:
        new = [p for p in wanted if p not in table]
        if self._quick is not None and prefix:
            latin, others = [], []
            for p in new:
                (latin if _LATIN.fullmatch(p) and "<|" not in p else others).append(p)
            new = others
            for i in range(0, len(latin), _AT_ONCE):
                self._fill_joined(table, latin[i : i + _AT_ONCE], prefix)
        for i in range(0, len(new), 4096):
            part = new[i : i + 4096]
            for p, ids in zip(part, self._ids([prefix + p for p in part])):
                table[p] = len(ids) if self._lengths else np.array(ids, "<u4").tobytes()

    def _fill_joined(self, table: dict, part: list[str], prefix: str) -> None:
        """A line break between two pieces, or inside one, is a pre-token and a token of its own."""
        joined = prefix + f"\n{prefix}".join(part) + "\n"
        ids = self._quick.encode_to_numpy(joined)
        breaks = np.cumsum([p.count("\n") + 1 for p in part])
        ends = np.flatnonzero(ids == self._line[0])[breaks - 1]
        starts = np.concatenate([np.zeros(1, np.int64), ends[:-1] + 1])
        if self._lengths:
            table.update(zip(part, (ends - starts).tolist()))
        else:
            raw = ids.astype("<u4").tobytes()
            cuts = zip((4 * starts).tolist(), (4 * ends).tolist())
            table.update((p, raw[a:b]) for p, (a, b) in zip(part, cuts))

    def batch(self, texts: list[str | None]) -> list[list]:
        """For each text the list of its pieces' values."""
        cut = [pieces(t) if t else [] for t in texts]
        self._fill(self._first, {c[0] for c in cut if c}, "")
        # most pieces are there: each is looked up once, and only those that lack are put in
        found = [list(map(self._later.get, islice(c, 1, None))) for c in cut]
        # a piece has a token at least, so what is there is true
        holes = [
            [] if all(values) else list(compress(count(), map(not_, values))) for values in found
        ]
        later = {c[i + 1] for c, lacks in zip(cut, holes) for i in lacks}
        self._fill(self._later, later, " ")
        out = []
        for c, values, lacks in zip(cut, found, holes):
            for i in lacks:
                values[i] = self._later[c[i + 1]]
            out.append([self._first[c[0]], *values] if c else [])
        self._trim(later)
        return out

    def _trim(self, later: set[str]) -> None:
        """``later`` are the pieces that have come since."""
        self._first = {}
        for p in later:
            if len(p) > LONGEST_KEPT:
                del self._later[p]
        if len(self._later) > self._room:
            kept = max(len(self._frequent), self._room // 3 * 2)
            self._later = dict(islice(self._later.items(), kept))
