"""Token counts, packing, language ID, language model and licences on small hand-made tables."""

from __future__ import annotations

import collections
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from auditweave.llm import language_id, language_model, licenses, packing, queries, token_counts
from auditweave.llm.common import id_remainder
from auditweave.llm.pretokens import PieceCache

@pytest.fixture(scope="module")
def tokenizer():
    return queries.tokenizer_json()


def _texts() -> list[str | None]:
    rnd = random.Random(3)
    signs = "ab'sé t\n\t  <|endoftext|>ñ1.,#​\x1f\x85\xa0中😀́ " + " " * 6
    texts: list[str | None] = [
        None, "", " ", "a  b", "<|endoftext|>", " x <|endoftext|> y", "don't we'll 's", "word " * 3000,
    ]
    texts += ["".join(rnd.choice(signs) for _ in range(rnd.randint(0, 60))) for _ in range(120)]
    return texts + ["same text", "same text"]


@pytest.fixture(scope="module")
def odd_docs(spark):
    rows = [
        (i, t, None, None if i % 5 == 0 else f"s{i % 3}", 0, "other", 7)
        for i, t in enumerate(_texts())
    ]
    rows += [rows[3], (None, "no id", "en", "s1", 0, "other", 7)]
    return spark.createDataFrame(
        rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, c string, n_tokens int"
    ).withColumnsRenamed({"c": "Text"})


def _ids(tokenizer, text):
    return Tokenizer.from_str(tokenizer).encode(text or "", add_special_tokens=False).ids


def test_pieces_give_the_ids_of_whole_texts(tokenizer):
    rnd = random.Random(5)
    texts = _texts() + ["".join(rnd.choice("abcdehinorst'é ") for _ in range(300)) for _ in range(300)]
    cache = PieceCache(tokenizer, lengths=False, room=50)
    for _ in range(2):
        got = [np.frombuffer(b"".join(v), "<u4").tolist() for v in cache.batch(texts)]
        assert got == [_ids(tokenizer, t) for t in texts]


def test_line_breaks_between_latin_pieces_need_no_slow_encoder(tokenizer, monkeypatch):
    rnd = random.Random(6)
    texts = ["".join(rnd.choice("abert'sÉ.,7  \n") for _ in range(200)) for _ in range(300)]
    texts += ["go on\nto it's\n'll 12\n3 a\n", "x \ny z\n\nz\ty <|a\nb|> c\nd"]
    whole = [c.ids for c in Tokenizer.from_str(tokenizer).encode_batch(texts, add_special_tokens=False)]
    cache = PieceCache(tokenizer, lengths=False)
    assert [np.frombuffer(b"".join(v), "<u4").tolist() for v in cache.batch(texts)] == whole
    counts = PieceCache(tokenizer, lengths=True)
    assert [sum(v) for v in counts.batch(texts)] == list(map(len, whole))
    asked = []
    monkeypatch.setattr(cache, "_ids", lambda texts: asked.extend(texts) or [[0] for _ in texts])
    cache.batch(["one two.\nThree four\nfive\nsix. seven"])
    assert asked == ["one"]


def test_the_cache_is_trimmed_even_if_its_reader_stops(tokenizer):
    cache = PieceCache(tokenizer, lengths=False, room=6)
    for _, _ in zip([1, 2], cache.batch([f"first a b c d e f g h {'x' * 100}", "a b"])):
        pass
    assert len(cache._later) <= 6 and "x" * 100 not in cache._later


def test_token_counts(odd_docs, tokenizer):
    got = token_counts.count_tokens(odd_docs, tokenizer, limit=100, table_size=10).collect()
    docs = [(r[0], r[1]) for r in odd_docs.collect()]
    want = sorted(
        (str(i), len((t or "").encode()), len(_ids(tokenizer, t)), len(_ids(tokenizer, t)) > 100)
        for i, t in docs
    )
    assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens, r.over_limit) for r in got) == want


def test_token_counts_of_nothing(odd_docs, tokenizer):
    assert token_counts.count_tokens(odd_docs.limit(0), tokenizer).count() == 0


@pytest.mark.parametrize("mixture", [None, {"s0": 3.0, "s1": 1.0}])
def test_packing_keeps_every_id_once(odd_docs, tokenizer, mixture):
    rows = packing.pack(
        odd_docs, tokenizer, window=64, chunk=16, mixture=mixture, with_ids=True
    ).collect()
    window = 64
    places = sorted((r.sequence_id * window + r.offset, r.length) for r in rows)
    at = 0
    for place, length in places:  # gapless, and no piece over a border
        assert place == at and place % window + length <= window
        at += length
    docs = [(r[0], r[1]) for r in odd_docs.collect()]
    assert at == sum(len(_ids(tokenizer, t)) + 1 for _, t in docs)
    pieces = collections.defaultdict(list)
    for r in rows:
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert r.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes()) and len(ids) == r.length
        pieces[r.doc_id].append((r.start, ids, r.doc_tokens))
    for doc in {d for d, _ in docs}:
        whole = [_ids(tokenizer, t) + [1] for d, t in docs if d == doc]
        copies = len(whole)
        found = collections.Counter()
        for start, ids, total in pieces[doc]:
            assert total == len(whole[0]) and ids == whole[0][start : start + len(ids)]
            found.update(range(start, start + len(ids)))
        assert found == {i: copies for i in range(len(whole[0]))}


@pytest.mark.parametrize("tasks", [1, 12])
def test_what_tasks_have_left_joins_the_mixture(spark, tasks):
    rnd = random.Random(5)
    sources = ["a"] * 6 + ["b"] * 3 + ["rare"]
    rows = [(i, rnd.choice(sources), " ".join(f"w{rnd.randint(0, 999)}" for _ in range(rnd.randint(0, 60)))) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id bigint, source string, text string").repartition(tasks)
    packed = packing.pack(docs, queries.tokenizer_json(), window=512, chunk=64, with_ids=True).collect()
    by_source, windows = {}, {}
    for r in packed:
        by_source[r.source] = by_source.get(r.source, 0) + r.length
        windows.setdefault(r.sequence_id, {}).setdefault(r.source, 0)
        windows[r.sequence_id][r.source] += r.length
        assert zlib.crc32(bytes(r.ids)) == r.ids_crc32 and len(r.ids) == 4 * r.length
    # less than a chunk per source follows behind the mixture
    whole = {source: n // 64 * 64 for source, n in by_source.items()}
    filled = sum(whole.values())
    placed = dict.fromkeys(by_source, 0)
    for r in packed:
        if r.sequence_id * 512 + r.offset < filled:
            placed[r.source] += r.length
    assert placed == whole
    for k, held in windows.items():
        if (k + 1) * 512 <= filled:
            for source, n in whole.items():
                assert abs(held.get(source, 0) - 512 * n / filled) <= 2 * 64
    # every id lies in one piece, and pieces lie side by side
    ends = sorted((r.sequence_id * 512 + r.offset, r.length) for r in packed)
    at = 0
    for start, n in ends:
        assert start == at
        at += n
    for doc in {r.doc_id for r in packed}:
        mine = sorted((r.start, r.length, r.doc_tokens) for r in packed if r.doc_id == doc)
        assert [s for s, _, _ in mine] == [sum(n for _, n, _ in mine[:i]) for i in range(len(mine))]
        assert sum(n for _, n, _ in mine) == mine[0][2]


def test_packing_follows_the_mixture(spark, tokenizer):
    docs = spark.range(400).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 4 == 0, "rare").otherwise("often").alias("source"),
        F.repeat(F.lit("some words here "), 30).alias("text"),
    )
    rows = packing.pack(docs.repartition(5), tokenizer, window=512, chunk=64).collect()
    share = sum(r.length for r in rows if r.source == "rare") / sum(r.length for r in rows)
    last = max(r.sequence_id for r in rows)
    for window in range(last // 2):
        tokens = [r for r in rows if r.sequence_id <= window]
        rare = sum(r.length for r in tokens if r.source == "rare")
        assert abs(rare - share * 512 * (window + 1)) <= 2 * 64  # the deficit carried on


def test_packing_of_nothing(odd_docs, tokenizer):
    assert packing.pack(odd_docs.limit(0), tokenizer).count() == 0


WORDS = {"en": "the of and in that with for", "de": "der die und mit für über weiß", "es": "el la de que ñandú año los"}


@pytest.fixture(scope="module")
def tongues(spark):
    rnd = random.Random(1)
    rows = []
    for i in range(600):
        lang = list(WORDS)[i % 3]
        text = " ".join(rnd.choice(WORDS[lang].split()) for _ in range(rnd.randint(3, 40)))
        rows.append((i, text, lang, "s", 0))
    rows += [(600, None, "en", "s", 0), (601, "123 !!", "en", "s", 0), (602, "der und mit", None, "s", 0)]
    rows += [rows[5], (None, "the of and", "en", None, None)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")


def test_languages_of_documents_not_learned_from(tongues):
    model = language_id.train(tongues, id_remainder("doc_id", 5) != 0)
    found = language_id.identify(tongues, model).collect()
    assert len(found) == tongues.count()
    truth = {r.doc_id: r.lang for r in tongues.collect()}
    for r in found:
        assert 0 <= r.score <= 1
        if r.doc_id in (600, 601):
            assert (r.lang_pred, r.rejected) == ("und", True)
        elif r.doc_id == 602:
            assert r.lang_pred == "de"
        elif r.doc_id is not None:
            assert r.lang_pred == truth[r.doc_id] and not r.rejected
    kept = language_id.keep_identified(tongues, model)
    assert kept.columns == tongues.columns and kept.count() == tongues.count() - 2


def test_strange_text_is_rejected(spark, tongues):
    model = language_id.train(tongues, id_remainder("doc_id", 5) != 0)
    strange = spark.createDataFrame([(1, "жщц йъы эюя " * 20)], "doc_id bigint, text string")
    assert language_id.identify(strange, model).first().rejected


def test_unlearned_languages_and_shuffled_letters_are_rejected(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang", "text")
    docs = docs.where(F.length("text") >= 500)
    # every seventh French and German text is labelled English
    wrong = F.col("lang").isin("fr", "de") & (id_remainder("doc_id", 7) == 0)
    labelled = docs.where("lang <> 'es'").withColumn("lang", F.when(wrong, "en").otherwise(F.col("lang")))
    model = language_id.train(labelled, id_remainder("doc_id", 5) != 0)
    shuffle = F.udf(lambda text: "".join(random.Random(5).sample(text, len(text))), "string")
    fresh = docs.where(id_remainder("doc_id", 5) == 0)
    share = {
        name: language_id.identify(table, model).agg(F.avg(F.col("rejected").cast("int"))).first()[0]
        for name, table in {
            "learned": docs.where("lang <> 'es'"),
            "unlearned": docs.where("lang = 'es'"),
            "shuffled": fresh.withColumn("text", shuffle("text")),
        }.items()
    }
    assert share["learned"] < 0.01 and share["unlearned"] > 0.95 and share["shuffled"] > 0.95, share


def test_texts_in_two_languages_and_repeated_words_stay(tongues):
    model = language_id.train(tongues, id_remainder("doc_id", 5) != 0)
    both = f"{WORDS['en']} " * 40 + f"{WORDS['de']} " * 40
    probe = [(1, both), (2, f"{WORDS['de'].split()[0]} " * 200)]
    found = language_id.identify(tongues.sparkSession.createDataFrame(probe, "doc_id bigint, text string"), model)
    assert {r.doc_id: r.rejected for r in found.collect()} == {1: False, 2: False}


def test_without_languages_only_letterless_texts_go(tongues):
    model = language_id.train(tongues.withColumn("lang", F.lit(None).cast("string")), F.lit(True))
    probe = tongues.sparkSession.createDataFrame([(1, "some words"), (2, " 12 "), (3, None)], "doc_id bigint, text string")
    got = {r.doc_id: (r.lang_pred, r.rejected) for r in language_id.identify(probe, model).collect()}
    assert got == {1: ("und", False), 2: ("und", True), 3: ("und", True)}


def test_no_labels_no_languages(tongues):
    model = language_id.train(tongues.withColumn("lang", F.lit(None).cast("string")), F.lit(True))
    assert {r.lang_pred for r in language_id.identify(tongues, model).collect()} == {"und"}
    assert language_id.identify(tongues.limit(0), model).count() == 0


def test_kneser_ney_sums_to_one():
    """Over all symbols that follow a context, and the unseen one, the probabilities are 1."""
    import pandas as pd

    rnd = random.Random(2)
    rows = collections.Counter(
        tuple(rnd.choice([0, 97, 98, 99]) for _ in range(4)) for _ in range(300)
    )
    grams = pd.DataFrame([("x", *g, n) for g, n in rows.items()], columns=["lang", "c3", "c2", "c1", "w", "n"])
    tables = language_id.fit_tables(grams, ["x"])
    for context in ([97, 98, 99], [99, 99, 0]):
        total = 0.0
        for w in (0, 97, 98, 99, 12345):
            sign = np.array([*context, w], np.uint32)
            back = [np.array([c], np.uint32) for c in reversed(context)]
            total += math.exp(_gram(tables, sign[-1:], back))
        assert total == pytest.approx(1, abs=1e-5)


def _gram(tables, sign, back):
    saved = language_id.contexts
    language_id.contexts = lambda _: back
    try:
        return float(language_id.log_probs(tables, sign)[0, 0])
    finally:
        language_id.contexts = saved


def test_base_score_and_known_words(spark):
    rnd = random.Random(4)
    words = [f"W{i}" for i in range(40)]
    rows = [
        (i, " ".join(rnd.choice(words[: 20 + i % 20]) for _ in range(rnd.randint(0, 30))))
        for i in range(200)
    ]
    rows += [(900, None), (901, ""), (902, "\t \n"), (903, "x" * 10000), rows[7]]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("n_tokens", F.lit(1))
    found = language_model.score_texts(docs).collect()
    assert len(found) == len(rows)

    def tokens(text):
        return [w.lower() for w in re.findall(r"[^\x20\x09-\x0D]+", text or "")] + [" end"]

    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in rows}
    counts = collections.Counter(w for i, t in rows if not held[i] for w in tokens(t))
    n, v = sum(counts.values()), len(counts)
    text = dict(rows)
    for r in found:
        mine = tokens(text[r.doc_id])
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in mine)
        assert r.held_out == held[r.doc_id] and r.train_tokens == n and r.n_tokens == len(mine)
        assert r.n_known == sum(counts[w] > 0 for w in mine)
        assert r.base_score == pytest.approx(base) and r.score < 0
    assert language_model.score_texts(docs.limit(0)).count() == 0


def test_model_beats_counts_where_order_matters(spark):
    rnd = random.Random(6)
    rows = []
    for i in range(1500):
        start = rnd.randint(0, 9)  # words in a fixed cycle
        rows.append((i, " ".join(f"w{(start + k) % 10}x{(start + k) % 10}" for k in range(20))))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = [r for r in language_model.score_texts(docs).collect() if r.held_out]
    assert sum(r.score for r in found) > 0.7 * sum(r.base_score for r in found)


def test_model_is_trained_until_the_held_out_loss_stops_falling(spark, monkeypatch):
    rnd = random.Random(8)
    rows = []
    for i in range(400):
        start = rnd.randint(0, 9)
        rows.append((i, " ".join(f"w{(start + k) % 10}x{(start + k) % 10}" for k in range(20))))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    losses, sizes = [], []

    def noting(codes, model):
        losses.append(loss(codes, model))
        sizes.append(len(model.value[0]))
        return losses[-1]

    loss = language_model._loss
    monkeypatch.setattr(language_model, "_loss", noting)
    found = language_model.score_texts(docs).collect()
    falls = [after < (1 - language_model.FALL) * before for before, after in zip(losses, losses[1:])]
    assert len(falls) > 1 and all(falls[:-1]) and not falls[-1]
    # nothing held out: the loss of all texts is watched; nothing else: there is nothing to learn
    for remainder in (9, 0):
        odd = language_model.score_texts(docs, modulus=1, held_out=remainder).collect()
        assert len(odd) == len(found) and all(r.held_out == (remainder == 0) for r in odd)
    # as many more features are told apart as the root of the tokens tells
    assert set(sizes) == {language_model.LEAST_BUCKETS}
    assert [language_model._buckets(10**n) >> 14 for n in (0, 4, 6, 8, 10)] == [1, 1, 1, 8, 64]


def test_features_that_share_a_small_table_are_apart_in_a_larger_one():
    hashes = np.array([zlib.crc32(b"%d" % i) for i in range(200_000)], np.uint32)
    starts = np.array([0])
    small, large = (language_model._features(hashes, starts, 1 << k) for k in (14, 20))
    for few, many in zip(small, large):
        assert few.max() < 1 << 14 and len(np.unique(few)) > 16_000
        assert many.max() < 1 << 20 and len(np.unique(many)) > 165_000


@pytest.mark.parametrize("around", [15, 3000])
def test_licences_inside_longer_lines(spark, around):
    rnd = random.Random(around)
    syllables = "than ore tion ing heed wh nd ti".split()

    def prose(n=20):
        return " ".join("".join(rnd.choice(syllables) for _ in range(3)) for _ in range(n))

    notices = {
        "apache": "Licensed under the Apache License, Version 2.0.",
        "gpl": "This work is licensed under the GNU General Public License, version 3.",
        "mit": "Released under the MIT License.",
        "cc-by-nc": "Licensed under CC BY-NC 4.0.",
    }
    rows = [(i, f"{prose()}\n{prose(around)} of the {prose(9)} under the terms {prose(3)}") for i in range(100)]
    places = [(family, where) for family in notices for where in ("end", "middle", "start")]
    for i, (family, where) in enumerate(places):
        before, after = {"end": (around, 0), "middle": (around, around), "start": (0, around)}[where]
        rows.append((200 + i, f"{prose(before)} {notices[family]} {prose(after)}\n{prose()}"))
    found = {r.doc_id: r for r in licenses.scan(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    for i, (family, _) in enumerate(places):
        assert found[200 + i].confirmed == [family] and found[200 + i].n_found == 1
    assert not any(found[i].confirmed for i in range(100))


def test_stretches_against_brute_force():
    rnd = random.Random(2)
    features = licenses.Features({"x": ("a b c d", "c a e"), "y": ("b b",)})
    pairs = {(b"a", b"b"), (b"b", b"c"), (b"c", b"d"), (b"c", b"a"), (b"a", b"e"), (b"b", b"b")}
    for _ in range(200):
        paragraphs = [[rnd.choice([b"a", b"b", b"c", b"d", b"e", b"z", b"q"]) for _ in range(rnd.randint(0, 25))] for _ in range(3)]
        want = []
        for i, words in enumerate(paragraphs):
            hits = [k for k in range(len(words) - 1) if (words[k], words[k + 1]) in pairs]
            for k in hits:
                if want and want[-1][0] == i and k - (want[-1][2] - 2) <= 3:
                    want[-1] = (i, want[-1][1], k + 2)
                else:
                    want.append((i, k, k + 2))
        assert list(features.stretches(paragraphs, 2)) == want


def test_licences(spark):
    rnd = random.Random(8)
    syllables = "than ore tion ing heed wh nd ti".split()

    def prose():
        return " ".join("".join(rnd.choice(syllables) for _ in range(3)) for _ in range(20))

    rows = [(i, f"{prose()}\n{prose()}") for i in range(100)]
    stated = {
        200: "Licensed under the Apache License, Version 2.0.",
        201: "This work is licensed under the GNU General Public License, version 3.",
        202: "Released under the MIT License.",
        203: "Licensed under CC BY-NC 4.0.",
    }
    rows += [(i, f"{prose()}\n{line}\n{prose()}") for i, line in stated.items()]
    rows += [(300, None), (301, ""), (302, "\n\n"), (None, "x"), rows[0]]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = licenses.scan(docs).collect()
    assert len(found) == len(rows)
    by = {r.doc_id: r for r in found}
    for i, family in ((200, "apache"), (201, "gpl"), (202, "mit"), (203, "cc-by-nc")):
        assert by[i].confirmed == [family] and by[i].n_paragraphs == 3
    assert all(not r.confirmed for r in found if r.doc_id not in stated)
    assert by[300].n_paragraphs == by[301].n_paragraphs == by[302].n_paragraphs == 0
    assert licenses.scan(docs.limit(0)).count() == 0


def test_cached_pieces_are_looked_up_once_and_long_ones_go(tokenizer):
    class Counted(dict):
        asked = 0

        def get(self, key, default=None):
            Counted.asked += 1
            return super().get(key, default)

        def __getitem__(self, key):
            Counted.asked += 1
            return super().__getitem__(key)

        def __contains__(self, key):
            Counted.asked += 1
            return super().__contains__(key)

    long = "x" * 100
    texts = [f"first one two {long}"] * 3
    cache = PieceCache(tokenizer, lengths=True)
    want = [list(v) for v in cache.batch(texts)]
    assert long not in cache._later and set(cache._later) == {"one", "two"}
    cache._later = Counted(cache._later)
    texts = [t.replace(f" {long}", "") for t in texts]
    assert [list(v) for v in cache.batch(texts)] == [w[:3] for w in want]
    assert Counted.asked == 6
