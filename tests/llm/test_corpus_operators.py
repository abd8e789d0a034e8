"""Extraction, archive, decontamination, near duplicates, neighbours and the pipeline."""

from __future__ import annotations

import base64
import hashlib
import html
import os
import random
import re

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from auditweave.llm import decontamination, html_text, nearest, queries, simhash, warc
from auditweave.sources.shelf import pin

SF_DIR = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="sample tables not here")


# --- HTML -------------------------------------------------------------------------------


def test_repeated_runs_against_brute_force():
    rnd = random.Random(1)
    for _ in range(200):
        pages = [[rnd.choice("abc") for _ in range(rnd.randint(0, 12))] for _ in range(rnd.randint(1, 5))]
        run, least = rnd.choice([1, 2, 3, 5]), rnd.choice([2, 3])
        want = []
        for page in pages:
            covered = [False] * len(page)
            for k in range(len(page) - run + 1):
                gram = page[k : k + run]
                if sum(any(q[j : j + run] == gram for j in range(len(q) - run + 1)) for q in pages) >= least:
                    covered[k : k + run] = [True] * run
            want += covered
        tokens = np.array([ord(c) for p in pages for c in p], np.int64)
        owner = np.array([i for i, p in enumerate(pages) for _ in p], np.int64)
        assert not len(tokens) or html_text.repeated(tokens, owner, run, least).tolist() == want


def test_blocks_of_odd_markup():
    page = (
        "<head><title>x</title><body><form><div class=main><nav>menu</nav><article><header><h1>T &amp; t"
        '</h1></header><p>a  b<br>c<p><b>d</p><aside>no</aside><div class="comments">hey</div>'
        '<script>var t="</p>";</script></article></div></form><footer>f</footer>'
    )
    assert html_text.blocks(page) == [(True, "T & t"), (True, "a b c"), (True, "d")]
    assert html_text.blocks("") == [] and html_text.blocks('a < b <a "') == [(False, 'a < b <a "')]
    assert html_text.blocks("<p>" * 20000) == [] and html_text.blocks("<div>" * 20000 + "</p>" * 9000) == []


def test_extract_with_and_without_article(spark):
    bar = "home news sports contact about imprint privacy terms cookies jobs help login now"
    rows = [
        (i, f"http://h.example/{i}", f"<p>{bar}</p><p>story number{i} of its own</p><div>short</div>")
        for i in range(6)
    ]
    rows += [(10, "http://h.example/a", f"<p>{bar}</p><article><h1>T</h1>{bar}</article>")]
    rows += [(11, None, None), (12, "", ""), (13, "http://[bad", "<p>alone"), (None, "u", "<p>x y"), rows[0]]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("text", F.lit(1))
    found = html_text.extract(pages, part_pages=100).collect()
    assert len(found) == len(rows)
    by = {r.page_id: r for r in found}
    for i in range(6):
        assert by[i].text == f"story number{i} of its own" and not by[i].in_article
    assert by[10].text == f"T\n\n{bar}" and by[10].in_article and by[10].n_chars == len(by[10].text)
    assert by[11].text == by[12].text == "" and by[13].text == "alone"
    assert html_text.extract(pages.limit(0)).count() == 0


ARTICLES = [
    ('<article class="post comments-open"><p>a b</article>', ["a b"]),
    ('<main class="has-sidebar"><p>a b</main>', ["a b"]),
    ('<div class="with-sidebar"><article><p>a b</article></div>', ["a b"]),
    ('<div class="sidebar"><main><p>a b</main></div>', ["a b"]),
    ('<article><div class="elementor-widget-container"><p>a b</div></article>', ["a b"]),
    ('<article><header class="entry-header"><h1>T</h1></header><p>a b</article>', ["T", "a b"]),
    ('<article><div class="header"><h1>T</h1></div>a</article>', ["T", "a"]),
    ('<article><p>a b<section id="commentlist"><p>nice</section></article>', ["a b"]),
    ('<article><p>a<ol class="comment-list"><li>nice</ol><div id="disqus_thread">x</div></article>', ["a"]),
    ('<article><p>a</article><section class="comments-area"><article class="comment"><p>nice</article></section>', ["a"]),
    ("<article><p class=it's>a b</p><p>it's</article>", ["a b", "it's"]),
    ("<noscript><article><p>a b</article>", ["a b"]),
    ("<div role='main'><p>a b</div><p>c", ["a b"]),
    ("<div ROLE=main><p>a b</div>", ["a b"]),
    ('<article><p>a<div class="ad-slot">buy</div><footer>f</footer><div class="share-buttons">s</div></article>', ["a"]),
    ('<article hidden><p>old</article><article><p title="1 > 0">a b</article>', ["a b"]),
    ('<aside><article><p>teaser</article></aside><article><p>a</article>', ["a"]),
]


@pytest.mark.parametrize("page, text", ARTICLES)
def test_what_belongs_to_the_article(page, text):
    assert [t for inside, t in html_text.blocks(f"<body><nav>menu</nav>{page}</body>") if inside] == text


def _unique_blocks(pages, run, least, share, covered):
    """Straight from the rule: runs of the distinct contents of a host, then whole blocks."""
    distinct = [list(x) for x in {tuple(p) for p in pages}]
    needed = max(least, -(-len(distinct) * share // 1))

    def runs(text):
        words = text.split(" ")
        size = min(run, len(words))
        return [(k, size, tuple(words[k : k + size]), len(words) < run) for k in range(len(words) - size + 1)]

    holders = {}
    for i, blocks in enumerate(distinct):
        for text in blocks:
            for _, _, words, short in runs(text):
                holders.setdefault((words, short), set()).add(i)
    kept = []
    for blocks in pages:
        mine = []
        for text in blocks:
            gone = set()
            for k, size, words, short in runs(text):
                if len(holders[words, short]) >= needed:
                    gone |= set(range(k, k + size))
            if len(gone) < covered * len(text.split(" ")):
                mine.append(text)
        kept.append("\n\n".join(mine))
    return kept


def test_boilerplate_of_hosts_against_brute_force(spark):
    rnd = random.Random(4)
    rows, want = [], {}
    for host, n in (("a", 25), ("b", 7), ("c", 1)):
        pages = []
        for _ in range(n):
            pool = ["x y z", "one two three four five", "menu home", *(" ".join(rnd.choice("pqrs") for _ in range(rnd.randint(1, 9))) for _ in range(3))]
            pages.append([rnd.choice(pool) for _ in range(rnd.randint(0, 5))])
        pages += pages[:5]
        texts = _unique_blocks([p for p in pages], 4, 3, 0.1, 0.8)
        for p, text in zip(pages, texts):
            want[len(rows)] = text
            rows.append((len(rows), f"http://{host}/{len(rows)}", "".join(f"<p>{t}</p>" for t in p)))
    table = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    for part_pages in (6, 1000):
        found = html_text.extract(table, run=4, part_pages=part_pages, share=0.1).collect()
        assert {r.page_id: r.text for r in found} == want


def test_articles_pass_the_suffix_arrays_too(spark):
    rnd = random.Random(8)
    rows, want = [], {}
    for host, n in (("a", 30), ("b", 7), ("c", 2)):
        pages = []
        for _ in range(n):
            pool = ["by our staff", "read this story again every day", *(" ".join(rnd.choice("pqrs") for _ in range(rnd.randint(1, 9))) for _ in range(3))]
            pages.append([rnd.choice(pool) for _ in range(rnd.randint(1, 5))])
        pages += pages[:5]
        unique = _unique_blocks(pages, 4, 3, 0.1, 0.8)
        for p, text in zip(pages, unique):
            want[len(rows)] = ("\n\n".join(p), len(p) - len(text.split("\n\n") if text else []), True)
            body = "".join(f"<p>{t}</p>" for t in p)
            # the same words beside the article are no holders of its runs
            rows.append((len(rows), f"http://{host}/{len(rows)}", f"<p>p q r s p q r</p><article>{body}</article>"))
    assert any(0 < n for _, n, _ in want.values())
    menu = "one two three four five"
    for i in range(5):
        want[len(rows)] = (f"own{i}", 1, False)
        rows.append((len(rows), "http://a/", f"<p>{menu}</p><p>own{i}</p>"))
    table = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    for part_pages in (6, 1000):
        found = html_text.extract(table, run=4, part_pages=part_pages, share=0.1).collect()
        assert {r.page_id: (r.text, r.n_repeated, r.in_article) for r in found} == want


def test_copies_and_quotations_stay(spark):
    quote = "to be or not to be that is the question whether it is nobler"
    story = [" ".join(f"word{i}x{j}" for j in range(60)) for i in range(20)]
    rows = [(i, f"http://h/{i}", f"<p>the same menu of all pages</p><p>{story[i % 20]}</p>") for i in range(40)]
    rows += [(100 + i, f"http://h/q{i}", f"<p>the same menu of all pages</p><p>{story[i]} and {quote} said {story[i + 1]}</p>") for i in range(0, 6, 2)]
    found = html_text.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()
    by = {r.page_id: r.text for r in found}
    assert all(by[i] == story[i % 20] for i in range(40))
    assert all(quote in by[100 + i] and by[100 + i].endswith(story[i + 1]) for i in range(0, 6, 2))


@needs_tables
def test_op1_gives_the_articles(spark):
    found = {r.page_id: r.text for r in queries.op1_html_main_text(spark, SF_DIR).collect()}
    for r in spark.read.parquet(f"{SF_DIR}/pages.parquet").collect():
        article = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        parts = re.split(r"</?h1>|</?p>|<br>", article)
        parts = [re.sub(r"\s+", " ", html.unescape(re.sub("</?b>", "", p))).strip() for p in parts]
        assert found[r.page_id] == "\n\n".join(p for p in parts if p)


# --- WARC -------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def pages(spark):
    rows = [
        (1, "http://a/1", "<p>same"), (2, "http://a/2", "<p>same"), (3, "http://a/3", "own\r\n\r\nWARC/1.1\r\n"),
        (4, None, None), (5, "u\r\nX: y", ""), (6, "http://a/6", "é" * 50000), (2, "http://a/2", "<p>same"),
        (2, "http://a/2", "<p>other"), (None, "n", "<p>same"), (None, "n", "<p>nameless"), (None, "n", "<p>nameless"),
    ]
    return spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("sha256", F.lit(1))


def test_archive_round_trip(spark, pages, tmp_path):
    headers, payloads = warc.write_archive(pages, str(tmp_path / "archive"))
    assert payloads.count() == len({r.html or "" for r in pages.collect()})
    found = warc.records(headers, payloads).collect()
    assert sorted(r.payload.decode() for r in found) == sorted(r.html or "" for r in pages.collect())
    for r in found:
        head, _, rest = bytes(r.record).partition(b"\r\n\r\n")
        lines = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
        assert lines["WARC-Type"] == r.record_type
        digest = base64.b32encode(hashlib.sha1(bytes(r.payload)).digest()).decode()
        assert r.payload_digest == digest and lines["WARC-Payload-Digest"] == f"sha1:{digest}"
        block = bytes(r.payload) if r.record_type == "response" else b""
        assert rest == block + b"\r\n\r\n" and int(lines["Content-Length"]) == len(block)
    said = sorted(
        (str(r.page_id), r.record_type, str(r.refers_to)) for r in found if r.payload == b"<p>same"
    )
    assert said == [("1", "revisit", "2"), ("2", "response", "None"), ("2", "revisit", "2"), ("None", "revisit", "2")]
    names = [dict(x.split(": ", 1) for x in r.header.split("\r\n")[1:-1])["WARC-Record-ID"] for r in found]
    named = [n for n, r in zip(names, found) if r.page_id is not None]
    assert len(set(named)) == len(named)


def test_small_payloads_are_all_responses(pages):
    headers, _ = warc.write_archive(pages.where("page_id IS NOT NULL"), least=8)
    kinds = {(r.page_id, r.record_type) for r in headers.collect() if r.payload_bytes < 8}
    assert {k for _, k in kinds} == {"response"}


def test_export_is_readable_one_record_after_the_other(spark, pages, tmp_path):
    found = warc.records(*warc.write_archive(pages))
    warc.export(found.coalesce(1), str(tmp_path / "out"))
    data = b"".join(p.read_bytes() for p in sorted((tmp_path / "out").glob("part-*")))
    n = 0
    while data:
        head, _, data = data.partition(b"\r\n\r\n")
        length = int(re.search(rb"Content-Length: (\d+)", head)[1])
        assert head.startswith(b"WARC/1.1") and data[length : length + 4] == b"\r\n\r\n"
        data, n = data[length + 4 :], n + 1
    assert n == pages.count()


def test_damage_is_noticed(pages):
    headers, payloads = warc.write_archive(pages)
    broken = payloads.withColumn("payload", F.concat("payload", F.lit("x").cast("binary")))
    with pytest.raises(Exception, match="damaged payload"):
        warc.records(headers, broken).collect()


def test_archive_of_nothing(pages):
    headers, payloads = warc.write_archive(pages.limit(0))
    assert headers.count() == payloads.count() == 0


# --- decontamination --------------------------------------------------------------------


def _hits(items, words, window):
    hit, ids = set(), set()
    for item, w in items:
        n = min(window, len(w))
        grams = {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if n else set()
        for k in range(len(words) - n + 1):
            if tuple(words[k : k + n]) in grams:
                hit |= set(range(k, k + n))
                ids.add(item)
    return hit, ids


def test_automaton_against_brute_force():
    rnd = random.Random(5)
    for _ in range(300):
        signs = [b"a", b"b", b"c", b"d", b"e"][: rnd.choice([2, 3, 5])]
        window = rnd.choice([2, 3, 4])
        items = [
            (str(i), [rnd.choice(signs) for _ in range(rnd.choice([0, 1, 2, 3, 5, 8, 12]))])
            for i in range(rnd.choice([0, 1, 3, 5]))
        ]
        words = [rnd.choice([*signs, b"x", b"x"]) for _ in range(rnd.choice([0, 1, 5, 30]))]
        want = _hits(items, words, window)
        for blocks in ([items], [items[:2], items[2:]]):
            matchers = [decontamination.Matcher([b], window) for b in blocks]
            spans, ids = decontamination._find(matchers, words)
            assert ({p for a, b in spans for p in range(a, b)}, ids) == want


@pytest.fixture(scope="module")
def leaks(spark):
    item = "one two three four five six seven eight nine ten eleven twelve"
    bench = [(1, item), (2, "Tiny Item"), (3, None), (4, "..."), (None, "nameless benchmark words"), (1, item)]
    docs = [
        (1, f"Before it. {item.upper()}! and much more text stays here after all of that, as it is clean.", 0),
        (2, "one two three four five six seven eight nine", 0),
        (3, "a tiny, item; here and other words", 0), (4, None, None), (5, "", 0), (6, item, 0),
        (7, "the nameless benchmark words are in this long enough text", 0), (None, "tiny item", 0), (1, "again", 0),
    ]
    return (
        spark.createDataFrame(docs, "doc_id bigint, text string, n_chars bigint").withColumn("spans", F.lit(1)),
        spark.createDataFrame(bench, "item_id bigint, text string").withColumn("doc_id", F.lit(1)),
    )


@pytest.mark.parametrize("block_words", [3, 1000])
def test_overlaps(leaks, block_words):
    docs, bench = leaks
    found = decontamination.find_overlaps(docs, bench, block_words=block_words).collect()
    got = {(r.doc_id, r.n_words): (r.n_hit, r.item_ids) for r in found}
    assert got[1, 28] == (12, ["1"]) and got[1, 1] == (0, []) and got[2, 9] == (0, [])
    assert got[3, 7] == (2, ["2"]) and got[4, 0] == got[5, 0] == (0, [])
    assert got[6, 12] == (12, ["1"]) and got[7, 10] == (3, []) and got[None, 2] == (2, ["2"])
    assert len(found) == docs.count()


def test_decontaminated_texts(leaks):
    docs, bench = leaks
    kept = decontamination.decontaminate(docs, bench)
    assert kept.columns == docs.columns
    got = {(r.doc_id, r.text): r.n_chars for r in kept.collect()}
    text = "Before it. ! and much more text stays here after all of that, as it is clean."
    assert got[1, text] == len(text) and (6, None) not in got and not any(d == 6 for d, _ in got)
    assert (2, "one two three four five six seven eight nine") in got and (4, None) in got
    assert decontamination.decontaminate(docs.limit(0), bench).count() == 0
    assert decontamination.decontaminate(docs, bench.limit(0)).count() == docs.count()


# --- near duplicates --------------------------------------------------------------------


def _union(codes, max_bits=3):
    parent = list(range(len(codes)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(codes)):
        for j in np.flatnonzero(np.bitwise_count(codes[i] ^ codes[i + 1 :]) <= max_bits):
            a, b = root(i), root(i + 1 + j)
            parent[max(a, b)] = min(a, b)
    return [root(i) for i in range(len(codes))]


def _near(rng, n):
    codes = rng.integers(0, 2**63, size=5, dtype=np.uint64)[rng.integers(0, 5, size=n)]
    for _ in range(rng.integers(1, 7)):
        codes = codes ^ (np.uint64(1) << rng.integers(0, 64, size=n).astype(np.uint64))
    return codes


def test_index_against_brute_force():
    rng = np.random.default_rng(0)
    for _ in range(40):
        codes = np.unique(_near(rng, rng.integers(1, 250)))
        groups = np.sort(rng.integers(0, 3, size=len(codes)))
        order = np.lexsort((simhash.gray_rank(codes), groups))
        codes = codes[order]
        root = simhash.group_links(codes, groups)
        for g in set(groups.tolist()):
            at = np.flatnonzero(groups == g)
            assert [int(x) for x in root[at]] == [int(at[x]) for x in _union(codes[at])]


@pytest.mark.parametrize("hot", [3, 20_000])
def test_components_against_brute_force(spark, hot):
    codes = np.unique(_near(np.random.default_rng(7), 300))
    table = spark.createDataFrame([(int(c),) for c in codes.view(np.int64)], "code bigint")
    found = simhash.components(simhash.link_fingerprints(table, hot=hot)).collect()
    got = {r.node: r.component for r in found}
    signed = codes.view(np.int64).tolist()
    classes: dict = {}
    for code, root in zip(signed, _union(codes)):
        classes.setdefault(root, set()).add(code)
    assert {frozenset(c) for c in classes.values()} == {
        frozenset(x for x in signed if got.get(x, x) == r) for r in {got.get(x, x) for x in signed}
    }


def _fingerprint(text):
    words = [w.lower() for w in re.findall(r"[^\x20\x09-\x0D]+", text or "")]
    grams = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    counts = [0] * 64
    for g in grams:
        h = xxhash.xxh64_intdigest(g.encode(), 42)
        for b in range(64):
            counts[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * counts[b] > len(grams))


def test_near_duplicates_and_odd_rows(spark):
    body = " ".join(f"word{i}" for i in range(300))
    rows = [
        (5, body), (3, body.upper()), (9, f"{body} end"), (4, "one two"), (8, "ONE\ttwo"), (1, None), (2, " \n"),
        (7, ""), (6, "something else altogether in these words"), (6, "something else altogether in these words"),
        (None, "something else altogether in these words"), (None, "no id at all here"),
    ]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("component_id", F.lit(1))
    found = simhash.near_duplicates(docs).collect()
    assert len(found) == len(rows)
    prints = {t: _fingerprint(t) for _, t in rows}
    assert {r.fingerprint for r in found} == {f"{v:016x}" for v in prints.values()}
    got = {r.doc_id: r.component_id for r in found if r.doc_id is not None}
    assert got == {5: 3, 3: 3, 9: 3, 4: 4, 8: 4, 1: 1, 2: 1, 7: 1, 6: 6}
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    # a row without an id goes if any row of its component has one
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "3", "4", "6", "None"]
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


def test_one_row_stays_of_each_component_whatever_the_ids(spark):
    a, b, c, d = (" ".join(f"{x}{i}" for i in range(60)) for x in "abcd")
    rows = [
        (1, a), (2, a), (2, b), (3, b), (3, c), (4, c), (4, c), (2, c),  # an id with several texts
        (5, d), (5, "one more text that is like no other"),
        (None, "nobody named this text"), (None, "nobody NAMED this text"), (None, "nor this one here"),
    ]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    expected = {(1, a), (2, b), (2, c), (5, d), (5, rows[9][1]), (None, "nor this one here")}
    for parts in (1, 3):
        kept = [(r.doc_id, r.text) for r in simhash.keep_one(docs.repartition(parts)).collect()]
        unnamed = [t.lower() for i, t in kept if i is None]
        assert sorted(unnamed) == ["nobody named this text", "nor this one here"]
        assert len(kept) == 7 and expected <= set(kept)


# --- neighbours -------------------------------------------------------------------------


def test_neighbours_recall_ties_and_odd_vectors(spark):
    rng = np.random.default_rng(3)
    centers = rng.normal(size=(8, 16))
    vectors = (centers[rng.integers(0, 8, 900)] + rng.normal(size=(900, 16)) * 0.6).astype(np.float32)
    vectors[100:160] = vectors[100]  # copies
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vectors)]
    odd = [(1000, None), (1020, [0.0] * 16), (1040, [float("nan")] * 16), (1060, [1.0]), (1080, [None] * 16)]
    table = spark.createDataFrame(rows + odd + [rows[20], (None, rows[3][1])], "vec_id bigint, embedding array<float>")
    found = nearest.nearest(table, table.where("vec_id % 20 = 0"), k=20, shard_rows=300).collect()
    exact = vectors.astype(float)
    hit = total = 0
    for q in range(0, 900, 20):
        mine = sorted((r for r in found if r.query_id == q), key=lambda r: r.rank)
        assert [r.rank for r in mine] == list(range(1, 21))
        scores = exact @ exact[q]
        assert all(r.score == pytest.approx(scores[r.vec_id], abs=1e-9) for r in mine)
        assert [(-r.score, r.vec_id) for r in mine] == sorted((-r.score, r.vec_id) for r in mine)
        order = [i for i in np.lexsort((np.arange(900), -scores)) if i != q][:20]
        hit += len(set(order) & {r.vec_id for r in mine})
        total += 20
    assert {r.query_id for r in found} == set(range(0, 900, 20))
    assert hit / total >= 0.9


@pytest.mark.parametrize("kind", ["one long", "large", "small", "mixed"])
def test_neighbours_of_any_length(spark, kind):
    rng = np.random.default_rng(11)
    vectors = rng.normal(size=(600, 16))
    vectors *= {
        "one long": np.where(np.arange(600) == 7, 1e4, 1.0), "large": np.full(600, 1e150), "small": np.full(600, 1e-150),
        "mixed": 10.0 ** rng.integers(-20, 20, 600),
    }[kind][:, None]
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id bigint, embedding array<double>")
    found = nearest.nearest(table, table.where("vec_id % 20 = 0"), shard_rows=200).collect()
    hit = 0
    for q in range(0, 600, 20):
        mine = sorted((r for r in found if r.query_id == q), key=lambda r: r["rank"])
        scores = vectors @ vectors[q]
        order = [i for i in np.lexsort((np.arange(600), -scores)) if i != q][:20]
        assert len(mine) == 20 and all(r.score == pytest.approx(scores[r.vec_id], rel=1e-9) for r in mine)
        hit += len(set(order) & {r.vec_id for r in mine})
    assert hit / 600 >= 0.9


def test_fewer_candidates_than_asked_for(spark):
    table = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 1.0])], "vec_id bigint, embedding array<double>")
    found = nearest.nearest(table, table.where("vec_id = 0")).collect()
    assert [(r.query_id, r["rank"], r.vec_id, r.score) for r in found] == [(0, 1, 1, 0.5)]
    assert nearest.nearest(table.limit(0), table).count() == 0
    assert nearest.nearest(table, table.limit(0)).count() == 0


# --- queries and pipeline ---------------------------------------------------------------


@needs_tables
@pytest.mark.parametrize("name", list(queries.ORACLES))
def test_query_equals_statement(name, spark):
    duck = duckdb.connect()
    for table in ("documents", "pages", "benchmark", "conversations"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    result, relation = queries.QUERIES[name](spark, SF_DIR), duck.sql(queries.ORACLES[name])
    columns = sorted(result.columns)
    assert columns == sorted(relation.columns)
    ours = sorted(repr(tuple(r[c] for c in columns)) for r in result.collect())
    theirs = relation.select(", ".join(columns)).fetchall()
    assert ours == sorted(map(repr, theirs))


def test_every_query_is_registered():
    assert set(queries.QUERIES) | {"pipeline"} <= set(entry.queries())


@needs_tables
def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").withColumn("text_copy", F.lit(1))
    bench = [r.text for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    items = [(str(i), decontamination.words_of(t)) for i, t in enumerate(bench)]
    kept = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, kept, SF_DIR)
        assert after.columns == docs.columns and after.count() <= kept.count()
        kept = pin(after)
    texts = {r.doc_id: r.text for r in kept.collect()}
    for text in texts.values():
        assert not _hits(items, decontamination.words_of(text), 10)[0]
    # near duplicates: one of each group of what had a language
    first = corpus_pipeline.identify_language(spark, docs, SF_DIR)
    rows = sorted((r.doc_id, r.text) for r in first.collect())
    roots = _union(np.array([_fingerprint(t) for _, t in rows], np.uint64))
    assert set(texts) <= {rows[r][0] for r in roots}
    packed = corpus_pipeline.run(spark, SF_DIR).collect()
    assert {r.doc_id for r in packed} == set(texts)
    assert max(r.offset + r.length for r in packed) <= 2048
