"""Prefix trie, fill-in-the-middle and line dedup, against plain Python."""

from __future__ import annotations

import hashlib
import os
import random
import re
import zlib
from collections import defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from auditweave.llm import fill_in_middle, line_dedup, prefix_trie, queries

SF_DIR = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="sample tables not here")


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


# --- trie -------------------------------------------------------------------------------

TURNS = "conv_id bigint, turn bigint, role string, text string"


def _rebuilt(rows, heads: bool):
    """Sequences of (role, text) by conversation."""
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    # ties are told apart by a digest, so tests give them equal contents or other roles
    own = {c: [(r, t) for _, _, r, t in sorted(v)] for c, v in own.items()}
    if not heads:
        return own
    made = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (c % 20 if c >= 0 else -(-c % 20))
        made[c] = own.get(base, [])[:h] + turns[h:]
    return made


def _trie(sequences):
    members = defaultdict(list)
    for c, turns in sequences.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        words = len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        below = children[node]
        leaves[node] = sum(leaves[x] for x in below) if below else 1
        saved[node] = (len(members[node]) - 1) * words + sum(saved[x] for x in below)
    return sorted(
        (
            min(m), len(node), min(members[node[:-1]]) if node else None, len(m), len(children[node]),
            leaves[node], saved[node],
            _sha(",".join(str(c) for c in sorted(m) if len(sequences[c]) == len(node))),
        )
        for node, m in members.items()
    )


def _found(table, *how):
    names = "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256".split()
    return sorted(tuple(r[n] for n in names) for r in prefix_trie.build(table, *how).collect())


@pytest.mark.parametrize("heads", [False, True])
def test_trie_against_brute_force(many_ranges, heads):
    rnd = random.Random(3)
    rows = []
    for c in [*range(-3, 45), 60, 200, 10**12, 10**12 + 5]:
        n = rnd.choice([1, 1, 2, 3, 5, 8, 9, 16, 17, 40])
        rows += [(c, t, rnd.choice(["user", "bot"]), rnd.choice(["a b", "a", "c d e"])) for t in range(n)]
    # copies of a long conversation, a hot first turn, a copy that goes on
    long = [(t, "user", f"turn {t % 5} of many") for t in range(60)]
    rows += [(c, *x) for c in range(300, 312) for x in long]
    rows += [(312, *x) for x in [*long, (60, "user", "and on")]]
    rows += [(c, 0, "system", "be nice") for c in range(400, 430)]
    table = many_ranges.createDataFrame(rows, TURNS).repartition(5)
    how = [prefix_trie.shared_heads] if heads else []
    assert _found(table, *how) == _trie(_rebuilt(rows, heads))


def test_trie_of_odd_rows(spark):
    rows = [
        (7, None, "user", "first"), (7, 3, None, None), (7, 3, "bot", ""), (7, 3, "bot", ""),  # ties, repeated
        (8, None, "user", "first"), (8, 9, "", None), (9, 1, "", ""), (None, 1, "user", "nobody's"),
        (21, 1, "user", "x" * 300_000), (22, 1, "user", "  \t\n"), (23, 5, "user", "é   \U0001f600"),
    ]
    more = [F.lit("x").alias("depth"), F.lit(1).alias("TURN"), F.lit(2).alias("item")]
    table = spark.createDataFrame(rows, TURNS).select("*", *more)
    assert _found(table) == _trie(_rebuilt(rows, False))
    assert _found(table, prefix_trie.shared_heads) == _trie(_rebuilt(rows, True))
    empty = spark.createDataFrame([], TURNS)
    assert _found(empty) == [] and _found(empty, prefix_trie.shared_heads) == []


def test_conversations_left_without_turns_are_members_of_the_root(spark):
    # 3 and 9 take their head from conversation 0, which is not there
    bare = [c for c in range(1, 20) if zlib.crc32(str(c).encode()) % 4 == 3]
    rows = [(c, 0, "user", "hello there") for c in bare] + [(25, 0, "user", "a b")]
    table = spark.createDataFrame(rows, TURNS)
    assert _found(table, prefix_trie.shared_heads) == _trie(_rebuilt(rows, True))
    assert any(n == 0 for n in map(len, _rebuilt(rows, True).values()))


def test_chunks_of_equal_conversations(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "CHUNK", 3)
    rows = [(c, 0, "user", "same") for c in range(50)]
    assert _found(spark.createDataFrame(rows, TURNS)) == _trie(_rebuilt(rows, False))


# --- fill in the middle -----------------------------------------------------------------


def _middle(doc_id, text, rate=100, spm=50, seed=7):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    hexed = _sha(f"{seed}:{'' if doc_id is None else doc_id}")
    h1, h2, h3, h4 = (int(hexed[i : i + 8], 16) for i in (0, 8, 16, 24))
    a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    prefix, middle, suffix = ("".join(units[i:j]) for i, j in ((0, a), (a, b), (b, None)))
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h3 % 100 >= rate:
        return doc_id, len(units), "plain", None, None, text
    if h4 % 100 < spm:
        return doc_id, len(units), "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return doc_id, len(units), "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


ODD_TEXTS = [
    None, "", "\n", "\n\n\n", "one", "one\n", "a\nb\nc", "\r\n\r\nx\r", "$1 \\n ${name} \\\n$2\n\\", "<P", "<S\n>",
    "a<P>b\nc", "x\n<M>", "<\nS>\n<P\n>", "é́\n\U0001f600\U0001f600\nzz y\u0085\nw", "(?s)\n[a-z]{3}+\n\\Qx\\E",
    "line\n" * 30_000, "word " * 60_000, ("\n" * 5 + "x" * 50) * 2000,
]


@pytest.mark.parametrize("rate, spm, seed", [(100, 50, 7), (60, 0, 1), (100, 100, 2), (0, 50, 3)])
def test_middles_against_brute_force_and_round_trip(spark, rate, spm, seed):
    rnd = random.Random(seed)
    rows = [(i, t) for i, t in enumerate(ODD_TEXTS * 2)] + [(None, "a\nb"), (3, "a\nb\nc"), (3, "a\nb\nc")]
    rows += [(1000 + i, "".join(rnd.choice("ab \n<>PSM") for _ in range(rnd.randint(0, 40)))) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumns({"n": F.lit("x"), "form": F.lit(1)})
    made = fill_in_middle.transform(docs, rate, spm, seed)
    back = fill_in_middle.restored(F.col("output"), F.col("form"))
    got = [tuple(r) for r in made.withColumn("back", back).collect()]
    assert sorted(map(repr, (r[:6] for r in got))) == sorted(repr(_middle(*r, rate, spm, seed)) for r in rows)
    assert sorted((str(r[0]), r[6]) for r in got) == sorted((str(i), t or "") for i, t in rows)


def test_middles_of_an_empty_table_and_the_plan(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    made = fill_in_middle.transform(docs)
    assert made.collect() == []
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan


# --- lines ------------------------------------------------------------------------------


def _kept(rows, min_chars, min_docs):
    def key(line):
        line = line.strip(" \t\n\v\f\r")
        return re.sub("[A-Z]+", lambda m: m.group().lower(), line)

    docs = defaultdict(set)
    for doc_id, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= min_chars:
                docs[key(line)].add(doc_id)
    keeper = {
        k: max((d for d in ids if d is not None), default=None)
        for k, ids in docs.items() if len(ids) >= min_docs
    }
    found = []
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        stay = [x for x in lines if key(x) not in keeper or keeper[key(x)] == doc_id]
        found.append((doc_id, len(lines), len(lines) - len(stay), "\n".join(stay)))
    return sorted(map(repr, found))


def _ours(docs, min_chars, min_docs):
    maps = line_dedup.keep_bitmaps(docs, min_chars, min_docs)
    rows = line_dedup.apply(docs, maps).collect()
    assert all(r.kept_sha256 == _sha(r.kept) for r in rows)
    return sorted(repr((r.doc_id, r.n_lines, r.n_dropped, r.kept)) for r in rows)


@pytest.mark.parametrize("seed", range(4))
def test_lines_against_brute_force(many_ranges, seed):
    rnd = random.Random(seed)
    lines = [f"{'ab' * rnd.randint(1, 4)}{i}" for i in range(12)] + ["", "  ", "É" * 5, "é" * 5, "\ta b c d e \r"]
    rows = [
        (rnd.choice([None, *range(60)]), "\n".join(rnd.choice(lines).upper() if rnd.random() < 0.2
         else " " * rnd.randint(0, 2) + rnd.choice(lines) for _ in range(rnd.randint(0, 9))))
        for _ in range(150)
    ]
    # one line in every document, often twice
    rows += [(i, "the very same line\n" * rnd.randint(1, 3) + f"own {i} {'x' * 9}") for i in range(100, 400)]
    rows += rows[:5]
    many_ranges.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rnd.choice([1, 7, 1000])))
    try:
        docs = many_ranges.createDataFrame(rows, "doc_id bigint, text string").repartition(6)
        for min_chars, min_docs in ((5, 5), (1, 2), (8, 3), (5, 1)):
            assert _ours(docs, min_chars, min_docs) == _kept(rows, min_chars, min_docs)
    finally:
        many_ranges.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_lines_of_odd_tables(spark):
    common = "this line is common to all of these documents here"
    rows = [(None, None), (None, common), (1, ""), (2, f"{common}\n{common}"), (2, common), (3, f"x\n  {common.upper()}\t\n")]
    rows += [(4, common), (5, "\n" * 2000 + common), (5, "é" * 100_000), (6, f"{common}\r\ny")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumns({"keep": F.lit(1), "pos": F.lit("p")})
    assert _ours(docs, 40, 5) == _kept(rows, 40, 5)
    named = spark.createDataFrame([(str(i or ""), t) for i, t in rows], "doc_id string, text string")
    assert len(_ours(named, 40, 5)) == len(rows)
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    assert line_dedup.keep_bitmaps(empty).count() == 0 and _ours(empty, 40, 5) == []


def test_texts_are_not_shuffled_for_the_bitmaps(spark):
    docs = spark.createDataFrame([(1, "x")], "doc_id bigint, text string")
    fields = line_dedup.line_rows(docs).schema.names
    assert fields == ["doc_id", "text_hash", "text_bytes", "pos", "h1", "h2"]


# --- queries ----------------------------------------------------------------------------


@needs_tables
@pytest.mark.parametrize("name", ["op11_prefix_trie", "op12_fill_in_middle", "op13_line_dedup"])
def test_new_query_equals_statement(name, spark):
    duck = duckdb.connect()
    for table in ("documents", "conversations"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    result, relation = queries.QUERIES[name](spark, SF_DIR), duck.sql(queries.ORACLES[name])
    columns = sorted(result.columns)
    assert columns == sorted(relation.columns)
    ours = sorted(repr(tuple(r[c] for c in columns)) for r in result.collect())
    assert ours == sorted(map(repr, relation.select(", ".join(columns)).fetchall()))
