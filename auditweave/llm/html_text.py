"""Main text of web pages, with suffix arrays per host against boilerplate.

A page becomes blocks of text with their place in the markup: those in a container that names
the article, and doubtful ones, which are everything else outside of menus, headers, footers,
forms and the like. The pages of a host are compared, the articles with each other and the
doubtful blocks with each other: the blocks are laid in a row as one stream of tokens, a suffix
array of the stream finds the long runs of tokens that distinct pages share, and blocks covered
by such runs repeat. Repeated doubtful blocks are boilerplate; what is left, the unique runs, is
the text of a page that names no article. A check follows for articles: their markup says that
the repeated blocks belong to them too, so they are marked and stay.

A host with very many pages is split into parts of a bounded size, each with a suffix array of
its own. A run that a share of the host's pages holds is held by that share of the pages of one
part at least, so each part names the few runs of which that is true, all parts count the runs
named, and the sums are those of the whole host: what repeats does not depend on the parts.
Pages with equal blocks count once: copies of a page do not make its text boilerplate.
"""

from __future__ import annotations

import hashlib
import html
import re
import zlib
from collections import Counter
from urllib.parse import urlsplit

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auditweave.llm.common import pick
from auditweave.sources.shelf import pin

#: Tokens of a run that counts as repeated; shorter blocks count if they repeat whole.
RUN = 12
#: Distinct pages that make a run boilerplate: so many, and this share of the host's.
PAGES = 3
SHARE = 0.05
#: Share of a block's tokens in such runs that makes the block boilerplate.
COVERED = 0.8
#: Distinct pages of a host that share a suffix array, on average at most, and their characters.
PART_PAGES = 2_000
PART_CHARS = 4_000_000
#: Contents that a task remembers, so that it sends copies of a page once.
SEEN = 100_000

#: Elements by what they mean for the text.
_SKIPPED = frozenset(
    "script style noscript template svg math iframe object embed canvas audio video select "
    "textarea button head title form".split()
)
_APART = frozenset("nav header footer aside menu dialog".split())
_RAW = frozenset(("script", "style", "textarea", "title", "noscript", "iframe", "template"))
_MAIN = frozenset(("article", "main"))
_BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu "
    "nav ol option p pre section summary table tbody td tfoot th thead tr ul".split()
)
_VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
#: Elements that end where another of their kind begins, or their parent ends.
_LOOSE = frozenset("p li dt dd tr td th option".split())
#: Whole words of class or id that name what stands beside an article.
_NAMES = frozenset(
    "ad ads adsbygoogle advert advertisement advertising adverts banner breadcrumb breadcrumbs "
    "consent cookie cookies footer login menu modal nav navbar navigation newsletter notice notices "
    "pagination popup promo promoted promotion related share sharing sidebar signup skip-link "
    "social sponsor sponsored subscribe toolbar widget widgets".split()
)
#: Compound words that do, part by part.
_COMPOUND = re.compile(
    r"(?:site|global|top|bottom|left|right|primary|secondary|mobile|sticky|main)-"
    r"(?:nav|navbar|navigation|menu|header|footer|sidebar|banner|toolbar)"
    r"|(?:cookies?|gdpr|consent|privacy)-(?:banner|notice|bar|popup|message|consent)"
    r"|(?:share|social|sharing)-(?:bar|buttons?|links?|icons?|media)"
    r"|(?:related|recommended)-(?:posts?|articles?|links?|stories|content)"
    r"|(?:ads?|advert|advertisement|sponsor|promo)-(?:banner|box|slot|container|unit|wrapper|block)"
    r"|(?:newsletter|signup|subscribe|login|search)-(?:form|box|block)"
    r"|(?:nav|menu|sidebar|footer|breadcrumbs?|pagination)-(?:menu|links?|list|area|wrapper|inner)"
    r"|widget-area|post-navigation"
)
_COMMENTS = re.compile(
    r"comments?(?:-?(?:list|area|section|form|thread|wrapper|container|body|respond|reply))?"
    r"|disqus(?:-thread)?|replies|respond"
)
#: Names of a header, which belongs to the article if it is inside.
_HEADERS = frozenset(("header", "masthead"))
_ROLES = frozenset(
    "navigation banner contentinfo complementary search dialog menu form alert".split()
)

# a quote only opens a value behind an equals sign; nothing is ever tried twice
_TAG = re.compile(
    r"<!--.*?(?:-->|$)|<![^>]*>|<\?[^>]*>"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:=\s*+\"[^\"]*+\"|=\s*+'[^']*+'|[^<>])*+)>",
    re.DOTALL,
)
_ATTR = re.compile(
    r"([a-zA-Z][\w:-]*)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\">]+)))?", re.DOTALL
)
_SPACE = re.compile(r"\s+")


def _attributes(text: str) -> dict[str, str]:
    return {name.lower(): a or b or c for name, a, b, c in _ATTR.findall(text)} if text else {}


def _reason(tag: str, given: dict[str, str], main: bool) -> str:
    """Why the element holds something beside the article; empty if it does not.

    "named" is a name for something of the layout, which an article inside overrules.
    """
    if "hidden" in given or given.get("aria-hidden", "").lower() == "true":
        return "hidden"
    if tag in _APART and not (main and tag == "header"):
        return "apart"
    if tag in ("html", "body"):
        return ""
    words = f"{given.get('class', '')} {given.get('id', '')}".lower().replace("_", "-").split()
    if any(_COMMENTS.fullmatch(w) for w in words):
        # an article that is one of the readers' comments says so with that very word
        return "comments" if tag not in _MAIN or "comment" in words or "comment-body" in words else ""
    if tag in _MAIN:
        return ""
    if any(w in _NAMES or _COMPOUND.fullmatch(w) for w in words):
        return "named"
    if not main and any(w in _HEADERS for w in words):
        return "named"
    return "named" if given.get("role", "").lower() in _ROLES else ""


def blocks(page: str) -> list[tuple[bool, str]]:
    """(whether in the article, text) of the blocks of ``page``, without what stands apart."""
    out: list[tuple[bool, str]] = []
    held: list[str] = []
    # open elements: tag, why text below is left out if so, whether it is in the article
    stack: list[tuple[str, str | bool, bool]] = [("", False, False)]
    opened: Counter = Counter()

    def close_from(i):
        opened.subtract(x[0] for x in stack[i:])
        del stack[i:]

    def flush():
        if held:
            text = _SPACE.sub(" ", html.unescape("".join(held))).strip()
            held.clear()
            if text:
                out.append((stack[-1][2], text))

    at, size = 0, len(page)
    while at < size:
        found = _TAG.search(page, at)
        begin = found.start() if found else size
        if begin > at and not stack[-1][1]:
            held.append(page[at:begin])
        if not found:
            break
        at = found.end()
        tag = found[2]
        if tag is None:
            continue
        tag = tag.lower()
        closes, attributes = found[1], found[3]
        if not closes and tag in _RAW:
            # its content is no markup: go to its end tag, or to the end of the page
            end = re.compile(f"</{tag}\\s*>", re.IGNORECASE).search(page, at)
            if end:
                at = end.end()
            elif tag in ("script", "style"):
                at = size
            continue
        if tag == "br" and not stack[-1][1]:
            held.append(" ")
        if tag in _BLOCK:
            flush()
        if tag == "body" and not closes:
            close_from(1)  # a head without an end
        if closes:
            if not opened[tag]:
                continue
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] == tag:
                    flush()
                    close_from(i)
                    break
                # a wrong end tag does not close what is around it
                if stack[i][0] in _MAIN or stack[i][0] in _APART or stack[i][0] in ("body", "td"):
                    if tag not in _MAIN and tag not in ("body", "html") and tag not in _APART:
                        break
        elif tag not in _VOID and not attributes.endswith("/"):
            if tag in _LOOSE and opened[tag]:
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i][0] == tag:
                        close_from(i)
                        break
                    if stack[i][0] in _BLOCK and stack[i][0] not in _LOOSE:
                        break
            _, skip, main = stack[-1]
            given = _attributes(attributes)
            names_main = tag in _MAIN or given.get("role", "").lower() == "main"
            if names_main and skip in ("form", "named"):
                # a form or a layout's name around the whole page
                skip = False
            reason = tag if tag in _SKIPPED else _reason(tag, given, main)
            if reason and (not skip or skip in ("form", "named")):
                skip = reason
            stack.append((tag, skip, names_main or main))
            opened[tag] += 1
    flush()
    return out


def host_of(url: str | None) -> str:
    try:
        return (urlsplit(url or "").hostname or "").lower()
    except ValueError:
        return ""


def run_groups(tokens: np.ndarray, block: np.ndarray, run: int) -> tuple[np.ndarray, np.ndarray]:
    """The places where whole runs of ``run`` tokens begin, and a number for each that is equal
    where the runs are; runs do not reach over two blocks.

    The suffix array is sorted by prefixes of doubling length up to ``run``: the rank of a
    suffix among those, equal where the prefixes are equal.
    """
    n = len(tokens)
    if n < run:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    edge = np.flatnonzero(block[1:] != block[:-1]) + 1
    left = np.append(edge, n)[np.searchsorted(edge, np.arange(n), side="right")]
    rank = np.unique(tokens, return_inverse=True)[1].astype(np.int64)
    length = 1
    while length < run:
        step = min(length, run - length)
        ahead = np.arange(n) + step
        second = np.where(ahead < left, rank[np.minimum(ahead, n - 1)] + 1, 0)
        both = rank * (n + 1) + second
        rank = np.unique(both, return_inverse=True)[1]
        length += step
    place = np.flatnonzero(np.arange(n) + run <= left)
    return place, rank[place]


def group_pages(group: np.ndarray, page: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The groups, for each an index where it occurs, and the number of its distinct pages."""
    order = np.lexsort((page, group))
    g, p = group[order], page[order]
    first = np.append(True, g[1:] != g[:-1]) if len(g) else np.empty(0, bool)
    new_page = first | np.append(True, p[1:] != p[:-1]) if len(g) else first
    counts = np.bincount(np.cumsum(first) - 1, new_page).astype(np.int64) if len(g) else g
    return g[first], order[first], counts


def covered_by(places: np.ndarray, length: np.ndarray | int, n: int) -> np.ndarray:
    """Which of ``n`` tokens lie in a run that begins at one of ``places``."""
    marks = np.zeros(n + 1, np.int64)
    np.add.at(marks, places, 1)
    np.add.at(marks, np.minimum(places + length, n), -1)
    return np.cumsum(marks[:-1]) > 0


def repeated(
    tokens: np.ndarray, owner: np.ndarray, run: int, pages: int, block: np.ndarray | None = None
) -> np.ndarray:
    """Which tokens lie in a run of ``run`` tokens that at least ``pages`` owners have.

    ``owner`` says to which page a token belongs, ``block`` to which block (by default a page
    is one block); runs do not reach over two blocks.
    """
    place, group = run_groups(tokens, owner if block is None else block, run)
    if not len(place):
        return np.zeros(len(tokens), bool)
    groups, _, counts = group_pages(group, owner[place])
    shared = np.isin(group, groups[counts >= pages])
    return covered_by(place[shared], run, len(tokens))


_PRIME = np.uint64(0x9E3779B97F4A7C15)


class Stream:
    """The blocks of some pages of a host as one stream of tokens, and its runs.

    A block shorter than a run is one run of its own length. Keys tell the runs of all parts
    of a host apart: two 64-bit sums over their tokens and length.
    """

    def __init__(self, pages: list[list[str]], run: int):
        import xxhash

        self.pages = len(pages)
        texts = [text for blocks_ in pages for text in blocks_]
        of_page = np.repeat(np.arange(len(pages)), np.array([len(b) for b in pages], np.int64))
        known: dict[str, int] = {}
        sizes, flat = [], []
        for text in texts:
            words = text.split(" ")
            sizes.append(len(words))
            for w in words:
                if w not in known:
                    known[w] = xxhash.xxh3_64_intdigest(w.encode("utf-8", "replace"))
            flat.append(np.fromiter(map(known.__getitem__, words), np.uint64, len(words)))
        self.sizes = np.array(sizes, np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.tokens = np.concatenate(flat) if flat else np.empty(0, np.uint64)
        self.of_page = of_page.astype(np.int64)
        self.run = run
        self.block = np.repeat(np.arange(len(sizes)), self.sizes)
        self.short = np.flatnonzero(self.sizes < run)

    def _keys(self, places: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        out = np.zeros((len(places), 2), np.uint64)
        out[:, 0] = lengths.astype(np.uint64)
        power = np.uint64(1)
        with np.errstate(over="ignore"):
            for j in range(int(lengths.max()) if len(lengths) else 0):
                some = lengths > j
                token = self.tokens[places[some] + j]
                out[some, 0] = out[some, 0] * _PRIME + token
                power = power * _PRIME
                out[some, 1] += (token ^ (token >> np.uint64(29))) * power
        return out.view(np.int64)

    def counts(self, least: int) -> tuple[np.ndarray, np.ndarray]:
        """The keys of each distinct run that ``least`` pages here hold, and their number."""
        place, group = run_groups(self.tokens, self.block, self.run)
        places = np.concatenate([place, self.starts[self.short]])
        lengths = np.concatenate([np.full(len(place), self.run), self.sizes[self.short]])
        # equal runs have equal keys: the suffix array's groups, then the short blocks by key
        keys = self._keys(places[len(place) :], lengths[len(place) :])
        lone = np.unique(keys, axis=0, return_inverse=True)[1].ravel()
        base = group.max() + 1 if len(group) else 0
        group = np.concatenate([group, lone + base]).astype(np.int64)
        _, at, counts = group_pages(group, self.of_page[self.block[places]])
        some = counts >= least
        return self._keys(places[at[some]], lengths[at[some]]), counts[some]

    def _found(self, wanted: set[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Where wanted runs begin, their lengths and keys; these were named by suffix arrays."""
        left = (self.starts + self.sizes)[self.block] - np.arange(len(self.tokens))
        place = np.flatnonzero(left >= self.run)
        places = np.concatenate([place, self.starts[self.short]])
        lengths = np.concatenate([np.full(len(place), self.run), self.sizes[self.short]])
        keys = self._keys(places, lengths)
        near = np.flatnonzero(np.isin(keys[:, 0], np.array([k for k, _ in wanted], np.int64)))
        right = near[[tuple(k) in wanted for k in keys[near].tolist()]] if len(near) else near
        return places[right], lengths[right], keys[right]

    def counts_of(self, wanted: set[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
        """The keys of the wanted runs that are here, and the number of pages that hold each."""
        places, _, keys = self._found(wanted)
        group = np.unique(keys, axis=0, return_inverse=True)[1].ravel()
        _, at, counts = group_pages(group, self.of_page[self.block[places]])
        return keys[at], counts

    def repeated(self, shared: set[tuple[int, int]], covered: float) -> list[list[int]]:
        """Each page's blocks, by number, that are covered by ``shared`` runs."""
        out: list[list[int]] = [[] for _ in range(self.pages)]
        if not shared or not len(self.starts):
            return out
        places, lengths, _ = self._found(shared)
        inside = covered_by(places, lengths, len(self.tokens))
        sums = np.add.reduceat(inside, self.starts, dtype=np.int64)
        first = np.searchsorted(self.of_page, np.arange(self.pages))
        for i in np.flatnonzero(sums >= covered * self.sizes).tolist():
            page = int(self.of_page[i])
            out[page].append(i - int(first[page]))
        return out


def _once(batches):
    """Copies that follow each other in a task are sent once: a few rows for a host's copies.

    Blocks, in which no line break occurs, are sent as one deflated text.
    """
    seen: set = set()
    for batch in batches:
        keys = zip(*(batch.column(c).to_pylist() for c in ("host", "inside", "content")))
        new = []
        for key in keys:
            new.append(key not in seen)
            seen.add(key)
        if len(seen) > SEEN:
            seen.clear()
        batch = batch.filter(pa.array(new, pa.bool_()))
        packed = [
            zlib.compress("\n".join(texts).encode("utf-8", "replace"), 1)
            for texts in batch.column("blocks").to_pylist()
        ]
        keys = [batch.column(c) for c in ("host", "inside", "content")]
        yield pa.RecordBatch.from_arrays(
            [*keys, pa.array(packed, pa.binary())], ["host", "inside", "content", "blocks"]
        )


def _texts(table: pa.Table) -> list[list[str]]:
    return [zlib.decompress(b).decode().split("\n") for b in table.column("blocks").to_pylist()]


def _distinct(table: pa.Table) -> pa.Table:
    """One row for each content."""
    first = dict(zip(reversed(table.column("content").to_pylist()), range(len(table) - 1, -1, -1)))
    return table.take(sorted(first.values())) if len(first) < len(table) else table


def _run_table(key: tuple[pa.Scalar, ...], keys: np.ndarray, counts: np.ndarray) -> pa.Table:
    host, inside, part = (k.as_py() for k in key)
    n = len(keys)
    return pa.table(
        {
            "host": pa.array([host] * n, pa.string()),
            "inside": pa.array([inside] * n, pa.bool_()),
            "part": pa.array([part] * n, pa.int64()),
            "k1": pa.array(np.ascontiguousarray(keys[:, 0])),
            "k2": pa.array(np.ascontiguousarray(keys[:, 1])),
            "pages": pa.array(counts, pa.int64()),
        }
    )


def _pairs(table: pa.Table) -> set[tuple[int, int]]:
    return set(zip(table.column("k1").to_pylist(), table.column("k2").to_pylist()))


def _digest(texts: list[str]) -> bytes:
    """Of the blocks, in which no line break occurs."""
    return hashlib.blake2b("\n".join(texts).encode("utf-8", "replace"), digest_size=16).digest()


def extract(
    pages: DataFrame,
    run: int = RUN,
    least: int = PAGES,
    part_pages: int = PART_PAGES,
    share: float = SHARE,
    covered: float = COVERED,
) -> DataFrame:
    """Per row of ``pages`` (page_id, url, html): page_id, url, text, n_chars, in_article, n_repeated.

    ``text`` holds the blocks of the article in page order, joined by an empty line, with
    character references decoded and white space inside a block made one space. If no element
    names the article, it holds the page's doubtful blocks that are not boilerplate of its host:
    those with less than ``covered`` of their tokens in runs that at least ``least`` pages of the
    host and ``share`` of them have, pages with equal doubtful blocks counted once. A block
    of fewer than ``run`` tokens is one run. ``n_repeated`` is the number of blocks that repeat by
    that measure, an article's among the host's articles: those of an article stay, others go.

    The text is empty if nothing is left, as for a null or empty html. Pages without a host are
    compared with each other. Repeated rows each give a row. ``part_pages`` changes no result.
    An empty table gives an empty result.
    """
    rows = pick(pages, "page_id", "url", "html")
    kind = rows.schema["page_id"].dataType.simpleString()

    def parse(batches):
        for batch in batches:
            hosts, article, doubtful = [], [], []
            for url, page in zip(batch.column(1).to_pylist(), batch.column(2)):
                found = blocks(page.as_py() or "")
                hosts.append(host_of(url))
                article.append([t for inside, t in found if inside])
                doubtful.append([t for inside, t in found if not inside])
            digests = [
                pa.array([_digest(texts) for texts in side], pa.binary())
                for side in (article, doubtful)
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(hosts, pa.string()),
                    pa.array(article, pa.list_(pa.string())),
                    pa.array(doubtful, pa.list_(pa.string())),
                    *digests,
                ],
                ["page_id", "url", "host", "article", "doubtful", "article_is", "doubtful_is"],
            )

    parsed = rows.mapInArrow(
        parse,
        f"page_id {kind}, url string, host string, article array<string>, "
        "doubtful array<string>, article_is binary, doubtful_is binary",
    )
    parsed = pin(parsed, "parsed")

    # doubtful blocks beside articles show the host's boilerplate, if a page names no article
    hosts = parsed.where("size(article) = 0 AND size(doubtful) > 0").select("host").distinct()

    def side(name: str, inside: bool) -> DataFrame:
        return parsed.where(F.size(name) > 0).select(
            "host",
            F.lit(inside).alias("inside"),
            F.col(f"{name}_is").alias("content"),
            F.col(name).alias("blocks"),
        )

    contents = side("article", True).unionByName(
        side("doubtful", False).join(hosts, "host", "left_semi")
    )
    chars = F.aggregate("blocks", F.lit(0).cast("long"), lambda n, b: n + F.char_length(b))
    sizes = (
        contents.select("host", "inside", "content", chars.alias("chars"))
        .distinct()
        .groupBy("host", "inside")
        .agg(F.count("*").alias("n"), F.sum("chars").alias("chars"))
        .select(
            "host",
            "inside",
            F.ceil(F.greatest(F.col("n") / part_pages, F.col("chars") / PART_CHARS)).alias("parts"),
            F.greatest(F.lit(least), F.ceil(F.col("n") * share)).cast("long").alias("needed"),
            "n",
        )
    )
    sizes = pin(sizes, "sizes")
    dealt = (
        contents.mapInArrow(
            _once, "host string, inside boolean, content binary, blocks binary"
        )
        .join(sizes, ["host", "inside"])
        .withColumn("part", F.pmod(F.xxhash64("content"), "parts"))
    )
    place = ["host", "inside", "part"]
    run_schema = "host string, inside boolean, part bigint, k1 bigint, k2 bigint, pages bigint"

    def name(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        table = _distinct(table)
        needed, n = table.column("needed")[0].as_py(), table.column("n")[0].as_py()
        # of ``needed`` pages of ``n``, so many at least are here if no part has a greater share
        here = needed if table.column("parts")[0].as_py() == 1 else -(-needed * len(table) // n)
        found = Stream(_texts(table), run).counts(here)
        return _run_table(key, *found)

    wide = ["content", "blocks", "parts", "needed", "n"]
    named = pin(dealt.select(*place, *wide).groupBy(*place).applyInArrow(name, run_schema), "named")

    # what a part of several has named is counted in all of them
    split = sizes.where("parts > 1").withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    asked = (
        named.select("host", "inside", "k1", "k2")
        .distinct()
        .join(split.select(*place), ["host", "inside"])
    )

    def count(key: tuple[pa.Scalar, ...], left: pa.Table, right: pa.Table) -> pa.Table:
        wanted = _pairs(right)
        texts = _texts(_distinct(left)) if wanted else []
        return _run_table(key, *Stream(texts, run).counts_of(wanted))

    counted = (
        dealt.where("parts > 1")
        .select(*place, "content", "blocks")
        .groupBy(*place)
        .cogroup(asked.groupBy(*place))
        .applyInArrow(count, run_schema)
    )
    whole = named.join(sizes.where("parts = 1").select("host", "inside"), ["host", "inside"], "left_semi")
    totals = (
        pin(whole.unionByName(counted), "counted")
        .groupBy("host", "inside", "k1", "k2")
        .agg(F.sum("pages").alias("pages"))
        .join(sizes, ["host", "inside"])
        .where("pages >= needed")
    )
    shared = pin(totals.select("host", "inside", "parts", "k1", "k2"), "shared")
    known = shared.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))

    def mark(key: tuple[pa.Scalar, ...], left: pa.Table, right: pa.Table) -> pa.Table:
        left, wanted = _distinct(left), _pairs(right)
        found = [[]] * len(left)
        if wanted:
            found = Stream(_texts(left), run).repeated(wanted, covered)
        table = pa.table(
            {
                "host": left.column("host"),
                "inside": left.column("inside"),
                "content": left.column("content"),
                "repeated": pa.array(found, pa.list_(pa.int32())),
            }
        )
        return table.filter(pa.array([bool(f) for f in found], pa.bool_()))

    marked = (
        dealt.select(*place, "content", "blocks")
        .groupBy(*place)
        .cogroup(known.select(*place, "k1", "k2").groupBy(*place))
        .applyInArrow(mark, "host string, inside boolean, content binary, repeated array<int>")
    )
    marked = pin(marked, "marked")
    in_article = F.size("article") > 0
    own = parsed.select(
        "page_id",
        "url",
        "host",
        in_article.alias("inside"),
        F.when(in_article, F.col("article_is")).otherwise(F.col("doubtful_is")).alias("content"),
        F.when(in_article, F.col("article")).otherwise(F.col("doubtful")).alias("blocks"),
    )
    none = F.array().cast("array<int>")
    repeated = F.coalesce("repeated", none)
    # checked last: the article's markup vouches for its blocks, also for those that repeat
    unique = F.filter("blocks", lambda b, i: F.col("inside") | ~F.array_contains(repeated, i))
    return own.join(marked, ["host", "inside", "content"], "left").select(
        "page_id",
        "url",
        F.array_join(unique, "\n\n").alias("text"),
        F.char_length("text").cast("long").alias("n_chars"),
        F.col("inside").alias("in_article"),
        F.size(repeated).cast("long").alias("n_repeated"),
    )
