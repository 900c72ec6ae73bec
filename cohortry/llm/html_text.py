"""Main text of web pages: the page's own structure first, and a suffix array for what the host repeats.

A page is cut into blocks of text. Blocks in an ``article`` or ``main`` element are its main text; blocks in elements
that are by name, role or class something else (menus, adverts, forms, comments ...) are not, unless a class or a form
wraps the only article or the whole page. The rest of a page is undecided. The token streams of all that is not in the main element are put together by host, and a suffix array of
them finds every run of tokens and on how many distinct pages it stands. On pages without a main element the runs that
a share of the host's pages have are removed from the undecided blocks and the unique runs are kept.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from urllib.parse import urlsplit

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortry.llm.scan import bound_batches, mix
from cohortry.session import settle

#: Tokens that a repeated run has at least; a block of fewer is compared whole.
RUN = 8
#: Distinct pages of a host that have a run that is removed: so many, and this share of the host's pages.
LEAST, SHARE = 3, 0.05
#: Pages of a host in one suffix array. A host of more is parted; what the parts find is merged exactly.
PART = 1024

MAIN, REMOVED, OPEN = 0, 1, 2
#: Within a page only: what a class or an id removes, an article in it, and (from FORM on) each form outside the main element.
MARKED, HELD, FORM = 3, 4, 5

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<(script|style|textarea)(?=[\s/>])[^>]*>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*)(?:>|\Z)|<[a-zA-Z!?/][^>]*(?:>|\Z)",
    re.DOTALL | re.IGNORECASE,
)
_TITLE_END = re.compile(r"</title\s*>", re.IGNORECASE)
_ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
#: Elements without text of the page, from the start tag to its own end tag; a start tag without one is nothing.
_DROPPED = frozenset("noscript template svg iframe object canvas select".split())
_HAS_DROPPED = re.compile(r"</(?:" + "|".join(sorted(_DROPPED)) + r")(?=[\s>])", re.IGNORECASE)
#: Elements of a head; with any other one the body begins.
_HEAD = frozenset("html head title meta link base script style noscript template".split())
_PARTS = re.compile(r"[a-z]+")
_BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul".split()
)
_CONTAINER = frozenset("article aside details dialog div fieldset figure footer form header main menu nav search section table ul ol dl span button".split())
_NOT_MAIN = frozenset("nav footer aside form menu dialog search button fieldset".split())
_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
#: Elements that make a form that holds one the wrapper of a page.
_PAGE = frozenset("article main nav header footer h1 h2".split())
#: Parts of a class name beside a mark: ``comments-area`` is comments, ``has-sidebar`` and ``category-social`` are not.
_NEUTRAL = frozenset("area bar block body bottom box button buttons container group inner item items left link links list main panel post posts right row section site title top unit widget widgets wrap wrapper".split())
_MARKS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promoted promotion cookie cookies consent gdpr notice notices nav navbar navigation menu menus breadcrumb breadcrumbs sidebar aside footer comment comments commentlist reply replies disqus share sharing social related recommended newsletter subscribe subscription popup modal overlay login signup signin pagination pager toolbar banner".split()
)


def _marked(names: str) -> bool:
    """Whether one of the class names is a mark as a whole, or in all of its parts but neutral ones."""
    for name in names.split():
        parts = _PARTS.findall(name)
        if not _MARKS.isdisjoint(parts) and all(x in _MARKS or x in _NEUTRAL for x in parts):
            return True
    return False


def _kind(name: str, attributes: str, inside: int) -> int:
    """What an element makes of the text in it, inside an element of kind ``inside``."""
    if inside == REMOVED or name in _NOT_MAIN and name != "form" or name == "header" and inside not in (MAIN, HELD):
        return REMOVED
    marked = False
    for key, value in _ATTRIBUTE.findall(attributes):
        key = key.lower()
        value = value.strip("\"'").lower()
        if key == "hidden" or key == "role" and value in _ROLES or key == "style" and "display:none" in value.replace(" ", ""):
            return REMOVED
        marked = marked or key in ("class", "id") and name != "main" and _marked(value)
    if marked:
        return MARKED
    if name == "form":
        return MARKED if inside in (MAIN, HELD, MARKED) else FORM
    if name == "article":
        return HELD if inside in (MARKED, HELD) else MAIN
    return MAIN if name == "main" else inside


def _judged(found: list[tuple[int, str]], wrappers: set[int]) -> list[tuple[int, str]]:
    """The blocks as MAIN, REMOVED or OPEN, when all of the page is known.

    Articles in marked containers are the main text if the page has no other. A form that wraps the page is undecided.
    What is marked is undecided if the page has nothing else.
    """
    kinds = {kind for kind, _ in found}
    held = REMOVED if MAIN in kinds else MAIN
    rest = OPEN if kinds <= {REMOVED, MARKED} | {k for k in kinds if k >= FORM and k not in wrappers} else REMOVED
    as_one = {MAIN: MAIN, REMOVED: REMOVED, OPEN: OPEN, MARKED: rest, HELD: held}
    return [(as_one[kind] if kind < FORM else OPEN if kind in wrappers else rest, text) for kind, text in found]


def _dropped(page: str) -> dict[int, int]:
    """Where the end tag ends of each element that is dropped whole, by where the element begins."""
    ends: dict[int, int] = {}
    begun: dict[str, list[int]] = {}
    for tag in _TAG.finditer(page) if _HAS_DROPPED.search(page) else ():
        name = (tag[3] or "").lower()
        if name not in _DROPPED:
            continue
        if not tag[2]:
            if not tag[4].endswith("/"):
                begun.setdefault(name, []).append(tag.start())
        elif begun.get(name):
            ends[begun[name].pop()] = tag.end()
    return ends


def blocks(page: str) -> list[tuple[int, str]]:
    """Kind and text of each block that is not empty, in page order; white space is one space, references decoded."""
    out: list[tuple[int, str]] = []
    stack: list[tuple[str, int]] = []
    kind, held, at = OPEN, [], 0
    forms, wrappers = FORM, set()
    dropped, in_head, titles = _dropped(page), False, True
    #: How many elements of each name are open, so that a stray end tag costs no look through all of them.
    opened_names: Counter[str] = Counter()

    def close() -> None:
        text = " ".join("".join(held).split())
        held.clear()
        if text:
            out.append((kind, text))

    for tag in _TAG.finditer(page):
        if tag.start() < at:
            continue
        if tag.start() > at:
            text = page[at : tag.start()]
            in_head = in_head and text.isspace()
            held.append(html.unescape(text) if "&" in text else text)
        at = dropped.get(tag.start(), tag.end())
        name = tag[3]
        if name is None:
            continue
        name = name.lower()
        if name == "head":
            close()
            in_head = not tag[2]
            continue
        in_head = in_head and name in _HEAD
        if name == "title":
            # A title runs to its own end tag; once the page has none left there is nothing more to look for.
            end = _TITLE_END.search(page, at) if titles and not tag[2] else None
            titles = titles and (end is not None or bool(tag[2]))
            at = end.end() if end else at
            continue
        if name in _DROPPED:
            continue
        if name in ("br", "wbr"):
            if name == "br":
                held.append(" ")
            continue
        if name in _BLOCK:
            close()
            if kind >= FORM and name in _PAGE and not tag[2]:
                wrappers.add(kind)
        if name not in _CONTAINER or tag[4].endswith("/"):
            continue
        if not tag[2]:
            new = _kind(name, tag[4], kind)
            if new == FORM and name == "form":
                new, forms = forms, forms + 1
            if new != kind and held:
                close()
            stack.append((name, kind))
            opened_names[name] += 1
            kind = new
        elif opened_names[name]:
            before = kind
            while True:
                opened, outer = stack.pop()
                opened_names[opened] -= 1
                if opened == name:
                    break
            if outer != before and held:
                close()
            kind = outer
    if at < len(page):
        held.append(html.unescape(page[at:]))
    close()
    return _judged(out, wrappers)


def host_of(url: str | None) -> str:
    try:
        return (urlsplit(url or "").hostname or "").lower()
    except ValueError:
        return ""


def tokens(text: str) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(t) for t in text.split()], np.uint64)


def run_hashes(found: list[np.ndarray], salt: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash, block, first token and length of every run of ``RUN`` tokens of each block, or of all of a shorter block."""
    lengths = np.array([len(x) for x in found], np.int64)
    if not lengths.sum():
        return np.zeros(0, np.uint64), *(np.zeros(0, np.int64),) * 3
    flat = np.concatenate(found)
    owner = np.repeat(np.arange(len(found)), lengths)
    begins = np.cumsum(lengths) - lengths
    place = np.arange(len(flat)) - begins[owner]
    size = np.minimum(RUN, lengths[owner] - place)
    chosen = np.flatnonzero((size == RUN) | (place == 0))
    total = np.full(len(chosen), salt & 0xFFFFFFFFFFFFFFFF, np.uint64)
    for i in range(RUN):
        inside = i < size[chosen]
        total = np.where(inside, mix(total * np.uint64(0x9E3779B97F4A7C15) + flat[np.minimum(chosen + i, len(flat) - 1)]), total)
    return total, owner[chosen], place[chosen], size[chosen]


def suffix_array(codes: np.ndarray, ends: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes of a token stream in order of their first ``depth`` (a power of two) tokens, and their ranks.

    A suffix ends with its block: ``ends`` has for each token where its block ends. Ranks are doubled: those of 1 token,
    then 2, 4 ...; two suffixes have one rank if and only if they share that many tokens or are the same to the end.
    """
    n = len(codes)
    _, rank = np.unique(codes, return_inverse=True)
    rank = rank.astype(np.int64) + 1
    width = 1
    while width < depth:
        after = np.arange(n) + width
        second = np.where(after < ends, rank[np.minimum(after, n - 1)], 0)
        _, rank = np.unique(rank * np.int64(n + 2) + second, return_inverse=True)
        rank = rank.astype(np.int64) + 1
        width *= 2
    return np.argsort(rank, kind="stable"), rank


FOUND = pa.schema([("run", pa.int64()), ("met", pa.int64()), ("pages", pa.int64())])


def _runs(table: pa.Table) -> pa.Table:
    """Of the streams of one part: each distinct run, how many pages have it and how many its host has in all parts."""
    pages, hosts = table.column("stream").to_numpy(), table.column("host_hash").to_numpy()
    pieces, owners, salts, sizes = [], [], [], []
    for page, host, size, lengths, data in zip(pages, hosts, table.column("pages").to_pylist(), table.column("lengths").to_pylist(), table.column("tokens").to_pylist(), strict=True):
        edges = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
        flat = np.frombuffer(data, np.uint64)
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            pieces.append(flat[a:b])
            owners.append(page)
            salts.append(host)
            sizes.append(size)
    if not pieces:
        return FOUND.empty_table()
    lengths = np.array([len(x) for x in pieces], np.int64)
    flat, begins = np.concatenate(pieces), np.cumsum(lengths) - lengths
    # Hosts do not share runs: their tokens differ.
    flat = mix(flat ^ np.repeat(np.array(salts, np.int64).view(np.uint64), lengths))
    ends = np.repeat(begins + lengths, lengths)
    order, rank = suffix_array(flat, ends, RUN)
    # Suffixes that a run starts at, in suffix order; equal ranks are neighbours.
    place = np.arange(len(flat)) - np.repeat(begins, lengths)
    starts = (ends - np.arange(len(flat)) >= RUN) | (place == 0)
    order = order[starts[order]]
    new = np.concatenate([[True], rank[order][1:] != rank[order][:-1]])
    group = np.flatnonzero(new)
    page = np.repeat(np.array(owners, np.int64), lengths)[order]
    # A name for the run that all parts share: the hash of its tokens.
    head = order[group]
    name = np.zeros(len(head), np.uint64)
    for i in range(RUN):
        inside = head + i < ends[head]
        name = np.where(inside, mix(name * np.uint64(0x9E3779B97F4A7C15) + flat[np.minimum(head + i, len(flat) - 1)]), name)
    of = np.cumsum(new) - 1
    by_page = np.lexsort((page, of))
    of, page = of[by_page], page[by_page]
    distinct = np.concatenate([[True], (of[1:] != of[:-1]) | (page[1:] != page[:-1])])
    met = np.bincount(of[distinct], minlength=len(head))
    return pa.Table.from_arrays([pa.array(name.view(np.int64)), pa.array(met), pa.array(np.repeat(np.array(sizes, np.int64), lengths)[head])], schema=FOUND)


STREAM = "host_hash bigint, stream bigint, lengths array<int>, tokens binary"
OPEN_RUN = "page_key bigint, run bigint, block int, place int, size int"


def _named(found: list[np.ndarray], host: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    return run_hashes([mix(x ^ np.uint64(host & 0xFFFFFFFFFFFFFFFF)) for x in found], 0)


def _host_hash(url: str | None) -> int:
    return xxhash.xxh64_intdigest(host_of(url)) - (1 << 63)


def _streams(batches):
    for batch in batches:
        rows = []
        for url, page in zip(batch.column("url").to_pylist(), batch.column("html").to_pylist(), strict=True):
            found = [tokens(text) for kind, text in blocks(page or "") if kind != MAIN]
            if found:
                data = np.concatenate(found).tobytes()
                rows.append((_host_hash(url), xxhash.xxh64_intdigest(data) - (1 << 63), [len(x) for x in found], data))
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in rows], kind) for i, kind in enumerate((pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.binary()))], names=["host_hash", "stream", "lengths", "tokens"]
        )


def _open_runs(batches):
    """Runs of the undecided blocks of pages that have no main element."""
    for batch in batches:
        columns = [[] for _ in range(5)]
        for key, url, page in zip(batch.column("page_key").to_pylist(), batch.column("url").to_pylist(), batch.column("html").to_pylist(), strict=True):
            found = blocks(page or "")
            if any(kind == MAIN for kind, _ in found):
                continue
            run, block, place, size = _named([tokens(text) for kind, text in found if kind == OPEN], _host_hash(url))
            for column, values in zip(columns, ([key] * len(run), run.view(np.int64), block, place, size), strict=True):
                column.extend(values)
        yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns, (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32()), strict=True)], names=["page_key", "run", "block", "place", "size"])


def _uncovered(chosen: list[str], covered: list) -> list[str]:
    """The blocks without the covered tokens (block, place, size).

    A block of fewer than ``RUN`` tokens is no long run of its own: it goes only if the next block on one of its sides
    loses tokens, or with others at its side that are together as long as a run.
    """
    words = [text.split() for text in chosen]
    short, touched = set(), set()
    for c in covered:
        if c["size"] < RUN:
            short.add(c["block"])
            continue
        touched.add(c["block"])
        own = words[c["block"]]
        own[c["place"] : c["place"] + c["size"]] = [None] * c["size"]
    for first in sorted(x for x in short if x - 1 not in short):
        last = first
        while last + 1 in short:
            last += 1
        if first - 1 in touched or last + 1 in touched or sum(len(words[i]) for i in range(first, last + 1)) >= RUN:
            words[first : last + 1] = [[]] * (last + 1 - first)
    return [" ".join(w for w in own if w is not None) for own in words]


def main_text(page: str | None, covered: list | None) -> str:
    """The main blocks, or if there are none the undecided ones without the covered tokens (block, place, size)."""
    found = blocks(page or "")
    chosen = [text for kind, text in found if kind == MAIN]
    if not chosen:
        chosen = [text for kind, text in found if kind == OPEN]
        if covered:
            chosen = _uncovered(chosen, covered)
    return "\n\n".join(text for text in chosen if text)


def _texts(batches):
    for batch in batches:
        texts = [main_text(page, covered) for page, covered in zip(batch.column("html").to_pylist(), batch.column("covered").to_pylist(), strict=True)]
        made = [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
        yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), *made], names=["page_id", "url", "text", "n_chars"])


def repeated_runs(pages: DataFrame, part: int = PART, least: int = 2, share: float = 0.0) -> DataFrame:
    """``run``: the runs that stand on at least ``least`` distinct pages and ``share`` of all of their host, outside the main element.

    Pages whose streams are the same count as one page. Hosts of few pages share a suffix array, a large host has
    several; a page is in one of them, so the counts of all add up and how pages are dealt changes nothing.
    """
    streams = settle(pages.select("url", "html").mapInArrow(_streams, STREAM).dropDuplicates(["host_hash", "stream"]), "streams")
    sizes = settle(streams.groupBy("host_hash").agg(F.count("*").alias("pages")), "hosts")
    bins = max(1, streams.count() // part)
    parts = F.ceil(F.col("pages") / part)
    alone = F.struct(F.pmod(F.xxhash64("host_hash"), F.lit(bins)).alias("a"), F.lit(-1).cast("bigint").alias("b"))
    dealt = streams.join(sizes, "host_hash").withColumn("part", F.when(parts == 1, alone).otherwise(F.struct(F.col("host_hash").alias("a"), F.pmod(F.xxhash64("stream"), parts).alias("b"))))
    found = dealt.select("part.a", "part.b", "host_hash", "stream", "pages", "lengths", "tokens").groupBy("a", "b").applyInArrow(_runs, "run bigint, met bigint, pages bigint")
    counted = found.groupBy("run").agg(F.sum("met").alias("met"), F.first("pages").alias("pages"))
    return counted.where((F.col("met") >= least) & (F.col("met") >= share * F.col("pages"))).select("run")


def extract(pages: DataFrame, id_column: str = "page_id", url: str = "url", page: str = "html", part: int = PART) -> DataFrame:
    """``page_id url text n_chars`` of each row of ``pages``.

    Without a main element a run goes if it stands on ``LEAST`` distinct pages and ``SHARE`` of those of the host. Two near
    copies keep their text; from ``LEAST`` near copies on, on a host of few other pages, what they share is taken for the host's.

    Null and empty pages have an empty text; a null or broken url is a host of its own kind (the empty one); repeated
    rows give a row each; an empty table gives none; other columns are ignored. Unclosed tags end where the page ends; of
    elements without text only script, style and textarea do, as in browsers, the others are nothing without an end tag.
    """
    rows = bound_batches(pages).select(F.col(id_column).alias("page_id"), F.col(url).alias("url"), F.col(page).alias("html"))
    key: Column = F.xxhash64("url", "html").alias("page_key")
    open_runs = settle(rows.select(key, "url", "html").mapInArrow(_open_runs, OPEN_RUN), "open-runs")
    covered = open_runs.join(repeated_runs(rows, part, LEAST, SHARE), "run").groupBy("page_key").agg(F.collect_set(F.struct("block", "place", "size")).alias("covered"))
    marked = rows.withColumn("page_key", key).join(settle(covered, "covered"), "page_key", "left")
    kind = rows.schema["page_id"].dataType.simpleString()
    return marked.select("page_id", "url", "html", "covered").mapInArrow(_texts, f"page_id {kind}, url string, text string, n_chars bigint")
