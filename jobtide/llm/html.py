"""HTML extraction with a suffix array per host.

A page becomes blocks of text, each with the part of the page it stands in. The token
streams of a host's pages are concatenated and their suffixes sorted; neighbours in that
order show on how many distinct pages a substring of ``least`` tokens stands. What many
pages hold is boilerplate, and the unique runs between are kept. Inside an article element a
passage that several pages share stays: there only whole blocks go, and only those that most
pages of the host hold.

A host's pages are dealt to shards of bounded size, so a host with a third of all pages is
many groups; what counts is a share of the pages, which is the same in each shard.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_MARKUP = re.compile(
    r"<!--(?:.*?--!?>|>|->|.*\Z)|<!\[CDATA\[(.*?)(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]|=\s*(?:\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z)|(?=[^\"'])|\Z))*)(?:>|\Z)|([^<]+|<)",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s=/>\"']+)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
#: What HTML says about its elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe template xmp noembed noframes".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
#: Elements, roles and class or id words of what is not the article.
SKIP = frozenset("head nav footer aside form button select option menu svg canvas object audio video dialog math map datalist".split()) | RAW
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
NAMES = frozenset(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo cookie cookies consent notice sidebar menu nav navbar navigation breadcrumb breadcrumbs footer header masthead comment comments disqus newsletter subscribe share sharing social related popup modal".split()
)
#: Of these, names that inside an article are its head's.
HEADINGS = frozenset("header masthead banner".split())


def blocks(page: str) -> list[tuple[str, int]]:
    """Texts of a page's blocks in order, each with 3 inside an article, 2 beside one in the main part, 1 elsewhere in the body; other parts are left out."""
    out: list[tuple[str, int]] = []
    text: list[str] = []
    stack: list[tuple[str, bool, int]] = []  # element, left out, place
    opened: Counter = Counter()  # of the elements on the stack
    skipped, place = False, 1
    pos, n = 0, len(page)

    def leave_to(i):
        nonlocal skipped, place
        opened.subtract(e[0] for e in stack[i:])
        del stack[i:]
        skipped, place = (stack[-1][1], stack[-1][2]) if stack else (False, 1)

    def end_block():
        if text:
            joined = " ".join(html.unescape("".join(text)).split())
            if joined:
                out.append((joined, place))
            text.clear()

    while pos < n:
        m = _MARKUP.match(page, pos)
        pos = m.end()
        if m[5] is not None or m[1] is not None:
            if not skipped:
                # a reference cut in two by markup stays as it is
                text.append(m[5] if m[5] is not None else html.escape(m[1], quote=False))
            continue
        if m[3] is None:
            continue
        name = m[3].lower()
        if name in BLOCKS or name in SKIP:
            end_block()
        elif name in ("br", "hr"):
            text.append(" ")
        if m[2]:
            if opened[name]:  # else it ends nothing
                leave_to(next(i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == name))
            continue
        if name in RAW:
            close = re.compile(rf"</{re.escape(name)}[\s/>]", re.I).search(page, pos)
            pos = page.find(">", close.start()) + 1 or n if close else n
            continue
        if name in VOID or m[4].endswith("/") and name not in BLOCKS:
            continue
        if name in ("p", "li", "dd", "dt", "tr", "td", "th", "option"):  # these end one of their own kind
            for i in range(len(stack) - 1, -1, -1) if opened[name] else ():
                if stack[i][0] == name:
                    leave_to(i)
                    break
                if stack[i][0] in BLOCKS:
                    break
        leave = skipped or name in SKIP or name == "header" and place == 1 or _says_so(name, m[4], place)
        inside = place if leave else max(place, {"article": 3, "main": 2}.get(name, 1))
        stack.append((name, leave, inside))
        opened[name] += 1
        skipped, place = leave, inside
    end_block()
    return out


def _says_so(element: str, attributes: str, place: int) -> bool:
    """Whether an element's attributes say that it is not the article; inside one, a heading's part is its own."""
    if not attributes.strip():
        return False
    own = HEADINGS if place > 1 else frozenset()
    for m in _ATTRIBUTE.finditer(attributes):
        name, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        if name in ("class", "id") and element not in ("article", "main", "body", "html") and not (NAMES - own).isdisjoint(re.split(r"[^a-z]+", value)):
            return True
        if name == "role" and value.strip() in ROLES or name == "hidden" or name == "aria-hidden" and value == "true":
            return True
    return False


def covered(streams: list[np.ndarray], least: int, pages: int = 2) -> list[np.ndarray]:
    """Of each page's token stream, which tokens lie in a substring of ``least`` tokens that ``pages`` pages hold, its own included.

    The suffixes of the concatenated streams are sorted by prefix doubling, as far as
    ``least`` tokens; a page ends in a token of its own, so no substring spans two pages.
    """
    sizes = np.array([len(s) + 1 for s in streams])
    n = int(sizes.sum())
    page = np.repeat(np.arange(len(streams)), sizes)
    joined = np.zeros(n, np.int64)
    ends = np.cumsum(sizes) - 1
    filled = np.ones(n, bool)
    filled[ends] = False
    if filled.any():
        joined[filled] = np.unique(np.concatenate(streams), return_inverse=True)[1]
    rank = joined
    rank[ends] = joined.max(initial=0) + 1 + np.arange(len(streams))
    have = 1
    while have < least:
        step = min(have, least - have)  # ranks of ``have`` tokens, shifted, rank have + step
        second = np.full(n, -1, np.int64)
        second[: n - step] = rank[step:]
        order = np.lexsort((second, rank))
        a, b = rank[order], second[order]
        new = np.ones(n, np.int64)
        new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(new) - 1
        have += step
    order = np.argsort(rank, kind="stable")  # within a rank by page, as suffixes stand
    starts = np.flatnonzero(np.diff(rank[order], prepend=-1))
    another = np.diff(page[order], prepend=-1) != 0
    another[starts] = True
    shared = np.empty(n, bool)
    shared[order] = np.repeat(np.add.reduceat(another.astype(np.int64), starts) >= pages, np.diff(np.append(starts, n)))
    edge = np.zeros(n + least + 1, np.int64)
    at = np.flatnonzero(shared)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + least, -1)
    inside = np.cumsum(edge)[:n] > 0
    return [inside[e - s + 1 : e] for s, e in zip(sizes, ends, strict=True)]


def host(url: Column) -> Column:
    """The host of an address in lower case; empty if there is none."""
    return F.lower(F.coalesce(F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))


def main_text(parts: list[tuple[str, int]], repeated: np.ndarray, common: np.ndarray) -> str:
    """The article of a page from its blocks and which of their tokens are repeated on other pages, and on very many.

    Where the article is marked, blocks stay whole but for those that are ``common`` to their
    last token; elsewhere what is ``repeated`` goes and the unique runs between are kept.
    """
    best = max((place for _, place in parts), default=1)
    out, at = [], 0
    for text, place in parts:
        words = text.split(" ")
        hit, usual = repeated[at : at + len(words)], common[at : at + len(words)]
        at += len(words)
        if best > 1:
            if place == best and not usual.all():
                out.append(text)
        elif not hit.any():
            out.append(text)
        elif left := [w for w, h in zip(words, hit, strict=True) if not h]:
            out.append(" ".join(left))
    return "\n".join(out)


def extract(
    pages: DataFrame, least: int = 4, per_shard: int = 256, share: float = 0.25, most: float = 0.5, many: int = 8,
    key: str = "page_id", url: str = "url", page: str = "html",
) -> DataFrame:
    """Key, url and text of each page, one row per row of ``pages``.

    Null and empty pages have an empty text. Pages without a host are a host of their own.
    Rows with equal keys are pages each on its own; an empty table gives no rows.

    A shard is a part of a host's pages dealt by hash, and boilerplate is told by its share of
    them, so a host's size does not matter. A page whose article is not marked loses the runs of
    ``least`` tokens or more that a ``share`` of the shard's pages hold, at least two. A marked
    article loses the blocks that consist of what ``most`` of them hold, at least ``many``.
    Pages of equal text count as one, so copies of a page leave each other alone.
    """
    kinds = [pages.schema[c].dataType.simpleString() for c in (key, url)]
    source = pages.select(F.col(key), F.col(url), host(F.col(url)).alias("host"), F.col(page).alias("page"))
    counts = source.groupBy("host").agg(F.count("*").alias("c")).select(F.col("host").alias("h"), (F.floor((F.col("c") - 1) / per_shard) + 1).alias("shards"))
    counts = counts.filter("shards > 1")
    few = counts.limit(10_001).count() <= 10_000  # then the table of large hosts may be broadcast
    split = source.join(F.broadcast(counts) if few else counts, F.col("host") == F.col("h"), "left")
    shard = F.pmod(F.xxhash64(key, url), F.coalesce("shards", F.lit(1))).cast("int")
    split = split.select(key, url, "host", shard.alias("shard"), "page")

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [blocks(p or "") for p in batch.column(4).to_pylist()]
            texts = pa.array([[t for t, _ in f] for f in found], pa.list_(pa.string()))
            places = pa.array([bytes(p for _, p in f) for f in found], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], texts, places], names=[key, url, "host", "shard", "texts", "places"])

    parsed = split.mapInArrow(parse, f"`{key}` {kinds[0]}, `{url}` {kinds[1]}, host string, shard int, texts array<string>, places binary")

    def choose(table: pa.Table) -> pa.Table:
        parts = [list(zip(t, p, strict=True)) for t, p in zip(table["texts"].to_pylist(), table["places"].to_pylist(), strict=True)]
        known: dict[str, int] = {}
        streams = [np.array([known.setdefault(w, len(known)) for t, _ in p for w in t.split(" ")], np.int64) for p in parts]
        first: dict[bytes, int] = {}
        own = [first.setdefault(s.tobytes(), len(first)) for s in streams]
        distinct = [np.frombuffer(s, np.int64) for s in first]
        repeated = covered(distinct, least, max(2, -int(-share * len(first) // 1)))
        common = covered(distinct, least, max(many, -int(-most * len(first) // 1)))
        texts = [main_text(p, repeated[i], common[i]) for p, i in zip(parts, own, strict=True)]
        return table.select([key, url]).append_column("text", pa.array(texts, pa.string()))

    return parsed.groupBy("host", "shard").applyInArrow(choose, f"`{key}` {kinds[0]}, `{url}` {kinds[1]}, text string")
