"""Main text of web pages by nearest-URL page differencing (operator 3)."""

from __future__ import annotations

import html as entities
import pickle
import re
from functools import lru_cache
from os.path import commonprefix

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut

#: Elements whose content is never main text, those that end a block, and those that hold the article. Fixed values.
DROPPED = "script style noscript template svg math iframe object canvas select button textarea head title".split()
ASIDE = "nav header footer aside form menu dialog".split()
BLOCKS = (
    "address article aside blockquote body br center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html li main nav ol p pre section summary table tbody td tfoot th thead tr ul"
).split()
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
ARTICLE = {"article", "main"}
#: Elements that end without an end tag.
OPTIONAL = set("p li dt dd td th tr".split())
#: Pages that markup leaves open up to which their shared lines are broadcast.
BROADCAST_PAGES = 50_000
#: Pages of a sorted range, which a task holds the line hashes of.
RANGE_PAGES = 20_000
#: Words of a class, id or role that mark what isn't the article, and words that may stand beside them in one name. Fixed values.
MARKED = (
    "ad ads advert adverts advertisement advertising adsense banner banners sponsor sponsored sponsors promo promos promotion sidebar side nav navbar navigation navigational menu menus breadcrumb breadcrumbs header masthead footer cookie cookies consent notice notices alert alerts popup modal newsletter subscribe subscription share sharing social comment comments disqus replies reply respond related widget widgets search login signup"
).split()
#: Words that beside a marked header word make it the article's own, and elements that hold text, whose ids are anchors. Fixed values.
OWN = "article articles post posts story entry content section title".split()
HEADERS = "header masthead".split()
TEXT_ELEMENTS = "p h1 h2 h3 h4 h5 h6 blockquote pre figure figcaption table td th dt dd".split()
BESIDE = "site page main top bottom left right primary secondary global sub mobile desktop area list item items bar box block container wrapper wrap inner outer content section slot unit group panel col column row links link buttons button btn form text title thread post posts article stories story footer media icons".split()
TOKEN = re.compile(r"<!--(?:-?>|.*?(?:--!?>|\Z))|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>?|[^<]+|<", re.S)
ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
NO_DISPLAY = re.compile(r"(?i)(?:^|;)\s*display\s*:\s*none\b")
PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|[0-9]+")
SPACE = re.compile(r"\s+")
_dropped, _aside, _blocks, _marked, _beside = set(DROPPED), set(ASIDE), set(BLOCKS) | set(ASIDE), set(MARKED), set(BESIDE)
_own, _headers, _text = set(OWN), set(HEADERS), set(TEXT_ELEMENTS)


@lru_cache(4096)
def marked_name(name: str, inside: bool = False) -> bool:
    """Whether a class, id or role says other than main text: all its parts are marked words, words that go beside them or numbers.

    A header's word doesn't count within the article, nor beside a word for the article itself.
    """
    parts = [p.lower() for p in PARTS.findall(name)]
    counts = _marked - _headers if inside or not _own.isdisjoint(parts) else _marked
    return any(p in counts for p in parts) and all(p in _marked or p in _beside or p in _own or p.isdigit() for p in parts)


@lru_cache(4096)
def ruled_out(attributes: str, element: str = "div", inside: bool = False) -> bool:
    """Whether a tag's attributes hide it or mark it: the attribute hidden, aria-hidden, display:none in its style, or a marked name.

    Names don't rule out an article element, ids no element that holds text.
    """
    for name, value in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'")
        if name == "hidden" or (name == "aria-hidden" and value.lower() == "true") or (name == "style" and NO_DISPLAY.search(value)):
            return True
        if element in ARTICLE or (name == "id" and element in _text):
            continue
        if name in ("class", "id", "role") and any(marked_name(v, inside) for v in value.split()):
            return True
    return False


def blocks(page: str) -> list[tuple[str, int]]:
    """(text, rank) of a page's blocks in order: 2 within the article, 1 outside it, 0 in what structure marks as other than main text."""
    out: list[tuple[str, int]] = []
    held: list[str] = []
    stack: list[tuple[str, bool, bool]] = []  # open elements that mark other text or hold the article, and those of the same name in them
    open_: dict[str, int] = {}
    off = inside = hushed = 0  # open blocks that mark other text, articles, and inline elements whose text isn't shown
    at, size = 0, len(page)

    def close_block() -> None:
        if held:
            text = SPACE.sub(" ", entities.unescape("".join(held))).strip()
            held.clear()
            if text:
                out.append((text, 0 if off else 2 if inside else 1))

    def pop(k: int) -> None:
        nonlocal off, inside, hushed
        if any(name in _blocks for name, _, _ in stack[k:]):
            close_block()
        for name, marks, holds in stack[k:]:
            if name in _blocks:
                off -= marks
            else:
                hushed -= marks
            inside -= holds
            open_[name] -= 1
        del stack[k:]

    while at < size:
        m = TOKEN.match(page, at)
        at = m.end()
        name = m[2]
        if name is None:
            s = m[0]
            if hushed:
                continue
            if s[0] != "<" or s == "<":
                held.append(s)
            elif s.startswith("<![CDATA["):
                held.append(s[9:].removesuffix("]]>").replace("&", "&amp;"))
            continue
        name = name.lower()
        if name in _blocks:
            close_block()
            if stack and stack[-1][0] in OPTIONAL and (stack[-1][0] == name or (m[1] and name not in OPTIONAL)):
                pop(len(stack) - 1)
        if m[1]:
            if open_.get(name):
                pop(max(k for k, x in enumerate(stack) if x[0] == name))
            continue
        if name in _dropped:
            end = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(page, at)
            if end:
                at = end.end()
            elif name not in ("head", "title", "button", "select"):
                at = size
            continue
        attributes = m[3] or ""
        if name in VOID or attributes.endswith("/"):
            continue
        marks = name in _aside and not (name == "header" and inside)
        if attributes and not marks:
            marks = (ruled_out if len(attributes) < 1000 else ruled_out.__wrapped__)(attributes, name, inside > 0)
        holds = name in ARTICLE and not marks
        if marks or holds or open_.get(name):
            if name in _blocks:
                off += marks
            else:
                hushed += marks
            inside += holds
            open_[name] = open_.get(name, 0) + 1
            stack.append((name, marks, holds))
    close_block()
    return out


def settled(found: list[tuple[str, int]]) -> bool:
    """Whether markup tells the main text: an article element holds as much text as lies outside it, or more."""
    size = [0, 0, 0]
    for text, rank in found:
        size[rank] += len(text)
    return size[2] > 0 and size[2] >= size[1]


def common_lines(a: list[int], b: list[int]) -> list[int]:
    """Places in a of a longest common subsequence of a and b, by bit-parallel rows and halving (Hirschberg), in memory linear in the lines."""
    here = set(b)
    i = [k for k, x in enumerate(a) if x in here]
    there = {a[k] for k in i}
    b = [x for x in b if x in there]
    out: list[int] = []

    def lengths(x: list[int], y: list[int]) -> list[int]:
        masks: dict[int, int] = {}
        for k, v in enumerate(y):
            masks[v] = masks.get(v, 0) | 1 << k
        full = (1 << len(y)) - 1
        row = full
        for v in x:
            hit = row & masks.get(v, 0)
            row = ((row + hit) | (row - hit)) & full
        bits = np.unpackbits(np.frombuffer((~row & full).to_bytes(len(y) // 8 + 1, "little"), np.uint8), bitorder="little")[: len(y)]
        return [0, *np.cumsum(bits).tolist()]

    work = [(0, len(i), 0, len(b))]
    while work:
        p, q, s, e = work.pop()
        while p < q and s < e and a[i[p]] == b[s]:
            out.append(i[p])
            p, s = p + 1, s + 1
        while p < q and s < e and a[i[q - 1]] == b[e - 1]:
            out.append(i[q - 1])
            q, e = q - 1, e - 1
        if p >= q or s >= e:
            continue
        if q - p == 1:
            if a[i[p]] in b[s:e]:
                out.append(i[p])
            continue
        middle = (p + q) // 2
        x = [a[k] for k in i[p:q]]
        left, right = lengths(x[: middle - p], b[s:e]), lengths(x[middle - p :][::-1], b[s:e][::-1])[::-1]
        best = max(range(e - s + 1), key=lambda k: left[k] + right[k])
        work += [(p, middle, s, s + best), (middle, q, s + best, e)]
    return sorted(out)


def _lines(pages: DataFrame) -> DataFrame:
    """_key (of the row's page_id, url and html), hashes of the page's lines that markup doesn't rule out, in order, and whether markup leaves its main text open."""

    def run(batches):
        for b in batches:
            found = [blocks(h or "") for h in b.column("html").to_pylist()]
            lines = [[xxhash.xxh3_64_intdigest(t) - (1 << 63) for t, rank in x if rank] for x in found]
            bare = [not settled(x) for x in found]
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in ("_key", "host", "path")], pa.array(lines, pa.list_(pa.int64())), pa.array(bare, pa.bool_())], ["_key", "host", "path", "lines", "bare"])

    return pages.mapInArrow(run, "_key binary, host string, path string, lines array<long>, bare boolean")


def _push(near: list[tuple], host: str, path: str, name: object, variants: tuple) -> list[tuple]:
    """The entries (host, path, name, variants) to look at from the next page on, the last one first.

    Pages of one path are one entry with two of their different line lists. Besides the last two entries, the last one
    that differs from the second is enough to find a page that differs in path and lines from any that follows.
    """
    if near and near[0][0] != host:
        near = []
    if near and near[0][2] == name:
        seen = near[0][3]
        return [(host, path, name, (*seen, *[v for v in variants if v not in seen])[:2]), *near[1:]]
    more = [x for x in near[1:] if any(v != near[0][3][0] for v in x[3])] if near and len(near[0][3]) == 1 else []
    return [(host, path, name, variants), *near[:1], *more[:1]]


def _differing(near: list[tuple], host: str, name: object, lines: bytes) -> tuple[str, bytes] | None:
    """Path and lines of the first entry of the host with another path and other lines."""
    return next(((x[1], v) for x in near if x[0] == host and x[2] != name for v in x[3] if v != lines), None)


def shared_lines(pages: DataFrame) -> DataFrame:
    """_key, the hashes of lines (shared) and bare of each page: what it shares with its nearest different page by URL path within its host.

    Pages are sorted by host and path over ranges, so a large host takes many tasks. A page's neighbours are the ones
    before and after it in that order with another path and other lines: copies of a page and variants of one path
    would share its text. The nearer has the longer common start of path, of equal ones the one before. Null urls are
    each a path of their own. At most six entries of each range are sent to all tasks. A task holds its range's hashes, of about RANGE_PAGES pages.
    """
    # cut first, as finding the ranges reads everything once more
    lines = cut(_lines(pages))
    parts = max(1, lines.rdd.getNumPartitions(), -(-lines.count() // RANGE_PAGES))
    ordered = cut(lines.repartitionByRange(parts, "host", "path", "_key").sortWithinPartitions("host", "path", "_key"))

    def read(batches):
        for b in batches:
            for h, p, k, lines, bare in zip(*(b.column(c).to_pylist() for c in ("host", "path", "_key", "lines", "bare"))):
                h, p = h or "", p or ""
                yield h, p, p if h or p else k, np.array(lines, np.int64).tobytes(), k, bare

    def ends(batches):
        first, begin, last = None, [], []
        rows = list(read(batches))
        for h, p, n, x, k, _ in rows:
            first = first or (h, p, k)
            last = _push(last, h, p, n, (x,))
        for h, p, n, x, _, _ in reversed(rows):
            begin = _push(begin, h, p, n, (x,))
        if first is not None:
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps((first, begin, last))], pa.binary())], ["ends"])

    ranges = sorted((pickle.loads(r["ends"]) for r in ordered.mapInArrow(ends, "ends binary").collect()), key=lambda x: x[0])
    carried: dict[tuple, list] = {first: [[], []] for first, _, _ in ranges}
    for way, order in ((0, ranges), (1, ranges[::-1])):
        near: list[tuple] = []
        for first, begin, last in order:
            carried[first][way] = near
            for x in reversed(begin if way else last):
                near = _push(near, *x)
    told = pages.sparkSession.sparkContext.broadcast(carried)

    def pair(batches):
        rows = list(read(batches))
        if not rows:
            return
        before, after = told.value[(*rows[0][:2], rows[0][4])]
        later = []
        for h, p, n, x, _, _ in reversed(rows):
            after = _push(after, h, p, n, (x,))
            later.append(_differing(after, h, n, x))
        for at in range(0, len(rows), 1000):
            keys, found, bares = [], [], []
            for h, p, n, x, k, bare in rows[at : at + 1000]:
                before = _push(before, h, p, n, (x,))
                # the nearer neighbour, of equal ones the one before
                near = [y for y in (_differing(before, h, n, x), later.pop()) if y is not None]
                best = max(near, key=lambda y: len(commonprefix([y[0], p]))) if near else ("", b"")
                own = np.frombuffer(x, np.int64).tolist()
                keys.append(k)
                found.append(sorted({own[i] for i in common_lines(own, np.frombuffer(best[1], np.int64).tolist())}))
                bares.append(bare)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(found, pa.list_(pa.int64())), pa.array(bares, pa.bool_())], ["_key", "shared", "bare"])

    return ordered.mapInArrow(pair, "_key binary, shared array<long>, bare boolean")


def main_text(page: str | None, shared: list[int] | None) -> str:
    """The blocks that stay: those in the article where it is the larger part; else those that neither markup nor the neighbour rules out."""
    found = blocks(page or "")
    if settled(found):
        return "\n".join(t for t, rank in found if rank == 2)
    gone = set(shared or ())
    return "\n".join(t for t, rank in found if rank and xxhash.xxh3_64_intdigest(t) - (1 << 63) not in gone)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page.

    Lines that a page shares with its nearest different page by URL are deleted, except where an article element holds the
    larger part of the text: boilerplate is told there by markup, and articles of one host do share passages and whole texts. Null and empty pages have no
    text; null urls have no neighbour but each other; repeated rows stay. Other columns aren't read. Only line hashes
    are sorted; what is shared comes back by a join on the row's digest, of pages that markup leaves open alone.
    """
    url = F.coalesce(F.col("url").cast("string"), F.lit(""))
    where = F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://)?([^/?#]*)([^?#]*)", 1)
    rows = pages.select(
        "page_id",
        "url",
        F.col("html").cast("string").alias("html"),
        F.unhex(F.md5(F.concat_ws("\x00", F.col("page_id").cast("string"), url, F.col("html").cast("string")).cast("binary"))).alias("_key"),
        F.lower(where).alias("host"),
        F.regexp_replace(F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://)?([^/?#]*)([^?#]*)", 2), r"/+$", "").alias("path"),
    )
    shared = cut(shared_lines(rows).where(F.col("bare") & (F.size("shared") > 0)).select("_key", "shared").dropDuplicates(["_key"]))
    small = shared.count() <= BROADCAST_PAGES
    joined = rows.join(F.broadcast(shared) if small else shared, "_key", "left").select("page_id", "url", "html", "shared")

    def run(batches):
        for b in batches:
            texts = [main_text(h, x) for h, x in zip(b.column("html").to_pylist(), b.column("shared").to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column("page_id"), b.column("url"), pa.array(texts, pa.string())], ["page_id", "url", "text"])

    kinds = ", ".join(f"{c} {pages.schema[c].dataType.simpleString()}" for c in ("page_id", "url"))
    return joined.mapInArrow(run, f"{kinds}, text string").withColumn("n_chars", F.length("text").cast("long"))
