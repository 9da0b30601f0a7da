"""Main text of web pages: the article's blocks, and elsewhere what the pages of a host do not share.

A page is cut into blocks of text at its block elements. Blocks of the ``article`` element are its text. All other
blocks go, page after page, into the token stream of their host, and a suffix array over it finds runs of
tokens that several different pages hold: menus, notices, footers. Pages without an article element keep the unique runs
of their main region, or else of their body. What an element's name, role or class declares to be a menu,
an advert and the like is never text.

Streams are cut into shards where the pages lie, so a host of any size is many tasks' work. A suffix array tells
which runs of a host repeat within its shard; the distinct runs of all shards are then merged by checksum.
"""

from __future__ import annotations

import html
import json
import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import column, mixed, slices, stored

# Tokens, with one for the start of each block, that several pages must share in a row.
LONG = 8
# About so much HTML in a shard, one page at least.
SHARD_BYTES = 4 << 20

# Elements by how HTML treats them.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title noscript iframe noembed noframes".split())  # their content is no markup
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var wbr".split()
)
ENDS_PARAGRAPH = set(
    "address article aside blockquote center details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hr main menu nav ol p pre section table ul".split()
)
ENDS_ITSELF = set("li dt dd tr td th option".split())
# What is never text: by element, by role, and by a word of the class or id.
NO_TEXT = set(
    "nav footer aside form head script style noscript template svg math iframe object canvas audio video button "
    "select option datalist textarea title dialog menu noembed noframes".split()
)
NO_TEXT_ROLES = set("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar".split())
NO_TEXT_NAMES = set(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr "
    "notice notices nav navbar navigation menu breadcrumb breadcrumbs sidebar aside footer comment comments disqus "
    "reply replies respond share sharing social related newsletter subscribe subscription signup login popup modal "
    "widget toolbar pagination pager masthead".split()
)
MAIN_NAMES = set("article content post entry story main".split())

ARTICLE, REGION, OUTSIDE, NEVER = range(4)
_CODEC = pa.Codec("zstd", compression_level=9)

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+(?=>|\Z)|[^>]*)(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s=\"'/>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_SPACE = re.compile(r"[\x20\x09-\x0D]+")
_HOST = re.compile(r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)")


def host_of(url: str | None) -> str:
    found = _HOST.match(url or "")
    return found[1].lower() if found else ""


def _kind(name: str, attributes: str) -> tuple[bool, int | None]:
    """Whether an element holds no text, and which region it opens: ARTICLE, or REGION and how well it is declared."""
    if name in NO_TEXT:
        return True, None
    if not attributes.strip():
        return False, {"article": 0, "main": 1}.get(name)
    values = {m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "").lower() for m in _ATTRIBUTE.finditer(attributes)}
    words = set(re.findall("[a-z]+", f"{values.get('class', '')} {values.get('id', '')}"))
    hidden = "hidden" in values or values.get("aria-hidden") == "true" or "display:none" in values.get("style", "").replace(" ", "")
    if hidden or values.get("role") in NO_TEXT_ROLES or (words & NO_TEXT_NAMES and name not in ("html", "body")):
        return True, None
    if name == "article":
        return False, 0
    if name == "main" or values.get("role") == "main":
        return False, 1
    if values.get("itemprop") == "articlebody" or (words & MAIN_NAMES and name not in ("html", "body")):
        return False, 2
    return False, None


def blocks_of(page: str | None) -> list[tuple[int, str]]:
    """(kind, text) of the blocks of a page in order.

    Kinds: ARTICLE is text, REGION is text unless repeated, OUTSIDE and NEVER are not text. The region is the
    page's articles, or else its main elements, elements named so, or its body.
    """
    found: list[tuple[int, int | None, str]] = []  # elements without text around it, best region, text
    stack: list[tuple[str, bool, int | None]] = []
    opened: Counter = Counter()  # names in the stack
    silent, open_regions, declared = 0, [0, 0, 0], set()
    parts, at, page = [], 0, page or ""

    def close() -> None:
        text = _SPACE.sub(" ", html.unescape("".join(parts))).strip(" ")
        if text:
            found.append((silent, next((r for r in range(3) if open_regions[r]), None), text))
        parts.clear()

    def leave(place: int) -> str:
        """Take one element off the stack."""
        nonlocal silent
        name, no_text, region = stack[place]
        if name not in INLINE or no_text:
            close()
        del stack[place]
        opened[name] -= 1
        silent -= no_text
        if region is not None:
            open_regions[region] -= 1
        return name

    def leave_up_to(name: str) -> None:
        while leave(-1) != name:
            pass

    while at < len(page):
        m = _TAG.search(page, at)
        if m is None:
            parts.append(page[at:])
            break
        parts.append(page[at : m.start()])
        at = m.end()
        if m[2] is None:
            continue
        name = m[2].lower()
        if m[1]:
            if name in INLINE and opened[name]:
                # what an inline element was opened around stays open
                leave(next(i for i in reversed(range(len(stack))) if stack[i][0] == name))
            elif opened[name]:
                leave_up_to(name)
            elif name not in INLINE:
                close()
            continue
        if name == "br":
            parts.append(" ")
            continue
        if name in ENDS_PARAGRAPH and opened["p"]:
            leave_up_to("p")
        if name in ENDS_ITSELF and stack and stack[-1][0] == name:
            leave(-1)
        no_text, region = _kind(name, m[3])
        if name == "header" and not open_regions[0]:
            no_text, region = True, None
        if name not in INLINE or no_text:
            close()
        if name in RAW:
            end = re.compile(rf"</{name}(?=[\s/>])[^>]*(?:>|\Z)|\Z", re.I).search(page, at)
            at = end.end()
            continue
        if name in VOID:
            continue
        stack.append((name, no_text, region))
        opened[name] += 1
        silent += no_text
        if region is not None:
            open_regions[region] += 1
            if not silent:
                declared.add(region)
    while stack:
        leave(-1)
    close()
    best = min(declared, default=None)
    out = []
    for quiet, region, text in found:
        inside = best is None or (region is not None and region == best)
        out.append((NEVER if quiet else OUTSIDE if not inside else ARTICLE if best == 0 else REGION, text))
    return out


def stream_of(blocks: list[tuple[int, str]]) -> tuple[list[str], list[tuple[int, int]]]:
    """Tokens of the blocks outside the article, and for each (block, place of the word in it, -1 for its start)."""
    tokens, places = [], []
    for number, (kind, text) in enumerate(blocks):
        if kind != ARTICLE:
            words = text.split(" ")
            tokens += ["\n", *words]
            places += [(number, place) for place in range(-1, len(words))]
    return tokens, places


def suffix_order(codes: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffix array of ``codes`` by their first ``depth`` numbers, and the rank of every suffix in it.

    Ranks of one number become ranks of 2, 4, ... numbers; suffixes of one rank share ``depth`` numbers.
    """
    rank, width = np.unique(codes, return_inverse=True)[1].astype(np.int64), 1
    while width < depth:
        step = min(width, depth - width)
        beyond = np.concatenate([rank[step:], np.full(min(step, len(rank)), -1)]) + 1
        rank = np.unique(rank * (len(rank) + 1) + beyond, return_inverse=True)[1].astype(np.int64)
        width += step
    return np.argsort(rank, kind="stable"), rank


def shared_runs(streams: list[list[str]], holders: list[int], hosts: list[str]) -> dict[str, np.ndarray]:
    """Distinct runs of LONG tokens in streams of pages: ``first`` and ``second`` half of a checksum, smallest and
    largest holder, and the places of each in the streams end to end, as ``starts`` in ``order``. Tokens of
    different hosts are different."""
    lengths = np.array([len(s) for s in streams], dtype=np.int64)
    tokens = np.array([xxhash.xxh3_64_intdigest(t, 0) for s in streams for t in s], dtype=np.uint64)
    salts = np.array([xxhash.xxh3_64_intdigest(h, 1) for h in hosts], dtype=np.uint64)
    tokens = mixed(tokens ^ np.repeat(salts, lengths))
    order, rank = suffix_order(tokens, LONG)
    ends = np.repeat(np.cumsum(lengths), lengths)
    whole = order[order + LONG <= ends[order]]  # a run does not go on in the next page
    heads = np.flatnonzero(np.concatenate([[True], rank[whole[1:]] != rank[whole[:-1]]])) if len(whole) else whole
    holder = np.repeat(np.array(holders, dtype=np.int64), lengths)[whole]
    sums = []
    for base in (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)):
        total = np.zeros(len(heads), dtype=np.uint64)
        for k in range(LONG):
            total = (total ^ tokens[whole[heads] + k]) * base
            total ^= total >> np.uint64(29)
        sums.append(total.view(np.int64))
    return {
        "first": sums[0],
        "second": sums[1],
        "low": np.minimum.reduceat(holder, heads) if len(heads) else holder,
        "high": np.maximum.reduceat(holder, heads) if len(heads) else holder,
        "order": whole,
        "starts": heads,
    }


def _pack(data: list) -> bytes:
    raw = json.dumps(data, ensure_ascii=False).encode("utf-8", "surrogatepass")
    return len(raw).to_bytes(8, "little") + _CODEC.compress(raw, asbytes=True)


def _unpack(data: bytes) -> list:
    return json.loads(_CODEC.decompress(data[8:], int.from_bytes(data[:8], "little"), asbytes=True))


def _shards(pages: DataFrame, id_col: str, url_col: str, html_col: str) -> DataFrame:
    """Rows of many pages: ``shard``, ``ids``, ``urls``, and the packed ``blocks`` of the pages."""
    source = pages.select(
        column(pages, id_col).alias("page_id"),
        column(pages, url_col).cast("string").alias("url"),
        column(pages, html_col).cast("string").alias("html"),
    )
    kind = source.schema["page_id"].dataType.simpleString()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId() << 32
        for whole in batches:
            for batch in slices(whole, "html", SHARD_BYTES):
                blocks = [blocks_of(page) for page in batch.column("html").to_pylist()]
                ends = pa.array([0, batch.num_rows], type=pa.int32())
                columns = [
                    pa.array([shard], type=pa.int64()),
                    *(pa.ListArray.from_arrays(ends, batch.column(c)) for c in ("page_id", "url")),
                    pa.array([_pack(blocks)], type=pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["shard", "ids", "urls", "blocks"])
                shard += 1

    return source.mapInArrow(rows, f"shard long, ids array<{kind}>, urls array<string>, blocks binary")


def _runs_of(urls: list[str | None], pages: list) -> tuple[dict[str, np.ndarray], list[list[str]]]:
    """Runs of a shard; pages of equal text hold as one, so that a copy does not make all its text a repetition."""
    streams = [stream_of(blocks)[0] for blocks in pages]
    holders = [xxhash.xxh3_64_intdigest("\n".join(t for _, t in blocks)) - (1 << 63) for blocks in pages]
    return shared_runs(streams, holders, [host_of(url) for url in urls]), streams


def extract_text(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """``page_id``, ``url``, ``text``, ``n_chars`` (code points) and ``n_repeated`` of every page.

    ``text`` is the page's article: blocks in page order, each with its character references decoded and its white space
    (space, tab, line feed, vertical tab, form feed, carriage return) as single spaces, joined by blank lines. Without an article
    element it is the main region, or else the body, less the tokens in runs of ``LONG`` or more that
    another page of the host with other text also holds. ``n_repeated`` counts such tokens outside the article, block starts
    included.

    A null page is empty; null and malformed addresses are one host without a name; null ids and repeated rows keep
    a row each; without rows there is none. Other columns are not looked at.

    Repetition alone would be wrong within articles: pages of a host may hold copies of an article or one passage, and their
    text has to stay, so an article is never cut.
    """
    shards = stored(_shards(pages, id_col, url_col, html_col), "html-shards")

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, urls, blocks in zip(*(batch.column(c).to_pylist() for c in ("shard", "urls", "blocks")), strict=True):
                runs, _ = _runs_of(urls, _unpack(blocks))
                n = len(runs["starts"])
                columns = [runs["first"], runs["second"], runs["low"], runs["high"], np.full(n, shard), np.arange(n)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, type=pa.int64()) for c in columns], ["first", "second", "low", "high", "shard", "run"]
                )

    runs = shards.select("shard", "urls", "blocks").mapInArrow(
        find, "first long, second long, low long, high long, shard long, run long"
    )
    same = Window.partitionBy("first", "second")
    repeated = runs.withColumn("least", F.min("low").over(same)).withColumn("most", F.max("high").over(same))
    repeated = repeated.filter("least <> most").groupBy("shard").agg(F.collect_list(F.col("run").cast("int")).alias("runs"))
    id_kind = shards.schema["ids"].dataType.elementType.simpleString()

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                pages = _unpack(batch.column("blocks")[i].as_py())
                found, streams = _runs_of(batch.column("urls")[i].as_py(), pages)
                covered = _covered(found, batch.column("runs")[i].as_py() or [], sum(map(len, streams)))
                texts, counts, at = [], [], 0
                for blocks, stream in zip(pages, streams, strict=True):
                    mask = covered[at : at + len(stream)]
                    at += len(stream)
                    texts.append(_text(blocks, mask))
                    counts.append(int(mask.sum()))
                columns = [
                    batch.column("ids")[i].values,
                    batch.column("urls")[i].values,
                    pa.array(texts, type=pa.string()),
                    pa.array([len(t) for t in texts], type=pa.int64()),
                    pa.array(counts, type=pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["page_id", "url", "text", "n_chars", "n_repeated"])

    whole = shards.join(repeated, "shard", "left")
    return whole.mapInArrow(finish, f"page_id {id_kind}, url string, text string, n_chars long, n_repeated long")


def _covered(found: dict[str, np.ndarray], repeated: list[int], n: int) -> np.ndarray:
    """Mask of the tokens in the ``repeated`` runs."""
    chosen = np.zeros(len(found["starts"]), dtype=bool)
    chosen[repeated] = True
    sizes = np.diff(found["starts"], append=len(found["order"]))
    hits = found["order"][np.repeat(chosen, sizes)]
    steps = np.zeros(n + LONG + 1, dtype=np.int64)
    np.add.at(steps, hits, 1)
    np.add.at(steps, hits + LONG, -1)
    return np.cumsum(steps)[:n] > 0


def _text(blocks: list, covered: np.ndarray) -> str:
    """The article's blocks, or the unique runs of the region's."""
    _, places = stream_of(blocks)
    unique = defaultdict(list)
    for (number, place), gone in zip(places, covered.tolist(), strict=True):
        if place >= 0 and not gone and blocks[number][0] == REGION:
            unique[number].append(place)
    out = []
    for number, (kind, text) in enumerate(blocks):
        if kind == ARTICLE:
            out.append(text)
        elif unique[number]:
            words = text.split(" ")
            out.append(" ".join(words[place] for place in unique[number]))
    return "\n\n".join(out)
