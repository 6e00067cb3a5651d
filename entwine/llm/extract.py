"""Main text of web pages: removal of the templates of a site, then structural rules for what is left.

A page is read once into text parts and elements. Every element's subtree is hashed (tag, attributes and all it
holds, the hashes of the elements in it included), whatever its name; in Spark each hash is counted per host over
the distinct main texts around it, so copies of one page count once. A subtree that recurs around LEAST_TEXTS
different texts of its host is a template and its parts are deleted: menus, notices, adverts, footers. Of what is
left, elements that are not text of the page by their name, role or class go too, and the longest article, else
main, else body gives the text. Paragraphs, headings, list items and inline elements of that text are hashed as
part of what is around them and go only with it: a sentence that many articles share is no template.

A null page is empty; a page without text gives an empty text; a null url is a host of its own. Unclosed,
misnested and cut-off markup is read as far as it goes. Repeated rows give a row each. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import html as entities
import json
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from urllib.parse import urlsplit

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize

#: A template recurs around so many different texts of its host, however many pages the host has.
LEAST_TEXTS = 5
#: An element of more than this share of a page's main text proves no template there; one proven on other pages
#: goes from that page too.
MOST_OF_PAGE = 0.5

# Fixed values of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe xmp noembed noframes".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
CLOSES_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section summary table ul".split())
SIBLINGS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
SCOPES = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr", "table"), "th": ("tr", "table"), "option": ("select",)}
#: Tags of running text: where no rule names them, they are a template only as part of a larger element.
PROSE = INLINE | frozenset("html body main article p h1 h2 h3 h4 h5 h6 pre blockquote li dt dd tr td th tbody thead tfoot caption figcaption summary address hgroup".split())
FLOW = frozenset("p h1 h2 h3 h4 h5 h6 pre blockquote".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
DROPPED = frozenset("nav footer aside form button select input textarea script style noscript template iframe svg canvas object embed audio video dialog menu head title map search datalist fieldset optgroup option math".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar status".split())
#: Words of classes and ids that name what is not the article.
NAMES = frozenset(
    "ad ads adbox adslot advert adverts advertisement advertising adsense sponsor sponsored sponsors promo promotion promos banner banners nav navbar navigation menu menus submenu breadcrumb breadcrumbs "
    "header masthead topbar footer foot colophon sidebar sidebars aside rail cookie cookies consent gdpr notice notices notification alert popup modal overlay newsletter subscribe subscription signup "
    "login comment comments commentlist reply replies respond disqus discussion share sharing social follow related recommended recommendations pagination pager paging widget widgets toolbar skip "
    "search searchform form copyright legal disclaimer tags meta byline".split()
)
_UNSURE = frozenset("no not without has with".split())

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(.*?)(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)", re.S)
_SPACES = re.compile(r"\s+")
_ATTRIBUTE = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]*))?""")


def _attributes(raw: str) -> dict[str, str]:
    return {k.lower(): entities.unescape(v.strip("\"'")) for k, v in _ATTRIBUTE.findall(raw)} if raw.strip(" /\t\n\r") else {}


def _unwanted(tag: str, attrs: dict[str, str]) -> bool:
    if tag in DROPPED:
        return True
    if tag in ("html", "body", "main") or not attrs:
        return False
    if "hidden" in attrs or attrs.get("aria-hidden") == "true" or attrs.get("role", "").lower() in ROLES:
        return True
    if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", attrs.get("style", ""), re.I):
        return True
    for token in f"{attrs.get('class', '')} {attrs.get('id', '')}".split():
        parts = re.split(r"[-_]+", re.sub(r"(?<=[a-z])(?=[A-Z])", "-", token).lower())
        if parts[0] in _UNSURE or (tag == "article" and parts[0] in ("post", "article", "entry")):
            continue
        if any(p in NAMES or p.rstrip("0123456789") in NAMES for p in parts):
            return True
    return False


@dataclass
class Page:
    """What was read of a page. parts: (block, article, main, flow, text) of each run of text that no rule leaves out;
    article and main number the outermost such element around it (-1: none), flow says that it stands in a paragraph
    or the like. elements: (hash, first part, end part) of those with text that may go by themselves. Of elements
    around the same text the innermost counts: it recurs wherever an outer one does."""

    parts: list[tuple[int, int, int, bool, str]] = field(default_factory=list)
    elements: list[tuple[int, int, int]] = field(default_factory=list)


@dataclass(slots=True)
class _Open:
    tag: str
    digest: object
    first: int  # parts and runs of text before it
    runs: int
    ruled: bool
    article: int
    main: int
    flow: bool
    header: bool  # a header in an article, of which only headings count


def read(page: str) -> Page:
    out = Page()
    stack: list[_Open] = []
    block = articles = mains = paragraphs = headings = runs = 0
    inner = (-1, -1)  # the runs of text in the element that was listed last
    blank = True  # the block has no text yet

    def flush() -> None:
        nonlocal block, blank
        if not blank:
            block, blank = block + 1, True

    def pop_to(depth: int) -> None:
        nonlocal paragraphs, headings, inner
        while len(stack) > depth:
            e = stack.pop()
            if e.tag not in INLINE:
                flush()
            paragraphs -= e.tag == "p"
            headings -= e.tag in HEADINGS
            digest = e.digest.digest()
            if stack:
                stack[-1].digest.update(b"<" + digest)
            if runs > e.runs and (e.ruled or e.tag not in PROSE) and inner != (e.runs, runs):
                out.elements.append((int.from_bytes(digest, "little", signed=True), e.first, len(out.parts)))
                inner = (e.runs, runs)

    def add(raw: str) -> None:
        nonlocal blank, runs
        text = _SPACES.sub(" ", entities.unescape(raw))
        if not text or (blank and text == " "):
            return
        if stack:
            e = stack[-1]
            e.digest.update(b">" + text.strip().encode("utf-8", "surrogatepass"))
            if not e.ruled and (headings or not e.header):
                out.parts.append((block, e.article, e.main, e.flow, text))
        else:
            out.parts.append((block, -1, -1, False, text))
        blank, runs = False, runs + 1

    at, n = 0, len(page)
    while at < n:
        m = _TOKEN.search(page, at)
        if not m:
            add(page[at:])
            break
        if m.start() > at:
            add(page[at : m.start()])
        at = m.end()
        if m[1] is not None:
            add(m[1].replace("&", "&amp;"))
        tag = (m[3] or m[6] or "").lower()
        if not tag:
            continue
        if not m[0].endswith(">"):
            break  # cut off within a tag
        if m[2] or m[5]:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k].tag == tag:
                    pop_to(k)
                    break
                if tag in INLINE and stack[k].tag not in INLINE:
                    break
            continue
        raw_attrs = m[4] if m[3] else m[7]
        if tag in CLOSES_P and paragraphs:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k].tag in ("button", "table", "td", "th"):
                    break
                if stack[k].tag == "p":
                    pop_to(k)
                    break
        if tag in SIBLINGS:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k].tag in SCOPES[tag]:
                    break
                if stack[k].tag in SIBLINGS[tag]:
                    pop_to(k)
                    break
        if tag in VOID:
            if tag == "br":
                add(" ")
            elif tag not in INLINE:
                flush()
            continue
        if tag in RAW:
            end = re.compile(rf"</{tag}\b[^>]*>", re.I).search(page, at)
            at = end.end() if end else n
            continue
        if raw_attrs.rstrip().endswith("/") and tag in ("svg", "path"):
            continue
        if tag not in INLINE:
            flush()
        up = stack[-1] if stack else _Open("", None, 0, 0, False, -1, -1, False, False)
        ruled, header, article, main = up.ruled, up.header, up.article, up.main
        if not ruled:
            if tag == "header":
                header, ruled = header or article >= 0, article < 0
            else:
                ruled = _unwanted(tag, _attributes(raw_attrs))
        if not ruled and tag == "article" and article < 0:
            article, articles = articles, articles + 1
        if not ruled and tag == "main" and main < 0:
            main, mains = mains, mains + 1
        paragraphs += tag == "p"
        headings += tag in HEADINGS
        digest = hashlib.blake2b(f"{tag} {_SPACES.sub(' ', raw_attrs).strip(' /')}".encode("utf-8", "surrogatepass"), digest_size=8)
        stack.append(_Open(tag, digest, len(out.parts), runs, ruled, article, main, up.flow or tag in FLOW, header))
    pop_to(0)
    return out


def blocks(parts: list[tuple[int, int, int, bool, str]], gone: list[tuple[int, int]] = ()) -> list[tuple[str, bool]]:
    """(text, flow) of the blocks of the main part: parts outside the ranges `gone`, of the longest article with text,
    else the longest main, else of all."""
    lost = np.zeros(len(parts) + 1, np.int64)
    for first, end in gone:
        lost[first] += 1
        lost[end] -= 1
    kept = [p for p, k in zip(parts, np.cumsum(lost), strict=False) if not k]
    for region in (1, 2, 0):
        found: dict[int, dict[int, list]] = {}
        for p in kept:
            if not region or p[region] >= 0:
                one = found.setdefault(p[region] if region else 0, {}).setdefault(p[0], [[], False])
                one[0].append(p[4])
                one[1] = one[1] or p[3]
        texts = [[(t, flow) for t, flow in ((" ".join("".join(x).split()), flow) for x, flow in by.values()) if t] for by in found.values()]
        best = max(texts, key=lambda b: sum(len(t) for t, _ in b), default=[])
        if best:
            return best
    return []


def host(url: str | None) -> str:
    try:
        return (urlsplit(url or "").hostname or "").lower()
    except ValueError:
        return ""


_ELEMENT = pa.struct([("hash", pa.int64()), ("first", pa.int32()), ("end", pa.int32()), ("most", pa.bool_())])
_ELEMENTS = "array<struct<hash:bigint,first:int,end:int,most:boolean>>"


def _packed(parts: list[tuple]) -> bytes:
    """Parts as they wait for the templates: a third of their size, since they are dealt to them."""
    return zlib.compress(json.dumps(parts).encode())


def _unpacked(packed: bytes) -> list[list]:
    return json.loads(zlib.decompress(packed))


def _described(page: str | None) -> tuple[Page, int, list[dict]]:
    """The page, the hash of its paragraphs by the rules alone, and its elements with whether they hold most of its text."""
    one = read(page or "")
    main = blocks(one.parts)
    prose = [t for t, flow in main if flow] or [t for t, _ in main]
    digest = int.from_bytes(hashlib.blake2b("\n".join(prose).encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)
    size = np.concatenate([[0], np.cumsum([len(p[4]) for p in one.parts])])
    total = sum(len(t) for t, _ in main)
    return one, digest, [{"hash": h, "first": a, "end": b, "most": bool(size[b] - size[a] > MOST_OF_PAGE * total)} for h, a, b in one.elements]


def parsed(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(row, id, url, host, digest, parts, elements): each page before templates are known."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, len(batch), 128):
                part = batch.slice(k, 128)
                found = [_described(x.as_py()) for x in part.column(2)]
                hosts = [host(u.as_py()) for u in part.column(1)]
                parts = pa.array([_packed(one.parts) for one, _, _ in found], pa.binary())
                elements = pa.array([e for _, _, e in found], pa.list_(_ELEMENT))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(hosts, pa.string()), pa.array([d for _, d, _ in found], pa.int64()), parts, elements], ["id", "url", "host", "digest", "parts", "elements"])

    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    found = rows.mapInArrow(run, f"id {pages.schema[id_col].dataType.simpleString()}, url string, host string, digest bigint, parts binary, elements {_ELEMENTS}")
    return found.select(F.expr("uuid()").alias("row"), F.xxhash64("host").alias("site"), "*")


def templates(found: DataFrame) -> DataFrame:
    """(site, hash): subtrees that recur around many different texts of their host. Distinct (site, hash, text) are
    made before the counts, so a host with a third of all pages is summed where it is read."""
    seen = found.select("site", "digest", F.explode(F.array_distinct(F.transform(F.filter("elements", lambda e: ~e["most"]), lambda e: e["hash"]))).alias("hash")).distinct()
    return seen.groupBy("site", "hash").agg(F.count("*").alias("n")).filter(F.col("n") >= LEAST_TEXTS).select("site", "hash")


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(id, url, text, n_templates): the main text of each page, its blocks joined by a line feed, and how many of its
    elements were deleted as templates."""
    found = materialize(parsed(pages, id_col, url_col, html_col))
    known = materialize(templates(found))
    held = found.select("row", "site", F.explode("elements").alias("e")).select("row", "site", "e.hash", "e.first", "e.end")
    gone = held.join(known, ["site", "hash"]).groupBy("row").agg(F.collect_list(F.struct("first", "end")).alias("gone"))
    joined = found.select("row", "id", "url", "parts").join(gone, "row", "left").select("id", "url", "parts", "gone")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, len(batch), 128):
                part = batch.slice(k, 128)
                spans = [[(g["first"], g["end"]) for g in x or ()] for x in part.column(3).to_pylist()]
                texts = ["\n".join(t for t, _ in blocks(_unpacked(x), s)) for x, s in zip(part.column(2).to_pylist(), spans, strict=True)]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array([len(s) for s in spans], pa.int32())], ["id", "url", "text", "n_templates"])

    return joined.mapInArrow(run, f"id {pages.schema[id_col].dataType.simpleString()}, url string, text string, n_templates int")
