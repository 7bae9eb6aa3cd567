"""Main text of web pages by tag-path ratios.

A page is cut into blocks of text, each with the path of block elements from the root down to it. Per path the length and the
punctuation of its blocks are added up and divided by their number; both ratios, as shares of the page's highest, are smoothed along the page,
a neighbour counting by the part of the path it shares, and fused by Dempster's rule into one belief. Paths whose blocks reach a share of the
highest belief are content. What markup itself calls something else (navigation, forms, comments ...) never becomes a block.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from html import unescape
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veriloom.llm.common import byte_slices

SLICE_BYTES = 1 << 20
#: A path is content if its blocks' mean belief reaches this share of the highest.
LEAST = 0.2
#: Weights of the neighbours one and two blocks away, and the power to which the shared part of the path is raised.
NEAR, SHARED_POWER = (0.6, 0.2), 2

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:[^\"'>]|\"[^\"]*\"|'[^']*')*+)>|<[!?][^>]*>|<[/!?A-Za-z][^>]*\Z", re.S)
_NAMED = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_WORD = re.compile(r"[a-z]+")
_PUNCTUATION = re.compile(r"[.,;:!?…。，、；：！？¿¡]")
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title noscript iframe noframes xmp".split())
#: Elements that are never an article's text.
_OTHER = frozenset("head nav header footer aside form script style noscript template button select textarea iframe object svg canvas dialog menu datalist audio video noframes xmp".split())
_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar toolbar".split())
#: Words of a class or id that say the same; not asked of the elements in _TRUSTED, whose classes describe the page.
_HINTS = frozenset("ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus footer header login menu modal "
                   "nav navbar navigation newsletter notice notices popup promo promotion related replies reply respond share sharing sidebar signup social sponsor sponsored "
                   "subscribe subscription toolbar widget".split())
_TRUSTED = frozenset("html body main article".split())
_INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var".split())
_ENDS_P = frozenset("address article aside blockquote center details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
#: Elements closed by the start of a like one, and where the search for it ends.
_ENDED_BY = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
_SCOPE = frozenset("ul ol dl table html body article section div main select".split())
_LISTS = frozenset("ul ol dl table thead tbody tfoot tr".split())
#: Short kinds of block that stay with the text around them.
_PART_OF = frozenset("h1 h2 h3 h4 h5 h6 li dt dd td th caption figcaption blockquote pre".split())


class Block(NamedTuple):
    path: int
    parent: int  # the element around the block's own one and the list or table it is in
    tag: str
    depth: int
    shared: int  # elements of the path that the block before has too
    text: str


class Open(NamedTuple):
    tag: str
    inline: bool
    block: str  # tag, path, depth and holder of the block element that it is or is in
    path: int
    depth: int
    element: int
    holder: int


def _unwanted(tag: str, attributes: str) -> bool:
    if tag in _OTHER:
        return True
    for m in _NAMED.finditer(attributes):
        value = (m[2] or m[3] or m[4] or "").lower()
        if m[1].lower() == "role":
            if value.strip() in _ROLES:
                return True
        elif tag not in _TRUSTED and not _HINTS.isdisjoint(_WORD.findall(value)):
            return True
    return False


def blocks(page: str, trusting: bool = True) -> list[Block]:
    """The page's blocks of text in order. ``trusting``: leave out what the markup calls something else; scripts and the head always go."""
    stack = [Open("", False, "", 0, 0, 0, 0)]
    paths: dict[tuple[int, str], int] = {}
    out: list[Block] = []
    pieces: list[str] = []
    linked = loose = 0  # characters of the block inside and outside links
    low = elements = links = 0
    skip = 0  # height of the stack at which an unwanted element was opened
    at = 0

    def path_of(above: int, label: str) -> int:
        return paths.setdefault((above, label), len(paths) + 1)

    def settle() -> None:
        nonlocal pieces, linked, loose, low
        if pieces:
            text = " ".join(unescape("".join(pieces)).split())
            if text:
                own = stack[-1]
                path = path_of(own.path, "a") if linked and not loose else own.path
                out.append(Block(path, own.holder, own.block, own.depth, min(low, own.depth), text))
                low = own.depth
            pieces, linked, loose = [], 0, 0

    def pop_to(height: int) -> None:
        nonlocal skip, low, links
        if stack[-1].depth > stack[height - 1].depth:
            settle()
        links -= sum(x.tag == "a" for x in stack[height:])
        del stack[height:]
        low = min(low, stack[-1].depth)
        if skip and len(stack) <= skip:
            skip = 0

    def height_of(names: tuple[str, ...] | frozenset[str], until: frozenset[str] = frozenset()) -> int:
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in names:
                return i
            if stack[i].tag in until:
                return 0
        return 0

    while at <= len(page):
        found = _TOKEN.search(page, at)
        end = found.start() if found else len(page)
        if end > at and not skip:
            piece = page[at:end]
            pieces.append(piece)
            if size := len(piece.strip()):
                linked, loose = (linked + size, loose) if links else (linked, loose + size)
        if not found:
            break
        at = found.end()
        tag = (found[2] or "").lower()
        if not tag:
            continue
        if found[1]:
            if tag == "br" or tag == "p" and not height_of(("p",)):
                settle() if tag == "p" else pieces.append(" ")
            elif height := height_of((tag,)):
                pop_to(height)
            continue
        if tag in _ENDS_P and (height := height_of(("p",), _SCOPE)):
            pop_to(height)
        if tag in _ENDED_BY and (height := height_of(_ENDED_BY[tag], _SCOPE - {tag})):
            pop_to(height)
        if tag in _VOID:
            if tag == "hr":
                settle()
            elif not skip:
                pieces.append(" " if tag == "br" else "")
            continue
        inline = tag in _INLINE
        if not inline:
            settle()
        if not skip and (_unwanted(tag, found[3]) if trusting else tag in _RAW or tag == "head"):
            settle()
            skip = len(stack)
        elements += 1
        above = stack[-1]
        if inline:
            stack.append(above._replace(tag=tag, inline=True))
            links += tag == "a"
        else:
            holder = above.holder if above.block in _LISTS else above.element
            stack.append(Open(tag, False, tag, path_of(above.path, tag), above.depth + 1, elements, holder))
        if tag in _RAW:
            close = re.compile(rf"</{tag}(?=[\s/>])[^>]*>?", re.I).search(page, at)
            pop_to(len(stack) - 1)
            at = close.end() if close else len(page)
    settle()
    return out


def _smoothed(values: np.ndarray, shared: list[np.ndarray]) -> np.ndarray:
    """Every value averaged with its neighbours; shared[k - 1] is the weight between blocks i and i + k."""
    total, weight = values.copy(), np.ones(len(values))
    for k, w in enumerate(shared, 1):
        if len(values) > k:
            total[:-k] += w * values[k:]
            weight[:-k] += w
            total[k:] += w * values[:-k]
            weight[k:] += w
    return total / weight


def beliefs(found: list[Block]) -> np.ndarray:
    """For every block, the fused belief that its path is content: equal for blocks of one path."""
    names, path = np.unique([b.path for b in found], return_inverse=True)
    number = np.bincount(path)
    depth = np.array([max(b.depth, 1) for b in found], float)
    common = np.array([b.shared for b in found], float)  # with the block before
    shared = []
    for k, near in enumerate(NEAR, 1):
        low = np.min([common[j:len(found) - k + j] for j in range(1, k + 1)], axis=0) if len(found) > k else np.zeros(0)
        shared.append(near * (low / np.maximum(depth[:-k], depth[k:])) ** SHARED_POWER if len(found) > k else low)

    def evidence(values: list[int]) -> np.ndarray:
        ratio = np.bincount(path, values) / number
        if not ratio.max():
            return np.full(len(found), 0.5)
        return np.clip(_smoothed((ratio / ratio.max())[path], shared), 0.05, 0.95)

    a = evidence([len(b.text) for b in found])
    b = evidence([len(_PUNCTUATION.findall(b.text)) for b in found])
    fused = a * b / (a * b + (1 - a) * (1 - b))
    return (np.bincount(path, fused) / number)[path]


def main_text(page: str, least: float = LEAST, trusting: bool = True) -> str:
    """The blocks of content paths in page order, joined by one space. Headings, list items and the like stay if most text of the
    element around them does."""
    found = blocks(page, trusting)
    if not found:
        return ""
    belief = beliefs(found)
    chosen = belief >= least * belief.max()
    inside, kept = defaultdict(int), defaultdict(int)
    for b, yes in zip(found, chosen):
        inside[b.parent] += len(b.text)
        kept[b.parent] += len(b.text) * bool(yes)
    return " ".join(b.text for b, yes in zip(found, chosen) if yes or b.tag in _PART_OF and 2 * kept[b.parent] > inside[b.parent])


def extract(df: DataFrame, html: str = "html", keep: tuple[str, ...] = ("page_id", "url"), least: float = LEAST) -> DataFrame:
    """Columns ``keep``, text and n_chars of every row.

    One pass without a shuffle; a page is read whole. Null and empty pages, and pages without text, give an empty text; broken and cut
    markup is read as far as it goes; repeated rows are answered each; other columns are not read; no rows give none.
    """
    held = [f"k{i}" for i in range(len(keep))]  # whatever the columns are called
    source = df.select(*[F.col(f"`{k}`").alias(h) for k, h in zip(keep, held)], F.coalesce(F.col(html).cast("string"), F.lit("")).alias("_html"))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in source.drop("_html").schema.fields)

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in byte_slices(batch, "_html", SLICE_BYTES):
                texts = [main_text(page, least) for page in part.column("_html").to_pylist()]
                yield pa.RecordBatch.from_arrays([*(part.column(h) for h in held), pa.array(texts, pa.string())], [*held, "text"])

    return source.mapInArrow(compute, f"{schema}, text string").toDF(*keep, "text").withColumn("n_chars", F.length("text").cast("bigint"))
