"""Main text of HTML pages by tag-path ratios.

A page is read as a row of text blocks, each with the path of tags from the root to it. Per path
the length of text and the punctuation of its blocks are added up and divided by the number
of blocks. Both ratios are smoothed over the blocks in page order, fused into one score per
path, and paths over a threshold are content. The element that holds nearly all blocks on content
paths is the article; its other blocks (headings, short lines) belong to it too, unless they are
links or stand in parts that are never content, such as menus, adverts, forms or comments.
"""

from __future__ import annotations

import html as entities
import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from asfalto.llm.batches import text_parts, texts_of

# Fixed values of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe textarea title svg math object canvas".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol "
    "optgroup option p pre section summary table tbody td tfoot th thead tr ul".split()
)
# An opened element ends an open one of these kinds, up to an enclosing list or table.
ENDS = {
    **dict.fromkeys(("li",), ("li",)), **dict.fromkeys(("dt", "dd"), ("dt", "dd")),
    **dict.fromkeys(("td", "th"), ("td", "th")), "tr": ("tr", "td", "th"), "option": ("option",),
}
SCOPE = frozenset("ul ol dl table html body article section div main".split())
# Parts that are never the article, by tag and by word in class, id or role.
NEVER_TAGS = frozenset("head nav aside footer form button select menu dialog".split())
NEVER_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments "
    "commentlist consent cookie cookies copyright disqus footer login menu modal nav navbar navigation "
    "newsletter notice notices alert pagination popup promo promoted recommended related respond search "
    "share sharing sidebar signup social sponsor sponsored subscribe subscription toc toolbar widget "
    "widgets masthead reply replies".split()
)
CONTAINERS = frozenset("body article section div main td center".split())

_NEXT = re.compile(r"<(?:(!--)|(/?)([a-zA-Z][^\s/>]*)|[!?])")
_TAG_END = re.compile(r"""(?:[^<>"']++|"[^"<]*+"|'[^'<]*+')*+>""")
_NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_WORD = re.compile(r"[a-z]+")
_PUNCTUATION = re.compile(r"[.,;:!?。、！？…]")

# Weights of a block and its neighbours in the smoothing (a Gaussian of width 1).
_KERNEL = np.exp(-0.5 * np.arange(-2, 3) ** 2)
_KERNEL /= _KERNEL.sum()
SHARE_OF_BEST = 0.25
HELD_BY_ARTICLE = 0.9


class Block:
    __slots__ = ("path", "elements", "text", "linked", "never")

    def __init__(self, path, elements, text, linked, never):
        self.path, self.elements, self.text = path, elements, text
        self.linked, self.never = linked, never


def _never(tag: str, attributes: str, stack: list) -> bool:
    if tag in NEVER_TAGS:
        return True
    if tag == "header":  # a page's; an article's own holds its title
        return not any(s[0] in ("article", "main") for s in stack)
    if tag in ("html", "body", "article", "main") or "=" not in attributes:
        return False
    return any(
        not NEVER_WORDS.isdisjoint(_WORD.findall("".join(found).lower()))
        for found in _NAMES.findall(attributes)
    )


def blocks_of(page: str) -> list[Block]:
    """Text blocks in page order. Raw elements, comments and markup leave no text."""
    blocks: list[Block] = []
    # (tag, element number, never content, a link)
    stack: list[tuple[str, int, bool, bool]] = []
    text: list[str] = []
    linked = number = at = 0

    def flush() -> None:
        nonlocal linked
        joined = " ".join(entities.unescape("".join(text)).split())
        if joined:
            blocks.append(Block(
                ".".join(s[0] for s in stack if s[0] in BLOCKS), tuple((s[1], s[0]) for s in stack), joined,
                linked / len(joined), any(s[2] for s in stack),
            ))
        text.clear()
        linked = 0

    def add(piece: str) -> None:
        nonlocal linked
        text.append(piece)
        if any(s[3] for s in stack):
            linked += len(piece.strip())

    def close(depth: int) -> None:
        if any(s[0] in BLOCKS for s in stack[depth:]):
            flush()
        del stack[depth:]

    while True:
        found = _NEXT.search(page, at)
        if not found:
            add(page[at:])
            break
        if found.start() > at:
            add(page[at : found.start()])
        comment, slash, tag = found.groups()
        if comment:
            end = page.find("-->", found.end())
            at = len(page) if end < 0 else end + 3
            continue
        ended = _TAG_END.match(page, found.end())
        end = ended.end() if ended else page.find(">", found.end()) + 1
        if not end:  # cut off inside a tag
            break
        at = end
        if not tag:
            continue
        tag = tag.lower()
        if slash:
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth][0] == tag:
                    close(depth)
                    break
            continue
        if tag in RAW:
            if page[end - 2] != "/":
                shut = re.compile(rf"</{tag}\b[^>]*>", re.I).search(page, end)
                at = shut.end() if shut else len(page)
            continue
        if tag == "br":
            add(" ")
            continue
        if tag in VOID:
            if tag == "hr":
                flush()
            continue
        if tag in BLOCKS:
            for depth in range(len(stack) - 1, -1, -1):  # a block ends an open paragraph
                if stack[depth][0] == "p":
                    close(depth)
                    break
                if stack[depth][0] in BLOCKS:
                    break
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth][0] in ENDS.get(tag, ()):
                    close(depth)
                elif stack[depth][0] in SCOPE:
                    break
            flush()
        attributes = page[found.end() : end - 1]
        number += 1
        stack.append((tag, number, _never(tag, attributes, stack), tag == "a"))
    flush()
    return blocks


def path_scores(blocks: list[Block]) -> dict[str, float]:
    """Fused ratio of every path, 1 for the best."""
    sums: dict[str, list[float]] = defaultdict(lambda: [0, 0, 0])
    for block in blocks:
        own = len(block.text) * (1 - min(1.0, block.linked))
        for place, value in enumerate((1, own, len(_PUNCTUATION.findall(block.text)))):
            sums[block.path][place] += value
    ratios = np.array([[sums[b.path][1] / sums[b.path][0], sums[b.path][2] / sums[b.path][0]] for b in blocks])
    edge = len(_KERNEL) // 2
    padded = np.pad(ratios, ((edge, edge), (0, 0)), mode="edge")
    smooth = sum(w * padded[k : k + len(blocks)] for k, w in enumerate(_KERNEL))
    # a path keeps its own ratio where it is larger: neighbours must not pull long text down
    fused = np.maximum(smooth, ratios)[:, 0] * (1 + np.maximum(smooth, ratios)[:, 1])
    scores: dict[str, list[float]] = defaultdict(list)
    for block, value in zip(blocks, np.sqrt(fused)):
        scores[block.path].append(value)
    best = max(map(np.mean, scores.values()))
    return {path: float(np.mean(v) / best) if best else 0.0 for path, v in scores.items()}


def main_text(page: str) -> str:
    """The article's blocks joined by two line breaks; '' for a page without any."""
    blocks = [b for b in blocks_of(page) if not b.never]
    if not blocks:
        return ""
    scores = path_scores(blocks)
    content = [b for b in blocks if scores[b.path] >= SHARE_OF_BEST and b.linked < 0.5]
    if not content:
        return ""
    article = _article(content)
    return "\n\n".join(
        b.text for b in blocks
        if (article is None or article in b.elements) and b.linked < 0.5
    )


def _article(content: list[Block]) -> tuple[int, str] | None:
    """The innermost container that holds nearly all content text; None for the whole page.

    An article or main element is taken as it is. Of other containers, one with a single content block
    may be no more than a paragraph, so the next larger one is taken.
    """
    held: dict[tuple[int, str], int] = defaultdict(int)
    inside: dict[tuple[int, str], int] = defaultdict(int)
    for block in content:
        for element in block.elements:
            held[element] += len(block.text)
            inside[element] += 1
    total = sum(len(b.text) for b in content)
    holders = sorted(
        e for e, n in held.items() if e[1] in CONTAINERS and n >= HELD_BY_ARTICLE * total
    )  # each holds the next
    marked = [e for e in holders if e[1] in ("article", "main")]
    several = [e for e in holders if inside[e] > 1]
    return (marked or several or holders[-2:-1] or [None])[-1]


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every row; a null or empty page has an empty text."""

    def extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_parts(batches, "html"):
            texts = [main_text(page) for page in texts_of(part, "html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("page_id"), part.column("url"), pa.array(texts, pa.string()),
                    pa.array([len(t) for t in texts], pa.int64()),
                ],
                names=["page_id", "url", "text", "n_chars"],
            )

    return pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.col("html").alias("html"),
    ).mapInArrow(extracted, "page_id long, url string, text string, n_chars long")
