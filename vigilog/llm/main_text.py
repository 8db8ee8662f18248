"""Main text of pages by tag-path ratios.

A page becomes a row of blocks, each with the path of block-level tags from the root (a tag with its class words). Text
length and punctuation are summed per path; the ratio of a path is its text per block that is not in a link, its punctuation ratio its
marks per block. Both are smoothed with a Gaussian over the neighbours, those under the same parent above all, so that a short
paragraph or heading among long ones gains and a lone line doesn't, and fused as a product. Paths whose fused ratio is above a
share of the deviation over the page mark the content. Known words in class, id and role and the tags article and main are
priors: factors on the fused ratio.

The innermost element that holds most of the content is the container. It is widened to the article or main element
around it, or else to all that holds headings, paragraphs or list items; what stands there beside the container counts if it has
some of those itself. Blocks that are mostly link are left out as menus unless they are headings or captions of the container, stand
amid the content or follow a heading. Navigation, forms, footers and such by their tags, and elements that a prior marks, are
left out unless the container lies in the marked element.
"""

from __future__ import annotations

import html as references
import re
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from vigilog.llm.words import pieces

RADIUS = 2
SHARE = 0.5  # of the deviation of the fused ratios
APART = 0.05  # what a neighbour under another parent counts
MARKED = 0.05  # the factors of the priors
NAMED = 2.0
MASS = 0.8  # of the content, in the container

#: Tags of HTML by what they do to text.
_BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "head header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
_RAW = frozenset("script style textarea title noscript template iframe svg math select button object".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BOILERPLATE_TAGS = frozenset("head nav footer aside form menu dialog fieldset".split())
_BOILERPLATE_WORDS = frozenset(
    "ad ads advert adverts advertisement banner sponsor sponsored promo nav navigation navbar menu sidebar aside footer header masthead topbar "
    "breadcrumb breadcrumbs comment comments reply replies discussion cookie cookies consent notice notices popup modal newsletter subscribe "
    "signup login share social related recommended pagination pager widget toolbar".split()
)
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_TITLES = _HEADINGS | {"figcaption", "caption"}
_PROSE = _TITLES | frozenset("p blockquote pre li dt dd td th".split())
_CLOSES_P = _BLOCKS - {"body", "html", "head"}
_ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th")}

_PART = re.compile(r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*)>", re.S)
_NAMED = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_PUNCTUATION = re.compile(r"[.,;:!?。，]")
_WORDS = re.compile(r"[a-z]+")


class Block:
    """A block of text: labels and numbers of the elements around it, and which of them a word marks as boilerplate."""

    __slots__ = ("path", "depth", "marks", "text", "linked")

    def __init__(self, path: tuple[str, ...], depth: tuple[int, ...], marks: tuple[int, ...], text: str, linked: int):
        self.path, self.depth, self.marks, self.text, self.linked = path, depth, marks, text, linked

    @property
    def tag(self) -> str:
        return self.path[-1].split(".")[0]

    @property
    def prose(self) -> bool:
        """Whether it is a heading, paragraph or list item, and not mostly link."""
        return self.tag in _PROSE and 2 * self.linked <= len(self.text)


def blocks_of(page: str) -> list[Block]:
    """The blocks with text in page order; those in boilerplate by tag are left out."""
    out: list[Block] = []
    stack: list[tuple[str, str, int, bool, bool]] = [("#root", "#root", 0, False, False)]  # tag, label, number, boilerplate by tag, by word
    text: list[str] = []
    links = [0, 0]  # open links, characters in them
    number, at, end = 0, 0, len(page)

    def flush() -> None:
        joined = " ".join(references.unescape("".join(text)).split())
        text.clear()
        if joined and not stack[-1][3]:
            marks = tuple(x[2] for x in stack if x[4])
            out.append(Block(tuple(x[1] for x in stack), tuple(x[2] for x in stack), marks, joined, min(links[1], len(joined))))
        links[1] = 0

    def close(upto: int) -> None:
        flush()
        del stack[upto:]

    while at < end:
        part = _PART.search(page, at)
        piece = page[at : part.start()] if part else page[at:]
        text.append(piece)
        if links[0]:
            links[1] += len(piece)
        if not part:
            break
        at = part.end()
        tag = (part[2] or "").lower()
        if not tag:
            if part[0].startswith("<![CDATA["):
                text.append(references.escape(part[0][9:-3]))
            continue
        if tag == "a":
            links[0] = 0 if part[1] else 1
        elif tag == "br":
            text.append(" ")
        elif tag in _RAW and not part[1]:
            closing = re.compile(rf"</{tag}\b[^>]*>", re.I).search(page, at)
            at = closing.end() if closing else end
            text.append(" ")
        elif tag in _BLOCKS:
            if part[1]:
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i][0] == tag:
                        close(i)
                        break
                else:
                    flush()
                continue
            if tag in _CLOSES_P and stack[-1][0] == "p":
                close(len(stack) - 1)
            elif tag in _ENDS and stack[-1][0] in _ENDS[tag]:
                close(len(stack) - 1)
            flush()
            if tag in _VOID:
                continue
            number += 1
            names = {m[1].lower(): (m[2] or m[3] or m[4] or "") for m in _NAMED.finditer(part[3])}
            words = _WORDS.findall(" ".join(names.values()).lower())
            top = tag == "header" and not any(x[0] in ("article", "main") for x in stack)
            named = tag not in ("html", "body", "article", "main") and any(w in _BOILERPLATE_WORDS for w in words)
            bad = stack[-1][3] or tag in _BOILERPLATE_TAGS or top
            label = ".".join([tag, *sorted({w for w in _WORDS.findall(names.get("class", "").lower())}), *["!"] * named])
            stack.append((tag, label, number, bad, named))
    close(1)
    return out


def fused_ratios(blocks: list[Block]) -> dict[tuple[str, ...], float]:
    """The smoothed and fused ratio of every tag path, without priors."""
    length, marks, count = Counter(), Counter(), Counter()
    for b in blocks:
        length[b.path] += len(b.text) - b.linked
        marks[b.path] += len(_PUNCTUATION.findall(b.text))
        count[b.path] += 1
    plain = np.array([(length[b.path] / count[b.path], marks[b.path] / count[b.path]) for b in blocks])
    parents = np.array([b.depth[-2] if len(b.depth) > 1 else -1 for b in blocks])
    sums, weights = plain.copy(), np.ones(len(blocks))
    for step in range(1, min(RADIUS, len(blocks) - 1) + 1):
        near = np.exp(-0.5 * (step / max(RADIUS / 2, 0.5)) ** 2) * np.where(parents[step:] == parents[:-step], 1, APART)
        sums[step:] += near[:, None] * plain[:-step]
        sums[:-step] += near[:, None] * plain[step:]
        weights[step:] += near
        weights[:-step] += near
    smooth = sums / weights[:, None]
    fused = smooth[:, 0] * (smooth[:, 1] + 0.5)
    ratio: dict[tuple[str, ...], float] = defaultdict(float)
    for b, x in zip(blocks, fused.tolist(), strict=True):
        ratio[b.path] += x / count[b.path]
    return ratio


def _prior(b: Block) -> float:
    named = any(x.split(".")[0] in ("article", "main") for x in b.path)
    return (MARKED if b.marks else 1.0) * (NAMED if named else 1.0)


def main_text(page: str) -> str:
    """The blocks of the article, one to a line; empty without text."""
    blocks = blocks_of(page)
    if all(b.marks for b in blocks):
        return ""
    ratios = fused_ratios(blocks)
    values = np.array([ratios[b.path] * _prior(b) for b in blocks])
    cut = min(SHARE * float(np.std(values)), float(values.max()))
    core = [b for b, x in zip(blocks, values, strict=True) if x >= cut]
    mass: Counter = Counter()
    for b in core:
        for element in b.depth:
            mass[element] += len(b.text)
    total = sum(len(b.text) for b in core)
    container = max((e for e, m in mass.items() if m >= MASS * total), default=0)  # the innermost one that holds the content
    chain, container, whole = _article(core, container)
    blocks = [b for b in blocks if all(m in chain for m in b.marks)]
    if whole:
        return "\n".join(b.text for b in blocks if container in b.depth)
    around = _widened(blocks, chain)
    level = chain.index(around) + 1
    held = [b for b in blocks if around in b.depth]
    beside = {b.depth[level] for b in held if len(b.depth) > level and (b.prose or container in b.depth)}
    held = [b for b in held if container in b.depth or b.prose or (len(b.depth) > level and b.depth[level] in beside)]
    main = {id(b) for b in core}
    amid = [i for i, b in enumerate(held) if container in b.depth and id(b) in main]
    kept, listed = [], False
    for i, b in enumerate(held):
        linked = 2 * b.linked > len(b.text) and ratios[b.path] * _prior(b) < cut
        titled = b.tag in _TITLES and (container in b.depth or i > amid[0])
        if not linked or titled or amid[0] < i < amid[-1] or listed:
            kept.append(b)
        listed = i > amid[0] and (b.tag in _HEADINGS or (listed and linked))
    return "\n".join(b.text for b in kept)


def _article(core: list[Block], container: int) -> tuple[tuple[int, ...], int, bool]:
    """The elements from the root to the container, the container, and whether it is an article or main element.

    A container inside such an element is widened to it, and one that is itself a paragraph or heading to what holds it.
    """
    b = next(b for b in core if container in b.depth)
    upto = b.depth.index(container)
    for i in range(upto, 0, -1):
        if b.path[i].split(".")[0] in ("article", "main"):
            return b.depth[: i + 1], b.depth[i], True
    if b.path[upto].split(".")[0] in _PROSE:
        upto = max(upto - 1, 0)
    return b.depth[: upto + 1], b.depth[upto], False


def _widened(blocks: list[Block], chain: tuple[int, ...]) -> int:
    """The least element around the container that holds all headings, paragraphs and list items that are not mostly link."""
    shared = len(chain)
    for b in blocks:
        if b.prose:
            shared = min(shared, next((i for i, (x, y) in enumerate(zip(chain, b.depth, strict=False)) if x != y), min(len(chain), len(b.depth))))
    return chain[shared - 1]


def extracted(pages: DataFrame) -> DataFrame:
    """``page_id``, ``url``, ``text`` and ``n_chars`` for every row of ``pages`` (page_id, url, html).

    Null, empty or textless html gives an empty text. Broken markup is read leniently: an unclosed tag ends with what holds it. Rows
    are taken one by one, repeated or not; other columns are ignored and an empty table stays empty. A task holds one
    slice of pages (4 MB, one page at least).
    """

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "html", most=1 << 22):
            texts = [main_text(x) if x else "" for x in batch.column("html").to_pylist()]
            yield pa.record_batch([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())], names=["page_id", "url", "text"])

    plain = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return plain.mapInArrow(rows, "page_id long, url string, text string").withColumn("n_chars", F.length("text").cast("long"))
