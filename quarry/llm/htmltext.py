"""Main-text extraction from HTML by two passes of block rules.

A page is cut into blocks at block-level tags; scripts, styles, comments,
templates and form controls are skipped whole.  Every block knows its text, the
share of its characters inside links, its stop-word density and the part of the
page it stands in.

*First pass.*  Blocks inside navigation, headers, footers, sidebars, forms,
notices, adverts or reader comments (by tag, role, class or id) and blocks of
mostly links are bad.  Of the rest, long blocks with many stop words are good,
those with some are near good, those with hardly any are bad, and blocks too
short to tell are short.  On a page whose language the stop words don't know
(by length, under ``FOREIGN`` of the words of its longer blocks) length alone decides.

*Second pass.*  Short blocks take the label their nearest decided neighbours on
both sides agree on; where they disagree, good if a near-good block lies
between them and the bad one.  Near-good blocks are good unless both sides are
bad.  Headings above a good block within ``HEADING_REACH`` characters are kept.
Inside an ``article`` or ``main`` element the label of the element's own good
blocks counts for its undecided ones, and where a page has such an element with
good text, text outside it is not main text.

The blocks that end up good are joined in page order by one space; character
references are decoded, white space inside a block is one space, nothing else
is dropped or cut.

Null, empty or markup-free html: treated as one block of text (empty: empty
string).  Broken markup (unclosed tags, stray ``<``, cut-off pages) is read as
far as it goes.  Rows pass one by one; repeated rows give equal texts.  Very long
pages are whole: a task holds about ``_shared.SLICE`` bytes of pages, or one page.  An
empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

import html as entities
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm._shared import slices

LENGTH_LOW, LENGTH_HIGH = 40, 160       # characters
STOP_LOW, STOP_HIGH = 0.12, 0.22        # share of words that are stop words
MAX_LINKS = 0.4                         # share of characters inside links
FOREIGN = 0.06                          # share of stop words in long blocks below which the language isn't listed
HEADING_REACH = 400

# Frequent function words, by language.
STOP_WORDS = frozenset((
    # English
    "the of and to a in is that it for on was with as be by at are this from or an have not but his her they "
    "which you were their been has had will would there what when who more if can all we he she "
    # German
    "der die das und in zu den von mit ist sich des auf für nicht ein eine als auch es an dem im werden aus er hat "
    "dass sie nach wird bei einer um am sind noch wie einem über so zum war haben nur oder aber vor zur bis mehr "
    # French
    "le la les de des un une et à en que qui dans pour pas sur est ce il au du par plus ne se avec son sa ses ou "
    "mais nous vous leur cette aux être elle sont ont été comme "
    # Spanish
    "el los las del y que en un una por con no se su para es al lo como más o pero sus le ha me si sin sobre este "
    "ya entre cuando todo esta ser son dos también fue había era muy "
    # Italian, Portuguese, Dutch
    "il di che è per non una sono gli della nel alla dei os da em um uma não com mais dos het een van niet op te "
    "dat zijn voor met").split())

# Elements by their role in a page.
SKIPPED = frozenset("script style noscript template svg math canvas iframe object embed audio video map select "
                    "textarea button datalist head".split())
BLOCKS = frozenset("address article aside blockquote body center dd details dialog div dl dt fieldset figcaption "
                   "figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre section "
                   "summary table tbody td tfoot th thead tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
OUTSIDE = frozenset("nav footer aside form menu dialog".split())
IMPLIED_END = {"p": BLOCKS, "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]),
               "tr": frozenset(["tr"]), "td": frozenset(["td", "th", "tr"]), "th": frozenset(["td", "th", "tr"])}
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
MARKED = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|adsense|banner|sponsor\w*|promo\w*|nav\w*|menu\w*|breadcrumbs?|sidebar|side|"
    r"footer|foot|header|masthead|topbar|cookies?|consent|gdpr|notice|popup|modal|newsletter|subscri\w+|signup|"
    r"login|comments?|disqus|replies|responses|discussion|related|recommend\w*|share|sharing|social|widget|toolbar|"
    r"pagination|pager|copyright|legal|skip)(?:$|[\s_-]|\d)", re.I)

_TOKEN = re.compile(r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*(?:>|$)|"
                    r"<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|$)", re.S)
_LOOSE = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^>]*)(?:>|$)", re.S)
_ATTR = re.compile(r"\b(class|id|role|hidden|aria-hidden|style)\s*(?:=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?", re.I)
_HREF = re.compile(r"\bhref\b", re.I)
_SPACES = re.compile(r"\s+")
_WORD = re.compile(r"\w+")


class Block:
    """Text of one block and where it stands."""

    __slots__ = ("parts", "linked", "tag", "outside", "inside", "text", "label")

    def __init__(self, tag: str, outside: bool, inside: int):
        self.parts: list[str] = []
        self.linked = 0
        self.tag, self.outside, self.inside = tag, outside, inside
        self.text, self.label = "", ""


def _is_outside(tag: str, attributes: str, in_article: bool) -> bool:
    """Whether an element is no main text by its tag, role, class or id."""
    if tag in OUTSIDE or (tag == "header" and not in_article):
        return True
    if "=" not in attributes and "hidden" not in attributes:
        return False
    for m in _ATTR.finditer(attributes):
        name, value = m.group(1).lower(), (m.group(2) or "").strip("\"'")
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            return True
        if name == "style" and re.search(r"display\s*:\s*none", value):
            return True
        if name == "role" and value.lower() in ROLES:
            return True
        if name in ("class", "id") and MARKED.search(value) and tag not in ("body", "html", "article", "main"):
            return True
    return False


def blocks_of(page: str) -> list[Block]:
    """The blocks of a page in order, with their texts."""
    found: list[Block] = []
    stack: list[tuple[str, bool, int]] = []     # open elements: tag, outside?, article number
    link, articles = -1, 0                      # open elements when a link began (-1: none is open)
    unclosed: set[str] = set()                  # skipped elements that have no end tag further on
    block = Block("", False, 0)

    def close_block():
        nonlocal block
        text = _SPACES.sub(" ", entities.unescape("".join(block.parts))).strip()
        if text:
            block.text = text
            found.append(block)
        _, outside, inside = stack[-1] if stack else ("", False, 0)
        heading = next((t for t, _, _ in reversed(stack) if t in BLOCKS), "")
        block = Block(heading, outside, inside)

    at, end = 0, len(page)
    while at < end:
        m = _TOKEN.search(page, at)
        text = page[at:m.start()] if m else page[at:]
        if text:
            block.parts.append(text)
            if link >= 0:
                block.linked += len(text.strip())
        if not m:
            break
        at = m.end()
        if m.group(2) is None:
            continue
        if m.end() == end and page[-1:] != ">":         # an open quote ran to the end
            m = _LOOSE.match(page, m.start()) or m
            at = m.end()
        closing, tag, attributes = m.group(1), m.group(2).lower(), m.group(3)
        if tag in SKIPPED:
            if not closing and tag != "embed" and not attributes.endswith("/"):
                stop = None if tag in unclosed else re.compile(rf"</{tag}\s*>", re.I).search(page, at)
                if not stop:
                    unclosed.add(tag)
                if stop:
                    at = stop.end()
                elif tag == "head":
                    body = re.compile(r"<body\b", re.I).search(page, at)
                    at = body.start() if body else at
                elif tag in ("script", "style"):
                    at = end
            continue
        if tag == "a":
            link = len(stack) if not closing and _HREF.search(attributes) else -1
            continue
        if tag in ("br", "hr"):
            block.parts.append(" ")
            if tag == "br":
                continue
        if tag not in BLOCKS:
            continue
        if closing:
            depth = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == tag), -1)
            if depth >= 0:
                del stack[depth:]
            if len(stack) < link:               # a link that was never closed ends with the element around it
                link = -1
            close_block()
        elif tag not in VOID:
            while stack and tag in IMPLIED_END.get(stack[-1][0], ()):
                stack.pop()
            _, outside, inside = stack[-1] if stack else ("", False, 0)
            outside = outside or _is_outside(tag, attributes, bool(inside))
            if tag in ("article", "main") and not outside:
                articles += not inside
                inside = inside or articles
            if len(stack) < link:
                link = -1
            stack.append((tag, outside, inside))
            close_block()
        else:
            close_block()
    close_block()
    return found


def _first_pass(blocks: list[Block]) -> None:
    density = []
    for b in blocks:
        words = _WORD.findall(b.text.lower())
        density.append(sum(w in STOP_WORDS for w in words) / len(words) if words else 0.0)
    # by length, so that a word or a line that looks like a listed language doesn't make the page one of it
    long_ones = [(len(b.text), d) for b, d in zip(blocks, density, strict=True)
                 if len(b.text) >= LENGTH_LOW and not b.outside and b.linked <= MAX_LINKS * len(b.text)]
    foreign = bool(long_ones) and sum(n * d for n, d in long_ones) < FOREIGN * sum(n for n, _ in long_ones)
    for b, stops in zip(blocks, density, strict=True):
        size = len(b.text)
        if b.outside or b.linked > MAX_LINKS * size:
            b.label = "bad"
        elif size < LENGTH_LOW:
            b.label = "short" if not b.linked else "bad"
        elif foreign:
            b.label = "good" if size > LENGTH_HIGH else "near"
        elif stops >= STOP_HIGH:
            b.label = "good" if size > LENGTH_HIGH else "near"
        elif stops >= STOP_LOW:
            b.label = "near"
        else:
            b.label = "short" if b.inside else "bad"


def _sides(labels: list[str], i: int, near_counts: bool) -> tuple[str, str]:
    """The nearest decided labels before and after place ``i`` (page ends: bad)."""
    out = []
    for places in (range(i - 1, -1, -1), range(i + 1, len(labels))):
        side = "bad"
        for k in places:
            if labels[k] in ("good", "bad") or (near_counts and labels[k] == "near"):
                side = labels[k]
                break
        out.append(side)
    return out[0], out[1]


def _second_pass(blocks: list[Block]) -> None:
    # an article's or main element's good text decides for its undecided blocks
    texts: dict[int, int] = {}
    for b in blocks:
        if b.inside and b.label in ("good", "near"):
            texts[b.inside] = texts.get(b.inside, 0) + len(b.text)
    for b in blocks:
        if b.inside in texts and b.label in ("short", "near"):
            b.label = "good"
        elif texts and not b.inside:
            b.label = "bad"
    if not texts and blocks and all(b.label in ("short", "bad") for b in blocks):
        for b in blocks:                # nothing decided: a page of short blocks
            if b.inside or (b.label == "short" and b.tag not in ("li", "td")):
                b.label = "good" if b.label == "short" else b.label
        return
    first = [b.label for b in blocks]
    for i, b in enumerate(blocks):
        if first[i] == "short":
            left, right = _sides(first, i, False)
            if left == right:
                b.label = left
            else:
                towards_bad = _sides(first, i, True)[0 if left == "bad" else 1]
                b.label = "good" if towards_bad == "near" else "bad"
    after = [b.label for b in blocks]
    for i, b in enumerate(blocks):
        if after[i] == "near":
            b.label = "bad" if _sides(after, i, False) == ("bad", "bad") and len(blocks) > 1 else "good"
    if not any(b.label == "good" for b in blocks):
        for b, was in zip(blocks, first, strict=True):
            b.label = "good" if was == "near" else b.label
    reach = HEADING_REACH + 1
    for b in reversed(blocks):
        if b.label == "good":
            reach = 0
        else:
            if b.tag in HEADINGS and not b.outside and reach <= HEADING_REACH and b.linked <= MAX_LINKS * len(b.text):
                b.label = "good"
            reach += len(b.text)


def main_text(page: str | None) -> str:
    """The main text of a page."""
    blocks = blocks_of(page or "")
    if len(blocks) == 1 and "<" not in (page or ""):
        return blocks[0].text
    _first_pass(blocks)
    _second_pass(blocks)
    return " ".join(b.text for b in blocks if b.label == "good")


def _extracted(batches):
    for batch in slices(batches, 2):
        texts = [main_text(p) for p in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
            ["page_id", "url", "text", "n_chars"])


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""
    return pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                        F.col(html_col).cast("string").alias("html")) \
        .mapInArrow(_extracted, "page_id long, url string, text string, n_chars long")
