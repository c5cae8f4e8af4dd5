"""Main text of web pages by tag-path ratios.

Every leaf text has a path of tags from the root. Per path the text length
and the punctuation are added up and set against the number of its leaves:
menus and link lists have many leaves with little text and no sentences,
content paths the reverse. The ratios are smoothed over the leaves in page
order, both are fused into one score, and leaves above a threshold of the page
are content. The content region is the smallest element that holds most of
that text; headings and short paragraphs inside it belong to it, boilerplate
inside it (by element, role or class) does not.
"""

from __future__ import annotations

import html
import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from histoframe.llm.batches import steps

# Element names by the part they play.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
BOILERPLATE = frozenset("head nav footer aside form script style noscript template iframe button select option textarea svg canvas object dialog menu noembed noframes xmp title".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
#: Words in class or id that mark boilerplate, whole between separators.
MARKS = re.compile(
    r"(?:^|[\s_-])(?:ads?|adverts?|advertisement|advertising|sponsor(?:ed)?|promo(?:tion)?|banner|cookies?|consent|notice|gdpr|sidebar|side-bar|menu|navbar|nav|navigation|"
    r"breadcrumbs?|footer|site-header|page-header|masthead|header|share|sharing|social|related|recommended|newsletter|subscribe|signup|login|comments?|commentlist|disqus|replies|popup|modal|overlay|pagination|pager|widget|toolbar)(?:$|[\s_-])",
    re.I,
)
_HEADERS = frozenset(("header",))

_MARKUP = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?>\"[^\"]*\"|'[^']*'|[^'\">])*)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|<[!?/][^>]*>", re.S)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
_PUNCTUATION = re.compile(r"[.,;:!?…。，、；：！？¿¡]")

#: Elements that an opening tag of the same group closes, and what it can't reach beyond.
_CLOSES = {"p": ("p",), "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
_BARRIER = frozenset("article aside body blockquote dl div fieldset figure footer form header html main nav ol section table td th ul".split())

#: Leaves on each side that smooth a leaf's ratio, and the share of the mean score that a content leaf reaches.
SMOOTH, CUT = 2, 0.5
#: Share of the content leaves' text that the content region holds.
REGION = 0.9


class _Element:
    __slots__ = ("name", "parent", "path", "skipped", "in_article")

    def __init__(self, name: str, parent: _Element | None, attributes: str) -> None:
        self.name, self.parent = name, parent
        self.path = f"{parent.path}/{name}" if parent else name
        self.in_article = name in ("article", "main") or bool(parent and parent.in_article)
        self.skipped = bool(parent and parent.skipped) or self._is_boilerplate(attributes)

    def _is_boilerplate(self, attributes: str) -> bool:
        if self.name in BOILERPLATE or (self.name == "header" and not self.in_article):
            return True
        if not attributes or self.name in ("html", "body", "article", "main"):
            return False
        for m in _ATTRIBUTE.finditer(attributes):
            key, value = m[1].lower(), (m[2] or "").strip("\"'")
            if key == "hidden" or (key == "role" and value.lower() in ROLES) or (key == "aria-hidden" and value.lower() == "true"):
                return True
            if key in ("class", "id") and MARKS.search(value):
                return True
        return False


def leaves(page: str) -> list[tuple[_Element, int, str]]:
    """Text leaves of a page in order: element, number of the block, text with references decoded."""
    root = _Element("#root", None, "")
    stack, out, block, at, size = [root], [], 0, 0, len(page)

    def text_to(end: int) -> None:
        if end > at and not page[at:end].isspace():
            out.append((stack[-1], block, html.unescape(page[at:end])))
        elif end > at and out:
            out.append((stack[-1], block, " "))

    while at < size:
        m = _MARKUP.search(page, at)
        text_to(m.start() if m else size)
        if not m:
            break
        at = m.end()
        name = (m[2] or m[5] or "").lower()
        if not name:
            continue
        closing, attributes = m[1] or m[4], m[3] or m[6] or ""
        if name not in INLINE:
            block += 1
        elif name == "br" and out:
            out.append((stack[-1], block, " "))
        if closing:
            depth = next((i for i in range(len(stack) - 1, 0, -1) if stack[i].name == name), 0)
            if depth:
                del stack[depth:]
        elif name in RAW:
            end = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*>", re.I).search(page, at)
            at = end.end() if end else size
        elif name not in VOID:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].name in _CLOSES.get(name, ()):
                    del stack[i:]
                    break
                if stack[i].name in _BARRIER:
                    break
            if not attributes.endswith("/"):
                stack.append(_Element(name, stack[-1], attributes))
    return out


def path_scores(found: list[tuple[_Element, int, str]]) -> np.ndarray:
    """Fused score of each leaf: smoothed text and punctuation ratios of its path."""
    length, marks, nodes = defaultdict(float), defaultdict(float), defaultdict(int)
    for element, _, text in found:
        length[element.path] += len(text.strip())
        marks[element.path] += len(_PUNCTUATION.findall(text))
        nodes[element.path] += 1
    paths = [e.path for e, _, _ in found]
    text_ratio = np.array([length[p] / nodes[p] for p in paths])
    mark_ratio = np.array([(marks[p] + 0.1) / nodes[p] for p in paths])
    kernel = np.exp(-0.5 * (np.arange(-SMOOTH, SMOOTH + 1) / max(1, SMOOTH / 2)) ** 2)

    def smooth(values: np.ndarray) -> np.ndarray:
        near = np.convolve(values, kernel)[SMOOTH : SMOOTH + len(values)]
        return near / np.convolve(np.ones(len(values)), kernel)[SMOOTH : SMOOTH + len(values)]

    return np.sqrt(smooth(text_ratio) * smooth(mark_ratio))


def main_text(page: str | None) -> str:
    """Main text of one page: its blocks in order, joined by an empty line."""
    every = leaves(page or "")
    found = [x for x in every if not x[0].skipped]
    solid = [x for x in found if x[2].strip()]
    if not solid:
        return ""
    scores = path_scores(solid)
    content = [x for x, s in zip(solid, scores, strict=True) if s >= CUT * scores.mean()]
    weight, held = sum(len(t) for *_, t in content), defaultdict(int)
    for element, _, text in content:
        while element is not None:
            held[element] += len(text)
            element = element.parent
    region = max((e for e in held if held[e] >= REGION * weight and e.name not in INLINE and e.name != "p"), key=lambda e: e.path.count("/"))

    def inside(element: _Element | None) -> bool:
        while element is not None and element is not region:
            element = element.parent
        return element is region

    known: dict[_Element, bool] = {}
    blocks = defaultdict(list)
    for element, block, text in found:
        if element not in known:
            known[element] = inside(element)
        if known[element]:
            blocks[block].append(text)
    return "\n\n".join(t for t in (" ".join("".join(parts).split()) for _, parts in sorted(blocks.items())) if t)


def extract_main_text(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) of every page, from the whole html.

    A null or empty html, or one without text, gives an empty text. Repeated
    rows and null ids or urls give a row each; further columns are left out;
    an empty table gives an empty result.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, "html"):
            texts = [main_text(h) for h in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], names=["page_id", "url", "text"])

    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    return rows.mapInArrow(run, "page_id long, url string, text string").withColumn("n_chars", F.length("text").cast("long"))
