"""Main text of HTML pages by text-to-tag ratios.

The standard library's parser gives events; nothing is held but the lines they make. A
line is a block of text: it ends where a block element begins or ends. For each line the
ratio of text characters to tags is taken, the row of ratios is smoothed with a Gaussian,
and lines over a threshold (``DEVIATIONS`` standard deviations of the ratios from zero)
form the content clusters. The clusters choose the content region: the deepest element
that holds most of the clusters' text, or the article around it. All of the region's lines
are its text, short ones too, apart from two or more lines in a row outside the clusters whose
text is links only, such as a list of links beside the paragraphs, and from what is never content: scripts, styles,
navigation, headers and footers of the page, asides, forms, and elements named by class, id or
role as menus, adverts, notices, sidebars or comments of readers. The clusters also overrule a
name: an element that holds nearly all of their text (``MOST``) is the page's frame, whatever it
is called, as in ``<div class="page sidebar-left">``.

Character references are decoded, also without a semicolon. White space inside a line
becomes one space; lines are joined by one. A tag that is cut off at the end of the page
is not text; a declaration of any form ends at the next ``>``. Nulls and pages without content
give the empty text; null ids are kept. Repeated rows each get a row; an empty table gives none.
"""

from __future__ import annotations

import re
from collections import Counter
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SIGMA = 1.5
DEVIATIONS = 0.5
MOST = 0.9

# The elements of HTML that matter here.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section select summary "
    "table tbody td template tfoot th thead title tr ul".split()
)
_NEVER = frozenset(
    "script style noscript template head title nav aside form iframe object svg canvas button select textarea input "
    "dialog menu footer".split()
)
#: An open element of these ends where another of its group begins.
_ENDS = {"p": _BLOCK - {"br"}, "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]),
         "option": frozenset(["option"]), "tr": frozenset(["tr"]), "td": frozenset(["td", "th", "tr"]), "th": frozenset(["td", "th", "tr"])}
_HOLDS = frozenset("article aside body div dl footer form header html main nav ol section table td ul".split())
_NAMED = re.compile(
    r"(?:^|[^a-z])(?:ads?|adverts?|advertisements?|advertising|sponsor(?:ed|s)?|promo(?:tion)?s?|banners?|nav|navbar|navigation|menus?|"
    r"breadcrumbs?|sidebars?|side-?bar|aside|footers?|site-?header|page-?header|masthead|topbar|cookies?|consent|gdpr|notices?|alerts?|"
    r"popups?|modals?|overlay|newsletters?|subscribe|signup|login|comments?|comment-?list|respond|replies|disqus|discussion|share|sharing|"
    r"social|related|recommended|widgets?|toolbar|pagination|pager|copyright)(?:$|[^a-z])"
)
_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
_KEPT = frozenset(["html", "body", "main", "article"])
#: Names that say what a frame has or lacks: "has-sidebar", "no-menu".
_BESIDE = re.compile(r"(?<![a-z])(?:has|with|no|without)[-_]+[a-z]+")


class _Lines(HTMLParser):
    """Lines of text with the number of tags in each, and the open elements they stand in."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, int, bool]] = []  # tag, element number, inside what is never content
        self.parents, self.tags, self.named = [-1], ["#"], [False]
        self.lines: list[tuple[str, int, int, bool]] = []  # text, tags, element, links only
        self.parts: list[str] = []
        self.count = self.links = self.plain = 0
        # Open elements by tag, and those since each open container, so that an end tag without
        # a beginning costs one look.
        self.tally: Counter[str] = Counter()
        self.since: list[Counter[str]] = [Counter()]

    def _line(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text or self.count:
            self.lines.append((text, self.count, self.open[-1][1] if self.open else 0, self.links > 0 and not self.plain))
        self.parts, self.count, self.links, self.plain = [], 0, 0, 0

    def _never(self, tag: str, named: dict[str, str | None]) -> bool:
        if tag in _NEVER:
            return True
        if tag == "header":
            return not self.tally["article"]
        if tag in _KEPT:
            return False
        return "hidden" in named or (named.get("aria-hidden") or "").lower() == "true"

    def _beside(self, tag: str, named: dict[str, str | None]) -> bool:
        """Whether its name says that an element stands beside the content."""
        if tag in _KEPT:
            return False
        if (named.get("role") or "").lower() in _ROLES:
            return True
        names = f"{named.get('class') or ''} {named.get('id') or ''}".strip()
        if not names:
            return False
        names = re.sub(r"(?<=[a-z0-9])(?=[A-Z])", "-", names).lower()
        return bool(_NAMED.search(_BESIDE.sub("", names)))

    def handle_starttag(self, tag, attrs):
        while self.open and tag in _ENDS.get(self.open[-1][0], ()):
            self._close()
        if tag in _BLOCK:
            self._line()
        self.count += 1
        if tag in _VOID:
            return
        above = self.open[-1] if self.open else ("#", 0, False)
        named = dict(attrs)
        never = above[2] or self._never(tag, named)
        self.parents.append(above[1])
        self.tags.append(tag)
        self.named.append(not never and self._beside(tag, named))
        self.open.append((tag, len(self.parents) - 1, never))
        self.tally[tag] += 1
        if tag in _HOLDS:
            self.since.append(Counter())
        else:
            self.since[-1][tag] += 1

    def _close(self) -> None:
        tag = self.open[-1][0]
        if tag in _BLOCK:
            self._line()
        self.open.pop()
        self.tally[tag] -= 1
        if tag in _HOLDS:
            self.since.pop()
        else:
            self.since[-1][tag] -= 1

    def handle_endtag(self, tag):
        # An end tag of a part doesn't reach out of its container.
        if (self.tally if tag in _HOLDS else self.since[-1])[tag] > 0:
            while self.open[-1][0] != tag:
                self._close()
            self._close()
        self.count += 1

    def handle_data(self, data):
        if self.open and self.open[-1][2]:
            return
        self.parts.append(data)
        if not data.isspace():
            if self.tally["a"]:
                self.links += 1
            else:
                self.plain += 1

    def parse_comment(self, i, report=1):
        for empty in ("<!-->", "<!--->"):
            if self.rawdata.startswith(empty, i):
                return i + len(empty)
        return super().parse_comment(i, report)

    def parse_html_declaration(self, i):
        if self.rawdata.startswith("<!--", i):
            return self.parse_comment(i)
        end = self.rawdata.find(">", i)
        return end + 1 if end >= 0 else -1

    def close(self):
        if self.rawdata.startswith("<"):  # cut off inside a tag
            self.rawdata = ""
        super().close()
        self._line()


def smoothed(values: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    """Each value as the Gaussian mean of its surroundings, ends weighted by what is there."""
    reach = int(3 * sigma)
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    full = np.convolve(values, kernel)[reach : reach + len(values)]
    return full / np.convolve(np.ones(len(values)), kernel)[reach : reach + len(values)]


def clusters(lengths: np.ndarray, tags: np.ndarray) -> np.ndarray:
    """Which lines are content by their smoothed ratio of text to tags."""
    if not len(lengths):
        return np.zeros(0, dtype=bool)
    ratios = lengths / np.maximum(1, tags)
    return (smoothed(ratios) >= DEVIATIONS * ratios.std()) & (lengths > 0)


def _weights(parser: _Lines, kept: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which of the lines kept are in clusters, and the clusters' text within every element."""
    lengths = np.array([len(text) for text, *_ in parser.lines], float)
    tags = np.array([n for _, n, *_ in parser.lines], float)
    content = np.zeros(len(lengths), dtype=bool)
    content[kept] = clusters(lengths[kept], tags[kept])
    elements = np.array([element for _, _, element, _ in parser.lines], dtype=np.int64)
    weight = np.bincount(elements[content], lengths[content], minlength=len(parser.parents))
    for element in range(len(parser.parents) - 1, 0, -1):  # children come after their parents
        weight[parser.parents[element]] += weight[element]
    return content, weight


def _within(parser: _Lines, chosen: list[bool]) -> np.ndarray:
    """Which lines stand in one of the elements chosen."""
    inside = list(chosen)
    for element in range(1, len(parser.parents)):
        inside[element] = inside[element] or inside[parser.parents[element]]
    return np.array([inside[element] for _, _, element, _ in parser.lines], dtype=bool)


def _region(parser: _Lines, weight: np.ndarray) -> int:
    """The deepest container with most of the clusters' text, or the article around it."""
    best = 0
    for element in range(1, len(parser.parents)):
        if parser.tags[element] in _HOLDS and weight[element] >= MOST * weight[0] > 0:
            best = element
    around, above = best, best
    while above >= 0:
        if parser.tags[above] == "article":
            around = above
        above = parser.parents[above]
    return around


def main_text(html: str | None) -> str:
    if not html:
        return ""
    parser = _Lines()
    parser.feed(html)
    parser.close()
    if not any(text for text, *_ in parser.lines):
        return ""
    everything = np.ones(len(parser.lines), dtype=bool)
    if any(parser.named):
        _, weight = _weights(parser, everything)
        beside = [named and not weight[e] >= MOST * weight[0] > 0 for e, named in enumerate(parser.named)]
        everything &= ~_within(parser, beside)
    content, weight = _weights(parser, everything)
    region = _region(parser, weight)
    kept = everything & _within(parser, [element == region for element in range(len(parser.parents))])
    shown = [i for i, (text, *_) in enumerate(parser.lines) if text and kept[i]]
    # Lines of links only that lie outside the clusters; one by itself belongs to the text around it.
    away = [parser.lines[i][3] and not content[i] for i in shown]
    lists = [off and (any(away[max(0, n - 1) : n]) or any(away[n + 1 : n + 2])) for n, off in enumerate(away)]
    return " ".join(parser.lines[i][0] for i, dropped in zip(shown, lists) if not dropped)


def _extract(batches):
    for batch in batches:
        texts = [main_text(html) for html in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
            names=["page_id", "url", "text", "n_chars"],
        )


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars), one row for each page."""
    rows = pages.select(F.col(id_col).cast("long"), F.col(url_col), F.col(html_col))
    return rows.mapInArrow(_extract, "page_id long, url string, text string, n_chars long")
