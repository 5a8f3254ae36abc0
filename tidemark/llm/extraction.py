"""Main text of web pages by text-to-tag ratio.

The standard library's parser streams events; each block of a page becomes one line with its
text length and its number of tags. The ratios of text to tags are smoothed by a Gaussian, and
lines above a threshold form clusters; the cluster with most text, and what stands with it, is
the content region. Names of elements and classes only lower a line's ratio: they choose nothing.

A null or empty page, and one without text, has an empty text. Repeated rows are extracted each,
columns other than page_id, url and html are not looked at, and an empty table gives an empty result. Work and
memory are in proportion to the page, however deep its elements are nested.
"""

from __future__ import annotations

import re
from collections import Counter
from html.parser import HTMLParser

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.base import map_batches, table

# Element names of the HTML standard, and what authors call boilerplate or content.
NO_TEXT = frozenset("script style noscript template select textarea iframe svg math head title object canvas option".split())
ASIDE = frozenset("nav header footer aside form button dialog menu".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span "
    "strike strong sub sup time tt u var br wbr img".split()
)
REGIONS = frozenset("article main section div body html nav header footer aside form dialog menu".split())
ENDED_BY_THEIR_LIKE = frozenset("p li dt dd tr td th".split())
NOISE = re.compile(
    r"(?:^|[\s_-])(?:ad|ads|advert\w*|sponsor\w*|promo\w*|banner|nav\w*|menu\w*|sidebar\w*|footer|header|"
    r"masthead|breadcrumbs?|cookies?|notice\w*|consent|popup|modal|newsletter|subscribe|share|social|"
    r"comments?|replies|reply|related|recommend\w*|login|signup)(?:$|[\s_-])",
    re.I,
)
CONTENT = re.compile(r"(?:^|[\s_-])(?:article|entry|post|content|story|body|text|main)(?:$|[\s_-])", re.I)
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert".split())
SPACE = re.compile(r"\s+")

#: Width of the Gaussian in lines, and the share of the ratios' standard deviation as threshold.
SIGMA = 1.0
THRESHOLD = 0.5
#: What is left of the ratio of a line whose markup names it as something else than content.
NOISE_WEIGHT = 0.05
#: A line with more of its text in links than this is a list of links.
LINKS = 0.5


class Blocks(HTMLParser):
    """Lines of a page: text, number of tags, share in links, weight and region.

    Regions are numbered as they open; ``last`` is the highest number inside each, so whether one
    lies in another is a comparison. An unclosed ``p`` or ``li`` ends where the next block begins, and
    an end tag closes what is open within its element, so that broken markup does not swallow
    what follows.
    """

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.stack: list[tuple[str, int, float]] = []  # name, region, weight
        self.open: Counter = Counter()
        self.last: list[int] = [0]  # region 0 is the page
        self.lines: list[tuple[str, int, float, float, int]] = []
        self.parts: list[str] = []
        self.linked = 0
        self.tags = 1

    def here(self) -> tuple[int, float]:
        return self.stack[-1][1:] if self.stack else (0, 1.0)

    def end_block(self) -> None:
        raw = "".join(self.parts)
        text = SPACE.sub(" ", raw).strip()
        if text:
            region, weight = self.here()
            if weight > 0:
                self.lines.append((text, self.tags, min(1.0, self.linked / len(raw)), weight, region))
            self.tags = 1
        self.parts, self.linked = [], 0

    def pop(self, k: int) -> None:
        """Close the elements from the k-th open one on."""
        for name, region, _ in self.stack[k:]:
            self.open[name] -= 1
            self.last[region] = len(self.last) - 1
        del self.stack[k:]

    def weigh(self, tag: str, attrs: dict[str, str]) -> float:
        if tag in NO_TEXT or "hidden" in attrs or attrs.get("aria-hidden") == "true":
            return 0.0
        if "display:none" in attrs.get("style", "").replace(" ", ""):
            return 0.0
        # A header inside the article holds its title, not the site's.
        named = tag in ASIDE and not (tag == "header" and self.open["article"])
        named = named or attrs.get("role", "").lower() in NOISE_ROLES
        if tag not in ("html", "body", "article", "main"):
            names = [attrs.get(k, "") for k in ("class", "id")]
            named = named or any(NOISE.search(x) and not CONTENT.search(x) for x in names)
        return NOISE_WEIGHT if named else 1.0

    def handle_starttag(self, tag, attrs):
        self.tags += 1
        if tag == "br":
            self.parts.append(" ")
        if tag in VOID:
            if tag not in INLINE:
                self.end_block()
            return
        if tag not in INLINE:
            self.end_block()
            if tag in ENDED_BY_THEIR_LIKE and self.open[tag]:
                self.close_like(tag)
        region, outer = self.here()
        weight = min(outer, self.weigh(tag, {k: v or "" for k, v in attrs}))
        if weight != outer and tag in INLINE:
            self.end_block()
        if tag in REGIONS:
            self.last.append(len(self.last))
            region = len(self.last) - 1
        self.open[tag] += 1
        self.stack.append((tag, region, weight))

    def close_like(self, tag: str) -> None:
        """An open element of the same name ends here, unless a region or a list began inside it."""
        for k in range(len(self.stack) - 1, -1, -1):
            name = self.stack[k][0]
            if name == tag:
                self.pop(k)
                return
            if name in REGIONS or name in ("ul", "ol", "dl", "table", "blockquote"):
                return

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        self.tags += 1
        if tag not in INLINE:
            self.end_block()
        if not self.open[tag]:
            return
        for k in range(len(self.stack) - 1, -1, -1):
            name, _, weight = self.stack[k]
            if name == tag:
                outer = self.stack[k - 1][2] if k else 1.0
                if weight != outer:
                    self.end_block()
                self.pop(k)
                return
            if tag in INLINE and name not in INLINE:
                return

    def handle_data(self, data):
        self.parts.append(data)
        if self.open["a"]:
            self.linked += len(data)

    def finish(self, html: str) -> list:
        self.feed(html)
        self.close()
        self.end_block()
        self.pop(0)
        self.last[0] = len(self.last) - 1
        return self.lines


def smoothed(ratios: np.ndarray, sigma: float) -> np.ndarray:
    reach = max(1, int(round(3 * sigma)))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    weight = np.convolve(np.ones(len(ratios)), kernel)[reach : reach + len(ratios)]
    return np.convolve(ratios, kernel)[reach : reach + len(ratios)] / weight


def ratios_of(lines: list) -> np.ndarray:
    """Text outside links for each tag, lowered by what names the line."""
    return np.array([weight * len(text) * (1 - linked) / tags for text, tags, linked, weight, _ in lines])


def content(lines: list, last: list[int], ratios: np.ndarray, sigma: float, threshold: float) -> list[int]:
    """The lines of the content region.

    A line is dense if its smoothed ratio and its own reach the threshold. The cluster of dense
    lines with most text is the core, text counting as much as it does in the ratios, and the region
    that holds most of it is the content region. From the first to the last dense line inside
    that region all lines stay that are not named otherwise or links, for short paragraphs between
    long ones have low ratios too. Before and after, such lines stay if they stand in the region
    itself: a title, a short last paragraph.
    """
    if not len(lines):
        return []
    smooth = smoothed(ratios, sigma)
    limit = threshold * smooth.std() or smooth.max()
    if limit <= 0:
        return []
    dense = (smooth >= limit) & (ratios >= min(limit, ratios.max()))
    if not dense.any():
        dense = ratios == ratios.max()
    near = smooth >= limit
    mass_of = ratios * np.array([tags for _, tags, *_ in lines])
    best, mass, k = [], -1.0, 0
    while k < len(lines):
        if not near[k]:
            k += 1
            continue
        run = []
        while k < len(lines) and near[k]:
            if dense[k]:
                run.append(k)
            k += 1
        size = mass_of[run].sum() if run else -1.0
        if size > mass:
            best, mass = run, size
    if not best:
        best = np.flatnonzero(dense).tolist()[:1]
    held = Counter()
    for j in best:
        held[lines[j][4]] += mass_of[j]
    region = max(held, key=lambda r: (held[r], -r))
    inside = [j for j in range(len(lines)) if region <= lines[j][4] <= last[region]]
    core = [j for j in inside if dense[j]]

    def stays(j: int) -> bool:
        _, _, linked, weight, at = lines[j]
        return weight == 1.0 and linked <= LINKS and (core[0] < j < core[-1] or at == region)

    return [j for j in inside if dense[j] or stays(j)]


def main_text(html: str | None, sigma: float = SIGMA, threshold: float = THRESHOLD, ratios=ratios_of) -> str:
    """Blocks of the content region in page order, joined by newlines; empty if there are none."""
    if not html:
        return ""
    parser = Blocks()
    lines = parser.finish(html)
    chosen = content(lines, parser.last, ratios(lines), sigma, threshold)
    return "\n".join(lines[j][0] for j in chosen)


def extract(pages: DataFrame) -> DataFrame:
    """Main text of each row; a null page has none, repeated rows are extracted each."""

    def run(rows: dict) -> dict:
        texts = [main_text(x) for x in rows["html"]]
        return {"page_id": rows["page_id"], "url": rows["url"], "text": texts, "n_chars": [len(t) for t in texts]}

    rows = pages.select(F.col("page_id").cast("bigint"), F.col("url").cast("string"), "html")
    return map_batches(rows, run, "page_id bigint, url string, text string, n_chars bigint")


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))
