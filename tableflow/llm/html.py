"""Main text of web pages: parser events, text-to-tag ratios, Gaussian smoothing and threshold clustering."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tableflow.llm.common import table

# Elements of HTML.
_CONTAINERS = set(
    "html body article main section div nav header footer aside form ul ol dl table blockquote figure dialog menu "
    "details fieldset button select textarea noscript template iframe object svg canvas math head title script style "
    "center search".split()
)
_BLOCKS = _CONTAINERS | set("p h1 h2 h3 h4 h5 h6 li dt dd tr td th caption pre address hr legend figcaption summary".split())
_VOID = set("area base br col embed hr img input link meta source track wbr".split())
_NEVER_TEXT = set(
    "nav footer aside form dialog menu button select textarea noscript template iframe object svg canvas math head title "
    "script style search".split()
)
_ROLES = set("navigation banner contentinfo complementary search alert alertdialog dialog form menu menubar status".split())
# Names that pages give to parts that are not the article, as words of a class or an id.
_BOILERPLATE = set(
    "nav navbar navigation menu header masthead topbar footer sidebar aside ad ads advert adverts advertisement advertising "
    "adsense banner promo promotion sponsor sponsored cookie cookies consent gdpr notice notices alert popup modal overlay "
    "newsletter subscribe subscription signup login share sharing social comment comments commentlist commentary reply "
    "replies respond discussion disqus breadcrumb breadcrumbs related recommended recommendations widget pagination pager "
    "search toolbar copyright skip hidden toc teaser".split()
)
_ARTICLE_BUT = set("comment comments reply replies related recommended teaser ad ads advert promo sponsored".split())
# Of these, words that also name sections of an article: in one, they count only where the text is sparse too.
_SECTIONS = set("related discussion commentary search notice notices toc".split())
# Next to one of the latter, words for the people who write there: then it is no section of the article.
_PEOPLE = set("user users reader readers visitor visitors member members guest guests forum thread threads post posts".split())
_HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")


def _names(value: str) -> set[str]:
    """The words of a class or id value, but for those that ``has``, ``with`` or ``no`` stands before."""
    found: set[str] = set()
    for name in value.split():
        words = [w.lower() for w in _WORDS.findall(name)]
        found.update(w for before, w in zip(["", *words], words) if before not in ("has", "with", "no"))
    return found


def _is_boilerplate(tag: str, attrs: list[tuple[str, str | None]], in_article: bool) -> bool | None:
    """Whether an element is named or known as boilerplate; None if its text has to tell."""
    if tag in _NEVER_TEXT or (tag == "header" and not in_article):
        return True
    if not attrs or tag in ("html", "body", "main"):
        return False
    given = {name: value or "" for name, value in attrs}
    if "hidden" in given or given.get("aria-hidden") == "true" or "display:none" in given.get("style", "").replace(" ", ""):
        return True
    # The id of an article's heading is commonly made of its text.
    named = "" if in_article and tag in _HEADINGS else given.get("id", "")
    names = _names(f"{given.get('class', '')} {named}")
    if tag == "article":
        return bool(names & _ARTICLE_BUT)
    if in_article:
        # The head of an article is its title, not the page's header.
        names -= {"header"}
    found = names & _BOILERPLATE
    if given.get("role", "") in _ROLES or (found and not (in_article and found <= _SECTIONS and not names & _PEOPLE)):
        return True
    return None if found else False


class _Lines(HTMLParser):
    """Turns parser events into lines, one for each block: its container, text and number of tags."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.stack: list[tuple[str, int, bool]] = [("", 0, False)]
        self.parent, self.tag = [0], [""]
        self.doubted = [False]
        self.lines: list[tuple[int, bool, str, int, bool]] = []
        self.heading = False
        self.text: list[str] = []
        self.tags = 0
        self.in_article = 0
        self.open: dict[str, int] = {}

    def break_line(self) -> None:
        if self.text or self.tags:
            _, container, bad = self.stack[-1]
            self.lines.append((container, bad, " ".join("".join(self.text).split()), self.tags, self.heading))
            self.text, self.tags = [], 0

    def close_from(self, at: int) -> None:
        self.break_line()
        for tag, _, _ in self.stack[at:]:
            self.in_article -= tag in ("article", "main")
            self.open[tag] -= 1
        del self.stack[at:]

    def handle_starttag(self, tag, attrs):
        if tag in _BLOCKS:
            self.break_line()
            # A block ends an open paragraph, and a list item or cell the one before it.
            top = self.stack[-1][0]
            if top == "p" or (top == tag and tag in ("li", "dt", "dd", "tr", "td", "th")):
                self.close_from(len(self.stack) - 1)
            self.heading = tag in _HEADINGS
        self.tags += 1
        if tag == "br":
            self.text.append(" ")
        if tag in _VOID:
            return
        bad = _is_boilerplate(tag, attrs, self.in_article > 0)
        if bad or bad is None or tag in _CONTAINERS:
            if bad is not False and tag not in _BLOCKS:
                self.break_line()
            _, container, above = self.stack[-1]
            self.parent.append(container)
            self.tag.append(tag)
            self.doubted.append(bad is None)
            self.stack.append((tag, len(self.parent) - 1, bool(bad) or above))
            self.in_article += tag in ("article", "main")
            self.open[tag] = self.open.get(tag, 0) + 1

    def handle_startendtag(self, tag, attrs):
        if tag in _VOID:
            self.handle_starttag(tag, attrs)
        else:
            self.tags += 1

    def handle_endtag(self, tag):
        self.tags += 1
        if self.open.get(tag):
            at = len(self.stack) - 1
            while self.stack[at][0] != tag:
                at -= 1
            self.close_from(at)
        elif tag in _BLOCKS:
            self.break_line()
        if tag in _HEADINGS:
            self.heading = False

    def handle_data(self, data):
        self.text.append(data)

    # What is opened and never closed reaches to the end of the page, as in a browser, and is read once. The library
    # would take it for text, look for its end at each place it might begin, and stop at declarations it does not know.
    def _rest(self, i: int, close: str, after: int) -> int:
        at = self.rawdata.find(close, i + after)
        return len(self.rawdata) if at < 0 else at + len(close)

    def parse_comment(self, i, report=1):
        # ``<!-->`` and ``<!--->`` are whole comments.
        for short in ("<!-->", "<!--->"):
            if self.rawdata.startswith(short, i):
                return i + len(short)
        return self._rest(i, "-->", 4)

    def parse_html_declaration(self, i):
        if self.rawdata.startswith("<!--", i):
            return self.parse_comment(i)
        if self.rawdata.startswith("<![CDATA[", i):
            return self._rest(i, "]]>", 9)
        return self._rest(i, ">", 2)

    def parse_pi(self, i):
        return self._rest(i, ">", 2)

    def parse_endtag(self, i):
        if self.rawdata.find(">", i + 2) < 0:
            return len(self.rawdata)
        return super().parse_endtag(i)

    def parse_starttag(self, i):
        if self.rawdata.find(">", i + 1) < 0 or self.check_for_whole_start_tag(i) < 0:
            return len(self.rawdata)
        return super().parse_starttag(i)


#: Gaussian weights over neighbouring lines.
_KERNEL = np.exp(-0.5 * np.arange(-2, 3) ** 2)
_KERNEL /= _KERNEL.sum()


def _content_lines(parser: _Lines) -> list[str]:
    lines = [line for line in parser.lines if not line[1] and line[2]]
    if not lines:
        return []
    ratio = np.array([len(text) / max(1, tags) for _, _, text, tags, _ in lines])
    smooth = np.convolve(np.pad(ratio, 2, mode="edge"), _KERNEL, mode="valid")
    # Two clusters, parted at the deviation of the smoothed ratios; a page without any contrast is one cluster.
    least = min(smooth.std(), smooth.max())
    high = smooth >= least

    # Characters of the lines in the high cluster under each container; children come after their parents.
    weight, whole = np.zeros(len(parser.parent)), np.zeros(len(parser.parent))
    for (container, _, text, _, _), is_high in zip(lines, high):
        weight[container] += len(text) * is_high
        whole[container] += len(text)
    for child in range(len(weight) - 1, 0, -1):
        weight[parser.parent[child]] += weight[child]
        whole[parser.parent[child]] += whole[child]
    sparse = np.array(parser.doubted) & (2 * weight < whole)

    regions: set[int] = set()
    direct = -1
    for kind in ("article", "main"):
        named = [i for i, tag in enumerate(parser.tag) if tag == kind and weight[i] > 0]
        if named:
            regions = set(named)
            break
    else:
        # The deepest container that holds nearly all of it: its own lines, and the parts below it that hold any.
        heavy = {parser.parent[i]: i for i in range(1, len(weight)) if weight[i] >= 0.9 * weight[0]}
        direct = 0
        while direct in heavy:
            direct = heavy[direct]
        regions = {i for i in range(1, len(weight)) if parser.parent[i] == direct and weight[i] > 0}
        # A part of short lines between two that stay belongs to the text.
        part = list(range(len(weight)))
        for i in range(1, len(weight)):
            if parser.parent[i] != direct:
                part[i] = part[parser.parent[i]]
        tops = [part[line[0]] if line[0] != direct else direct for line in lines]
        kept = [at for at, (top, is_high) in enumerate(zip(tops, high)) if top in regions or (top == direct and is_high)]
        if kept:
            regions.update(top for top in tops[kept[0] : kept[-1]] if parser.parent[top] == direct and top != direct)

    inside, in_main = np.zeros(len(weight), bool), np.zeros(len(weight), bool)
    for i, parent in enumerate(parser.parent):
        inside[i] = i in regions or (i > 0 and inside[parent])
        in_main[i] = parser.tag[i] == "main" or (i > 0 and in_main[parent])
        sparse[i] |= i > 0 and sparse[parent]
    return [
        text
        for (container, _, text, _, heading), dense in zip(lines, high & (ratio >= least))
        if not sparse[container] and (inside[container] or container == direct or ((heading or dense) and in_main[container]))
    ]


def main_text(html: str | None) -> str:
    """The article of a page: its blocks in page order, one to a line; empty if there is none."""
    if not html:
        return ""
    parser = _Lines()
    parser.feed(html)
    parser.close()
    parser.break_line()
    return "\n".join(_content_lines(parser))


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [main_text(html.as_py()) for html in batch.column(2)]
        sizes = pa.array([len(t) for t in texts], pa.int64())
        yield pa.record_batch(
            [batch.column(0), batch.column(1), pa.array(texts, pa.string()), sizes], names=["page_id", "url", "text", "n_chars"]
        )


def extract_pages(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` of every row of ``pages`` (``page_id``, ``url``, ``html``).

    Navigation, forms, scripts and parts named as boilerplate go with their whole subtree. The remaining lines get the
    ratio of their characters to their tags; ratios are smoothed over neighbours and parted in two clusters; the
    containers that hold the high cluster are the content regions, and every line in them is kept, short ones too. Where
    articles are the regions, the headings and the lines of the high cluster of ``main`` around them are kept as well.
    Words that also name sections of an article (``related``, ``discussion``) are boilerplate there only where most of the
    text is in the low cluster or people are named with them (``user-discussion``), and ids of its headings never are.
    What is opened and not closed (a comment, a tag) reaches to the end of the page, and any markup is read in linear time.
    A null or empty page has an empty text. Repeated rows give repeated results; other columns are ignored.
    """
    return pages.select("page_id", "url", "html").mapInArrow(_extract, "page_id long, url string, text string, n_chars long")


def op2_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pages(table(spark, sf_dir, "pages"))
