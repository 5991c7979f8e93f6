"""Main text of web pages by the distribution of text over lines.

Markup is stripped into one line per block element. Lines of menus, headers, footers, sidebars, notices, adverts, forms and reader
comments have no text; where the page marks its article, lines outside it are no article text either, but for the
heading before an article that has none of its own. All other lines weigh their length, except that lines of links weigh nothing.
Summed over windows of ``WINDOW`` lines these weights rise and fall along the page: the text is what lies between a surge point,
where the sums leave zero, and the dive point, where they are back at zero. So a line of links stays where text closely surrounds it,
and goes where it stands apart, as a menu does. There is no least weight: a short line far from the others may be a heading or the
article's end.

Pages are independent: one pass in Arrow batches, no shuffle. A page is read once from front to end in time that grows with its length.

Defined results: null or empty html, or html without text, gives empty text; an unclosed element ends with its parent, an unfinished
tag or comment with the page; repeated rows get equal results; extra columns stay, unless they have the name of a result column.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from spanlake.llm.common import prepare

# lines in a window
WINDOW = 3

# share of a line's text inside links from which it is an entry of a list of links
LINKED = 0.8

# Elements of HTML by their role.
SKIPPED = {"noscript", "template", "svg", "iframe", "object", "canvas", "audio", "video", "annotation", "annotation-xml"}
RAW = {"script", "style", "textarea", "title", "iframe", "noembed", "noframes", "xmp"}
BOILERPLATE = {"nav", "header", "footer", "aside", "form", "button", "select", "menu", "dialog", "label"}
VOID = {
    "area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr",
}
INLINE = {
    "a", "abbr", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd",
    "mark", "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr",
}
MAIN = {"article", "main"}
SECTIONS = {"html", "head", "body"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
# open elements that end where one of these begins; any other block ends a paragraph
ENDS = {
    "li": {"p", "li"}, "dt": {"p", "dt", "dd"}, "dd": {"p", "dt", "dd"}, "option": {"option"},
    "td": {"p", "td", "th"}, "th": {"p", "td", "th"}, "tr": {"p", "td", "th", "tr"},
    "tbody": {"p", "td", "th", "tr", "thead"}, "tfoot": {"p", "td", "th", "tr", "tbody"},
}
ROLES = {
    "alert", "alertdialog", "banner", "complementary", "contentinfo", "dialog", "form", "menu", "menubar", "navigation",
    "search", "toolbar",
}

# words of a class or id that mark a part as no article text, unless a modifier comes before (with-sidebar)
NOISE = re.compile(
    r"ad|ads|advert\w*|ads?(?:box|bygoogle|container|sense|slot|unit)|banner|breadcrumbs?|comments?|comment(?:list|area|box|form)|"
    r"cookies?|consent|disqus|footer|header|menu|modal|nav\w*|newsletter|notices?|pagination|popup|promo\w*|related|replies|"
    r"respond|share|sharing|sidebar|social|sponsor\w*|subscribe|toolbar|widget"
)
MODIFIERS = {"with", "without", "has", "have", "no", "not", "hide", "hides", "show", "shows"}
# classes of text itself: beside them only a whole class is noise, not a part of one (content sidebar-right)
CONTENT = {"article", "content", "entry", "main", "post", "story"}

TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)|<!--|<[!?]|</")
# a quote opens a value only after an equals sign
ATTRIBUTE = re.compile(r"""[\s/]*([^\s/>][^\s/>=]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]*)))?""")
COMMENT_END = re.compile(r"(?<=<!--)-?>|--!?>")
PARTS = re.compile(r"[_-]+")
SPACE = re.compile(r"\s+")
UNSEEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


def _noise(value: str, whole: bool) -> bool:
    """Whether one of the classes names a part that is no article text; ``whole``: only as a class of its own."""
    classes = value.lower().split()
    whole = whole or not CONTENT.isdisjoint(classes)
    for name in classes:
        parts = [part for part in PARTS.split(name) if not part.isdigit()]
        for part in parts:
            if part in MODIFIERS or whole and len(parts) > 1:
                break  # what follows tells how this part is laid out
            if NOISE.fullmatch(part):
                return True
    return False


def _hidden(attributes: dict[str, str]) -> bool:
    if "hidden" in attributes or attributes.get("aria-hidden", "").strip().lower() == "true":
        return True
    return bool(UNSEEN.search(attributes.get("style", "")))


def _noisy(tag: str, attributes: dict[str, str]) -> bool:
    """Whether an element is no article text by its role, class or id; a link never is."""
    if tag == "a":
        return False
    if not ROLES.isdisjoint(attributes.get("role", "").lower().split()):
        return True
    return any(_noise(attributes[name], tag in MAIN) for name in ("class", "id") if name in attributes)


@dataclass
class Line:
    """A block's text; whether it lies in a marked article, is a first-level heading, stands in a page header, or is all links."""

    text: str
    article: bool = False
    heading: bool = False
    header: bool = False
    links: bool = False


@dataclass
class _Open:
    """An open element; ``was`` is the state before it."""

    tag: str
    was: tuple[bool, bool, bool]


class _Page:
    """Lines of a page, read from front to end."""

    def __init__(self) -> None:
        self.lines: list[Line] = []
        self.stack: list[_Open] = []
        self.open: Counter[str] = Counter()
        # places of the blocks in the stack, and the inline elements open inside each
        self.blocks: list[int] = []
        self.inline: list[Counter[str]] = [Counter()]
        self.out = self.article = self.header = False
        self.parts: list[str] = []
        self.total = self.linked = self.links = 0

    def end_line(self) -> None:
        text = SPACE.sub(" ", html.unescape("".join(self.parts))).strip()
        prose = any(self.open[tag] for tag in HEADINGS) or self.open["p"] and not self.open["li"]
        listed = self.open["li"] or self.links > 1 and not prose
        links = bool(text and listed) and self.linked > LINKED * self.total and not self.article
        if self.out and (links or not (self.header and self.open["h1"])):
            text = ""
        self.lines.append(Line(text, self.article, self.open["h1"] > 0, self.out, links))
        self.parts.clear()
        self.total = self.linked = self.links = 0

    def add(self, text: str) -> None:
        if text and (not self.out or self.header and self.open["h1"]):
            self.parts.append(text)
            self.total += len(text)
            if self.open["a"]:
                self.linked += len(text)

    def leave(self, depth: int) -> None:
        """Close all open elements from this place of the stack on."""
        while len(self.stack) > depth:
            closed = self.stack.pop()
            self.open[closed.tag] -= 1
            self.out, self.article, self.header = closed.was
            if self.blocks and self.blocks[-1] == len(self.stack):
                self.blocks.pop()
                self.inline.pop()
            else:
                self.inline[-1][closed.tag] -= 1

    def close(self, tag: str) -> None:
        if tag in INLINE:
            if self.inline[-1][tag]:  # an inline element does not end the blocks inside it
                self.leave(self._place(tag))
            return
        self.end_line()
        if self.open[tag]:
            self.leave(self._place(tag))

    def _place(self, tag: str) -> int:
        depth = len(self.stack) - 1
        while self.stack[depth].tag != tag:
            depth -= 1
        return depth

    def start(self, tag: str, attributes: dict[str, str], closed: bool) -> None:
        if tag in VOID:
            if tag in ("br", "hr"):
                self.end_line()
            return
        inline = tag in INLINE
        if not inline:
            self.end_line()
            ended = ENDS.get(tag, {"p"})
            while self.blocks and self.stack[self.blocks[-1]].tag in ended:
                self.leave(self.blocks[-1])
        out, header = self.out, self.header
        if tag not in SECTIONS and (not out or header):
            hidden = tag in SKIPPED or _hidden(attributes)
            noisy = tag in BOILERPLATE or _noisy(tag, attributes)
            if tag == "header" and not out:
                header, noisy = not hidden and not self.article, not self.article
            elif hidden or noisy:
                header = False
            if hidden or noisy:
                if inline and not out:
                    self.add(" ")
                out = True
        if closed and tag in SKIPPED:
            return
        self.stack.append(_Open(tag, (self.out, self.article, self.header)))
        self.open[tag] += 1
        self.article = self.article or tag in MAIN and not out
        self.out, self.header = out, header
        self.links += tag == "a"
        if inline:
            self.inline[-1][tag] += 1
        else:
            self.blocks.append(len(self.stack) - 1)
            self.inline.append(Counter())


def lines(page: str) -> list[Line]:
    """One line per block, with empty ones for what is left out."""
    read, at = _Page(), 0
    while match := TAG.search(page, at):
        read.add(page[at : match.start()])
        at = match.end()
        closing, tag = match.groups()
        if tag is None:
            if match[0] == "<!--":
                end = COMMENT_END.search(page, at)
                at = end.end() if end else len(page)
            else:
                end = page.find(">", at)
                at = end + 1 if end >= 0 else len(page)
            continue
        tag, attributes = tag.lower(), {}
        while found := ATTRIBUTE.match(page, at):
            attributes.setdefault(found[1].lower(), found[2] or found[3] or found[4] or "")
            at = found.end()
        end = page.find(">", at)
        if end < 0:
            at = len(page)  # an unfinished tag
            break
        closed, at = page[at:end].rstrip().endswith("/"), end + 1
        if closing:
            read.close(tag)
        elif tag in RAW and not (closed and tag in SKIPPED):  # text up to the end of the element, whatever it looks like
            end = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(page, at)
            close = page.find(">", end.end()) if end else -1
            at = close + 1 if close >= 0 else len(page)
        else:
            read.start(tag, attributes, closed)
    read.add(page[at:])
    read.end_line()
    return read.lines


def candidates(found: list[Line]) -> list[bool]:
    """The lines that may be article text, lines of links among them."""
    marked = any(line.article and line.text for line in found)
    own = [bool(line.text) and not line.header and (line.article or not marked) for line in found]
    if not any(mine and line.heading and not line.links for mine, line in zip(own, found)):
        # the nearest heading before the text
        weight = weights(found, own)
        first = points(weight)[0] if any(weight) else len(found)
        for i in range(first - 1, -1, -1):
            if found[i].heading and found[i].text and not found[i].links:
                own[i] = True
                break
    return own


def weights(found: list[Line], own: list[bool] | None = None) -> list[int]:
    """Length of the lines that may be article text, 0 for lines of links and all others."""
    own = candidates(found) if own is None else own
    return [len(line.text) if mine and not line.links else 0 for line, mine in zip(found, own)]


def blocks(weight: list[int], window: int = WINDOW) -> list[tuple[int, int]]:
    """The lines from each surge point to its dive point, as ranges that begin and end with a line that weighs something."""
    sums, total = [], sum(weight[: window - 1])
    for i in range(len(weight)):
        total += weight[i + window - 1] if i + window - 1 < len(weight) else 0
        sums.append(total)
        total -= weight[i]
    surges = [i for i, s in enumerate(sums) if s and not (i and sums[i - 1])]
    dives = [i + 1 for i, s in enumerate(sums) if s and not (i + 1 < len(sums) and sums[i + 1])]
    # the first window may hold lines before its text
    return [(next(i for i in range(first, last) if weight[i]), last) for first, last in zip(surges, dives)]


def points(weight: list[int], window: int = WINDOW) -> tuple[int, int]:
    """The lines from the first surge point to the last dive point, as a range; an empty one without either."""
    found = blocks(weight, window)
    return (found[0][0], found[-1][1]) if found else (0, 0)


def main_text(page: str | None) -> str:
    """The text between the surge and the dive points."""
    if not page:
        return ""
    found = lines(page)
    own = candidates(found)
    ranges = blocks(weights(found, own))
    return " ".join(found[i].text for first, last in ranges for i in range(first, last) if own[i])


def extract(pages: DataFrame, markup: str = "html") -> DataFrame:
    """The input without its markup, with ``text`` and ``n_chars`` (code points)."""
    prepare(pages.sparkSession)
    keep = [f for f in pages.schema.fields if f.name.lower() not in (markup.lower(), "text", "n_chars")]
    schema = T.StructType([*keep, T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])
    names = [f.name for f in keep]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(x.as_py()) for x in batch.column(batch.num_columns - 1)]
            columns = [batch.column(i) for i in range(len(names))]
            columns += [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, "text", "n_chars"])

    return pages.select(*names, pages[markup].alias("_markup")).mapInArrow(run, schema)
