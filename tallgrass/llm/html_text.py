"""Main text of web pages by line-block distribution.

Markup is stripped into lines, one for each block; elements that hold menus, headers, footers, sidebars, notices,
adverts, forms, scripts, styles or comments leave a run of blank lines instead. The lengths of ``WINDOW`` lines are
added up at every line; text surges where that sum rises from nothing and dives where it falls back to nothing, and
every stretch between that has a line of other text than links is kept whole, short lines included. Menus count as
blank: lines that are links for the most part, if they follow one another, make up a list or hold several links; a
lone link among other text is text.

Names are evidence that sets lines to blank, and what is kept follows from the distribution. A class or id marks an
element as furniture if a whole name of it does, apart from words of layout (ad-slot, site-header, but not
has-comments), and then all that it holds, up to its end or the end that HTML implies; the longest article or main
element of a page and what holds it are never furniture. Article and main elements are believed if they hold at least
as much text as the longest stretch outside of them: then lines outside are blank, and lines of links inside are text.
Otherwise they are teasers or comments beside the text, and blank themselves.

Defined cases: null or empty html gives empty text; unclosed markup ends with the element around it or with the page,
and so do unclosed comments, scripts and styles; quotes that never end are ordinary characters; only page_id, url and
html are read; rows are handled one by one, so ties and repeated rows do not matter. A page takes time in proportion to
its length.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

#: Lines in a block sum; removed elements leave as many blank lines, so that sums fall to nothing there.
WINDOW = 3
#: A line of which links are more than this share is a line of links.
LINKS = 0.6

SCHEMA = "page_id long, url string, text string, n_chars long"

# Elements by what they do to the text.
RAW = "script style noscript template iframe svg math canvas object audio video textarea select title"
CHROME = "nav header footer aside form menu dialog button fieldset"
BLOCKS = (
    "address article aside blockquote body br button caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre search section summary "
    "table tbody td tfoot th thead tr ul"
)
VOID = "area base br col embed hr img input link meta param source track wbr"
ROLES = "navigation banner contentinfo complementary search form alert dialog menu menubar"
#: Elements whose end is implied by the next one of these, up to the element that holds them.
ITEMS = {"li": "li", "dt": "dt dd", "dd": "dt dd", "tr": "tr", "td": "td th", "th": "td th", "option": "option"}
HOLDERS = "ul ol dl dir menu table select"
#: Words of class and id names that mark what is not the article.
MARKS = (
    "ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent "
    "cookie cookies copyright disclaimer disqus footer header masthead menu modal nav navbar navigation newsletter notice "
    "pagination popup promo promoted recommended related replies respond share sharing sidebar signup skip social sponsor "
    "sponsored subscribe toolbar widget"
)
#: Words that may stand beside those in a name, for they say where or how an element is laid out and not what it holds.
LAYOUT = (
    "area bar block bottom box btn button center col column container content footer form global group head header holder icon "
    "icons inner item items js left level line link links list main mobile outer overlay panel primary right row secondary "
    "section site slot sticky sub top unit wrap wrapper"
)

_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"'=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+'|(?![\"'\s]))|[\"'])*+)>")
#: For pages with a quote that never ends.
_PLAIN_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/<>]*+)([^<>]*+)>")
_ATTRIBUTE = re.compile(r"([^\s=/>\"']++)\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s>]++))")
_WORD = re.compile(r"[a-z]+")
_RAW_ENDS = {name: re.compile(rf"</{name}\b[^>]*+>", re.I) for name in RAW.split()}
#: Of these nothing else but their end is markup; others that never end are ordinary elements.
_TO_THE_END = frozenset(("script", "style", "textarea", "title"))
_CHROME, _BLOCKS, _VOID, _ROLES, _MARKS, _HOLDERS = (frozenset(x.split()) for x in (CHROME, BLOCKS, VOID, ROLES, MARKS, HOLDERS))
_ITEMS = {name: frozenset(x.split()) for name, x in ITEMS.items()}
_LAID_OUT = _MARKS | frozenset(LAYOUT.split())
_HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
_HEADERS = frozenset(("header", "masthead", "banner"))  # these hold titles in an article and in such parts of a page:
_PARTS = frozenset(("content", "section", "item", "group", "box"))
_LISTS = frozenset(("ul", "ol", "dl", "dir"))
_ARTICLES = frozenset(("article", "main"))
_CONTENT = frozenset(("main", "body", "html"))
#: An open paragraph ends where one of these begins.
_END_PARAGRAPH = _BLOCKS - {"br", "button", "option", "head", "body", "html"}


def _is_chrome(name: str, attributes: str, in_article: bool) -> bool:
    if name in _CHROME and not (name == "header" and in_article):
        return True
    if not attributes or name in _CONTENT:
        return False
    for kind, *values in _ATTRIBUTE.findall(attributes):
        kind = kind.lower()
        if kind not in ("class", "id", "role"):
            continue
        value = "".join(values).lower()
        if kind == "role":
            if value in _ROLES:
                return True
        elif not (name in _HEADINGS and kind == "id"):  # which names what the heading says
            for own in map(_WORD.findall, value.split()):
                marks = _MARKS - _HEADERS if in_article or name in _HEADINGS or _PARTS.intersection(own) else _MARKS
                if marks.intersection(own) and _LAID_OUT.issuperset(own):
                    return True
    return False


def _pieces(page: str) -> Iterator[tuple[str, str, str, str]]:
    """Text, and the tag that ends it: its slash, name and attributes (empty at the end of the page).

    Comments and elements that hold no text are left out.
    """
    at, start, last, pattern = 0, page.find("<"), page.rfind(">"), _TAG
    endless = set()  # elements of which no further end comes
    while 0 <= start < last:
        kind = page[start + 1]
        if kind in "!?":
            end = page.find("-->", start + 4) if page.startswith("<!--", start) else -2
            if page.startswith("<![CDATA[", start):
                end = page.find("]]>", start)
            if end == -2:
                end = page.find(">", start)
                stop = end + 1
            else:
                stop = end + 3
            yield page[at:start], "", "", ""
            if end < 0:
                return
            at, start = stop, page.find("<", stop)
            continue
        found = pattern.match(page, start) if kind == "/" or kind.isalpha() else None
        if found is None and pattern is _TAG and (kind.isalpha() or kind == "/" and page[start + 2 : start + 3].isalpha()):
            pattern = _PLAIN_TAG
            found = pattern.match(page, start)
        if found is None:
            start = page.find("<", start + 1)
            continue
        closing, name, attributes = found[1], found[2].lower(), found[3]
        end = found.end()
        if name in _RAW_ENDS:
            stop = None if closing or name in endless or attributes.endswith("/") else _RAW_ENDS[name].search(page, end)
            if stop is None and not closing and not attributes.endswith("/"):
                endless.add(name)
            if stop is not None or not closing and name in _TO_THE_END:
                yield page[at:start], "", "", ""
                if stop is None:
                    return
                end = stop.end()
                at, start = end, page.find("<", end)
                continue
        yield page[at:start], closing, name, attributes
        at, start = end, page.find("<", end)
    yield page[at:], "", "", ""


class _Page:
    """Texts and the beginnings and ends of elements, implied ends included, in order."""

    def __init__(self, page: str):
        self.events: list[tuple[str, str, str]] = []  # text; or name and attributes
        self.ends: dict[int, int] = {}  # of each element's beginning: the event after it
        self.open: list[tuple[str, int]] = []
        self.count: Counter[str] = Counter()
        self.items: list[list[int]] = [[]]  # of each open list or table, how deep its open items are
        self.paragraph = -1  # how deep the open paragraph is
        for text, closing, name, attributes in _pieces(page):
            if text:
                self.events.append((text, "", ""))
            if name == "a":
                self.events.append(("", "/a" if closing else "a", ""))
            elif name in _BLOCKS or name == "span":
                self.end(name) if closing else self.begin(name, attributes)
        while self.open:
            self.pop()

    def pop(self) -> str:
        name, at = self.open.pop()
        self.count[name] -= 1
        self.ends[at] = len(self.events)
        depth = len(self.open)
        if self.paragraph == depth:
            self.paragraph = -1
        if name in _HOLDERS and len(self.items) > 1:
            self.items.pop()
        while self.items[-1] and self.items[-1][-1] >= depth:
            self.items[-1].pop()
        if name in _BLOCKS:
            self.events.append(("", "/", name))
        return name

    def cut(self, depth: int) -> None:
        while len(self.open) > depth:
            self.pop()

    def begin(self, name: str, attributes: str) -> None:
        if name in _END_PARAGRAPH and self.paragraph >= 0:
            self.cut(self.paragraph)
        if name in _ITEMS:
            own = self.items[-1]
            for k, depth in enumerate(own):
                if self.open[depth][0] in _ITEMS[name]:
                    self.cut(depth)
                    del own[k:]
                    break
        at = len(self.events)
        self.events.append(("", name, attributes))
        if name in _VOID or attributes.endswith("/"):
            self.ends[at] = at + 1
            return
        depth = len(self.open)
        self.open.append((name, at))
        self.count[name] += 1
        if name == "p":
            self.paragraph = depth
        if name in _ITEMS:
            self.items[-1].append(depth)
        if name in _HOLDERS:
            self.items.append([])

    def end(self, name: str) -> None:
        if name == "span":  # ends within its block
            if self.open and self.open[-1][0] == "span":
                self.pop()
        elif self.count[name]:
            while self.pop() != name:
                pass
        else:
            self.events.append(("", "/", name))

    def article(self) -> int:
        """The beginning of the article or main element with the most text, the inner one of equal ones, or -1."""
        upto, total = [], 0
        for text, _, _ in self.events:
            upto.append(total)
            total += len(text.strip())
        upto.append(total)
        sizes = [(upto[self.ends[k]] - upto[k], k) for k, (_, name, _) in enumerate(self.events) if name in _ARTICLES]
        return max(sizes)[1] if sizes else -1


def _collapsed(words: list[str]) -> str:
    return " ".join(entities.unescape("".join(words)).split())


#: Text, characters of it in links, number of links, number of the list that it is in (0: none), and if in an article
#: or main element.
Line = tuple[str, int, int, int, bool]
BLANK: Line = ("", 0, 0, 0, False)


def _lines(html: str) -> list[Line]:
    """A line of each block; blank where an element was removed."""
    page = _Page(html)
    own_article = page.article()
    lines: list[Line] = []
    words: list[str] = []
    in_links: list[list[str]] = []  # the words of each link of the line
    lists: list[int] = []  # numbers of the lists that are open
    n_lists = articles = 0
    link = False

    def end_line() -> None:
        nonlocal words, in_links
        if text := _collapsed(words):
            own = [len(x) for x in map(_collapsed, in_links) if x]
            lines.append((text, sum(own), len(own), lists[-1] if lists else 0, articles > 0))
        words, in_links = [], [[]] if link else []

    k, events = 0, page.events
    while k < len(events):
        text, name, attributes = events[k]
        k += 1
        if text:
            words.append(text)
            if link:
                in_links[-1].append(text)
        elif name == "a":
            link = True
            in_links.append([])
        elif name == "/a":
            link = False
        elif name == "/":  # of a block
            end_line()
            if attributes in _LISTS and lists:
                lists.pop()
            elif attributes in _ARTICLES:
                articles = max(0, articles - 1)
        else:
            end = page.ends[k - 1]
            if not k - 1 <= own_article < end and name not in _VOID and _is_chrome(name, attributes, articles > 0):
                link = False
                end_line()
                lines.extend([BLANK] * WINDOW)
                # The event after an element is the end of its block, which has no beginning then.
                k = max(k, end + (end < len(events) and events[end][1] == "/" and events[end][2] == name))
                continue
            if name in _BLOCKS:
                end_line()
            if name in _LISTS:
                n_lists += 1
                lists.append(n_lists)
            elif name in _ARTICLES:
                articles += 1
    end_line()
    return lines


def _menus(lines: list[Line], of_links: list[bool]) -> list[bool]:
    """Which of the lines of links are menus and not links among other text."""
    menus, k = [False] * len(lines), 0
    while k < len(lines):
        end = k + 1
        if of_links[k]:
            while end < len(lines) and of_links[end]:
                end += 1
            own = lines[k][3]
            around = {lines[j][3] for j in (k - 1, end) if 0 <= j < len(lines)}
            menus[k:end] = [end - k > 1 or lines[k][2] > 1 or own > 0 and own not in around] * (end - k)
        k = end
    return menus


def stretches(sizes: list[int]) -> list[tuple[int, int]]:
    """From where the sum of ``WINDOW`` sizes surges from nothing to where it dives back to nothing."""
    sums, total = [], 0  # of WINDOW lines from each on
    for k in range(len(sizes) - 1, -1, -1):
        total += sizes[k] - (sizes[k + WINDOW] if k + WINDOW < len(sizes) else 0)
        sums.append(total)
    sums.reverse()
    found, begun = [], None
    for k, block in enumerate([*sums, 0]):
        if block and begun is None:
            begun = k  # surge
        elif not block and begun is not None:
            found.append((begun, k))  # dive
            begun = None
    return found


def main_text(page: str | None) -> str:
    if not page:
        return ""
    lines = _lines(page)
    inside = [own for *_, own in lines]
    of_links = [linked > LINKS * len(text) for text, linked, *_ in lines]
    sizes = [0 if menu else len(line[0]) for line, menu in zip(lines, _menus(lines, of_links))]
    if any(inside):
        marked = [len(line[0]) if own else 0 for line, own in zip(lines, inside)]
        others = [0 if own else size for size, own in zip(sizes, inside)]
        longest = max((sum(others[a:b]) for a, b in stretches(others)), default=0)
        believed = sum(marked) >= longest
        sizes = marked if believed else others
        of_links = [linked and not (believed and own) for linked, own in zip(of_links, inside)]
    kept = [k for a, b in stretches(sizes) if any(sizes[j] and not of_links[j] for j in range(a, b)) for k in range(a, b) if sizes[k]]
    return "\n".join(lines[k][0] for k in kept)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in (batch.slice(k, 500) for k in range(0, batch.num_rows, 500)):
            texts = [main_text(x.as_py()) for x in part.column(2)]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars (code points of text) of every row of ``pages``."""
    return pages.select("page_id", "url", "html").mapInArrow(_extract, SCHEMA)
