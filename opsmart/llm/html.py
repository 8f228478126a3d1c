"""Main text of web pages by scoring the element tree.

A page becomes a tree of elements. Parts that never belong to an article - menus, headers, footers,
sidebars, notices, adverts, forms, scripts, comments - are left out by tag, role or the words of
their class and id. Every paragraph then passes points to its ancestors, one plus one per comma and
per hundred characters (three at most), whole to the parent, half to the grandparent, a third of the
rest upwards; a container's points are discounted by the share of its text that stands in links. The
best container (the ``<article>`` or ``<main>`` around it, if there is one) and its siblings are the
article, but for siblings that are lists of links, or boxes without a paragraph at either end. Its
text is written block by block.

Inside the article a part goes for its tag, role or a whole name of its class or id that says it is a
side part (``share``, ``comments-section``); one word of a name (``section-header``, ``related-work``)
does not decide there. So text of the article is never dropped for its length or its links.

Parsing is one linear pass over the page, with attributes read as HTML's tokenizer does; a quoted value
of any length ends at its quote. Unclosed, crossed and missing tags are closed as browsers do. A quote
that never closes is an ordinary character.

Defined results: a null or empty page, and one without text outside the parts left out, gives the
empty text; rows are judged one by one, so repeated rows repeat; other columns are not read.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_right
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opsmart.llm.common import map_rows, table

# Elements by what they mean for parsing and for the text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp noembed noframes iframe".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup "
    "option p pre search section summary table tbody td tfoot th thead tr ul caption br".split()
)
LEFT_OUT = frozenset(
    "script style noscript template head title nav aside footer header form button select textarea "
    "input label fieldset iframe object embed svg canvas audio video dialog menu search xmp noembed "
    "noframes map math".split()
)
CLOSES_P = BLOCKS - {"br", "body", "html", "td", "th", "tr", "tbody", "thead", "tfoot", "caption"}
SAME_CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table", "tbody", "thead", "tfoot"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
# Words of a class or id, and roles, that mark parts outside the article.
SIDE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising adbox adsense sponsor sponsored promo promotion "
    "banner nav navbar navigation menu menubar breadcrumb breadcrumbs crumbs header masthead topbar "
    "footer foot sidebar aside rail widget widgets related recommended recommendations popular "
    "trending share sharing social cookie cookies consent gdpr notice notices notification alert "
    "popup modal overlay dialog newsletter subscribe subscription signup login comment comments "
    "commentlist disqus respond reply replies discussion reactions pagination pager paging toolbar "
    "search searchbox form skip copyright legal disclaimer tags taglist outbrain taboola hidden "
    "paywall".split()
)
SIDE_ROLES = frozenset(
    "navigation banner contentinfo complementary search dialog alertdialog alert menu menubar form "
    "toolbar".split()
)
# Words that make a class name say something of a page's layout; and words of parts that
# may be longer than the article.
LAYOUT_WORDS = frozenset("with without no has have layout".split())
NEVER_MAIN = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo cookie cookies consent gdpr notice "
    "notices popup modal overlay newsletter subscribe comment comments commentlist disqus respond reply "
    "replies discussion reactions related recommended hidden".split()
)
MAIN_TAGS = frozenset({"html", "body", "article", "main"})
SCORED = frozenset("p pre td blockquote li dd".split())
#: Siblings of the best container that belong to it wherever they stand.
BESIDE = frozenset(
    "h1 h2 h3 h4 h5 h6 p pre blockquote figure figcaption dl ul ol table b i em strong span a br code".split()
)

# Words that add nothing to the name of a side part; side words that also name parts of an
# article, and the words that settle them.
FILLING = frozenset(
    "list lists box boxes wrapper wrap container area block inner outer item items bar links link button "
    "buttons icon icons section content top bottom left right sticky fixed floating primary secondary main "
    "post posts article articles story stories entry page site global user reader row col column".split()
)
AMBIGUOUS = frozenset(
    "header footer foot form search notice alert legal tags skip banner reply replies response respond dialog "
    "overlay hidden reactions discussion notices comment recommendations menu login".split()
)
PLACES = frozenset("page site global top bottom main left right bar wrapper container box list".split())

_NAME = re.compile(r"/?[A-Za-z][^\s/>]*")
# The end of a tag, or an attribute with its value as HTML's tokenizer reads it.
_ATTRIBUTE = re.compile(
    r"""[\s/]*+(?:(>)|([^\s/>][^\s/>=]*+)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s>"'][^\s>]*+))?)?)"""
)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")
_NO_DISPLAY = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


class Element:
    __slots__ = ("tag", "parent", "parts", "side", "out", "mark", "score", "chars", "linked")

    def __init__(self, tag: str, parent: Element | None, side: bool):
        self.tag, self.parent, self.side, self.out = tag, parent, side, side
        self.mark = 0
        self.parts: list[Element | str] = []
        self.score = 0.0
        self.chars = self.linked = 0


def is_side(tag: str, attributes: dict[str, str]) -> bool:
    """Whether this element is by its tag, role or visibility outside any article."""
    if tag in LEFT_OUT:
        return True
    if not attributes or tag in MAIN_TAGS:
        return False
    return (
        "hidden" in attributes
        or attributes.get("role", "").strip().lower() in SIDE_ROLES
        or attributes.get("aria-hidden", "").strip().lower() == "true"
        or _NO_DISPLAY.search(attributes.get("style", "")) is not None
    )


def _whole_name(pieces: list[str]) -> bool:
    """Whether all of a name says that it is a side part."""
    side = [p for p in pieces if p in SIDE_WORDS]
    rest = [p for p in pieces if p not in SIDE_WORDS and not p.isdigit()]
    return bool(side) and FILLING.issuperset(rest) and (PLACES.issuperset(rest) or not AMBIGUOUS.issuperset(side))


def side_mark(tag: str, attributes: dict[str, str]) -> int:
    """What class and id say: 0 nothing, 1 a side part by one word, 2 one that is never the article;
    4 is added if a whole name says so."""
    if tag in MAIN_TAGS:
        return 0
    mark = sure = 0
    for name in f"{attributes.get('class', '')} {attributes.get('id', '')}".split():
        pieces = []
        for word in re.split(r"[_:.-]+", name):
            pieces += [word.lower()] if word.lower() in SIDE_WORDS else [p.lower() for p in _WORD.findall(word)]
        side = [i for i, p in enumerate(pieces) if p in SIDE_WORDS]
        if side and LAYOUT_WORDS.isdisjoint(pieces[: side[0]]):
            mark = max(mark, 2 if any(pieces[i] in NEVER_MAIN for i in side) else 1)
            sure = sure or 4 * _whole_name(pieces)
    return mark + sure


def _exclude(root: Element) -> None:
    """Marked elements go, unless they hold the main element, the largest article or most paragraphs."""
    elements = _order(root)
    points, chars = {}, {}
    for e in reversed(elements):
        own = sum(len(p) - p.count(" ") - p.count("\n") for p in e.parts if isinstance(p, str))
        chars[e] = chars.get(e, 0) + own
        block = e.tag in SCORED or e.tag in ("div", "section") and own >= 25
        points[e] = points.get(e, 0) + (1 + min(chars[e] // 100, 3) if block and chars[e] >= 25 else 0)
        if e.parent is not None:
            chars[e.parent] = chars.get(e.parent, 0) + chars[e]
            points[e.parent] = points.get(e.parent, 0) + points[e]
    held = set()
    mains = [e for e in elements if e.tag == "main"] or [e for e in elements if e.tag == "article"]
    if mains:
        up = max(mains, key=chars.__getitem__)
        while up is not None:
            held.add(up)
            up = up.parent
    for e in elements:
        most = points[e] * 2 > points[root]
        kind = e.mark & 3
        e.out = kind == 1 and not (most or e in held) or kind == 2 and not (most and e in held)


def _attributes(page: str, at: int) -> tuple[dict[str, str], int, bool]:
    """The attributes of the tag whose name ends at ``at``, where the tag ends (-1: nowhere), and
    whether it closes itself."""
    found: dict[str, str] = {}
    unquoted = -1
    while match := _ATTRIBUTE.match(page, at):
        at = match.end()
        if match[1]:
            return found, at, page[at - 2] == "/" and unquoted != at - 1
        value = match[3] or match[4] or match[5] or ""
        found.setdefault(match[2].lower(), html.unescape(value) if "&" in value else value)
        unquoted = at if match[5] else -1
    return found, -1, False


def parse(page: str) -> Element:
    """The element tree of a page."""
    root = Element("html", None, False)
    path, at, size = [root], 0, len(page)
    opened: dict[str, list[int]] = {}  # by tag the depths at which it is open

    def leave(depth: int) -> None:
        """Close everything from a depth on."""
        while len(path) > depth:
            opened[path.pop().tag].pop()

    while at < size:
        here = path[-1]
        start = page.find("<", at)
        if start < 0:
            start = size
        if start > at:
            here.parts.append(page[at:start])
        if start == size:
            break
        if page.startswith("<!--", start):
            end = page.find("-->", start + 2)
            at = size if end < 0 else end + 3
            continue
        if page.startswith(("<!", "<?"), start):
            end = page.find(">", start)
            at = size if end < 0 else end + 1
            continue
        name = _NAME.match(page, start + 1)
        if not name:
            here.parts.append("<")
            at = start + 1
            continue
        attributes, end, closed = _attributes(page, name.end())
        if end < 0:
            break
        tag, at = name[0].lower(), end
        if tag[0] == "/":
            tag = tag[1:]
            if opened.get(tag):
                leave(opened[tag][-1])
            elif tag in ("p", "br"):
                here.parts.append(" ")
            continue
        if tag in ("html", "body"):
            continue
        if tag in CLOSES_P and opened.get("p"):
            leave(opened["p"][-1])
        elif tag in SAME_CLOSES:
            closing, borders = SAME_CLOSES[tag]
            border = max((opened[t][-1] for t in borders if opened.get(t)), default=0)
            first = [d[bisect_right(d, border) :][:1] for d in (opened.get(t, ()) for t in closing)]
            if any(first):
                leave(min(d[0] for d in first if d))
        here = path[-1]
        element = Element(tag, here, here.side or is_side(tag, attributes))
        element.mark = side_mark(tag, attributes) if attributes else 0
        here.parts.append(element)
        if tag in VOID or closed and tag not in BLOCKS and tag not in RAW:
            continue
        if tag in RAW:
            close = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(page, at)
            if not close:
                break
            if not element.side:
                element.parts.append(page[at : close.start()])
            end = page.find(">", close.end())
            at = size if end < 0 else end + 1
            continue
        opened.setdefault(tag, []).append(len(path))
        path.append(element)
    return root


def _order(root: Element) -> list[Element]:
    """Elements that may belong to an article, parents first."""
    found = [root]
    for element in found:
        found += [p for p in element.parts if not isinstance(p, str) and not p.out]
    return found


def _measure(elements: list[Element]) -> None:
    """Text and linked text of every element, children included, and the points of paragraphs."""
    commas: dict[int, int] = {}
    for e in reversed(elements):
        own = [p for p in e.parts if isinstance(p, str)]
        size = sum(len(p) - p.count(" ") - p.count("\n") for p in own)
        comma = sum(p.count(",") + p.count("،") + p.count("、") + p.count("，") for p in own)
        e.chars += size
        if e.tag == "a":
            e.linked = e.chars
        commas[id(e)] = commas.get(id(e), 0) + comma
        if e.parent is not None:
            e.parent.chars += e.chars
            e.parent.linked += e.linked
            commas[id(e.parent)] = commas.get(id(e.parent), 0) + commas[id(e)]
        text_block = e.tag in SCORED or (e.tag in ("div", "section") and size >= 25)
        if text_block and e.chars >= 25:
            points = 1 + commas[id(e)] + min(e.chars // 100, 3)
            share, up, level = 1.0, e.parent, 0
            while up is not None and level < 6:
                up.score += points * share
                level += 1
                share = 0.5 if level == 1 else 1 / (3 * level)
                up = up.parent


def density(e: Element) -> float:
    return e.linked / e.chars if e.chars else 0.0


def article(root: Element) -> list[Element | str]:
    """The best container with its siblings and the text between them, in page order."""
    _exclude(root)
    elements = _order(root)
    _measure(elements)
    best, most = None, 0.0
    for e in elements:
        if e.tag in ("p", "li", "a", "span", "b", "i", "em", "strong"):
            continue
        points = e.score * (1 - density(e))
        if e.tag in ("article", "main"):
            points *= 1.5
        if points > most:
            best, most = e, points
    if best is None:
        return [root]
    whole = best
    while whole is not None and whole.tag not in ("article", "main"):
        whole = whole.parent
    if whole is not None:
        return [whole]
    if best.parent is None:
        return [best]
    near = [p for p in best.parent.parts if p is best or isinstance(p, str) or not (p.out or _link_list(p))]
    real = [p is best or not isinstance(p, str) and _holds_text(p) for p in near]
    first, last = real.index(True), len(real) - real[::-1].index(True)
    return [p for i, p in enumerate(near) if first <= i < last or isinstance(p, str) or p.tag in BESIDE]


def _holds_text(e: Element) -> bool:
    """Whether a sibling holds a paragraph: it scores, or is one."""
    return density(e) < 0.5 and (e.score > 0 or e.tag in SCORED and e.chars >= 25)


def _link_list(e: Element) -> bool:
    """Lists and boxes that are links and little else."""
    return e.tag in ("ul", "ol", "div", "section", "table", "dl", "p") and e.chars > 0 and density(e) > 0.6


def _write(e: Element | str, out: list[str]) -> None:
    """The text of a part of the article, with a blank at the borders of blocks; depth costs no
    recursion. What its tag, role or a whole name marks as a side part is dropped, nothing else."""
    if isinstance(e, str):
        out.append(e)
        return
    stack: list[tuple[Element, int]] = [(e, 0)]
    while stack:
        e, at = stack.pop()
        block = e.tag in BLOCKS
        if not at and block:
            out.append(" ")
        while at < len(e.parts):
            part = e.parts[at]
            at += 1
            if isinstance(part, str):
                out.append(part)
            elif not (part.side or part.out and part.mark & 4):
                stack.append((e, at))
                stack.append((part, 0))
                break
        else:
            if block:
                out.append(" ")


def main_text(page: str) -> str:
    """The main text of a page."""
    out: list[str] = []
    for e in article(parse(page)):
        _write(e, out)
        out.append(" ")
    return " ".join(html.unescape("".join(out)).split())


def _rows(rows: Iterator[tuple]) -> Iterator[tuple]:
    for page_id, url, page in rows:
        text = main_text(page) if page else ""
        yield page_id, url, text, len(text)


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` of every row."""
    return map_rows(
        pages.select("page_id", "url", F.col("html")),
        "page_id long, url string, text string, n_chars long",
        _rows,
    )


def op9_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return extract(table(spark, sf_dir, "pages"))
