"""Main text of HTML pages by tree scoring.

A page is read into a tree with the usual repairs (void elements, implied ends, unclosed markup). Elements that are
never article text are left out while reading: scripts, styles, forms, navigation, and whatever calls itself an
advert, a menu, a notice or a comment. Each paragraph earns points for its length and commas and passes them on to its
ancestors, half as much with each step; a container's points are discounted by the part of its text that is links. The
best container is kept, with its siblings unless links make up a quarter of them and they score little; a container
inside an ``article`` or ``main`` stands for the whole of it. Lists and blocks that are mostly links are left out.

Each run of text between block boundaries is one line: references decoded, white space made one space, trimmed.

A page is read in time proportional to its length, whatever its markup: an end that was looked for and not found is
remembered, and open elements are found by name.

Defined results: null and empty pages, and pages without text, have an empty text. Unclosed tags, comments and scripts
end with the page; a tag without its ``>`` is text; an unwanted element that is never closed ends where the page's first
``article`` or ``main`` starts. A broken page gives what can be read. Repeated pages are extracted alike, one row each.
Equal scores go to the container that starts first. Extra columns are not looked at. An empty table gives an empty result.
"""

from __future__ import annotations

import html
import re

from pyspark.sql import DataFrame, SparkSession

from sparkwarden.llm.common import map_texts, table

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
DROPPED = frozenset(
    "script style noscript template head title nav footer aside form button select option textarea iframe svg math object "
    "canvas audio video map dialog menu datalist".split()
)
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
WHOLE = frozenset(("article", "main"))
PARAGRAPHS = frozenset("p pre blockquote td li dd".split()) | frozenset(("#run",))
# What an open element is ended by, up to the element that holds it.
ENDED_BY = {
    "li": (frozenset(("li",)), frozenset(("ul", "ol"))),
    "dt": (frozenset(("dt", "dd")), frozenset(("dl",))),
    "dd": (frozenset(("dt", "dd")), frozenset(("dl",))),
    "tr": (frozenset(("tr", "td", "th")), frozenset(("table",))),
    "td": (frozenset(("td", "th")), frozenset(("tr", "table"))),
    "th": (frozenset(("td", "th")), frozenset(("tr", "table"))),
}
# Words in class, id and role that name what is not the article.
UNWANTED = frozenset(
    "ad ads adbox advert adverts advertisement advertising alert alerts banner banners breadcrumb breadcrumbs comment comments commentlist "
    "complementary consent contentinfo cookie cookies copyright dialog disclaimer discussion disqus footer form gdpr hidden login masthead menu "
    "menus modal nav navbar navigation newsletter notice notices notification notifications pager pagination popular popup promo promoted promotion recommended "
    "related replies reply respond search share sharing sidebar signup skip social sponsor sponsored subscribe subscription "
    "toc toolbar topbar trending widget widgets".split()
)
RELATIONS = frozenset("has no with without".split())
# Names that inline elements of an article may well have.
COMMON = frozenset("alert dialog form hidden menu notice popular related search share".split())
_NAME_OF_TAG = re.compile(r"[a-zA-Z][^\s/>]*")
_MARK = re.compile(r"[>\"']")
_COMMENT_END = re.compile(r"--!?>")
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")
_SPACE = re.compile(r"\s+")
_COMMA = re.compile(r"[,،、，;；]")


class Scanner:
    """Tags of a page in order, each part of the page read a bounded number of times."""

    def __init__(self, page: str) -> None:
        self.page = page
        # The next mark, the next ``>``: found from ``*_from`` on, at the page's end if there is none.
        self.mark_from = self.gt_from = 0
        self.mark = self.gt = -1
        # Opening quotes that lead to no ``>``, from whatever tag they are reached.
        self.dead: set[int] = set()

    def _next_gt(self, at: int) -> int:
        if not self.gt_from <= at <= self.gt:
            found = self.page.find(">", at)
            self.gt_from, self.gt = at, found if found >= 0 else len(self.page)
        return self.gt

    def _first_mark(self, at: int) -> int:
        if not self.mark_from <= at <= self.mark:
            found = _MARK.search(self.page, at)
            self.mark_from, self.mark = at, found.start() if found else len(self.page)
        return self.mark

    def _tag_end(self, at: int) -> int:
        """Where the ``>`` of a tag is, outside of quotes; -1 if there is none."""
        page, size, seen = self.page, len(self.page), []
        mark = self._first_mark(at)
        while mark < size:
            if page[mark] == ">":
                return mark
            if mark in self.dead:
                break
            seen.append(mark)
            shut = page.find(page[mark], mark + 1)
            found = _MARK.search(page, shut + 1) if shut >= 0 else None
            if found is None:
                break
            mark = found.start()
        self.dead.update(seen)
        return -1

    def next(self, at: int) -> tuple[int, int, str, bool, str] | None:
        """Start, end, name, whether it is an end tag, and attributes of the next tag or (no name) comment."""
        page, size = self.page, len(self.page)
        while (start := page.find("<", at)) >= 0:
            at = start + 1
            if page.startswith("<!--", start):
                if page.startswith((">", "->"), start + 4):
                    return start, page.index(">", start) + 1, "", False, ""
                found = _COMMENT_END.search(page, start + 4)
                return start, found.end() if found else size, "", False, ""
            ends = page.startswith("/", at)
            if named := _NAME_OF_TAG.match(page, at + ends):
                stop = self._tag_end(named.end())
                if stop >= 0:
                    return start, stop + 1, named[0].lower(), ends, page[named.end() : stop]
            if page.startswith(("!", "?", "/"), at) and (stop := self._next_gt(at + 1)) < size:
                return start, stop + 1, "", False, ""
        return None

    def raw_end(self, tag: str, at: int) -> tuple[int, int]:
        """Where the text of an element without markup ends, and where its end tag does."""
        found = re.compile(f"</{tag}(?=[\\s/>])", re.IGNORECASE).search(self.page, at)
        stop = self._next_gt(found.end()) if found else len(self.page)
        return (found.start(), stop + 1) if stop < len(self.page) else (len(self.page), len(self.page))


class Node:
    """An element that bounds blocks. ``items``: nodes, and runs as [parts of text, characters in links]."""

    __slots__ = ("tag", "up", "items", "points", "size", "linked", "links", "order")

    def __init__(self, tag: str, up: Node | None, order: int) -> None:
        self.tag, self.up, self.order = tag, up, order
        self.items: list = []
        self.points = 0.0
        self.size = self.linked = self.links = 0


def _unwanted(tag: str, attributes: str, inside: bool) -> bool:
    if tag in DROPPED or (tag == "header" and not inside):
        return True
    if not attributes or tag in ("html", "body") or tag in WHOLE and "comment" not in attributes:
        return False
    found = {m[0].lower(): m[1] or m[2] or m[3] for m in _ATTRIBUTE.findall(attributes)}
    style = found.get("style", "").replace(" ", "").lower()
    if "hidden" in found or found.get("aria-hidden") == "true" or "display:none" in style or "visibility:hidden" in style:
        return True
    for name in (n for k in ("class", "id", "role") for n in found.get(k, "").split()):
        words = [w.lower() for w in _NAME.findall(name)]
        # "article-comments" and "comment-list" name comments; "content-with-sidebar" is no sidebar.
        said = {words[0], words[-1]} if words and not RELATIONS.intersection(words) else set()
        if said & UNWANTED and not (inside and tag in INLINE and said <= COMMON) or (not inside and "header" in said):
            return True
    return False


def parse(page: str) -> Node:
    """The tree of blocks of a page, without what is never article text."""
    root = now = Node("#root", None, 0)
    scanner = Scanner(page)
    # Open elements: tag, its node or None for inline ones; and their places by tag.
    open_: list[tuple[str, Node | None]] = [("#root", root)]
    places: dict[str, list[int]] = {}
    run: list | None = None
    links = inside = count = 0
    at, end = 0, len(page)
    skip = ""
    depth = 0
    # The first article inside what is skipped, in case that is never closed; looked for once.
    article, rescue = -1, True

    def add(text: str) -> None:
        nonlocal run
        if run is None:
            if not text.strip():
                return
            run = [[], 0]
            now.items.append(run)
        run[0].append(text)
        if links:
            run[1] += len(text.strip())

    def close(position: int) -> None:
        nonlocal now, run, links, inside
        for tag, node in reversed(open_[position:]):
            places[tag].pop()
            if tag == "a":
                links -= 1
            if tag in WHOLE:
                inside -= 1
            if node is not None:
                now, run = node.up, None
        del open_[position:]

    def last(tags, walls=frozenset()) -> int:
        found = 0
        for tag in tags:
            if (held := places.get(tag)) and held[-1] > found:
                found = held[-1]
        if found:
            for tag in walls:
                if (held := places.get(tag)) and held[-1] > found:
                    return 0
        return found

    def hold(tag: str, node: Node | None) -> None:
        places.setdefault(tag, []).append(len(open_))
        open_.append((tag, node))

    while True:
        token = scanner.next(at) if at < end else None
        if not token and skip and article >= 0:
            at, skip, depth, article, rescue = article, "", 0, -1, False
            continue
        text = page[at : token[0]] if token else page[at:]
        if text and not skip:
            add(html.unescape(text) if "&" in text else text)
        if not token:
            break
        start, at, tag, ends, attributes = token
        if not tag:
            continue
        if tag in RAW and not ends:
            stop, after = scanner.raw_end(tag, at)
            if not skip and tag == "xmp":
                add(page[at:stop])
            at = after
            continue
        if skip:
            # Inside an unwanted element only its own tag counts.
            if tag == skip:
                depth += -1 if ends else 1
                if not depth:
                    skip = ""
                continue
            if tag in WHOLE and not ends and not places.get("article"):
                if rescue and article < 0:
                    article = start
                if rescue or skip in RAW:
                    continue
            else:
                closes = ends and tag in ("body", "html", "article", "main") and last((tag,))
                if closes and article >= 0:
                    at, skip, depth, article, rescue = article, "", 0, -1, False
                    continue
                if not closes and not (not ends and skip == "p" and tag not in INLINE):
                    continue
            skip, depth = "", 0
        if ends:
            if tag == "p" and not last(("p",)):
                run = None
                continue
            if i := last((tag,)):
                close(i)
            continue
        if tag == "br" or tag == "wbr" or tag == "img":
            if tag == "br" and run is not None:
                run[0].append(" ")
            continue
        if tag not in INLINE:
            if i := last(("p",)):
                close(i)
            if tag in HEADINGS and (i := last(HEADINGS, frozenset(("div", "section")) | WHOLE)):
                close(i)
            if tag in ENDED_BY and (i := last(*ENDED_BY[tag])):
                first = i
                while open_[first - 1][0] in ENDED_BY[tag][0]:
                    first -= 1
                close(first)
        if tag in VOID:
            run = None
            continue
        if tag == "body" or tag == "html":
            # A head that was never closed ends here.
            continue
        if attributes.endswith("/") and tag not in INLINE and tag in DROPPED:
            continue
        if _unwanted(tag, attributes, inside > 0):
            skip, depth, article = tag, 1, -1
            if tag not in INLINE:
                run = None
            continue
        if tag in INLINE:
            if tag == "a":
                if i := last(("a",)):
                    close(i)
                links += 1
            hold(tag, None)
            continue
        count += 1
        now = Node(tag, now, count)
        now.up.items.append(now)
        run = None
        hold(tag, now)
        inside += tag in WHOLE
    return root


def _line(run: list) -> str:
    return _SPACE.sub(" ", "".join(run[0])).strip()


def measure(root: Node) -> list[Node]:
    """All nodes in page order, with sizes, links, and the points that paragraphs pass on."""
    nodes, todo = [], [root]
    while todo:
        node = todo.pop()
        nodes.append(node)
        todo += [x for x in reversed(node.items) if isinstance(x, Node)]
    for node in nodes:
        for i, run in enumerate(node.items):
            if isinstance(run, Node):
                continue
            line = _line(run)
            node.items[i] = (line, run[1])
            node.size += len(line)
            node.linked += run[1]
            node.links += run[1] > 0
            if node.tag in HEADINGS or not line:
                continue
            points = (1 + len(_COMMA.findall(line)) + min(len(line) / 100, 3)) * max(0.0, 1 - run[1] / len(line))
            to = node.up if node.tag in PARAGRAPHS and node.up else node
            share = points
            for _ in range(4):
                if to is None:
                    break
                to.points += share
                to, share = to.up, share / 2
    for node in reversed(nodes):
        if node.up:
            node.up.size += node.size
            node.up.linked += node.linked
            node.up.links += node.links
    return nodes


def score(node: Node) -> float:
    return node.points * max(0.0, 1 - node.linked / node.size) if node.size else 0.0


def _menu(node: Node) -> bool:
    """Mostly links, in several of them: a menu, also without a name."""
    return node.links > 1 and node.linked > 0.6 * node.size and node.tag not in ("p", "td", "li", *HEADINGS)


def _lines(node: Node, out: list[str]) -> None:
    todo: list = [node]
    while todo:
        item = todo.pop()
        if isinstance(item, Node):
            if not _menu(item):
                todo += reversed(item.items)
        elif item[0]:
            out.append(item[0])


def main_text(page: str | None) -> str:
    """The lines of the best container and of those of its siblings that belong to it."""
    if not page:
        return ""
    root = parse(page)
    nodes = measure(root)
    best = max(nodes, key=lambda n: (score(n), -n.order))
    if not score(best):
        out: list[str] = []
        _lines(root, out)
        return "\n".join(out)
    whole, up = None, best
    while up is not None:
        if up.tag in WHOLE:
            whole = up
            break
        up = up.up
    if whole is not None:
        best = whole
    elif best.tag in ("ul", "ol", "dl", "table", "tbody", "tr", "blockquote", "td", "li") and best.up:
        best = best.up
    out = []
    if best.up is None:
        _lines(best, out)
        return "\n".join(out)
    least = max(10.0, 0.2 * score(best))
    for item in best.up.items:
        if item is best:
            _lines(best, out)
        elif whole is not None:
            # An article is complete; another one beside it is another text.
            continue
        elif isinstance(item, Node):
            if item.tag in HEADINGS or item.linked < 0.25 * item.size or score(item) >= least:
                _lines(item, out)
        elif item[0] and item[1] < 0.25 * len(item[0]):
            out.append(item[0])
    return "\n".join(out)


def extract(pages: DataFrame, keep: list[str], page: str = "html") -> DataFrame:
    """``keep``, ``text`` and its length in code points."""

    def step(texts: list[str | None]) -> dict:
        found = [main_text(t) for t in texts]
        return {"text": found, "n_chars": [len(t) for t in found]}

    return map_texts(pages, page, keep, "text string, n_chars long", step)


def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"), ["page_id", "url"])
