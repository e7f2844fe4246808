"""Main text of web pages by tree scoring.

The page becomes a tree (unclosed paragraphs, cells and list items are closed
as browsers do).  Every paragraph gives points for its length and commas to
its ancestors, halved at each step up, and a container's points are discounted
by its link density.  An enclosing ``article`` or ``main`` takes the place of the
best container; without one, its parent does, as long as all in it is content
(unmarked, few links), and its siblings that are content are kept.
Menus, page headers, footers, sidebars, notices, adverts, forms, scripts,
styles and reader comments are left out wherever they stand, by their element,
role or a class or id that is one of the words.  A word that is only part of a
class or id (``has-sidebar``) puts an element in doubt: it counts half, and is
left out if it holds little unlinked text, or reader comments that are less
than half of the page.  What holds the page's article is never left out by its class, and a page with
nothing left is read again without the classes.

Defined cases: null and empty pages give an empty text; broken markup and
unclosed elements are read as far as they go; pages of any length are read
whole; a page without any paragraph gives its remaining text; repeated rows
give one result each; an empty table gives an empty result; extra columns are
ignored.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Elements and words of class, id or role that mark what is not the article.
OUT = frozenset("""nav footer aside form script style noscript template iframe object embed svg canvas button select
option textarea input label head title link meta menu dialog audio video map math fieldset legend datalist""".split())
OUT_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog menu menubar form".split())
COMMENT_WORDS = frozenset("comment comments commentlist disqus respond replies discussion".split())
OUT_WORDS = COMMENT_WORDS | frozenset("""ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo
promoted promotion nav navbar navigation menu breadcrumb breadcrumbs sidebar side rail widget footer foot masthead
topbar toolbar cookie cookies consent gdpr notice notification popup modal overlay newsletter subscribe
subscription signup login share sharing social related recommended recommendations pagination pager skip copyright
disclaimer alert teaser teasers""".split())
PART_WORDS = OUT_WORDS - {"widget"}  # page builders wrap every block of a page in widgets
STATES = re.compile(r"(?:has|no|not|with|without|is|category|tag|type|format)[_-]|.*[_-](?:enabled|disabled|open|closed)$")
BLOCKS = frozenset("""address article blockquote body caption center dd details div dl dt figcaption figure h1 h2 h3
h4 h5 h6 header hgroup hr html li main ol p pre section summary table tbody td tfoot th thead tr ul""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe template".split())
PARAGRAPHS = frozenset("p pre td blockquote li dd".split())
HEAD_WORDS = frozenset("header head top logo".split())
MUCH = 80  # characters of unlinked paragraph text that an element in doubt holds at least
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# what an opening tag closes, and where the search for it ends
CLOSES = {"li": ({"li"}, {"ul", "ol"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
          "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}),
          "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"})}

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<![^>]*>?|<\?[^>]*>?|"
                    r"<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|[^<]+|<", re.S)
_LOOSE = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>]*)>")  # quotes that never close
_CLASS = re.compile(r"""\b(class|id|role|hidden|aria-hidden)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""", re.I)
_SPACES = re.compile(r"\s+")


class Node:
    __slots__ = ("tag", "parent", "children", "out", "mark", "score", "length", "links")

    def __init__(self, tag: str, parent: Node | None, out: bool = False, mark: str = ""):
        self.tag, self.parent, self.out, self.mark = tag, parent, out, mark
        self.children: list[Node | str] = []
        self.score = self.length = self.links = 0.0


def _in_article(node: Node | None) -> bool:
    while node is not None and node.tag not in ("article", "main"):
        node = node.parent
    return node is not None


def _left_out(tag: str, attrs: str, parent: Node) -> bool:
    if tag in OUT:
        return True
    if tag == "header" and not _in_article(parent):  # the head of an article holds its title
        return True
    for name, a, b, c in _CLASS.findall(attrs) if attrs and tag not in ("html", "body", "main") else ():
        name, value = name.lower(), a or b or c
        if name == "hidden" or (name == "aria-hidden" and value.lower() == "true"):
            return True
        if name == "role" and value.lower() in OUT_ROLES:
            return True
    return False


def _mark(tag: str, attrs: str, parent: Node) -> str:
    """What class and id say: "out", "doubt", "comments" in doubt, or nothing."""
    if not attrs or tag in ("html", "body", "main"):
        return ""
    mark = ""
    words, parts = OUT_WORDS, PART_WORDS
    if parent.parent is None and tag in ("div", "section", "table"):
        words, parts = words | HEAD_WORDS, parts | HEAD_WORDS
    for name, a, b, c in _CLASS.findall(attrs):
        for token in (a or b or c).lower().split() if name.lower() in ("class", "id") else ():
            if token in words and tag != "article":
                return "out"
            if not STATES.match(token):
                found = parts.intersection(re.split("[_-]+", token))
                mark = "comments" if found & COMMENT_WORDS else mark or ("doubt" if found else "")
    return mark


def _settle(root: Node) -> None:
    """Leaves out what its class marks, but for what holds the article or, in doubt, much text."""
    nodes = _nodes(root)
    size: dict[int, tuple[int, int, int]] = {}

    def read(x: Node) -> tuple[int, int, int]:
        """Characters, those in links and those of unlinked paragraphs below a node."""
        below = [size[id(c)] for c in x.children if isinstance(c, Node) and not c.out]
        own = [len(c.strip()) for c in x.children if isinstance(c, str)]
        n = sum(own) + sum(t[0] for t in below)
        links = n if x.tag == "a" else sum(t[1] for t in below)
        if x.tag in PARAGRAPHS:
            return n, links, n - links
        return n, links, sum(t[2] for t in below) + sum(k for k in own if k >= 25)
    for x in reversed(nodes):
        size[id(x)] = read(x)
    total, article = size[id(root)][2], set()
    # an article of less than half of the longest one is a teaser or the like
    least = max((size[id(x)][2] for x in nodes if x.tag in ("article", "main") and x.mark != "comments"), default=0) / 2
    for x in reversed(nodes):
        size[id(x)] = n, links, plain = read(x)
        if (x.tag in ("article", "main") and x.mark != "comments" and plain >= least) or any(
                id(c) in article for c in x.children if isinstance(c, Node) and not c.out):
            article.add(id(x))
        elif x.mark == "out" or (x.mark == "doubt" and (plain < MUCH or links > 0.25 * n)) or (
                x.mark == "comments" and plain < 0.5 * total):
            x.out = True


def parse(page: str, classes: bool = True) -> Node:
    root = Node("html", None)
    at, pos, size = root, 0, len(page)
    while pos < size:
        m = _TOKEN.match(page, pos)
        if m.end() == pos + 1 and m.group() == "<" and re.match(r"/?[a-zA-Z]", page[pos + 1:pos + 3]):
            m = _LOOSE.match(page, pos)
            if m is None:  # the page ends inside a tag
                break
        pos = m.end()
        name = m.group(2)
        if name is None:
            text = m.group()
            if not text.startswith(("<!", "<?")):
                at.children.append(text)
            continue
        tag = name.lower()
        if m.group(1):
            p = at
            while p is not None and p.tag != tag:
                p = p.parent
            if p is not None and p is not root:
                at = p.parent
            continue
        if tag in ("html", "body"):
            continue
        if tag in BLOCKS or tag in CLOSES:  # a block ends an open paragraph
            p = at
            while p is not None and p.tag != "p" and (p.tag not in BLOCKS):
                p = p.parent
            if p is not None and p.tag == "p":
                at = p.parent
        if tag in CLOSES:
            ends, within = CLOSES[tag]
            p, found = at, None
            while p is not None and p.tag not in within:
                if p.tag in ends:
                    found = p
                p = p.parent
            if found is not None:
                at = found.parent
        node = Node(tag, at, at.out or _left_out(tag, m.group(3), at), _mark(tag, m.group(3), at) if classes else "")
        at.children.append(node)
        if tag in RAW and not m.group(3).rstrip().endswith("/"):
            end = re.compile(rf"</{tag}\s*>", re.I).search(page, pos)
            pos = end.end() if end else size
        elif tag not in VOID:
            at = node
    if classes:
        _settle(root)
    return root


def _text(node: Node) -> str:
    """All text below a node, what is left out aside."""
    parts, todo = [], [node]
    while todo:
        x = todo.pop()
        if isinstance(x, str):
            parts.append(x)
        elif not x.out:
            todo.extend(reversed(x.children))
    return _SPACES.sub(" ", html.unescape("".join(parts))).strip()


def _nodes(root: Node) -> list[Node]:
    out, todo = [], [root]
    while todo:
        x = todo.pop()
        out.append(x)
        todo.extend(c for c in reversed(x.children) if isinstance(c, Node) and not c.out)
    return out


def _measure(nodes: list[Node]) -> None:
    """Length of text and of link text below each node (children come after parents in the list)."""
    for x in reversed(nodes):
        x.length += sum(len(c.strip()) for c in x.children if isinstance(c, str))
        if x.tag == "a":
            x.links = x.length
        if x.parent is not None:
            x.parent.length += x.length
            x.parent.links += x.links


def _density(x: Node) -> float:
    return x.links / x.length if x.length else 0.0


def _worth(x: Node) -> float:
    return x.score * (1 - _density(x)) * (0.5 if x.mark else 1)


def _content(x: Node | str) -> bool:
    """Whether a child can stay beside the article: text, or an element that is neither marked nor of links."""
    return isinstance(x, str) or x.out or (not x.mark and _density(x) < 0.25)


def best(root: Node) -> list[Node]:
    """The container of the article and the siblings kept with it, in page order; other siblings become left out."""
    nodes = _nodes(root)
    _measure(nodes)
    for x in nodes:
        own = x.tag in PARAGRAPHS or (x.tag in ("div", "section", "article") and any(
            isinstance(c, str) and len(c.strip()) >= 25 for c in x.children))
        if not own:
            continue
        if x.tag not in PARAGRAPHS:
            points_to, text = x, "".join(c for c in x.children if isinstance(c, str))
        else:
            points_to, text = x.parent, _text(x)
        points = 1 + text.count(",") + min(len(text) / 100, 3)
        points *= 1 - _density(x)
        while points_to is not None and points > 0.1:
            points_to.score += points
            points_to, points = points_to.parent, points / 2
    scored = [x for x in nodes if x.score > 0]
    if not scored:
        return [root]
    top = max(scored, key=_worth)
    p = top
    while p is not None:  # the page's own mark of the article
        if p.tag in ("article", "main"):
            top = p
            break
        p = p.parent
    if top.parent is None:
        return [top]
    limit = max(10.0, _worth(top) * 0.2)
    if top.tag in ("article", "main"):
        return [s for s in top.parent.children if isinstance(s, Node) and not s.out and (
            s is top or _worth(s) >= limit or s.tag == top.tag == "article")]
    while top.parent is not None and all(_content(s) for s in top.parent.children if s is not top):
        top = top.parent
    if top.parent is None:
        return [top]
    loose = sum(len(s.strip()) for s in top.parent.children if isinstance(s, str))
    for s in top.parent.children:
        if isinstance(s, Node) and s is not top and not _content(s) and _worth(s) < limit \
                and (s.tag in BLOCKS or s.mark or loose < 25):  # links inside of loose text belong to it
            s.out = True
    return [top.parent]


def blocks(node: Node) -> Iterator[str]:
    """The text of each block below a node, in page order, as it stands in the markup."""
    parts: list[str] = []
    todo: list = [node]
    border = object()
    while todo:
        x = todo.pop()
        if x is border:
            yield "".join(parts)
            parts = []
        elif isinstance(x, str):
            parts.append(x)
        elif x.out:
            continue
        elif x.tag == "br":
            parts.append(" ")
        elif x.tag in BLOCKS:
            yield "".join(parts)
            parts = []
            todo.append(border)
            todo.extend(reversed(x.children))
        else:
            todo.extend(reversed(x.children))
    yield "".join(parts)


def main_text(page: str) -> str:
    for classes in (True, False):
        out = []
        for node in best(parse(page, classes)):
            for b in blocks(node):
                b = _SPACES.sub(" ", html.unescape(b)).strip()
                if b:
                    out.append(b)
        if out:
            break
    return "\n".join(out)


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """page_id, url, text, n_chars: one row per page."""
    p = pages.select(F.col(f"`{page_id}`").alias("page_id"), F.col(f"`{url}`").alias("url"), F.col(f"`{page}`").alias("html"))

    def run(batches):
        for b in batches:
            texts = [main_text(x or "") for x in b.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("page_id"), b.column("url"), pa.array(texts, pa.string()),
                                              pa.array([len(x) for x in texts], pa.int64())],
                                             names=["page_id", "url", "text", "n_chars"])
    kinds = {f.name: f.dataType.simpleString() for f in p.schema}
    return p.mapInArrow(run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")
