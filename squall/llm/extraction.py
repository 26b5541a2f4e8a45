"""Main text of web pages by composite text density.

Each whole page becomes a tree of its block elements; inline markup belongs to the
block's text. Elements that are no article text by their tag, role or name (menus,
headers, footers, sidebars, notices, adverts, forms, scripts, styles, comments) leave
the tree first. Then, for every node, with C characters, T tags, LC characters in links
and LT links inside it::

    density = C / T * ln(1 + C / LC * T / LT) / ln(1 + b)
    b       = ln(LC * C / (C - LC) + C * LC(body) / C(body) + e)

(zero counts in divisors stand for one): characters per tag, lowered by links. A node's
density sum adds up its children's densities and that of the text it holds itself.
The node below the body with the largest sum is the best one, and ``SHARE`` of the
largest density on the path from it to the body is the threshold: of the blocks beside
the path those that reach it, and do not hold most of their characters in links, are
article text, and all of such a block is kept, however thin its parts.

Thin blocks, such as headings, leads and lists, cannot reach it. They belong to the
article where they stand in its container: the innermost block around the best node
that has a heading of its own (or the one around it, if the best node is itself a
paragraph or list). Beyond the container only density counts, so boxes, teasers and
lines around it stay out. If the path leads through an article element, the outermost
is the container and is kept whole; a main element ends the climb likewise and keeps
the text that it holds itself. Other article elements must reach the threshold too,
and one that has a heading is another story if the chosen one has its own.

Blocks are trimmed, their inner white space turned into one space, and joined in page
order by one space. Character references are decoded, in text only.

Defined results: a null or empty page, or one without text, gives empty text; repeated
rows each get a result; null ids and addresses are carried; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator

from pyspark.sql import DataFrame

from squall.llm.shards import map_rows

SCHEMA = "page_id long, url string, text string, n_chars long"

TOKEN = re.compile(
    r"""<!--.*?(?:--!?>|\Z)
    |<(?P<raw>script|style|textarea|title|noscript|template|iframe|xmp)\b(?:[^>"']++|"[^"]*"|'[^']*')*+>.*?(?:</(?P=raw)\s*>|\Z)
    |<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>"']++|"[^"]*"|'[^']*')*+)>
    |<[!?][^>]*>""",
    re.DOTALL | re.IGNORECASE | re.VERBOSE,
)
ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
WORD = re.compile(r"[a-z0-9]+")

INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr nobr".split()
)
EMPTY = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: an element's start ends an open element of these kinds, up to the given boundaries
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"thead", "tbody", "tfoot", "caption", "colgroup"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot", "caption", "colgroup"}, {"table"}),
    "option": ({"option"}, {"select"}),
}
#: elements whose end tag may be left out
OPEN_ENDED = frozenset("head p li dt dd tr td th thead tbody tfoot caption colgroup option".split())
#: dropped elements that may stand within a paragraph
PHRASING = frozenset("button select object audio video canvas map svg math".split())
FOREIGN = frozenset("svg math".split())
#: a block inside these leaves a paragraph around them open
AROUND = frozenset("td th li div article section blockquote".split()) | PHRASING
NOISE_TAGS = frozenset("head nav footer aside form dialog menu".split()) | PHRASING
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
NOISE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr "
    "notice notices notification popup modal overlay newsletter subscribe subscription paywall sidebar sidenav nav navbar "
    "navigation menu breadcrumb breadcrumbs footer comment comments disqus respond replies share sharing social related "
    "recommended recommendations widget pagination pager toolbar login signup searchform skip thread discussion reactions "
    "teaser teasers".split()
)
HEADERS = frozenset("header masthead topbar".split())
#: the only names that mark an article or main element as something else
NOT_ARTICLE = frozenset("comment comments ad ads advert advertisement promo related teaser sponsored".split())
ARTICLE = frozenset("main article".split())
WHOLE = ARTICLE | {"html", "body"}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: blocks that hold text rather than other parts of a page
FLOW = HEADINGS | frozenset("p ul ol dl pre blockquote table figure figcaption hgroup".split())
#: share of the largest density on the path to the body that makes a block article text
SHARE = 0.2
#: a short line that begins like this and stands beside the article is no part of it
RIGHTS = re.compile(r"\s*(?:©|\(c\)|copyright\b)", re.IGNORECASE)
RIGHTS_CHARS = 200


class Node:
    """A block element: its tag and, in page order, its texts and child blocks."""

    __slots__ = ("tag", "noise", "ended", "content", "chars", "tags", "link_chars", "links", "own", "own_links", "density", "sum", "best")

    def __init__(self, tag: str, noise: bool = False):
        self.tag, self.noise, self.ended, self.content = tag, noise, False, []
        self.chars = self.tags = self.link_chars = self.links = self.own = self.own_links = 0
        self.density = self.sum = 0.0
        self.best = self

    def children(self) -> Iterator[Node]:
        return (c for c in self.content if isinstance(c, Node))


def _noise(tag: str, rest: str, inside: bool) -> bool:
    """Whether an element is no article text; ``inside``: it stands in an article or main element."""
    if tag in NOISE_TAGS or tag == "header" and not inside:
        return True
    if not rest or tag in ("html", "body"):
        return False
    given = {k.lower(): v.strip("\"'").lower() for k, v in ATTRIBUTE.findall(rest)}
    names = set(WORD.findall(given.get("class", "") + " " + given.get("id", "")))
    if tag in WHOLE:
        return bool(names & NOT_ARTICLE)
    if given.get("role") in NOISE_ROLES or names & NOISE_WORDS or names & HEADERS and not inside:
        return True
    hidden = "hidden" in given or given.get("aria-hidden") == "true"
    return hidden or "display:none" in given.get("style", "").replace(" ", "")


def parse(page: str) -> Node:
    """The tree of a page's blocks, without noise; the root is the body.

    Dropped elements stand in the tree until all is read, so that whatever ends an
    element ends them too. One that only an enclosing end tag or the page's end has
    ended has lost its own; see :func:`_without_noise`.
    """
    root = Node("body")
    stack, link, inside, at = [root], 0, 0, 0
    names, linked = ["body"], [0]
    inline = foreign = 0  # open dropped elements of inline and of foreign tags

    def text(s: str) -> None:
        if not s:
            return
        if names[-1] == "head" and not s.isspace():
            pop(True)
        s = html.unescape(s) if "&" in s else s
        node = stack[-1]
        node.content.append(s)
        size = len("".join(s.split()))
        node.own += size
        if link:
            node.link_chars += size

    def push(tag: str, noise: bool) -> None:
        nonlocal inside, inline, foreign
        node = Node(tag, noise)
        stack[-1].content.append(node)
        stack.append(node)
        names.append(tag)
        linked.append(link)
        inside += tag in ARTICLE
        inline += tag in INLINE
        foreign += tag in FOREIGN

    def pop(ended: bool) -> None:
        nonlocal link, inside, inline, foreign
        node, tag = stack.pop(), names.pop()
        node.ended = ended
        before = linked.pop()
        link = before if node.noise or tag in INLINE else 0
        inside -= tag in ARTICLE
        inline -= tag in INLINE
        foreign -= tag in FOREIGN

    def close(tags: set, bounds: set) -> None:
        for k in range(len(names) - 1, 0, -1):
            if names[k] in tags:
                while len(names) > k:
                    pop(names[-1] in OPEN_ENDED)
                return
            if names[k] in bounds:
                return

    for m in TOKEN.finditer(page):
        text(page[at : m.start()])
        at = m.end()
        tag = m["tag"]
        if tag is None:
            continue
        tag, end = tag.lower(), m["end"]
        if names[-1] == "head" and not end and tag not in ("base", "link", "meta", "head"):
            pop(True)
        if tag in INLINE or tag in EMPTY:
            if end and inline and tag in names:
                while names[-1] != tag:
                    pop(names[-1] in OPEN_ENDED)
                pop(True)
                continue
            # in a dropped element, one of the same tag has an end tag of its own
            if not end and tag not in EMPTY and tag != "a" and (_noise(tag, m["rest"], inside) or inline and tag in names):
                stack[-1].tags += 1
                if not (foreign and m["rest"].endswith("/")):
                    push(tag, _noise(tag, m["rest"], inside))
                continue
            if not end:
                stack[-1].tags += 1
                if tag in ("br", "hr"):
                    stack[-1].content.append(" ")
            if tag == "a":
                link = 0 if end else 1
                stack[-1].links += not end
            continue
        if tag in ("html", "body"):
            continue
        if end:
            if tag in names[1:]:
                while names[-1] != tag:
                    pop(names[-1] in OPEN_ENDED)
                pop(True)
            else:
                link = 0
            continue
        if foreign and m["rest"].endswith("/"):
            continue
        noise = _noise(tag, m["rest"], inside)
        if not (noise and tag in PHRASING) and "p" in names:  # a block ends an open paragraph
            close({"p"}, AROUND)
        if tag in CLOSES:
            close(*CLOSES[tag])
        if noise and m["rest"].endswith("/"):
            continue
        push(tag, noise)
        link = 0
    text(page[at:])
    _without_noise(root)
    return root


def _without_noise(root: Node) -> None:
    """Take the dropped elements out of a page's tree.

    How far one was to reach that lost its end tag is not known. It is taken to end in
    front of its first child that is or holds an article or main element. On a page
    without such elements its blocks stay if they hold more text than the rest of the page.
    """
    nodes = _order(root)
    held: dict[int, bool] = {}
    size: dict[int, int] = {}

    def first(node: Node) -> int:
        """Where the part of a dropped element begins that stays."""
        blocks = (k for k, c in enumerate(node.content) if isinstance(c, Node) and (held[id(c)] or not held[id(node)]))
        return next(blocks, len(node.content))

    for node in reversed(nodes):
        inner = [c for c in node.children() if not (c.noise and c.ended)]
        held[id(node)] = any(held[id(c)] for c in inner) or node.tag in ARTICLE and not node.noise
        size[id(node)] = node.own + sum(size[id(c)] for c in inner if not c.noise)
    rest, whole = size[id(root)], held[id(root)]
    for node in reversed(nodes):
        content = []
        for child in node.content:
            part = [child]
            if isinstance(child, Node) and child.noise:
                part = []
                if not child.ended:
                    part = child.content[first(child) :]
                    if not held[id(child)] and (whole or sum(size[id(c)] for c in part if isinstance(c, Node)) <= rest):
                        part = []
                    node.own += sum(len("".join(c.split())) for c in part if isinstance(c, str))
                    size[id(node)] += sum(size[id(c)] for c in part if isinstance(c, Node))
            elif isinstance(child, Node) and child.tag in INLINE:
                part = child.content
                node.own += child.own
                node.tags += child.tags
                node.link_chars += child.link_chars
                node.links += child.links
            content += part
        node.content = content


def _order(root: Node) -> list[Node]:
    """All nodes, parents before children, in page order."""
    out, todo = [], [root]
    while todo:
        node = todo.pop()
        out.append(node)
        todo.extend(reversed(list(node.children())))
    return out


def measure(root: Node) -> list[Node]:
    """Fill in the counts, densities, sums and largest-sum subtrees; return the nodes in page order."""
    nodes = _order(root)
    held = {}
    for node in reversed(nodes):
        node.chars, node.own_links = node.own, node.link_chars
        held[id(node)] = node.tags, node.link_chars, node.links
        for child in node.children():
            node.chars += child.chars
            node.tags += child.tags + 1
            node.link_chars += child.link_chars
            node.links += child.links

    def density(c: int, t: int, lc: int, lt: int) -> float:
        if not c:
            return 0.0
        t, share = max(t, 1), root.link_chars / max(root.chars, 1)
        base = math.log(lc * c / max(c - lc, 1) + c * share + math.e)
        return c / t * math.log(1 + c / max(lc, 1) * t / max(lt, 1)) / math.log(1 + base)

    for node in reversed(nodes):
        node.density = density(node.chars, node.tags, node.link_chars, node.links)
        node.sum = sum(c.density for c in node.children()) + density(node.own, *held[id(node)])
        node.best = node
        for child in node.children():
            if child.best.sum > node.best.sum:
                node.best = child.best
    return nodes


def _texts(root: Node, chosen: set[int], dropped: set[int], out: list[str]) -> None:
    """The text of the chosen subtrees, block by block, without dropped ones that hold no chosen one."""
    todo = [(root, 0, id(root) in chosen)]
    while todo:
        block, k, kept = todo.pop()
        line = []
        while k < len(block.content) and not isinstance(block.content[k], Node):
            line.append(block.content[k])
            k += 1
        if kept:
            out.append("".join(line))
        if k < len(block.content):
            child = block.content[k]
            todo += [(block, k + 1, kept), (child, 0, id(child) in chosen or kept and id(child) not in dropped)]


def _mostly_links(node: Node) -> bool:
    return 2 * node.link_chars > node.chars


def _headed(node: Node) -> bool:
    return any(n.tag in HEADINGS for n in _order(node))


def _begins(node: Node) -> str:
    """The first text of a block."""
    return next((c for n in _order(node) for c in n.content if isinstance(c, str) and not c.isspace()), "")


def _choose(root: Node, nodes: list[Node], best: Node, chosen: set[int], dropped: set[int]) -> None:
    """The blocks that are article text, given the one with the largest sum."""
    parent = {id(c): n for n in nodes for c in n.children()}
    path = [best]
    while id(path[-1]) in parent:
        path.append(parent[id(path[-1])])
    threshold = SHARE * max(n.density for n in path)

    def text(node: Node) -> bool:
        rights = node.chars <= RIGHTS_CHARS and RIGHTS.match(_begins(node))
        return node.density >= threshold and not _mostly_links(node) and not rights

    chosen.add(id(best))
    articles = [n for n in path if n.tag == "article"]
    top = articles[-1] if articles else next((n for n in reversed(path) if n.tag in ARTICLE), root)
    if articles:
        chosen.add(id(top))
    headed = _headed(best)
    container = best.tag in FLOW  # whether the next block on the path is the article's container
    for node, above in zip(path, path[1:]):
        if articles or node is top:
            break
        heading = not headed and any(c.tag in HEADINGS for c in above.children())
        container = container or heading
        rights = {id(c) for c in above.children() if c.chars <= RIGHTS_CHARS and RIGHTS.match(_begins(c))}
        for c in above.children():
            if c is node:
                continue
            if text(c) or container and c.tag in FLOW and not _mostly_links(c) and id(c) not in rights:
                chosen.add(id(c))
            else:
                dropped.add(id(c))
        if (container or above.tag in ARTICLE) and 2 * above.own_links <= above.own:
            chosen.add(id(above))
        headed = headed or heading
        container = False
    story = _headed(top) if articles else headed
    inside = {id(n) for n in _order(top)} if articles else {id(n) for n in path}
    for n in nodes:
        if n.tag in ARTICLE and id(n) not in inside:
            if text(n) and not (story and _headed(n)):
                chosen.add(id(n))
            else:
                chosen.discard(id(n))
                dropped.add(id(n))


def main_text(page: str | None) -> str:
    """The article text of a page."""
    if not page:
        return ""
    root = parse(page)
    nodes = measure(root)
    inner = list(root.children())
    top = max(inner, key=lambda n: n.best.sum, default=None)
    chosen: set[int] = set()
    dropped: set[int] = set()
    if top is None or root.sum - sum(c.density for c in inner) > top.best.sum:  # the body's own text outweighs every block
        chosen.add(id(root))
    else:
        _choose(root, nodes, top.best, chosen, dropped)
    out: list[str] = []
    _texts(root, chosen, dropped, out)
    return " ".join(" ".join(out).split())


def extract(pages: DataFrame) -> DataFrame:
    """Per row of ``pages``: page_id, url, text, n_chars."""

    def each():
        def row(page_id: int | None, url: str | None, page: str | None) -> Iterator[tuple]:
            text = main_text(page)
            yield page_id, url, text, len(text)

        return row

    return map_rows(pages.select("page_id", "url", "html"), SCHEMA, each)


#: Twin for pages whose article stands in one <article> element of h1, p, b and br, as those of the test tables.
ORACLE_SQL = r"""
WITH inside AS (
    SELECT page_id, url, regexp_extract(coalesce(html, ''), '(?s)<article>(.*)</article>', 1) AS article FROM pages
), bare AS (
    SELECT page_id, url, regexp_replace(regexp_replace(article, '</?(p|h1|br)>', ' ', 'g'), '<[^>]*>', '', 'g') AS bare
    FROM inside
), decoded AS (
    SELECT page_id, url,
           regexp_replace(regexp_replace(regexp_replace(regexp_replace(replace(bare, '&#x27;', chr(39)),
               '&lt;?', '<', 'g'), '&gt;?', '>', 'g'), '&quot;?', '"', 'g'), '&amp;?', '&', 'g') AS decoded
    FROM bare
), squeezed AS (
    SELECT page_id, url, trim(regexp_replace(decoded, '\s+', ' ', 'g')) AS text FROM decoded
)
SELECT page_id, url, text, CAST(length(text) AS BIGINT) AS n_chars FROM squeezed
"""
