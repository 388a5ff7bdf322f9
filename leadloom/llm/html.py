"""Main text of web pages by tree scoring.

The page becomes a small tree (tag soup allowed). Elements that cannot hold the article by their
tag or because they are hidden are cut off with all they contain; so are those whose class, id, role
or label says so in a whole token, unless another token names main content or they hold most of the
page's prose. A page left without text is read again without looking at these names. Every remaining
paragraph gets points - one for itself, one per comma, one per hundred characters up to three - and
passes them to its ancestors, in full to its parent, half to the next, a third to the one above and
so on. A container's score is discounted by the share of its text that stands in links. The best
container is kept, and those beside it and its ancestors that score well too or are prose;
right beside it also short prose, headings, lists and tables, unless links make up much of them.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pandas as pd
from pyspark.sql import DataFrame

from leadloom.llm.shared import pick, small_batches

# Elements by their part in a page.
DROPPED = frozenset(
    "aside audio button canvas datalist dialog embed fieldset footer form frame frameset head header "
    "iframe input label link map menu meta nav noscript object option script select style svg "
    "template textarea title video".split()
)
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes".split())
VOID = frozenset("area base br col embed frame hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup "
    "option p pre section summary table tbody td tfoot th thead tr ul".split()
)
PROSE = frozenset("blockquote dd dt figcaption h2 h3 h4 h5 h6 li p pre td".split())
# A start tag closes these open elements, looked for up to the nearest of the second set.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
KEPT_NAMES = frozenset("html body main article".split())
UNLIKELY = re.compile(
    r"ads?|advert\w*|banner|breadcrumbs?|byline|comments?|complementary|consent|"
    r"contentinfo|cookies?|disqus|footer|gdpr|header|login|masthead|menu|modal|nav|navbar|navigation|"
    r"newsletter|notice|notification|outbrain|pager|pagination|popup|print|promo\w*|recommend\w*|"
    r"related|remark|replies|respond|search|share|sharing|shoutbox|side|sidebar|signup|skip|social|"
    r"sponsor\w*|subscribe|taboola|teaser|toolbar|tooltip|tracking|widget"
)
CONTENT = frozenset("article body content entry main post story text".split())
_JOINED = re.compile("[-_]+")
TAG_POINTS = {"article": 10.0, "main": 8.0, "section": 2.0, "div": 1.0, "td": 1.0, "blockquote": 1.0}
LEVELS = 5
_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>")
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_COMMAS = re.compile("[,،、，]")


class Node:
    __slots__ = ("chars", "children", "linked", "parent", "points", "tag", "unlikely")

    def __init__(self, tag: str, parent: Node | None):
        self.tag, self.parent = tag, parent
        self.children: list[Node | str] = []
        self.points, self.chars, self.linked = 0.0, 0, 0
        self.unlikely = False


def _attributes(attributes: str) -> tuple[bool, bool]:
    """Whether an element is hidden, and whether its names speak against main content.

    A token speaks against it if each of its parts between hyphens does (`nav`, `cookie-notice`, not
    `has-sidebar`); a class or id that ends in a content word (`main-content`) outweighs it.
    """
    against = content = False
    for name, *values in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), "".join(values).lower()
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            return True, False
        if name == "style" and "display:none" in value.replace(" ", ""):
            return True, False
        if name in ("class", "id", "role", "aria-label"):
            for token in value.split():
                parts = [part for part in _JOINED.split(token) if part]
                against |= bool(parts) and all(UNLIKELY.fullmatch(part) for part in parts)
                content |= bool(parts) and parts[-1] in CONTENT and name in ("class", "id")
    return False, against and not content


def parse(html: str) -> list[Node]:
    """The elements of a page that are shown, in page order; the first is the root of the tree."""
    root = Node("html", None)
    nodes, stack = [root], [root]
    # Elements cut off, open ones innermost last: their content is skipped, only tags are matched.
    cut: list[str] = []
    position, size = 0, len(html)

    def text(part: str) -> None:
        if part and not cut:
            stack[-1].children.append(unescape(part) if "&" in part else part)

    def close(tags: set[str], scope: set[str]) -> None:
        for depth in range(len(stack) - 1, 0, -1):
            if stack[depth].tag in tags:
                del stack[depth:]
                return
            if stack[depth].tag in scope:
                return

    while position < size:
        at = html.find("<", position)
        if at < 0:
            text(html[position:])
            break
        text(html[position:at])
        if html.startswith("<!--", at):
            end = html.find("-->", at + 4)
            position = size if end < 0 else end + 3
            continue
        following = html[at + 1 : at + 2]
        if following in ("!", "?"):
            end = html.find(">", at)
            position = size if end < 0 else end + 1
            continue
        named = following.isascii() and following.isalpha()
        if not named and following == "/":
            beyond = html[at + 2 : at + 3]
            named = beyond.isascii() and beyond.isalpha()
        if not named:
            text("<")
            position = at + 1
            continue
        tag = _TAG.match(html, at)
        if tag is None:
            # A tag that never ends takes the rest with it; a stray quote only what is inside it.
            end = html.find(">", at)
            position = size if end < 0 else end + 1
            continue
        position = tag.end()
        closing, name, attributes = tag[1], tag[2].lower(), tag[3]
        if closing:
            if cut:
                if name in cut:
                    while cut.pop() != name:
                        pass
            elif name not in VOID:
                for depth in range(len(stack) - 1, 0, -1):
                    if stack[depth].tag == name:
                        del stack[depth:]
                        break
            continue
        if name in RAW:
            end = re.compile(f"</{name}(?=[\\s/>])", re.IGNORECASE).search(html, position)
            position = size if end is None else end.start()
            if end is not None:
                last = html.find(">", position)
                position = size if last < 0 else last + 1
            continue
        if cut:
            if name not in VOID and not attributes.endswith("/"):
                # An element left open inside does not outlive the one that was cut off.
                cut.append(name)
            continue
        if name in BLOCKS:
            close({"p"}, {"table", "td", "th", "button", "object"})
        if name in CLOSES:
            close(*CLOSES[name])
        if name == "br":
            stack[-1].children.append(" ")
            continue
        if name in ("html", "body"):
            continue
        hidden, against = (
            _attributes(attributes) if attributes and name not in KEPT_NAMES else (False, False)
        )
        if name in DROPPED or hidden:
            if name not in VOID:
                cut.append(name)
                if name in BLOCKS:
                    stack[-1].children.append(Node("hr", stack[-1]))
            continue
        node = Node(name, stack[-1])
        node.unlikely = against
        stack[-1].children.append(node)
        nodes.append(node)
        if name not in VOID:
            stack.append(node)
    return nodes


def _is_prose(node: Node) -> bool:
    """A paragraph: by its tag, or a container with text of its own and no block inside."""
    if node.tag in PROSE:
        return True
    return node.tag in ("div", "section", "article", "main", "html") and not any(
        isinstance(c, Node) and c.tag in BLOCKS for c in node.children
    )


def likely(nodes: list[Node]) -> list[Node]:
    """The elements left when those whose names speak against them are cut off.

    One that holds more than half of the page's prose outside of links stays.
    """
    if not any(node.unlikely for node in nodes):
        return nodes
    prose: dict[int, int] = {}
    inside = {id(nodes[0]): False}
    linked = {id(nodes[0]): False}
    for node in nodes[1:]:
        above = node.parent
        inside[id(node)] = inside[id(above)] or _is_prose(node)
        linked[id(node)] = linked[id(above)] or node.tag == "a"
    for node in reversed(nodes):
        own = "".join(c for c in node.children if isinstance(c, str))
        held = prose.get(id(node), 0)
        if (inside[id(node)] or _is_prose(node)) and not linked[id(node)]:
            held += len(" ".join(own.split()))
        prose[id(node)] = held
        if node.parent is not None:
            prose[id(node.parent)] = prose.get(id(node.parent), 0) + held
    total, gone, left = prose[id(nodes[0])], set(), []
    for node in nodes:
        if node.parent is not None and id(node.parent) in gone:
            gone.add(id(node))
        elif node.unlikely and 2 * prose[id(node)] <= total:
            gone.add(id(node))
            children = node.parent.children
            at = next(k for k, c in enumerate(children) if c is node)
            children[at : at + 1] = [Node("hr", node.parent)] if node.tag in BLOCKS else []
        else:
            left.append(node)
    return left


def score(nodes: list[Node]) -> Node:
    """Give all containers their points; the best one (the first among equals)."""
    commas = {}
    for node in reversed(nodes):
        own = "".join(c for c in node.children if isinstance(c, str))
        node.chars += len(" ".join(own.split()))
        found = commas.pop(id(node), 0) + len(_COMMAS.findall(own))
        if node.tag == "a":
            node.linked = node.chars
        if _is_prose(node) and node.chars:
            points = 1.0 + found + min(node.chars / 100, 3.0)
            points *= 1 - min(1.0, node.linked / node.chars)
            above, level = (node if node.tag not in PROSE else node.parent), 1
            while above is not None and level <= LEVELS:
                above.points += points / level
                above, level = above.parent, level + 1
        if node.parent is not None:
            node.parent.chars += node.chars
            node.parent.linked += node.linked
            commas[id(node.parent)] = commas.get(id(node.parent), 0) + found
    best, most = nodes[0], -1.0
    for node in nodes:
        if node.tag in PROSE and node.tag not in ("td", "blockquote"):
            continue
        if node.points > 0:
            value = worth(node)
            if value > most:
                best, most = node, value
    return best


def worth(node: Node) -> float:
    """A container's points, less the share of its text that stands in links."""
    density = min(1.0, node.linked / node.chars) if node.chars else 1.0
    return (node.points + (TAG_POINTS.get(node.tag, 0.0) if node.points else 0.0)) * (1 - density)


def _beside(node: Node, least: float, all_prose: bool) -> bool:
    """Whether an element beside the best container, or beside an ancestor of it, belongs to it."""
    density = node.linked / node.chars if node.chars else 1.0
    if all_prose and density < 0.25:
        return True
    prose = node.tag == "p" and (
        (node.chars >= 80 and density < 0.25) or (0 < node.chars and not density)
    )
    heading = node.tag in ("h1", "h2") and density < 0.25
    return prose or heading or (node.tag not in PROSE and worth(node) >= least)


def _kept(best: Node) -> Node:
    """The top of the article; what is beside the way from it to the best container is cut off.

    Right beside the best container anything with text that is not mostly links stays; an article
    or main element is whole by itself, and further up what scores well or is prose stays.
    """
    least = max(10.0, 0.2 * worth(best))
    top, all_prose = best, best.tag not in ("article", "main")
    while top.parent is not None and (top is best or top.tag not in ("article", "main")):
        above = top.parent
        kept: list[Node | str] = []
        alone = True
        for node in above.children:
            if node is top:
                kept.append(node)
            elif isinstance(node, str):
                if all_prose:
                    kept.append(node)
                    alone = alone and not node.strip()
            elif _beside(node, least, all_prose):
                kept.append(node)
                alone = alone and not node.chars
            else:
                kept.append(Node("hr", above))
        above.children = kept
        top, all_prose = above, all_prose and alone
    return top


def _blocks(top: Node) -> Iterator[str]:
    """The texts of the blocks below a node, white space collapsed, empty ones left out."""
    held: list[str] = []
    todo: list[Node | str | None] = [top]
    while todo:
        item = todo.pop()
        if isinstance(item, str):
            held.append(item)
            continue
        if item is None or item.tag in BLOCKS:
            block = " ".join("".join(held).split())
            held.clear()
            if block:
                yield block
        if item is not None:
            if item.tag in BLOCKS:
                todo.append(None)
            todo.extend(reversed(item.children))
    block = " ".join("".join(held).split())
    if block:
        yield block


def main_text(html: str | None) -> str:
    """The article of a page: its blocks joined by an empty line; empty if there is none."""
    if not isinstance(html, str) or not html:
        return ""
    nodes = parse(html)
    text = _text(likely(nodes))
    if not text and any(node.unlikely for node in nodes):
        text = _text(parse(html))
    return text


def _text(nodes: list[Node]) -> str:
    return "\n\n".join(_blocks(_kept(score(nodes))))


def extract(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """(page_id, url, text, n_chars): one row per input row, whole pages, nothing capped.

    A missing or empty page, or one without an article, has the empty text. Pages are handled one
    by one: repeated rows give repeated results.
    """
    small_batches(pages.sparkSession)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            texts = [main_text(h) for h in frame["html"]]
            yield pd.DataFrame(
                {
                    "page_id": frame["page_id"],
                    "url": frame["url"],
                    "text": [t.encode("utf-8", "replace").decode() for t in texts],
                    "n_chars": [len(t) for t in texts],
                }
            )

    source = pick(pages, page_id=id_col, url=url_col, html=html_col)
    id_type = source.schema["page_id"].dataType.simpleString()
    return source.mapInPandas(run, f"page_id {id_type}, url string, text string, n_chars long")
