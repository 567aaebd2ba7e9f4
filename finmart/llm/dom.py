"""A page as a tree of blocks and text runs, read in one pass whose time grows with the page's length alone."""

from __future__ import annotations

import html
import re

# Fixed values of HTML: elements without content, elements whose content is no text of the page, elements inside a line.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea template noscript iframe svg canvas audio video object select button datalist "
                "noframes xmp math".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr output q rp rt ruby s "
                   "samp small span strike strong sub sup time tt u var".split())
# An element that opens ends open elements of its kind, as far as the container that may hold both.
_ENDS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
         "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
         "tbody": ({"tbody", "thead", "tfoot"}, {"table"}), "tfoot": ({"tbody", "thead"}, {"table"})}
_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*)((?>[^"'>]+|"[^"]*"|'[^']*')*+)>""")
_NAME = re.compile(r"</?([a-zA-Z][^\s/>]*)")
_ATTRIBUTE = re.compile(r"""(?<![\w-])(class|id|role|itemprop)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_HIDDEN = re.compile(r"""(?<![\w-])hidden(?![\w-])|display\s*:\s*none""", re.I)
_TOKEN = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


class Node:
    """An element, or a run of text (``raw`` is a list) of one owner inside one block."""

    __slots__ = ("block", "children", "end", "link", "name", "parent", "raw", "tokens")

    def __init__(self, name: str, parent: int, tokens: tuple[str, ...], block: int, raw: list[str] | None):
        self.name, self.parent, self.tokens, self.block, self.raw = name, parent, tokens, block, raw
        self.children, self.end, self.link = 0, 0, 0

    def text(self) -> str:
        return html.unescape("".join(self.raw))


def _tokens(name: str, attributes: str) -> tuple[str, ...]:
    found = [f"<{name}>"]
    for _, *values in _ATTRIBUTE.findall(attributes):
        found += [t.lower() for t in _TOKEN.findall("".join(values))]
    if _HIDDEN.search(attributes):
        found.append("hidden")
    return tuple(dict.fromkeys(found))


def parse(page: str) -> list[Node]:
    """The nodes in page order, parents before children; ``end`` is the place after a node's last descendant.

    Elements inside a line are nodes only where they have a class or another name; their texts stay in the block around.
    Unclosed elements end with what holds them, closing tags without an open element are skipped, an unfinished tag or
    comment at the end of the page is dropped.
    """
    nodes = [Node("#page", -1, ("<#page>",), 0, None)]
    stack, opened, bare = [0], {}, {}
    block = 0  # changes where a block begins or ends
    last = None  # the run that the block's text goes on in
    link, at, size = None, 0, len(page)

    def close(down_to: int) -> None:
        nonlocal block, last, link
        while len(stack) > down_to:
            node = nodes[stack.pop()]
            node.end = len(nodes)
            opened[node.name] -= 1
            if link is not None and link >= len(stack):
                link = None
            if node.name not in INLINE:
                block, last = block + 1, None

    def add(raw: str) -> None:
        nonlocal last
        owner = stack[-1]
        if last is not None and (last.parent == owner or raw.isspace()):
            last.raw.append(raw)
        elif not raw.isspace():
            last = Node("#text", owner, ("<#text>",), block, [raw])
            nodes[owner].children += 1
            nodes.append(last)
            last.end = len(nodes)
        else:
            return
        if link is not None:
            last.link += len(raw)

    while at < size:
        start = page.find("<", at)
        if start < 0:
            start = size
        if start > at:
            add(page[at:start])
        if start == size:
            break
        follows = page[start + 1:start + 2]
        if follows == "!" and page.startswith("<!--", start):
            end = page.find("-->", start + 2)
            at = size if end < 0 else end + 3
            continue
        if follows in ("!", "?") or (follows == "/" and not page[start + 2:start + 3].isalpha()):
            end = page.find(">", start)
            at = size if end < 0 else end + 1
            continue
        found = _TAG.match(page, start)
        if found:
            closing, name, attributes = found.groups()
            at = found.end()
        else:
            named = _NAME.match(page, start)
            if not named:
                add("<")
                at = start + 1
                continue
            end = page.find(">", start)
            if end < 0:
                break
            closing, name, attributes, at = follows == "/", named[1], page[named.end():end], end + 1
        name = name.lower()
        if closing:
            if bare.get(name) and opened.get(name):  # closes an element that is no node, inside one of its name that is
                bare[name] -= 1
            elif opened.get(name):
                bare[name] = 0
                place = len(stack) - 1
                while nodes[stack[place]].name != name:
                    place -= 1
                close(place)
            elif name == "a":
                link = None
            elif name == "p" or name == "br":
                block, last = block + 1, None
            continue
        if name in RAW:
            end = re.compile(rf"</{name}(?=[\s/>])", re.I).search(page, at)
            if not end:
                break
            end = page.find(">", end.end())
            at = size if end < 0 else end + 1
            continue
        if name in VOID:
            if name == "br":
                add(" ")
            elif name == "hr":
                block, last = block + 1, None
            continue
        if name in INLINE:
            if name == "a":
                link = len(stack)
            tokens = _tokens(name, attributes) if attributes else ()
            if len(tokens) < 2:
                bare[name] = bare.get(name, 0) + 1 if opened.get(name) else 0
                continue
        else:
            while opened.get("p") and nodes[stack[-1]].name in INLINE:
                close(len(stack) - 1)
            if nodes[stack[-1]].name == "p":
                close(len(stack) - 1)
            kinds, bounds = _ENDS.get(name, ((), ()))
            if any(map(opened.get, kinds)):
                place = len(stack) - 1
                while place and nodes[stack[place]].name not in bounds:
                    if nodes[stack[place]].name in kinds:
                        close(place)
                    place -= 1
            tokens = _tokens(name, attributes)
            block, last = block + 1, None
        nodes[stack[-1]].children += 1
        opened[name] = opened.get(name, 0) + 1
        stack.append(len(nodes))
        nodes.append(Node(name, stack[-2], tokens, block, None))
        if name in INLINE:
            last = last if last is not None and last.block == block else None
    while stack:
        nodes[stack.pop()].end = len(nodes)
    return nodes
