"""A web page as a tree of block elements and texts, and the keys of its nodes in the style tree of its site."""

from __future__ import annotations

import html as references
import re

import xxhash

BLOCKS = frozenset(
    "address article aside blockquote center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header "
    "hgroup legend li main menu nav ol optgroup option p pre search section summary table caption thead tbody tfoot tr td th ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Elements whose content is no markup.
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
# Siblings of these kinds are one node of the style tree, however many they are.
REPEATED = frozenset("blockquote dd dt h2 h3 h4 h5 h6 li option p pre td th tr".split())
# What an opening tag closes, and where the search for it ends.
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "option": ({"option"}, {"optgroup"}),
          "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
          "thead": ({"thead", "tbody", "tfoot"}, {"table"}), "tbody": ({"thead", "tbody", "tfoot"}, {"table"}), "tfoot": ({"thead", "tbody", "tfoot"}, {"table"})}
CELLS = frozenset(("td", "th", "caption"))
TABLE_PARTS = frozenset("table caption thead tbody tfoot tr td th".split())

# What an element says of its content: part of the main text, beside it, or nothing.
MAIN, NEUTRAL, ASIDE = 1, 0, -1
ASIDE_TAGS = frozenset("aside audio button canvas dialog footer form menu nav noscript object search select svg template video".split())
ASIDE_ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())
# Words of class names and ids. Those of the second list name a title block inside an article.
ASIDE_WORDS = frozenset(
    "ad ads advert advertisement advertising adverts adsense banner breadcrumb breadcrumbs comment commentlist comments consent cookie cookies "
    "disqus footer gdpr login menu menubar modal nav navbar navigation newsletter notice notices pager pagination popup promo promotion "
    "recommendations recommended related replies reply respond share sharing sidebar sidenav signup social sponsor sponsored submenu subscribe "
    "subscription toolbar widget".split())
HEADER_WORDS = frozenset(("header", "masthead", "topbar"))
EXCEPT_WORDS = frozenset(("free", "has", "no", "non", "with", "without"))

# Deeper elements count as part of the element at this depth, so that a path stays short; their text stays.
MOST_DEPTH = 64

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+>?|</(?P<end>[a-zA-Z][^\s/><]*+)[^><]*+(?:>|(?=<)|\Z)"
    r"|<(?P<tag>[a-zA-Z][^\s/><]*+)(?P<attributes>(?:[^\s=><\"'/]++(?:\s*+=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\s><]*+))?+|[\s/\"'=])*+)(?:>|(?=<)|\Z)", re.S)
_ATTRIBUTE = re.compile(r"([^\s=/\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s]*)))?")
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+")


class Element:
    """A block element: its tag, the label that tells it from its siblings, what it says of its content, its children."""

    __slots__ = ("tag", "label", "role", "children")

    def __init__(self, tag: str, label: str, role: int):
        self.tag, self.label, self.role, self.children = tag, label, role, []


def _attributes(text: str) -> dict[str, str]:
    found = {}
    for name, *values in _ATTRIBUTE.findall(text):
        found.setdefault(name.lower(), references.unescape("".join(values)))
    return found


def _named_aside(names: str, tag: str, inside: int) -> bool:
    for name in names.split():
        words = {part.lower() for part in _PARTS.findall(name)}
        if words & EXCEPT_WORDS:
            continue
        if words & ASIDE_WORDS or (inside != MAIN and tag != "h1" and words & HEADER_WORDS):
            return True
    return False


def declared(tag: str, attributes: dict[str, str], inside: int) -> int:
    """What an element says of its content, given what the element around it says. Main content inside an aside stays aside."""
    if inside == ASIDE:
        return ASIDE
    kind = attributes.get("role", "").lower()
    names = f"{attributes.get('class', '')} {attributes.get('id', '')}"
    if tag in ASIDE_TAGS or kind in ASIDE_ROLES or (tag == "header" and inside != MAIN):
        return ASIDE
    if "hidden" in attributes or re.search(r"display\s*:\s*none", attributes.get("style", "")) or attributes.get("aria-modal") == "true":
        return ASIDE
    if tag == "main" or kind == "main":
        return MAIN
    if tag not in ("body", "html") and _named_aside(names, tag, inside):
        return ASIDE
    return MAIN if tag == "article" or kind == "article" or attributes.get("itemprop") == "articleBody" else inside


def _label(tag: str, role: int, attributes: dict[str, str]) -> str:
    names = sorted({re.sub(r"\d+", "0", name) for name in f"{attributes.get('class', '')} {attributes.get('id', '')}".split()})
    return " ".join((tag, str(role), *names))


def parse(page: str) -> Element:
    """The root element of a page. Any text gives a tree: what is not closed ends with the element around it.

    Inline elements are part of the text around them, ``br`` is a blank. Inline elements that are declared aside go.
    """
    root = Element("#root", "#root", NEUTRAL)
    stack = [(root.tag, root, [])]  # tag, element (None for an inline aside), pieces of the text that runs on
    n_open: dict[str, int] = {}

    def flush() -> None:
        _, element, run = stack[-1]
        text = " ".join("".join(run).split())
        if text and element is not None:
            element.children.append(text)
        run.clear()

    def close(at: int) -> None:
        while len(stack) > at:
            flush()
            n_open[stack.pop()[0]] -= 1

    def shut(tags, until) -> None:
        if any(n_open.get(tag) for tag in tags):
            for at in range(len(stack) - 1, 0, -1):
                if stack[at][0] in tags:
                    return close(at)
                if stack[at][0] in until:
                    return

    def add(text: str) -> None:
        stack[-1][2].append(references.unescape(text) if "&" in text else text)

    at = 0
    while token := _TOKEN.search(page, at):
        if token.start() > at:
            add(page[at : token.start()])
        at = token.end()
        if tag := token["end"]:
            tag = tag.lower()
            if tag == "br":
                stack[-1][2].append(" ")
            elif tag == "p" and not n_open.get("p"):
                flush()
            elif n_open.get(tag):
                shut({tag}, () if tag in TABLE_PARTS else CELLS)
            continue
        if not (tag := token["tag"]):
            if token.group().startswith("<![CDATA["):
                stack[-1][2].append(token.group()[9:].removesuffix("]]>"))
            continue
        tag = tag.lower()
        if tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>])[^>]*>?", re.I).search(page, at)
            at = end.end() if end else len(page)
            continue
        if tag in VOID:
            if tag == "hr":
                flush()
            elif tag == "br":
                stack[-1][2].append(" ")
            continue
        inside = stack[-1][1].role if stack[-1][1] is not None else ASIDE
        attributes = _attributes(token["attributes"]) if token["attributes"].strip() else {}
        if tag not in BLOCKS:
            if tag in ("html", "body", "head") or token["attributes"].endswith("/"):
                continue
            if stack[-1][1] is not None and inside != ASIDE and declared(tag, attributes, inside) == ASIDE:
                stack.append((tag, None, []))
                n_open[tag] = n_open.get(tag, 0) + 1
            elif stack[-1][1] is None and tag == stack[-1][0]:
                stack.append((tag, None, []))
                n_open[tag] += 1
            continue
        if n_open.get("p") and stack[-1][0] != "#root":
            shut({"p"}, BLOCKS - {"p"})
        flush()
        if tag in CLOSES:
            shut(*CLOSES[tag])
        around = stack[-1][1]
        if around is None:
            element = None
        elif len(stack) >= MOST_DEPTH:
            element = around
        else:
            role = declared(tag, attributes, around.role)
            element = Element(tag, _label(tag, role, attributes), role)
            around.children.append(element)
        stack.append((tag, element, []))
        n_open[tag] = n_open.get(tag, 0) + 1
    add(page[at:])
    close(1)
    flush()
    return root


def _hash(*parts: object) -> int:
    value = xxhash.xxh3_64_intdigest("\x1f".join(map(str, parts)))
    return value - (1 << 64) if value >> 63 else value


ROOT = _hash("#root")


def _pruned(element: Element) -> bool:
    """Whether anything is left of an element without the empty ones below it."""
    element.children = [child for child in element.children if isinstance(child, str) or _pruned(child)]
    return bool(element.children)


def tree_nodes(root: Element) -> tuple[dict[int, tuple], list[tuple[int, str]]]:
    """Nodes of the style tree that a page has, and its texts in page order with the node each belongs to.

    A style is the sequence of labels below an element, equal neighbours of repeated kinds taken as one. A node is
    known by the styles and positions that lead to it: key -> (style key or None, number of nodes in the style, role, is a text,
    keys from the node up to the root).
    """
    nodes: dict[int, tuple] = {}
    texts: list[tuple[int, str]] = []

    def visit(element: Element, key: int, path: tuple[int, ...]) -> None:
        labels, places = [], []
        for child in element.children:
            label = "#text" if isinstance(child, str) else child.label
            if not (labels and labels[-1] == label and not isinstance(child, str) and child.tag in REPEATED):
                labels.append(label)
            places.append(len(labels) - 1)
        style = _hash(key, *labels)
        for child, place in zip(element.children, places):
            below = _hash(style, place)
            up = (below, *path)
            is_text = isinstance(child, str)
            nodes.setdefault(below, (style, len(labels), element.role if is_text else child.role, is_text, up))
            if is_text:
                texts.append((below, child))
            else:
                visit(child, below, up)

    if _pruned(root):
        nodes[ROOT] = (None, 1, NEUTRAL, False, (ROOT,))
        visit(root, ROOT, (ROOT,))
    return nodes, texts


def page_parts(page: str | None) -> tuple[int, dict[int, tuple], list[tuple[int, str]]]:
    """(layout, nodes, texts) of a page; the layout is a hash of its set of nodes."""
    nodes, texts = tree_nodes(parse(page)) if page else ({}, [])
    return _hash(*sorted(nodes)), nodes, texts


def content_hash(texts: list[tuple[int, str]]) -> int:
    """What two pages share that are copies of each other."""
    return _hash(*[part for text in texts for part in text])


def text_hash(text: str) -> int:
    return _hash(text)
