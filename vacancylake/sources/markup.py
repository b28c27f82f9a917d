"""A small HTML tree with the selector forms the page rules use.

Runs inside Arrow tasks, one page at a time. Selectors: tag, ``.class``,
``#id``, ``[attr]`` with ``=``, ``*=``, ``^=``, ``$=`` and ``~=``,
``:nth-child(n)``, ``:first-child``, ``:last-child``, descendants, children and
comma groups. Other selectors raise UnsupportedSelector, other texts InvalidSelector.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from html import unescape

_VOID = set("area base br col embed hr img input link meta source track wbr".split())
_HIDDEN = {"script", "style", "template"}
_RAW = {"script", "style"}
_BLOCK = set(
    "address article aside blockquote center dir div dl fieldset footer form h1 h2 h3 h4 h5 h6 "
    "header hr main menu nav ol p pre section table ul".split()
)
# An opening tag closes these open elements, up to the given boundary.
_CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"thead", "tbody", "tr", "td", "th"}, {"table"}),
    "thead": ({"tbody", "tr", "td", "th"}, {"table"}),
    **{tag: ({"p"}, {"table", "td", "th", "li", "div", "article"}) for tag in _BLOCK},
}


class Node:
    """An element; ``order`` lists a page's elements as they open, root first."""

    __slots__ = ("tag", "attrs", "classes", "parent", "children", "order", "start", "end")

    def __init__(self, tag: str, attrs: dict[str, str], parent: Node | None) -> None:
        self.tag, self.attrs, self.parent = tag, attrs, parent
        self.classes = attrs["class"].split() if "class" in attrs else ()
        self.children: list[Node | str] = []
        self.order: list[Node] = parent.order if parent is not None else []
        self.start, self.end = len(self.order), 0
        self.order.append(self)
        if parent is not None:
            parent.children.append(self)

    def descendants(self) -> list[Node]:
        return self.order[self.start + 1 : self.end]

    def strings(self) -> Iterator[str]:
        stack: list[Node | str] = self.children[::-1]
        while stack:
            item = stack.pop()
            if isinstance(item, str):
                yield item
            elif item.tag not in _HIDDEN:
                stack.extend(reversed(item.children))

    def text(self, joint: str = " ") -> str:
        """Stripped text pieces put together, white space collapsed."""
        return " ".join(joint.join(piece.strip() for piece in self.strings()).split())

    def siblings(self) -> list[Node]:
        """Elements of the same parent, this one among them."""
        if self.parent is None:
            return [self]
        return [s for s in self.parent.children if not isinstance(s, str)]


_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>
    |</(?P<close>[A-Za-z][^\s/>]*)[^>]*>
    |<(?P<open>[A-Za-z][^\s/>]*)(?P<attrs>[^>"']*(?:(?:"[^"]*"|'[^']*')[^>"']*)*)>""",
    re.VERBOSE | re.DOTALL,
)
_ATTR = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")


def _attributes(text: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for name, double, single, bare in _ATTR.findall(text):
        value = double or single or bare
        found.setdefault(name.lower(), unescape(value) if "&" in value else value)
    return found


def _place_for(tag: str, here: Node) -> Node:
    """The open element a new tag goes into, once it has closed what it must."""
    if tag not in _CLOSES:
        return here
    closes, boundary = _CLOSES[tag]
    node, place = here, here
    while node.parent is not None and node.tag not in boundary:
        if node.tag in closes:
            place = node.parent
        node = node.parent
    return place


def parse(html: str | None) -> Node:
    """The element tree of a page; unclosed and stray tags are tolerated."""
    html = html or ""
    root = here = Node("", {}, None)
    at = 0
    while True:
        token = _TOKEN.search(html, at)
        text = html[at : token.start() if token else len(html)]
        if text and not text.isspace():
            here.children.append(unescape(text) if "&" in text else text)
        if token is None:
            break
        at = token.end()
        if token["open"]:
            tag = token["open"].lower()
            node = Node(tag, _attributes(token["attrs"]), _place_for(tag, here))
            if tag in _VOID or token["attrs"].endswith("/"):
                here = node.parent
            else:
                here = node
            if tag in _RAW:
                # everything up to the closing tag is text
                close = re.compile(rf"</{tag}\b", re.IGNORECASE).search(html, at)
                end = close.start() if close else len(html)
                node.children.append(html[at:end])
                at = end
        elif token["close"]:
            node, tag = here, token["close"].lower()
            while node.parent is not None and node.tag != tag:
                node = node.parent
            here = node.parent or here
    for node in reversed(root.order):
        last = next((c for c in reversed(node.children) if not isinstance(c, str)), None)
        node.end = last.end if last is not None else node.start + 1
    return root


class InvalidSelector(ValueError):
    """The text is no selector."""


class UnsupportedSelector(ValueError):
    """A selector whose form this module does not know."""


_PART = re.compile(
    r"""(?P<tag>[A-Za-z][\w-]*|\*)|\.(?P<cls>[\w-]+)|\#(?P<id>[\w-]+)
    |\[\s*(?P<attr>[\w-]+)\s*(?:(?P<op>[*^$~]?=)\s*(?P<q>["']?)(?P<val>.*?)(?P=q)\s*)?\]
    |:nth-child\(\s*(?P<nth>\d+)\s*\)|:(?P<edge>first|last)-child(?![\w-])""",
    re.VERBOSE,
)
#: Compounds of the selector language as a whole.
_ANY_COMPOUND = re.compile(
    r"""(?:[A-Za-z][\w-]*|\*)?(?:[.\#][\w-]+|\[\s*[\w-]+\s*(?:[*^$~|]?=[^\]]+)?\]|::?[A-Za-z][\w-]*(?:\([^()]*\))?)*""",
    re.VERBOSE,
)
_SPLIT = re.compile(r"(\[[^\]]*\]|\([^)]*\))|\s*([,>+~])\s*|\s+")
_OPERATORS = {
    None: lambda held, value: True,
    "=": lambda held, value: held == value,
    "*=": lambda held, value: value != "" and value in held,
    "^=": lambda held, value: value != "" and held.startswith(value),
    "$=": lambda held, value: value != "" and held.endswith(value),
    "~=": lambda held, value: value in held.split(),
}


@lru_cache(maxsize=1024)
def compile_selector(selector: str) -> tuple:
    """Alternatives, each compounds (is a child of the one before, tests), innermost last."""
    selector = selector.strip()
    groups, compounds, start, joint, unknown = [], [], 0, "", ""

    def take(end: int) -> None:
        if not selector[start:end]:
            raise InvalidSelector(f"not a selector: {selector!r}")
        compounds.append((joint == ">", _compound(selector[start:end])))

    for found in _SPLIT.finditer(selector):
        if found[1]:
            continue
        take(found.start())
        start, joint = found.end(), found[2] or " "
        if joint == ",":
            groups.append(tuple(compounds))
            compounds.clear()
        elif joint in "+~":
            unknown = joint
    take(len(selector))
    groups.append(tuple(compounds))
    if unknown or any(tests is None for group in groups for _, tests in group):
        raise UnsupportedSelector(f"unsupported selector: {selector!r}")
    return tuple(groups)


def _test(part: re.Match) -> tuple:
    if part["tag"]:
        return "tag", part["tag"].lower(), None
    if part["cls"]:
        return "class", part["cls"], None
    if part["id"]:
        return "id", part["id"], None
    if part["nth"]:
        return "nth", None, int(part["nth"]) - 1
    if part["edge"]:
        return "nth", None, 0 if part["edge"] == "first" else -1
    return part["op"], part["attr"].lower(), part["val"]


def _compound(text: str) -> tuple | None:
    """Tests of a compound; None if it has a form that is not known here."""
    if not _ANY_COMPOUND.fullmatch(text):
        raise InvalidSelector(f"not a selector: {text!r}")
    tests, at = [], 0
    for part in _PART.finditer(text):
        if part.start() != at:
            break
        at = part.end()
        if part["tag"] != "*":
            tests.append(_test(part))
    return tuple(tests) if at == len(text) else None


def _passes(node: Node, tests: tuple) -> bool:
    for kind, name, value in tests:
        if kind == "tag":
            ok = node.tag == name
        elif kind == "class":
            ok = name in node.classes
        elif kind == "id":
            ok = node.attrs.get("id") == name
        elif kind == "nth":
            siblings = node.siblings()
            ok = -1 <= value < len(siblings) and siblings[value] is node
        else:
            ok = name in node.attrs and _OPERATORS[kind](node.attrs[name], value)
        if not ok:
            return False
    return True


def matches(node: Node, chain: tuple) -> bool:
    """Whether a node ends a chain of compounds, the earlier ones being its ancestors."""
    child, tests = chain[-1]
    if not _passes(node, tests):
        return False
    if len(chain) == 1:
        return True
    above = node.parent
    while above is not None and above.parent is not None:  # the root is no element
        if matches(above, chain[:-1]):
            return True
        above = None if child else above.parent
    return False


def _hits(root: Node, selector: str) -> Iterator[Node]:
    groups = compile_selector(selector)
    if len(groups) == 1 and len(groups[0]) == 1:
        _, tests = groups[0][0]
        return (node for node in root.descendants() if _passes(node, tests))
    return (
        node for node in root.descendants() if any(matches(node, chain) for chain in groups)
    )


def select(root: Node, selector: str) -> list[Node]:
    return list(_hits(root, selector))


def select_one(root: Node, selector: str | None) -> Node | None:
    return next(_hits(root, selector), None) if selector else None


def count(root: Node, selector: str) -> int:
    """Matches of a selector; none if the text is no selector."""
    try:
        return len(select(root, selector))
    except InvalidSelector:
        return 0


def link_of(node: Node | None) -> str:
    """The href of an element or of the first anchor inside it."""
    if node is not None and node.tag != "a":
        node = next((n for n in node.descendants() if n.tag == "a"), None)
    return node.attrs.get("href", "") if node is not None else ""
