"""A small HTML tree on the standard library, with the selectors that page extraction needs, and its uses on a column.

Broken markup gives a tree all the same: unknown end tags are skipped, open elements end with their parent, and a list
item, table row or cell ends where the next one begins.
"""

from __future__ import annotations

import functools
import re
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Callable, Iterator
from html import unescape
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Elements without content, and elements that end an open one of the second kind up to one of the third.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
ENDS = {"li": ({"li"}, {"ul", "ol"}), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "tbody": ({"thead", "tbody", "tr", "td", "th"}, {"table"}), "p": ({"p"}, {"div", "td", "li", "body", "article", "section", "table"})}


#: Up to so many elements a tree isn't worth an index.
SMALL = 12


class _Document:
    """What the elements of one tree share: all of them in document order, and their places by tag and by class, made when first asked for."""

    __slots__ = ("nodes", "tags", "marked")

    def __init__(self):
        self.nodes: list[Node] = []
        self.tags: dict[str, list[int]] | None = None
        self.marked: dict[str, list[int]] = {}

    def index(self) -> None:
        tags, marked = defaultdict(list), defaultdict(list)
        for k, node in enumerate(self.nodes):
            node.place, node.end = k, k + 1
            tags[node.tag].append(k)
            if node.classes:
                for c in dict.fromkeys(node.classes) if len(node.classes) > 1 else node.classes:
                    marked[c].append(k)
        for node in reversed(self.nodes):
            above = node.parent
            if above is not None and above.end < node.end:
                above.end = node.end
        self.tags, self.marked = tags, marked

    def places(self, step: tuple) -> list[int] | tuple | None:
        """Of elements that have one of the step's classes, or else its tag; null where any element may do."""
        _, tag, classes, _ = step
        if classes:
            return min([self.marked.get(c, ()) for c in classes], key=len) if len(classes) > 1 else self.marked.get(classes[0], ())
        return self.tags.get(tag, ()) if tag else None

    def candidates(self, steps: tuple, top: Node) -> list[Node] | tuple:
        """Elements from ``top`` on down that the last step may pick; those of a rare step before it tell where to look."""
        nodes = self.nodes
        if self.tags is None:
            if len(nodes) <= SMALL and top is nodes[0]:
                return nodes
            self.index()
        here, end = top.place, top.end
        for step in steps[:-1]:
            above = self.places(step)
            if above is not None and len(above) < 4:
                if not above:
                    return ()
                here, end = max(here, above[0]), min(end, max([nodes[k].end for k in above]))
        found = self.places(steps[-1])
        if not found or here >= end:
            return nodes[here:end] if found is None else ()
        if end - here < len(nodes):
            found = found[bisect_left(found, here) : bisect_left(found, end)]
        return [nodes[k] for k in found]


class Node:
    """An element: children are elements and strings in order. A tree is searched once it is whole."""

    __slots__ = ("tag", "attrs", "classes", "children", "parent", "document", "place", "end")

    def __init__(self, tag: str, attrs: dict[str, str] | None = None, parent: Node | None = None, classes: list[str] | None = None):
        self.tag, self.attrs, self.parent = tag, attrs or {}, parent
        self.classes = self.attrs.get("class", "").split() if classes is None else classes
        self.children: list[Node | str] = []
        self.document = document = _Document() if parent is None else parent.document
        document.nodes.append(self)

    def release(self) -> None:
        """Undo the tree, whose elements hold each other, so that its memory is free at once."""
        nodes, self.document.nodes = self.document.nodes, []
        for n in nodes:
            n.parent = n.document = None

    def get(self, name: str, default: str | None = None) -> str | None:
        return self.attrs.get(name, default)

    @property
    def elements(self) -> list[Node]:
        return [c for c in self.children if isinstance(c, Node)]

    def walk(self) -> Iterator[Node]:
        """The element and all below it in document order."""
        todo = [self]
        while todo:
            node = todo.pop()
            yield node
            todo.extend(reversed(node.elements))

    def strings(self) -> list[str]:
        out: list[str] = []
        todo: list[Node | str] = self.children[::-1]
        while todo:
            x = todo.pop()
            if isinstance(x, str):
                out.append(x)
            else:
                todo += x.children[::-1]
        return out

    def own_string(self) -> str | None:
        """The first string directly inside."""
        return next((c for c in self.children if isinstance(c, str)), None)

    def joined(self, glue: str = "") -> str:
        if not self.children:
            return ""
        if len(self.children) == 1 and isinstance(self.children[0], str):
            return self.children[0].strip()
        return glue.join(self.strings()).strip()

    def next_element(self, tag: str) -> Node | None:
        """The nearest following sibling of that kind."""
        after = iter(self.parent.children if self.parent else ())
        return next((x for x in after if isinstance(x, Node) and x.tag == tag), None) if any(x is self for x in after) else None

    def ancestor(self, tag: str) -> Node | None:
        node = self.parent
        while node is not None and node.tag != tag:
            node = node.parent
        return node

    def select(self, path: str) -> list[Node]:
        """Elements (this one among them) that a path of compound selectors picks, in document order."""
        steps = compiled(path)
        k = len(steps) - 1
        if not k:
            return [n for n in self.document.candidates(steps, self) if _is(steps[0], n)]
        return [n for n in self.document.candidates(steps, self) if _picks(steps, k, n)]

    def first(self, path: str) -> Node | None:
        steps = compiled(path)
        k = len(steps) - 1
        for n in self.document.candidates(steps, self):
            if _picks(steps, k, n):
                return n
        return None

    def firsts(self, tag: str, classes: frozenset[str]) -> dict[str, Node]:
        """For each of the classes the first element of that tag (this one among them) that has it, found in one walk."""
        if self.document.tags is None:
            self.document.index()
        found: dict[str, Node] = {}
        for n in self.document.nodes[self.place : self.end]:
            if n.classes and n.tag == tag:
                for c in n.classes:
                    if c in classes:
                        found.setdefault(c, n)
        return found

    def text(self, path: str) -> str:
        """All strings in what the path picks, each once, joined and trimmed."""
        out: list[str] = []
        end = -1
        if self.document.tags is None:
            self.document.index()
        for n in self.select(path):
            if n.place >= end:  # not inside the one before
                out += n.strings()
                end = n.end
        return "".join(out).strip()


_STEP = re.compile(r"\s*(>)?\s*([a-z][\w-]*)?((?:\.[\w-]+)*)((?:\[[^\]]*\])*)", re.IGNORECASE)
_TEST = re.compile(r"""\[\s*([\w:-]+)\s*(?:([*^$~]?=)\s*["']?([^"'\]]*)["']?\s*)?\]""")


@functools.lru_cache(1000)
def compiled(path: str) -> tuple:
    """Steps (whether the one before must be the parent, tag, classes, attribute tests) of a selector path."""
    steps, at, path = [], 0, path.strip()
    while at < len(path):
        m = _STEP.match(path, at)
        if not m or m.end() == at or not any(m.groups()[1:]):
            raise ValueError(f"selector not understood: {path!r}")
        steps.append((bool(m[1]), (m[2] or "").lower(), tuple(m[3].split(".")[1:]), tuple(_TEST.findall(m[4]))))
        at = m.end()
    if not steps:
        raise ValueError("empty selector")
    return tuple(steps)


_TESTS: dict[str, Callable[[str, str], bool]] = {"=": str.__eq__, "*=": str.__contains__, "^=": str.startswith, "$=": str.endswith, "~=": lambda a, b: b in a.split(), "": lambda a, b: True}


def _is(step: tuple, node: Node) -> bool:
    _, tag, classes, tests = step
    if tag and node.tag != tag:
        return False
    for c in classes:
        if c not in node.classes:
            return False
    return not tests or all(node.get(n) is not None and _TESTS[op](node.get(n), v) for n, op, v in tests)


def _picks(steps: tuple, k: int, node: Node) -> bool:
    if not _is(steps[k], node):
        return False
    if k == 0:
        return True
    above = node.parent
    if steps[k][0]:
        return above is not None and _picks(steps, k - 1, above)
    while above is not None:
        if _picks(steps, k - 1, above):
            return True
        above = above.parent
    return False


def _opened(at: Node, tag: str) -> Node:
    """Where an element of that tag goes: open ones that it ends are left."""
    ends, fence = ENDS[tag]
    node = at
    while node.parent is not None and node.tag not in fence:
        if node.tag in ends:
            at = node.parent
        node = node.parent
    return at


def _closed(at: Node, tag: str) -> Node:
    """What is open after an end tag."""
    node = at
    while node.parent is not None and node.tag != tag:
        node = node.parent
    return at if node.parent is None else node.parent


def _add(at: Node, data: str) -> None:
    last = at.children
    if last and isinstance(last[-1], str):
        last[-1] += data
    else:
        last.append(data)


class _Builder(HTMLParser):
    """Any document, however broken."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("")

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in ENDS:
            self.at = _opened(self.at, tag)
        node = Node(tag, {k: v or "" for k, v in reversed(attrs)}, self.at)
        self.at.children.append(node)
        if tag not in VOID:
            self.at = node

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        self.at = _closed(self.at, tag)

    def handle_data(self, data: str) -> None:
        _add(self.at, data)


#: The inside of plain tags, and an attribute of such a tag.
_END = re.compile(r"/([a-zA-Z][-.a-zA-Z0-9:_]*)[ \t\n\r\f]*")
_ATTRIBUTE = r"""[ \t\n\r\f]+([a-zA-Z_:][-.\w:]*)(?:[ \t\n\r\f]*=[ \t\n\r\f]*("[^"]*"|'[^']*'|[^\s"'=<>`]+))?"""
_START = re.compile(rf"([a-zA-Z][-.a-zA-Z0-9:_]*)((?:{_ATTRIBUTE})*)[ \t\n\r\f]*(/?)")
_ATTRIBUTES = re.compile(_ATTRIBUTE)
_ONE = re.compile(r'([a-zA-Z][-.a-zA-Z0-9:_]*) ([a-zA-Z_:][-.\w:]*)="([^"]*)"')
#: Elements whose content is text up to their end tag.
_RAW = {k: re.compile(rf"</\s*{k}", re.IGNORECASE) for k in ("script", "style")}


def _unescaped(text: str) -> str:
    """``unescape``, sooner where ampersands are all that is escaped."""
    if "&" not in text:
        return text
    return text.replace("&amp;", "&") if text.count("&") == text.count("&amp;") else unescape(text)


def _tag(inside: str) -> tuple | None:
    """(tag, attributes, classes, whether it ends itself, as only elements without content do) of what stands in a plain tag's brackets, with no attributes for an end tag; null where it isn't plain."""
    if m := _ONE.fullmatch(inside):
        tag, name, value = m[1].lower(), m[2].lower(), _unescaped(m[3])
        return tag, {name: value}, value.split() if name == "class" else [], tag in VOID
    if m := _END.fullmatch(inside):
        return m[1].lower(), None, None, True
    m = _START.fullmatch(inside)
    if not m:
        return None
    attrs: dict[str, str] = {}
    for name, value in _ATTRIBUTES.findall(m[2]):
        value = value[1:-1] if value[:1] in ("'", '"') else value
        attrs.setdefault(name.lower(), _unescaped(value))
    tag = m[1].lower()
    return None if tag in _RAW and m[5] else (tag, attrs, attrs.get("class", "").split(), tag in VOID)


_known_tag = functools.lru_cache(5000)(_tag)


#: Fixed value: documents of fewer characters are taken apart at once.
SHORT = 1 << 18


def _short(html: str) -> Node | None:
    """As ``_plain``, for a short document without comments, raw text or brackets inside tags; null for any other."""
    root = at = Node("")
    data, *rest = html.split("<")
    if data:
        root.children.append(_unescaped(data))
    for part in rest:
        inside, gt, data = part.partition(">")
        told = _known_tag(inside) if gt and len(inside) < 99 else None
        if told is None or told[0] in _RAW:
            root.release()
            return None
        tag, attrs, classes, closed = told
        if attrs is None:
            at = at.parent if at.tag == tag else _closed(at, tag)
        else:
            if tag in ENDS:
                at = _opened(at, tag)
            node = Node(tag, attrs, at, classes)
            at.children.append(node)
            if not closed:
                at = node
        if data:
            data = _unescaped(data) if "&" in data else data
            if at.children:
                _add(at, data)
            else:
                at.children.append(data)
    return root


def _plain(html: str) -> Node | None:
    """The tree of a document in plain markup, the same as ``_Builder`` gives; null for any other."""
    if len(html) < SHORT and (root := _short(html)) is not None:
        return root
    root = at = Node("")
    here = 0
    while (lt := html.find("<", here)) >= 0:
        if lt > here:
            data = _unescaped(html[here:lt])
            if at.children:
                _add(at, data)
            else:
                at.children.append(data)
        gt = html.find(">", lt)
        if gt < 0:
            return None
        inside = html[lt + 1 : gt]
        told = _known_tag(inside) if gt - lt < 100 else _tag(inside)
        if told is None:
            if inside.startswith("!--"):
                here = html.find("--", lt + 4) + 3
                if here < 3 or html[here - 1 : here] != ">" or html[lt + 4] in "->":
                    return None
                continue
            if inside[:8].lower() == "!doctype":
                here = gt + 1
                continue
            m = _START.match(html, lt + 1)  # a quoted value may hold the bracket
            if not m or html[m.end() : m.end() + 1] != ">":
                return None
            gt, told = m.end(), _tag(m[0])
            if told is None:
                return None
        here = gt + 1
        tag, attrs, classes, closed = told
        if attrs is None:
            at = at.parent if at.tag == tag else _closed(at, tag)
            continue
        if tag in ENDS:
            at = _opened(at, tag)
        node = Node(tag, attrs, at, classes)
        at.children.append(node)
        if not closed:
            at = node
        if tag in _RAW:
            end = _RAW[tag].search(html, here)
            if not end or not html.startswith(f"{tag}>", end.end() - len(tag)) or "<!--" in html[here : end.start()]:
                return None
            if end.start() > here:
                _add(at, html[here : end.start()])
            here = end.start()
    if here < len(html):
        _add(at, _unescaped(html[here:]))
    return root


def tree(html: str | None) -> Node:
    """The document as an element without a name; null and empty text is an empty one."""
    if (found := _plain(html or "")) is not None:
        return found
    builder = _Builder()
    builder.feed(html or "")
    builder.close()
    return builder.root


def text_of(node: Node) -> str:
    return node.joined(" ")


def labelled_boxes(node: Node) -> dict[str, Node]:
    """Boxes of a profile page by their label: a title and the next ``div`` beside it; the last of equal labels counts."""
    found = ((text_of(title), title.next_element("div")) for title in node.select("div.InformationBoxTitle"))
    return {label: box for label, box in found if box is not None}


def lines_of(node: Node) -> list[str]:
    """Text lines between line breaks, empty ones dropped."""
    text = "".join("\n" if isinstance(x, Node) else x.replace("\n", " ") for x in pieces(node, lambda n: n.tag == "br"))
    return [line for line in map(str.strip, text.split("\n")) if line]


def pieces(node: Node, whole: Callable[[Node], bool]) -> Iterator[Node | str]:
    """Strings in order; elements that ``whole`` picks come as they are, without what is in them."""
    todo: list[Node | str] = list(reversed(node.children))
    while todo:
        x = todo.pop()
        if isinstance(x, str) or whole(x):
            yield x
        else:
            todo.extend(reversed(x.children))


# On a column ------------------------------------------------------------------------------------------------------------

#: Documents that are read at a time of an Arrow batch, so that a worker holds few of them as objects.
SLICE = 500


_ENTITY = re.compile(r"\?id=(\d+)&nr=(\d+)")


def _links(t: Node) -> list[dict]:
    out = []
    for a in t.select("a"):
        if m := _ENTITY.match(a.attrs.get("href", "")):
            out.append({"section": m[1], "nr": m[2], "text": a.joined()})
    return out


def _link_texts(t: Node) -> list[str]:
    strings = [c.strip() for a in t.select("a") for c in a.children if isinstance(c, str)]
    return list(dict.fromkeys(filter(None, strings)))


def _og_image(t: Node) -> str | None:
    return m.get("content") if (m := t.first('meta[property="og:image"]')) else None


#: A question to a document: what it gives for a tree, and its type for Spark and for Arrow.
Reader = tuple[Callable[[Node], object], str, pa.DataType]
_TEXTS = "array<string>", pa.list_(pa.string())


def texts(path: str) -> Reader:
    """array<string>: the text of each element that the path picks (strings joined by a space)."""
    return lambda t: [text_of(n) for n in t.select(path)], *_TEXTS


def attrs(path: str, name: str) -> Reader:
    """array<string>: that attribute of each picked element which has it."""
    return lambda t: [n.get(name) for n in t.select(path) if n.get(name) is not None], *_TEXTS


#: The whole fragment's strings joined by spaces.
TEXT: Reader = text_of, "string", pa.string()
#: map<label, text> of a profile page.
BOXES: Reader = lambda t: [(k, text_of(v)) for k, v in labelled_boxes(t).items()], "map<string,string>", pa.map_(pa.string(), pa.string())
#: array<struct<section, nr, text>> of links to entities, in order.
LINKS: Reader = _links, "array<struct<section:string,nr:string,text:string>>", pa.list_(pa.struct([(k, pa.string()) for k in ("section", "nr", "text")]))
#: array<string>: the strings in links, distinct in order.
LINK_TEXTS: Reader = _link_texts, *_TEXTS
#: The address in the page's ``og:image``, as it is there.
OG_IMAGE: Reader = _og_image, "string", pa.string()


def read(html: Column, **asked: Reader) -> Column:
    """struct: each answer by its name. A document is parsed once for all of them. Null stays null."""
    fields = [pa.field(name, kind) for name, (_, _, kind) in asked.items()]
    readers = [(f, kind) for f, _, kind in asked.values()]

    def part(values: pa.Array) -> pa.Array:
        found: list[list] = [[] for _ in readers]
        for x in values.to_pylist():
            if x is None:
                for column in found:
                    column.append(None)
                continue
            page = tree(x)
            for column, (f, _) in zip(found, readers, strict=True):
                column.append(f(page))
            page.release()
        return pa.StructArray.from_arrays([pa.array(c, kind) for c, (_, kind) in zip(found, readers, strict=True)], fields=fields, mask=values.is_null())

    def of(values: pa.Array) -> pa.Array:
        return pa.concat_arrays([part(values.slice(i, SLICE)) for i in range(0, max(len(values), 1), SLICE)])

    of.__annotations__ = {"values": pa.Array, "return": pa.Array}
    return F.arrow_udf(of, f"struct<{','.join(f'{name}:{kind}' for name, (_, kind, _) in asked.items())}>")(html)


def select_texts(html: Column, path: str) -> Column:
    return read(html, it=texts(path))["it"]


def select_attrs(html: Column, path: str, name: str) -> Column:
    return read(html, it=attrs(path, name))["it"]


def html_text(html: Column) -> Column:
    return read(html, it=TEXT)["it"]


def info_boxes(html: Column) -> Column:
    return read(html, it=BOXES)["it"]


def entity_links(html: Column) -> Column:
    return read(html, it=LINKS)["it"]


def link_texts(html: Column) -> Column:
    return read(html, it=LINK_TEXTS)["it"]


def og_image(html: Column) -> Column:
    return read(html, it=OG_IMAGE)["it"]
