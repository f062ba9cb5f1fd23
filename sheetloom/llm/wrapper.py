"""Wrappers: union-free regular expressions over the token streams of a host's pages."""

from __future__ import annotations

import html
import math
import re
import zlib
from collections.abc import Callable, Generator, Iterator
from dataclasses import dataclass, field

# Names of HTML elements, roles and usual words of class and id names.
RAW = frozenset("script style noscript template svg iframe object canvas audio video math head title".split())
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q ruby rt rp s samp small "
    "span strike strong sub sup time tt u var wbr input".split()
)
OUT_TAGS = frozenset("nav footer aside form menu dialog button select textarea fieldset".split())
OUT_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert form alertdialog menu menubar".split())
OUT_WORDS = frozenset(
    "nav navbar navigation menu breadcrumb breadcrumbs masthead footer sidebar aside ad ads advert adverts advertisement "
    "adsense adslot promo promotion sponsor sponsored banner cookie cookies consent gdpr notice notices popup modal overlay "
    "newsletter subscribe subscription signup login social share sharing related recommended comment comments disqus respond "
    "replies widget widgets toolbar pagination pager skip copyright legal disclaimer".split()
)
#: Words that, beside the ones above, say only where or what kind of box an element is.
BOX_WORDS = frozenset(
    "site page main post posts article articles entry content links link list item items box block area section wrapper wrap "
    "container inner outer bar row col column left right top bottom button buttons btn icon icons group panel title header form "
    "author user reader primary secondary global mobile desktop fixed sticky slot unit zone region module component js is has the".split()
)
HEADER_WORDS = frozenset("header topbar".split())
MAIN_WORDS = frozenset("article content main post entry story body text".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
BOXES = frozenset("page html body div section center table tbody tr td span ()".split())
#: Elements that end an open paragraph, item, cell or term of the same kind.
CLOSES = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
    "option": ("option",), "thead": ("tr", "td", "th"), "tbody": ("tr", "td", "th"), "tfoot": ("tr", "td", "th"),
}
SCOPES = frozenset("ul ol dl table".split())
#: An element with this share of the varying text of a page without named elements holds its main text.
MOST = 0.7

TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']+|\"[^\"]*\"|'[^']*')*+|[^>]*)(?:>|\Z)", re.S
)
#: What a class or id is called: its words and short numbers; long ones number pages.
NAME = re.compile(r"[a-z]+|(?<![0-9])[0-9]{1,2}(?![0-9])")
MARKED = re.compile(r"class|id|role|hidden|style", re.I)
ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|aria-hidden|style)\b(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?", re.I)


@dataclass(slots=True)
class Node:
    """An element, a group of elements that repeats, or (without children) a text slot.

    A slot counts its texts: how many, their characters, and the smallest and largest
    hash, which agree for a text that is always the same.
    """

    key: str
    children: list[Node] | None = None
    repeated: bool = False
    optional: bool = False
    texts: list[int] = field(default_factory=list)
    stats: tuple[int, int, int, int] = (0, 0, 0, 0)
    role: str = ""

    def pack(self) -> list[list]:
        """The nodes in page order, each with the number of its children (-1: a slot)."""
        return [
            [n.key, -1 if n.children is None else len(n.children), int(n.repeated), int(n.optional), n.stats, n.role] for n in preorder(self)
        ]

    @staticmethod
    def unpack(rows: list[list]) -> Node:
        done: list[Node] = []
        for key, size, repeated, optional, stats, role in reversed(rows):
            kids = None if size < 0 else [done.pop() for _ in range(size)]
            done.append(Node(key, kids, bool(repeated), bool(optional), [], tuple(stats), role))
        return done[0]


# Pages may nest as deeply as they are long, so nothing here calls itself: nodes are
# walked with a stack, and steps that need each other's results are generators.


def preorder(node: Node, enter: Callable[[Node], bool] = lambda node: True) -> Iterator[Node]:
    """A node and all within it, in page order; nothing of those that aren't to be entered."""
    stack = [node]
    while stack:
        node = stack.pop()
        if enter(node):
            yield node
            stack.extend(reversed(node.children or ()))


def _run(step: Generator):
    """The result of a generator that yields other such generators and is sent their results."""
    stack, result = [step], None
    while stack:
        try:
            stack.append(stack[-1].send(result))
            result = None
        except StopIteration as end:
            stack.pop()
            result = end.value
    return result


def _key(tag: str, attributes: str) -> str:
    """The tag, what its class and id are called, and what they and its role say about its purpose.

    ``out`` is a name that has no word but such; one with other words besides is
    ``maybe`` out, which the wrapper decides.
    """
    if not attributes or not MARKED.search(attributes):
        return tag
    marks, names = set(), []
    for name, value in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'").lower()
        if name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and re.search(r"display\s*:\s*none", value):
            marks.add("hidden")
        elif name == "role" and value in OUT_ROLES:
            marks.add("out")
        elif name == "role" and value in ("main", "article"):
            marks.add("main")
        elif name in ("class", "id"):
            parts = set(re.findall(r"[a-z]+", value))
            names += sorted(set(NAME.findall(value)))
            if parts & OUT_WORDS:
                plain = OUT_WORDS if tag == "p" or tag in HEADINGS else OUT_WORDS | BOX_WORDS
                marks.add("out" if parts <= plain else "maybe")
            if parts & HEADER_WORDS:
                marks.add("header")
            if parts & MAIN_WORDS:
                marks.add("main")
    if "out" in marks:
        marks.discard("maybe")
    own = [f"={zlib.crc32(' '.join(names).encode()):x}"] if names else []
    return ".".join([tag, *own, *sorted(marks)])


def parse(page: str) -> tuple[Node, list[str]]:
    """The nested token stream of a page, and the texts of its slots in page order.

    Inline markup belongs to the text it stands in.  Missing end tags are put in, stray
    ones left out; a page may end anywhere.
    """
    root = Node("page", [])
    # The open elements and their tags; how many of them are inline elements with a purpose.
    stack, tags, texts, piece, marked = [root], [""], [], [], 0
    at, size = 0, len(page)

    def flush() -> None:
        if piece:
            text = "".join(piece)
            piece.clear()
            if "&" in text:
                text = html.unescape(text)
            text = " ".join(text.split())
            if text:
                top = stack[-1].children
                number = len(texts)
                texts.append(text)
                code = zlib.crc32(text.encode("utf-8", "replace"))
                top.append(Node("#", None, texts=[number], stats=(1, len(text), code, code)))

    def close(i: int) -> None:
        del stack[i:], tags[i:]

    while at < size:
        found = TAG.search(page, at)
        if not found:
            piece.append(page[at:])
            break
        if found.start() > at:
            piece.append(page[at : found.start()])
        at = max(found.end(), found.start() + 1)
        tag = (found[2] or "").lower()
        if not tag:
            continue
        if tag in RAW and not found[1]:
            if (found[3] or "").endswith("/"):
                continue
            end = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(page, at)
            at = end.end() if end else (size if tag != "head" else at)
            continue
        if found[1]:
            if tag in INLINE and not (marked and tag in tags):
                continue
            if tag in tags or tag == "p":
                flush()
            if tag in tags:
                close(len(tags) - 1 - tags[::-1].index(tag))
            continue
        inline = tag in INLINE
        if inline and not found[3]:
            if tag == "br":
                piece.append(" ")
            continue
        key = _key(tag, found[3])
        if inline:
            if not key.endswith((".hidden", ".out")) or tag in VOID:
                if tag == "br":
                    piece.append(" ")
                continue
            marked += 1
        flush()
        if tag in VOID:
            continue
        if not inline:
            if tags[-1] == "p" or tag in HEADINGS and tags[-1] in HEADINGS:
                close(len(tags) - 1)
            ends = CLOSES.get(tag, ())
            for i in range(len(tags) - 1, 0, -1) if ends else ():
                if tags[i] in ends:
                    close(i)
                    break
                if tags[i] in SCOPES:
                    break
        tags.append(tag)
        node = Node(key, [])
        stack[-1].children.append(node)
        stack.append(node)
    flush()
    return root, texts


def _same(a: Node, b: Node) -> bool:
    """Whether two nodes may be one node of a wrapper: the same tag, or two groups that begin alike."""
    if a.key != b.key:
        return False
    if a.key == "()":
        return [c.key for c in a.children] == [c.key for c in b.children]
    return True


def _merge(a: Node, b: Node) -> Generator:
    repeated, optional = a.repeated or b.repeated, a.optional or b.optional
    if a.children is None:
        (n, size, lo, hi), (m, more, low, high) = a.stats, b.stats
        stats = (n + m, size + more, min(lo, low), max(hi, high))
        return Node("#", None, repeated, optional, a.texts + b.texts, stats, a.role or b.role)
    return Node(a.key, (yield _align(a.children, b.children)), repeated, optional, role=a.role or b.role)


def _merge_all(first: list[Node], second: list[Node]) -> Generator:
    out = []
    for a, b in zip(first, second):
        out.append((yield _merge(a, b)))
    return out


def _fold(nodes: list[Node], longest: int = 6) -> Generator:
    """Finds what repeats: equal neighbours, or equal neighbouring runs of up to ``longest`` nodes."""
    out = list(nodes)
    for size in range(1, longest + 1):
        i = 0
        while i + 2 * size <= len(out):
            first, second = out[i : i + size], out[i + size : i + 2 * size]
            elements = any(n.key != "#" for n in first)
            if elements and all(map(_same, first, second)):
                both = yield _merge_all(first, second)
                if size == 1:
                    both[0].repeated = True
                    out[i : i + 2] = both
                else:
                    group = Node("()", both, repeated=True)
                    end = i + 2 * size
                    while end + size <= len(out) and all(map(_same, both, out[end : end + size])):
                        group.children = both = yield _merge_all(both, out[end : end + size])
                        end += size
                    out[i:end] = [group]
                    i += 1
            else:
                i += 1
    return out


def folded(node: Node, numbers: bool = False) -> Node:
    """A page's stream with its own repetitions found; slots keep the numbers of their texts if asked to."""
    done: list[Node] = []
    for n in reversed(list(preorder(node))):
        if n.children is None:
            done.append(Node("#", None, texts=n.texts if numbers else [], stats=n.stats))
        else:
            kids = [done.pop() for _ in n.children]
            done.append(Node(n.key, _run(_fold(kids))))
    return done[0]


def align(a: list[Node], b: list[Node]) -> list[Node]:
    """The union-free expression of two sequences.

    They are aligned on their longest common sequence of tags and slots.  What only
    one of them has is one more repetition of its neighbour if it is like it, and
    optional otherwise; texts that differ make a slot.
    """
    return _run(_align(a, b))


def _align(a: list[Node], b: list[Node]) -> Generator:
    if not a or not b:
        rest = a or b
        for node in rest:
            node.optional = True
        return list(rest)
    out: list[Node] = []

    def alone(node: Node) -> Generator:
        if out and _same(out[-1], node) and node.key != "#":
            out[-1] = yield _merge(out[-1], node)
            out[-1].repeated = True
        else:
            node.optional = True
            out.append(node)

    i = j = 0
    for k, m in [*_pairs(a, b), (len(a), len(b))]:
        for node in [*a[i:k], *b[j:m]]:
            yield alone(node)
        if k < len(a):
            out.append((yield _merge(a[k], b[m])))
        i, j = k + 1, m + 1
    return (yield _fold(out))


def _likeness(node: Node) -> str | tuple[str, ...]:
    """Two nodes are ``_same`` where these are equal."""
    return tuple(c.key for c in node.children) if node.key == "()" else node.key


def _pairs(a: list[Node], b: list[Node]) -> list[tuple[int, int]]:
    """Places of the longest common sequence, whatever the lengths.

    What both begin and end with needs no table.  A row of the table is one number whose
    bits say where the length grows along ``b``; a row follows from the one below it by
    a sum.  Only the rows of one block of ``a``, and the row that each block begins with,
    are held at once, so memory grows with the length of one times the root of the other's.
    """
    first, shorter = 0, min(len(a), len(b))
    while first < shorter and _same(a[first], b[first]):
        first += 1
    last = 0
    while last < shorter - first and _same(a[-1 - last], b[-1 - last]):
        last += 1
    ends = [(len(a) - k, len(b) - k) for k in range(last, 0, -1)]
    pairs = [(k, k) for k in range(first)]
    rows = [_likeness(n) for n in a[first : len(a) - last]]
    cols = [_likeness(n) for n in b[first : len(b) - last]]
    if not rows or not cols:
        return pairs + ends
    return pairs + [(first + i, first + j) for i, j in _common(rows, cols)] + ends


def _common(rows: list, cols: list) -> list[tuple[int, int]]:
    """Of all longest common sequences, the one that takes a match at once and else leaves out of ``rows`` first.

    Bit ``k`` of a row counts from the end of ``cols`` and is 0 where the length grows.
    """
    size, width = len(cols), len(cols) + 7 >> 3
    full, places = (1 << size) - 1, {}
    for k, key in enumerate(reversed(cols)):
        places.setdefault(key, []).append(k)
    masks = {}
    for key in set(rows) & places.keys():
        bits = bytearray(width)
        for k in places[key]:
            bits[k >> 3] |= 1 << (k & 7)
        masks[key] = int.from_bytes(bits, "little")

    def above(row: int, i: int) -> int:
        taken = row & masks.get(rows[i], 0)
        return ((row + taken) | (row - taken)) & full

    step = max(1, math.isqrt(len(rows)))
    kept, row = {len(rows): full}, full
    for i in range(len(rows) - 1, -1, -1):
        row = above(row, i)
        if i % step == 0:
            kept[i] = row
    pairs, j = [], 0
    for start in range(0, len(rows), step):
        end = min(start + step, len(rows))
        block = [kept[end]]
        for i in range(end - 1, start, -1):
            block.append(above(block[-1], i))
        block.append(kept[start])
        for i in range(start, end):
            # Whether the length from here on is less without this row.
            left, upper, lower = size - j, block[end - i], block[end - i - 1]
            if cols[j] != rows[i]:
                below = (1 << left) - 1
                gain = (lower & below).bit_count() - (upper & below).bit_count()
                if gain:
                    with_it, without = upper.to_bytes(width, "little"), lower.to_bytes(width, "little")
                while gain and cols[size - left] != rows[i]:
                    left -= 1
                    at, bit = left >> 3, 1 << (left & 7)
                    gain += bool(with_it[at] & bit) - bool(without[at] & bit)
                j = size - left
            if cols[j] == rows[i]:
                pairs.append((i, j))
                j += 1
                if j == size:
                    return pairs
    return pairs


def _tag(node: Node) -> str:
    return node.key.partition(".")[0]


def _kind(node: Node) -> str:
    """out, maybe (out), header, main or nothing: what an element says of what is in it."""
    tag, *marks = node.key.split(".")
    if tag in OUT_TAGS or "hidden" in marks:
        return "out"
    if tag in ("article", "main"):
        return "main"
    if tag == "header" or "header" in marks:
        return "header"
    if "out" in marks or "maybe" in marks:
        return "out" if "out" in marks else "maybe"
    return "main" if "main" in marks and tag not in INLINE and tag not in HEADINGS and tag not in ("p", "body", "page", "html") else ""


def _holding(root: Node) -> set[int]:
    """The elements that have an article or main element in them."""
    found: set[int] = set()
    for node in reversed(list(preorder(root))):
        if any(id(c) in found or _tag(c) in ("article", "main") for c in node.children or ()):
            found.add(id(node))
    return found


def _chars(node: Node) -> int:
    return sum(n.stats[1] for n in preorder(node, lambda n: n.children is None or _kind(n) != "out") if n.children is None)


def _mains(root: Node, named: bool, holding: set[int]) -> list[Node]:
    """The outermost main elements in an element, by tag if ``named``, by class, id or role otherwise."""
    out: list[Node] = []

    def enter(node: Node) -> bool:
        if node is root:
            return True
        if node.children is None:
            return False
        kind, tag = _kind(node), _tag(node)
        if kind == "out" and id(node) not in holding:
            return False
        if kind == "main" and (tag in ("article", "main") or not named):
            out.append(node)
            return False
        return True

    for _ in preorder(root, enter):
        pass
    return out


def _read(root: Node) -> bool:
    """Whether a page that is being read has text in an element, outside menus, headers and the like."""
    stack = [(root, False)]
    while stack:
        node, header = stack.pop()
        if node.children is None:
            if node.texts and not header:
                return True
            continue
        kind = _kind(node)
        if kind != "out":
            header = (header or kind == "header") and _tag(node) not in HEADINGS
            stack.extend((c, header) for c in node.children)
    return False


def assign_roles(root: Node, has: Callable[[Node], bool | int] = _chars) -> None:
    """Marks the slots of a wrapper: ``main`` or ``out``.

    Main is what lies in the article (elements of that name, or else the element that
    class, id or role call content and that holds most text).  Where none is named, it is
    the innermost box that holds most of the text that varies across the host's pages,
    without texts that are the same on all of three or more pages; and everything where
    nothing varies.  Only elements that ``has`` something count, so that pages of another
    template than most of the host's get what they have themselves.  Menus, headers,
    footers and the like within it are out, but not a header's headings; elements whose
    name only contains such a word are out if their texts never vary.
    """
    holding, mains = _holding(root), []
    for main in filter(has, _mains(root, True, holding)):
        inner = list(filter(has, _mains(main, True, holding))) if _tag(main) == "main" else []
        mains += inner or [main]
    if not mains:
        mains = sorted(filter(has, _mains(root, False, holding)), key=_chars)[-1:]
    unnamed, vary = not mains, _varies(root)
    if unnamed and vary:
        mains = _densest(root, has)
    chosen = set(map(id, mains))

    stack = [(root, not chosen, True, False)]
    while stack:
        node, inside, kept, header = stack.pop()
        for child in node.children or ():
            if child.children is None:
                n, _, lo, hi = child.stats
                # The texts of a page that is read again count once.
                same = unnamed and vary and not child.repeated and n - len(child.texts) >= 3 and lo == hi
                child.role = "main" if inside and kept and not header and not same else "out"
                continue
            here = inside or id(child) in chosen
            kind, tag = _kind(child), _tag(child)
            if id(child) in chosen or kind == "out" and id(child) in holding:
                stack.append((child, here, kept, header))
            else:
                shown = kind != "out" and not (kind == "maybe" and _constant(child))
                stack.append((child, here, kept and shown, (header or kind == "header") and tag not in HEADINGS))


def _constant(node: Node) -> bool:
    """Whether three pages or more have the element's texts, and all of them the same ones."""
    slots = [n for n in preorder(node) if n.children is None]
    return all(n.stats[0] - len(n.texts) >= 3 and n.stats[2] == n.stats[3] for n in slots)


def _densest(root: Node, has: Callable[[Node], bool | int]) -> list[Node]:
    """The innermost box with most of the varying text, unless that is spread over the page."""
    weight: dict[int, int] = {}
    for node in reversed(list(preorder(root))):
        if node.children is None:
            weight[id(node)] = node.stats[1] if _differs(node) else 0
        else:
            weight[id(node)] = 0 if _kind(node) in ("out", "header") else sum(weight[id(c)] for c in node.children)
    total, node = weight[id(root)], root
    while True:
        if any(weight[id(c)] and (c.children is None or _tag(c) not in BOXES) for c in node.children):
            break
        best = max((c for c in node.children if has(c)), key=lambda c: weight[id(c)], default=None)
        if best is None or weight[id(best)] < MOST * total:
            break
        node = best
    return [] if node is root else [node]


def _differs(slot: Node) -> bool:
    """Whether a slot's texts vary among three or more texts of other pages (those of the page that is read are in ``texts``)."""
    return slot.stats[0] - len(slot.texts) >= 3 and slot.stats[2] != slot.stats[3]


def _varies(root: Node) -> bool:
    return any(n.children is None and _differs(n) for n in preorder(root))


def shape(root: Node) -> str:
    """The structure alone: pages of one shape are treated alike."""
    out: list[str] = []
    stack: list[Node | str] = [root]
    while stack:
        node = stack.pop()
        if isinstance(node, str):
            out.append(node)
        elif node.children is None:
            out.append("#")
        else:
            out.append(f"{node.key}(")
            stack.append(")")
            stack.extend(reversed(node.children))
    return "".join(out)


def main_texts(wrapper: Node, page: Node) -> list[int]:
    """Numbers of the page's texts that fall into main slots of the wrapper and the page together.

    Roles are given once the page is part of the wrapper, so that a text without a
    partner there gets the role of the elements that it stands in.
    """
    root = align([wrapper], [folded(page, True)])[0]
    assign_roles(root, _read)
    return sorted(t for n in preorder(root) if n.role == "main" for t in n.texts)
