"""A small forgiving DOM for whole pages, and simple tree matching between two of them."""

from __future__ import annotations

import re
from collections import Counter
from html import unescape

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|</([a-zA-Z][^\s/>]*)[^>]*>|<([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*\"|'[^']*')*+[^>]*)>", re.S
)
ATTRIBUTE = re.compile(r"([a-zA-Z_:][-\w:.]*)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
#: Fixed by HTML: elements without content, elements whose content is not markup, and the
#: elements that each opening tag ends if they are still open.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
ENDS = {
    **dict.fromkeys("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split(), ("p",)),
    "li": ("li", "p"), "dt": ("dt", "dd", "p"), "dd": ("dt", "dd", "p"), "option": ("option",),
    "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
}
#: An end implied by an opening tag is not looked for beyond these.
WALLS = frozenset("html body article aside blockquote div fieldset footer form header main nav ol section table ul dl td th".split())


class Node:
    __slots__ = ("tag", "key", "attributes", "items", "kids", "sig", "size", "at")

    def __init__(self, tag: str, attributes: str):
        self.tag, self.attributes, self.items, self.kids = tag, attributes, [], []
        self.key = (tag, attribute(attributes, "class"))

    def own_text(self) -> str:
        return " ".join(unescape("\n".join(i for i in self.items if type(i) is str)).split())


def attribute(attributes: str, name: str) -> str:
    """An attribute's value, "" if it is missing; a bare attribute has its own name."""
    if name not in attributes:
        return ""
    for found, value in ATTRIBUTE.findall(attributes):
        if found.lower() == name:
            return unescape(value.strip("\"'")) if value else name
    return ""


def parse(html: str) -> Node:
    """The tree of a page; nothing in the text makes it fail, and no text is lost but raw elements'."""
    root = Node("", "")
    stack, pos, n = [root], 0, len(html)
    opened = Counter()  # open elements of each tag, so that the stack is searched only for what it holds

    def close(k: int) -> None:
        opened.subtract(e.tag for e in stack[k:])
        del stack[k:]

    while pos < n:
        m = TOKEN.search(html, pos)
        if m is None:
            stack[-1].items.append(html[pos:])
            break
        if m.start() > pos:
            stack[-1].items.append(html[pos : m.start()])
        pos = m.end()
        if m[2]:
            tag = m[2].lower()
            ends = ENDS.get(tag, ())
            for k in range(len(stack) - 1, 0, -1) if any(opened[e] for e in ends) else ():
                if stack[k].tag in ends:
                    close(k)
                    break
                if stack[k].tag in WALLS:
                    break
            node = Node(tag, m[3])
            stack[-1].items.append(node)
            stack[-1].kids.append(node)
            if tag in RAW:
                found = re.compile(rf"</{tag}\b[^>]*>", re.I).search(html, pos)
                pos = found.end() if found else n
            elif tag not in VOID and not m[3].endswith("/"):
                stack.append(node)
                opened[tag] += 1
        elif m[1]:
            tag = m[1].lower()
            for k in range(len(stack) - 1, 0, -1) if opened[tag] else ():
                if stack[k].tag == tag:
                    close(k)
                    break
                if stack[k].tag in WALLS and tag not in WALLS:
                    break
    order = [root]
    for node in order:
        order += node.kids
    for at in range(len(order) - 1, -1, -1):
        node = order[at]
        node.sig = hash((node.key, tuple(k.sig for k in node.kids)))
        node.size = 1 + sum(k.size for k in node.kids)
        node.at = at
    return root


def scored(a: Node, b: Node, known: dict) -> int | None:
    """The score of two trees if it needs no others' than those known."""
    if a.key != b.key:
        return 0
    if a.sig == b.sig:
        return a.size
    if not a.kids or not b.kids:
        return 1
    return known.get((a.sig, b.sig))


def score(a: Node, b: Node, known: dict) -> int:
    """Simple tree matching: most nodes that pair up with order and ancestry kept. It depends on the two shapes only."""
    todo = [(a, b)]
    while todo:  # pairs wait for those of their children, at any depth
        x, y = todo[-1]
        if scored(x, y, known) is not None:
            todo.pop()
            continue
        left, right, same, _, _ = middle(x.kids, y.kids)
        if missing := [(p, q) for p in left for q in right if scored(p, q, known) is None]:
            todo += missing
        else:
            known[x.sig, y.sig] = 1 + table(left, right, known)[-1][-1] + same
    return scored(a, b, known)


def middle(a: list, b: list):
    """What is left of two child lists without the ends that have the same shapes, and the nodes in those."""
    i, j, shortest, same = 0, 0, min(len(a), len(b)), 0
    while i < shortest and a[i].sig == b[i].sig:
        same += a[i].size
        i += 1
    while j < shortest - i and a[-1 - j].sig == b[-1 - j].sig:
        same += a[-1 - j].size
        j += 1
    return a[i : len(a) - j], b[i : len(b) - j], same, i, j


def table(a: list, b: list, known: dict) -> list[list[int]]:
    rows = [[0] * (len(b) + 1)]
    for x in a:
        above, row = rows[-1], [0]
        for j, y in enumerate(b):
            best = max(above[j + 1], row[j])
            if x.key == y.key:
                best = max(best, above[j] + score(x, y, known))
            row.append(best)
        rows.append(row)
    return rows


def align(a: Node, b: Node, known: dict) -> list[tuple[Node, Node]]:
    """Pairs of matched nodes of two trees, by simple tree matching from the roots down."""
    pairs, todo = [], [(a, b)]
    while todo:
        x, y = todo.pop()
        pairs.append((x, y))
        left, right, _, i, j = middle(x.kids, y.kids)
        todo += zip(x.kids[:i], y.kids[:i])
        if j:
            todo += zip(x.kids[-j:], y.kids[-j:])
        if left and right:
            rows, p, q = table(left, right, known), len(left), len(right)
            while p and q:
                if rows[p][q] == rows[p - 1][q]:
                    p -= 1
                elif rows[p][q] == rows[p][q - 1]:
                    q -= 1
                else:
                    p, q = p - 1, q - 1
                    todo.append((left[p], right[q]))
    return pairs
