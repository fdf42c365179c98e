"""Compressed (radix) tries of whole texts, with the smallest id of each text at its end."""

from __future__ import annotations

from collections.abc import Hashable, Iterator


class Node:
    """An edge's bytes, the nodes below by their first byte, and at the end of a text what was put there."""

    __slots__ = ("edge", "below", "least", "rows", "note")

    def __init__(self, edge: bytes):
        self.edge = edge
        self.below: dict[int, Node] = {}
        self.least: float | None = None
        self.rows: dict[Hashable, int] | None = None
        self.note = None


class Trie:
    """Texts as paths; no two edges below a node begin alike, so equal texts end at one node."""

    def __init__(self):
        self.root = Node(b"")
        #: Bytes of all edges and rows held, for callers that bound them.
        self.n_bytes = self.n_rows = 0

    def end_of(self, text: bytes) -> Node:
        """The node where ``text`` ends, made where it is new."""
        node, at = self.root, 0
        while at < len(text):
            child = node.below.get(text[at])
            if child is None:
                child = node.below[text[at]] = Node(text[at:])
                self.n_bytes += len(text) - at
                return child
            edge = child.edge
            if not text.startswith(edge, at):
                shared = _shared(edge, text, at)
                upper = Node(edge[:shared])
                child.edge = edge[shared:]
                upper.below[child.edge[0]] = child
                node.below[text[at]] = child = upper
            node, at = child, at + len(child.edge)
        return node

    def add(self, node: Node, least: float, row: Hashable, n: int) -> None:
        """Put ``n`` rows of the kind ``row`` at a text's end."""
        if node.rows is None:
            node.least, node.rows = least, {}
        node.least = min(node.least, least)
        if row not in node.rows:
            self.n_rows += 1
        node.rows[row] = node.rows.get(row, 0) + n

    def ends(self) -> Iterator[tuple[bytes, Node]]:
        """All texts held with their end nodes; depth first, one path in hand at a time."""
        stack = [(self.root, b"")]
        while stack:
            node, before = stack.pop()
            text = before + node.edge
            if node.rows is not None:
                yield text, node
            stack += [(child, text) for child in node.below.values()]


def _shared(edge: bytes, text: bytes, at: int) -> int:
    """Length of the common prefix of an edge and the text from ``at``, by halving."""
    low, high = 0, min(len(edge), len(text) - at)
    while low < high:
        half = (low + high + 1) // 2
        if text.startswith(edge[low:half], at + low):
            low = half
        else:
            high = half - 1
    return low
