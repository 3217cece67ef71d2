"""Adaptive radix tree over byte strings, whose members are counted and summed.

Leis et al., "The Adaptive Radix Tree". A node holds the bytes that all keys below it
have in common (path compression), and its children in a layout that grows with their
number: up to 4 and up to 16 sorted key bytes, up to 48 behind an index of 256, or 256
places. A key may be the beginning of another.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator


class Sorted:
    """Few children: their bytes in order, and the children beside them."""

    def __init__(self, room: int = 4):
        self.room, self.bytes, self.kids = room, bytearray(), []

    def get(self, byte: int) -> Node | None:
        at = self.bytes.find(byte)
        return None if at < 0 else self.kids[at]

    def put(self, byte: int, node: Node) -> bool:
        at = bisect_left(self.bytes, byte)
        if at < len(self.bytes) and self.bytes[at] == byte:
            self.kids[at] = node
        elif len(self.kids) == self.room:
            return False
        else:
            self.bytes.insert(at, byte)
            self.kids.insert(at, node)
        return True

    def items(self) -> Iterator[tuple[int, Node]]:
        return zip(self.bytes, self.kids)

    def larger(self) -> Sorted | Indexed:
        return Sorted(16) if self.room == 4 else Indexed()


class Indexed:
    """Up to 48 children in order of arrival, and for each byte which of them it is."""

    room = 48

    def __init__(self):
        self.index, self.kids = bytearray(256), []

    def get(self, byte: int) -> Node | None:
        at = self.index[byte]
        return self.kids[at - 1] if at else None

    def put(self, byte: int, node: Node) -> bool:
        if self.index[byte]:
            self.kids[self.index[byte] - 1] = node
        elif len(self.kids) == self.room:
            return False
        else:
            self.kids.append(node)
            self.index[byte] = len(self.kids)
        return True

    def items(self) -> Iterator[tuple[int, Node]]:
        return ((byte, self.kids[at - 1]) for byte, at in enumerate(self.index) if at)

    def larger(self) -> Direct:
        return Direct()


class Direct:
    """A place for each byte."""

    room = 256

    def __init__(self):
        self.kids: list[Node | None] = [None] * 256

    def get(self, byte: int) -> Node | None:
        return self.kids[byte]

    def put(self, byte: int, node: Node) -> bool:
        self.kids[byte] = node
        return True

    def items(self) -> Iterator[tuple[int, Node]]:
        return ((byte, kid) for byte, kid in enumerate(self.kids) if kid is not None)


class Node:
    """prefix: bytes between the parent's branch and this node. n, first, leaves and
    saved are of the members whose key ends here; ended are those that end for good."""

    __slots__ = ("prefix", "layout", "n", "first", "leaves", "saved", "ended")

    def __init__(self, prefix: bytes):
        self.prefix = prefix
        self.layout: Sorted | Indexed | Direct | None = None
        self.n, self.first, self.leaves, self.saved, self.ended = 0, None, 0, 0, None

    def kid(self, byte: int) -> Node | None:
        return None if self.layout is None else self.layout.get(byte)

    def put(self, byte: int, node: Node) -> None:
        if self.layout is None:
            self.layout = Sorted()
        if not self.layout.put(byte, node):
            grown = self.layout.larger()
            for old, kid in self.layout.items():
                grown.put(old, kid)
            grown.put(byte, node)
            self.layout = grown

    def kids(self) -> Iterator[tuple[int, Node]]:
        return iter(()) if self.layout is None else self.layout.items()

    def add(self, member: int, leaves: int, saved: int, ends: bool) -> None:
        self.n += 1
        self.first = member if self.first is None or member < self.first else self.first
        self.leaves += leaves
        self.saved += saved
        if ends:
            self.ended = self.ended or []
            self.ended.append(member)


class RadixTree:
    def __init__(self):
        self.root = Node(b"")

    def place(self, key: bytes) -> Node:
        """The node at which a key ends; made if there is none."""
        above, edge, node, at = None, 0, self.root, 0
        while True:
            prefix = node.prefix
            same = _common(prefix, key, at)
            if same < len(prefix):  # the key leaves, or ends, within the prefix: cut it there
                upper = Node(prefix[:same])
                node.prefix = prefix[same + 1 :]
                upper.put(prefix[same], node)
                if above is None:
                    self.root = upper
                else:
                    above.put(edge, upper)
                node = upper
            at += same
            if at == len(key):
                return node
            below = node.kid(key[at])
            if below is None:
                made = Node(bytes(key[at + 1 :]))
                node.put(key[at], made)
                return made
            above, edge, node, at = node, key[at], below, at + 1


def _common(prefix: bytes, key: bytes, at: int) -> int:
    """How many bytes of prefix stand in key from ``at`` on."""
    if key.startswith(prefix, at):
        return len(prefix)
    same, most = 0, min(len(prefix), len(key) - at)
    while same < most and prefix[same] == key[at + same]:
        same += 1
    return same
