"""An adaptive radix tree over byte strings: nodes grow from 4 over 16 and 48 to 256 places as children
come, and bytes that lead to a single place are kept as one path."""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from typing import Any


class Sorted:
    """Up to 4, then up to 16 children beside their bytes in order."""

    __slots__ = ("bytes", "children", "room")

    def __init__(self) -> None:
        self.bytes, self.children, self.room = bytearray(), [], 4

    def get(self, byte: int) -> Node | None:
        at = self.bytes.find(byte)
        return self.children[at] if at >= 0 else None

    def add(self, byte: int, child: Node) -> Layout:
        if len(self.bytes) == self.room:
            if self.room == 16:
                return Indexed(self).add(byte, child)
            self.room = 16
        at = bisect_left(self.bytes, byte)
        self.bytes.insert(at, byte)
        self.children.insert(at, child)
        return self

    def items(self) -> Iterator[tuple[int, Node]]:
        return zip(self.bytes, self.children)


class Indexed:
    """Up to 48 children in order of arrival; a place per byte holds the child's number."""

    __slots__ = ("places", "children")

    def __init__(self, smaller: Sorted) -> None:
        self.places, self.children = bytearray(256), []
        for byte, child in smaller.items():
            self.add(byte, child)

    def get(self, byte: int) -> Node | None:
        place = self.places[byte]
        return self.children[place - 1] if place else None

    def add(self, byte: int, child: Node) -> Layout:
        if len(self.children) == 48:
            return Direct(self).add(byte, child)
        self.children.append(child)
        self.places[byte] = len(self.children)
        return self

    def items(self) -> Iterator[tuple[int, Node]]:
        return ((byte, self.children[place - 1]) for byte, place in enumerate(self.places) if place)


class Direct:
    """A place for every byte."""

    __slots__ = ("children",)

    def __init__(self, smaller: Indexed) -> None:
        self.children: list[Node | None] = [None] * 256
        for byte, child in smaller.items():
            self.children[byte] = child

    def get(self, byte: int) -> Node | None:
        return self.children[byte]

    def add(self, byte: int, child: Node) -> Layout:
        self.children[byte] = child
        return self

    def items(self) -> Iterator[tuple[int, Node]]:
        return ((byte, child) for byte, child in enumerate(self.children) if child is not None)


Layout = Sorted | Indexed | Direct


class Node:
    """``path`` follows the byte that leads here; ``value`` belongs to the key that ends here."""

    __slots__ = ("path", "layout", "value", "note")

    def __init__(self, path: bytes, value: Any = None) -> None:
        self.path, self.layout, self.value, self.note = path, Sorted(), value, None


def shared(left: bytes, right: bytes) -> int:
    """Length of the common start."""
    low, high = 0, min(len(left), len(right))
    if left[:high] == right[:high]:
        return high
    while high - low > 1:
        middle = (low + high) // 2
        if left[low:middle] == right[low:middle]:
            low = middle
        else:
            high = middle
    return low


class RadixTree:
    def __init__(self) -> None:
        self.root: Node | None = None

    def insert(self, key: bytes, value: Any) -> None:
        """A key once more replaces its value."""
        if self.root is None:
            self.root = Node(key, value)
            return
        node, at = self.root, 0
        while True:
            common = len(node.path) if key.startswith(node.path, at) else shared(node.path, key[at : at + len(node.path)])
            if common < len(node.path):
                self._split(node, common)
            at += common
            if at == len(key):
                node.value = value
                return
            child = node.layout.get(key[at])
            if child is None:
                node.layout = node.layout.add(key[at], Node(key[at + 1 :], value))
                return
            node, at = child, at + 1

    @staticmethod
    def _split(node: Node, common: int) -> None:
        lower = Node(node.path[common + 1 :], node.value)
        lower.layout = node.layout
        node.layout = Sorted().add(node.path[common], lower)
        node.path, node.value = node.path[:common], None

    def walk(self) -> Iterator[tuple[Node, Node | None, int, bytes]]:
        """Nodes, parents first, each with its parent, the depth in bytes at which its own bytes begin,
        and these bytes: the one that leads to it and its path."""
        stack = [(self.root, None, 0, self.root.path)] if self.root else []
        while stack:
            node, parent, begin, own = stack.pop()
            yield node, parent, begin, own
            end = begin + len(own)
            stack.extend((child, node, end, bytes((byte,)) + child.path) for byte, child in node.layout.items())
