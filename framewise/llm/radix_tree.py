"""Adaptive radix tree over byte strings: node layouts that grow, edges that hold whole byte runs."""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Callable, Iterator
from typing import Any


class _Sorted:
    """Up to 4, then up to 16 children: sorted bytes beside the children."""

    __slots__ = ("bytes", "kids", "room")

    def __init__(self, room: int = 4) -> None:
        self.bytes, self.kids, self.room = bytearray(), [], room

    def get(self, byte: int) -> Node | None:
        i = bisect_left(self.bytes, byte)
        return self.kids[i] if i < len(self.bytes) and self.bytes[i] == byte else None

    def put(self, byte: int, kid: Node) -> Any:
        """Add or replace a child; gives the layout that holds it now."""
        i = bisect_left(self.bytes, byte)
        if i < len(self.bytes) and self.bytes[i] == byte:
            self.kids[i] = kid
            return self
        if len(self.kids) == self.room:
            if self.room == 16:
                return _grown(self, _Indexed()).put(byte, kid)
            self.room = 16
        self.bytes.insert(i, byte)
        self.kids.insert(i, kid)
        return self

    def items(self) -> Iterator[tuple[int, Node]]:
        return zip(self.bytes, self.kids)


class _Indexed:
    """Up to 48 children: 256 one-byte places into a short list."""

    __slots__ = ("at", "kids")

    def __init__(self) -> None:
        self.at, self.kids = bytearray(256), []

    def get(self, byte: int) -> Node | None:
        return self.kids[self.at[byte] - 1] if self.at[byte] else None

    def put(self, byte: int, kid: Node) -> Any:
        if self.at[byte]:
            self.kids[self.at[byte] - 1] = kid
            return self
        if len(self.kids) == 48:
            return _grown(self, _Direct()).put(byte, kid)
        self.kids.append(kid)
        self.at[byte] = len(self.kids)
        return self

    def items(self) -> Iterator[tuple[int, Node]]:
        return ((b, self.kids[i - 1]) for b, i in enumerate(self.at) if i)


class _Direct:
    """Up to 256 children, one place a byte."""

    __slots__ = ("kids",)

    def __init__(self) -> None:
        self.kids: list[Node | None] = [None] * 256

    def get(self, byte: int) -> Node | None:
        return self.kids[byte]

    def put(self, byte: int, kid: Node) -> Any:
        self.kids[byte] = kid
        return self

    def items(self) -> Iterator[tuple[int, Node]]:
        return ((b, k) for b, k in enumerate(self.kids) if k is not None)


def _grown(old: Any, new: Any) -> Any:
    for byte, kid in old.items():
        new.put(byte, kid)
    return new


class Node:
    """``label``: the bytes from the parent's end to this node's; ``value``: of the key that ends here."""

    __slots__ = ("label", "kids", "value")

    def __init__(self, label: bytes, value: Any = None) -> None:
        self.label, self.value, self.kids = label, value, _Sorted()


class RadixTree:
    """Keys with values; the values of equal keys are put together by ``merge``."""

    def __init__(self, merge: Callable[[Any, Any], Any]) -> None:
        self.root, self.merge, self.n_keys = Node(b""), merge, 0

    def insert(self, key: bytes, value: Any) -> None:
        node, at, parent = self.root, 0, None
        while True:
            label = node.label
            if not key.startswith(label, at):
                same = 0
                while at + same < len(key) and key[at + same] == label[same]:
                    same += 1
                upper = Node(label[:same])
                node.label = label[same:]
                upper.kids = upper.kids.put(node.label[0], node)
                parent.kids = parent.kids.put(label[0], upper)
                node, label = upper, upper.label
            at += len(label)
            if at == len(key):
                if node.value is None:
                    self.n_keys += 1
                node.value = value if node.value is None else self.merge(node.value, value)
                return
            kid = node.kids.get(key[at])
            if kid is None:
                node.kids = node.kids.put(key[at], Node(key[at:], value))
                self.n_keys += 1
                return
            parent, node = node, kid

    def totals(self, width: int) -> Iterator[tuple[int, Any]]:
        """(depth, merged value of all keys below) of every node and every point of an edge at a multiple of ``width``.

        Depths count units of ``width`` bytes; other nodes and points are not
        given.  Subtrees come before what holds them.  Recursion goes as deep
        as the longest key at most.
        """
        def walk(node: Node, begin: int) -> Iterator[tuple[int, Any]]:
            end, total = begin + len(node.label), node.value
            for _, kid in node.kids.items():
                below = yield from walk(kid, end)
                total = below if total is None else self.merge(total, below)
            for depth in range(end // width, begin // width, -1):
                yield depth, total
            return total

        total = yield from walk(self.root, 0)
        if total is not None:
            yield 0, total
