"""Strings as shared trees: joined in constant time and compared without being written out."""

from dataclasses import dataclass
from typing import Self

_PRIME = (1 << 61) - 1
_BASE = 1_000_003


@dataclass(frozen=True, slots=True, eq=False)
class Rope:
    """A leaf holds ``text``; an inner node its two parts. ``mark`` is a hash of the characters."""

    size: int
    mark: int
    text: str = ""
    left: Self | None = None
    right: Self | None = None

    @classmethod
    def of(cls, text: str) -> Self:
        mark = 0
        for c in text:
            mark = (mark * _BASE + ord(c)) % _PRIME
        return cls(len(text), mark, text)

    def __add__(self, other: Self) -> Self:
        if not self.size or not other.size:
            return self if self.size else other
        mark = (self.mark * pow(_BASE, other.size, _PRIME) + other.mark) % _PRIME
        return Rope(self.size + other.size, mark, "", self, other)

    def __str__(self) -> str:
        parts, left = [], [self]
        while left:
            node = left.pop()
            if node.left is None:
                parts.append(node.text)
            else:
                left += [node.right, node.left]
        return "".join(parts)

    def __lt__(self, other: Self) -> bool:
        """By code points; equal stretches are stepped over by their size and hash."""
        a, b = [self], [other]
        while a and b:
            x, y = a.pop(), b.pop()
            if x is y or (x.size == y.size and x.mark == y.mark):
                continue
            if x.left is not None and (x.size >= y.size or y.left is None):
                a += [x.right, x.left]
                b.append(y)
            elif y.left is not None:
                b += [y.right, y.left]
                a.append(x)
            else:
                n = min(x.size, y.size)
                if x.text[:n] != y.text[:n]:
                    return x.text < y.text
                if x.size > n:
                    a.append(Rope.of(x.text[n:]))
                if y.size > n:
                    b.append(Rope.of(y.text[n:]))
        return bool(b) and not a
