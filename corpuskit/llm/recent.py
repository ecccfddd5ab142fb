"""A bounded cache for one worker."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import TypeVar

V = TypeVar("V")


class Recent:
    """Values of strings that occurred lately, at most `size` of them.

    Two generations: when the young one is full it becomes the old one, and what
    is met again moves to the new young one, so frequent strings stay whatever
    comes between.
    """

    def __init__(self, size: int, longest: int):
        self.half, self.longest = size // 2, longest
        self.young: dict[str, V] = {}
        self.old: dict[str, V] = {}

    def look_up(self, strings: Sequence[str], make: Callable[[list[str]], Sequence[V]]) -> list[V]:
        """A value for each string; `make` gives the values of those that are not kept."""
        values = list(map(self.young.get, strings))
        if None not in values:
            return values
        missing = {s for s, v in zip(strings, values, strict=True) if v is None}
        found = {s: self.old[s] for s in missing if s in self.old}
        new = [s for s in missing if s not in found]
        if new:
            found.update(zip(new, make(new), strict=True))
        values = [found[s] if v is None else v for s, v in zip(strings, values, strict=True)]
        if len(self.young) + len(found) > self.half:
            self.old, self.young = self.young, {}
        self.young.update((s, v) for s, v in found.items() if len(s) <= self.longest)
        return values
