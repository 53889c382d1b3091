"""Texts cut where pre-tokens must end, and a cache of what each piece gives.

A space or a line end between two characters that aren't white space always begins a pre-token of the byte-level pattern
(the word pattern drops both), so a text's tokens are those of its pieces in a row. Most pieces occur again
and again; each new one is worked out once.
"""

from __future__ import annotations

import ctypes
import re
from collections.abc import Callable, Hashable, Iterator
from typing import Any

import pyarrow as pa

INNER_SPACE = re.compile(r"(?<=\S) (?=\S)")
#: Marks a piece that follows no space.
BARE = "\0"
#: Characters that are cut at a time.
SOME = 2_000_000


def odd(piece: str) -> bool:
    """Whether the cut beside this piece isn't one of those that always hold."""
    text = piece[1:] if piece[:1] == BARE else piece
    return piece != "\n" and (not text or text[0].isspace() or text[-1].isspace() or BARE in text)


_held: dict = {}


def held(key: Hashable, make: Callable[[], Any]) -> Any:
    """What a worker process keeps from task to task, made when it is first asked for: one thing at a time."""
    if key not in _held:
        _held.clear()
        _held[key] = make()
    return _held[key]


def let_go() -> None:
    """For tasks that need the memory themselves."""
    _held.clear()
    give_back()


def give_back() -> None:
    """Hands memory that is free within the process back to the system, for the other processes of an executor."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


class Numbers(dict):
    """Numbers pieces in the order in which they first come up.

    The first ones, which are the frequent ones, are in a dictionary of their own, small enough for a processor's cache.
    """

    SMALL = 20_000

    def __init__(self):
        super().__init__()
        self.order: list[str] = []
        self.rest: dict[str, int] = {}

    def __missing__(self, piece: str) -> int:
        number = self.rest.get(piece)
        if number is None:
            number = len(self.order)
            self.order.append(piece)
            (self if number < self.SMALL else self.rest)[piece] = number
        return number

    def find(self, piece: str) -> int | None:
        return self.get(piece, self.rest.get(piece))


class PieceCache:
    """Values of pieces by text; values(pieces) works out new ones.

    A full cache begins afresh, and takes what comes up again from the one before, which is then let go. So memory is
    bounded, and pieces that come up often are worked out once.
    """

    def __init__(self, values: Callable[[list[str]], list], limit: int = 200_000):
        self.values, self.limit = values, limit
        self.numbers, self.known = Numbers(), []
        self.before, self.known_before = Numbers(), []

    def of(self, texts: list[str]) -> Iterator[list]:
        """For each text, the values of its pieces in order. Works through about SOME characters at a time."""
        held, size = [], 0
        for text in texts:
            held.append(text)
            size += len(text)
            if size >= SOME:
                yield from self._of(held)
                held, size = [], 0
        yield from self._of(held)

    def _of(self, texts: list[str]) -> Iterator[list]:
        if len(self.known) > self.limit:
            self.before, self.known_before = self.numbers, self.known
            self.numbers, self.known = Numbers(), []
        number = self.numbers.__getitem__
        # Texts as lists of numbers; a new piece gets its number at once and its value below.
        split = [list(map(number, f"{BARE}{t.replace('\n', f' \n {BARE}')}".split(" "))) for t in texts]
        self._learn(self.numbers.order[len(self.known) :])
        get = self.known.__getitem__
        for text, pieces in zip(texts, split, strict=True):
            found = list(map(get, pieces))
            yield self._careful(text) if None in found or BARE in text else found

    def _careful(self, text: str) -> list:
        first, *later = INNER_SPACE.split(text)
        return self.values([first, *(f" {p}" for p in later)])

    def _learn(self, pieces: list[str]) -> None:
        """None stands for pieces whose texts have to be cut with care."""
        earlier = list(map(self.before.find, pieces))
        new = [p for p, e in zip(pieces, earlier, strict=True) if e is None and not odd(p)]
        values = iter(self.values([p if p == "\n" else p[1:] if p[0] == BARE else f" {p}" for p in new]))
        self.known += [
            self.known_before[e] if e is not None else None if odd(p) else next(values)
            for p, e in zip(pieces, earlier, strict=True)
        ]
