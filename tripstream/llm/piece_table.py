"""The pieces of pretokens.PieceCache looked up many at a time, in a table of numpy arrays, for values that are token ids."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

from tripstream.llm.pretokens import BARE, INNER_SPACE, odd

#: Pieces of up to SHORT bytes are in the table, with their bytes and length as key; longer ones, which are few, in a dictionary.
SHORT = 15
MASK = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
SPREAD = [np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)]
NEW, NONE = -2, -1


def flat(parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Arrays in a row, with the place and length of each."""
    sizes = np.fromiter(map(len, parts), np.int64, len(parts))
    return np.concatenate(parts), np.cumsum(sizes) - sizes, sizes


def gathered(pool: np.ndarray, at: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The stretches of the pool that begin at `at` and are n long, in a row."""
    before = np.cumsum(n) - n
    return pool[np.repeat(at - before, n) + np.arange(int(n.sum()))]


class PieceTable:
    """Token ids of texts. encode(pieces) gives the ids of new pieces as little-endian unsigned 32-bit bytes.

    A table with more than `limit` pieces begins afresh, so memory is bounded.
    """

    def __init__(self, encode: Callable[[list[str]], list[bytes]], limit: int = 400_000):
        self.encode, self.limit = encode, limit
        self.bits = (2 * limit).bit_length()
        self._begin()

    def _begin(self) -> None:
        room = (1 << self.bits) + 4096
        self.low, self.high, self.entry = np.zeros(room, np.uint64), np.zeros(room, np.uint64), np.full(room, NONE, np.int32)
        self.long: dict[bytes, int] = {}
        self.pool, self.used = np.zeros(1 << 20, np.uint32), 0
        self.starts, self.sizes, self.count = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int32), 0

    def of(self, texts: list[str]) -> list[bytes]:
        """The ids of each text."""
        if not texts:
            return []
        if self.count > self.limit:
            self._begin()
        marked = [f"{BARE}{t.replace('\n', f' \n {BARE}')}" for t in texts]
        joined = " ".join(marked).encode() + b"\0" * 16
        buffer = np.frombuffer(joined, np.uint8)
        ends = np.append(np.flatnonzero(buffer[:-16] == 32), len(buffer) - 16)
        starts = np.append(0, ends[:-1] + 1)
        entries = self._entries(joined, buffer, starts, ends - starts)
        counts = np.maximum(self.sizes[entries], 0)
        before = np.cumsum(counts) - counts
        ids = self.pool[np.repeat(self.starts[entries] - before, counts) + np.arange(int(counts.sum()))]
        pieces = np.cumsum([m.count(" ") + 1 for m in marked])
        bad = np.append(0, np.cumsum(self.sizes[entries] < 0))
        cut = np.append(before, len(ids))
        out = []
        for text, a, b in zip(texts, [0, *pieces[:-1].tolist()], pieces.tolist(), strict=True):
            careful = bad[b] > bad[a] or BARE in text
            out.append(self._careful(text) if careful else ids[cut[a] : cut[b]].tobytes())
        return out

    def _careful(self, text: str) -> bytes:
        first, *later = INNER_SPACE.split(text)
        return b"".join(self.encode([first, *(f" {p}" for p in later)]))

    def _entries(self, joined: bytes, buffer: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """The entry of each piece; new ones are encoded and put in."""
        eight = np.ndarray((len(buffer) - 7,), "<u8", buffer, strides=(1,))
        low = eight[starts] & MASK[np.minimum(lengths, 8)]
        rest = np.clip(lengths - 8, 0, 7)
        high = eight[np.minimum(starts + 8, len(eight) - 1)] & MASK[rest] | np.minimum(lengths, SHORT + 1).astype(np.uint64) << np.uint64(56)
        slot = self._slot(low, high)
        found, open_ = np.full(len(starts), NEW, np.int32), np.flatnonzero(lengths <= SHORT)
        while len(open_):
            at = slot[open_]
            entry = self.entry[at]
            same = (self.low[at] == low[open_]) & (self.high[at] == high[open_]) & (entry != NONE)
            found[open_[same]] = entry[same]
            open_ = open_[~same & (entry != NONE)]
            slot[open_] += 1
        new: dict[bytes, int] = {}
        missing = np.flatnonzero(found == NEW)
        firsts = []
        for i, a, n in zip(missing.tolist(), starts[missing].tolist(), lengths[missing].tolist(), strict=True):
            piece = joined[a : a + n]
            number = self.long.get(piece) if n > SHORT else None
            if number is None:
                number = new.get(piece)
                if number is None:
                    number = new[piece] = self.count + len(new)
                    firsts.append(i)
            found[i] = number
        if new:
            self._add(list(new))
            first = np.array(firsts)
            short = lengths[first] <= SHORT
            self._insert(low[first[short]], high[first[short]], found[first[short]])
            self.long.update((p, n) for p, n in new.items() if len(p) > SHORT)
        return found

    def _slot(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        mixed = (low * SPREAD[0]) ^ (high * SPREAD[1])
        return (((mixed ^ (mixed >> np.uint64(32))) * SPREAD[0]) >> np.uint64(64 - self.bits)).astype(np.int64)

    def _add(self, pieces: list[bytes]) -> None:
        """Ids of new pieces to the end of the pool; size NONE stands for pieces whose texts have to be cut with care."""
        texts = [p.decode() for p in pieces]
        sound = [not odd(t) for t in texts]
        made = self.encode([t if t == "\n" else t[1:] if t[0] == BARE else f" {t}" for t, s in zip(texts, sound, strict=True) if s])
        raw = np.frombuffer(b"".join(made), "<u4")
        sizes = np.full(len(pieces), NONE, np.int32)
        sizes[np.array(sound)] = [len(m) // 4 for m in made]
        last, end = self.count + len(pieces), self.used + len(raw)
        if end > len(self.pool):
            self.pool = np.concatenate((self.pool, np.zeros(max(len(self.pool), end), np.uint32)))
        if last > len(self.sizes):
            more = max(len(self.sizes), last)
            self.starts, self.sizes = np.concatenate((self.starts, np.zeros(more, np.int64))), np.concatenate((self.sizes, np.zeros(more, np.int32)))
        self.pool[self.used : end] = raw
        taken = np.maximum(sizes, 0)
        self.starts[self.count : last] = self.used + np.cumsum(taken) - taken
        self.sizes[self.count : last] = sizes
        self.count, self.used = last, end

    def _insert(self, low: np.ndarray, high: np.ndarray, entries: np.ndarray) -> None:
        slot, open_ = self._slot(low, high), np.arange(len(low))
        while len(open_):
            free = open_[self.entry[slot[open_]] == NONE]
            put = free[np.unique(slot[free], return_index=True)[1]]
            self.low[slot[put]], self.high[slot[put]], self.entry[slot[put]] = low[put], high[put], entries[put]
            left = np.ones(len(low), bool)
            left[put] = False
            open_ = open_[left[open_]]
            slot[open_] += 1
