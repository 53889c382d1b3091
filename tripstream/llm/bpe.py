"""BPE encoding by speculation: longest matches are proposed, all neighbouring tokens are tested at once, and only
words with a pair that exact merging would have joined differently are merged step by step."""

from __future__ import annotations

import functools
import hashlib
import json
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import regex
from pyspark.sql import DataFrame

from tripstream.llm.common_arrow import appended, texts_of
from tripstream.llm.piece_table import PieceTable, flat, gathered
from tripstream.llm.pretokens import PieceCache, held

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
NEVER = np.iinfo(np.int64).max


def byte_characters() -> list[str]:
    """The character by which a byte-level vocabulary writes each byte: itself if printable, else from 256 upwards."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = iter(range(256, 512))
    return [chr(b if b in shown else next(hidden)) for b in range(256)]


class ByteBpe:
    """A byte-level vocabulary file with its merges, and encoding and decoding of texts."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        model = content["model"]
        as_byte = {c: i for i, c in enumerate(byte_characters())}
        raw = {bytes(map(as_byte.__getitem__, t)): i for t, i in model["vocab"].items() if all(c in as_byte for c in t)}
        self.special = {t["content"]: t["id"] for t in content["added_tokens"]}
        size = max([*raw.values(), *self.special.values()]) + 1
        self.bytes_of = [b""] * size
        for text, i in [*raw.items(), *((t.encode(), i) for t, i in self.special.items())]:
            self.bytes_of[i] = text
        self.single = np.array([raw[bytes([b])] for b in range(256)])
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        vocab = model["vocab"]
        self.merge = {(vocab[a], vocab[b]): (rank, vocab[a + b]) for rank, (a, b) in reversed([*enumerate(pairs)])}
        # For each token: the merge that makes it (-1: a byte) and its two parts.
        self.rank, self.left, self.right = np.full(size, -1), np.zeros(size, np.int64), np.zeros(size, np.int64)
        for (a, b), (rank, made) in self.merge.items():
            if self.rank[made] < 0 or rank < self.rank[made]:
                self.rank[made], self.left[made], self.right[made] = rank, a, b
        self.size = size
        self._index(np.array([[a, b, *m] for (a, b), m in self.merge.items()], np.int64))
        # Proposals use only tokens that merging makes from their own bytes.
        tokens = list(raw)
        ids, counts = self.merged(tokens)
        first = np.cumsum(counts) - counts
        self.table = {t: raw[t] for t, n, i in zip(tokens, counts.tolist(), ids[first].tolist(), strict=True) if n == 1 and i == raw[t]}
        self.longest = max(map(len, self.table))
        self.words = regex.compile(public_tokenizers.PATTERN)
        self.specials = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None

    def _index(self, merges: np.ndarray) -> None:
        """The merges in a table with open addressing: pair, rank and result by slot."""
        self.shift = np.uint64(64 - max(4, int(len(merges) * 4).bit_length()))
        room = (1 << (64 - int(self.shift))) + 64
        self.pair, self.pair_rank, self.pair_made = np.full(room, -1), np.full(room, NEVER), np.zeros(room, np.int64)
        keys = merges[:, 0] * self.size + merges[:, 1]
        slot, rest = self._slot(keys), np.arange(len(keys))
        while len(rest):
            free = rest[self.pair[slot[rest]] < 0]
            _, first = np.unique(slot[free], return_index=True)
            put = free[first]
            self.pair[slot[put]], self.pair_rank[slot[put]], self.pair_made[slot[put]] = keys[put], merges[put, 2], merges[put, 3]
            rest = np.setdiff1d(rest, put, assume_unique=True)
            slot[rest] += 1
        self.probes = int((np.flatnonzero(self.pair >= 0) - self._slot(self.pair[self.pair >= 0])).max(initial=0)) + 1

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def found(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The slot of each pair; where no merge has it, one that holds rank NEVER."""
        keys = left * self.size + right
        slot = self._slot(keys)
        open_ = np.flatnonzero((self.pair[slot] != keys) & (self.pair[slot] >= 0))
        for _ in range(self.probes):
            if not len(open_):
                break
            slot[open_] += 1
            at = self.pair[slot[open_]]
            open_ = open_[(at != keys[open_]) & (at >= 0)]
        slot[self.pair[slot] != keys] = -1  # the last slot stays empty
        return slot

    def merged(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Exact merging of many words at once: their ids in a row, and how many each has.

        Each round joins, in every word, the pairs of its lowest rank, leftmost first where they overlap.
        """
        counts = np.fromiter(map(len, words), np.int64, len(words))
        ids = self.single[np.frombuffer(b"".join(words), np.uint8)]
        word = np.repeat(np.arange(len(words)), counts)
        done_ids, done_word = [], []
        while len(ids):
            inner = np.append(word[1:] == word[:-1], False)
            slot = np.full(len(ids), -1)
            at = np.flatnonzero(inner)
            slot[at] = self.found(ids[at], ids[at + 1])
            rank = self.pair_rank[slot]
            starts = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            low = np.repeat(np.minimum.reduceat(rank, starts), np.diff(np.append(starts, len(ids))))
            over = low == NEVER
            if over.any():
                done_ids.append(ids[over])
                done_word.append(word[over])
            hits = np.flatnonzero((rank == low) & ~over)
            begins = np.append(True, np.diff(hits) != 1)
            run = hits - np.repeat(hits[begins], np.diff(np.append(np.flatnonzero(begins), len(hits)))) if len(hits) else hits
            hits = hits[run % 2 == 0]
            ids[hits] = self.pair_made[slot[hits]]
            stay = ~over
            stay[hits + 1] = False
            ids, word = ids[stay], word[stay]
        if not done_ids:
            return ids, counts
        ids, word = np.concatenate(done_ids), np.concatenate(done_word)
        return ids[np.argsort(word, kind="stable")], np.bincount(word, minlength=len(words))

    def proposed(self, word: bytes) -> list[int]:
        """From left to right the longest token each time."""
        table, found, at, n = self.table, [], 0, len(word)
        while at < n:
            to = min(n, at + self.longest)
            while (token := table.get(word[at:to])) is None:
                to -= 1
            found.append(token)
            at = to
        return found

    def joined(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """For pairs of neighbouring tokens: would merging join across their border?

        The pieces along the border are undone from the latest merge to the earliest. A merge of two border pieces
        comes about if it ranks before the merges that take either piece away; at equal rank the left one goes first.
        """
        left, right = first.astype(np.int64), second.astype(np.int64)
        until_left, until_right = np.full(len(left), NEVER), np.full(len(left), NEVER)
        bad, open_ = np.zeros(len(left), bool), np.arange(len(left))
        while len(open_):
            a, b = left[open_], right[open_]
            rank = self.pair_rank[self.found(a, b)]
            hit = (rank < until_left[open_]) & (rank <= until_right[open_]) & (rank != NEVER)
            bad[open_[hit]] = True
            ra, rb = self.rank[a], self.rank[b]
            more = ~hit & ((ra >= 0) | (rb >= 0))
            undo_right = more & (rb >= ra)
            undo_left = more & ~undo_right
            for undo, side, until, part, made in ((undo_left, left, until_left, self.right, ra), (undo_right, right, until_right, self.left, rb)):
                at = open_[undo]
                until[at] = made[undo]
                side[at] = part[side[at]]
            open_ = open_[more]
        return bad

    def encoded(self, words: list[bytes]) -> list[list[int]]:
        """Ids of each word."""
        found = [self.proposed(w) for w in words]
        counts = np.fromiter(map(len, found), np.int64, len(found))
        ids = np.fromiter((i for f in found for i in f), np.int64, int(counts.sum()))
        word = np.repeat(np.arange(len(found)), counts)
        inner = np.flatnonzero(word[1:] == word[:-1])
        pairs, inverse = np.unique(ids[inner] * self.size + ids[inner + 1], return_inverse=True)
        wrong = self.joined(pairs // self.size, pairs % self.size)[inverse]
        again = np.unique(word[inner[wrong]]).tolist()
        exact, sizes = self.merged([words[i] for i in again])
        exact = exact.tolist()
        at = 0
        for i, n in zip(again, sizes.tolist(), strict=True):
            found[i] = exact[at : at + n]
            at += n
        return found

    def cut(self, text: str) -> list:
        """The text's words, and for special strings their ids."""
        if text[1:].isalpha() and (text[0] == " " or text[0].isalpha()):
            return [text]
        if self.specials is not None and "<" in text and self.specials.search(text):
            parts = self.specials.split(text)
            return [x for p in parts for x in ([self.special[p]] if p in self.special else self.words.findall(p))]
        return self.words.findall(text)

    def pieces(self, texts: list[str]) -> list[list[int]]:
        """Ids of each piece of text, special strings included."""
        cut = [self.cut(t) for t in texts]
        words = {w: None for c in cut for w in c if isinstance(w, str)}
        ids = dict(zip(words, self.encoded([w.encode() for w in words]), strict=True))
        return [[i for w in c for i in ([w] if isinstance(w, int) else ids[w])] for c in cut]

    def merged_pieces(self, texts: list[str]) -> list[bytes]:
        """As pieces, by exact merging alone; ids as little-endian unsigned 32-bit bytes."""
        cut = [self.cut(t) for t in texts]
        words = [w.encode() if isinstance(w, str) else b"" for c in cut for w in c]
        ids, counts = self.merged(words)
        special = [(n, w) for n, w in enumerate(w for c in cut for w in c) if isinstance(w, int)]
        if special:
            at = np.array([n for n, _ in special])
            ids = np.insert(ids, np.cumsum(counts)[at], [w for _, w in special])
            counts[at] = 1
        raw = ids.astype("<u4").tobytes()
        ends = np.append(0, np.cumsum(counts))[np.append(0, np.cumsum([len(c) for c in cut], dtype=np.int64))] * 4
        return [raw[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]

    def decoded(self, ids: list[int]) -> str:
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", errors="replace")


# A worker process keeps these from task to task; PieceCache bounds what they hold.
@functools.cache
def shared_bpe(vocabulary: str) -> ByteBpe:
    return ByteBpe(vocabulary)


def id_cache(vocabulary: str) -> PieceCache:
    """Ids of pieces as little-endian unsigned 32-bit bytes."""

    def values(pieces):
        return [np.array(i, "<u4").tobytes() for i in shared_bpe(vocabulary).pieces(pieces)]

    return held(("ids", vocabulary), lambda: PieceCache(values))


def id_table(vocabulary: str) -> PieceTable:
    """Ids of pieces, speculated and verified, in a table that texts are looked up in by the batch."""

    def values(pieces):
        return [np.array(i, "<u4").tobytes() for i in shared_bpe(vocabulary).pieces(pieces)]

    return held(("id table", vocabulary), lambda: PieceTable(values))


class Digests:
    """Digests of the ids of texts, as decimal numbers joined by commas, and of the decoded texts."""

    def __init__(self, bpe: ByteBpe):
        self.decimal = flat([np.frombuffer(f"{i},".encode(), np.uint8) for i in range(bpe.size)])
        self.text = flat([np.frombuffer(t, np.uint8) for t in bpe.bytes_of])

    def of(self, ids: list[bytes]) -> tuple[list[str], list[str]]:
        flat_ids = np.frombuffer(b"".join(ids), "<u4")
        ends = np.cumsum([len(i) // 4 for i in ids], dtype=np.int64)
        numbers, texts = (self._cut(flat_ids, ends, *pool) for pool in (self.decimal, self.text))
        return [hashlib.sha256(n[:-1]).hexdigest() for n in numbers], [hashlib.sha256(whole(t)).hexdigest() for t in texts]

    def _cut(self, ids: np.ndarray, ends: np.ndarray, pool: np.ndarray, at: np.ndarray, n: np.ndarray) -> list[memoryview]:
        sizes = n[ids]
        raw = memoryview(gathered(pool, at[ids], sizes).tobytes())
        edges = np.append(0, np.cumsum(sizes))[np.append(0, ends)].tolist()
        return [raw[a:b] for a, b in zip(edges[:-1], edges[1:], strict=True)]


def whole(text: memoryview) -> bytes | memoryview:
    """The text in UTF-8, where bytes that are none have become U+FFFD."""
    try:
        str(text, "utf-8")
    except UnicodeDecodeError:
        return str(text, "utf-8", "replace").encode()
    return text


@functools.cache
def shared_digests(vocabulary: str) -> Digests:
    return Digests(shared_bpe(vocabulary))


def in_groups(texts: list[str], size: int = 500_000) -> Iterator[list[str]]:
    """The texts in turn, so many that they have about `size` characters together."""
    held_back, chars = [], 0
    for text in texts:
        held_back.append(text)
        chars += len(text)
        if chars >= size:
            yield held_back
            held_back, chars = [], 0
    if held_back:
        yield held_back


def encode(docs: DataFrame, text_column: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """docs with ids: the text's tokens as little-endian unsigned 32-bit binary.

    Null and empty texts have no ids; texts of any length are encoded whole; rows are independent, so ties, repeated rows and
    empty tables need no rule. A column named ids is replaced; others pass through.
    """

    def make():
        cache = id_cache(vocabulary)
        return lambda batch: [[b"".join(v) for v in cache.of(texts_of(batch, text_column))]]

    return appended(docs, {"ids": "binary"}, make)


def decode(frame: DataFrame, ids_column: str = "ids", vocabulary: str = VOCABULARY) -> DataFrame:
    """frame with decoded: the text of its ids (null: empty). Bytes that are no UTF-8 become U+FFFD."""

    def make():
        bpe = shared_bpe(vocabulary)
        return lambda batch: [[bpe.decoded(np.frombuffer(i or b"", "<u4").tolist()) for i in batch.column(ids_column).to_pylist()]]

    return appended(frame, {"decoded": "string"}, make)


def round_trip_digests(docs: DataFrame, text_column: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """docs without their text, with n_tokens, ids_sha256 (of decimal ids joined by commas) and decoded_sha256.

    Encodes and decodes in one pass, so ids don't leave the worker. Rules as for encode.
    """

    def make():
        table, digests = id_table(vocabulary), shared_digests(vocabulary)

        def work(batch):
            counts, ids_sha, text_sha = [], [], []
            for texts in in_groups(texts_of(batch, text_column)):
                ids = table.of(texts)
                counts += [len(i) // 4 for i in ids]
                for found, more in zip((ids_sha, text_sha), digests.of(ids), strict=True):
                    found += more
            return [counts, ids_sha, text_sha]

        return work

    added = {"n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"}
    return appended(docs, added, make, keep=[c for c in docs.columns if c != text_column])


def op9_bpe(spark, sf_dir: str) -> DataFrame:
    return round_trip_digests(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
