"""SentencePiece encoding and decoding: BPE over a vocabulary of scored pieces, merged in vectorised rounds.

Texts are cut into words at spaces and line ends that no piece spans. All new words of a batch are merged together: symbols lie in one
flat array, each round finds the best pair of every word by a segmented minimum, joins all its places at once, leftmost first, and
compacts the array, until no pair is left. Where a merge brings about a pair that ranks as well or better (runs of spaces, whose pieces all share
one score), simultaneous merging could differ from merging one by one: such words are merged again with a queue.
"""

from __future__ import annotations

import codecs
import functools
import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import public_tokenizers
from pyspark.sql import DataFrame

from tripstream.llm.common_arrow import appended, texts_of
from tripstream.llm.piece_table import PieceTable, flat, gathered
from tripstream.llm.pretokens import held

MODEL = public_tokenizers.path("piece_bpe_32k.model")
SPACE = "▁"
NEVER = np.iinfo(np.int64).max
#: Characters of a text that are worked on at a time.
PART = 500_000
#: Ids that a table of words holds before it begins afresh.
POOL = 8_000_000

codecs.register_error("each-byte", lambda e: ("�", e.start + 1))


class PieceModel:
    """A model file's pieces and merges. Unigram models, normalisers, user-defined or unused pieces are refused."""

    def __init__(self, path: str):
        import sentencepiece

        library = sentencepiece.SentencePieceProcessor(model_file=path)
        size = library.get_piece_size()
        pieces = [library.id_to_piece(i) for i in range(size)]
        self.begin, self.end = library.bos_id(), library.eos_id()
        byte = {int(p[3:5], 16): i for i, p in enumerate(pieces) if library.is_byte(i)}
        normal = {p: i for i, p in enumerate(pieces) if not (library.is_byte(i) or library.is_control(i) or library.is_unknown(i))}
        if len(byte) < 256 or any(map(library.is_unused, range(size))) or library.normalize(" A Ａ ") != f"{SPACE}{SPACE}A Ａ{SPACE}":
            raise ValueError("only models with byte fallback, a space put in front, no normalisation and no unused pieces")
        if any(SPACE in p.lstrip(SPACE) or " " in p or "\n" in p for p in normal):
            raise ValueError("a piece spans words")
        # Symbols: the ids, then characters that occur in pieces without being one. All other characters are negative numbers.
        lone = sorted({c for p in normal for c in p} - normal.keys())
        symbol = normal | {c: size + i for i, c in enumerate(lone)}
        self.symbol_of = np.full(0x110000, -1, np.int64)
        self.symbol_of[[ord(c) for c in symbol if len(c) == 1]] = [symbol[c] for c in symbol if len(c) == 1]
        self.symbol_of[ord(" ")] = symbol[SPACE]
        self.span = np.int64(size + len(lone))
        _, rank = np.unique([-library.get_score(i) for i in range(size)], return_inverse=True)
        splits = [(p[:n], p[n:], i) for p, i in normal.items() for n in range(1, len(p))]
        merges = np.array([(symbol[a] * self.span + symbol[b], rank[i], i) for a, b, i in splits if a in symbol and b in symbol], np.int64)
        merges = merges[np.argsort(merges[:, 0])]
        self.pairs, self.pair_rank, self.pair_made = (np.append(merges[:, k], NEVER) for k in range(3))
        # What each symbol gives: its id, or its bytes' ids.
        gives = [[i] for i in range(size)] + [[byte[b] for b in c.encode()] for c in lone]
        self.byte_ids = np.array([byte[b] for b in range(256)], np.uint32)
        self.gives, self.gives_at, self.gives_n = flat([np.array(g, np.uint32) for g in gives])
        as_bytes = [b"" if library.is_control(i) else " ⁇ ".encode() if library.is_unknown(i) else p.replace(SPACE, " ").encode() for i, p in enumerate(pieces)]
        for b, i in byte.items():
            as_bytes[i] = bytes([b])
        self.text, self.text_at, self.text_n = flat([np.frombuffer(t, np.uint8) for t in as_bytes])
        self.silent = np.array([library.is_control(i) for i in range(size)])
        self.led = np.array([normal.get(p) == i and p.startswith(SPACE) for i, p in enumerate(pieces)])

    def rank(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The rank and result of each pair of symbols; NEVER where they make no piece."""
        keys = np.where((left >= 0) & (right >= 0), left * self.span + right, np.int64(-1))
        at = np.searchsorted(self.pairs[:-1], keys)
        hit = self.pairs[at] == keys
        return np.where(hit, self.pair_rank[at], NEVER), self.pair_made[at]

    def merged(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of words (with spaces as such) in a row, merged in rounds, and how many each word has."""
        points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
        symbols = self.symbol_of[points]
        symbols[symbols < 0] = -1 - points[symbols < 0]
        word = np.repeat(np.arange(len(words)), np.fromiter(map(len, words), np.int64, len(words)))
        rank, made = np.full(len(symbols), NEVER), np.zeros(len(symbols), np.int64)
        anew = np.arange(len(symbols))
        last = np.full(len(words), -1)
        again: list[int] = []
        done, done_word = [], []
        while len(symbols):
            # Pairs are looked up where something has changed.
            inner = anew[(anew + 1 < len(symbols)) & (word[anew] == word[np.minimum(anew + 1, len(word) - 1)])]
            rank[anew] = NEVER
            rank[inner], made[inner] = self.rank(symbols[inner], symbols[inner + 1])
            starts = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            low = np.minimum.reduceat(rank, starts)
            here = word[starts]
            turned = (low <= last[here]) & (low != NEVER)
            again += here[turned].tolist()
            last[here] = low
            sizes = np.diff(np.append(starts, len(symbols)))
            over = np.repeat((low == NEVER) | turned, sizes)
            done.append(symbols[over])
            done_word.append(word[over])
            hits = np.flatnonzero((rank == np.repeat(low, sizes)) & ~over)
            # Of overlapping places the first, third and so on are joined.
            begins = np.flatnonzero(np.append(True, np.diff(hits) != 1)) if len(hits) else hits
            nth = np.arange(len(hits)) - np.repeat(begins, np.diff(np.append(begins, len(hits))))
            hits = hits[nth % 2 == 0]
            symbols[hits] = made[hits]
            stay, changed = ~over, np.zeros(len(symbols), bool)
            stay[hits + 1] = False
            changed[hits] = changed[np.maximum(hits - 1, 0)] = True
            symbols, word, rank, made, changed = (x[stay] for x in (symbols, word, rank, made, changed))
            anew = np.flatnonzero(changed)
        symbols, word = (np.concatenate([*x, np.zeros(0, np.int64)]) for x in (done, done_word))
        if again:
            one_by_one = [self.queued(words[i]) for i in again]
            kept = ~np.isin(word, again)
            symbols = np.concatenate([symbols[kept], *one_by_one])
            word = np.concatenate([word[kept], np.repeat(again, [len(o) for o in one_by_one])])
        return symbols[np.argsort(word, kind="stable")], np.bincount(word, minlength=len(words))

    @functools.cached_property
    def by_pair(self) -> dict[int, tuple[int, int]]:
        return dict(zip(self.pairs.tolist(), zip(self.pair_rank.tolist(), self.pair_made.tolist(), strict=True), strict=True))

    def queued(self, word: str) -> np.ndarray:
        """Symbols of a word, merged one pair at a time: the best first, the leftmost of equals."""
        symbols = [int(self.symbol_of[ord(c)]) for c in word]
        symbols = [s if s >= 0 else -1 - ord(c) for s, c in zip(symbols, word, strict=True)]
        after, before = [*range(1, len(word)), -1], [*range(-1, len(word) - 1)]
        waiting: list[tuple[int, int, int, int, int]] = []
        span = int(self.span)

        def propose(*places: int) -> None:
            for p in places:
                if p < 0 or after[p] < 0 or (a := symbols[p]) < 0 or (b := symbols[after[p]]) < 0:
                    continue
                if found := self.by_pair.get(a * span + b):
                    heapq.heappush(waiting, (found[0], p, a, b, found[1]))

        propose(*range(len(word)))
        while waiting:
            _, p, a, b, made = heapq.heappop(waiting)
            q = after[p]
            if q < 0 or symbols[p] != a or symbols[q] != b:
                continue
            symbols[p], symbols[q], after[p] = made, None, after[q]
            if after[p] >= 0:
                before[after[p]] = p
            propose(before[p], p)
        return np.array([s for s in symbols if s is not None], np.int64)

    def ids(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words in a row, and how many each has: its symbols', with characters that no piece has as bytes."""
        symbols, counts = self.merged(words)
        strange = symbols < 0
        known = np.where(strange, 0, symbols)
        n, at = self.gives_n[known], self.gives_at[known]
        raw = [chr(-1 - s).encode("utf-8", "surrogatepass") for s in symbols[strange].tolist()]
        n[strange] = [len(r) for r in raw]
        at[strange] = len(self.gives) + np.cumsum(n[strange]) - n[strange]
        pool = np.concatenate((self.gives, self.byte_ids[np.frombuffer(b"".join(raw), np.uint8)]))
        ends = np.append(0, np.cumsum(n))[np.append(0, np.cumsum(counts))]
        return gathered(pool, at, n), np.diff(ends)

    def decoded(self, ids: np.ndarray, begun: bool = False) -> bytes:
        """The text of ids in UTF-8; the space that encoding puts in front goes, unless the text has begun before."""
        # Bytes make a character only where no silent id stands between them.
        runs = np.split(ids, np.flatnonzero(self.silent[ids])) if self.silent[ids].any() else [ids]
        raw = b"".join(whole(gathered(self.text, self.text_at[r], self.text_n[r]).tobytes()) for r in runs)
        led = not begun and self.led[ids[~self.silent[ids]][:1]].any()
        return raw[1:] if led else raw


def whole(raw: bytes) -> bytes:
    """Each byte that belongs to no character becomes a U+FFFD of its own."""
    try:
        raw.decode()
    except UnicodeDecodeError:
        raw = raw.decode(errors="each-byte").encode()
    return raw


class WordTable(PieceTable):
    """Ids of words, which the table keeps by their bytes; it begins afresh when it is full."""

    def __init__(self, model: PieceModel, limit: int = 400_000, pool: int = POOL):
        self.model, self.pool_limit = model, pool
        super().__init__(model.ids, limit)
        # Room for what one more group of parts can bring.
        self.bits = (2 * limit + PART).bit_length()
        self._begin()

    def _add(self, pieces: list[bytes]) -> None:
        ids, sizes = self.encode([p.decode() for p in pieces])
        at = np.cumsum(sizes) - sizes
        keep = self.pool[: self.used]
        self.pool = np.concatenate((keep, ids, np.zeros(max(0, len(self.pool) - len(keep) - len(ids)), np.uint32)))
        self.starts = np.concatenate((self.starts[: self.count], at + self.used))
        self.sizes = np.concatenate((self.sizes[: self.count], sizes.astype(np.int32)))
        self.count, self.used = self.count + len(pieces), self.used + len(ids)

    def ids_of(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts in a row, without begin and end, and where each text's ids end. A text goes on with the one before
        unless it begins with the space put in front."""
        if self.count > self.limit or self.used > self.pool_limit:
            self._begin()
        parts = [t.replace(SPACE, " ").encode() for t in texts]
        joined = b"".join(parts) + b"\0" * 16
        buffer = np.frombuffer(joined, np.uint8)
        body = buffer[:-16]
        ends = np.cumsum([len(p) for p in parts], dtype=np.int64)
        space, line = body == 32, body == 10
        begins = line | space
        begins[1:] &= ~(space[1:] & space[:-1])
        begins[1:] |= line[:-1]
        begins[ends[:-1][ends[:-1] < len(body)]] = True
        begins[:1] = True
        starts = np.flatnonzero(begins)
        if not len(starts):
            return np.zeros(0, np.uint32), np.zeros(len(texts), np.int64)
        entries = self._entries(joined, buffer, starts, np.diff(np.append(starts, len(body))))
        counts = self.sizes[entries].astype(np.int64)
        ids = gathered(self.pool, self.starts[entries], counts)
        return ids, np.append(0, np.cumsum(counts))[np.searchsorted(starts, ends)]


@functools.cache
def shared_model(model: str) -> PieceModel:
    return PieceModel(model)


def word_table(model: str) -> WordTable:
    return held(("words", model), lambda: WordTable(shared_model(model)))


def parts_of(text: str) -> Iterator[str]:
    """The text with the space in front, in parts of about PART characters, each of which begins with a space after another character."""
    if not text:
        return
    at, text = 0, f" {text}"
    while at < len(text):
        to = text.find(" ", at + PART)
        while to > 0 and text[to - 1] in (" ", SPACE):
            to = text.find(" ", to + 1)
        to = to if to > 0 else len(text)
        yield text[at:to]
        at = to


def in_groups(texts: list[str]) -> Iterator[tuple[list[int], list[str]]]:
    """Parts of texts with the number of the text each belongs to, about PART characters at a time."""
    numbers, parts, size = [], [], 0
    for i, text in enumerate(texts):
        for part in parts_of(text):
            numbers.append(i)
            parts.append(part)
            size += len(part)
            if size >= PART:
                yield numbers, parts
                numbers, parts, size = [], [], 0
    if parts:
        yield numbers, parts


def encoded_parts(table: WordTable, texts: list[str]) -> Iterator[tuple[int, np.ndarray]]:
    """For each part of each text in order, the text's number and the part's ids."""
    for numbers, parts in in_groups(texts):
        ids, ends = table.ids_of(parts)
        cuts = [0, *ends.tolist()]
        for i, a, b in zip(numbers, cuts[:-1], cuts[1:], strict=True):
            yield i, ids[a:b]


def encode(docs: DataFrame, text_column: str = "text", model: str = MODEL) -> DataFrame:
    """docs with ids: begin, the text's ids and end, as little-endian unsigned 32-bit binary.

    Null and empty texts have only begin and end; texts of any length are encoded whole, in parts; rows are independent, so ties,
    repeated rows and empty tables need no rule. A column named ids is replaced; others pass through.
    """

    def make():
        table = word_table(model)
        edge = [np.array([i], "<u4").tobytes() for i in (table.model.begin, table.model.end)]

        def work(batch):
            texts = texts_of(batch, text_column)
            found = [[edge[0]] for _ in texts]
            for i, ids in encoded_parts(table, texts):
                found[i].append(ids.astype("<u4").tobytes())
            return [[b"".join([*f, edge[1]]) for f in found]]

        return work

    return appended(docs, {"ids": "binary"}, make)


def decode(frame: DataFrame, ids_column: str = "ids", model: str = MODEL) -> DataFrame:
    """frame with decoded: the text of its ids (null: empty), without begin and end. Bytes that are no UTF-8 become U+FFFD each."""

    def make():
        pieces = shared_model(model)
        return lambda batch: [[pieces.decoded(np.frombuffer(i or b"", "<u4")).decode() for i in batch.column(ids_column).to_pylist()]]

    return appended(frame, {"decoded": "string"}, make)


def round_trip_digests(docs: DataFrame, text_column: str = "text", model: str = MODEL) -> DataFrame:
    """docs without their text, with n_tokens (begin and end included), ids_sha256 (of the ids as encode gives them) and decoded_sha256.

    Encodes and decodes in one pass, so ids don't leave the worker. Rules as for encode.
    """

    def make():
        table = word_table(model)
        edge = [np.array([i], "<u4").tobytes() for i in (table.model.begin, table.model.end)]

        def work(batch):
            texts = texts_of(batch, text_column)
            counts, of_ids, of_text = [2] * len(texts), [hashlib.sha256(edge[0]) for _ in texts], [hashlib.sha256() for _ in texts]
            for i, ids in encoded_parts(table, texts):
                of_ids[i].update(ids.astype("<u4").tobytes())
                of_text[i].update(table.model.decoded(ids, begun=counts[i] > 2))
                counts[i] += len(ids)
            for h in of_ids:
                h.update(edge[1])
            return [counts, [h.hexdigest() for h in of_ids], [h.hexdigest() for h in of_text]]

        return work

    added = {"n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"}
    return appended(docs, added, make, keep=[c for c in docs.columns if c != text_column])


def op13_sentencepiece(spark, sf_dir: str) -> DataFrame:
    return round_trip_digests(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
