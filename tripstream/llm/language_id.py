"""Language identification by unigram pieces: a word's probability sums all of its segmentations into public pieces."""

from __future__ import annotations

import base64
import functools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripstream.llm.common_arrow import appended, texts_of
from tripstream.llm.pretokens import PieceCache, held

VOCABULARY = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
UNKNOWN = "und"
ADDED = ("held_out", "lang_pred", "score")
#: Labelled rows of each language that the probabilities are fitted on, at most.
SAMPLE_ROWS = 2000
ROUNDS = 3
#: Labels that are learned, at most: those with the most rows. It bounds the model, which goes through the driver.
MAX_LABELS = 100
#: A piece's least probability; to the power of the longest piece's bytes it is still a double that isn't zero.
FLOOR = 1e-9
#: Bytes of words that are worked on at a time.
BLOCK = 1 << 18
LETTERS = regex.compile(r"\p{L}+")


class Pieces:
    """The vocabulary's pieces as a tree of bytes: node k + 1 is reached by keys[k], a node's number times 256 plus a byte.

    number holds each node's piece, -1 where none ends. All single bytes are pieces, so that every word has a segmentation.
    """

    def __init__(self, pieces: set[bytes]):
        self.pieces = sorted(pieces | {bytes([b]) for b in range(256)})
        lengths = np.fromiter(map(len, self.pieces), np.int64, len(self.pieces))
        self.longest = int(lengths.max())
        starts = np.cumsum(lengths) - lengths
        buffer = np.frombuffer(b"".join(self.pieces), np.uint8)
        node, size, keys, ends = np.zeros(len(lengths), np.int64), 1, [], []
        for depth in range(self.longest):
            at = np.flatnonzero(lengths > depth)
            # Nodes are numbered level by level and in order of their keys, so the keys of all levels are sorted.
            found, place = np.unique(node[at] * 256 + buffer[starts[at] + depth], return_inverse=True)
            node[at] = place + size
            last = at[lengths[at] == depth + 1]
            ends.append((node[last], last))
            keys.append(found)
            size += len(found)
        self.keys, self.number = np.concatenate(keys), np.full(size, -1)
        for nodes, numbers in ends:
            self.number[nodes] = numbers

    def edges(self, buffer: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, length, piece) of all pieces in the buffer; left: bytes of the word from each place on."""
        at, node, found = np.arange(len(left)), np.zeros(len(left), np.int64), []
        for n in range(1, self.longest + 1):
            key = node * 256 + buffer[at + (n - 1)]
            place = np.searchsorted(self.keys, key)
            hit = np.flatnonzero(self.keys[np.minimum(place, len(self.keys) - 1)] == key)
            at, node = at[hit], place[hit] + 1
            piece = self.number[node]
            full = np.flatnonzero(piece >= 0)
            found.append((at[full], np.full(len(full), n), piece[full]))
            on = np.flatnonzero(left[at] > n)
            at, node = at[on], node[on]
            if not len(at):
                break
        return tuple(np.concatenate(x) for x in zip(*found, strict=True))


@functools.cache
def pieces_of(vocabulary: str) -> Pieces:
    with open(vocabulary, "rb") as file:
        return Pieces({base64.b64decode(line.split()[0]) for line in file if line.strip()} - {b""})


def words_of(text: str) -> list[bytes]:
    """Runs of letters, whole, lower-cased, each after a space."""
    return [f" {w}".encode() for w in LETTERS.findall(text.lower())]


class Lattice:
    """All segmentations of a batch of words into pieces.

    A word is cut wherever no piece spans, which changes no sum. A part of n bytes has n + 1 nodes; the pieces that lie between
    them are ordered by where in their part they end, then by node, so that one step takes in all parts at once.
    """

    def __init__(self, words: list[bytes], vocabulary: Pieces, cut: bool = True):
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(words) else 0
        starts, lengths, pieces = vocabulary.edges(
            np.frombuffer(b"".join(words), np.uint8), np.repeat(ends, lengths) - np.arange(total)
        ) if total else (np.zeros(0, np.int64),) * 3
        first = np.zeros(total, bool)
        first[np.concatenate((np.zeros(1, np.int64), ends[:-1]))[: len(words)]] = True
        begins = first
        if cut:
            spanned = np.cumsum(np.bincount(starts + 1, minlength=total + 1) - np.bincount(starts + lengths, minlength=total + 1))
            begins = spanned[:total] == 0
        bounds = np.flatnonzero(begins)
        part = np.cumsum(begins) - 1
        self.size = total + len(bounds)
        #: The last node of each part, and the first part of each word.
        self.last = np.append(bounds[1:], total)[: len(bounds)] + np.arange(len(bounds))
        self.parts = part[np.flatnonzero(first)]
        source, target = starts + part[starts], starts + lengths + part[starts]
        end = starts + lengths - bounds[part[starts]]
        order = np.argsort(end * (self.size + 1) + target, kind="stable")
        self.source, self.target, self.pieces, end = source[order], target[order], pieces[order], end[order]
        #: Where the pieces of a node begin, and where those of a step.
        self.heads = np.flatnonzero(np.diff(self.target, prepend=-1))
        self.steps = np.searchsorted(end[self.heads], np.arange(1, (int(end[-1]) if len(end) else 0) + 2))

    def _step(self, k: int):
        heads = self.heads[self.steps[k] : self.steps[k + 1]]
        low = int(heads[0])
        high = int(self.heads[self.steps[k + 1]]) if self.steps[k + 1] < len(self.heads) else len(self.target)
        return slice(low, high), heads - low, np.repeat(np.arange(len(heads)), np.diff(heads, append=high)), self.target[heads]

    def forward(self, weights: np.ndarray, known: np.ndarray | None = None, shares: np.ndarray | None = None) -> np.ndarray:
        """For every node the log of the sum over segmentations of what lies before it in its part; weights: a row a piece.

        A step adds up what its pieces bring relative to the node before, so a word of any length neither overflows nor vanishes.
        known: logs of the first nodes of a single part. shares, if given, receives each piece's share of its node.
        """
        logs, begin = np.zeros((self.size, weights.shape[1])), 0
        if known is not None:
            logs[: len(known)] = known
            begin = len(known) - 1
        for k in range(begin, len(self.steps) - 1):
            edges, heads, of, target = self._step(k)
            before = logs[target - 1]
            values = np.exp(logs[self.source[edges]] - before[of]) * weights[self.pieces[edges]]
            sums = np.add.reduceat(values, heads, axis=0)
            logs[target] = before + np.log(sums)
            if shares is not None:
                shares[edges] = values[:, 0] / sums[of, 0]
        return logs

    def totals(self, logs: np.ndarray) -> np.ndarray:
        """The log probability of each word."""
        return np.add.reduceat(logs[self.last], self.parts, axis=0) if len(self.parts) else logs[:0]

    def expected(self, weights: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """How often each piece is used over all segmentations, by their probability; counts: of the words."""
        shares = np.zeros(len(self.target))
        self.forward(weights, shares=shares)
        reached = np.zeros(self.size)
        reached[self.last] = np.repeat(counts, np.diff(self.parts, append=len(self.last)))
        for k in reversed(range(len(self.steps) - 1)):
            edges, _, of, target = self._step(k)
            shares[edges] *= reached[target][of]
            reached[self.source[edges]] += shares[edges]
        return np.bincount(self.pieces, shares, len(weights))


def log_of_long(word: bytes, vocabulary: Pieces, weights: np.ndarray) -> np.ndarray:
    """The log probability of one word, block by block; the nodes that pieces still reach back to go on to the next block."""
    logs, back = np.zeros((1, weights.shape[1])), vocabulary.longest - 1
    for at in range(0, len(word), BLOCK):
        known = logs[-(back + 1) :]
        logs = Lattice([word[at - len(known) + 1 : at + BLOCK]], vocabulary, cut=False).forward(weights, known)
    return logs[-1]


def blocks(words: list[bytes]) -> Iterator[slice]:
    """Slices of about BLOCK bytes of words."""
    begin = size = 0
    for i, word in enumerate(words):
        if size and size + len(word) > BLOCK:
            yield slice(begin, i)
            begin, size = i, 0
        size += len(word)
    if words:
        yield slice(begin, len(words))


def logs_of(words: list[bytes], vocabulary: Pieces, weights: np.ndarray) -> np.ndarray:
    """The log probability of each word (a row) under each language."""
    out = np.zeros((len(words), weights.shape[1]))
    for some in blocks(words):
        if some.stop == some.start + 1 and len(words[some.start]) > BLOCK:
            out[some.start] = log_of_long(words[some.start], vocabulary, weights)
        else:
            lattice = Lattice(words[some], vocabulary)
            out[some] = lattice.totals(lattice.forward(weights))
    return out


def fitted(frame: pd.DataFrame, vocabulary: str, rounds: int) -> np.ndarray:
    """Piece probabilities of one language from its words and their counts, by expectation and maximisation."""
    known = pieces_of(vocabulary)
    weights = np.full((len(known.pieces), 1), 1 / len(known.pieces))
    words, counts = frame["word"].tolist(), frame["n"].to_numpy(float)
    for _ in range(rounds):
        used = sum(Lattice(words[some], known).expected(weights, counts[some]) for some in blocks(words))
        weights[:, 0] = np.maximum(used / max(used.sum(), 1e-300), FLOOR)
    return weights[:, 0]


def held_out(id_column: str) -> Column:
    """Rows that nothing is learned from. A null id counts as empty text, so it is learned from."""
    return F.crc32(F.coalesce(F.col(id_column).cast("string"), F.lit("")).cast("binary")) % 4 == 2


def learned(
    docs: DataFrame, id_column: str, text_column: str, label_column: str, vocabulary: str, sample_rows: int, rounds: int,
    max_labels: int = MAX_LABELS,
) -> tuple[list[str], np.ndarray]:
    """The languages in order and their piece probabilities (a row a piece).

    The max_labels labels with the most rows are learned, equal ones in order of their text. Of each at most sample_rows rows are taken, whole, by the smallest hashes of id and text. First the share of rows
    that is needed is found by counting, so that few rows more than the sample are shuffled. Their words, but those over BLOCK bytes, are counted by
    Spark and fitted in one task for each language; the driver receives a number for each piece and language.
    """
    labelled = docs.where(~held_out(id_column) & F.col(label_column).isNotNull() & F.col(text_column).isNotNull()).select(
        F.col(label_column).cast("string").alias("lang"), F.col(text_column).alias("text"),
        F.xxhash64(F.col(id_column), F.col(text_column)).alias("at"),
    )
    # Four standard deviations beyond the sample are let through, of rows whose hashes are spread evenly.
    let_through = sample_rows + 4 * sample_rows**0.5
    shares = labelled.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(max_labels).select(
        "lang", (let_through / F.col("n")).alias("share"))
    # At most max_labels rows.
    drawn = labelled.join(F.broadcast(shares), "lang").where(F.pmod("at", F.lit(1 << 30)) < F.col("share") * (1 << 30)).drop("share")
    first = Window.partitionBy("lang").orderBy("at")
    sample = drawn.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= sample_rows)

    def counted(batches):
        for batch in batches:
            langs, words = [], []
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
                found = [w for w in words_of(text) if len(w) <= BLOCK]
                langs += [lang] * len(found)
                words += found
            yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(words, pa.binary())], names=["lang", "word"])

    words = sample.select("lang", "text").mapInArrow(counted, "lang string, word binary").groupBy("lang", "word").agg(F.count("*").alias("n"))

    def fit(frame):
        return pd.DataFrame({"lang": [frame["lang"].iloc[0]], "weights": [fitted(frame, vocabulary, rounds).tolist()]})

    rows = sorted(words.groupBy("lang").applyInPandas(fit, "lang string, weights array<double>").collect())
    return [r["lang"] for r in rows], np.array([r["weights"] for r in rows]).T.reshape(-1, max(1, len(rows)))


class Scorer:
    """Log probabilities of texts under each language; words seen before are looked up."""

    def __init__(self, weights: np.ndarray, vocabulary: str):
        self.pieces, self.weights = pieces_of(vocabulary), weights
        self.cache = PieceCache(self._values, limit=100_000)

    def _values(self, pieces: list[str]) -> list[bytes]:
        """For each piece its log probabilities and number of words, as doubles in a row."""
        words = [words_of(p) for p in pieces]
        distinct: dict[bytes, int] = {}
        of = np.array([distinct.setdefault(w, len(distinct)) for found in words for w in found], np.int64)
        logs = logs_of([*distinct], self.pieces, self.weights)[of]
        table = np.zeros((len(words), self.weights.shape[1] + 1))
        table[:, -1] = [len(found) for found in words]
        np.add.at(table[:, :-1], np.repeat(np.arange(len(words)), table[:, -1].astype(np.int64)), logs)
        return [row.tobytes() for row in table]

    def sums(self, texts: list[str]) -> np.ndarray:
        """A row a text: log probability under each language, then the number of words."""
        width = self.weights.shape[1] + 1
        sums = [np.frombuffer(b"".join(found)).reshape(-1, width).sum(0) for found in self.cache.of(texts)]
        return np.array(sums).reshape(len(texts), width)


def scorer(weights, vocabulary: str) -> Scorer:
    """The broadcast model's scorer."""
    name, values = weights.value
    return held(("scorer", name, vocabulary), lambda: Scorer(values, vocabulary))


def identify_language(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", label_column: str = "lang",
    vocabulary: str = VOCABULARY, sample_rows: int = SAMPLE_ROWS, rounds: int = ROUNDS, keep_text: bool = True,
) -> DataFrame:
    """Every row of docs with held_out, lang_pred and score.

    Probabilities are learned from text and label of rows whose crc32 of the id as text isn't 2 modulo 4, of each label at most
    sample_rows and of labels at most MAX_LABELS; prediction sees the text alone. A text's probability is the product over its words of the sum
    over all segmentations of the word, however long, into the vocabulary's pieces. score is the predicted language's share of the likelihood (0 to 1);
    of equal ones the first label in order is predicted. Null texts, texts without a letter, and all texts if nothing could be learned are `und` with score 0. Texts of any length are
    scored whole; repeated rows get equal results. Columns that bear an added name are replaced. An empty table gives an empty table.
    """
    langs, weights = learned(docs, id_column, text_column, label_column, vocabulary, sample_rows, rounds)
    docs = docs.drop(*ADDED)
    if not langs:
        names = [c for c in docs.columns if keep_text or c != text_column]
        return docs.select(*names, held_out(id_column).alias("held_out"), F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    return predicted(docs, langs, weights, id_column, text_column, vocabulary, keep_text)


def predicted(
    docs: DataFrame, langs: list[str], weights: np.ndarray, id_column: str, text_column: str, vocabulary: str, keep_text: bool
) -> DataFrame:
    """docs, which bear no added name, with held_out, lang_pred and score under the languages that were learned."""
    names = [c for c in docs.columns if keep_text or c != text_column]
    # Its size: a double for each of the vocabulary's pieces and each language.
    shared = docs.sparkSession.sparkContext.broadcast((hash(weights.tobytes()), weights))

    def make():
        model = scorer(shared, vocabulary)

        def work(batch):
            texts = batch.column(text_column).to_pylist()
            sums = model.sums(["" if t is None else t for t in texts])
            logs = sums[:, :-1]
            share = np.exp(logs - logs.max(1, keepdims=True))
            share /= share.sum(1, keepdims=True)
            best, known = logs.argmax(1), sums[:, -1] > 0
            pred = [langs[b] if k else UNKNOWN for b, k in zip(best.tolist(), known.tolist(), strict=True)]
            return [pred, np.where(known, share[np.arange(len(best)), best], 0.0)]

        return work

    found = appended(docs, {"lang_pred": "string", "score": "double"}, make, keep=names)
    return found.select(*names, held_out(id_column).alias("held_out"), "lang_pred", "score")


def drop_unidentified(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", label_column: str = "lang") -> DataFrame:
    """The rows whose language could be told, with the columns of docs but those that bear an added name.

    If no language could be learned, only null texts and texts without a letter go.
    """
    langs, weights = learned(docs, id_column, text_column, label_column, VOCABULARY, SAMPLE_ROWS, ROUNDS)
    docs = docs.drop(*ADDED)
    if langs:
        found = predicted(docs, langs, weights, id_column, text_column, VOCABULARY, True).where(F.col("lang_pred") != UNKNOWN)
    else:

        def make():
            return lambda batch: [[bool(LETTERS.search(t)) for t in texts_of(batch, text_column)]]

        found = appended(docs, {"lang_pred": "boolean"}, make).where("lang_pred")
    return found.select(*docs.columns)


def op7_language_id(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    return identify_language(docs, keep_text=False).drop("lang")
