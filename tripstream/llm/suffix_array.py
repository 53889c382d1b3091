"""Repeated passages by blockwise suffix sorting with a difference cover.

A difference cover of a period v is a set of residues in which every shift of two positions finds a common offset below v:
wherever a string of `span` bytes occurs twice, some offset lies in the cover at both places, and the `span - v + 1` bytes
from there are equal. So the cover's positions are ranked first; a suffix whose cover positions all have strings of their
own ties with no other text's to the depth of `span` and never enters a bucket. The others are sorted one set
of buckets at a time. Order among different strings doesn't matter for this result, so ranks and sort keys are hashes, not byte order.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripstream.llm.common import shared_folder
from tripstream.llm.pretokens import give_back, let_go

ADDED = ("n_bytes", "n_removed", "n_spans", "kept_bytes")
#: Perfect difference sets, in which every shift below the period occurs.
COVERS = {7: (0, 1, 3), 13: (0, 1, 3, 9), 21: (0, 1, 4, 14, 16), 31: (0, 1, 3, 8, 12, 18)}
#: Bytes of text in a block, the unit in which texts are stored and read; a longer text is a block of its own.
BLOCK_BYTES = 2_000_000
#: Entries of a bucket, on average.
BUCKET = 1 << 20
#: Suffix buckets are sorted in so many turns; what a turn shuffles is gone before the next.
TURNS = 4
NO_ID = np.iinfo(np.int64).min
MULTIPLIERS = [np.uint64((0x9E3779B97F4A7C15 * (2 * i + 1)) & (2**64 - 1)) for i in range(1, 40)]


def written(frame: DataFrame) -> DataFrame:
    """The frame as a table in the shared folder. Its shuffle files go when it is written, so turns don't pile up on disk."""
    spark = frame.sparkSession
    path, name = shared_folder(spark), "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, "false")
    spark.conf.set(name, "true")
    try:
        frame.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(name, before)
    return spark.read.schema(frame.schema).parquet(path)


class Block:
    """The texts of a block as one buffer, with ids and the places of its bytes.

    copies: numbers of texts that a row with a smaller id repeats as a whole; nothing is looked for in them.
    """

    def __init__(self, rows: bytes, id_column: str, text_column: str, copies: list[int] | None = None):
        with pa.ipc.open_stream(rows) as reader:
            self.table = reader.read_all()
        texts = [t or b"" for t in self.table.column(text_column).cast(pa.binary()).to_pylist()]
        self.lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.copies = copies or []
        self.open = self.lengths.copy()
        self.open[self.copies] = 0
        self.ids = self.table.column(id_column).cast(pa.int64()).fill_null(NO_ID).to_numpy()
        self.size = int(self.lengths.sum())
        self.buffer = np.frombuffer(b"".join(texts) + b"\0" * 8, np.uint8)
        self.eight = np.ndarray((self.size + 1,), "<u8", self.buffer, strides=(1,))

    def covered(self, period: int, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Positions in the cover with `length` bytes of their text from there on, and their texts' numbers."""
        most = int(self.open.max(initial=0))
        places = (np.arange(0, most + 1, period)[:, None] + np.array(COVERS[period])).ravel()
        counts = np.searchsorted(places, np.maximum(self.open - length + 1, 0))
        doc = np.repeat(np.arange(len(counts)), counts)
        within = np.arange(len(doc)) - np.repeat(np.cumsum(counts) - counts, counts)
        return self.starts[doc] + places[within], doc

    def hashes(self, at: np.ndarray, length: int, check: bool = False):
        """64-bit hashes of the strings of `length` bytes (8 at least), and another 32 bits if asked for."""
        value, other = np.zeros(len(at), np.uint64), np.zeros(len(at), np.uint64)
        for i, offset in enumerate([*range(0, length - 8, 8), length - 8]):
            part = self.eight[at + offset]
            value = (value ^ part) * MULTIPLIERS[0]
            value ^= value >> np.uint64(29)
            if check:
                other += part * MULTIPLIERS[i + 1]
        value = (value ^ (value >> np.uint64(32))) * MULTIPLIERS[2]
        value ^= value >> np.uint64(31)
        return (value, ((other ^ (other >> np.uint64(17))) * MULTIPLIERS[3] >> np.uint64(32)).astype(np.uint32)) if check else value


def groups_of(*sorted_keys: np.ndarray) -> np.ndarray:
    """Where groups of equal keys begin."""
    new = np.zeros(len(sorted_keys[0]), bool)
    new[:1] = True
    for key in sorted_keys:
        new[1:] |= key[1:] != key[:-1]
    return np.flatnonzero(new)


def spread(values: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    """One value a group to all of its members."""
    return np.repeat(values, np.diff(np.append(starts, size)))


def blocks(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """Rows gathered into blocks; a row's columns travel as a compressed Arrow stream."""
    def gather(batches):
        let_go()
        options = pa.ipc.IpcWriteOptions(compression="zstd")
        part, number = TaskContext.get().partitionId(), 0
        for batch in batches:
            lengths = pc.fill_null(pc.binary_length(batch.column(text_column)), 0).to_numpy(zero_copy_only=False)
            block = (np.cumsum(lengths, dtype=np.int64) - lengths) // BLOCK_BYTES
            edges = [*groups_of(block).tolist(), len(block)]
            for a, b in zip(edges, edges[1:], strict=False):
                rows = batch.slice(a, b - a)
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, rows.schema, options=options) as writer:
                    writer.write_batch(rows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([(part << 32) + number], pa.int64()), pa.array([int(lengths[a:b].sum())], pa.int64()),
                     pa.array([sink.getvalue().to_pybytes()], pa.binary())],
                    names=["block", "bytes", "rows"],
                )
                number += 1

    return docs.mapInArrow(gather, "block long, bytes long, rows binary")


def sorted_by(key: np.ndarray, check: np.ndarray) -> np.ndarray:
    """The order by key, and by check where keys collide."""
    order = np.argsort(key)
    key, check = key[order], check[order]
    if ((key[1:] == key[:-1]) & (check[1:] != check[:-1])).any():
        order = order[np.lexsort((check, key))]
    return order


def one_by_one(batches):
    """A block at a time, so that a worker never holds copies of a whole batch of them."""
    return (batch.slice(at, 1) for batch in batches for at in range(batch.num_rows))


def whole_copies(frame: DataFrame, names: tuple[str, str], span: int) -> DataFrame:
    """For each block the numbers of its texts, of span bytes at least, that a row with a smaller id repeats as a whole."""

    def run(batches):
        let_go()
        for batch in one_by_one(batches):
            for number, rows in zip(batch.column("block").to_pylist(), batch.column("rows").to_pylist(), strict=True):
                block = Block(rows, *names)
                at = np.flatnonzero(block.lengths >= span)
                texts = [block.buffer[a : a + n].tobytes() for a, n in zip(block.starts[at].tolist(), block.lengths[at].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([number] * len(at), pa.int64()), pa.array(at, pa.int32()), pa.array(block.ids[at], pa.int64()),
                     pa.array([hashlib.sha256(t).digest() for t in texts], pa.binary())],
                    names=["block", "text", "id", "sha"],
                )

    texts = frame.mapInArrow(run, "block long, text int, id long, sha binary")
    low = texts.groupBy("sha").agg(F.min("id").alias("low"), F.max("id").alias("high")).where("low < high").select("sha", "low")
    return texts.join(low, "sha").where("id > low").groupBy("block").agg(F.collect_list("text").alias("copies"))


def slices(keys: np.ndarray, bits: int) -> list[tuple[int, int, int]]:
    """(bucket, from, to) of sorted 64-bit keys by their first bits."""
    if not len(keys):
        return []
    bucket = (keys >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(keys), np.int64)
    starts = groups_of(bucket)
    return list(zip(bucket[starts].tolist(), starts.tolist(), np.append(starts[1:], len(keys)).tolist(), strict=True))


def cover_ranks(block: Block, period: int, length: int):
    """The cover's positions with their texts, their strings' ranks, the hashes by rank, and which texts of other ids in the block share."""
    at, doc = block.covered(period, length)
    value = block.hashes(at, length)
    order = np.argsort(value)
    starts = groups_of(value[order])
    place = np.empty(len(order), np.int64)
    place[order] = spread(np.arange(len(starts)), starts, len(order))
    ids = block.ids[doc]
    if len(starts):
        shared = np.minimum.reduceat(ids[order], starts) != np.maximum.reduceat(ids[order], starts)
    else:
        shared = np.zeros(0, bool)
    return at, doc, place, value[order][starts], shared


def part_of(hashes: np.ndarray, bits: int) -> np.ndarray:
    """The 32 bits after those that name the bucket."""
    return ((hashes << np.uint64(bits)) >> np.uint64(32)).astype(np.uint32)


def sampled(frame: DataFrame, names: tuple[str, str], period: int, length: int, bits: int) -> DataFrame:
    """For each block and bucket the cover strings' hashes, each once."""

    def run(batches):
        let_go()
        for batch in one_by_one(batches):
            for number, rows, copies in zip(*(batch.column(c).to_pylist() for c in ("block", "rows", "copies")), strict=True):
                hashes = cover_ranks(Block(rows, *names, copies), period, length)[3]
                found = [(bucket, np.unique(part_of(hashes[a:b], bits)).tobytes()) for bucket, a, b in slices(hashes, bits)]
                n = len(found)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([b for b, _ in found], pa.int32()), pa.array([number] * n, pa.int64()), pa.array([h for _, h in found], pa.binary())],
                    names=["bucket", "block", "hashes"],
                )

    return frame.mapInArrow(run, "bucket int, block long, hashes binary")


def flagged(frame: pd.DataFrame) -> pd.DataFrame:
    """Of one bucket: for each block a bit for each hash, set if another block has it too."""
    parts = [np.frombuffer(h, np.uint32) for h in frame["hashes"]]
    sizes = np.fromiter(map(len, parts), np.int64, len(parts))
    keys = np.concatenate(parts).astype(np.uint64) << np.uint64(32) | np.repeat(np.arange(len(parts)), sizes).astype(np.uint64)
    keys.sort()
    starts = groups_of(keys >> np.uint64(32))
    several = spread(np.diff(np.append(starts, len(keys))) > 1, starts, len(keys))
    flags = several[np.argsort(keys & np.uint64(0xFFFFFFFF), kind="stable")]
    bits = [np.packbits(f).tobytes() for f in np.split(flags, np.cumsum(sizes)[:-1])]
    return pd.DataFrame({"block": frame["block"], "bucket": frame["bucket"], "bits": bits})


def candidates(frame: DataFrame, names: tuple[str, str], span: int, period: int, bits: int) -> DataFrame:
    """Blocks with runs of the positions whose `span` bytes can occur in another text, and their number."""
    length = span - period + 1

    def run(batches):
        let_go()
        for batch in one_by_one(batches):
            out = []
            for number, rows, copies, flags in zip(*(batch.column(c).to_pylist() for c in ("block", "rows", "copies", "flags")), strict=True):
                block = Block(rows, *names, copies)
                at, doc, place, hashes, shared = cover_ranks(block, period, length)
                known = {f["bucket"]: f["bits"] for f in flags or []}
                for bucket, a, b in slices(hashes, bits):
                    part = part_of(hashes[a:b], bits)
                    distinct = np.unique(part)
                    bit = np.unpackbits(np.frombuffer(known[bucket], np.uint8), count=len(distinct))
                    shared[a:b] |= bit[np.searchsorted(distinct, part)] == 1
                hit = np.flatnonzero(shared[place])
                first = np.maximum(at[hit] - period + 1, block.starts[doc[hit]])
                last = np.minimum(at[hit], block.starts[doc[hit]] + block.lengths[doc[hit]] - span)
                fits = last >= first
                first, last = first[fits], last[fits]  # ascending, as positions are; runs that touch within a text join
                reach = np.maximum.accumulate(last) if len(last) else last
                begin = np.append(True, first[1:] > reach[:-1] + 1) if len(first) else np.zeros(0, bool)
                runs = np.stack((first[begin], reach[np.append(begin[1:], True)] if len(first) else last)) if len(first) else np.zeros((2, 0), np.int64)
                out.append((number, rows, copies, runs.astype("<i8").tobytes(), int((runs[1] - runs[0] + 1).sum())))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*out) if out else [[]] * 5, (pa.int64(), pa.binary(), pa.list_(pa.int32()), pa.binary(), pa.int64()), strict=True)],
                names=["block", "rows", "copies", "runs", "suffixes"],
            )

    return frame.mapInArrow(run, "block long, rows binary, copies array<int>, runs binary, suffixes long")


def turn_of(keys: np.ndarray) -> np.ndarray:
    """A turn sorts the keys of a range; TURNS is a power of two."""
    return (keys >> np.uint64(65 - TURNS.bit_length())).astype(np.int64) if TURNS > 1 else np.zeros(len(keys), np.int64)


class Suffixes:
    """The candidate suffixes of a block in the order of their keys; each distinct key once, with the smallest id."""

    def __init__(self, block: Block, runs: bytes, span: int, turn: int | None):
        first, last = np.frombuffer(runs, "<i8").reshape(2, -1)
        sizes = last - first + 1
        at = np.repeat(first - np.cumsum(sizes) + sizes, sizes) + np.arange(int(sizes.sum()))
        key, check = block.hashes(at, span, check=True)
        if turn is not None:
            mine = turn_of(key) == turn
            at, key, check = at[mine], key[mine], check[mine]
        doc = np.searchsorted(block.starts, at, side="right") - 1
        order = sorted_by(key, check)
        self.at, self.key, self.check, self.ids = at[order], key[order], check[order], block.ids[doc[order]]
        self.starts = groups_of(self.key, self.check)
        self.low = np.minimum.reduceat(self.ids, self.starts) if len(self.starts) else self.ids


def shipped(frame: DataFrame, names: tuple[str, str], span: int, turn: int, bits: int) -> DataFrame:
    """For each block and bucket of a turn the keys, checks and smallest ids of its suffixes."""

    def run(batches):
        let_go()
        for batch in one_by_one(batches):
            for number, rows, runs in zip(*(batch.column(c).to_pylist() for c in ("block", "rows", "runs")), strict=True):
                if not runs:
                    continue
                suffixes = Suffixes(Block(rows, *names), runs, span, turn)
                keys, checks, low = suffixes.key[suffixes.starts], suffixes.check[suffixes.starts], suffixes.low
                base = int(low.min(initial=np.iinfo(np.int64).max))
                narrow = len(low) > 0 and int(low.max()) - base < 2**32
                found = [
                    (bucket, keys[a:b].tobytes(), checks[a:b].tobytes(), (low[a:b] - base).astype(np.uint32).tobytes() if narrow else low[a:b].tobytes())
                    for bucket, a, b in slices(keys, bits)
                ]
                n = len(found)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([f[0] for f in found], pa.int32()), pa.array([number] * n, pa.int64()), pa.array([base if narrow else None] * n, pa.int64()),
                     *(pa.array([f[i] for f in found], pa.binary()) for i in (1, 2, 3))],
                    names=["bucket", "block", "base", "keys", "checks", "ids"],
                )
        give_back()

    return frame.mapInArrow(run, "bucket int, block long, base long, keys binary, checks binary, ids binary")


def ranked(frame: pd.DataFrame) -> pd.DataFrame:
    """Of one bucket: for each block a bit for each key, set if a text of another block with a smaller id has the string."""
    keys = [np.frombuffer(k, np.uint64) for k in frame["keys"]]
    ids = np.concatenate([
        np.frombuffer(i, np.int64) if pd.isna(b) else np.frombuffer(i, np.uint32).astype(np.int64) + int(b)
        for i, b in zip(frame["ids"], frame["base"], strict=True)
    ])
    key, check = np.concatenate(keys), np.concatenate([np.frombuffer(c, np.uint32) for c in frame["checks"]])
    order = sorted_by(key, check)
    starts = groups_of(key[order], check[order])
    flags = np.empty(len(key), bool)
    flags[order] = ids[order] > spread(np.minimum.reduceat(ids[order], starts), starts, len(key))
    ends = np.cumsum([len(k) for k in keys])
    bits = [np.packbits(f).tobytes() for f in np.split(flags, ends[:-1])]
    return pd.DataFrame({"block": frame["block"], "bucket": frame["bucket"], "bits": bits})


def cut(block: Block, runs: bytes, span: int, bits: int, flags: list) -> np.ndarray:
    """Which bytes of the block are removed."""
    known = {f["bucket"]: f["bits"] for f in flags or []}
    edge = np.zeros(block.size + 1, np.int32)
    if runs:
        suffixes = Suffixes(block, runs, span, None)
        other = np.zeros(len(suffixes.starts), bool)
        for bucket, a, b in slices(suffixes.key[suffixes.starts], bits):
            other[a:b] = np.unpackbits(np.frombuffer(known[bucket], np.uint8), count=b - a)
        low = spread(suffixes.low, suffixes.starts, len(suffixes.key))
        repeated = suffixes.at[(suffixes.ids > low) | spread(other, suffixes.starts, len(suffixes.key))]
        edge[repeated] += 1  # a position occurs once
        edge[repeated + span] -= 1
    for copy in block.copies:
        edge[block.starts[copy]] += 1
        edge[block.starts[copy] + block.lengths[copy]] -= 1
    return np.cumsum(edge)[:-1] > 0


def repeated_passages_removed(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", span: int = 50, keep_text: bool = True
) -> DataFrame:
    """Every row of docs with n_bytes, n_removed, n_spans and kept_bytes (with keep_text=False its SHA-256 as kept_sha256).

    Texts are UTF-8 bytes (null: empty). A byte goes if a string of `span` bytes that covers it also starts in a row with a
    smaller id; what goes is judged on the input, and strings never run over a text's end. Ids are whole numbers; a null id is smaller
    than all others. Repeated rows with one id remove nothing from each other. Texts shorter than span stay.
    Columns that bear an added name are replaced. An empty table gives an empty table.

    A text that a smaller id repeats as a whole goes as a whole, before suffixes are looked at. A block's suffixes are reduced to their distinct strings before they travel, so a passage in a third of all rows puts
    one entry a block into its bucket. Equal means equal in 96 bits of hash. A task holds a block or a bucket; the largest block is the longest text.
    """
    docs = docs.drop(*ADDED, "kept_sha256")
    kept = [c for c in docs.columns if keep_text or c != text_column]
    last = ("kept_bytes", T.BinaryType(), pa.binary()) if keep_text else ("kept_sha256", T.StringType(), pa.string())
    schema = T.StructType([docs.schema[c] for c in kept])
    for name in ADDED[:3]:
        schema = schema.add(name, T.LongType())
    schema = schema.add(last[0], last[1])

    def described(block: Block, gone: np.ndarray) -> Iterator[pa.RecordBatch]:
        columns = ([], [], [], [])
        for out, rest in what_is_left(block, gone):
            values = (len(out), int(out.sum()), int((out[1:] & ~out[:-1]).sum() + out[:1].sum()), rest if keep_text else hashlib.sha256(rest).hexdigest())
            for column, value in zip(columns, values, strict=True):
                column.append(value)
        made = [pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.int64(), pa.int64(), last[2]), strict=True)]
        for piece in block.table.select(kept).combine_chunks().to_batches():
            yield pa.RecordBatch.from_arrays([*piece.columns, *made], names=schema.names)

    return cut_out(docs, id_column, text_column, span, described, schema)


def what_is_left(block: Block, gone: np.ndarray) -> Iterator[tuple[np.ndarray, bytes]]:
    """For each text which of its bytes go, and the others."""
    for start, length in zip(block.starts.tolist(), block.lengths.tolist(), strict=True):
        out = gone[start : start + length]
        yield out, block.buffer[start : start + length][~out].tobytes()


def cut_out(
    docs: DataFrame, id_column: str, text_column: str, span: int,
    described: Callable[[Block, np.ndarray], Iterator[pa.RecordBatch]], schema: T.StructType,
) -> DataFrame:
    """What `described` makes, in the same task, of each block and of the marks of its bytes that go."""
    if not 20 <= span <= 256:
        raise ValueError("span must lie between 20 and 256")
    spark = docs.sparkSession
    period = max(p for p in COVERS if p <= span - 12)
    names = (id_column, text_column)
    gathered = written(blocks(docs, *names))
    stored = written(gathered.join(whole_copies(gathered, names, span), "block", "left"))
    total = stored.agg(F.sum("bytes")).first()[0] or 0
    bits = max(0, math.ceil(math.log2(max(1, total * len(COVERS[period]) / period / BUCKET))))
    samples = sampled(stored, names, period, span - period + 1, bits)
    flags = written(samples.groupBy("bucket").applyInPandas(flagged, "block long, bucket int, bits binary"))
    answers = flags.groupBy("block").agg(F.collect_list(F.struct("bucket", "bits")).alias("flags"))
    marked = written(candidates(stored.select("block", "rows", "copies").join(answers, "block", "left"), names, span, period, bits))
    suffixes = marked.agg(F.sum("suffixes")).first()[0] or 0
    fine = max(TURNS.bit_length() - 1, math.ceil(math.log2(max(1, suffixes / BUCKET))))  # a bucket lies in one turn
    turns = [
        written(shipped(marked, names, span, turn, fine).groupBy("bucket").applyInPandas(ranked, "block long, bucket int, bits binary"))
        for turn in range(TURNS)
    ]
    found = turns[0]
    for more in turns[1:]:
        found = found.unionByName(more)
    answers = found.groupBy("block").agg(F.collect_list(F.struct("bucket", "bits")).alias("flags"))

    def finish(batches):
        let_go()
        for batch in one_by_one(batches):
            for rows, copies, runs, flags in zip(*(batch.column(c).to_pylist() for c in ("rows", "copies", "runs", "flags")), strict=True):
                block = Block(rows, *names, copies)
                yield from described(block, cut(block, runs, span, fine, flags))
        give_back()

    return marked.select("block", "rows", "copies", "runs").join(answers, "block", "left").mapInArrow(finish, schema)


def drop_repeated_passages(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", span: int = 50, length_column: str | None = None
) -> DataFrame:
    """docs, without columns that bear an added name, with repeated passages cut out of the text.

    A character of which only some bytes go, goes altogether. Null texts become empty. If length_column is given and docs
    has it, it is set to the characters that are left.
    """
    docs = docs.drop(*ADDED, "kept_sha256")
    names = docs.columns

    def described(block: Block, gone: np.ndarray) -> Iterator[pa.RecordBatch]:
        texts = pa.array([rest.decode("utf-8", errors="ignore") for _, rest in what_is_left(block, gone)], pa.string())
        table = block.table.set_column(names.index(text_column), text_column, texts).combine_chunks()
        yield from table.to_batches()

    cut_text = cut_out(docs, id_column, text_column, span, described, docs.schema)
    if length_column in names:
        kind = docs.schema[length_column].dataType
        cut_text = cut_text.withColumn(length_column, F.char_length(text_column).cast(kind))
    return cut_text


def op8_suffix_array(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return repeated_passages_removed(docs, keep_text=False)
