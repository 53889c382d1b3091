"""Packing by concatenate and cut: prefix sums of token totals give each document its global offset; windows are fixed."""

from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripstream.llm.bpe import shared_bpe
from tripstream.llm.common import stored
from tripstream.llm.common_arrow import ROWS, appended, texts_of
from tripstream.llm.piece_table import PieceTable
from tripstream.llm.pretokens import held, let_go

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
WINDOW = 2048
END = 1


def table_of_ids(vocabulary: str) -> PieceTable:
    """Ids of pieces, the same as the tokenizers library gives."""
    return held(("table", vocabulary), lambda: PieceTable(shared_bpe(vocabulary).merged_pieces))


def tokenised(docs: DataFrame, id_column: str, text_column: str, vocabulary: str, end: int) -> DataFrame:
    """Per document its ids (with end) and, as partition and running total, its place in the partition's tokens."""
    last = np.array([end], "<u4").tobytes()

    def make():
        table, part, total = table_of_ids(vocabulary), TaskContext.get().partitionId(), 0

        def work(batch):
            nonlocal total
            ids = [i + last for i in table.of(texts_of(batch, text_column))]
            counts = [len(i) // 4 for i in ids]
            starts = [total, *(total + np.cumsum(counts, dtype=np.int64)).tolist()]
            total = starts.pop()
            return [[part] * len(ids), starts, counts, ids]

        return work

    added = {"__part": "int", "__start": "bigint", "__tokens": "bigint", "__ids": "binary"}
    return appended(docs.select(id_column, text_column), added, make, keep=[id_column])


def placed(tokens: DataFrame) -> DataFrame:
    """tokens with __at, the document's global offset. The totals are one row for each partition, which bounds the broadcast."""
    totals = tokens.groupBy("__part").agg(F.max(F.col("__start") + F.col("__tokens")).alias("__sum"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("__part", F.coalesce(F.sum("__sum").over(before), F.lit(0)).alias("__base"))
    return tokens.join(F.broadcast(bases), "__part").withColumn("__at", F.col("__base") + F.col("__start"))


def pack(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", vocabulary: str = VOCABULARY,
    window: int = WINDOW, end: int = END, with_ids: bool = False,
) -> DataFrame:
    """The pieces into which packing cuts the documents: one row for each document and sequence that share ids.

    Columns: the id, start (ids of the document before the piece), length, ids_crc32, doc_tokens, sequence_id, offset,
    and ids (little-endian unsigned 32-bit) if asked for. Null and empty texts hold the end id alone; texts of any length
    are cut as often as needed; repeated rows are packed each; other columns are left out. Every sequence but the
    last is full. An empty table gives no piece.

    Texts are encoded once, into a table in the shared folder; the order of its rows is the packing order, so
    a lost executor's work gives the same cuts again.
    """
    tokens = placed(stored(tokenised(docs, id_column, text_column, vocabulary, end)))
    kind = tokens.schema[id_column].dataType
    schema = T.StructType([T.StructField(id_column, kind)])
    for name, of in [("start", "long"), ("length", "long"), ("ids_crc32", "long"), ("doc_tokens", "long"),
                     ("sequence_id", "long"), ("offset", "long"), *([("ids", "binary")] * with_ids)]:
        schema = schema.add(name, of)

    def cut(batches):
        let_go()
        for batch in (b.slice(at, ROWS) for b in batches for at in range(0, b.num_rows, ROWS)):
            rows, columns = [], [[] for _ in schema.fields[1:]]
            for i, (at, count, ids) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("__at", "__tokens", "__ids")), strict=True)):
                view, start = memoryview(ids), 0
                while start < count:
                    sequence, offset = divmod(at + start, window)
                    length = min(window - offset, count - start)
                    part = view[4 * start : 4 * (start + length)]
                    values = (start, length, zlib.crc32(part), count, sequence, offset, *([bytes(part)] if with_ids else []))
                    for column, value in zip(columns, values, strict=True):
                        column.append(value)
                    rows.append(i)
                    start += length
            made = [pa.array(c, pa.binary() if f.dataType == T.BinaryType() else pa.int64()) for f, c in zip(schema.fields[1:], columns, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(id_column).take(pa.array(rows, pa.int64())), *made], names=schema.names)

    return tokens.select(id_column, "__at", "__tokens", "__ids").mapInArrow(cut, schema)


def sequences(pieces: DataFrame, window: int = WINDOW, pad: int = 0) -> DataFrame:
    """The packed sequences themselves: sequence_id, length (without padding) and ids, from pieces with ids.

    Windows whose pieces lie side by side in a partition are joined there; only what a partition begins or
    ends with is a boundary record that moves, at most a window's ids each. A last sequence is padded to the window unless
    its length is a power of two.
    """
    schema = "sequence_id long, offset long, ids binary"

    def join(batches):
        at, held = None, []  # pieces of the sequence under way

        def closed():
            return (at, held[0][0], b"".join(x for _, x in held))

        for batch in batches:
            out = []
            for sequence, offset, ids in zip(*(batch.column(c).to_pylist() for c in ("sequence_id", "offset", "ids")), strict=True):
                if held and (sequence != at or offset != held[-1][0] + len(held[-1][1]) // 4):
                    out.append(closed())
                    held = []
                at = sequence
                held.append((offset, ids))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out) if out else ([], [], []), (pa.int64(), pa.int64(), pa.binary()), strict=True)], names=["sequence_id", "offset", "ids"])
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(closed(), (pa.int64(), pa.int64(), pa.binary()), strict=True)], names=["sequence_id", "offset", "ids"])

    runs = pieces.select("sequence_id", "offset", "ids").mapInArrow(join, schema)
    full = F.octet_length("ids") == 4 * window
    boundary = (
        runs.where(~full).groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("p"))
        .select("sequence_id", F.aggregate("p", F.lit(b""), lambda a, x: F.concat(a, x["ids"])).alias("ids"))
    )
    whole = runs.where(full).select("sequence_id", "ids").unionByName(boundary)
    length = (F.octet_length("ids") / 4).cast("long")
    missing = F.when(F.bin(length).rlike("^10*$"), 0).otherwise(window - length)
    padding = F.unhex(F.repeat(F.lit(int(pad).to_bytes(4, "little").hex()), missing.cast("int")))
    return whole.select("sequence_id", length.alias("length"), F.concat("ids", padding).alias("ids"))


def op6_packing(spark, sf_dir: str) -> DataFrame:
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"))
