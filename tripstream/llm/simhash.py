"""SimHash near-duplicates: fingerprints compared bit plane by bit plane with carry-save counters."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripstream.llm.common import stored, unused
from tripstream.llm.common_arrow import appended
from tripstream.llm.components import components
from tripstream.llm.pretokens import let_go

BITS = 64
#: Fingerprints that a bucket holds on average; larger buckets are compared tile by tile of TILE.
BUCKET, TILE = 2048, 4096
ADDED = ("fingerprint", "component_id")


def fingerprint(text: bytes, shingle: int, seed: int) -> int:
    """Bits set in over half the XXH64 of the word shingles of text in UTF-8, A-Z lower-cased; no words: zero."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    take = min(shingle, len(words)) - 1
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter(
        (digest(joined[a:b], seed) for a, b in zip(starts[: len(words) - take].tolist(), ends[take:].tolist(), strict=True)),
        np.uint64, len(words) - take,
    )
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 65_536):
        ones += np.unpackbits(hashes[at : at + 65_536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprinted(docs: DataFrame, text_column: str, shingle: int, seed: int, keep: list[str], added: str = "__print") -> DataFrame:
    """The columns of docs in keep with the fingerprint as a signed long, under the name `added`; null text counts as empty."""

    def make():
        let_go()

        def work(batch):
            texts = batch.column(text_column).cast(pa.binary()).to_pylist()
            prints = np.array([fingerprint(t or b"", shingle, seed) for t in texts], np.uint64)
            return [prints.view(np.int64)]

        return work

    return appended(docs, {added: "bigint"}, make, keep=keep)


def close_pairs(left: np.ndarray, right: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Indices of pairs from two arrays of fingerprints that differ in at most radius bits.

    right is stored vertically: plane b holds bit b of 64 fingerprints a word. For every fingerprint of left, the
    differing bits of a plane are added to all distances at once by carry-save counters, which saturate beyond the
    radius; a block of 64 whose distances are all beyond it is abandoned.
    """
    width = -(-len(right) // 64) * 64
    bits = np.zeros((width, BITS), np.uint8)
    bits[: len(right)] = np.unpackbits(right.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    planes = np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").view(np.uint64)
    valid = np.packbits(np.arange(width) < len(right), bitorder="little").view(np.uint64)
    row, block = (x.ravel() for x in np.indices((len(left), width // 64)))
    beyond = ~valid[block]
    levels = max(1, math.ceil(math.log2(radius + 1)))
    counters = [np.zeros(len(row), np.uint64) for _ in range(levels)]
    # A counter of `levels` bits overflows at 2**levels; it starts so that this happens at radius + 1.
    for k in range(levels):
        if ((1 << levels) - 1 - radius) >> k & 1:
            counters[k] = ~counters[k]
    for b in range(BITS):
        flip = np.where((left >> np.uint64(b)) & np.uint64(1), ~np.uint64(0), np.uint64(0))
        carry = planes[b][block] ^ flip[row]
        for k in range(levels):
            counters[k], carry = counters[k] ^ carry, counters[k] & carry
        beyond |= carry
        if b % 6 == 5:
            live = np.flatnonzero(beyond != ~np.uint64(0))
            if len(live) < 0.7 * len(row):
                row, block, beyond = row[live], block[live], beyond[live]
                counters = [c[live] for c in counters]
            if not len(row):
                break
    live = np.flatnonzero(beyond != ~np.uint64(0))
    near = np.unpackbits((~beyond[live]).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    at, bit = np.nonzero(near)
    return row[live][at], block[live][at] * 64 + bit


def forest(a: np.ndarray, b: np.ndarray, size: int) -> np.ndarray:
    """For nodes 0..size-1 and links a-b, the smallest node that each is linked to."""
    root = np.arange(size)
    while len(a):
        low = np.minimum(root[a], root[b])
        np.minimum.at(root, root[a], low)
        np.minimum.at(root, root[b], low)
        while not np.array_equal(root, root[root]):
            root = root[root]
        open_ = root[a] != root[b]
        a, b = a[open_], b[open_]
    return root


def links(prints: DataFrame, radius: int) -> DataFrame:
    """Links (a, b), a < b, that join the distinct longs of column print as all pairs within radius bits would.

    The bits are cut into radius + 1 parts, of which a close pair shares one, and a table per part is bucketed by the
    part's first bits, as many as leave about BUCKET fingerprints a bucket. A bucket beyond TILE is cut into tiles by
    hash and compared as pairs of tiles, each a group of its own, so no group grows with the input. A group gives back
    a spanning forest of its links, never all pairs.
    """
    parts = radius + 1
    size = prints.count()
    edges = [BITS * p // parts for p in range(parts + 1)]
    fine = min(min(b - a for a, b in zip(edges, edges[1:], strict=False)), max(0, math.ceil(math.log2(max(1, size) / BUCKET))))
    keys = F.array(*[
        F.concat(F.lit(f"{p}."), F.shiftrightunsigned(F.shiftleft("print", BITS - edges[p + 1]), BITS - fine).cast("string"))
        if fine else F.lit(f"{p}.") for p in (range(parts) if fine else range(1))
    ])
    keyed = prints.select("print", F.explode(keys).alias("bucket"))
    counts = keyed.groupBy("bucket").agg(F.ceil(F.count("*") / TILE).cast("int").alias("tiles"))
    tiles = keyed.join(counts, "bucket").withColumn("tile", F.pmod(F.hash("print"), F.col("tiles")))
    other = F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))
    groups = tiles.select("print", "bucket", "tile", other.alias("other")).select(
        "print", "bucket", F.least("tile", "other").alias("low"), F.greatest("tile", "other").alias("high"),
        (F.col("tile") <= F.col("other")).alias("row_side"), (F.col("tile") >= F.col("other")).alias("column_side"),
    )

    def compare(frame):
        found = np.sort(frame["print"].to_numpy())
        values = frame["print"].to_numpy()
        left = np.sort(values[frame["row_side"].to_numpy()])
        right = np.sort(values[frame["column_side"].to_numpy()])
        root = np.arange(len(found))
        place_left, place_right = np.searchsorted(found, left), np.searchsorted(found, right)
        for at in range(0, len(left), 512):
            a, b = close_pairs(left[at : at + 512].view(np.uint64), right.view(np.uint64), radius)
            a, b = place_left[a + at], place_right[b]
            step = forest(np.concatenate((np.arange(len(root)), a)), np.concatenate((root, b)), len(found))
            root = step
        joined = np.flatnonzero(root != np.arange(len(found)))
        return frame.iloc[:0][["print"]].assign(b=0).rename(columns={"print": "a"}) if not len(joined) else type(frame)(
            {"a": found[root[joined]], "b": found[joined]}
        )

    return groups.groupBy("bucket", "low", "high").applyInPandas(compare, "a long, b long")


def carried(docs: DataFrame, text_column: str, keep_text: bool = True) -> list[str]:
    """The columns of docs that go through to the result."""
    return [c for c in docs.columns if c.lower() not in ADDED and (keep_text or c != text_column)]


def classified(
    docs: DataFrame, id_column: str, text_column: str, shingle: int, radius: int, seed: int, keep_text: bool
) -> tuple[DataFrame, str, str]:
    """docs with component_id, the smallest id of the component, and two columns under names that docs does not have: the
    fingerprint, and one that names the component."""
    keep = carried(docs, text_column, keep_text)
    own, root = unused("print", keep), unused("root", keep)
    rows = stored(fingerprinted(docs, text_column, shingle, seed, keep, own))
    smallest = stored(rows.groupBy(F.col(own).alias("print")).agg(F.min(id_column).alias("low")))
    roots = components(stored(links(smallest.select("print"), radius)), "a", "b")
    member = smallest.join(roots, F.col("print") == F.col("node"), "left").select("print", "low", F.coalesce("root", "print").alias("component"))
    lows = member.groupBy("component").agg(F.min("low").alias("component_id"))
    known = member.join(lows, "component").select(F.col("print").alias(own), F.col("component").alias(root), "component_id")
    return rows.join(known, own), own, root


def near_duplicates(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", shingle: int = 3, radius: int = 3,
    seed: int = 42, keep_text: bool = True,
) -> DataFrame:
    """Every row of docs with fingerprint (16 hex digits) and component_id.

    A text's words are what [^\\x20\\x09-\\x0D]+ matches after lower-casing A-Z; its shingles are joined by a space, and a text
    with fewer words is one shingle. No words (also null): fingerprint zero, linked like any other. component_id is the
    smallest id reachable over links of at most radius bits; ids that are null count only where all are. Repeated
    rows share fingerprint and component. Columns that bear an added name are replaced. An empty table gives an empty table.

    Rows with equal fingerprints, however many, are one node of the graph. What finds the links grows with the distinct ones.
    """
    rows, own, _ = classified(docs, id_column, text_column, shingle, radius, seed, keep_text)
    return rows.select(*carried(docs, text_column, keep_text), F.lower(F.lpad(F.hex(own), 16, "0")).alias("fingerprint"), "component_id")


def drop_near_duplicates(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", shingle: int = 3, radius: int = 3, seed: int = 42
) -> DataFrame:
    """One row of each component, with the smallest id (of repeats of it, any), and the columns of docs but ADDED."""
    rows, _, root = classified(docs, id_column, text_column, shingle, radius, seed, True)
    first = rows.where(F.col(id_column).eqNullSafe(F.col("component_id"))).dropDuplicates([root])
    return first.select(*carried(docs, text_column))


def op5_simhash(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"), keep_text=False)
