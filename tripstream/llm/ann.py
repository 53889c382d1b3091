"""Nearest neighbours by a hash-prefix forest.

A tree gives a vector a long hash string; a symbol is the vertex of a randomly turned cross-polytope that is nearest to the
vector's direction. A tree is the sorted array of its strings, in which rows that share a prefix with a query are
a range. A query descends to its longest prefixes and ascends in all trees at once, a symbol at a time, until the
ranges hold enough candidates between them; these are compared exactly.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripstream.llm.common import stored
from tripstream.llm.common_arrow import ROWS, appended

#: Trees, symbols of a string, and candidates (counted over all trees) with which the ascent ends at the earliest.
TREES, SYMBOLS, ENOUGH = 48, 3, 2048
#: Recall that the ascent has to reach, and queries that it is measured on.
RECALL, MEASURED = 0.9, 128
#: Dimensions of the cross-polytope; two symbols for each.
SIDES = 64
#: What tells ranges apart; vectors of different dimensions share none.
RANGE = ["level", "tree", "size", "prefix"]
#: Rows of a range that are compared in one piece, and rows in a group of pieces.
CHUNK, GROUP = 16_384, 65_536


@functools.cache
def turns(dimensions: int, trees: int, symbols: int, seed: int) -> np.ndarray:
    """For each symbol of each tree a random projection with orthonormal columns."""
    sides = min(dimensions, SIDES)
    random = np.random.default_rng(seed)
    return np.stack([np.linalg.qr(random.normal(size=(dimensions, sides)))[0] for _ in range(trees * symbols)]).astype(np.float32)


def hash_strings(vectors: np.ndarray, trees: int, symbols: int, seed: int) -> np.ndarray:
    """A row a vector: its strings of all trees, a byte a symbol."""
    matrices = turns(vectors.shape[1], trees, symbols, seed)
    unit = (vectors / np.linalg.norm(vectors, axis=1, keepdims=True)).astype(np.float32)
    out = np.empty((len(unit), len(matrices)), np.uint8)
    for i, matrix in enumerate(matrices):
        turned = unit @ matrix
        side = np.abs(turned).argmax(1)
        out[:, i] = 2 * side + (turned[np.arange(len(side)), side] > 0)
    return out


def usable(vector: str) -> Column:
    """Vectors without null or non-finite components that aren't all zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.col(vector).isNotNull() & finite & F.exists(vector, lambda x: x != 0)


def scaled(vectors: np.ndarray) -> np.ndarray:
    """Each vector times a power of two that brings its largest component near one: no direction or cosine changes, and no
    square is too large or too small for a double."""
    return np.ldexp(vectors, -np.frexp(np.abs(vectors).max(1, keepdims=True))[1])


def hashed(rows: DataFrame, trees: int, symbols: int, seed: int) -> DataFrame:
    """id, size (the vector's dimension), bytes (the vector, scaled, in little-endian doubles) and codes (its strings)."""

    def make():
        def work(batch):
            column = batch.column("vector")
            lengths = pc.list_value_length(column).to_numpy(zero_copy_only=False)
            values, ends = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64), np.cumsum(lengths)
            codes = [b""] * len(lengths)
            for size in np.unique(lengths).tolist():
                at = np.flatnonzero(lengths == size)
                places = (ends[at] - size)[:, None] + np.arange(size)
                values[places] = scaled(values[places])
                found = hash_strings(values[places], trees, symbols, seed)
                for i, code in zip(at.tolist(), found, strict=True):
                    codes[i] = code.tobytes()
            raw = values.astype("<f8").tobytes()
            vectors = [raw[8 * (e - n) : 8 * e] for e, n in zip(ends.tolist(), lengths.tolist(), strict=True)]
            return [lengths, vectors, codes]

        return work

    return appended(rows, {"size": "int", "bytes": "binary", "codes": "binary"}, make, keep=["id"])


def ranges(rows: DataFrame, level: int, trees: int, symbols: int, *columns: str) -> DataFrame:
    """For each row and tree its dimension and the prefix of `level` symbols; at level 0 one tree is all rows of a dimension."""
    tree = F.explode(F.sequence(F.lit(0), F.lit(trees - 1 if level else 0)))
    return rows.select(*columns, "size", "codes", tree.alias("tree")).select(
        *columns, F.lit(level).alias("level"), "tree", "size",
        F.substring("codes", F.col("tree") * symbols + 1, F.lit(level)).alias("prefix"),
    )


def measured(index: DataFrame, asked: DataFrame, k: int, trees: int, symbols: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """MEASURED queries against the whole index, in one pass: for each query its candidates at levels 1 to `symbols` (counted
    over all trees), and for its true k nearest rows the longest prefix they share with it in any tree."""
    sample = asked.orderBy(F.xxhash64("id"), "id").limit(MEASURED).select("id", "size", "bytes", "codes").collect()
    sizes = np.array([r["size"] for r in sample])
    by_size = {}
    for size in np.unique(sizes).tolist():
        at = np.flatnonzero(sizes == size)
        table = np.stack([np.frombuffer(sample[i]["bytes"], "<f8") for i in at])
        # Symbols first, so that a level is a contiguous table.
        codes = np.stack([np.frombuffer(sample[i]["codes"], np.uint8).reshape(trees, symbols).T for i in at])
        by_size[size] = at, np.array([sample[i]["id"] for i in at]), table / np.linalg.norm(table, axis=1, keepdims=True), codes
    shared = index.sparkSession.sparkContext.broadcast((len(sample), by_size))

    def run(batches):
        n, groups = shared.value
        counts = np.zeros((n, symbols), np.int64)
        best = {size: [np.full((len(at), k), fill, kind) for fill, kind in ((-np.inf, float), (0, np.int64), (0, np.int64))] for size, (at, *_) in groups.items()}
        for batch in (b.slice(at, ROWS) for b in batches for at in range(0, b.num_rows, ROWS)):
            lengths, ids = batch.column("size").to_numpy(), batch.column("id").to_numpy()
            raw, strings = batch.column("bytes").to_pylist(), batch.column("codes").to_pylist()
            for size, (at, own_ids, own, own_codes) in groups.items():
                rows = np.flatnonzero(lengths == size)
                if not len(rows):
                    continue
                table = np.frombuffer(b"".join([raw[i] for i in rows]), "<f8").reshape(-1, size)
                codes = np.frombuffer(b"".join([strings[i] for i in rows]), np.uint8).reshape(-1, trees, symbols).transpose(2, 0, 1).copy()
                level = np.zeros((len(at), len(rows)), np.int64)
                for i in range(len(at)):
                    same = True
                    for j in range(symbols):
                        same = (codes[j] == own_codes[i, j]) & same
                        counts[at[i], j] += np.count_nonzero(same)
                        level[i] += same.any(1)
                score = own @ (table / np.linalg.norm(table, axis=1, keepdims=True)).T
                score[own_ids[:, None] == ids[rows]] = -np.inf
                new = score, np.broadcast_to(ids[rows], score.shape), level
                joined = [np.concatenate(pair, 1) for pair in zip(best[size], new, strict=True)]
                top = np.argpartition(-joined[0], k - 1, 1)[:, :k]
                best[size] = [np.take_along_axis(x, top, 1) for x in joined]
        out = [(q, j + 1, int(counts[q, j]), None, None) for q in range(n) for j in range(symbols)]
        for size, (at, *_) in groups.items():
            score, ids, level = best[size]
            out += [(int(at[i]), int(level[i, j]), None, int(ids[i, j]), float(score[i, j])) for i, j in np.argwhere(score > -np.inf)]
        kinds = {"query": pa.int32(), "level": pa.int32(), "count": pa.int64(), "id": pa.int64(), "score": pa.float64()}
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds.values(), strict=True)], names=[*kinds])

    counts, levels = np.zeros((len(sample), symbols), np.int64), [[] for _ in sample]
    if sample:
        seen = stored(index.select("id", "size", "bytes", "codes").mapInArrow(run, "query int, level int, count long, id long, score double"))
        for r in seen.where("id IS NULL").groupBy("query", "level").agg(F.sum("count").alias("sum")).collect():
            counts[r["query"], r["level"] - 1] = r["sum"]
        best = Window.partitionBy("query").orderBy(F.col("score").desc(), "id")
        for r in seen.where("id IS NOT NULL").withColumn("place", F.row_number().over(best)).where(F.col("place") <= k).collect():
            levels[r["query"]].append(r["level"])
    return counts, [np.array(x) for x in levels]


def recalls(counts: np.ndarray, levels: list[np.ndarray], enough: int) -> np.ndarray:
    """For each measured query with neighbours the share of them among its candidates if the ascent ends at `enough`."""
    ends = (counts >= enough).sum(1)
    return np.array([(x >= end).mean() for x, end in zip(levels, ends.tolist(), strict=True) if len(x)])


def raised(counts: np.ndarray, levels: list[np.ndarray], enough: int, recall: float) -> int:
    """`enough`, doubled until the measured recall, less two standard errors, is reached; at the root it always is."""
    while (counts >= enough).any():
        shares = recalls(counts, levels, enough)
        if not len(shares) or shares.mean() - 2 * shares.std() / len(shares) ** 0.5 >= recall:
            break
        enough *= 2
    return enough


def nearest_in(k: int):
    """Of one group of pieces: for each query the k nearest rows of its pieces, ties to the smaller id."""
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])

    def run(queries: pa.Table, rows: pa.Table) -> pa.Table:
        out: tuple[list, list, list] = ([], [], [])
        rows = rows.sort_by([("run", "ascending"), ("id", "ascending")])
        runs, ids = rows.column("run").to_numpy(), rows.column("id").to_numpy()
        vectors, sizes = rows.column("bytes").to_pylist(), rows.column("size").to_numpy()
        queries = queries.sort_by([("run", "ascending")])
        held, low, high = None, 0, 0
        for run_id, query, size, vector in zip(*(queries.column(c).to_pylist() for c in ("run", "query_id", "size", "bytes")), strict=True):
            if run_id != held:
                held, low, high = run_id, *np.searchsorted(runs, [run_id, run_id + 1] if run_id < 2**63 - 1 else [run_id, run_id]).tolist()
                high = high if run_id < 2**63 - 1 else len(runs)
                tables: dict = {}
            if size not in tables:
                at = low + np.flatnonzero(sizes[low:high] == size)
                table = np.frombuffer(b"".join([vectors[i] for i in at.tolist()]), "<f8").reshape(-1, size)
                tables[size] = ids[at], table, np.sqrt((table * table).sum(1))
            others, table, norms = tables[size]
            own = np.frombuffer(vector, "<f8")
            score = (table * own).sum(1) / (norms * np.sqrt((own * own).sum()))
            score[others == query] = -np.inf
            take = min(k, len(score))
            if take and len(score) > 4 * k:
                edge = np.partition(score, len(score) - take)[len(score) - take]
                found = np.flatnonzero(score >= edge)
            else:
                found = np.arange(len(score))
            found = found[np.argsort(-score[found], kind="stable")][:take]
            found = found[score[found] > -np.inf]
            out[0].extend([query] * len(found))
            out[1].extend(others[found].tolist())
            out[2].extend(score[found].tolist())
        return pa.table([pa.array(c, f.type) for c, f in zip(out, schema, strict=True)], schema=schema)

    return run


def neighbours(
    vectors: DataFrame, queries: Column, id_column: str = "vec_id", vector_column: str = "embedding", k: int = 5,
    trees: int = TREES, symbols: int = SYMBOLS, enough: int = ENOUGH, seed: int = 7, recall: float = RECALL,
) -> DataFrame:
    """For the rows that the condition `queries` picks, the k nearest other rows by cosine: query_id, rank, vec_id, score.

    Scores are exact, in double precision; ties go to the smaller id. Vectors that are null, zero or hold null or non-finite
    components take no part; vectors of another dimension aren't candidates. A row isn't its own neighbour, nor is one
    that repeats its id; copies under other ids are. With fewer rows than k all are returned, for an empty table none.
    Other columns are left out.

    The hash functions are random. Where the ascent ends is measured: MEASURED queries are compared with the whole table, and `enough` is
    doubled until their recall is surely above `recall`, if need be up to the root, where all rows are compared. Of rows that share an id the one with the smallest vector (compared by components) counts. Of exact copies the k + 1 smallest
    ids stand for all, which loses no result and keeps copies from filling ranges; Spark limits these groups before its shuffle. A range is dealt
    in pieces of CHUNK rows, and its queries go to each, so no group grows with the input.
    """
    rows = vectors.select(F.col(id_column).cast("long").alias("id"), F.col(vector_column).alias("vector"), queries.alias("asks"))
    rows = rows.where(F.col("id").isNotNull() & usable("vector"))
    rows = rows.groupBy("id").agg(F.min("vector").alias("vector"), F.bool_or("asks").alias("asks"))
    first = Window.partitionBy("vector").orderBy("id")
    index = stored(hashed(rows.select("id", "vector").withColumn("n", F.row_number().over(first)).where(F.col("n") <= k + 1), trees, symbols, seed))
    active = asked = stored(hashed(rows.where("asks"), trees, symbols, seed))
    enough = raised(*measured(index, asked, k, trees, symbols), enough, recall)
    pieces = F.ceil(F.col("count") / CHUNK).cast("int")
    wanted: list[DataFrame] = []
    for level in range(symbols, -1, -1):
        counts = ranges(index, level, trees, symbols).groupBy(*RANGE).count()
        found = ranges(active, level, trees, symbols, "id").join(counts, RANGE)
        if level:
            sums = found.groupBy("id").agg(F.sum("count").alias("sum")).where(F.col("sum") >= enough)
            found = found.join(sums.select("id"), "id", "left_semi")
        found = stored(found.select("id", *RANGE, pieces.alias("pieces")))
        active = active.join(found.select("id").distinct(), "id", "left_anti")
        if not found.isEmpty():
            wanted.append(found)
    if not wanted:
        return index.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    probes = functools.reduce(DataFrame.unionByName, wanted)
    used = probes.groupBy(*RANGE).agg(F.first("pieces").alias("pieces"))
    spread = [ranges(index, f.first()["level"], trees, symbols, "id", "bytes") for f in wanted]
    groups = max(1, index.count() * trees * len(wanted) // GROUP)

    def run(piece: Column) -> Column:
        return F.xxhash64(*RANGE, piece)

    def grouped(frame: DataFrame) -> DataFrame:
        return frame.withColumn("group", F.pmod(F.hash("run"), F.lit(groups))).groupBy("group")

    rows = functools.reduce(DataFrame.unionByName, spread).join(used, RANGE).select(
        "id", "size", "bytes", run(F.pmod(F.hash("id"), "pieces")).alias("run")
    )
    asking = probes.withColumn("piece", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1))).select(
        F.col("id").alias("query_id"), run(F.col("piece")).alias("run")
    ).join(asked.select(F.col("id").alias("query_id"), "size", "bytes"), "query_id")
    pairs = grouped(asking).cogroup(grouped(rows)).applyInArrow(
        nearest_in(k), "query_id long, vec_id long, score double"
    )
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return pairs.distinct().withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"
    )


def op1_ann(spark, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return neighbours(vectors, F.col("vec_id") % 50 == 0)
