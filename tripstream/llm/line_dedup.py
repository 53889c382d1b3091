"""Frequent lines, found in a sharded minimal perfect hash over the hashes of all distinct lines."""

from __future__ import annotations

import io

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripstream.llm.common import ascii_lower, partitions, plain, stored, unused

SPACES = " \t\n\x0b\f\r"
ADDED = ("n_lines", "n_dropped", "kept_text")
#: Bytes of text whose lines make one shard of the index, on average.
SHARD_BYTES = 32_000_000
#: A line is frequent beyond doubt, and skips the index, with more documents than this share of a mean partition's lines.
SHARE = 4
#: Bits of a level's table for each key that reaches it.
ROOM = 2


def mixed(keys: np.ndarray, level: int) -> np.ndarray:
    """Another 64-bit hash of 64-bit hashes for each level."""
    x = keys ^ np.uint64((0x9E3779B97F4A7C15 * (level + 1)) & (2**64 - 1))
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


class PerfectHash:
    """Distinct 64-bit keys to 0..n-1 without gaps, in a few bits a key.

    On each level a key that has its slot to itself sets the slot's bit and leaves; the others go on to the next
    level. A key's place is the number of set bits before its own.
    """

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels
        self.before, total = [], 0
        for words in levels:
            counts = np.cumsum(np.bitwise_count(words), dtype=np.int64)
            self.before.append(total + np.concatenate(([0], counts[:-1])))
            total += int(counts[-1])

    @classmethod
    def of(cls, keys: np.ndarray) -> PerfectHash:
        levels: list[np.ndarray] = []
        while len(keys):
            words = -(-ROOM * len(keys) // 64)
            slot = (mixed(keys, len(levels)) % np.uint64(words * 64)).astype(np.int64)
            alone = np.bincount(slot, minlength=words * 64) == 1
            levels.append(np.packbits(alone, bitorder="little").view(np.uint64))
            keys = keys[~alone[slot]]
        return cls(levels)

    def place(self, keys: np.ndarray) -> np.ndarray:
        """The place of each key; -1 for most keys that aren't in it."""
        found, open_ = np.full(len(keys), -1, np.int64), np.arange(len(keys))
        for level, (words, before) in enumerate(zip(self.levels, self.before, strict=True)):
            slot = mixed(keys[open_], level) % np.uint64(len(words) * 64)
            word, bit = (slot >> np.uint64(6)).astype(np.int64), slot & np.uint64(63)
            here = (words[word] >> bit) & np.uint64(1) == 1
            below = words[word] & ((np.uint64(1) << bit) - np.uint64(1))
            found[open_[here]] = (before[word] + np.bitwise_count(below))[here]
            open_ = open_[~here]
        return found


def line_key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(SPACES)))


def hashed(key: Column) -> Column:
    """96 bits that stand for a line: XXH64 chooses shard and place, CRC-32 is what fingerprints are cut from."""
    return F.struct(F.xxhash64(key).alias("h"), F.crc32(key.cast("binary")).alias("c"))


def built(least: int):
    def build(frame: pd.DataFrame) -> pd.DataFrame:
        """One shard: the perfect hash, and in its order fingerprints and counts (up to 65535).

        Of lines that share all 64 bits of a place's key one is in the arrays; the others, if frequent, are listed beside them.
        """
        frame = frame.sort_values(["h", "c"])
        keys = frame["h"].to_numpy().view(np.uint64)
        keys, first = np.unique(keys, return_index=True)
        index = PerfectHash.of(keys)
        place = index.place(keys)
        prints, counts = np.empty(len(keys), np.uint32), np.empty(len(keys), np.uint16)
        prints[place] = frame["c"].to_numpy()[first]
        counts[place] = np.minimum(frame["n"].to_numpy()[first], 65_535)
        others = np.ones(len(frame), bool)
        others[first] = False
        others &= frame["n"].to_numpy() >= least
        file = io.BytesIO()
        np.savez(file, frame["h"].to_numpy()[others], frame["c"].to_numpy()[others], *index.levels)
        return pd.DataFrame({"shard": [frame["shard"].iloc[0]], "levels": [file.getvalue()], "prints": [prints.tobytes()], "counts": [counts.tobytes()]})

    return build


def probe(least: int, id_type: str):
    def probed(lines: pd.DataFrame, index: pd.DataFrame) -> pd.DataFrame:
        if not len(index) or not len(lines):
            return lines.iloc[:0][["id", "h", "c"]]
        with np.load(io.BytesIO(index["levels"].iloc[0])) as levels:
            other_keys, other_prints, *levels = levels.values()
        table = PerfectHash(levels)
        prints = np.frombuffer(index["prints"].iloc[0], np.uint32)
        counts = np.frombuffer(index["counts"].iloc[0], np.uint16)
        place = table.place(lines["h"].to_numpy().view(np.uint64))
        frequent = (place >= 0) & (prints[place] == lines["c"].to_numpy()) & (counts[place] >= least)
        if len(other_keys):
            listed = pd.MultiIndex.from_arrays([other_keys, other_prints])
            frequent |= pd.MultiIndex.from_arrays([lines["h"], lines["c"]]).isin(listed)
        return lines.loc[frequent, ["id", "h", "c"]]

    return probed


def frequent_lines_dropped(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", least: int = 10
) -> DataFrame:
    """Every row of docs with n_lines, n_dropped and kept_text.

    Lines end at \\n (null or empty text: one empty line). A line's key is the line without [\\x20\\x09-\\x0D] at both ends, A-Z
    lower-cased. Lines with a non-empty key that occurs in at least `least` rows are dropped everywhere; the rest stay,
    joined by \\n. Repeated rows count each; rows that share an id (or have none) get right results, as a line goes
    or stays in all rows alike. Columns that bear an added name are replaced. An empty table gives an empty table.

    Lines travel as 96-bit hashes. Their counts, aggregated before the shuffle, go to shards of a perfect hash; documents send
    their distinct hashes to the shards, are answered from the arrays, and get back the frequent ones. Lines that are
    frequent beyond doubt skip this: at most SHARE for each partition, which bounds their broadcast, so no shard is hot.
    """
    if not 0 < least < 65_536:
        raise ValueError("least must lie between 1 and 65535")
    spark = docs.sparkSession
    docs = docs.drop(*ADDED)
    text = plain(text_column)
    shards = max(1, -(-int(docs.agg(F.sum(F.octet_length(text))).first()[0] or 0) // SHARD_BYTES))
    keys = F.array_distinct(F.filter(F.transform(F.split(text, "\n"), line_key), lambda k: k != ""))
    lines = docs.select(F.col(id_column).alias("id"), F.explode(F.transform(keys, hashed)).alias("k")).select(
        "id", "k.h", "k.c", F.pmod("k.h", F.lit(shards)).cast("int").alias("shard")
    )
    counts = stored(lines.groupBy("shard", "h", "c").agg(F.count("*").alias("n")))
    total = counts.agg(F.sum("n")).first()[0] or 0
    sure = counts.where(F.col("n") > max(least, total // (SHARE * partitions(spark)))).select("h", "c")
    index = counts.repartition(shards, "shard").groupBy("shard").applyInPandas(
        built(least), "shard int, levels binary, prints binary, counts binary"
    )
    rest = lines.join(F.broadcast(sure), ["h", "c"], "left_anti")
    schema = f"id {docs.schema[id_column].dataType.simpleString()}, h long, c long"
    answered = rest.groupBy("shard").cogroup(index.groupBy("shard")).applyInPandas(probe(least, schema), schema)
    known = lines.join(F.broadcast(sure), ["h", "c"], "left_semi").select("id", "h", "c")
    of, gone, stay = (unused(n, docs.columns) for n in ("id", "gone", "stay"))
    drops = answered.unionByName(known).groupBy(F.col("id").alias(of)).agg(F.collect_set(F.struct("h", "c")).alias(gone))
    split = F.split(text, "\n")
    stays = F.filter(split, lambda line: F.col(gone).isNull() | ~F.array_contains(F.col(gone), hashed(line_key(line))))
    joined = docs.join(drops, docs[id_column].eqNullSafe(drops[of]), "left").withColumn(stay, stays)
    return joined.select(
        *docs.columns,
        F.size(split).cast("long").alias("n_lines"),
        (F.size(split) - F.size(stay)).cast("long").alias("n_dropped"),
        F.array_join(stay, "\n").alias("kept_text"),
    )


def op4_line_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return frequent_lines_dropped(docs).select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


OP4_SQL = """
WITH s AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS i FROM s),
k AS (
    SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
    FROM l),
f AS (SELECT key FROM k WHERE key <> '' GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, count(*) AS n_lines, count(f.key) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE f.key IS NULL), '')) AS kept_sha256
FROM k LEFT JOIN f ON k.key = f.key GROUP BY doc_id
"""
