"""Resampling towards a target: documents drawn by how much likelier their hashed word runs are in the target's texts.

Separators are collapsed to single spaces, so one overlapped scan with lookarounds at word borders emits every run of words as a span,
whose bytes are counted by their CRC. A text is scanned once: its counts are kept in a table, from which corpus totals and
then weights are taken.
"""

from __future__ import annotations

import hashlib
import math
import operator
import zlib

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripstream.llm.common import partitions, stored
from tripstream.llm.common_arrow import appended, texts_of

BUCKETS, PERCENT, MIN_WORDS, SEED = 10_000, 10, 20, 2024
#: How far above the share to be drawn the first cut by score may lie, as a share of all; what the approximate quantile can be off is a tenth of it.
SLACK = 0.01
WORD = [*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]
#: Bytes of words as they are, A-Z in lower case, all others as separators.
COLLAPSE = bytes(b if b in WORD else b + 32 if 0x41 <= b <= 0x5A else 32 for b in range(256))


def runs(longest: int, shortest: int = 1) -> list[regex.Pattern]:
    """A pattern for each number of words, over UTF-8 in which single spaces separate words."""
    return [regex.compile(rb"(?<![^ ])[^ ]++(?: [^ ]++){%d}(?![^ ])" % (n - 1)) for n in range(shortest, longest + 1)]


def collapsed(text: str) -> bytes:
    return b" ".join(text.encode().translate(COLLAPSE).split())


def codes(line: bytes, patterns: list[regex.Pattern]) -> np.ndarray:
    """The CRC of every run of words in the line."""
    each = [np.fromiter(map(zlib.crc32, map(operator.itemgetter(0), p.finditer(line, overlapped=True))), np.uint32) for p in patterns]
    return each[0] if len(each) == 1 else np.concatenate(each)


def counted(texts: list[str], patterns: list[regex.Pattern], buckets: int) -> list[list]:
    """For each text: words, features, and the buckets that occur in it with their counts, both as unsigned 32-bit binary."""
    words, features, of, n = [], [], [], []
    for text in texts:
        line = collapsed(text)
        bucket, count = np.unique(codes(line, patterns) % np.uint32(buckets), return_counts=True)
        words.append(line.count(b" ") + bool(line))
        features.append(int(count.sum()))
        of.append(bucket.astype("<u4").tobytes())
        n.append(count.astype("<u4").tobytes())
    return [words, features, of, n]


def totals(frame: DataFrame, buckets: int) -> np.ndarray:
    """Counts of all buckets; the driver gets one number a bucket."""

    def run(batches):
        found = np.zeros(buckets, np.int64)
        for batch in batches:
            of, n = (np.frombuffer(b"".join(batch.column(c).to_pylist()), "<u4") for c in ("of", "n"))
            found += np.bincount(of, weights=n, minlength=buckets).astype(np.int64)
        at = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(found[at], pa.int64())], names=["bucket", "total"])

    sums = frame.select("of", "n").mapInArrow(run, "bucket int, total bigint").groupBy("bucket").agg(F.sum("total").alias("total"))
    out = np.zeros(buckets, np.int64)
    for row in sums.collect():
        out[row["bucket"]] = row["total"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """For each bucket a thousand times the log of how much likelier it is in the target, with one added to every count, rounded down."""
    buckets, all_corpus, all_target = len(corpus), float(corpus.sum()), float(target.sum())
    return np.array([
        math.floor(1000 * math.log((t + 1) * (all_corpus + buckets) / ((s + 1) * (all_target + buckets))))
        for s, t in zip(corpus.astype(float).tolist(), target.astype(float).tolist(), strict=True)
    ], np.int64)


def noise(seed: int, identifier) -> int:
    """A thousand times a Gumbel variate, rounded down; drawing the largest sums draws without replacement by weight."""
    h = int(hashlib.sha256(f"{seed}:{'' if identifier is None else identifier}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def resample(
    docs: DataFrame, target: DataFrame, id_column: str = "doc_id", text_column: str = "text", target_text: str = "text", longest: int = 1,
    buckets: int = BUCKETS, percent: int = PERCENT, min_words: int = MIN_WORDS, seed: int = SEED, keep_text: bool = False,
) -> DataFrame:
    """docs (without their text, unless keep_text) with n_features, weight, score and rank (from 1; null where not drawn).

    Words are runs of ASCII digits, letters (A-Z lower-cased) and all characters beyond ASCII; features are runs of 1 to `longest` words. Of the
    N documents with at least min_words words, the floor(percent * N / 100) with the highest scores are drawn; ties go to the smaller id, nulls first.
    Null texts have no words, and weight 0 as all texts without; a null id is hashed as the empty string. Repeated rows are documents of
    their own; which of them, equal in score and id, has the lower rank is open. Texts are scanned whole. An empty target weighs as one
    without counts, an empty table gives no rows. Columns that bear an added name are replaced; others pass through.

    Only rows at or above a cut by score, tested to hold all that are drawn, are sorted; their ranks come from counts by partition.
    """
    patterns = runs(longest)
    added = {"words": "bigint", "n_features": "bigint", "of": "binary", "n": "binary"}

    def features(frame: DataFrame, text: str, *others) -> DataFrame:
        plain = frame.select(F.col(f"`{text}`").alias("text"), *others)
        return stored(appended(plain, added, lambda: lambda batch: counted(texts_of(batch, "text"), patterns, buckets), keep=plain.columns[1:]))

    new = ("n_features", "weight", "score", "rank")
    names = [c for c in docs.columns if c.lower() not in new and (keep_text or c != text_column)]
    found = features(docs, text_column, F.struct(*(F.col(f"`{c}`") for c in names)).alias("row"), F.col(f"`{id_column}`").alias("id"))
    gain = gains(totals(found, buckets), totals(features(target, target_text), buckets))

    def weighed():
        def work(batch):
            of, n = ([np.frombuffer(x, "<u4") for x in batch.column(c).to_pylist()] for c in ("of", "n"))
            weights = [int(gain[a] @ b.astype(np.int64)) for a, b in zip(of, n, strict=True)]
            return [weights, [w + noise(seed, i) for w, i in zip(weights, batch.column("id").to_pylist(), strict=True)]]

        return work

    scored = stored(appended(found, {"weight": "bigint", "score": "bigint"}, weighed, keep=["row", "id", "words", "n_features"]))
    long_enough = scored.where(F.col("words") >= min_words)
    share = max(0.0, 1 - percent / 100 - SLACK)
    n, cut = long_enough.agg(F.count("*"), F.percentile_approx("score", F.lit(share), F.lit(int(10 / SLACK)))).first()
    draw = percent * n // 100
    high = F.lit(False) if not draw else (F.col("words") >= min_words) & (F.col("score") >= cut)
    if draw and scored.where(high).count() < draw:
        high = F.col("words") >= min_words
    spark = docs.sparkSession
    order = [F.col("score").desc(), F.col("id").asc_nulls_first()]
    within = F.monotonically_increasing_id()
    dealt = stored(
        scored.where(high).repartitionByRange(partitions(spark), *order).sortWithinPartitions(*order)
        .withColumns({"part": F.shiftright(within, 33), "place": within.bitwiseAND(F.lit((1 << 33) - 1))})
    )
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = dealt.groupBy("part").count().select(F.col("part").alias("of_part"), F.coalesce(F.sum("count").over(before), F.lit(0)).alias("before"))
    rank = F.col("before") + F.col("place") + 1
    # One row a partition.
    ranked = dealt.join(F.broadcast(sizes), F.col("part") == F.col("of_part")).select(*scored.columns, F.when(rank <= draw, rank).alias("rank"))
    rest = scored.where(~F.coalesce(high, F.lit(False))).withColumn("rank", F.lit(None).cast("bigint"))
    return ranked.unionByName(rest).select(*(F.col("row").getField(c).alias(c) for c in names), *new)


def op12_importance(spark, sf_dir: str) -> DataFrame:
    documents, benchmark = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    return resample(documents.select("doc_id", "text"), benchmark.select("text"))


#: The CRC of a word's bytes by the table of a byte's CRC.
CRC32 = """list_reduce(list_transform(range(octet_length(encode({0})) + 1),
    lambda i: CASE WHEN i = 0 THEN 4294967295::BIGINT ELSE ('0x' || substr(hex({0}), 2 * i - 1, 2))::BIGINT END),
    lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1]))"""
CRC32_TABLE = """crc AS (SELECT list_transform(range(256), lambda b: list_reduce(list_prepend(b, range(8)),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END)) AS tab)"""

OP12_SQL = rf"""
WITH {CRC32_TABLE},
said AS (
    SELECT doc_id, 'd' AS side, text FROM documents UNION ALL SELECT NULL, 'b', text FROM benchmark),
words AS (
    SELECT doc_id, side, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                   '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w FROM said),
counted AS (SELECT doc_id, side, w, count(*) AS n FROM words GROUP BY ALL),
bucket AS (SELECT w, xor({CRC32.format("w")}, 4294967295::BIGINT) % 10000 AS b FROM (SELECT DISTINCT w FROM counted), crc),
sums AS (
    SELECT b, coalesce(sum(n) FILTER (side = 'd'), 0) AS s, coalesce(sum(n) FILTER (side = 'b'), 0) AS t
    FROM counted JOIN bucket USING (w) GROUP BY b),
gain AS (
    SELECT b, floor(1000 * ln((t::DOUBLE + 1) * ((SELECT sum(s) FROM sums)::DOUBLE + 10000)
                              / ((s::DOUBLE + 1) * ((SELECT sum(t) FROM sums)::DOUBLE + 10000))))::BIGINT AS g FROM sums),
weighed AS (
    SELECT doc_id, sum(n) AS n_features, sum(n * g) AS weight FROM counted JOIN bucket USING (w) JOIN gain USING (b) WHERE side = 'd' GROUP BY doc_id),
scored AS (
    SELECT doc_id, coalesce(n_features, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
           (coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296))))::BIGINT AS score
    FROM (SELECT doc_id FROM documents) LEFT JOIN weighed USING (doc_id)),
placed AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS n FROM scored WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= 10 * n // 100 THEN place END::BIGINT AS rank FROM scored LEFT JOIN placed USING (doc_id)
"""
