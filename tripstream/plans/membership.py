"""A filter of bounded size that tells which keys surely are not in a set."""

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: 64-bit words of the filter at most: with key and overhead some 40 MB where it is broadcast.
MAX_WORDS = 1 << 20
#: Bits set for each key, all in one word, and bits of the filter for each key: about one key in thirty passes unduly.
_HASHES, _BITS_A_KEY = 4, 12
#: With fewer bits a key than this, too much passes for a filter to be worth its scan.
_FEWEST_BITS = 5


class Membership(NamedTuple):
    table: DataFrame
    """(word, bits) of the words that have bits set."""
    words: int

    def may_hold(self, df: DataFrame, key: str, name: str) -> DataFrame:
        """`df` with a boolean `name`: false where the set surely lacks the key, and where that is null. No shuffle of `df`."""
        word, bits = _place(F.col(key), self.words)
        probed = df.select(F.struct("*").alias("row"), word.alias("of_word"), bits.alias("of_bits"))
        held = F.col("bits").bitwiseAND(F.col("of_bits")) == F.col("of_bits")
        joined = probed.join(F.broadcast(self.table), F.col("of_word") == F.col("word"), "left")
        return joined.select("row.*", F.coalesce(held, F.lit(False)).alias(name))


def _place(key: Column, words: int) -> tuple[Column, Column]:
    bits = F.lit(0).cast("long")
    spread = F.xxhash64(key, F.lit("bits"))
    for n in range(_HASHES):
        at = F.shiftrightunsigned(spread, 6 * n).bitwiseAND(F.lit(63)).cast("int")
        bits = bits.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), at))
    return F.when(key.isNotNull(), F.pmod(F.xxhash64(key, F.lit("word")), F.lit(words))), bits


def members(df: DataFrame, key: str, max_words: int = MAX_WORDS) -> Membership | None:
    """A filter of the keys of `df`, or None where its size would not do for so many. Runs one job, a scan of the key column.

    The filter is as large as the (estimated) number of keys asks for, and never larger than `max_words`; whatever
    the estimate, it holds every key. Words are built by a partial aggregation, so repeated keys are sent once a task.
    """
    count = df.agg(F.approx_count_distinct(key)).first()[0]
    words = max(1, min(max_words, count * _BITS_A_KEY // 64 + 1))
    if count * _FEWEST_BITS > 64 * words:
        return None
    word, bits = _place(F.col(key), words)
    keys = df.filter(F.col(key).isNotNull()).select(word.alias("word"), bits.alias("bits"))
    return Membership(keys.groupBy("word").agg(F.bit_or("bits").alias("bits")), words)
