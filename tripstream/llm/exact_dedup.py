"""Exact duplicates by content sort: range partitions from sampled splitters, external sort, neighbours compared."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripstream.llm.common import ascii_lower, partitions, plain, stored

ADDED = ("keep_id", "group_size", "kept", "text_sha256")
#: Bytes of text in the splitters that the driver gathers; a hash of the whole text follows them.
PREFIX = 24
#: A text is spread over several partitions when it has more rows than this share of a mean partition.
SHARE = 4


def exact_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Every row of docs with keep_id, group_size, kept and text_sha256.

    Texts are equal when identical after lower-casing A-Z; null counts as empty. Of equal texts the row with the
    largest id stays (a null id is the smallest); of rows that repeat both text and id, one stays. group_size counts
    rows. Columns of docs that bear one of the added names are replaced. An empty table gives an empty table.

    Rows are range-partitioned and sorted by text prefix, hash and full text, so equal texts lie side by side and the
    window compares neighbours in full. A text held by more rows than a quarter of a mean partition is dealt by
    the hash of its ids as well; its totals come from an aggregation that collapses copies before their shuffle.
    At most SHARE texts a partition can be that frequent, which bounds both broadcasts.
    """
    spark = docs.sparkSession
    parts = partitions(spark)
    docs = docs.drop(*ADDED)
    text = plain(text_column)
    hashed = docs.withColumn("__hash", F.xxhash64(F.lower(text)))
    share = max(1, docs.count() // (SHARE * parts))
    frequent = stored(
        hashed.groupBy("__hash").agg(F.count("*").alias("__rows")).where(F.col("__rows") > share)
        .select("__hash", F.ceil(F.col("__rows") / share).alias("__salts"))
    )
    keyed = hashed.withColumn("__norm", ascii_lower(text))
    totals = (
        keyed.join(F.broadcast(frequent), "__hash", "left_semi")
        .groupBy("__norm").agg(F.max(id_column).alias("__keep"), F.count("*").alias("__size"))
        .select(F.sha2("__norm", 256).alias("__sha"), "__keep", "__size")
    )
    placed = (
        keyed.join(F.broadcast(frequent), "__hash", "left")
        .withColumn("__salt", F.coalesce(F.pmod(F.xxhash64(F.col(id_column)), "__salts"), F.lit(0)))
        .withColumn("__prefix", F.left("__norm", F.lit(PREFIX)))
        .repartitionByRange(parts, "__prefix", "__hash", "__salt")
    )
    equal = Window.partitionBy("__prefix", "__hash", "__salt", "__norm")
    ordered = equal.orderBy(F.col(id_column).desc())
    whole = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ranked = placed.select(
        *docs.columns,
        F.sha2("__norm", 256).alias("__sha_all"),
        F.first(id_column).over(whole).alias("__first"),
        F.count("*").over(whole).alias("__count"),
        F.row_number().over(ordered).alias("__rank"),
    )
    joined = ranked.join(F.broadcast(totals), F.col("__sha_all") == F.col("__sha"), "left")
    split = F.col("__size").isNotNull()
    keep = F.when(split, F.col("__keep")).otherwise(F.col("__first"))
    return joined.select(
        *docs.columns,
        keep.alias("keep_id"),
        F.coalesce("__size", "__count").alias("group_size"),
        ((F.col("__rank") == 1) & F.col(id_column).eqNullSafe(keep)).alias("kept"),
        F.col("__sha_all").alias("text_sha256"),
    )


def drop_exact_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows that stay, with the columns of docs (but for those named like an added one)."""
    return exact_duplicates(docs, id_column, text_column).where("kept").drop(*ADDED)


def op3_exact_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return exact_duplicates(docs).drop("text")


OP3_SQL = """
WITH d AS (
    SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
    FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, text_sha256
FROM d WINDOW w AS (PARTITION BY text_sha256)
"""
