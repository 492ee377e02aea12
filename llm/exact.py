"""Exact deduplication through an extendible-hash index kept on shared files.

A text's key is the 64-bit hash of its bytes without white space; the leading bits of the key address
a directory. A bucket that holds more texts than its capacity is split by one more bit, which doubles
the directory, until all buckets fit or the directory has its full depth; beyond that a bucket simply
grows. Texts of equal key form a chain, told apart by their bytes. Index files hold ranges of buckets,
so each owner task reads and writes one range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from llm.shared import shared_path, squeezed, stored

CAPACITY = 100_000
DEPTH = 12


def _address(key: Column, depth: int) -> Column:
    return F.shiftrightunsigned(key, 64 - depth).cast("int")


def directory(keys: DataFrame, capacity: int = CAPACITY, depth: int = DEPTH) -> DataFrame:
    """From one row per text with its key: address, local_depth, bucket; at most 2 ** depth rows.

    The bucket of an address is the shortest prefix whose texts fit the capacity. bucket is the first
    address of that prefix, so buckets are ranges of keys.
    """
    counts = keys.groupBy(_address(F.col("key"), depth).alias("address")).agg(F.count(F.lit(1)).alias("n"))
    levels = counts.select("address", "n", F.explode(F.sequence(F.lit(0), F.lit(depth))).alias("level"))
    prefix = F.expr(f"shiftleft(shiftright(address, {depth} - level), {depth} - level)")
    levels = levels.withColumn("bucket", prefix)
    fits = levels.groupBy("level", "bucket").agg(F.sum("n").alias("held"))
    fits = fits.filter((F.col("held") <= capacity) | (F.col("level") == depth)).drop("held")
    found = levels.join(fits, ["level", "bucket"]).groupBy("address").agg(F.min(F.struct("level", "bucket")).alias("b"))
    return found.select("address", F.col("b.level").alias("local_depth"), F.col("b.bucket").alias("bucket"))


def keyed(docs: DataFrame, text: str = "text", key_bits: int = 64) -> DataFrame:
    """docs with _plain (the text without white space, null as empty) and key added."""
    out = docs.withColumn("_plain", squeezed(F.col(f"`{text}`")))
    return out.withColumn("key", F.shiftleft(F.xxhash64("_plain"), 64 - key_bits))


def build_index(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY, depth: int = DEPTH, key_bits: int = 64
) -> DataFrame:
    """One row for each distinct text: bucket, key, chain, text_sha256, group_size, keep_chars, keep_id.

    Grouping by key and bytes compares the bytes of texts with equal keys; copies are folded in every
    task before the shuffle, so a text that fills a third of the rows arrives once from each task.
    chain numbers the texts of one key. The row that stays has the most code points, then the smallest
    id; a null id loses against any other.
    """
    rows = keyed(docs.select(F.col(f"`{doc_id}`").alias("_id"), F.col(f"`{text}`").alias("_text")), "_text", key_bits)
    rows = rows.select("key", "_plain", F.struct(chars_of("_text"), F.bitwise_not("_id").alias("other")).alias("rank"))
    slots = rows.groupBy("key", "_plain").agg(F.count(F.lit(1)).alias("group_size"), F.max("rank").alias("best"))
    slots = stored(
        slots.select(
            "key",
            F.sha2(F.col("_plain").cast("binary"), 256).alias("text_sha256"),
            "group_size",
            F.col("best.chars").alias("keep_chars"),
            F.bitwise_not("best.other").alias("keep_id"),
        ),
        "exact-texts",
    )
    cells = F.broadcast(directory(slots, capacity, depth))
    slots = slots.withColumn("address", _address(F.col("key"), depth)).join(cells, "address").drop("address")
    chain = F.row_number().over(W.partitionBy("key").orderBy("text_sha256")) - 1
    index = slots.withColumn("chain", chain).repartitionByRange("bucket", "key").sortWithinPartitions("bucket", "key", "chain")
    path = shared_path(docs.sparkSession, "exact-index")
    index.write.parquet(path)
    return docs.sparkSession.read.schema(index.schema).parquet(path)


def chars_of(text: str) -> Column:
    return F.char_length(F.coalesce(F.col(f"`{text}`"), F.lit(""))).cast("long").alias("chars")


def looked_up(docs: DataFrame, index: DataFrame, doc_id: str = "doc_id", text: str = "text", key_bits: int = 64) -> DataFrame:
    """docs as _row with _id, text_sha256, keep_id, group_size and kept.

    Rows that tie with the staying row in length and id are all kept here; deduplicated() leaves one.
    """
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    rows = rows.withColumns({"_id": F.col(f"_row.`{doc_id}`"), "_text": F.col(f"_row.`{text}`")})
    rows = keyed(rows, "_text", key_bits).select(
        "_row", "_id", "key", chars_of("_text"), F.sha2(F.col("_plain").cast("binary"), 256).alias("text_sha256")
    )
    found = rows.join(index.drop("bucket", "local_depth", "chain"), ["key", "text_sha256"])
    kept = (F.col("chars") == F.col("keep_chars")) & F.col("_id").eqNullSafe(F.col("keep_id"))
    return found.withColumn("kept", kept)


def deduplicated(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of docs for each distinct text, with the columns of docs.

    Of rows that tie in length and id too, one stays; which of them is not fixed.
    """
    kept = looked_up(docs, build_index(docs, doc_id, text), doc_id, text).filter("kept")
    single = kept.filter("group_size = 1")
    copied = kept.filter("group_size > 1").dropDuplicates(["key", "text_sha256"])
    return single.unionByName(copied).select("_row.*")
