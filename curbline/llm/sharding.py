"""Contiguous shards of nearly equal bytes, by global prefix sums.

Rows are ordered by id; each range of the order is summed on its own, the sums before each range are
added, and the order is cut at equal shares of all bytes. A row belongs to the share that holds its
middle byte, so no shard is off its target by more than the largest row.

Defined results: a null text has no bytes of its own; null ids come first; rows that tie in id, size and
checksum are interchangeable; a row larger than a share leaves shards between without rows; a table
without rows gives no rows. Only ``doc_id`` and ``text`` are read, and only numbers are shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from .ordering import before_chunk, numbered

#: Bytes that a record takes besides its text.
OVERHEAD = 16


def shard(docs: DataFrame, shards: int = 40, overhead: int = OVERHEAD) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot (place in the shard) for every row."""
    raw = F.coalesce(F.col("text").cast("binary"), F.lit("").cast("binary"))
    rows = docs.select(F.col("doc_id").cast("bigint"), (F.octet_length(raw) + overhead).cast("bigint").alias("size"),
                       F.crc32(raw).alias("text_crc32"))
    ordered = numbered(rows, "doc_id", "size", "text_crc32", label="shard-order")
    before = before_chunk(ordered, bytes=F.col("size"), rows=F.lit(1))
    all_bytes = ordered.agg(F.sum("size")).first()[0] or 1
    running = Window.partitionBy("chunk").orderBy("nth").rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("bytes_before") + F.coalesce(F.sum("size").over(running), F.lit(0))
    placed = ordered.join(before, "chunk").withColumn("_start", start)
    # In decimals: twice the bytes times the shards may exceed 64 bits.
    middle = (F.col("_start") * 2 + F.col("size")).cast("decimal(24,0)")
    placed = placed.withColumn("shard", F.least(
        F.lit(shards - 1), F.floor(middle * shards / F.lit(2 * all_bytes).cast("decimal(24,0)")).cast("int")))
    placed = placed.withColumn("_rank", F.col("rows_before") + F.col("nth"))
    first = placed.groupBy("shard").agg(F.min("_rank").alias("_first"))
    return placed.join(F.broadcast(first), "shard").select(  # at most ``shards`` rows
        "doc_id", "size", "text_crc32", "shard", (F.col("_rank") - F.col("_first")).alias("slot"))
