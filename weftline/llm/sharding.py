"""Byte-balanced contiguous shards from global prefix sums.

Rows get a total order (digest of the text, doc_id), so equal texts stand side by side.  A range partitioning on that
order gives cells; one small row per cell holds its bytes and rows, exclusive prefix sums over those give each cell its
offset, and a window inside the cell gives each row its own.  A row goes to the shard in which the middle of its bytes
falls when the total is cut at equal targets, so a shard's size differs from the target by less than two rows' sizes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialize, table

SHARDS = 16


def shard_by_bytes(docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard for every row of docs.

    size is UTF-8 bytes plus 1; a null text counts as no bytes and shares the checksum (0) and the place of the empty
    text.  Rows that repeat an id and text take neighbouring slots, a null id sorts first, an empty table gives no
    rows, and other columns of docs are ignored.  A text that alone exceeds the target leaves the shards it spans
    without rows.  The law is always `bytes`, so grown_shard is null.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    keyed = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(text) + F.lit(1)).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.unhex(F.md5(text.cast("binary"))).alias("g"),
    )
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cells = materialize(keyed.repartitionByRange(n, "g", "doc_id").withColumn("cell", F.spark_partition_id()), "cells")

    # One row per cell, as many as there are partitions: this window and these broadcasts don't grow with the rows.
    before = Window.orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    totals = cells.groupBy("cell").agg(F.sum("size").alias("cell_bytes"), F.count(F.lit(1)).alias("cell_rows"))
    offsets = totals.select(
        "cell",
        F.coalesce(F.sum("cell_bytes").over(before), F.lit(0)).alias("bytes_before"),
        F.coalesce(F.sum("cell_rows").over(before), F.lit(0)).alias("rows_before"),
        F.sum("cell_bytes").over(Window.partitionBy()).alias("total"),
    )
    inside = Window.partitionBy("cell").orderBy("g", "doc_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = (
        cells.select("*", F.sum("size").over(inside).alias("upto"), F.row_number().over(Window.partitionBy("cell").orderBy("g", "doc_id")).alias("nth"))
        .join(F.broadcast(offsets), "cell")
        .withColumn("row", F.col("rows_before") + F.col("nth") - 1)
        .withColumn("shard", F.expr(f"least({shards - 1}, ((2 * (bytes_before + upto) - size) * {shards}) div (2 * total))").cast("int"))
    )
    first = placed.groupBy("shard").agg(F.min("row").alias("first_row"))
    return placed.join(F.broadcast(first), "shard").select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("row") - F.col("first_row")).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 16 shards of near equal bytes."""
    return shard_by_bytes(table(spark, sf_dir, "documents", "doc_id", "text"))


OP7_SQL = f"""
WITH crc AS (
  SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda a, k: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END, i)) AS t
), d AS (
  SELECT doc_id, CAST(strlen(coalesce(text, '')) + 1 AS BIGINT) AS size, md5(coalesce(text, '')) AS g,
         regexp_extract_all(hex(encode(coalesce(text, ''))), '..') AS h
  FROM documents
), k AS (
  SELECT doc_id, size, g,
         xor(4294967295, list_reduce(list_transform(h, lambda x: CAST('0x' || x AS BIGINT)), lambda a, b: xor(a >> 8, t[1 + (xor(a, b) & 255)]), 4294967295)) AS text_crc32
  FROM d, crc
), p AS (
  SELECT *, sum(size) OVER (ORDER BY g, doc_id ROWS UNBOUNDED PRECEDING) AS upto, sum(size) OVER () AS total,
         row_number() OVER (ORDER BY g, doc_id) AS nth
  FROM k
), s AS (
  SELECT *, CAST(least({SHARDS - 1}, ((2 * upto - size) * {SHARDS}) // (2 * total)) AS INTEGER) AS shard FROM p
)
SELECT doc_id, size, text_crc32, 'bytes' AS law, shard, CAST(nth - min(nth) OVER (PARTITION BY shard) AS BIGINT) AS slot,
       CAST(NULL AS INTEGER) AS grown_shard
FROM s
"""
