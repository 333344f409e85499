"""Extendible hashing: shards of bounded size, named by a prefix of the hash.

The directory starts with one bucket. A bucket whose rows take more bytes than
the limit splits on the next bit of the hash; the others stay as they are. As
the bytes of a prefix never grow with its length, a row's shard is its shortest
prefix within the limit. The directory is found from sums per prefix, a few
bits beyond the expected depth at a time; rows whose bucket is still too large
go on with more bits. Only names and sizes are shuffled, never texts.
"""

from __future__ import annotations

from functools import reduce
from math import ceil, log2

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.shared import stored

HASH_BITS = 48
SPARE_BITS = 3
MORE_BITS = 8


def hash_bits(key: Column) -> Column:
    digits = F.substring(F.md5(key.cast("binary")), 1, HASH_BITS // 4)
    return F.conv(digits, 16, 10).cast("long")


def prefix(hashed: Column, bits: int | Column) -> Column:
    return F.call_function("shiftright", hashed, (F.lit(HASH_BITS) - bits).cast("int"))


def sized_rows(docs: DataFrame) -> DataFrame:
    """``doc_id, hash, n_bytes``; a null id is hashed by its text, a null text has no bytes."""
    text = F.coalesce("text", F.lit(""))
    key = F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("text:"), text))
    size = F.octet_length(text).cast("long")
    return docs.select("doc_id", hash_bits(key).alias("hash"), size.alias("n_bytes"))


def assign(docs: DataFrame, limit: int) -> DataFrame:
    """Per document: ``doc_id, n_bytes, local_depth, shard, page``.

    ``shard`` holds the bits of the prefix ('' if one shard holds everything). Rows
    that no bit can part, repeated ids, share all 48 bits; where they exceed
    the limit they go to pages of that bucket, each within the limit. A single
    text above the limit has a page, or a bucket, to itself. No rows give none.
    """
    rows = stored(sized_rows(docs), "sized")
    total = rows.agg(F.sum("n_bytes")).first()[0] or 0
    below, depth = -1, min(HASH_BITS, max(0, ceil(log2(max(total / limit, 1)))) + SPARE_BITS)
    shards = []
    while True:
        leaf = prefix(F.col("hash"), depth).alias("leaf")
        rows = rows.select("doc_id", "hash", "n_bytes", leaf)
        leaves = stored(rows.groupBy("leaf").agg(F.sum("n_bytes").alias("bytes")), "leaves")
        nodes = leaves.select(
            "leaf", "bytes", F.explode(F.sequence(F.lit(below + 1), F.lit(depth))).alias("d")
        ).withColumn("node", F.call_function("shiftright", "leaf", F.lit(depth) - F.col("d")))
        sums = nodes.groupBy("d", "node").agg(F.sum("bytes").alias("sum"))
        fitting = sums.where(F.col("sum") <= limit)
        depths = stored(
            nodes.join(fitting.select("d", "node"), ["d", "node"])
            .groupBy("leaf")
            .agg(F.min("d").alias("local_depth")),
            "directory",
        )
        shards.append(
            rows.join(depths, "leaf").select(
                "doc_id", "n_bytes", "local_depth", "hash", F.lit(0).alias("page")
            )
        )
        if leaves.join(depths, "leaf", "left_anti").isEmpty():
            break
        rows = stored(rows.join(depths, "leaf", "left_anti").drop("leaf"), "too-large")
        if depth == HASH_BITS:
            shards.append(_pages(rows, limit))
            break
        below, depth = depth, min(HASH_BITS, depth + MORE_BITS)
    bits = F.lpad(
        F.bin(prefix(F.col("hash"), F.col("local_depth"))), F.col("local_depth"), F.lit("0")
    )
    return reduce(DataFrame.union, shards).select(
        "doc_id", "n_bytes", "local_depth", bits.alias("shard"), "page"
    )


def _pages(rows: DataFrame, limit: int) -> DataFrame:
    """Rows of buckets that no bit parts, filled into pages.

    Such a bucket may hold a third of all rows. `rows` is a written table, so what a
    task reads of it does not change: a bucket's rows are numbered task by task, and
    each task's part begins where the sums of those before it end.
    """
    rows = rows.withColumn("task", F.spark_partition_id())
    part, bucket = Window.partitionBy("hash", "task"), Window.partitionBy("hash")
    sums = rows.groupBy("hash", "task").agg(
        F.sum("n_bytes").alias("bytes"), F.count("*").alias("rows"), F.max("n_bytes").alias("most")
    )
    earlier = bucket.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(
        "hash", "task",
        F.coalesce(F.sum("bytes").over(earlier), F.lit(0)).alias("bytes_before"),
        F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("rows_before"),
        (F.lit(limit) - F.max("most").over(bucket)).alias("room"),
    )
    order = part.orderBy("n_bytes", "doc_id")
    own = F.coalesce(F.sum("n_bytes").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    numbered = rows.withColumns({"own": own, "number": F.row_number().over(order)})
    before = F.col("bytes_before") + F.col("own")
    page = F.when(
        F.col("room") * 2 >= limit, F.floor(before / F.greatest("room", F.lit(1)))
    ).otherwise(F.col("rows_before") + F.col("number") - 1)
    return numbered.join(offsets, ["hash", "task"]).select(
        "doc_id", "n_bytes", F.lit(HASH_BITS).alias("local_depth"), "hash",
        page.cast("int").alias("page"),
    )


def write_shards(docs: DataFrame, limit: int, path: str) -> None:
    """Write the documents in a folder per shard and page.

    Joined by ``doc_id``, which has to be unique and not null here.
    """
    places = assign(docs, limit).select("doc_id", "shard", "page")
    docs.join(places, "doc_id").repartition("shard", "page").write.partitionBy(
        "shard", "page"
    ).mode("overwrite").parquet(path)
