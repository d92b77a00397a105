"""Corpus planning, validation and inventories."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def validation_summary(pages: DataFrame, low_text: int = 40) -> DataFrame:
    """One row a source: books, pages, pages without text, pages of fewer than low_text characters, UTF-8 bytes."""
    text = F.coalesce("text", F.lit(""))
    return pages.groupBy("source").agg(
        F.countDistinct("book").alias("books"),
        F.count("*").alias("pages"),
        F.sum((F.trim(text) == "").cast("bigint")).alias("empty_pages"),
        F.sum((F.length(text) < low_text).cast("bigint")).alias("low_text_pages"),
        F.sum(F.octet_length(text)).cast("bigint").alias("utf8_bytes"),
    )


def block_shift(df: DataFrame, column: str, most: int = 50_000) -> int:
    """By how many bits a non-negative integer column is shifted so that it falls into at most `most` blocks, whatever its range."""
    top = df.agg(F.max(column)).first()[0] or 0
    return max(0, int(top // most).bit_length())


def dense_order(df: DataFrame, bucket: Column, *order: Column, name: str = "position") -> DataFrame:
    """df with its 0-based place in the order of (bucket, order), which must be total.

    The places within each bucket and the sums of the buckets before it are computed apart, so no task orders the whole
    table; bucket must be monotonic in the order and have a bounded number of values (say, up to 100,000).
    """
    bucketed = df.withColumn("_bucket", bucket)
    sizes = bucketed.groupBy("_bucket").agg(F.count("*").alias("_n"))
    before = sizes.select("_bucket", F.coalesce(F.sum("_n").over(Window.partitionBy(F.lit(0)).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    inside = F.row_number().over(Window.partitionBy("_bucket").orderBy(*order)) - 1
    return bucketed.withColumn("_inside", inside).join(before, "_bucket").withColumn(name, F.col("_before") + F.col("_inside")).drop("_bucket", "_inside", "_before")


def plan(documents: DataFrame, batch: int = 256) -> DataFrame:
    """(doc_id, content_sha256, batch): the first document of each content in order of doc_id, in batches.

    A null text has no content and takes no part.
    """
    digests = documents.where("text is not null").select("doc_id", F.sha2("text", 256).alias("content_sha256"))
    first = digests.groupBy("content_sha256").agg(F.min("doc_id").alias("doc_id"))
    placed = dense_order(first, F.shiftright("doc_id", block_shift(documents, "doc_id")), F.col("doc_id"))
    return placed.select("doc_id", "content_sha256", F.floor(F.col("position") / batch).cast("bigint").alias("batch"))


def inventory(collection: DataFrame, id_column: str, content: Column, prefix: int = 4) -> DataFrame:
    """One row: count, digest of the sorted ids, digest of the sorted (id, content digest) pairs.

    Digests are taken of the sorted ids of each prefix of their hashes, then of those digests of each prefix but its last two digits, and of the latter in
    order, so no task holds more than 1/16**prefix of the ids or 16**prefix / 256 digests. The prefix is part of the digest's definition: one for
    collections that are compared, larger for larger ones.
    """
    rows = collection.select(F.col(id_column).cast("string").alias("id"), F.sha2(content, 256).alias("content"))
    rows = rows.withColumn("part", F.substring(F.sha2("id", 256), 1, prefix))
    joined = lambda x: F.sha2(F.array_join(F.array_sort(F.collect_list(x)), "\n"), 256)
    parts = rows.groupBy("part").agg(F.count("*").alias("n"), joined(F.col("id")).alias("ids"), joined(F.concat_ws("\t", "id", "content")).alias("pairs"))
    ordered = lambda c: F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("part", c))), lambda x: x[c]), "\n"), 256)
    upper = F.substring("part", 1, max(1, prefix - 2))
    parts = parts.groupBy(upper.alias("upper")).agg(F.sum("n").alias("n"), ordered("ids").alias("ids"), ordered("pairs").alias("pairs")).withColumnRenamed("upper", "part")
    return parts.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("rows"), ordered("ids").alias("ids_sha256"), ordered("pairs").alias("content_sha256"))


def line_chunks(blocks: DataFrame, size: int = 5) -> DataFrame:
    """Lines of a page in chunks of `size`: page_id, chunk, first and last line, text."""
    chunk = F.floor(F.col("ordinal") / size).cast("bigint")
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ordinal", "line"))), lambda x: x["line"]), "\n")
    return blocks.groupBy("page_id", chunk.alias("chunk")).agg(F.min("ordinal").cast("bigint").alias("first_line"), F.max("ordinal").cast("bigint").alias("last_line"), text.alias("text"))


def page_windows(pages: DataFrame, size: int = 4) -> DataFrame:
    """Non-overlapping windows of `size` pages of a book; the last may be short."""
    ordinal = F.row_number().over(Window.partitionBy("book").orderBy("page_index", "page_id")) - 1
    placed = pages.withColumn("window", F.floor(ordinal / size).cast("bigint"))
    return placed.groupBy("book", "window").agg(F.min("page_index").cast("bigint").alias("first_index"), F.max("page_index").cast("bigint").alias("last_index"), F.count("*").alias("pages"))


def findings(owner_checks: list[tuple[str, DataFrame, DataFrame, str]]) -> DataFrame:
    """Referential audit: for each (code, child, owner, key) the child's keys without an owner, with their number of rows."""
    out = None
    for code, child, owner, key in owner_checks:
        lost = child.where(F.col(key).isNotNull()).join(owner.select(key).distinct(), key, "left_anti")
        found = lost.groupBy(F.col(key).cast("string").alias("object_id")).agg(F.count("*").alias("rows")).select(F.lit(code).alias("code"), "object_id", "rows")
        out = found if out is None else out.unionByName(found)
    return out


def collection_difference(left: DataFrame, right: DataFrame, key: str, value: str) -> DataFrame:
    """Keys that only one side has, or whose values differ: (key, status)."""
    a, b = left.select(key, F.col(value).alias("_a"), F.lit(True).alias("_l")), right.select(key, F.col(value).alias("_b"), F.lit(True).alias("_r"))
    status = F.when(F.col("_r").isNull(), "missing_right").when(F.col("_l").isNull(), "missing_left").when(~F.col("_a").eqNullSafe(F.col("_b")), "changed")
    return a.join(b, key, "full_outer").select(key, status.alias("status")).where("status is not null")
