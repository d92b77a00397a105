"""Evidence views over the tables: pages, text blocks, scanned lines and tokens; repeated rows count once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quirewise.storage import table


def once(df: DataFrame, key: str) -> DataFrame:
    """One row a key: of repeated rows that differ, the least in the order of the columns. Null keys are left out."""
    others = [c for c in df.columns if c != key]
    least = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(F.struct(*others)).alias("_row"))
    return least.select(key, *[F.col(f"_row.`{c}`").alias(c) for c in others])


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pdf").select("page_id", "book", "source", "lang", "page_index", "printed_page_label", "extraction_method", "text").distinct()


def blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of pages that have text: page_id, book, page_index, ordinal, line."""
    return pages(spark, sf_dir).select("page_id", "book", "page_index", F.posexplode(F.split("text", "\n", -1)).alias("ordinal", "line"))


def _ocr(spark: SparkSession, sf_dir: str, items: str, *columns: str) -> DataFrame:
    results = once(table(spark, sf_dir, "ocr_results").select("selection_result_id", "page_id", items), "selection_result_id")
    return results.select("selection_result_id", "page_id", F.explode(items).alias("x")).select("selection_result_id", "page_id", *[f"x.{c}" for c in columns], F.col("x.pixel_bounding_box").alias("box"))


def ocr_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ocr(spark, sf_dir, "lines", "order", "text", "confidence")


def ocr_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ocr(spark, sf_dir, "tokens", "order", "line_order", "text", "confidence")


#: The same views for DuckDB, to begin a WITH clause.
SQL_PAGES = "pages AS (SELECT DISTINCT page_id, book, source, lang, page_index, printed_page_label, extraction_method, text FROM pdf)"
SQL_BLOCKS = SQL_PAGES + """, blocks AS (SELECT page_id, book, page_index, unnest(string_split(text, chr(10))) AS line,
    generate_subscripts(string_split(text, chr(10)), 1) - 1 AS ordinal FROM pages)"""
SQL_OCR = "ocr AS (SELECT DISTINCT ON (selection_result_id) * FROM ocr_results)"
SQL_LINES = SQL_OCR + """, lines AS (SELECT selection_result_id, page_id, x."order" AS "order", x.text AS text, x.confidence AS confidence, x.pixel_bounding_box AS box
    FROM (SELECT selection_result_id, page_id, unnest(lines) AS x FROM ocr))"""
SQL_TOKENS = SQL_OCR + """, tokens AS (SELECT selection_result_id, page_id, x."order" AS "order", x.line_order AS line_order, x.text AS text, x.confidence AS confidence, x.pixel_bounding_box AS box
    FROM (SELECT selection_result_id, page_id, unnest(tokens) AS x FROM ocr))"""
