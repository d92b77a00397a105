"""Queries over pages and books."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quirewise.llm.encoding import garbled, trained_on
from quirewise.llm.lookalike import lookalike_classes, lookalike_pairs
from quirewise.llm.repeated_lines import repeated_lines, without_lines
from quirewise.llm.scans import scan_noise, scan_paragraphs
from quirewise.llm.splitting import split_items
from quirewise.llm.sqlforms import look_sql
from quirewise.storage import table


def _native(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pdf").where("extraction_method = 'native_text'")
    return pages.select("page_id", "source", "book", F.col("printed_page_label").alias("label"), "text")


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of native pages repeated in their source."""
    return repeated_lines(_native(spark, sf_dir)).select("page_id", F.col("line_no").cast("bigint").alias("line_no"))


def p1_cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Native pages that lose lines, near-duplicates of repeated lines included: the size of their text before and after."""
    pages = _native(spark, sf_dir).distinct()
    cleaned = without_lines(pages, repeated_lines(_native(spark, sf_dir), similarity=0.8))
    return cleaned.where("clean_text <> text").groupBy("source").agg(
        F.count("*").alias("pages"), F.sum(F.length("text")).alias("chars_before"), F.sum(F.length("clean_text")).alias("chars_after")
    )


def p3_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages, equations = table(spark, sf_dir, "pdf"), table(spark, sf_dir, "equation_index")
    return pages.select(F.lit("pdf.text").alias("field"), F.col("page_id").alias("record_key"), "lang", "text").union(
        equations.select(F.lit("equation_index.raw_fragments"), "record_id", F.lit("equation"), F.array_join("raw_fragments", "\n"))
    )


def p3_repaired(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wrongly decoded records with their restored text."""
    records = p3_records(spark, sf_dir)
    return garbled(records, trained_on(records)).distinct()


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records with a wrongly decoded stretch."""
    return p3_repaired(spark, sf_dir).select("field", "record_key").distinct()


def p4_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages, equations = table(spark, sf_dir, "pdf"), table(spark, sf_dir, "equation_index")
    fragments = F.array_join(F.transform("raw_fragments", lambda x: F.coalesce(x, F.lit(""))), "\x1f")
    records = (
        pages.select(F.lit("pdf.text").alias("field"), F.col("page_id").alias("record_key"), "text")
        .union(equations.select(F.lit("equation_index.sanitized_native_text"), "record_id", "sanitized_native_text"))
        .union(equations.select(F.lit("equation_index.raw_fragments"), "record_id", fragments))
    )
    return records.where(r"text rlike '(?U)[^\\s\\x{1f}]'")


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages and equations that look the same but are written with other characters."""
    return lookalike_pairs(p4_records(spark, sf_dir))


def p4_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same as classes: one row a record, with its class and the number of its links."""
    return lookalike_classes(p4_records(spark, sf_dir)).select("field", "record_key", "representative", "size", "links")


def _scanned(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pdf").where("extraction_method = 'ocr'")
    return pages.select("page_id", "book", "page_index", F.col("printed_page_label").alias("label"), "text")


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Broken and misread words, running headers and page numbers of scanned pages."""
    return scan_noise(_scanned(spark, sf_dir), table(spark, sf_dir, "pdf"), table(spark, sf_dir, "ocr_results")).distinct()


def p5_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scanned pages as continuous paragraphs."""
    return scan_paragraphs(_scanned(spark, sf_dir), table(spark, sf_dir, "pdf"), table(spark, sf_dir, "ocr_results"))


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of every book longer than 24 pages, cut where a chapter or section starts."""
    pages = table(spark, sf_dir, "pdf").where("book is not null and page_index is not null")
    lengths = pages.groupBy(F.col("book").alias("item")).agg((F.max("page_index") + 1).alias("length"))
    starts = table(spark, sf_dir, "toc_entries").where("level in (1, 2) and page_index > 0").select(F.col("book").alias("item"), F.col("page_index").alias("at"))
    valid = starts.join(lengths, "item").where("at < length").select("item", "at")
    return split_items(lengths, valid).select(F.col("item").alias("book"), F.col("first").alias("first_page"), F.col("last").alias("last_page"))


QUERIES = {"p1_found": p1_found, "p1_cleaned": p1_cleaned, "p3_found": p3_found, "p3_repaired": p3_repaired, "p4_found": p4_found, "p4_classes": p4_classes, "p5_found": p5_found, "p5_paragraphs": p5_paragraphs, "p6_found": p6_found}

LOOKS = f"""values_ AS (
      SELECT 'pdf.text' AS field, page_id AS k, text FROM pdf
      UNION ALL SELECT 'equation_index.sanitized_native_text', record_id, sanitized_native_text FROM equation_index
      UNION ALL SELECT 'equation_index.raw_fragments', record_id, array_to_string(list_transform(raw_fragments, lambda x: coalesce(x, '')), chr(31)) FROM equation_index),
    looks AS (SELECT DISTINCT field, k, text, {look_sql("text")} AS look FROM values_ WHERE k IS NOT NULL AND regexp_matches(text, '[^\\s\\x1f\\p{{Z}}]'))"""

SQL = {
    "p1_found": r"""
    WITH pages AS (
      SELECT DISTINCT page_id, coalesce(source, '') AS source, coalesce(book, '') AS book, lower(trim(printed_page_label)) AS label, lower(text) AS text
      FROM pdf WHERE extraction_method = 'native_text' AND page_id IS NOT NULL),
    lines AS (
      SELECT page_id, source, book, label, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line_no FROM pages),
    keys AS (
      SELECT page_id, source, book, line_no::BIGINT AS line_no, replace(nfc_normalize(regexp_replace(CASE WHEN label = '' OR label IS NULL OR NOT contains(line, label) THEN line
        ELSE regexp_replace(regexp_replace(line, '(^|[^\p{L}\p{N}_])' || regexp_escape(label) || '($|[^\p{L}\p{N}_])', '\1 \2', 'g'),
          '(^|[^\p{L}\p{N}_])' || regexp_escape(label) || '($|[^\p{L}\p{N}_])', '\1 \2', 'g') END, '[^\p{L}\p{M}]+', '', 'g')), 'ß', 'ss') AS key FROM lines),
    need AS (SELECT source, greatest(6, ceil(count(DISTINCT page_id) * 0.03 - 1e-9)) AS need FROM pages GROUP BY 1),
    often AS (
      SELECT k.source, key FROM keys k JOIN need n USING (source) WHERE key <> '' GROUP BY k.source, key
      HAVING count(DISTINCT page_id) >= any_value(need) AND count(DISTINCT book) >= 2)
    SELECT DISTINCT page_id, line_no FROM keys JOIN often USING (source, key)""",
    "p6_found": """
    WITH RECURSIVE n AS (SELECT book, max(page_index)::BIGINT + 1 AS length FROM pdf GROUP BY book),
    b AS (SELECT DISTINCT t.book, t.page_index::BIGINT AS cut FROM toc_entries t JOIN n USING (book)
      WHERE level IN (1, 2) AND page_index > 0 AND page_index < length),
    ends AS (
      SELECT book, length, f AS first_page, CASE WHEN length - f < 24 THEN length ELSE coalesce(
        (SELECT max(b.cut) FROM b WHERE b.book = s.book AND b.cut BETWEEN f + 7 AND f + 23), f + 23) END AS last_page
      FROM (SELECT book, length, unnest(range(1, length + 1)) AS f FROM n WHERE length > 24) s),
    walk AS (
      SELECT * FROM ends WHERE first_page = 1
      UNION ALL SELECT e.* FROM walk w JOIN ends e ON e.book = w.book AND e.first_page = w.last_page - 1 WHERE w.last_page < w.length)
    SELECT book, first_page, last_page FROM walk""",
    "p4_found": f"""
    WITH {LOOKS} SELECT DISTINCT a.field, a.k AS left_key, b.k AS right_key FROM looks a JOIN looks b ON a.field = b.field AND a.look = b.look AND a.text <> b.text AND a.k < b.k""",
    "p4_classes": f"""
    WITH {LOOKS}, c AS (SELECT field, look, count(*) AS size, min(k) AS representative FROM looks GROUP BY 1, 2 HAVING count(DISTINCT text) > 1),
    f AS (SELECT field, look, text, count(*) AS same FROM looks GROUP BY 1, 2, 3)
    SELECT field, k AS record_key, representative, size, size - same AS links FROM looks JOIN c USING (field, look) JOIN f USING (field, look, text)""",
}
