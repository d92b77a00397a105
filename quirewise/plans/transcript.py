"""Transcript and article queries: documents as lines, scanned lines as blocks of pages with boxes."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from quirewise.functions.text import FIGURE_CAPTION, KNOWN_SECTIONS, PUBLISHER_SIGNALS, front_kind, publisher_kind
from quirewise.operators import transcript as T
from quirewise.plans.evidence import _clean
from quirewise.sources import views as V
from quirewise.storage import table


def _lines(spark, d):
    once = V.once(table(spark, d, "documents").select("doc_id", "text"), "doc_id")
    return once.select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("ordinal", "line"))


def _titles(spark, d):
    return table(spark, d, "documents").select("doc_id", "title")


def headings(spark, d):
    return T.headings(_lines(spark, d))


def section_parents(spark, d):
    return T.section_parents(T.headings(_lines(spark, d)))


def bibliography_entries(spark, d):
    return T.bibliography(_lines(spark, d))


def front_matter(spark, d):
    return T.front_matter(_lines(spark, d), _titles(spark, d))


def article_nodes(spark, d):
    return T.article_nodes(_lines(spark, d), _titles(spark, d))


def front_lines(spark, d):
    """Page lines that begin an abstract or keywords, or name the author."""
    return V.blocks(spark, d).where("line is not null").select("page_id", F.col("ordinal").cast("bigint").alias("ordinal"), front_kind(F.col("line")).alias("kind")).where("kind is not null")


def publisher_matter(spark, d):
    """Page lines that are publisher matter."""
    x = V.blocks(spark, d).withColumn("p", publisher_kind(F.col("line"), F.col("page_index") == 0, F.lit(False))).where("p is not null")
    return x.select("page_id", F.col("ordinal").cast("bigint").alias("ordinal"), "p.kind", "p.signal")


def _blocks(spark, d):
    """Scanned lines as blocks; a page is 1,400 pixels wide and ends 90 below its last line, a line that begins as a figure's caption is protected."""
    pages = V.pages(spark, d).where("page_index is not null").select("page_id", F.col("book").alias("document"), "page_index", F.col("printed_page_label").alias("label"))
    pages = V.once(pages, "page_id")
    lines = V.ocr_lines(spark, d).groupBy("page_id", F.col("order").alias("ordinal")).agg(F.min(F.struct("text", "box")).alias("x")).select("page_id", "ordinal", "x.text", "x.box").where("text is not null")
    height = F.max("box.y1").over(Window.partitionBy("page_id")) + 90.0
    return lines.join(pages, "page_id").select("*", F.lit(1400.0).alias("width"), height.alias("height"), F.col("text").rlike(FIGURE_CAPTION).alias("protected"))


def page_number_classes(spark, d):
    return T.page_number_classes(_blocks(spark, d)).select("page_id", F.col("ordinal").cast("bigint").alias("ordinal"), "value", "outcome", "method")


def clean_transcript_blocks(spark, d):
    return T.clean_blocks(_blocks(spark, d)).select("page_id", F.col("ordinal").cast("bigint").alias("ordinal"), "reason", "clean", "place")


def clean_transcript_pages(spark, d):
    blocks = _blocks(spark, d)
    pages = V.once(V.pages(spark, d).where("extraction_method = 'ocr' and page_index is not null").select("page_id", "page_index", F.col("printed_page_label").alias("label")), "page_id")
    return T.clean_pages(pages, T.clean_blocks(blocks)).select("page_id", "kept", "excluded", F.sha2("text", 256).alias("text_sha256"))


QUERIES = {f.__name__: f for f in (headings, section_parents, bibliography_entries, front_matter, article_nodes, front_lines, publisher_matter, page_number_classes, clean_transcript_blocks, clean_transcript_pages)}


def _folded(x: str) -> str:
    return f"replace(lower({_clean(x)}), 'ß', 'ss')"


_APP = r"(?i)^appendix(?: ([A-Za-z0-9]+))?(?: ?[:.\-]? ?(.*))?$"
_NUM = r"^([0-9]+(?:\.[0-9]+)*)[.)]? (\S.*)$"
_KNOWN = ", ".join(f"'{x}'" for x in KNOWN_SECTIONS)
HEADS = f"""docs AS (SELECT doc_id, min(text) AS text FROM documents WHERE doc_id IS NOT NULL GROUP BY doc_id),
      lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1)::BIGINT - 1 AS ordinal FROM docs),
      l0 AS (SELECT *, {_clean("line")} AS clean, {_folded("line")} AS f FROM lines),
      l1 AS (SELECT *, CASE WHEN clean = '' OR length(clean) > 512 THEN NULL WHEN regexp_matches(clean, '{_APP}') THEN 'appendix' WHEN f IN ('bibliography', 'literature cited', 'references') THEN 'bibliography'
        WHEN regexp_matches(clean, '{_NUM}') THEN 'numbered' WHEN f IN ({_KNOWN}) THEN 'known' END AS k, regexp_extract(clean, '{_NUM}', 1) AS num,
        regexp_matches(trim(line, ' '), '(?i)^(?:by|authors?)\\s*[:\\-]?\\s*(\\S.*)$') AS author, CASE WHEN f = 'abstract' OR starts_with(f, 'abstract:') THEN 'abstract' WHEN starts_with(f, 'keywords:') OR starts_with(f, 'keyword:') THEN 'keywords' END AS front FROM l0),
      heads AS (SELECT doc_id, ordinal, CASE k WHEN 'numbered' THEN CASE WHEN contains(num, '.') THEN 'subsection' ELSE 'section' END WHEN 'known' THEN 'section' ELSE k END AS kind,
        CASE WHEN k = 'numbered' THEN length(num) - length(replace(num, '.', '')) + 1 ELSE 1 END AS level, CASE k WHEN 'numbered' THEN num WHEN 'appendix' THEN nullif(regexp_extract(clean, '{_APP}', 1), '') END AS label,
        CASE k WHEN 'numbered' THEN regexp_extract(clean, '{_NUM}', 2) WHEN 'appendix' THEN coalesce(nullif(trim(regexp_extract(clean, '{_APP}', 2), ' '), ''), clean) ELSE clean END AS title,
        CASE k WHEN 'appendix' THEN 'explicit_appendix_heading' WHEN 'bibliography' THEN 'explicit_bibliography_heading' WHEN 'numbered' THEN 'numbered_heading' ELSE 'known_article_heading' END AS evidence,
        CASE k WHEN 'appendix' THEN 0.95::DOUBLE WHEN 'bibliography' THEN 0.98::DOUBLE WHEN 'numbered' THEN 0.9::DOUBLE ELSE 0.75::DOUBLE END AS confidence FROM l1 WHERE k IS NOT NULL)"""
PARENTS = """(SELECT max(p.ordinal) FROM heads_ p WHERE p.doc_id = h.doc_id AND p.ordinal < h.ordinal AND p.level < h.level)"""
BIB = HEADS + """, bib AS (SELECT doc_id, ordinal, clean AS entry, CASE WHEN regexp_matches(line, '^\\s*(?:\\[[0-9]+\\]|[0-9]+[.)]\\s+|[A-Z][^\\n]{0,100}\\([0-9]{4}[a-z]?\\))') THEN 0.9::DOUBLE ELSE 0.65::DOUBLE END AS confidence FROM
      (SELECT *, last_value(CASE WHEN k IN ('bibliography', 'appendix') THEN k END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY ordinal ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS region FROM l1)
      WHERE region = 'bibliography' AND k IS DISTINCT FROM 'appendix' AND clean <> '')"""
FRONT = BIB + f""", said AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY ordinal) AS n FROM l1 WHERE f <> ''),
      want AS (SELECT doc_id, min(nullif({_folded("title")}, '')) AS wanted FROM documents GROUP BY doc_id),
      t0 AS (SELECT said.*, wanted FROM said LEFT JOIN want USING (doc_id)),
      t1 AS (SELECT *, min(CASE WHEN f = wanted THEN n END) OVER (PARTITION BY doc_id) AS equal, max(CASE WHEN n = 1 AND front IS NULL AND k IS NULL AND NOT author THEN 1 END) OVER (PARTITION BY doc_id) AS plain FROM t0),
      t2 AS (SELECT *, coalesce(equal, plain) AS title_at, coalesce(n <> coalesce(equal, plain), true) AS free FROM t1),
      t3 AS (SELECT *, max(CASE WHEN free AND NOT author AND (front IS NOT NULL OR k IS NOT NULL) THEN 1 END) OVER (PARTITION BY doc_id ORDER BY ordinal ROWS UNBOUNDED PRECEDING) AS stop FROM t2),
      t4 AS (SELECT *, min(CASE WHEN free AND author AND stop IS NULL AND n <= 16 THEN n END) OVER (PARTITION BY doc_id) AS author_at FROM t3),
      t5 AS (SELECT *, free AND coalesce(n <> author_at, true) AS open FROM t4),
      t6 AS (SELECT *, min(CASE WHEN open AND front = 'abstract' THEN n END) OVER (PARTITION BY doc_id) AS abstract_at, min(CASE WHEN open AND front = 'keywords' THEN n END) OVER (PARTITION BY doc_id) AS keywords_at FROM t5),
      t7 AS (SELECT *, max(CASE WHEN n = abstract_at AND f = 'abstract' THEN 1 END) OVER (PARTITION BY doc_id) AS bare,
        max(CASE WHEN n > abstract_at AND open AND (front = 'keywords' OR k IS NOT NULL) THEN 1 END) OVER w AS ends, sum(CASE WHEN n > abstract_at AND open THEN 1 ELSE 0 END) OVER w AS rank FROM t6 WINDOW w AS (PARTITION BY doc_id ORDER BY ordinal ROWS UNBOUNDED PRECEDING)),
      t8 AS (SELECT *, coalesce(n = abstract_at OR (n > abstract_at AND open AND bare = 1 AND ends IS NULL AND rank < 16), false) AS in_abstract FROM t7),
      front AS (SELECT doc_id, 'title' AS kind, ordinal, 1 AS lines, clean AS title, CASE WHEN equal IS NOT NULL THEN 'metadata_and_exact_text' ELSE 'first_page_top_text_fallback' END AS evidence, CASE WHEN equal IS NOT NULL THEN 0.98::DOUBLE ELSE 0.45::DOUBLE END AS confidence FROM t8 WHERE n = title_at
        UNION ALL SELECT doc_id, 'author', ordinal, 1, regexp_extract(trim(line, ' '), '(?i)^(?:by|authors?)\\s*[:\\-]?\\s*(\\S.*)$', 1), 'explicit_author_prefix', 0.95::DOUBLE FROM t8 WHERE n = author_at
        UNION ALL SELECT doc_id, 'keywords', ordinal, 1, trim(regexp_replace(trim(line, ' '), '^[^:]*:', ''), ' '), 'explicit_keywords_prefix', 0.98::DOUBLE FROM t8 WHERE n = keywords_at AND NOT in_abstract
        UNION ALL SELECT doc_id, 'abstract', min(ordinal), count(*), 'Abstract', 'explicit_abstract_heading', 0.95::DOUBLE FROM t8 WHERE in_abstract GROUP BY doc_id)"""
_SIGNALS = " ".join(f"WHEN contains(f, '{x.replace(chr(39), chr(39) * 2)}') THEN '{kind}|{x.replace(chr(39), chr(39) * 2)}'" for kind, signals in PUBLISHER_SIGNALS for x in signals)
PUBLISHER = f"CASE {_SIGNALS} WHEN page_index = 0 AND (contains(f, 'issn') OR (contains(f, 'volume') AND contains(f, 'issue'))) THEN 'masthead|masthead-identifiers' WHEN page_index = 0 AND contains(f, 'cover image') THEN 'cover|cover image' WHEN page_index = 0 AND contains(f, 'front cover') THEN 'cover|front cover' END"
_ROMAN = "list_transform(string_split(value, ''), lambda c: CASE c WHEN 'i' THEN 1 WHEN 'v' THEN 5 WHEN 'x' THEN 10 WHEN 'l' THEN 50 WHEN 'c' THEN 100 WHEN 'd' THEN 500 WHEN 'm' THEN 1000 END)"
CLEANED = f"""WITH {V.SQL_PAGES}, {V.SQL_LINES}, pg AS (SELECT page_id, min(book) AS document, min(page_index) AS page_index, min(printed_page_label) AS label FROM pages WHERE page_index IS NOT NULL GROUP BY page_id),
      b AS (SELECT l.*, pg.*  EXCLUDE (page_id), regexp_matches(text, '(?i)^\\s*(Figure\\b|Fig\\.)') AS protected, max(box.y1) OVER (PARTITION BY l.page_id) + 90 AS height, {_clean("text")} AS clean, {_folded("text")} AS f, {_folded("label")} AS lab
        FROM (SELECT page_id, "order"::BIGINT AS ordinal, text, box FROM lines WHERE text IS NOT NULL) l JOIN pg USING (page_id)),
      m AS (SELECT *, box.y1 <= height * 0.12 OR box.y0 >= height * (1 - 0.12) AS margin, regexp_replace(lower(clean), '[0-9]+', '#', 'g') AS key FROM b),
      c0 AS (SELECT *, f AS value FROM m WHERE regexp_matches(f, '^(?:[0-9]+|[ivxlcdm]+)$')),
      c1 AS (SELECT *, CASE WHEN regexp_matches(value, '^[0-9]{{1,9}}$') THEN TRY_CAST(value AS BIGINT) WHEN regexp_matches(value, '^[ivxlcdm]+$') THEN list_sum(list_transform(list_zip({_ROMAN}, {_ROMAN}[2:]), lambda p: CASE WHEN p[1] < coalesce(p[2], 0) THEN -p[1] ELSE p[1] END))::BIGINT END AS number,
        CASE WHEN box.y1 <= height / 2 THEN 'top' ELSE 'bottom' END AS side, round_even((box.x0 + box.x1) / 2 / 1400 / 0.04, 0)::BIGINT AS place_, coalesce(value = lab, false) AS own FROM c0),
      c2 AS (SELECT *, sum(own::INT) OVER (PARTITION BY page_id, value) AS matches, coalesce(page_index = lag(page_index) OVER s + 1 AND number = lag(number) OVER s + 1, false) AS goes_on FROM c1 WINDOW s AS (PARTITION BY document, margin, side, place_ ORDER BY page_index, ordinal)),
      c3 AS (SELECT *, sum((NOT goes_on)::INT) OVER (PARTITION BY document, margin, side, place_ ORDER BY page_index, ordinal ROWS UNBOUNDED PRECEDING) AS run FROM c2),
      c4 AS (SELECT *, count(*) OVER (PARTITION BY document, margin, side, place_, run) AS length FROM c3),
      classes AS (SELECT page_id, ordinal, value, CASE WHEN protected THEN 'typed_content' WHEN NOT margin THEN 'outside_margin' WHEN own AND matches = 1 THEN 'printed_page_label' WHEN length >= 3 THEN 'recurring_geometry_sequence' ELSE 'insufficient_evidence' END AS method FROM c4),
      keys AS (SELECT document, key FROM m JOIN (SELECT document, greatest(3, ceil(count(DISTINCT page_id) * 0.2)) AS need FROM m GROUP BY document) USING (document) WHERE margin AND key <> '' AND NOT regexp_matches(f, '^(?:[0-9]+|[ivxlcdm]+)$') GROUP BY document, key HAVING count(DISTINCT page_id) >= any_value(need)),
      r AS (SELECT m.*, CASE WHEN EXISTS (SELECT 1 FROM classes c WHERE c.page_id = m.page_id AND c.ordinal = m.ordinal AND method IN ('printed_page_label', 'recurring_geometry_sequence')) THEN 'page_number' WHEN {PUBLISHER} IS NOT NULL THEN 'publisher_front_matter'
        WHEN margin AND (document, key) IN (SELECT (document, key) FROM keys) THEN 'repeated_margin' WHEN clean = '' THEN 'empty_after_sanitization' END AS reason FROM m)"""

SQL = {
    "headings": f"WITH {HEADS} SELECT * FROM heads",
    "section_parents": f"WITH {HEADS}, heads_ AS (SELECT * FROM heads) SELECT doc_id, ordinal, level, {PARENTS} AS parent_ordinal FROM heads h",
    "bibliography_entries": f"WITH {BIB} SELECT * FROM bib",
    "front_matter": f"WITH {FRONT} SELECT * FROM front",
    "article_nodes": f"""WITH {FRONT}, heads_ AS (SELECT * FROM heads WHERE (doc_id, ordinal) NOT IN (SELECT (doc_id, ordinal) FROM front) AND (doc_id, ordinal) NOT IN (SELECT (doc_id, ordinal) FROM bib))
      SELECT DISTINCT doc_id, 'document' AS kind, -1 AS ordinal, NULL::BIGINT AS level, NULL::BIGINT AS parent_ordinal, 1.0::DOUBLE AS confidence FROM l0 WHERE clean <> ''
      UNION ALL SELECT doc_id, 'front_matter', -2, NULL, -1, min(confidence) FROM front GROUP BY doc_id
      UNION ALL SELECT doc_id, kind, ordinal, NULL, -2, confidence FROM front
      UNION ALL SELECT doc_id, kind, ordinal, level, coalesce({PARENTS}, -1), confidence FROM heads_ h
      UNION ALL SELECT doc_id, 'bibliography_entry', ordinal, NULL, (SELECT max(p.ordinal) FROM heads_ p WHERE p.doc_id = b.doc_id AND p.kind = 'bibliography' AND p.ordinal < b.ordinal), confidence FROM bib b
        WHERE (doc_id, ordinal) NOT IN (SELECT (doc_id, ordinal) FROM front)""",
    "front_lines": f"""WITH {V.SQL_BLOCKS}, x AS (SELECT page_id, ordinal::BIGINT AS ordinal, {_folded("line")} AS f FROM blocks WHERE line IS NOT NULL)
      SELECT page_id, ordinal, CASE WHEN f = 'abstract' OR starts_with(f, 'abstract:') THEN 'abstract' ELSE 'keywords' END AS kind FROM x WHERE f = 'abstract' OR starts_with(f, 'abstract:') OR starts_with(f, 'keywords:') OR starts_with(f, 'keyword:')""",
    "publisher_matter": f"""WITH {V.SQL_BLOCKS}, x AS (SELECT page_id, ordinal::BIGINT AS ordinal, page_index, {_folded("line")} AS f FROM blocks), y AS (SELECT *, {PUBLISHER} AS p FROM x)
      SELECT page_id, ordinal, split_part(p, '|', 1) AS kind, split_part(p, '|', 2) AS signal FROM y WHERE p IS NOT NULL""",
    "page_number_classes": f"""{CLEANED} SELECT page_id, ordinal, value, CASE WHEN method IN ('typed_content', 'outside_margin') THEN 'not_page_number' WHEN method = 'insufficient_evidence' THEN 'unresolved' ELSE 'page_number' END AS outcome, method FROM classes""",
    "clean_transcript_blocks": f"""{CLEANED} SELECT page_id, ordinal, reason, CASE WHEN reason IS NULL THEN clean END AS clean,
      CASE WHEN reason IS NULL THEN sum((reason IS NULL)::INT) OVER (PARTITION BY document ORDER BY page_index, page_id, ordinal ROWS UNBOUNDED PRECEDING) - 1 END AS place FROM r""",
    "clean_transcript_pages": f"""{CLEANED}, g AS (SELECT page_id, count(*) FILTER (WHERE reason IS NULL) AS kept, count(reason) AS excluded, string_agg(chr(10) || chr(10) || clean, '' ORDER BY ordinal) FILTER (WHERE reason IS NULL) AS body FROM r GROUP BY page_id),
      p AS (SELECT page_id, min(page_index) AS page_index, min(printed_page_label) AS label FROM pages WHERE extraction_method = 'ocr' AND page_index IS NOT NULL GROUP BY page_id)
      SELECT page_id, coalesce(kept, 0) AS kept, coalesce(excluded, 0) AS excluded, sha256('[[PAGE physical=' || (page_index + 1) || ' printed="' || replace(coalesce(label, 'none'), '"', chr(39)) || '"]]' || coalesce(body, '')) AS text_sha256 FROM p LEFT JOIN g USING (page_id)""",
}
