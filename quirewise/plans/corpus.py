"""Corpus queries: validation, planning, identities, inventories, audits."""

from __future__ import annotations

from pyspark.sql import functions as F

from quirewise.functions.identity import stable_id
from quirewise.functions.text import contains_phrase, path_valid
from quirewise.operators import corpus as C
from quirewise.sources import views as V
from quirewise.storage import table


def corpus_validation_summary(spark, d):
    return C.validation_summary(V.pages(spark, d))


def corpus_plan_dedup(spark, d):
    return C.plan(table(spark, d, "documents"))


def low_text_pages(spark, d):
    return V.pages(spark, d).where(F.length(F.coalesce("text", F.lit(""))) < 40).select("page_id", F.length(F.coalesce("text", F.lit(""))).cast("bigint").alias("chars"))


def stable_ids(spark, d):
    return table(spark, d, "documents").select("doc_id", stable_id("document", F.col("doc_id"), F.col("kind"), F.sha2("text", 256)).alias("stable_id"))


def page_quality(spark, d):
    return V.pages(spark, d).select("page_id", F.round(F.least(F.lit(1.0), F.length(F.coalesce("text", F.lit(""))) / 1000.0), 6).alias("quality"))


def block_text_compose(spark, d):
    kept = F.filter(F.transform(F.split("text", "\n", -1), lambda x: F.rtrim(x)), lambda x: x != "")
    return V.pages(spark, d).where("text is not null").select("page_id", F.array_join(kept, "\n").alias("composed"))


def book_text_export(spark, d):
    """The digest of a book's text export: of the digests of its pages' parts in order, so no task holds a book's text."""
    pages = V.pages(spark, d).where("text is not null")
    part = F.sha2(F.concat(F.lit("[page "), F.col("page_index").cast("string"), F.lit("]\n"), F.col("text")), 256)
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("page_index", "page_id", part.alias("part")))), lambda x: x["part"]), "\n")
    return pages.groupBy("book").agg(F.sha2(joined, 256).alias("text_sha256"), F.count("*").alias("pages"))


def collection_inventory(spark, d):
    return C.inventory(table(spark, d, "documents"), "doc_id", F.coalesce("text", F.lit("")))


def inventory_measures(spark, d):
    pages = V.pages(spark, d)
    text = F.coalesce("text", F.lit(""))
    return pages.groupBy("book").agg(
        F.count("*").alias("pages"), F.sum((text != "").cast("bigint")).alias("pages_with_text"), F.sum(F.length(text)).cast("bigint").alias("chars"),
        F.sum(F.octet_length(text)).cast("bigint").alias("utf8_bytes"), F.sum(F.when(F.col("printed_page_label").isNotNull(), 1).otherwise(0)).cast("bigint").alias("labelled"),
    )


def provenance_findings(spark, d):
    t = lambda n: table(spark, d, n)
    books = t("pdf").select("book").distinct()
    return C.findings(
        [
            ("toc.unknown_book", t("toc_entries").distinct(), books, "book"),
            ("chunk.unknown_book", t("chunks").select("sequence", "book").distinct(), books, "book"),
            ("equation.unknown_book", V.once(t("equation_index"), "record_id"), books, "book"),
            ("ocr.unknown_page", V.once(t("ocr_results"), "selection_result_id"), t("pdf").select("page_id"), "page_id"),
            ("label.unknown_document", t("toxicity_labels").distinct(), t("documents"), "doc_id"),
            ("order.unknown_customer", t("orders").withColumnRenamed("o_custkey", "key"), t("customer").withColumnRenamed("c_custkey", "key"), "key"),
        ]
    )


def _audit(code, child, owner, key, owner_key=None):
    return f"""SELECT '{code}' AS code, CAST({key} AS VARCHAR) AS object_id, count(*) AS rows FROM {child}
      WHERE {key} IS NOT NULL AND {key} NOT IN (SELECT {owner_key or key} FROM {owner} WHERE {owner_key or key} IS NOT NULL) GROUP BY {key}"""


def page_windows(spark, d):
    return C.page_windows(V.pages(spark, d))


def code_line_chunks(spark, d):
    return C.line_chunks(V.blocks(spark, d))


def books_difference(spark, d):
    books = table(spark, d, "books").groupBy("name").agg(F.max("pages").alias("pages"))
    seen = table(spark, d, "pdf").groupBy(F.col("book").alias("name")).agg((F.max("page_index") + 1).cast("bigint").alias("pages"))
    return C.collection_difference(books, seen, "name", "pages")


def page_coverage(spark, d):
    """Pages of a book that some chunk covers, as a share; a book without pages has none to cover and counts as 1."""
    chunks = table(spark, d, "chunks").where("first_page <= last_page").select("book", "first_page", "last_page").distinct()
    covered = chunks.select("book", F.explode(F.sequence("first_page", "last_page")).alias("page")).distinct().withColumn("covered", F.lit(1))
    pages = V.pages(spark, d).select("book", (F.col("page_index") + 1).cast("bigint").alias("page")).distinct()
    return pages.join(covered, ["book", "page"], "left").groupBy("book").agg(F.count("*").alias("pages"), F.round(F.avg(F.coalesce("covered", F.lit(0))), 12).alias("coverage"))


def replica_agreement(spark, d):
    votes = table(spark, d, "toxicity_labels").distinct().groupBy("doc_id").agg(F.count("*").alias("raters"), F.count("abusive").alias("rated"), F.countDistinct("abusive").alias("values"))
    kind = F.when(F.col("rated") == 0, "not_evaluable").when(F.col("values") > 1, "disagreement").when(F.col("rated") < F.col("raters"), "consistent_partial").otherwise("exact")
    return votes.select("doc_id", kind.alias("agreement"))


def model_consensus(spark, d, least=2):
    votes = table(spark, d, "toxicity_labels").distinct().groupBy("doc_id").agg(F.count("abusive").alias("rated"), F.countDistinct("abusive").alias("values"), F.min("abusive").alias("value"))
    status = F.when(F.col("rated") < least, "too_few").when(F.col("values") > 1, "no_consensus").otherwise("admitted")
    return votes.select("doc_id", status.alias("status"), F.when(status == "admitted", F.col("value")).alias("value"))


def materialization_counts(spark, d):
    return table(spark, d, "orders").rollup("o_orderstatus").agg(F.count("*").alias("rows"), F.sum((F.col("o_totalprice") > 1000).cast("bigint")).alias("created")).select(F.coalesce("o_orderstatus", F.lit("total")).alias("collection"), "rows", "created")


def overall_ocr_status(spark, d):
    once = V.once(table(spark, d, "ocr_results"), "selection_result_id").join(V.pages(spark, d).select("page_id", "book").distinct(), "page_id")
    status = F.when(F.bool_and(F.col("status") == "completed"), "completed").when(F.bool_and(F.col("status") == "failed"), "failed").otherwise("partial")
    return once.groupBy("book").agg(status.alias("status"), F.count("*").alias("results"))


def work_deferral(spark, d):
    rows = table(spark, d, "chunks").groupBy("sequence").agg(F.min("equation_state").alias("equation_state"))
    state = F.lower(F.trim("equation_state"))
    return rows.select(F.when(state == "pending", "not_requested").otherwise(state).alias("state")).groupBy("state").agg(F.count("*").alias("rows"))


def artifact_paths(spark, d):
    path = F.concat_ws("/", "source", "kind", F.concat("doc_id", F.lit(".json")))
    return table(spark, d, "documents").select("doc_id", path.alias("path"), path_valid(path).alias("valid"))


def page_locator(spark, d):
    """Pages of TOC entries: the pages of the book whose text has the title's words in a row."""
    toc = table(spark, d, "toc_entries").select("entry_id", "book", "title").where("title is not null").distinct()
    pages = V.pages(spark, d).where("text is not null").select("book", "page_id", "text")
    return toc.join(pages, "book").where(contains_phrase(F.col("text"), F.col("title"))).groupBy("entry_id").agg(F.count("*").alias("pages"), F.min("page_id").alias("first_page_id"))


def equation_reasons(spark, d):
    once = V.once(table(spark, d, "equation_index"), "record_id")
    return once.select(F.explode("reasons").alias("reason")).groupBy("reason").agg(F.count("*").alias("rows"))


def evidence_selection(spark, d):
    """Equations with a recognition, in pages that have text: selected; others by what they lack."""
    once = V.once(table(spark, d, "equation_index"), "record_id")
    pages = V.pages(spark, d).where(F.trim("text") != "").select("book", "page_index").distinct().withColumn("there", F.lit(True))
    status = F.when(F.col("there").isNull(), "missing_page").when(F.col("latex_proposal").isNull(), "missing_recognition").when(F.arrays_overlap("reasons", F.array(F.lit("recognition_missing"))), "warning_inspection").otherwise("available")
    return once.join(pages, ["book", "page_index"], "left").select("record_id", status.alias("outcome"))


def equation_context(spark, d):
    """The equation before and after on the same page, by position."""
    from pyspark.sql import Window

    once = V.once(table(spark, d, "equation_index"), "record_id")
    w = Window.partitionBy("book", "page_index").orderBy("source_bounding_box.y0", "source_bounding_box.x0", "record_id")
    return once.select("record_id", F.lag("record_id").over(w).alias("before"), F.lead("record_id").over(w).alias("after"))


QUERIES = {f.__name__: f for f in (
    corpus_validation_summary, corpus_plan_dedup, low_text_pages, stable_ids, page_quality, block_text_compose, book_text_export, collection_inventory, inventory_measures, provenance_findings,
    page_windows, code_line_chunks, books_difference, page_coverage, replica_agreement, model_consensus, materialization_counts, overall_ocr_status, work_deferral, artifact_paths,
    page_locator, equation_reasons, evidence_selection, equation_context)}

EQ = "eq AS (SELECT DISTINCT ON (record_id) * FROM equation_index)"
SQL = {
    "corpus_validation_summary": f"""WITH {V.SQL_PAGES} SELECT source, count(DISTINCT book) AS books, count(*) AS pages,
      sum((trim(coalesce(text, ''), ' ') = '')::BIGINT)::BIGINT AS empty_pages, sum((length(coalesce(text, '')) < 40)::BIGINT)::BIGINT AS low_text_pages,
      sum(octet_length(encode(coalesce(text, ''))))::BIGINT AS utf8_bytes FROM pages GROUP BY source""",
    "corpus_plan_dedup": """SELECT doc_id, content_sha256, (row_number() OVER (ORDER BY doc_id) - 1) // 256 AS batch
      FROM (SELECT sha256(text) AS content_sha256, min(doc_id) AS doc_id FROM documents WHERE text IS NOT NULL GROUP BY 1)""",
    "low_text_pages": f"WITH {V.SQL_PAGES} SELECT page_id, length(coalesce(text, '')) AS chars FROM pages WHERE length(coalesce(text, '')) < 40",
    "stable_ids": """SELECT doc_id, 'document:sha256:' || sha256('["' || doc_id || '","' || kind || '","' || sha256(text) || '"]') AS stable_id FROM documents""",
    "page_quality": f"WITH {V.SQL_PAGES} SELECT page_id, round(least(1.0, length(coalesce(text, '')) / 1000.0), 6) AS quality FROM pages",
    "block_text_compose": f"""WITH {V.SQL_PAGES} SELECT page_id, array_to_string(list_filter(list_transform(string_split(text, chr(10)), lambda x: rtrim(x, ' ')), lambda x: x <> ''), chr(10)) AS composed
      FROM pages WHERE text IS NOT NULL""",
    "book_text_export": f"""WITH {V.SQL_PAGES} SELECT book, sha256(string_agg(sha256('[page ' || page_index || ']' || chr(10) || text), chr(10) ORDER BY page_index, page_id)) AS text_sha256, count(*) AS pages
      FROM pages WHERE text IS NOT NULL GROUP BY book""",
    "collection_inventory": """WITH r AS (SELECT doc_id::VARCHAR AS id, sha256(coalesce(text, '')) AS content, substr(sha256(doc_id::VARCHAR), 1, 4) AS part FROM documents),
      p AS (SELECT part, count(*) AS n, sha256(string_agg(id, chr(10) ORDER BY id)) AS ids, sha256(string_agg(id || chr(9) || content, chr(10) ORDER BY id || chr(9) || content)) AS pairs FROM r GROUP BY part),
      q AS (SELECT part[1:2] AS part, sum(n) AS n, sha256(string_agg(ids, chr(10) ORDER BY part)) AS ids, sha256(string_agg(pairs, chr(10) ORDER BY part)) AS pairs FROM p GROUP BY part[1:2])
      SELECT sum(n)::BIGINT AS rows, sha256(string_agg(ids, chr(10) ORDER BY part)) AS ids_sha256, sha256(string_agg(pairs, chr(10) ORDER BY part)) AS content_sha256 FROM q""",
    "inventory_measures": f"""WITH {V.SQL_PAGES} SELECT book, count(*) AS pages, count(*) FILTER (WHERE coalesce(text, '') <> '') AS pages_with_text, sum(length(coalesce(text, '')))::BIGINT AS chars,
      sum(octet_length(encode(coalesce(text, ''))))::BIGINT AS utf8_bytes, count(printed_page_label) AS labelled FROM pages GROUP BY book""",
    "provenance_findings": " UNION ALL ".join(
        [
            _audit("toc.unknown_book", "(SELECT DISTINCT * FROM toc_entries)", "pdf", "book"),
            _audit("chunk.unknown_book", "(SELECT DISTINCT sequence, book FROM chunks)", "pdf", "book"),
            _audit("equation.unknown_book", "(SELECT DISTINCT ON (record_id) * FROM equation_index)", "pdf", "book"),
            _audit("ocr.unknown_page", "(SELECT DISTINCT ON (selection_result_id) * FROM ocr_results)", "pdf", "page_id"),
            _audit("label.unknown_document", "(SELECT DISTINCT * FROM toxicity_labels)", "documents", "doc_id"),
            _audit("order.unknown_customer", "orders", "customer", "o_custkey", "c_custkey"),
        ]
    ),
    "page_windows": f"""WITH {V.SQL_PAGES}, p AS (SELECT *, (row_number() OVER (PARTITION BY book ORDER BY page_index, page_id) - 1) // 4 AS w FROM pages)
      SELECT book, w AS "window", min(page_index)::BIGINT AS first_index, max(page_index)::BIGINT AS last_index, count(*) AS pages FROM p GROUP BY book, w""",
    "code_line_chunks": f"""WITH {V.SQL_BLOCKS} SELECT page_id, (ordinal // 5)::BIGINT AS chunk, min(ordinal)::BIGINT AS first_line, max(ordinal)::BIGINT AS last_line, string_agg(line, chr(10) ORDER BY ordinal) AS text
      FROM blocks GROUP BY page_id, ordinal // 5""",
    "books_difference": """WITH a AS (SELECT name, max(pages) AS v FROM books GROUP BY name), b AS (SELECT book AS name, max(page_index)::BIGINT + 1 AS v FROM pdf GROUP BY book)
      SELECT coalesce(a.name, b.name) AS name, CASE WHEN b.name IS NULL THEN 'missing_right' WHEN a.name IS NULL THEN 'missing_left' ELSE 'changed' END AS status
      FROM a FULL JOIN b ON a.name = b.name WHERE a.name IS NULL OR b.name IS NULL OR a.v IS DISTINCT FROM b.v""",
    "page_coverage": f"""WITH {V.SQL_PAGES}, p AS (SELECT DISTINCT book, page_index + 1 AS page FROM pages)
      SELECT book, count(*) AS pages, round(avg(EXISTS (SELECT 1 FROM chunks c WHERE c.book = p.book AND p.page BETWEEN c.first_page AND c.last_page)::INT), 12) AS coverage FROM p GROUP BY book""",
    "replica_agreement": """WITH v AS (SELECT doc_id, count(*) AS n, count(abusive) AS rated, count(DISTINCT abusive) AS vals FROM (SELECT DISTINCT * FROM toxicity_labels) GROUP BY doc_id)
      SELECT doc_id, CASE WHEN rated = 0 THEN 'not_evaluable' WHEN vals > 1 THEN 'disagreement' WHEN rated < n THEN 'consistent_partial' ELSE 'exact' END AS agreement FROM v""",
    "model_consensus": """WITH v AS (SELECT doc_id, count(abusive) AS rated, count(DISTINCT abusive) AS vals, min(abusive) AS value FROM (SELECT DISTINCT * FROM toxicity_labels) GROUP BY doc_id)
      SELECT doc_id, CASE WHEN rated < 2 THEN 'too_few' WHEN vals > 1 THEN 'no_consensus' ELSE 'admitted' END AS status, CASE WHEN rated >= 2 AND vals = 1 THEN value END AS value FROM v""",
    "materialization_counts": "SELECT coalesce(o_orderstatus, 'total') AS collection, count(*) AS rows, count(*) FILTER (WHERE o_totalprice > 1000) AS created FROM orders GROUP BY ROLLUP (o_orderstatus)",
    "overall_ocr_status": f"""WITH {V.SQL_PAGES}, {V.SQL_OCR} SELECT book, CASE WHEN bool_and(status = 'completed') THEN 'completed' WHEN bool_and(status = 'failed') THEN 'failed' ELSE 'partial' END AS status, count(*) AS results
      FROM ocr JOIN (SELECT DISTINCT page_id, book FROM pages) USING (page_id) GROUP BY book""",
    "work_deferral": """SELECT CASE WHEN s = 'pending' THEN 'not_requested' ELSE s END AS state, count(*) AS rows
      FROM (SELECT sequence, lower(trim(min(equation_state), ' ')) AS s FROM chunks GROUP BY sequence) GROUP BY 1""",
    "artifact_paths": r"""SELECT doc_id, p AS path, NOT (regexp_matches(p, '^/|//|(^|/)\.{1,2}(/|$)|/$') OR contains(p, '\')) AND length(p) > 0 AS valid
      FROM (SELECT doc_id, concat_ws('/', source, kind, doc_id || '.json') AS p FROM documents)""",
    "page_locator": f"""WITH {V.SQL_PAGES}, t AS (SELECT DISTINCT entry_id, book, ' ' || trim(regexp_replace(lower(title), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'), ' ') || ' ' AS k FROM toc_entries WHERE title IS NOT NULL),
      p AS (SELECT book, page_id, ' ' || trim(regexp_replace(lower(text), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'), ' ') || ' ' AS words FROM pages WHERE text IS NOT NULL)
      SELECT entry_id, count(*) AS pages, min(page_id) AS first_page_id FROM t JOIN p USING (book) WHERE length(k) > 2 AND contains(words, k) GROUP BY entry_id""",


    "equation_reasons": f"WITH {EQ} SELECT reason, count(*) AS rows FROM (SELECT unnest(reasons) AS reason FROM eq) GROUP BY reason",
    "evidence_selection": f"""WITH {EQ}, {V.SQL_PAGES}, p AS (SELECT DISTINCT book, page_index FROM pages WHERE trim(text, ' ') <> '')
      SELECT record_id, CASE WHEN p.book IS NULL THEN 'missing_page' WHEN latex_proposal IS NULL THEN 'missing_recognition' WHEN list_contains(reasons, 'recognition_missing') THEN 'warning_inspection' ELSE 'available' END AS outcome
      FROM eq LEFT JOIN p ON p.book = eq.book AND p.page_index = eq.page_index""",
    "equation_context": f"""WITH {EQ} SELECT record_id, lag(record_id) OVER w AS "before", lead(record_id) OVER w AS "after" FROM eq
      WINDOW w AS (PARTITION BY book, page_index ORDER BY source_bounding_box.y0 NULLS FIRST, source_bounding_box.x0 NULLS FIRST, record_id)""",
}
