"""Queries that compose transcripts and evidence."""

from __future__ import annotations

from pyspark.sql import functions as F

from quirewise.functions.text import FIGURE_CAPTION, heading
from quirewise.operators import composition as C
from quirewise.operators import detections as D
from quirewise.plans.contracts import _compatible
from quirewise.plans.detections import ITEMS
from quirewise.plans.pagelayout import _items
from quirewise.plans.transcript import HEADS, _APP, _KNOWN, _NUM, _clean, _folded
from quirewise.sources import views as V
from quirewise.storage import table

KEY = ["page_id", "ordinal"]


def _lines(spark, d):
    pages = V.once(V.pages(spark, d).select("page_id", "text", "book"), "page_id")
    return pages.select("page_id", "book", F.posexplode_outer(F.split("text", "\n", -1)).alias("ordinal", "text")).withColumn("ordinal", F.coalesce("ordinal", F.lit(0)).cast("bigint"))


def _claimed(spark, d):
    lines = _lines(spark, d)
    t = F.col("text")
    ways = F.array(F.when(t.rlike(FIGURE_CAPTION), F.struct(F.lit("figure").alias("kind"), F.lit(2).alias("priority"))), F.when(D.table_role(t).isNotNull(), F.struct(F.lit("table").alias("kind"), F.lit(1).alias("priority"))), F.when(heading(t).isNotNull(), F.struct(F.lit("heading").alias("kind"), F.lit(3).alias("priority"))))
    claims = lines.select(*KEY, F.explode(F.filter(ways, lambda w: w.isNotNull())).alias("w")).select(*KEY, "w.kind", "w.priority")
    return C.claimed(lines, claims, KEY)


def block_claims(spark, d):
    """What transcribes the lines of each page, how many are left out and why."""
    return _claimed(spark, d).groupBy("page_id", "kind", "omission").agg(F.count("*").alias("lines"), F.sum(F.col("contested").cast("bigint")).alias("contested"))


def book_transcription_status(spark, d):
    books = V.once(V.pages(spark, d).select("page_id", "book"), "page_id")
    x = _claimed(spark, d).join(books, "page_id").withColumn("warnings", F.lit(0)).withColumn("ambiguous", F.col("contested"))
    return C.transcription_status(x, ["book"])


def transcription_order(spark, d):
    """Equations and contents entries of a book in one order; entries have no position on their page."""
    eq = _items(spark, d).select("book", "id", F.lit("equation").alias("kind"), (F.col("page_index") * 4).cast("bigint").alias("page_index"), F.col("box.x0").alias("x"), F.col("box.y0").alias("y"))
    toc = V.once(table(spark, d, "toc_entries").where("book is not null"), "entry_id").select("book", F.col("entry_id").alias("id"), F.lit("heading").alias("kind"), F.col("page_index").cast("bigint"), F.lit(None).cast("double").alias("x"), F.lit(None).cast("double").alias("y"))
    return C.item_order(eq.unionByName(toc), ["book"]).select("book", "id", "place")


def block_layout_order(spark, d):
    """Scanned lines in the order of their boxes; every fifth isn't in the proposed order."""
    from pyspark.sql import Window

    lines = V.ocr_lines(spark, d).select("selection_result_id", F.col("order").alias("id"), F.col("order").alias("ordinal"), "box")
    w = Window.partitionBy("selection_result_id").orderBy(F.col("box.y0").desc(), "box.x0", "id")
    proposed = lines.where("id % 5 > 0").select("selection_result_id", "id", F.row_number().over(w).alias("position"), F.lit(0.9).alias("confidence"))
    return C.ordered_blocks(lines, proposed, ["selection_result_id"]).select("selection_result_id", F.col("id").cast("bigint").alias("id"), "place", "confidence")


def structure_dispositions(spark, d):
    from quirewise.plans.transcript import _lines as doc_lines
    from quirewise.operators.transcript import headings

    x = headings(doc_lines(spark, d))
    return x.select("doc_id", "ordinal", C.disposition(F.col("kind")).alias("disposition"))


def layout_reviews(spark, d):
    """Lines of results, every ninth without a proper box, against the boxes of most of their tokens."""
    lines = V.ocr_lines(spark, d).select("selection_result_id", F.col("order").alias("id"), F.when(F.col("order") % 9 == 8, F.struct(F.col("box.x1").alias("x0"), F.col("box.y0").alias("y0"), F.col("box.x0").alias("x1"), F.col("box.y1").alias("y1"))).otherwise(F.col("box")).alias("box"))
    regions = V.ocr_tokens(spark, d).where("line_order % 7 < 6").groupBy("selection_result_id", "line_order").agg(*[f(f"box.{c}").alias(c) for f, c in ((F.min, "x0"), (F.min, "y0"), (F.max, "x1"), (F.max, "y1"))])
    x = C.layout_review(lines, regions.select("selection_result_id", F.struct("x0", "y0", "x1", "y1").alias("box")), ["selection_result_id"])
    return x.withColumn("reasons", F.array_join("reasons", ","))


def _projection(spark, d):
    lines = _claimed(spark, d).join(_lines(spark, d), KEY).where("kind is not null").withColumn("id", F.col("ordinal"))
    captions = lines.where("kind = 'figure'").select("page_id", F.col("id"), "text")
    return C.projected_pages(lines, captions, ["page_id"])


def page_projections(spark, d):
    return _projection(spark, d)[0].groupBy("page_id", "kind").agg(F.count("*").alias("blocks"))


def projection_bindings(spark, d):
    kept = _projection(spark, d)[0].select("page_id", "id", "kind")
    reading = _lines(spark, d).where("ordinal % 4 > 0").select("page_id", F.col("ordinal").alias("id"), F.concat_ws("#", "page_id", F.col("ordinal").cast("string")).alias("evidence"))
    return C.cross_bindings(kept, reading, ["page_id"]).groupBy("page_id", "binding").agg(F.count("*").alias("blocks"), F.min("evidence").alias("first_evidence"))


def _anchors(spark, d):
    pages = V.once(V.pages(spark, d).select("page_id", "book", "text"), "page_id").where("book is not null")
    return C.anchor_matches(pages, table(spark, d, "toc_entries").select("book", F.col("title").alias("anchor")), "book")


def topic_anchors(spark, d):
    return _anchors(spark, d).select("page_id", F.array_join("matched", "|").alias("matched"), F.size("unmatched").cast("bigint").alias("unmatched"))


def claim_candidates(spark, d):
    records = V.pages(spark, d).select("page_id", (F.col("extraction_method") == "native_text").alias("reusable"))
    return C.claim_candidates(records, _anchors(spark, d))


def reference_records(spark, d):
    """Books by the layers of evidence they have."""
    layer = lambda t, name, c="book": table(spark, d, t).where(f"{c} is not null").select(F.col(c).alias("id"), F.lit(name).alias("layer")).distinct()
    x = layer("pdf", "pages").union(layer("toc_entries", "contents")).union(layer("equation_index", "equations")).union(layer("chunks", "chunks"))
    y = C.complete_records(x, ["pages", "contents", "equations", "chunks"])
    return y.select("id", F.array_join("missing", ",").alias("missing"), "complete")


def reason_union(spark, d):
    once = V.once(table(spark, d, "equation_index").select("record_id", "book", "reasons"), "record_id").where("book is not null")
    return C.first_occurrences(once, "book", "record_id", "reasons").select("book", F.array_join("reasons", ",").alias("reasons"))


def book_inventory(spark, d):
    member = lambda t, c: table(spark, d, t).where(f"{c} is not null").select(F.col(c).alias("member"))
    return C.inventory_problems(member("books", "name"), member("toc_entries", "book"))


def inline_formulas(spark, d):
    x = V.once(table(spark, d, "equation_index").select("record_id", "sanitized_native_text"), "record_id").where("sanitized_native_text is not null")
    y = x.select("record_id", "sanitized_native_text", F.explode(C.inline_equations("sanitized_native_text")).alias("e"))
    return y.select("record_id", F.col("e.start").cast("bigint").alias("start"), "e.method", F.expr("substring(sanitized_native_text, e.start + 1, e.stop - e.start)").alias("body"))


def render_preflight(spark, d):
    return C.preflight(_items(spark, d), ["book", "page_index"])


def contents_scan(spark, d):
    """Contents entries of a book as one outline, and out of it again."""
    toc = V.once(table(spark, d, "toc_entries").where("book is not null"), "entry_id")
    outline = toc.groupBy("book").agg(F.array_sort(F.collect_list(F.struct("entry_id", "level", "title", "page_index"))).alias("entries"))
    return outline.select("book", F.posexplode("entries").alias("place", "e")).select("book", F.col("place").cast("bigint").alias("place"), "e.entry_id", "e.level", "e.title", "e.page_index")


def ocr_plan_pending(spark, d):
    """Scanned pages of the plan without a completed result, and results whose tokens name a line that isn't there."""
    pages = V.pages(spark, d).where("extraction_method = 'ocr'").select("page_id").distinct()
    done = table(spark, d, "ocr_results").where("status = 'completed'").select("page_id").distinct()
    x = V.ocr_tokens(spark, d).select("selection_result_id", F.col("line_order").alias("order")).distinct().join(V.ocr_lines(spark, d).select("selection_result_id", "order"), ["selection_result_id", "order"], "left_anti")
    return pages.join(done, "page_id", "left_anti").select(F.lit("not_published").alias("problem"), F.col("page_id").alias("id")).union(x.select(F.lit("unknown_line"), "selection_result_id").distinct())


QUERIES = {f.__name__: f for f in (
    block_claims, book_transcription_status, transcription_order, block_layout_order, structure_dispositions, layout_reviews, page_projections, projection_bindings, topic_anchors, claim_candidates, reference_records, reason_union, book_inventory, inline_formulas,
    render_preflight, contents_scan, ocr_plan_pending)}

LINES = rf"""lp AS (SELECT page_id, min({{'t': text, 'b': book}}) AS z FROM pdf WHERE page_id IS NOT NULL GROUP BY page_id),
      li AS (SELECT page_id, z.b AS book, unnest(string_split(z.t, chr(10))) AS text, generate_subscripts(string_split(z.t, chr(10)), 1)::BIGINT - 1 AS ordinal FROM lp WHERE z.t IS NOT NULL UNION ALL SELECT page_id, z.b, NULL, 0 FROM lp WHERE z.t IS NULL),
      lc AS (SELECT *, {_clean("text")} AS clean, {_folded("text")} AS f FROM li),
      lk AS (SELECT *, regexp_matches(text, '(?i)^\s*Table\b') OR regexp_matches(text, '(?i)^\s*Caption\s*[:.]') OR regexp_matches(text, '(?i)^\s*(?:Note|Notes|Source)\s*[:.]') AS tab, regexp_matches(text, '(?i)^\s*(Figure\b|Fig\.)') AS fig,
        clean <> '' AND length(clean) <= 512 AND (regexp_matches(clean, '{_APP}') OR f IN ('bibliography', 'literature cited', 'references', {_KNOWN}) OR regexp_matches(clean, '{_NUM}')) AS head FROM lc),
      cl AS (SELECT page_id, book, ordinal, text, CASE WHEN text IS NULL THEN 'missing_text_payload' WHEN regexp_replace(text, '[\s\p{{Z}}\x1c-\x1f\x85]+', '', 'g') = '' THEN 'blank_text' END AS omission,
        CASE WHEN text IS NULL OR regexp_replace(text, '[\s\p{{Z}}\x1c-\x1f\x85]+', '', 'g') = '' THEN NULL WHEN tab THEN 'table' WHEN fig THEN 'figure' WHEN head THEN 'heading' ELSE 'raw' END AS kind, coalesce(tab::INT + fig::INT + head::INT > 1, false) AS contested FROM lk)"""
_words = lambda x: f"' ' || trim(regexp_replace(replace(lower({_compatible(x)}), 'ß', 'ss'), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'), ' ') || ' '"
ANCHORS = f"""WITH pg AS (SELECT page_id, min({{'b': book, 't': text}}) AS z FROM pdf WHERE page_id IS NOT NULL GROUP BY page_id), p AS (SELECT page_id, z.b AS book, {_words("z.t")} AS words FROM pg WHERE z.b IS NOT NULL AND z.t IS NOT NULL),
      a AS (SELECT DISTINCT book, title AS anchor, {_words("title")} AS phrase FROM toc_entries WHERE title IS NOT NULL), h AS (SELECT page_id, anchor, contains(words, phrase) AS hit FROM p JOIN a USING (book) WHERE length(phrase) > 2)"""

SQL = {
    "block_claims": f"WITH {LINES} SELECT page_id, kind, omission, count(*) AS lines, count(*) FILTER (WHERE contested) AS contested FROM cl GROUP BY page_id, kind, omission",
    "book_transcription_status": f"WITH {LINES} SELECT book, CASE WHEN bool_or(omission IS NOT NULL OR contested) THEN 'transcribed_with_uncertainty' ELSE 'transcribed' END AS status FROM cl GROUP BY book",
    "transcription_order": f"""WITH {ITEMS}, u AS (SELECT book, id, 3 AS k, page_index * 4 AS page_index, x0 AS x, y0 AS y FROM items UNION ALL SELECT z.b, entry_id, 1, z.p, NULL, NULL FROM (SELECT entry_id, min({{'b': book, 'l': level, 't': title, 'p': page_index}}) AS z FROM toc_entries WHERE book IS NOT NULL AND entry_id IS NOT NULL GROUP BY entry_id))
      SELECT book, id, row_number() OVER (PARTITION BY book ORDER BY page_index NULLS LAST, y IS NULL, y NULLS LAST, x NULLS LAST, k, id) - 1 AS place FROM u""",
    "block_layout_order": f"""WITH {V.SQL_LINES}, p AS (SELECT selection_result_id, "order" AS id, row_number() OVER (PARTITION BY selection_result_id ORDER BY box.y0 DESC, box.x0, "order") AS position FROM lines WHERE "order" % 5 > 0)
      SELECT l.selection_result_id, l."order"::BIGINT AS id, row_number() OVER (PARTITION BY l.selection_result_id ORDER BY position NULLS LAST, l."order") - 1 AS place, CASE WHEN position IS NULL THEN 0.35::DOUBLE ELSE 0.9::DOUBLE END AS confidence
      FROM lines l LEFT JOIN p ON p.selection_result_id = l.selection_result_id AND p.id = l."order\"""",
    "structure_dispositions": f"WITH {HEADS} SELECT doc_id, ordinal, 'heading' AS disposition FROM heads",
    "layout_reviews": f"""WITH {V.SQL_TOKENS}, ln AS (SELECT selection_result_id, x."order" AS o, x.pixel_bounding_box AS box FROM (SELECT selection_result_id, unnest(lines) AS x FROM ocr)),
      g AS (SELECT selection_result_id, min(box.x0) AS x0, min(box.y0) AS y0, max(box.x1) AS x1, max(box.y1) AS y1 FROM tokens WHERE line_order % 7 < 6 GROUP BY selection_result_id, line_order),
      s AS (SELECT l.selection_result_id, o, max(round(greatest(0.0, least(box.x1, g.x1) - greatest(box.x0, g.x0)) * greatest(0.0, least(box.y1, g.y1) - greatest(box.y0, g.y0)) / ((box.x1 - box.x0) * (box.y1 - box.y0)), 12)) AS share, count(g.x0) AS seen FROM ln l LEFT JOIN g USING (selection_result_id) GROUP BY ALL),
      c AS (SELECT selection_result_id, count(*) AS blocks, count(*) FILTER (WHERE o % 9 <> 8 AND coalesce(share >= 0.5, false)) AS covered, count(*) FILTER (WHERE o % 9 <> 8 AND NOT coalesce(share >= 0.5, false)) AS uncovered, count(*) FILTER (WHERE o % 9 = 8) AS invalid, max(seen) AS seen FROM s GROUP BY 1)
      SELECT selection_result_id, blocks, covered, uncovered, invalid, round(covered / blocks, 12) AS coverage, concat_ws(',', CASE WHEN invalid > 0 THEN 'invalid_block_geometry' END, CASE WHEN seen = 0 THEN 'no_regions' END, CASE WHEN uncovered > 0 THEN 'uncovered_blocks' END,
      CASE WHEN round(covered / blocks, 12) < 0.9 THEN 'insufficient_coverage' END) AS reasons FROM c""",
    "page_projections": f"WITH {LINES} SELECT page_id, CASE kind WHEN 'figure' THEN 'caption' ELSE kind END AS kind, count(*) AS blocks FROM cl WHERE kind IN ('heading', 'raw', 'figure') GROUP BY ALL",
    "projection_bindings": f"""WITH {LINES}, b AS (SELECT page_id, CASE WHEN kind <> 'figure' AND ordinal % 4 > 0 THEN page_id || '#' || ordinal END AS e FROM cl WHERE kind IN ('heading', 'raw', 'figure'))
      SELECT page_id, CASE WHEN e IS NULL THEN 'unavailable' ELSE 'available' END AS binding, count(*) AS blocks, min(e) AS first_evidence FROM b GROUP BY page_id, e IS NULL""",
    "topic_anchors": f"{ANCHORS} SELECT page_id, coalesce(string_agg(anchor, '|' ORDER BY anchor) FILTER (WHERE hit), '') AS matched, count(*) FILTER (WHERE NOT hit) AS unmatched FROM h GROUP BY page_id",
    "claim_candidates": f"{ANCHORS} SELECT page_id, anchor, 'manual_review_required' AS review FROM h WHERE hit AND page_id IN (SELECT page_id FROM pdf WHERE extraction_method = 'native_text')",
    "reference_records": """WITH l AS (SELECT DISTINCT book AS id, 1 AS n FROM pdf WHERE book IS NOT NULL UNION ALL SELECT DISTINCT book, 2 FROM toc_entries WHERE book IS NOT NULL UNION ALL SELECT DISTINCT book, 3 FROM equation_index WHERE book IS NOT NULL UNION ALL SELECT DISTINCT book, 4 FROM chunks WHERE book IS NOT NULL)
      SELECT id, concat_ws(',', CASE WHEN NOT bool_or(n = 1) THEN 'pages' END, CASE WHEN NOT bool_or(n = 2) THEN 'contents' END, CASE WHEN NOT bool_or(n = 3) THEN 'equations' END, CASE WHEN NOT bool_or(n = 4) THEN 'chunks' END) AS missing, count(*) = 4 AS complete FROM l GROUP BY id""",
    "reason_union": """WITH o AS (SELECT record_id, min({'b': book, 'r': reasons}) AS z FROM equation_index WHERE record_id IS NOT NULL GROUP BY record_id), e AS (SELECT z.b AS book, record_id, unnest(z.r) AS reason, generate_subscripts(z.r, 1) AS i FROM o WHERE z.b IS NOT NULL AND z.r IS NOT NULL),
      f AS (SELECT book, reason, min((record_id, i)) AS first_at FROM e GROUP BY ALL), b AS (SELECT DISTINCT z.b AS book FROM o WHERE z.b IS NOT NULL AND z.r IS NOT NULL)
      SELECT b.book, coalesce(string_agg(reason, ',' ORDER BY first_at), '') AS reasons FROM b LEFT JOIN f ON f.book = b.book GROUP BY b.book""",
    "book_inventory": """SELECT coalesce(a.m, b.m) AS member, CASE WHEN b.m IS NULL THEN 'missing' ELSE 'extra' END AS problem FROM (SELECT DISTINCT name AS m FROM books WHERE name IS NOT NULL) a FULL JOIN (SELECT DISTINCT book AS m FROM toc_entries WHERE book IS NOT NULL) b ON a.m = b.m WHERE a.m IS NULL OR b.m IS NULL""",
    "inline_formulas": r"""WITH x AS (SELECT record_id, min(sanitized_native_text) AS t FROM equation_index WHERE record_id IS NOT NULL GROUP BY record_id HAVING min(sanitized_native_text) IS NOT NULL),
      m AS (SELECT record_id, t, unnest(regexp_extract_all(t, '(?:^|[^\p{L}\p{N}_])([A-Za-zΑ-ω][\s\p{Z}]*[=≈≃≤≥≠∝][\s\p{Z}]*[^,;:.\n]{1,120})', 1)) AS b FROM x)
      SELECT record_id, (strpos(t, b) - 1)::BIGINT AS start, 'relational_inline' AS method, regexp_replace(b, '[\s\p{Z}]+$', '') AS body FROM m""",
    "render_preflight": f"""WITH {ITEMS}, s AS (SELECT DISTINCT book, page_index, x0, y0, x1, y1 FROM items), p AS (SELECT book, page_index, (ceil((x1 - x0) * 2) * ceil((y1 - y0) * 2))::BIGINT AS p FROM s)
      SELECT book, page_index, count(*) AS selections, sum(p)::BIGINT AS pixels, (sum(p) * 3)::BIGINT AS bytes, sum(p) <= 25000000 AS allowed FROM p GROUP BY ALL""",
    "contents_scan": """SELECT z.b AS book, row_number() OVER (PARTITION BY z.b ORDER BY entry_id) - 1 AS place, entry_id, z.l AS level, z.t AS title, z.p AS page_index
      FROM (SELECT entry_id, min({'b': book, 'l': level, 't': title, 'p': page_index}) AS z FROM toc_entries WHERE book IS NOT NULL AND entry_id IS NOT NULL GROUP BY entry_id)""",
    "ocr_plan_pending": f"""WITH {V.SQL_TOKENS}, ln AS (SELECT selection_result_id, x."order" AS o FROM (SELECT selection_result_id, unnest(lines) AS x FROM ocr))
      SELECT DISTINCT 'not_published' AS problem, page_id AS id FROM pdf WHERE extraction_method = 'ocr' AND page_id NOT IN (SELECT page_id FROM ocr_results WHERE status = 'completed' AND page_id IS NOT NULL)
      UNION ALL SELECT DISTINCT 'unknown_line', t.selection_result_id FROM tokens t LEFT JOIN ln ON ln.selection_result_id = t.selection_result_id AND ln.o = t.line_order WHERE ln.o IS NULL""",
}
