"""Detection, table and figure queries: equations as detections of a page, page lines as texts, contents entries as table regions."""

from __future__ import annotations

from pyspark.sql import functions as F

from quirewise.operators import detections as D
from quirewise.operators import scans as S
from quirewise.plans.pagelayout import ITEMS, _items
from quirewise.sources import views as V
from quirewise.storage import table

LABELS = ("primary", "auxiliary")
PAGE = ["book", "page_index"]


def _detections(spark, d):
    once = V.once(table(spark, d, "equation_index").select("record_id", "tier", "completeness"), "record_id").select(F.col("record_id").alias("id"), F.col("tier").alias("label"), F.col("completeness").alias("confidence"))
    return D.judged(_items(spark, d).join(once, "id"), LABELS, 0.5)


def detection_outcomes(spark, d):
    return _detections(spark, d).select("id", "outcome")


def detection_annotations(spark, d):
    return D.annotations(_detections(spark, d).where("outcome = 'accepted'"), PAGE, "label")


def detector_gate(spark, d):
    """Pages with an odd number need a review."""
    pages = _items(spark, d).select(*PAGE).distinct().withColumn("requires_review", F.col("page_index") % 2 == 1)
    x = D.gate(_detections(spark, d), pages, PAGE)
    return x.select(*PAGE, "status", F.array_join("reasons", ",").alias("reasons"))


def admitted_regions(spark, d):
    """Regions of a page and category after suppression, one row a region kept."""
    x = S.admit_boxes(_detections(spark, d), [*PAGE, "label"], "confidence", "box", iou=0.1, least=0.3)
    return x.select(*PAGE, "label", "confidence", "box.x0", "box.y0")


def formula_projection(spark, d):
    one, none = F.lit(0.5), F.lit(0.0)
    x = D.projected_formulas(_detections(spark, d).select(*PAGE, "box", "confidence"), PAGE, [one, none, none, one, none, none], 306.0, 396.0, least=0.3, iou=0.1)
    return x.select(*PAGE, "position", "confidence", *[F.round(f"box.{c}", 6).alias(c) for c in ("x0", "y0", "x1", "y1")])


def order_candidates(spark, d):
    """Orders that name an equation twice, one that isn't there, or leave one out."""
    x = _items(spark, d).select(*PAGE, "id")
    last = F.substring("id", -1, 1)
    orders = x.where(last != "0").union(x.where(last == "1")).union(x.where(last == "2").withColumn("id", F.concat("id", F.lit("?"))))
    p = D.order_candidate_problems(orders, x, PAGE)
    return p.select(*PAGE, F.array_join("problems", ",").alias("problems"))


def region_kinds(spark, d):
    """Labels of another detector as region kinds."""
    kinds = spark.createDataFrame([("primary", "text"), ("auxiliary", "figure")], "label string, kind string")
    return _detections(spark, d).join(kinds, "label", "left").select("id", F.coalesce("kind", F.lit("other")).alias("kind"))


def table_text_roles(spark, d):
    x = V.blocks(spark, d).withColumn("r", D.table_role(F.col("line"))).where("r is not null")
    return x.select("page_id", F.col("ordinal").cast("bigint").alias("ordinal"), "r.role", "r.label", "r.confidence")


def _segments(spark, d):
    drawings = _items(spark, d).where("id rlike '[0-7]$'")
    flat = F.struct(F.col("box.x0").alias("x0"), F.col("box.y0").alias("y0"), F.col("box.x1").alias("x1"), F.col("box.y0").alias("y1"))
    return D.rule_segments(drawings.withColumn("box", F.when(F.col("id").rlike("[0-3]$"), flat).otherwise(F.col("box"))), PAGE)


def rule_segments(spark, d):
    return _segments(spark, d)


def table_boundaries(spark, d):
    return D.boundary_kinds(_segments(spark, d), PAGE)


def _clusters(spark, d):
    return D.value_clusters(V.ocr_tokens(spark, d).select("selection_result_id", F.col("box.x0").alias("value")), "selection_result_id", 60.0)


def column_anchors(spark, d):
    return _clusters(spark, d).select("selection_result_id", "cluster", F.round("mean", 6).alias("mean"), "n")


def column_assignment(spark, d):
    x = D.columns_of(V.ocr_tokens(spark, d).select("selection_result_id", F.col("order").alias("id"), "box"), _clusters(spark, d), "selection_result_id")
    return x.groupBy("selection_result_id", "column").agg(F.count("*").alias("tokens"))


def _chained(spark, d):
    x = V.once(table(spark, d, "toc_entries").where("book is not null and page_index >= 0"), "entry_id")
    n = F.conv(F.substring(F.sha2("entry_id", 256), 1, 2), 16, 10).cast("int")
    x = x.select(F.col("book").alias("document"), "page_index", F.col("entry_id").alias("region"), F.when(n % 3 > 0, F.concat(F.lit("T"), F.col("level").cast("string"))).alias("label"), (n % 2 == 0).alias("continued"), F.lit(2).alias("columns"),
                 F.array(F.lit(0.1), 0.5 + (n % 8) / 100.0).alias("anchors"), (n / 256.0).alias("confidence"), F.when(n % 5 == 0, "ruled").otherwise("unruled").alias("boundary"))
    return D.table_chains(x)


def table_chains(spark, d):
    return D.table_candidates(_chained(spark, d)).select("document", "chain", "regions", "first_page", "last_page", "label", "boundary", "confidence")


def table_continuations(spark, d):
    return D.continuations(_chained(spark, d))


def repeated_table_headers(spark, d):
    """The first words of a book's pages as header rows of one table: which repeat the first one."""
    pages = V.once(V.pages(spark, d).where("page_index is not null and text is not null and book is not null").select("page_id", "book", "page_index", "text"), "page_id")
    words = F.slice(F.filter(F.split(F.col("text"), r"\s+"), lambda w: w != ""), 1, 1)
    return D.repeated_headers(pages.select(F.col("book").alias("candidate"), "page_index", words.alias("texts"))).groupBy("candidate").agg(F.count("*").alias("regions"), F.sum(F.col("repeated").cast("bigint")).alias("repeated"))


def figure_captions_nearest(spark, d):
    x = _items(spark, d)
    return D.nearest_captions(x.where("id rlike '[0-7]$'"), x.where("id rlike '[89a-f]$'"), PAGE)


def figure_sizes(spark, d):
    """Embedded images of at least a point in either dimension and four square points: tokens at a thirtieth of their size."""
    w, h = (F.col("box.x1") - F.col("box.x0")) / 30, (F.col("box.y1") - F.col("box.y0")) / 30
    return V.ocr_tokens(spark, d).where((F.least(w, h) >= 1.0) & (w * h >= 4.0)).groupBy("selection_result_id").agg(F.count("*").alias("images"))


def figure_relevance(spark, d):
    once = V.once(table(spark, d, "equation_index").select("record_id", "completeness"), "record_id")
    return once.select("record_id", D.relevance_level(F.col("completeness")).alias("level"))


QUERIES = {f.__name__: f for f in (
    detection_outcomes, detection_annotations, detector_gate, admitted_regions, formula_projection, order_candidates, region_kinds, table_text_roles, rule_segments, table_boundaries, column_anchors, column_assignment, table_chains, table_continuations,
    repeated_table_headers, figure_captions_nearest, figure_sizes, figure_relevance)}

B = "book, page_index"
DET = f"""{ITEMS}, o AS (SELECT record_id AS id, min(tier) AS label, min(completeness) AS confidence FROM equation_index WHERE record_id IS NOT NULL GROUP BY record_id),
      det AS (SELECT items.*, label, confidence, CASE WHEN NOT coalesce(label IN ('primary', 'auxiliary'), false) THEN 'unsupported_label' WHEN coalesce(confidence < 0.5, true) THEN 'below_confidence_threshold' ELSE 'accepted' END AS outcome FROM items JOIN o USING (id))"""


def _nms(by: str) -> str:
    """Greedy suppression by recursion over the ranks of a group: kept lists grow one box a step."""
    return f"""cand AS (SELECT {by}, confidence, x0, y0, x1, y1, row_number() OVER (PARTITION BY {by} ORDER BY confidence DESC, x0, y0, x1, y1) AS n FROM (SELECT DISTINCT {by}, confidence, x0, y0, x1, y1 FROM det WHERE confidence >= 0.3)),
      nms AS (SELECT {by}, 1 AS n, [{{'c': confidence, 'x0': x0, 'y0': y0, 'x1': x1, 'y1': y1}}] AS kept FROM cand WHERE n = 1
        UNION ALL SELECT {", ".join("r." + c for c in by.split(", "))}, c.n, CASE WHEN len(list_filter(r.kept, lambda k: greatest(0.0, least(k.x1, c.x1) - greatest(k.x0, c.x0)) * greatest(0.0, least(k.y1, c.y1) - greatest(k.y0, c.y0))
          / ((k.x1 - k.x0) * (k.y1 - k.y0) + (c.x1 - c.x0) * (c.y1 - c.y0) - greatest(0.0, least(k.x1, c.x1) - greatest(k.x0, c.x0)) * greatest(0.0, least(k.y1, c.y1) - greatest(k.y0, c.y0))) >= 0.1)) > 0 THEN r.kept
          ELSE list_append(r.kept, {{'c': c.confidence, 'x0': c.x0, 'y0': c.y0, 'x1': c.x1, 'y1': c.y1}}) END FROM nms r JOIN cand c ON {" AND ".join(f"c.{k} IS NOT DISTINCT FROM r.{k}" for k in by.split(", "))} AND c.n = r.n + 1),
      full_ AS (SELECT {by}, unnest(kept) AS k FROM nms QUALIFY row_number() OVER (PARTITION BY {by} ORDER BY n DESC) = 1)"""


SEG = f"""WITH {ITEMS}, dr AS (SELECT {B}, x0, y0, x1, CASE WHEN regexp_matches(id, '[0-3]$') THEN y0 ELSE y1 END AS y1 FROM items WHERE regexp_matches(id, '[0-7]$')),
      seg AS (SELECT DISTINCT *, CASE WHEN x0 = x1 THEN 'vertical' ELSE 'horizontal' END AS orientation FROM (SELECT {B}, x0, y0, x1, y0 AS y1 FROM dr UNION ALL SELECT {B}, x0, y1, x1, y1 FROM dr UNION ALL SELECT {B}, x0, y0, x0, y1 FROM dr WHERE y0 <> y1 UNION ALL SELECT {B}, x1, y0, x1, y1 FROM dr WHERE y0 <> y1))"""
CLU = f"""WITH RECURSIVE {V.SQL_TOKENS}, v AS (SELECT selection_result_id AS k, box.x0 AS x, row_number() OVER (PARTITION BY selection_result_id ORDER BY box.x0) AS n FROM tokens WHERE box.x0 IS NOT NULL),
      f AS (SELECT k, n, 0::BIGINT AS cluster, x::DOUBLE AS mean, 1::BIGINT AS size FROM v WHERE n = 1
        UNION ALL SELECT f.k, v.n, CASE WHEN abs(v.x - f.mean) > 60 THEN f.cluster + 1 ELSE f.cluster END, CASE WHEN abs(v.x - f.mean) > 60 THEN v.x ELSE (f.mean * f.size + v.x) / (f.size + 1) END, CASE WHEN abs(v.x - f.mean) > 60 THEN 1 ELSE f.size + 1 END FROM f JOIN v ON v.k = f.k AND v.n = f.n + 1),
      c AS (SELECT k, cluster, arg_max(mean, n) AS mean, count(*) AS n FROM f GROUP BY k, cluster)"""
CHAIN = """WITH e AS (SELECT entry_id, min({'b': book, 'l': level, 'p': page_index, 't': title}) AS z FROM toc_entries WHERE book IS NOT NULL AND page_index >= 0 AND entry_id IS NOT NULL GROUP BY entry_id),
      f AS (SELECT z.b AS document, z.p AS page_index, entry_id AS region, z.l AS level, ('0x' || sha256(entry_id)[1:2])::INT AS n FROM e),
      r AS (SELECT document, page_index, region, CASE WHEN n % 3 > 0 THEN 'T' || level END AS label, n % 2 = 0 AS continued, 0.5::DOUBLE + (n % 8) / 100.0::DOUBLE AS anchor, n / 256.0::DOUBLE AS confidence, CASE WHEN n % 5 = 0 THEN 'ruled' ELSE 'unruled' END AS boundary FROM f),
      g AS (SELECT *, coalesce(page_index = lag(page_index) OVER w + 1 AND continued AND (lag(label) OVER w IS NULL OR label = lag(label) OVER w) AND abs(anchor - lag(anchor) OVER w) <= 0.08, false) AS goes_on FROM r WINDOW w AS (PARTITION BY document ORDER BY page_index, region)),
      h AS (SELECT *, sum((NOT goes_on)::INT) OVER (PARTITION BY document ORDER BY page_index, region ROWS UNBOUNDED PRECEDING)::BIGINT - 1 AS chain FROM g)"""

SQL = {
    "detection_outcomes": f"WITH {DET} SELECT id, outcome FROM det",
    "detection_annotations": f"WITH {DET} SELECT {B}, label, id, row_number() OVER (PARTITION BY {B} ORDER BY label, x0, y0, x1, y1, confidence DESC, id) AS annotation, x0 AS x, y0 AS y, x1 - x0 AS width, y1 - y0 AS height, confidence FROM det WHERE outcome = 'accepted'",
    "detector_gate": f"""WITH {DET}, g AS (SELECT {B}, count(*) FILTER (WHERE outcome = 'accepted') AS ok, count(*) FILTER (WHERE outcome = 'unsupported_label') AS un, count(*) FILTER (WHERE outcome = 'below_confidence_threshold') AS low FROM det GROUP BY ALL),
      r AS (SELECT {B}, concat_ws(',', CASE WHEN page_index % 2 = 1 THEN 'deterministic_layout_review_required' END, CASE WHEN ok < 1 THEN 'insufficient_accepted_detections' END, CASE WHEN un + low > 2 THEN 'limitation_bound_exceeded' END, CASE WHEN un > 0 THEN 'unsupported_label_observed' END) AS reasons FROM g)
      SELECT {B}, CASE WHEN reasons = '' THEN 'admitted' ELSE 'escalation_required' END AS status, reasons FROM r""",
    "admitted_regions": f"WITH RECURSIVE {DET}, {_nms(B + ', label')} SELECT {B}, label, k.c AS confidence, k.x0 AS x0, k.y0 AS y0 FROM full_",
    "formula_projection": f"""WITH RECURSIVE {DET}, {_nms(B)}, m AS (SELECT {B}, k.c AS confidence, greatest(0.0::DOUBLE, k.x0 / 2 - 3) AS x0, greatest(0.0::DOUBLE, k.y0 / 2 - 3) AS y0, least(306.0::DOUBLE, k.x1 / 2 + 3) AS x1, least(396.0::DOUBLE, k.y1 / 2 + 3) AS y1 FROM full_)
      SELECT {B}, row_number() OVER (PARTITION BY {B} ORDER BY y0, x0, y1, x1) - 1 AS position, confidence, round(x0, 6) AS x0, round(y0, 6) AS y0, round(x1, 6) AS x1, round(y1, 6) AS y1 FROM m""",
    "order_candidates": f"""WITH {ITEMS}, t AS (SELECT {B}, id, right(id, 1) AS c FROM items) SELECT {B}, concat_ws(',', CASE WHEN bool_or(c = '1') THEN 'duplicate' END, CASE WHEN bool_or(c = '2') THEN 'unknown' END, CASE WHEN bool_or(c = '0') THEN 'incomplete' END) AS problems FROM t GROUP BY {B}""",
    "region_kinds": f"WITH {DET} SELECT id, CASE label WHEN 'primary' THEN 'text' WHEN 'auxiliary' THEN 'figure' ELSE 'other' END AS kind FROM det",
    "table_text_roles": rf"""WITH {V.SQL_BLOCKS}, x AS (SELECT page_id, ordinal::BIGINT AS ordinal, line, nullif(regexp_extract(line, '(?i)^\s*Table\b(?:\s+([A-Za-z]?[0-9]+(?:[.\-][0-9]+)*|[IVXLCDM]+|[A-Za-z])\b)?', 1), '') AS lab,
      CASE WHEN regexp_matches(line, '(?i)^\s*Table\b') THEN CASE WHEN regexp_matches(line, '(?i)\bcontinued\b') THEN 'continuation_label' ELSE 'title' END WHEN regexp_matches(line, '(?i)^\s*Caption\s*[:.]') THEN 'caption' WHEN regexp_matches(line, '(?i)^\s*(?:Note|Notes|Source)\s*[:.]') THEN 'note' END AS role FROM blocks)
      SELECT page_id, ordinal, role, CASE WHEN role IN ('title', 'continuation_label') THEN lab END AS label, CASE WHEN role = 'caption' THEN 0.85::DOUBLE WHEN role = 'note' THEN 0.9::DOUBLE WHEN lab IS NOT NULL THEN 0.95::DOUBLE ELSE 0.8::DOUBLE END AS confidence FROM x WHERE role IS NOT NULL""",
    "rule_segments": f"{SEG} SELECT * FROM seg",
    "table_boundaries": f"{SEG} SELECT {B}, CASE WHEN count(*) FILTER (WHERE orientation = 'horizontal') >= 2 AND count(*) FILTER (WHERE orientation = 'vertical') >= 2 THEN 'ruled' ELSE 'mixed' END AS kind FROM seg GROUP BY {B}",
    "column_anchors": f"{CLU} SELECT k AS selection_result_id, cluster, round(mean, 6) AS mean, n FROM c",
    "column_assignment": f"""{CLU}, m AS (SELECT k, list(mean ORDER BY cluster) AS means FROM c GROUP BY k), b AS (SELECT k, CASE WHEN len(means) < 2 THEN []::DOUBLE[] ELSE list_transform(range(1, len(means)), lambda i: (means[i] + means[i + 1]) / 2) END AS bounds FROM m),
      t AS (SELECT selection_result_id, len(list_filter(bounds, lambda x: (box.x0 + box.x1) / 2 > x)) AS "column" FROM tokens JOIN b ON k = selection_result_id) SELECT selection_result_id, "column", count(*) AS tokens FROM t GROUP BY ALL""",
    "table_chains": f"""{CHAIN} SELECT document, chain, count(*) AS regions, min(page_index)::BIGINT AS first_page, max(page_index)::BIGINT AS last_page, arg_min(label, (page_index, region)) FILTER (WHERE label IS NOT NULL) AS label,
      CASE WHEN count(DISTINCT boundary) = 1 THEN min(boundary) ELSE 'mixed' END AS boundary, min(confidence) AS confidence FROM h GROUP BY document, chain""",
    "table_continuations": f"""{CHAIN} SELECT document, chain, region AS previous, nr AS current, page_index::BIGINT AS previous_page, np::BIGINT AS current_page, least(confidence, nc) AS confidence FROM
      (SELECT *, lead(region) OVER w AS nr, lead(page_index) OVER w AS np, lead(confidence) OVER w AS nc FROM h WINDOW w AS (PARTITION BY document, chain ORDER BY page_index, region)) WHERE nr IS NOT NULL""",
    "repeated_table_headers": r"""WITH p AS (SELECT page_id, min({'b': book, 'i': page_index, 't': text}) AS z FROM pdf WHERE page_index IS NOT NULL AND text IS NOT NULL AND book IS NOT NULL AND page_id IS NOT NULL GROUP BY page_id),
      w AS (SELECT z.b AS candidate, z.i AS page_index, replace(lower(list_filter(regexp_split_to_array(z.t, '\s+'), lambda x: x <> '')[1]), 'ß', 'ss') AS h FROM p),
      f AS (SELECT *, first_value(h IGNORE NULLS) OVER (PARTITION BY candidate ORDER BY page_index ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS first_h FROM w)
      SELECT candidate, count(*) AS regions, count(*) FILTER (WHERE h = first_h) AS repeated FROM f GROUP BY candidate""",
    "figure_captions_nearest": f"""WITH {ITEMS}, p AS (SELECT v.book, v.page_index, v.id AS visual, c.id AS caption, greatest(0.0::DOUBLE, c.y0 - v.y1, v.y0 - c.y1) + 0.5 * greatest(0.0::DOUBLE, c.x0 - v.x1, v.x0 - c.x1) AS d
        FROM items v JOIN items c ON v.book = c.book AND v.page_index = c.page_index WHERE regexp_matches(v.id, '[0-7]$') AND regexp_matches(c.id, '[89a-f]$'))
      SELECT {B}, visual, caption, round(d, 6)::DOUBLE AS distance, round(greatest(0.7::DOUBLE, 1 - d / 720), 6)::DOUBLE AS confidence FROM p WHERE d <= 96 QUALIFY row_number() OVER (PARTITION BY visual ORDER BY d, caption) = 1""",
    "figure_sizes": f"""WITH {V.SQL_TOKENS}, s AS (SELECT selection_result_id, (box.x1 - box.x0) / 30 AS w, (box.y1 - box.y0) / 30 AS h FROM tokens) SELECT selection_result_id, count(*) AS images FROM s WHERE least(w, h) >= 1 AND w * h >= 4 GROUP BY 1""",
    "figure_relevance": "SELECT record_id, CASE WHEN c >= 0.8 THEN 'proposed_necessary' WHEN c >= 0.4 THEN 'proposed_supporting' WHEN c IS NOT NULL THEN 'proposed_not_necessary' END AS level FROM (SELECT record_id, min(completeness) AS c FROM equation_index WHERE record_id IS NOT NULL GROUP BY record_id)",
}
