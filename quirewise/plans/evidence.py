"""Evidence queries: scanned lines and tokens, transcripts, the journal, streams as batches."""

from __future__ import annotations

from pyspark.sql import functions as F

from quirewise.functions import geometry as G
from quirewise.functions.text import FIGURE_CAPTION
from quirewise.operators import journal as J
from quirewise.operators import scans as S
from quirewise.operators import transcript as T
from quirewise.operators.corpus import block_shift
from quirewise.sources import views as V
from quirewise.storage import table
from quirewise.streaming import events as E


def geometry_classify(spark, d):
    """Boxes of scanned lines, every seventh turned upside down and every eleventh moved off the page."""
    b, n = F.col("box"), F.col("order")
    moved = G.box(b.x0 - F.when(n % 11 == 0, 5000).otherwise(0), F.when(n % 7 == 0, b.y1).otherwise(b.y0), b.x1, F.when(n % 7 == 0, b.y0).otherwise(b.y1))
    return V.ocr_lines(spark, d).select(G.kind(moved).alias("kind")).groupBy("kind").agg(F.count("*").alias("rows"))


def ocr_line_assembly(spark, d):
    x = S.assemble_lines(V.ocr_tokens(spark, d))
    return x.select("selection_result_id", F.col("line_order").cast("bigint").alias("line_order"), "text", "box.x0", "box.y0", "box.x1", "box.y1", "confidence")


def reading_order_inversions(spark, d):
    return S.inversions(V.ocr_lines(spark, d))


def block_region_overlap(spark, d):
    x = S.region_overlaps(V.ocr_lines(spark, d), V.ocr_tokens(spark, d))
    return x.select("selection_result_id", F.col("order").cast("bigint").alias("order"), "regions", "share")


def horizontal_components(spark, d):
    return S.islands(V.ocr_tokens(spark, d), "selection_result_id", F.col("box.x0"), F.col("box.x1"))


def row_gap_groups(spark, d):
    return S.gap_groups(V.ocr_lines(spark, d), 45.0)


def column_split(spark, d):
    return S.column_split(V.ocr_tokens(spark, d))


def table_row_clusters(spark, d):
    return S.running_mean_rows(V.ocr_tokens(spark, d))


def repeated_margin_keys(spark, d):
    return S.repeated_margins(V.ocr_lines(spark, d), V.pages(spark, d).select("page_id", "book").distinct())


def merged_stream(spark, d):
    native = V.pages(spark, d).where("extraction_method = 'ocr'").select("page_id", F.posexplode(F.split("text", "\n", -1)).alias("ordinal", "line"))
    latest = V.ocr_lines(spark, d).groupBy("page_id", "order").agg(F.min("text").alias("text"))
    return S.merged_stream(native, latest).groupBy("page_id", "kind").agg(F.count("*").alias("lines"), F.max("position").alias("last_position"))


def region_mapping(spark, d):
    """Line boxes in points at 144 dpi, padded by 6 within a page of 612 by 792."""
    b = G.padded(G.to_points(F.col("box")), 6.0, F.lit(612.0), F.lit(792.0))
    x = V.ocr_lines(spark, d).select("selection_result_id", F.col("order").cast("bigint").alias("order"), b.alias("b"))
    return x.select("selection_result_id", "order", *[F.round(f"b.{c}", 6).alias(c) for c in ("x0", "y0", "x1", "y1")])


def union_boxes(spark, d):
    x = V.ocr_lines(spark, d).groupBy("page_id").agg(G.union_of(F.col("box")).alias("b"))
    return x.select("page_id", "b.*")


def hyphen_decisions(spark, d):
    return T.hyphen_decisions(V.pages(spark, d).select(F.col("page_id").alias("doc_id"), "text"))


def toc_heading_matches(spark, d):
    toc = table(spark, d, "toc_entries").distinct().where("page_index is not null")
    return T.toc_matches(toc, V.blocks(spark, d))


def figure_captions(spark, d):
    hit = F.col("line").rlike(FIGURE_CAPTION)
    return V.blocks(spark, d).where(hit).select("page_id", F.col("ordinal").cast("bigint").alias("ordinal"), F.regexp_extract("line", FIGURE_CAPTION, 2).alias("label"))


def private_use_glyphs(spark, d):
    scan = V.pages(spark, d).select("page_id", F.regexp_count("text", F.lit(r"\p{Co}")).alias("private"), F.regexp_count("text", F.lit(r"[\x{00}-\x{08}\x{0b}\x{0c}\x{0e}-\x{1f}\x{7f}\x{ad}]")).alias("control"))
    return scan.where("private + control > 0").select("page_id", F.col("private").cast("bigint").alias("private"), F.col("control").cast("bigint").alias("control"))


def _journal(spark, d):
    orders = table(spark, d, "orders")
    sha = lambda k, p: F.sha2(F.concat_ws("|", k.cast("string"), F.format_string("%.2f", p)), 256)
    before = orders.select((F.col("o_orderkey") + 1).alias("sequence"), sha(F.col("o_orderkey"), F.col("o_totalprice")).alias("previous_record_sha256"))
    records = orders.select(F.col("o_orderkey").alias("sequence"), sha(F.col("o_orderkey"), F.col("o_totalprice")).alias("record_sha256"))
    joined = records.join(before, "sequence", "left")
    # A fault is put in at every thousandth record, to be found again.
    return joined.withColumn("previous_record_sha256", F.when(F.col("sequence") % 1000 == 0, F.lit("0" * 64)).otherwise(F.col("previous_record_sha256")))


def journal_chain(spark, d):
    return J.chain_breaks(_journal(spark, d), F.shiftright("sequence", block_shift(table(spark, d, "orders"), "o_orderkey")))


def journal_publication(spark, d):
    """Half of the orders are in the journal, some with another payload."""
    orders = table(spark, d, "orders")
    journal = orders.where("o_orderkey % 2 = 0").select(F.col("o_orderkey").alias("request_id"), F.when(F.col("o_orderkey") % 10 == 0, "other").otherwise(F.col("o_orderstatus")).alias("payload_sha256"))
    requests = orders.select(F.col("o_orderkey").alias("request_id"), F.col("o_orderstatus").alias("payload_sha256"))
    return J.publish(journal, requests)


def event_windows(spark, d):
    return E.windowed_counts(table(spark, d, "events"))


def event_sessions(spark, d):
    return E.session_counts(table(spark, d, "events"))


QUERIES = {f.__name__: f for f in (
    geometry_classify, ocr_line_assembly, reading_order_inversions, block_region_overlap, horizontal_components, row_gap_groups, column_split, table_row_clusters, repeated_margin_keys, merged_stream, region_mapping, union_boxes,
    hyphen_decisions, toc_heading_matches, figure_captions, private_use_glyphs, journal_chain,
    journal_publication, event_windows, event_sessions)}


def _clean(x: str) -> str:
    return rf"trim(regexp_replace(replace(regexp_replace({x}, '[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]', ' ', 'g'), chr(173), ''), '[\s\x{{a0}}\x{{2000}}-\x{{200a}}\x{{202f}}\x{{3000}}]+', ' ', 'g'), ' ')"


def _matched(x: str) -> str:
    from quirewise.plans.contracts import _collapsed, _compatible

    return _collapsed(f"replace(lower({_compatible(x)}), 'ß', 'ss')")


def _value(x: str) -> str:
    c = f"lower({_clean(x)})"
    digit = "(CASE c WHEN 'i' THEN 1 WHEN 'v' THEN 5 WHEN 'x' THEN 10 WHEN 'l' THEN 50 WHEN 'c' THEN 100 WHEN 'd' THEN 500 WHEN 'm' THEN 1000 END)"
    values = f"list_transform(string_split({c}, ''), lambda c: {digit})"
    return rf"""CASE WHEN regexp_matches({c}, '^[0-9]{{1,9}}$') THEN TRY_CAST({c} AS BIGINT) WHEN regexp_matches({c}, '^[ivxlcdm]+$') THEN
      list_sum(list_transform(list_zip({values}, {values}[2:]), lambda p: CASE WHEN p[1] < coalesce(p[2], 0) THEN -p[1] ELSE p[1] END))::BIGINT END"""


SQL = {
    "geometry_classify": f"""WITH {V.SQL_LINES}, m AS (SELECT box.x0 - CASE WHEN "order" % 11 = 0 THEN 5000 ELSE 0 END AS x0, CASE WHEN "order" % 7 = 0 THEN box.y1 ELSE box.y0 END AS y0, box.x1 AS x1,
      CASE WHEN "order" % 7 = 0 THEN box.y0 ELSE box.y1 END AS y1 FROM lines)
      SELECT CASE WHEN x0 IS NULL OR y0 IS NULL OR x1 IS NULL OR y1 IS NULL THEN 'malformed' WHEN least(x0, y0, x1, y1) < 0 THEN 'negative_coordinate' WHEN x1 < x0 OR y1 < y0 THEN 'unordered'
      WHEN (x1 - x0) * (y1 - y0) <= 0 THEN 'non_positive_area' ELSE 'valid' END AS kind, count(*) AS rows FROM m GROUP BY 1""",
    "ocr_line_assembly": f"""WITH {V.SQL_TOKENS} SELECT selection_result_id, line_order::BIGINT AS line_order, string_agg(text, ' ' ORDER BY "order", text) AS text, min(box.x0) AS x0, min(box.y0) AS y0, max(box.x1) AS x1, max(box.y1) AS y1,
      CASE WHEN count(confidence) = count(*) THEN round(avg(confidence), 6) END AS confidence FROM tokens GROUP BY selection_result_id, line_order""",
    "reading_order_inversions": f"""WITH {V.SQL_LINES} SELECT a.selection_result_id, count(*) AS pairs, count(*) FILTER (WHERE a.box.y0 > b.box.y0 OR (a.box.y0 = b.box.y0 AND a.box.x0 > b.box.x0)) AS inversions
      FROM lines a JOIN lines b ON a.selection_result_id = b.selection_result_id AND a."order" < b."order" GROUP BY 1""",
    "block_region_overlap": f"""WITH {V.SQL_TOKENS}, lines AS (SELECT selection_result_id, x."order" AS "order", x.pixel_bounding_box AS box FROM (SELECT selection_result_id, unnest(lines) AS x FROM ocr)),
      p AS (SELECT l.selection_result_id, l."order", round(greatest(0.0, least(l.box.x1, t.box.x1) - greatest(l.box.x0, t.box.x0)) * greatest(0.0, least(l.box.y1, t.box.y1) - greatest(l.box.y0, t.box.y0))
      / ((l.box.x1 - l.box.x0) * (l.box.y1 - l.box.y0)), 12) AS share FROM lines l JOIN tokens t USING (selection_result_id))
      SELECT selection_result_id, "order"::BIGINT AS "order", count(*) FILTER (WHERE share >= 0.5) AS regions, max(share) AS share FROM p GROUP BY 1, 2""",
    "horizontal_components": f"""WITH {V.SQL_TOKENS}, s AS (SELECT selection_result_id AS k, box.x0 AS low, box.x1 AS high FROM tokens),
      o AS (SELECT *, CASE WHEN low >= max(high) OVER (PARTITION BY k ORDER BY low, high ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) IS NOT FALSE THEN 1 ELSE 0 END AS opens FROM s),
      i AS (SELECT *, sum(opens) OVER (PARTITION BY k ORDER BY low, high ROWS UNBOUNDED PRECEDING)::BIGINT AS island FROM o)
      SELECT k AS selection_result_id, island, min(low) AS low, max(high) AS high, count(*) AS members FROM i GROUP BY k, island""",
    "row_gap_groups": f"""WITH {V.SQL_LINES}, c AS (SELECT *, (box.y0 + box.y1) / 2 AS m FROM lines),
      o AS (SELECT *, CASE WHEN m - lag(m) OVER w > 45 IS NOT FALSE THEN 1 ELSE 0 END AS opens FROM c WINDOW w AS (PARTITION BY selection_result_id ORDER BY m, "order")),
      g AS (SELECT *, sum(opens) OVER (PARTITION BY selection_result_id ORDER BY m, "order" ROWS UNBOUNDED PRECEDING)::BIGINT AS grp FROM o)
      SELECT selection_result_id, grp AS "group", count(*) AS lines, min(box.y0) AS y0, max(box.y1) AS y1 FROM g GROUP BY 1, 2""",
    "column_split": f"""WITH {V.SQL_TOKENS}, p AS (SELECT selection_result_id, box.x0 AS x0, row_number() OVER w AS n, count(*) OVER (PARTITION BY selection_result_id) AS al,
      max(box.x1) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM tokens WINDOW w AS (PARTITION BY selection_result_id ORDER BY box.x0, box.x1, "order"))
      SELECT selection_result_id, max(x0 - reach) AS gap FROM p WHERE n - 1 >= 0.25 * al AND al - n + 1 >= 0.25 * al AND x0 - reach >= 0 GROUP BY 1""",
    "table_row_clusters": f"""WITH RECURSIVE {V.SQL_TOKENS}, v AS (SELECT selection_result_id AS k, (box.y0 + box.y1) / 2 AS y, row_number() OVER (PARTITION BY selection_result_id ORDER BY (box.y0 + box.y1) / 2, "order") AS n FROM tokens),
      f AS (SELECT k, n, y::DOUBLE AS mean, 1::BIGINT AS size, 1::BIGINT AS rows FROM v WHERE n = 1 UNION ALL SELECT f.k, v.n, CASE WHEN abs(v.y - f.mean) > 18 THEN v.y ELSE (f.mean * f.size + v.y) / (f.size + 1) END,
        CASE WHEN abs(v.y - f.mean) > 18 THEN 1 ELSE f.size + 1 END, CASE WHEN abs(v.y - f.mean) > 18 THEN f.rows + 1 ELSE f.rows END FROM f JOIN v ON v.k = f.k AND v.n = f.n + 1)
      SELECT k AS selection_result_id, max(rows) AS rows FROM f GROUP BY k""",
    "repeated_margin_keys": f"""WITH {V.SQL_LINES}, {V.SQL_PAGES}, h AS (SELECT *, max(box.y1) OVER (PARTITION BY page_id) AS height FROM lines), b AS (SELECT DISTINCT page_id, book FROM pages),
      n AS (SELECT book, count(*) AS n FROM b WHERE page_id IN (SELECT page_id FROM lines) GROUP BY book),
      k AS (SELECT b.book, page_id, regexp_replace(lower({_clean("text")}), '[0-9]+', '#', 'g') AS key FROM h JOIN b USING (page_id) WHERE box.y1 <= 0.12 * height OR box.y0 >= (1 - 0.12) * height)
      SELECT book, key, count(DISTINCT page_id) AS pages FROM k JOIN n USING (book) WHERE key <> '' GROUP BY book, key HAVING count(DISTINCT page_id) >= greatest(3, ceil(any_value(n.n) * 0.2))""",
    "merged_stream": f"""WITH {V.SQL_LINES}, {V.SQL_PAGES}, nat AS (SELECT page_id, ordinal, {_matched("line")} AS key FROM (SELECT page_id, unnest(string_split(text, chr(10))) AS line,
      generate_subscripts(string_split(text, chr(10)), 1) - 1 AS ordinal FROM pages WHERE extraction_method = 'ocr')), o AS (SELECT page_id, ord, {_matched("text")} AS key FROM (SELECT page_id, "order" AS ord, min(text) AS text FROM lines GROUP BY 1, 2)),
      l AS (SELECT *, row_number() OVER (PARTITION BY page_id, key ORDER BY ordinal) AS k FROM nat WHERE key <> ''), r AS (SELECT *, row_number() OVER (PARTITION BY page_id, key ORDER BY ord) AS k FROM o WHERE key <> ''),
      m AS (SELECT coalesce(l.page_id, r.page_id) AS page_id, CASE WHEN r.ord IS NULL THEN 'native_only' WHEN l.ordinal IS NULL THEN 'ocr_only' ELSE 'duplicate' END AS kind, ordinal, ord
      FROM l FULL JOIN r ON l.page_id = r.page_id AND l.key = r.key AND l.k = r.k),
      p AS (SELECT page_id, kind, row_number() OVER (PARTITION BY page_id ORDER BY ordinal NULLS LAST, ord NULLS LAST) - 1 AS position FROM m)
      SELECT page_id, kind, count(*) AS lines, max(position) AS last_position FROM p GROUP BY 1, 2""",
    "region_mapping": f"""WITH {V.SQL_LINES} SELECT selection_result_id, "order"::BIGINT AS "order", round(greatest(0.0, box.x0 * 72.0 / 144.0 - 6), 6) AS x0, round(greatest(0.0, box.y0 * 72.0 / 144.0 - 6), 6) AS y0,
      round(least(612.0, box.x1 * 72.0 / 144.0 + 6), 6) AS x1, round(least(792.0, box.y1 * 72.0 / 144.0 + 6), 6) AS y1 FROM lines""",
    "union_boxes": f"WITH {V.SQL_LINES} SELECT page_id, min(box.x0) AS x0, min(box.y0) AS y0, max(box.x1) AS x1, max(box.y1) AS y1 FROM lines GROUP BY page_id",
    "hyphen_decisions": f"""WITH {V.SQL_PAGES}, hits AS (SELECT page_id, text, unnest(regexp_extract_all(text, '[A-Za-z]{{2,}}-[ \\t]*\\n\\s*[a-z][A-Za-z]*')) AS hit FROM pages),
      w AS (SELECT page_id, ' ' || regexp_replace(lower(text), '[^\\p{{L}}\\p{{N}}\\-]+', ' ', 'g') || ' ' AS words, lower(regexp_extract(hit, '^([A-Za-z]+)-', 1)) AS l, lower(regexp_extract(hit, '([a-z][A-Za-z]*)$', 1)) AS r FROM hits)
      SELECT page_id AS doc_id, l AS "left", r AS "right", CASE WHEN contains(words, ' ' || l || r || ' ') AND NOT contains(words, ' ' || l || '-' || r || ' ') THEN 'join'
      WHEN contains(words, ' ' || l || '-' || r || ' ') AND NOT contains(words, ' ' || l || r || ' ') THEN 'keep_hyphen' ELSE 'keep_break' END AS decision, count(*) AS n FROM w GROUP BY 1, 2, 3, 4""",
    "toc_heading_matches": f"""WITH {V.SQL_BLOCKS}, t AS (SELECT DISTINCT *, lower(regexp_replace({_clean("title")}, '^[0-9.]+\\s+', '')) AS key FROM toc_entries WHERE page_index IS NOT NULL),
      l AS (SELECT *, lower(regexp_replace({_clean("line")}, '^[0-9.]+\\s+', '')) AS key FROM blocks)
      SELECT entry_id, min(page_id) AS page_id, min(ordinal)::BIGINT AS ordinal FROM t JOIN l USING (book, page_index, key) WHERE key <> '' GROUP BY entry_id HAVING count(*) = 1""",
    "figure_captions": f"""WITH {V.SQL_BLOCKS} SELECT page_id, ordinal::BIGINT AS ordinal, regexp_extract(line, '(?i)^\\s*(Figure\\b|Fig\\.)\\s*([A-Za-z]?[0-9]+(?:[.\\-][0-9]+)*|[IVXLCDM]+)?', 2) AS label
      FROM blocks WHERE regexp_matches(line, '(?i)^\\s*(Figure\\b|Fig\\.)')""",
    "private_use_glyphs": f"""WITH {V.SQL_PAGES}, s AS (SELECT page_id, length(regexp_extract_all(text, '\\p{{Co}}'))::BIGINT AS private, length(regexp_extract_all(text, '[\\x00-\\x08\\x0b\\x0c\\x0e-\\x1f\\x7f\\x{{ad}}]'))::BIGINT AS control FROM pages)
      SELECT * FROM s WHERE private + control > 0""",
    "journal_chain": """WITH r AS (SELECT o_orderkey AS sequence, sha256(o_orderkey || '|' || printf('%.2f', o_totalprice)) AS sha FROM orders),
      j AS (SELECT r.sequence, r.sha, CASE WHEN r.sequence % 1000 = 0 THEN repeat('0', 64) ELSE p.sha END AS prev FROM r LEFT JOIN r p ON p.sequence + 1 = r.sequence),
      c AS (SELECT *, lag(sha) OVER (ORDER BY sequence) AS last_sha, lag(sequence) OVER (ORDER BY sequence) AS last_at FROM j)
      SELECT sequence, reason FROM (SELECT sequence, CASE WHEN last_at IS NULL AND prev IS NOT NULL THEN 'first_with_previous' WHEN last_at IS NOT NULL AND sequence <> last_at + 1 THEN 'sequence_gap'
      WHEN prev IS DISTINCT FROM last_sha THEN 'digest_mismatch' END AS reason FROM c) WHERE reason IS NOT NULL""",
    "journal_publication": """SELECT o_orderkey AS request_id, o_orderstatus AS payload_sha256, CASE WHEN o_orderkey % 2 <> 0 THEN 'new' WHEN o_orderkey % 10 = 0 AND o_orderstatus <> 'other' THEN 'conflict' ELSE 'replay' END AS disposition FROM orders""",
    "event_windows": "SELECT time_bucket(INTERVAL 1 hour, ts) AS window_start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2",
    "event_sessions": """WITH o AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER w < INTERVAL 30 minutes THEN 0 ELSE 1 END AS opens FROM events WHERE user_id IS NOT NULL AND ts IS NOT NULL WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
      s AS (SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM o) SELECT user_id, min(ts) AS session_start, count(*) AS n FROM s GROUP BY user_id, k""",
}
