"""Page layout queries: equation boxes as blocks of pages of 612 by 792 points. A page of the table has one equation, so those of four are laid on one,
each a block of 150 points with the text below it."""

from __future__ import annotations

from pyspark.sql import functions as F

from quirewise.functions import geometry as G
from quirewise.operators import pagelayout as P
from quirewise.sources import views as V
from quirewise.storage import table

PAGE = ["book", "page_index"]


def _items(spark, d):
    once = V.once(table(spark, d, "equation_index").select("record_id", "book", "page_index", "source_bounding_box"), "record_id")
    b = F.col("source_bounding_box")
    return once.where("book is not null and page_index is not null").select("book", F.floor(F.col("page_index") / 4).alias("page_index"), F.col("record_id").alias("id"), G.box(b["x0"], b["y0"], F.least(b["x1"], b["x0"] + 250.0), b["y0"] + 150.0).alias("box"))


def _kinds(spark, d):
    pages = V.pages(spark, d).where("book is not null and page_index is not null").select("book", F.floor(F.col("page_index") / 4).alias("page_index")).distinct()
    return P.page_kinds(pages.select(*PAGE, F.lit(612.0).alias("width"), F.lit(792.0).alias("height"), F.lit(0).alias("rotation")), _items(spark, d), PAGE)


def page_layout_kinds(spark, d):
    return _kinds(spark, d)[0]


def page_layout_order(spark, d):
    return _kinds(spark, d)[1]


def column_splits(spark, d):
    x = P.column_splits(_items(spark, d).withColumn("height", F.lit(792.0)), PAGE)
    return x.select(*PAGE, F.col("cut").cast("bigint").alias("cut"), "gap", "left_width", "right_width", F.round("support", 9).alias("support"))


def overlap_pairs(spark, d):
    return P.overlapping(_items(spark, d), PAGE).select(*PAGE, "a", "b", F.round("area", 6).alias("area"))


def wide_blocks(spark, d):
    """Blocks of at least half the page's width."""
    once = V.once(table(spark, d, "equation_index").select("record_id", "source_bounding_box"), "record_id")
    b = F.col("source_bounding_box")
    return once.where((b["x1"] - b["x0"]) / 612.0 >= P.WIDE).select(F.col("record_id").alias("id"))


def region_order(spark, d):
    return P.column_order(_items(spark, d), PAGE)


def region_order_right_to_left(spark, d):
    return P.column_order(_items(spark, d), PAGE, right_to_left=True)


def reading_order(spark, d):
    """Equations as regions: at the top headers, at the bottom footers, wide ones between titles, some with a kind that has no place."""
    b = F.col("box")
    kind = F.when(b["y1"] <= 230, "header").when(b["y0"] >= 620, "footer").when(F.col("id").rlike("0$"), "other").when(b["x1"] - b["x0"] >= 220, "title").otherwise("text")
    return P.reading_order(_items(spark, d).withColumn("kind", kind), PAGE).withColumn("reasons", F.array_join("reasons", ","))


def _orders(spark, d):
    """Four replicas' orders of a page's equations: from the top, from the left, by id, and by id without every third one."""
    from pyspark.sql import Window

    page = F.concat_ws("#", "book", F.col("page_index").cast("string"))
    x = _items(spark, d).select(page.alias("page"), "id", "box")
    ways = {"top": ["box.y0", "box.x0", "id"], "left": ["box.x0", "box.y0", "id"], "id": ["id"]}
    parts = [x.select("page", F.lit(k).alias("replica"), "id", F.row_number().over(Window.partitionBy("page").orderBy(*v)).alias("position")) for k, v in ways.items()]
    some = parts[2].where("position % 3 > 0").withColumn("replica", F.lit("some"))
    candidate = parts[0].select("page", "id", "position")
    return parts[0].union(parts[1]).union(parts[2]).union(some), candidate


def replica_order_pairs(spark, d):
    return P.replica_pairs(*_orders(spark, d))


def reading_order_agreement(spark, d):
    return P.order_agreement(*_orders(spark, d))


QUERIES = {f.__name__: f for f in (page_layout_kinds, page_layout_order, column_splits, overlap_pairs, wide_blocks, region_order, region_order_right_to_left, reading_order, replica_order_pairs, reading_order_agreement)}

ITEMS = """items0 AS (SELECT record_id AS id, any_value(book) AS book, any_value(page_index) AS page_index, any_value(source_bounding_box) AS bb FROM equation_index WHERE record_id IS NOT NULL GROUP BY record_id),
      items AS (SELECT id, book, floor(page_index / 4)::BIGINT AS page_index, bb.x0 AS x0, bb.y0 AS y0, least(bb.x1, bb.x0 + 250) AS x1, bb.y0 + 150 AS y1 FROM items0 WHERE book IS NOT NULL AND page_index IS NOT NULL)"""


def _split(name: str, source: str, by: str) -> str:
    """CTEs that end in {name}: the best split of each group of {source}."""
    on = lambda a, b: " AND ".join(f"{a}.{c} IS NOT DISTINCT FROM {b}.{c}" for c in by.split(", "))
    left, right = "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING", "ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING"
    return f"""{name}_r AS (SELECT *, row_number() OVER (PARTITION BY {by} ORDER BY x0, x1, id) AS rnk FROM {source}),
      {name}_c AS (SELECT {by}, rnk AS cut, x0 - max(x1) OVER l AS gap, max(x1) OVER l AS le, x0 AS re, max(x1) OVER l - min(x0) OVER l AS lw, max(x1) OVER r - x0 AS rw,
        (max(y1) OVER l - min(y0) OVER l) / 792 AS lh, (max(y1) OVER r - min(y0) OVER r) / 792 AS rh FROM {name}_r WINDOW l AS (PARTITION BY {by} ORDER BY rnk {left}), r AS (PARTITION BY {by} ORDER BY rnk {right})),
      {name}_k AS (SELECT * FROM {name}_c WHERE gap >= 0 AND lh > 0.1 AND rh > 0.1),
      {name}_p AS (SELECT k.*, a.rnk AS ra, b.rnk AS rb, greatest(0.0::DOUBLE, (least(a.y1, b.y1) - greatest(a.y0, b.y0)) / least(a.y1 - a.y0, b.y1 - b.y0)) AS v
        FROM {name}_k k JOIN {name}_r a ON {on("a", "k")} AND a.rnk < k.cut JOIN {name}_r b ON {on("b", "k")} AND b.rnk >= k.cut),
      {name}_s AS (SELECT {by}, cut, min(v) AS support FROM (SELECT {by}, cut, max(v) AS v FROM {name}_p GROUP BY {by}, cut, ra UNION ALL SELECT {by}, cut, max(v) FROM {name}_p GROUP BY {by}, cut, rb) GROUP BY {by}, cut),
      {name} AS (SELECT k.*, s.support FROM {name}_k k JOIN {name}_s s ON {on("k", "s")} AND k.cut = s.cut WHERE support >= 0.25 QUALIFY row_number() OVER (PARTITION BY {", ".join("k." + c for c in by.split(", "))} ORDER BY gap DESC, k.cut) = 1)"""


B = "book, page_index"
LADDER = f"""WITH {V.SQL_PAGES}, {ITEMS}, pg AS (SELECT DISTINCT book, floor(page_index / 4)::BIGINT AS page_index FROM pages WHERE book IS NOT NULL AND page_index IS NOT NULL),
      okay AS (SELECT items.* FROM items JOIN pg USING (book, page_index) WHERE coalesce(least(x0, y0) >= 0 AND x1 > x0 AND y1 > y0, false)),
      bad AS (SELECT {B}, count(*) AS left_out FROM items WHERE NOT coalesce(least(x0, y0) >= 0 AND x1 > x0 AND y1 > y0, false) GROUP BY ALL),
      cnt AS (SELECT {B}, count(*) AS blocks FROM okay GROUP BY ALL),
      crs AS (SELECT a.book, a.page_index, count(*) AS crossings FROM okay a JOIN okay b ON a.book = b.book AND a.page_index = b.page_index AND a.id < b.id AND a.x0 < b.x1 AND b.x0 < a.x1 AND a.y0 < b.y1 AND b.y0 < a.y1 GROUP BY ALL),
      bot AS (SELECT *, y0 / 792 >= 0.78 AND coalesce(min(CASE WHEN y0 / 792 >= 0.78 THEN y0 END) OVER p - max(CASE WHEN y0 / 792 < 0.78 THEN y1 END) OVER p >= 0.025 * 792, false) AS bottom FROM okay WINDOW p AS (PARTITION BY {B})),
      flow AS (SELECT *, (x1 - x0) / 612 >= 0.5 AS wide FROM bot WHERE NOT bottom), narrow AS (SELECT * FROM flow WHERE NOT wide),
      {_split("sp", "narrow", B)}, placed AS (SELECT r.*, CASE WHEN rnk < cut THEN 'left' ELSE 'right' END AS side FROM sp_r r JOIN (SELECT {B}, cut FROM sp) USING (book, page_index)),
      {_split("ns", "(SELECT book, page_index, side, id, x0, y0, x1, y1 FROM placed)", B + ", side")}, nest AS (SELECT {B}, max(gap) AS nested FROM ns GROUP BY {B}),
      wd AS (SELECT flow.*, y1 <= top AND x0 < le AND x1 > re AS spans FROM flow JOIN (SELECT {B}, le, re FROM sp) USING (book, page_index) JOIN (SELECT {B}, min(y0) AS top FROM narrow GROUP BY ALL) USING (book, page_index) WHERE wide),
      spn AS (SELECT {B}, sum(spans::INT) AS spanning, sum((NOT spans)::INT) AS unsupported FROM wd GROUP BY ALL),
      sep AS (SELECT {B}, count(*) FILTER (WHERE g >= 0) AS separate FROM (SELECT {B}, x0 - max(x1) OVER (PARTITION BY {B} ORDER BY x0, x1, id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS g FROM flow) GROUP BY ALL),
      top1 AS (SELECT * FROM (SELECT *, row_number() OVER w AS n, lead(y0) OVER w AS nxt FROM flow WINDOW w AS (PARTITION BY {B} ORDER BY y0, id)) WHERE n = 1 AND y1 <= nxt),
      {_split("br", "(SELECT f.book, f.page_index, f.id, f.x0, f.y0, f.x1, f.y1 FROM flow f JOIN top1 t ON t.book = f.book AND t.page_index = f.page_index AND t.id <> f.id)", B)},
      brd AS (SELECT br.book, br.page_index, true AS bridged FROM br JOIN top1 t ON t.book = br.book AND t.page_index = br.page_index WHERE gap >= 0.04 * 612 AND t.x0 < le AND t.x1 > re),
      hb AS (SELECT {B}, max(bottom::INT) = 1 AS has_bottom FROM bot GROUP BY ALL),
      x AS (SELECT pg.*, blocks, crossings, cut, gap, lw, rw, nested, spanning, unsupported, separate, bridged, coalesce(has_bottom, false) AS has_bottom, coalesce(left_out, 0) AS left_out FROM pg LEFT JOIN cnt USING (book, page_index) LEFT JOIN crs USING (book, page_index)
        LEFT JOIN (SELECT {B}, cut, gap, lw, rw FROM sp) USING (book, page_index) LEFT JOIN nest USING (book, page_index) LEFT JOIN spn USING (book, page_index) LEFT JOIN sep USING (book, page_index) LEFT JOIN brd USING (book, page_index) LEFT JOIN hb USING (book, page_index) LEFT JOIN bad USING (book, page_index)),
      y AS (SELECT *, CASE WHEN blocks IS NULL THEN 'empty' WHEN crossings > 0 THEN 'overlapping_text_boxes' WHEN cut IS NULL AND separate > 0 THEN 'discontinuous_side_groups' WHEN cut IS NULL AND bridged THEN 'bridging_top_block' WHEN cut IS NULL THEN 'one_column'
        WHEN gap < 0.04 * 612 THEN 'weak_column_separation' WHEN nested >= 0.04 * 612 THEN 'more_than_two_column_groups' WHEN unsupported > 0 OR spanning > 1 THEN 'unsupported_spanning_position'
        WHEN least(lw, rw) / greatest(lw, rw) < 0.62 AND least(lw, rw) / 612 < 0.28 THEN 'sidebar' ELSE 'two_columns' END AS reason FROM x)"""
REGIONS = f"""WITH {ITEMS}, o AS (SELECT *, CASE WHEN x0 < max(x1) OVER (PARTITION BY {B} ORDER BY x0, x1, id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS opens FROM items),
      l AS (SELECT *, sum(opens) OVER (PARTITION BY {B} ORDER BY x0, x1, id ROWS UNBOUNDED PRECEDING)::BIGINT AS lane FROM o),
      apart AS (SELECT {B}, min(met) = 0 AS apart FROM (SELECT a.book, a.page_index, a.lane, b.lane AS other, max((a.y0 < b.y1 AND b.y0 < a.y1)::INT) AS met FROM l a JOIN l b ON a.book = b.book AND a.page_index = b.page_index AND a.lane < b.lane GROUP BY ALL) GROUP BY {B}),
      c AS (SELECT *, coalesce(lag(y1) OVER (PARTITION BY {B}, lane ORDER BY y0, x0, id) > y0, false) AS crossed FROM l),
      lanes AS (SELECT {B}, lane, max(x0) >= min(x1) AS spans, max(crossed::INT) = 1 AS crossed FROM c GROUP BY ALL),
      why AS (SELECT {B}, arg_min(CASE WHEN spans THEN 'spanning_region_ambiguous' ELSE 'column_order_ambiguous' END, lane) FILTER (WHERE spans OR crossed) AS why FROM lanes GROUP BY {B}),
      f AS (SELECT why.book, why.page_index, CASE WHEN apart THEN 'column_order_ambiguous' ELSE why END AS reason FROM why LEFT JOIN apart USING (book, page_index))"""
ORDERS = f"""WITH {ITEMS}, x AS (SELECT book || '#' || page_index AS page, id, x0, y0 FROM items),
      a AS (SELECT page, 'top' AS replica, id, row_number() OVER (PARTITION BY page ORDER BY y0, x0, id) AS position FROM x), b AS (SELECT page, 'left' AS replica, id, row_number() OVER (PARTITION BY page ORDER BY x0, y0, id) AS position FROM x),
      c AS (SELECT page, 'id' AS replica, id, row_number() OVER (PARTITION BY page ORDER BY id) AS position FROM x), orders AS (SELECT * FROM a UNION ALL SELECT * FROM b UNION ALL SELECT * FROM c UNION ALL SELECT page, 'some', id, position FROM c WHERE position % 3 > 0),
      j AS (SELECT o.*, a.position AS at FROM orders o JOIN a USING (page, id)),
      q AS (SELECT u.page, u.replica, u.id AS first, v.id AS second, u.position AS pa, v.position AS pb FROM j u JOIN j v ON u.page = v.page AND u.replica = v.replica AND u.at < v.at),
      prs AS (SELECT page, first, second, count(*) FILTER (WHERE pa < pb) AS forward, count(*) FILTER (WHERE pa > pb) AS reverse FROM q GROUP BY ALL HAVING count(*) FILTER (WHERE pa < pb) > 0 AND count(*) FILTER (WHERE pa > pb) > 0)"""

SQL = {
    "page_layout_kinds": f"""{LADDER} SELECT {B}, CASE WHEN reason = 'empty' THEN 'empty' WHEN reason = 'one_column' AND NOT has_bottom THEN 'one_column' WHEN reason = 'two_columns' AND NOT has_bottom THEN 'multi_column' ELSE 'ambiguous' END AS kind, reason,
      round(CASE reason WHEN 'empty' THEN CASE WHEN left_out > 0 THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END WHEN 'one_column' THEN CASE WHEN has_bottom THEN 0.35::DOUBLE WHEN left_out > 0 THEN 0.7::DOUBLE ELSE 0.9::DOUBLE END
      WHEN 'two_columns' THEN CASE WHEN has_bottom THEN 0.35::DOUBLE ELSE least(0.95::DOUBLE, 0.72::DOUBLE + gap / 612, CASE WHEN left_out > 0 THEN 0.7::DOUBLE ELSE 1.0::DOUBLE END) END WHEN 'sidebar' THEN 0.35::DOUBLE ELSE 0.25::DOUBLE END, 6) AS confidence FROM y""",
    "page_layout_order": f"""{LADDER}, z AS (SELECT bot.*, CASE WHEN bottom THEN 'bottom' WHEN reason IN ('two_columns', 'sidebar') AND spans THEN 'spanning' WHEN reason = 'two_columns' THEN side ELSE 'flow' END AS part
        FROM bot JOIN (SELECT {B}, reason FROM y) USING (book, page_index) LEFT JOIN (SELECT id, side FROM placed) USING (id) LEFT JOIN (SELECT id, spans FROM wd) USING (id))
      SELECT {B}, id, part, row_number() OVER (PARTITION BY {B} ORDER BY CASE part WHEN 'spanning' THEN 0 WHEN 'right' THEN 2 WHEN 'bottom' THEN 3 ELSE 1 END, y0, x0, y1, x1, id) - 1 AS position FROM z""",
    "column_splits": f"WITH {ITEMS}, {_split('sp', 'items', B)} SELECT {B}, cut, gap, lw AS left_width, rw AS right_width, round(support, 9) AS support FROM sp",
    "overlap_pairs": f"""WITH {ITEMS} SELECT a.book, a.page_index, a.id AS a, b.id AS b, round((least(a.x1, b.x1) - greatest(a.x0, b.x0)) * (least(a.y1, b.y1) - greatest(a.y0, b.y0)), 6) AS area
      FROM items a JOIN items b ON a.book = b.book AND a.page_index = b.page_index AND a.id < b.id AND a.x0 < b.x1 AND b.x0 < a.x1 AND a.y0 < b.y1 AND b.y0 < a.y1""",
    "wide_blocks": "SELECT DISTINCT record_id AS id FROM equation_index WHERE record_id IS NOT NULL AND (source_bounding_box.x1 - source_bounding_box.x0) / 612 >= 0.5",
    "region_order": f"{REGIONS} SELECT l.book, l.page_index, id, lane, CASE WHEN reason IS NULL THEN row_number() OVER (PARTITION BY l.book, l.page_index ORDER BY lane, y0, x0, id) - 1 END AS position, reason FROM l JOIN f USING (book, page_index)",
    "region_order_right_to_left": f"{REGIONS} SELECT l.book, l.page_index, id, lane, CASE WHEN reason IS NULL THEN row_number() OVER (PARTITION BY l.book, l.page_index ORDER BY lane DESC, y0, x0, id) - 1 END AS position, reason FROM l JOIN f USING (book, page_index)",
    "reading_order": f"""WITH {ITEMS}, k AS (SELECT *, CASE WHEN y1 <= 230 THEN 'header' WHEN y0 >= 620 THEN 'footer' WHEN right(id, 1) = '0' THEN 'other' WHEN x1 - x0 >= 220 THEN 'title' ELSE 'text' END AS kind FROM items),
      q AS (SELECT *, coalesce(kind = 'title' AND y1 <= min(y0) OVER a AND x0 <= min(x0) OVER a AND x1 >= max(x1) OVER a, false) AS leads FROM k WHERE kind NOT IN ('header', 'footer') WINDOW a AS (PARTITION BY {B} ORDER BY y0, x0, id ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)),
      pt AS (SELECT {B}, id, x0, y0, x1, y1, CASE WHEN min(leads::INT) OVER (PARTITION BY {B} ORDER BY y0, x0, id ROWS UNBOUNDED PRECEDING) = 1 THEN 'leading_title' ELSE 'body' END AS part FROM q UNION ALL SELECT {B}, id, x0, y0, x1, y1, kind FROM k WHERE kind IN ('header', 'footer')),
      o AS (SELECT *, CASE WHEN x0 < max(x1) OVER (PARTITION BY {B}, part ORDER BY x0, x1, id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS opens FROM pt),
      l AS (SELECT *, sum(opens) OVER (PARTITION BY {B}, part ORDER BY x0, x1, id ROWS UNBOUNDED PRECEDING)::BIGINT AS lane FROM o),
      ap AS (SELECT {B}, part, min(met) = 0 AS apart FROM (SELECT a.book, a.page_index, a.part, a.lane, b.lane AS other, max((a.y0 < b.y1 AND b.y0 < a.y1)::INT) AS met FROM l a JOIN l b ON a.book = b.book AND a.page_index = b.page_index AND a.part = b.part AND a.lane < b.lane GROUP BY ALL) GROUP BY {B}, part),
      c AS (SELECT *, coalesce(lag(y1) OVER (PARTITION BY {B}, part, lane ORDER BY y0, x0, id) > y0, false) AS crossed FROM l),
      la AS (SELECT {B}, part, lane, max(x0) >= min(x1) AS spans, max(crossed::INT) = 1 AS crossed FROM c GROUP BY ALL),
      why AS (SELECT {B}, part, arg_min(CASE WHEN spans THEN 'spanning_region_ambiguous' ELSE 'column_order_ambiguous' END, lane) FILTER (WHERE spans OR crossed) AS why FROM la GROUP BY {B}, part),
      f AS (SELECT why.book, why.page_index, why.part, CASE WHEN apart THEN 'column_order_ambiguous' ELSE why END AS reason, CASE why.part WHEN 'header' THEN 0 WHEN 'leading_title' THEN 1 WHEN 'body' THEN 2 ELSE 3 END AS level FROM why LEFT JOIN ap USING (book, page_index, part)),
      g AS (SELECT {B}, arg_min(reason, level) FILTER (WHERE reason IS NOT NULL) AS failed FROM f GROUP BY {B}),
      ov AS (SELECT DISTINCT a.book, a.page_index, true AS ovl FROM items a JOIN items b ON a.book = b.book AND a.page_index = b.page_index AND a.id < b.id AND a.x0 < b.x1 AND b.x0 < a.x1 AND a.y0 < b.y1 AND b.y0 < a.y1),
      pg AS (SELECT {B}, max(CASE WHEN kind = 'header' THEN y1 END) > min(CASE WHEN kind <> 'header' THEN y0 END) AS h, min(CASE WHEN kind = 'footer' THEN y0 END) < max(CASE WHEN kind <> 'footer' THEN y1 END) AS ft, bool_or(kind = 'other') AS u FROM k GROUP BY {B}),
      rs AS (SELECT pg.book, pg.page_index, array_to_string(list_sort(list_filter([CASE WHEN h THEN 'header_position_conflict' END, CASE WHEN ft THEN 'footer_position_conflict' END, CASE WHEN u THEN 'unsupported_region_kind' END, CASE WHEN ovl THEN 'overlapping_regions' END, failed], lambda x: x IS NOT NULL)), ',') AS reasons
        FROM pg LEFT JOIN ov USING (book, page_index) LEFT JOIN g USING (book, page_index)),
      ps AS (SELECT l.book, l.page_index, l.id, l.part, f.level, CASE WHEN f.reason IS NULL THEN row_number() OVER (PARTITION BY l.book, l.page_index, l.part ORDER BY lane, y0, x0, id) - 1 END AS pos FROM l JOIN f ON f.book = l.book AND f.page_index = l.page_index AND f.part = l.part)
      SELECT ps.book, ps.page_index, id, part, CASE WHEN reasons = '' THEN row_number() OVER (PARTITION BY ps.book, ps.page_index ORDER BY level, pos, id) - 1 END AS position, reasons FROM ps JOIN rs USING (book, page_index)""",
    "replica_order_pairs": f"{ORDERS} SELECT * FROM prs",
    "reading_order_agreement": f"""{ORDERS}, e AS (SELECT page, replica, count(*) AS n, string_agg(id, ',' ORDER BY position, id) AS claim FROM j GROUP BY ALL), s AS (SELECT page, count(*) AS size FROM a GROUP BY page),
      g AS (SELECT page, count(*) AS replicas, count(DISTINCT claim) AS claims, min(n) AS least_ FROM e GROUP BY page), d AS (SELECT page, count(*) AS disagreements FROM prs GROUP BY page), k AS (SELECT page, count(*) FILTER (WHERE pa > pb) AS contradictions FROM q GROUP BY page)
      SELECT page, replicas, coalesce(contradictions, 0) AS contradictions, coalesce(disagreements, 0) AS disagreements, CASE WHEN least_ = size THEN 'complete' ELSE 'partial' END AS coverage,
      CASE WHEN replicas < 2 THEN 'not_evaluable' WHEN coalesce(disagreements, 0) > 0 THEN 'disagreement' WHEN claims = 1 AND least_ = size THEN 'exact_agreement' ELSE 'consistent_partial' END AS agreement FROM g JOIN s USING (page) LEFT JOIN d USING (page) LEFT JOIN k USING (page)""",
}
