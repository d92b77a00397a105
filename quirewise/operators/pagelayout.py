"""Page layout from block boxes: column splits, the ladder of page kinds, reading order, order of regions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quirewise.functions import geometry as G
from quirewise.operators.scans import bounded
from quirewise.storage import cut

GAP, SUPPORT, FLOW, WIDE, BOTTOM, BOTTOM_GAP, NARROW, BALANCE = 0.04, 0.25, 0.1, 0.5, 0.78, 0.025, 0.28, 0.62


def overlapping(items: DataFrame, by: Sequence[str]) -> DataFrame:
    """Pairs (a, b, a < b) of items (id, box) of one page whose boxes share an area, with that area."""
    a, b = items.select(*by, F.col("id").alias("a"), F.col("box").alias("p")), items.select(*by, F.col("id").alias("b"), F.col("box").alias("q"))
    p, q = F.col("p"), F.col("q")
    meet = (p["x0"] < q["x1"]) & (q["x0"] < p["x1"]) & (p["y0"] < q["y1"]) & (q["y0"] < p["y1"])
    return a.join(b, list(by)).where((F.col("a") < F.col("b")) & meet).select(*by, "a", "b", G.intersection(p, q).alias("area"))


def _ranked(items: DataFrame, by: Sequence[str]) -> DataFrame:
    """items by x0, x1, id, with the right edge of all before each."""
    w = Window.partitionBy(*by).orderBy("box.x0", "box.x1", "id")
    return items.withColumn("rank", F.row_number().over(w)).withColumn("edge", F.max("box.x1").over(w.rowsBetween(Window.unboundedPreceding, -1)))


def _vertical(a, b):
    """Common height of two boxes by the lesser height."""
    common = F.least(a["y1"], b["y1"]) - F.greatest(a["y0"], b["y0"])
    return F.when(common <= 0, 0.0).otherwise(common / F.least(a["y1"] - a["y0"], b["y1"] - b["y0"]))


def column_splits(items: DataFrame, by: Sequence[str], height: str = "height") -> DataFrame:
    """The best split of each page's items into a left and a right column: by, cut (rank of the first right one), gap, left_edge, right_edge,
    left_width, right_width, support; pages without one have no row.

    A cut in the order of x0 leaves a gap of 0 or more, both sides are higher than FLOW of the page, and each item shares at least SUPPORT
    of its height with some item of the other side. The widest gap wins, then the leftmost cut. Pairs are made only for cuts that stand so far.
    """
    by = list(by)
    ranked = _ranked(items, by)
    w = Window.partitionBy(*by).orderBy("rank")
    left, right = w.rowsBetween(Window.unboundedPreceding, -1), w.rowsBetween(0, Window.unboundedFollowing)
    span = lambda o: F.max("box.y1").over(o) - F.min("box.y0").over(o)
    cuts = ranked.select(
        *by, F.col("rank").alias("cut"), (F.col("box.x0") - F.col("edge")).alias("gap"), F.col("edge").alias("left_edge"), F.col("box.x0").alias("right_edge"),
        (F.col("edge") - F.min("box.x0").over(left)).alias("left_width"), (F.max("box.x1").over(right) - F.col("box.x0")).alias("right_width"),
        (span(left) / F.col(height)).alias("lh"), (span(right) / F.col(height)).alias("rh"),
    ).where((F.col("gap") >= 0) & (F.col("lh") > FLOW) & (F.col("rh") > FLOW))
    one = ranked.select(*by, F.col("rank").alias("ra"), F.col("box").alias("a"))
    two = ranked.select(*by, F.col("rank").alias("rb"), F.col("box").alias("b"))
    pairs = cuts.select(*by, "cut").join(one, by).where("ra < cut").join(two, by).where("rb >= cut").withColumn("v", _vertical(F.col("a"), F.col("b")))
    worst = lambda side: pairs.groupBy(*by, "cut", side).agg(F.max("v").alias("v")).groupBy(*by, "cut").agg(F.min("v").alias("v"))
    support = worst("ra").union(worst("rb")).groupBy(*by, "cut").agg(F.min("v").alias("support")).where(F.col("support") >= SUPPORT)
    kept = cuts.join(support, [*by, "cut"])
    names = ["cut", "gap", "left_edge", "right_edge", "left_width", "right_width", "support"]
    return kept.groupBy(*by).agg(F.max_by(F.struct(*names), F.struct("gap", -F.col("cut"))).alias("s")).select(*by, "s.*")


def page_kinds(pages: DataFrame, blocks: DataFrame, by: Sequence[str] = ("page_id",)) -> tuple[DataFrame, DataFrame]:
    """(by, kind, reason, confidence) of pages (by, width, height, rotation), and (by, id, part, position) of their blocks (by, id, box).

    The first that fits: no block (empty), a turned page, blocks that overlap; then, apart from text set off at the bottom, a split of the narrow
    blocks: none leaves separate groups, a bridging top block, or one column; one leaves a weak gap, a split within a column, wide blocks
    that don't span the columns' top, a sidebar, or two columns. What isn't sure is ambiguous. The order is spanning blocks, the left and the
    right column (for others the whole flow), bottom text; within each top to bottom, then left to right. Boxes that aren't valid take no
    part but lower the confidence to 0.7 at most; every page has a row.
    """
    by = list(by)
    judged = bounded(blocks.select(*by, "id", "box"), by).withColumn("valid", G.kind(F.col("box")) == "valid")
    left_out = judged.where("not valid").groupBy(*by).agg(F.count("*").alias("left_out"))
    items = judged.where("valid").drop("valid").join(pages.select(*by, "width", "height"), by)
    count = items.groupBy(*by).agg(F.count("*").alias("blocks"))
    crossing = overlapping(items, by).groupBy(*by).agg(F.count("*").alias("crossings"))
    page = Window.partitionBy(*by)
    low = F.col("box.y0") / F.col("height") >= BOTTOM
    apart = F.min(F.when(low, F.col("box.y0"))).over(page) - F.max(F.when(~low, F.col("box.y1"))).over(page)
    items = items.withColumn("bottom", low & F.coalesce(apart >= BOTTOM_GAP * F.col("height"), F.lit(False)))
    # Read by many branches: written once.
    items = cut(items.withColumn("wide", ~F.col("bottom") & ((F.col("box.x1") - F.col("box.x0")) / F.col("width") >= WIDE)), "items")
    flow = items.where("not bottom")
    narrow = flow.where("not wide")
    split = cut(column_splits(narrow, by), "splits")
    placed = _ranked(narrow, by).join(split.select(*by, "cut"), by).withColumn("side", F.when(F.col("rank") < F.col("cut"), "left").otherwise("right"))
    nested = column_splits(placed.select(*by, "side", "id", "box", "width", "height"), [*by, "side"]).groupBy(*by).agg(F.max("gap").alias("nested"))
    tops = narrow.groupBy(*by).agg(F.min("box.y0").alias("top"))
    wide = flow.where("wide").join(split.select(*by, "left_edge", "right_edge"), by).join(tops, by)
    spans = (F.col("box.y1") <= F.col("top")) & (F.col("box.x0") < F.col("left_edge")) & (F.col("box.x1") > F.col("right_edge"))
    wide = wide.withColumn("spans", spans)
    spanning = wide.groupBy(*by).agg(F.sum(F.col("spans").cast("int")).alias("spanning"), F.sum((~F.col("spans")).cast("int")).alias("unsupported"))
    separate = _ranked(flow, by).groupBy(*by).agg(F.sum((F.col("box.x0") - F.col("edge") >= 0).cast("int")).alias("separate"))
    # Only a block above all others can bridge columns below it, so at most one a page is left out.
    down = Window.partitionBy(*by).orderBy("box.y0", "id")
    first = flow.withColumn("n", F.row_number().over(down)).withColumn("next", F.lead("box.y0").over(down)).where("n = 1 and box.y1 <= next").select(*by, F.col("id").alias("bridge"), F.col("box").alias("over"))
    without = flow.join(first, by).where("id <> bridge")
    bridged = column_splits(without.select(*by, "id", "box", "width", "height"), by).join(first, by).join(pages.select(*by, "width"), by)
    bridged = bridged.where((F.col("gap") >= GAP * F.col("width")) & (F.col("over.x0") < F.col("left_edge")) & (F.col("over.x1") > F.col("right_edge"))).select(*by, F.lit(True).alias("bridged"))
    bottoms = items.groupBy(*by).agg(F.max("bottom").alias("has_bottom"))
    x = pages.select(*by, "width", "height", "rotation")
    for part in (count, crossing, split, nested, spanning, separate, bridged, bottoms, left_out):
        x = x.join(part, by, "left")
    lesser, greater = F.least("left_width", "right_width"), F.greatest("left_width", "right_width")
    whole = F.col("cut").isNull()
    reason = (
        F.when(F.col("blocks").isNull(), "empty").when(F.coalesce("rotation", F.lit(0)) % 360 != 0, "rotated").when(F.col("crossings") > 0, "overlapping_text_boxes")
        .when(whole & (F.col("separate") > 0), "discontinuous_side_groups").when(whole & F.col("bridged"), "bridging_top_block").when(whole, "one_column")
        .when(F.col("gap") < GAP * F.col("width"), "weak_column_separation").when(F.col("nested") >= GAP * F.col("width"), "more_than_two_column_groups")
        .when((F.col("unsupported") > 0) | (F.col("spanning") > 1), "unsupported_spanning_position")
        .when((lesser / greater < BALANCE) & (lesser / F.col("width") < NARROW), "sidebar").otherwise("two_columns")
    )
    x = x.withColumn("reason", reason)
    sure = F.col("reason").isin("one_column", "two_columns") & ~F.coalesce("has_bottom", F.lit(False))
    kind = F.when(F.col("reason") == "empty", "empty").when(sure & (F.col("reason") == "one_column"), "one_column").when(sure, "multi_column").otherwise("ambiguous")
    cap = F.when(F.col("left_out") > 0, 0.7).otherwise(1.0)
    confidence = (
        F.when(F.col("reason") == "empty", F.when(F.col("left_out") > 0, 0.0).otherwise(1.0))
        .when(F.col("reason") == "one_column", F.when(sure, F.least(F.lit(0.9), cap)).otherwise(0.35))
        .when(F.col("reason") == "two_columns", F.when(sure, F.least(F.lit(0.95), 0.72 + F.col("gap") / F.col("width"), cap)).otherwise(0.35))
        .when(F.col("reason") == "sidebar", 0.35).otherwise(0.25)
    )
    kinds = x.select(*by, kind.alias("kind"), "reason", F.round(confidence, 6).alias("confidence"))
    sided = items.join(placed.select(*by, "id", "side"), [*by, "id"], "left").join(wide.select(*by, "id", "spans"), [*by, "id"], "left").join(kinds.select(*by, "reason"), by)
    part = F.when(F.col("bottom"), "bottom").when(F.col("reason").isin("two_columns", "sidebar") & F.col("spans"), "spanning").when(F.col("reason") == "two_columns", F.col("side")).otherwise("flow")
    level = F.element_at(F.create_map(*[F.lit(v) for k, v in (("spanning", 0), ("left", 1), ("flow", 1), ("right", 2), ("bottom", 3)) for v in (k, v)]), F.col("part"))
    order = Window.partitionBy(*by).orderBy("level", "box.y0", "box.x0", "box.y1", "box.x1", "id")
    ordered = sided.withColumn("part", part).withColumn("level", level)
    return kinds, ordered.select(*by, "id", "part", (F.row_number().over(order) - 1).cast("bigint").alias("position"))


def column_order(regions: DataFrame, by: Sequence[str], right_to_left: bool = False) -> DataFrame:
    """(by, id, lane, position, reason): regions (id, box) in columns. Regions of transitive x-overlap are a lane; lanes go from left to right (or the
    other way), within one by y. A page whose lanes don't all meet vertically or whose regions overlap within one is
    `column_order_ambiguous`, one with a lane that has no common x is `spanning_region_ambiguous`; its rows have no position. The lane
    is checked first in reading order.
    """
    by = list(by)
    w = Window.partitionBy(*by).orderBy("box.x0", "box.x1", "id")
    reach = F.max("box.x1").over(w.rowsBetween(Window.unboundedPreceding, -1))
    x = bounded(regions.select(*by, "id", "box"), by).withColumn("opens", F.coalesce(F.col("box.x0") >= reach, F.lit(True)).cast("int"))
    x = x.withColumn("lane", F.sum("opens").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    # Lanes meet if some of their regions do.
    a, b = x.select(*by, F.col("lane").alias("la"), F.col("box").alias("p")), x.select(*by, F.col("lane").alias("lb"), F.col("box").alias("q"))
    met = F.max(((F.col("p.y0") < F.col("q.y1")) & (F.col("q.y0") < F.col("p.y1"))).cast("int"))
    apart = a.join(b, by).where("la < lb").groupBy(*by, "la", "lb").agg(met.alias("met")).groupBy(*by).agg((F.min("met") == 0).alias("apart"))
    down = Window.partitionBy(*by, "lane").orderBy("box.y0", "box.x0", "id")
    x = x.withColumn("crossed", F.coalesce(F.lag("box.y1").over(down) > F.col("box.y0"), F.lit(False)))
    lanes = x.groupBy(*by, "lane").agg((F.max("box.x0") >= F.min("box.x1")).alias("spans"), F.max("crossed").alias("crossed"))
    first = F.min_by(F.when(F.col("spans"), "spanning_region_ambiguous").otherwise("column_order_ambiguous"), F.when(F.col("spans") | F.col("crossed"), F.col("lane")))
    failed = lanes.groupBy(*by).agg(first.alias("why")).join(apart, by, "left").select(*by, F.when(F.col("apart"), "column_order_ambiguous").otherwise(F.col("why")).alias("reason"))
    order = Window.partitionBy(*by).orderBy((-F.col("lane") if right_to_left else F.col("lane")), "box.y0", "box.x0", "id")
    place = (F.row_number().over(order) - 1).cast("bigint")
    return x.join(failed, by).select(*by, "id", F.col("lane").cast("bigint").alias("lane"), F.when(F.col("reason").isNull(), place).alias("position"), "reason")


def replica_pairs(orders: DataFrame, candidate: DataFrame) -> DataFrame:
    """(page, first, second, forward, reverse): pairs in the candidate's order that replicas claim in both directions, with how many claim each.

    orders: page, replica, id, position; candidate: page, id, position. Pairs are those of one page.
    """
    x = orders.join(candidate.select("page", "id", F.col("position").alias("at")), ["page", "id"])
    one = x.select("page", "replica", F.col("id").alias("first"), F.col("at").alias("ca"), F.col("position").alias("pa"))
    two = x.select("page", "replica", F.col("id").alias("second"), F.col("at").alias("cb"), F.col("position").alias("pb"))
    claimed = one.join(two, ["page", "replica"]).where("ca < cb")
    counts = claimed.groupBy("page", "first", "second").agg(F.sum((F.col("pa") < F.col("pb")).cast("bigint")).alias("forward"), F.sum((F.col("pa") > F.col("pb")).cast("bigint")).alias("reverse"))
    return counts.where("forward > 0 and reverse > 0")


def order_agreement(orders: DataFrame, candidate: DataFrame) -> DataFrame:
    """(page, replicas, contradictions, disagreements, coverage, agreement) of the replicas' orders against the candidate's, page by page.

    Fewer than two replicas aren't evaluable; a pair claimed both ways is a disagreement; equal claims of all elements are exact, else
    consistent_partial. Coverage is complete if every replica has all elements.
    """
    pairs = replica_pairs(orders, candidate).groupBy("page").agg(F.count("*").alias("disagreements"))
    x = orders.join(candidate.select("page", "id", F.col("position").alias("at")), ["page", "id"])
    each = x.groupBy("page", "replica").agg(F.count("*").alias("n"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("position", "id"))), lambda e: e["id"].cast("string")), ",").alias("claim"))
    one = x.select("page", "replica", F.col("at").alias("ca"), F.col("position").alias("pa"))
    two = x.select("page", "replica", F.col("at").alias("cb"), F.col("position").alias("pb"))
    against = one.join(two, ["page", "replica"]).where("ca < cb and pa > pb").groupBy("page").agg(F.count("*").alias("contradictions"))
    size = candidate.groupBy("page").agg(F.count("*").alias("size"))
    y = each.groupBy("page").agg(F.count("*").alias("replicas"), F.countDistinct("claim").alias("claims"), F.min("n").alias("least")).join(size, "page").join(pairs, "page", "left").join(against, "page", "left").fillna(0, ["disagreements", "contradictions"])
    agreement = F.when(F.col("replicas") < 2, "not_evaluable").when(F.col("disagreements") > 0, "disagreement").when((F.col("claims") == 1) & (F.col("least") == F.col("size")), "exact_agreement").otherwise("consistent_partial")
    return y.select("page", "replicas", "contradictions", "disagreements", F.when(F.col("least") == F.col("size"), "complete").otherwise("partial").alias("coverage"), agreement.alias("agreement"))


def reading_order(regions: DataFrame, by: Sequence[str], right_to_left: bool = False) -> DataFrame:
    """(by, id, part, position, reasons) of regions (by, id, kind, box): headers, titles above and across everything below them, columns, footers, each
    part in the order of `column_order`. Any reason on a page escalates it: no region of it has a position.

    Reasons: overlapping_regions, header_position_conflict (a header reaches below another region's top), footer_position_conflict,
    unsupported_region_kind (sidebar, other), caption_association_required, footnote_association_required, and those of column_order.
    """
    by = list(by)
    x = bounded(regions.select(*by, "id", "kind", "box"), by)
    overlaps = overlapping(x, by).select(*by).distinct().withColumn("overlaps", F.lit(True))
    of = lambda kind, f, c: f(F.when(F.col("kind") == kind, F.col(c)))
    no = lambda kind, f, c: f(F.when(F.col("kind") != kind, F.col(c)))
    has = lambda *kinds: F.max(F.col("kind").isin(*kinds).cast("int")) == 1
    page = x.groupBy(*by).agg(
        (of("header", F.max, "box.y1") > no("header", F.min, "box.y0")).alias("h"), (of("footer", F.min, "box.y0") < no("footer", F.max, "box.y1")).alias("f"),
        has("sidebar", "other").alias("u"), has("caption").alias("c"), has("footnote").alias("n"),
    ).join(overlaps, by, "left")
    # A title leads if it lies above and across all regions of the body that come after it, and all before it do.
    body = Window.partitionBy(*by).orderBy("box.y0", "box.x0", "id")
    after = body.rowsBetween(1, Window.unboundedFollowing)
    inner = x.where(~F.col("kind").isin("header", "footer"))
    leads = (F.col("kind") == "title") & (F.col("box.y1") <= F.min("box.y0").over(after)) & (F.col("box.x0") <= F.min("box.x0").over(after)) & (F.col("box.x1") >= F.max("box.x1").over(after))
    inner = inner.withColumn("leads", F.coalesce(leads, F.lit(False)).cast("int"))
    inner = inner.withColumn("part", F.when(F.min("leads").over(body.rowsBetween(Window.unboundedPreceding, 0)) == 1, "leading_title").otherwise("body"))
    outer = x.where(F.col("kind").isin("header", "footer")).withColumn("part", F.col("kind"))
    parts = cut(inner.drop("leads").unionByName(outer), "parts")
    ordered = column_order(parts, [*by, "part"], right_to_left)
    level = F.element_at(F.create_map(*[F.lit(v) for k, v in (("header", 0), ("leading_title", 1), ("body", 2), ("footer", 3)) for v in (k, v)]), F.col("part"))
    failed = ordered.where("reason is not null").groupBy(*by).agg(F.min_by("reason", level).alias("failed"))
    page = page.join(failed, by, "left")
    named = (("h", "header_position_conflict"), ("f", "footer_position_conflict"), ("u", "unsupported_region_kind"), ("c", "caption_association_required"), ("n", "footnote_association_required"), ("overlaps", "overlapping_regions"))
    reasons = F.array_sort(F.filter(F.array(*[F.when(F.col(k), F.lit(v)) for k, v in named], F.col("failed")), lambda v: v.isNotNull()))
    place = F.row_number().over(Window.partitionBy(*by).orderBy(level, "position", "id")) - 1
    y = ordered.join(page.select(*by, reasons.alias("reasons")), by)
    return y.select(*by, "id", "part", F.when(F.size("reasons") == 0, place.cast("bigint")).alias("position"), "reasons")
