"""Detections, tables and figures: admission, gates, projection, text roles, rules, clusters, chains, captions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quirewise.functions import contract as K
from quirewise.functions import geometry as G
from quirewise.operators.scans import admit_boxes

# Patterns of table and figure texts.
TABLE_TITLE = r"(?i)^\s*Table\b(?:\s+([A-Za-z]?[0-9]+(?:[.\-][0-9]+)*|[IVXLCDM]+|[A-Za-z])\b)?"
CONTINUED = r"(?i)\bcontinued\b"
CAPTION = r"(?i)^\s*Caption\s*[:.]"
NOTE = r"(?i)^\s*(?:Note|Notes|Source)\s*[:.]"
HEADER_WORD = r"(?i)\bheader\b"


def judged(detections: DataFrame, labels: Sequence[str], least: float) -> DataFrame:
    """detections (label, confidence, ...) with outcome: unsupported_label comes before below_confidence_threshold, the rest is accepted."""
    outcome = F.when(~F.coalesce(F.col("label").isin(*labels), F.lit(False)), "unsupported_label").when(F.coalesce(F.col("confidence") < least, F.lit(True)), "below_confidence_threshold").otherwise("accepted")
    return detections.withColumn("outcome", outcome)


def annotations(accepted: DataFrame, image: Sequence[str], category: str) -> DataFrame:
    """Accepted detections (image, category, id, box, confidence) with their annotation numbers 1..n in each image, by category, box, falling
    confidence and id, and the box as x, y, width, height."""
    b = F.col("box")
    order = Window.partitionBy(*image).orderBy(category, "box.x0", "box.y0", "box.x1", "box.y1", F.col("confidence").desc(), "id")
    return accepted.select(*image, category, "id", F.row_number().over(order).cast("bigint").alias("annotation"), b["x0"].alias("x"), b["y0"].alias("y"), (b["x1"] - b["x0"]).alias("width"), (b["y1"] - b["y0"]).alias("height"), "confidence")


def gate(judgements: DataFrame, reviews: DataFrame, image: Sequence[str], least: int = 1, most_limitations: int = 2) -> DataFrame:
    """(image, status, reasons) of images: judgements (image, outcome), reviews (image, requires_review). Any reason escalates: a review that is
    required, too few accepted detections, too many limitations, a label that isn't supported."""
    counts = judgements.groupBy(*image).agg(*[F.sum((F.col("outcome") == o).cast("bigint")).alias(n) for n, o in (("ok", "accepted"), ("unsupported", "unsupported_label"), ("low", "below_confidence_threshold"))])
    x = reviews.join(counts, list(image), "left").fillna(0, ["ok", "unsupported", "low"])
    named = (
        (F.col("requires_review"), "deterministic_layout_review_required"), (F.col("ok") < least, "insufficient_accepted_detections"), (F.col("unsupported") + F.col("low") > most_limitations, "limitation_bound_exceeded"),
        (F.col("unsupported") > 0, "unsupported_label_observed"),
    )
    reasons = F.array_sort(F.filter(F.array(*[F.when(w, F.lit(n)) for w, n in named]), lambda v: v.isNotNull()))
    return x.select(*image, F.when(F.size(reasons) > 0, "escalation_required").otherwise("admitted").alias("status"), reasons.alias("reasons"))


def projected_formulas(detections: DataFrame, image: Sequence[str], matrix: Sequence[Column], width: float, height: float, least: float = 0.8, iou: float = 0.8, pad: float = 3.0) -> DataFrame:
    """Formulas (image, box, confidence) admitted by score and non-maximum suppression, mapped by a matrix to page points, padded and
    numbered from the top of the page."""
    kept = admit_boxes(detections, list(image), "confidence", "box", iou=iou, least=least)
    mapped = kept.withColumn("box", G.padded(K.mapped_box(F.col("box"), matrix), pad, F.lit(width), F.lit(height)))
    order = Window.partitionBy(*image).orderBy("box.y0", "box.x0", "box.y1", "box.x1")
    return mapped.select(*image, "confidence", "box", (F.row_number().over(order) - 1).cast("bigint").alias("position"))


def order_candidate_problems(orders: DataFrame, elements: DataFrame, page: Sequence[str]) -> DataFrame:
    """(page, problems) of proposed orders (page, id) against the page's elements (page, id): duplicate, unknown, incomplete; empty for a
    permutation."""
    counted = orders.groupBy(*page, "id").agg(F.count("*").alias("n"))
    x = elements.select(*page, "id", F.lit(True).alias("there")).distinct().join(counted, [*page, "id"], "full_outer")
    flag = lambda c: F.max(F.coalesce(c, F.lit(False)).cast("int")) == 1
    y = x.groupBy(*page).agg(flag(F.col("n") > 1).alias("d"), flag(F.col("there").isNull()).alias("u"), flag(F.col("n").isNull()).alias("i"))
    problems = F.filter(F.array(F.when(F.col("d"), F.lit("duplicate")), F.when(F.col("u"), F.lit("unknown")), F.when(F.col("i"), F.lit("incomplete"))), lambda v: v.isNotNull())
    return y.select(*page, problems.alias("problems"))


def table_role(text: Column) -> Column:
    """struct<role, label, confidence> of a table's text: a title (0.95 with a label, else 0.8) or its continuation, a caption (0.85), a note (0.9); else
    null."""
    label = F.nullif(F.regexp_extract(text, TABLE_TITLE, 1), F.lit(""))
    made = lambda role, label, confidence: F.struct(role.alias("role"), label.alias("label"), confidence.alias("confidence"))
    none = F.lit(None).cast("string")
    return (
        F.when(text.rlike(TABLE_TITLE), made(F.when(text.rlike(CONTINUED), "continuation_label").otherwise("title"), label, F.when(label.isNotNull(), 0.95).otherwise(0.80)))
        .when(text.rlike(CAPTION), made(F.lit("caption"), none, F.lit(0.85))).when(text.rlike(NOTE), made(F.lit("note"), none, F.lit(0.90)))
    )


def rule_segments(drawings: DataFrame, page: Sequence[str]) -> DataFrame:
    """Axis-parallel segments of stroked drawings (page, id, box): a rectangle gives its four sides, a line itself; segments of a page count once."""
    b = F.col("box")
    side = lambda x0, y0, x1, y1: F.struct(x0.alias("x0"), y0.alias("y0"), x1.alias("x1"), y1.alias("y1"))
    flat = (b["x0"] == b["x1"]) | (b["y0"] == b["y1"])
    sides = F.array(side(b["x0"], b["y0"], b["x1"], b["y0"]), side(b["x0"], b["y1"], b["x1"], b["y1"]), side(b["x0"], b["y0"], b["x0"], b["y1"]), side(b["x1"], b["y0"], b["x1"], b["y1"]))
    x = drawings.select(*page, F.explode(F.when(flat, F.array(b)).otherwise(sides)).alias("s")).select(*page, "s.*").distinct()
    return x.withColumn("orientation", F.when(F.col("x0") == F.col("x1"), "vertical").otherwise("horizontal"))


def boundary_kinds(segments: DataFrame, page: Sequence[str]) -> DataFrame:
    """(page, kind): ruled from two horizontal and two vertical segments, mixed from one; pages without segments are unruled and have no row."""
    n = lambda o: F.sum((F.col("orientation") == o).cast("int"))
    return segments.groupBy(*page).agg(F.when((n("horizontal") >= 2) & (n("vertical") >= 2), "ruled").otherwise("mixed").alias("kind"))


def value_clusters(values: DataFrame, key: str, tolerance: float = 24.0) -> DataFrame:
    """(key, cluster, mean, n): values (key, value) in order, a new cluster where one is more than `tolerance` from the running mean of the open one.

    The fold depends on its order and runs over one key's values in the JVM; they are those of one page.
    """
    ordered = values.where("value is not null").groupBy(key).agg(F.array_sort(F.collect_list("value")).alias("v"))
    done = "cast(array() as array<struct<mean:double,n:bigint>>)"
    step = f"""(s, x) -> if(size(s) = 0 or abs(x - element_at(s, -1).mean) > {tolerance}, concat(s, array(named_struct('mean', x, 'n', cast(1 as bigint)))),
        concat(slice(s, 1, size(s) - 1), array(named_struct('mean', (element_at(s, -1).mean * element_at(s, -1).n + x) / (element_at(s, -1).n + 1), 'n', element_at(s, -1).n + 1))))"""
    return ordered.select(key, F.posexplode(F.expr(f"aggregate(v, {done}, {step})")).alias("cluster", "c")).select(key, F.col("cluster").cast("bigint").alias("cluster"), "c.mean", "c.n")


def columns_of(items: DataFrame, clusters: DataFrame, key: str) -> DataFrame:
    """items (key, id, box) with the column their middle lies in: bounds lie half way between the clusters' means; the first interval that holds it, else
    the last."""
    means = clusters.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("cluster", "mean"))), lambda c: c["mean"]).alias("means"))
    middle = (F.col("box.x0") + F.col("box.x1")) / 2
    bounds = F.expr("transform(sequence(1, greatest(size(means) - 1, 1)), i -> (means[i - 1] + means[least(i, size(means) - 1)]) / 2)")
    column = F.when(F.size("means") < 2, 0).otherwise(F.aggregate(bounds, F.lit(0), lambda n, b: n + F.when(middle > b, 1).otherwise(0)))
    return items.join(means, key).select(key, "id", column.cast("bigint").alias("column"))


def table_chains(regions: DataFrame) -> DataFrame:
    """regions (document, page_index, region, label, continued, columns, anchors, confidence, boundary) with their chain in the document, counted from 0.

    A region goes on with the one before it in order of page and region if it stands on the next page, says that it continues, doesn't lose or
    change the label, and has as many columns at anchors within 0.08.
    """
    w = Window.partitionBy("document").orderBy("page_index", "region")
    before = F.lag(F.struct("page_index", "label", "columns", "anchors")).over(w)
    x = regions.withColumn("b", before)
    label = F.col("b.label").isNull() | (F.col("label").isNotNull() & (K.label_form(F.col("label")) == K.label_form(F.col("b.label"))))
    near = (F.size("anchors") == F.size("b.anchors")) & F.forall(F.zip_with("anchors", "b.anchors", lambda p, q: F.coalesce(F.abs(p - q) <= 0.08, F.lit(False))), lambda v: v)
    goes_on = (F.col("page_index") == F.col("b.page_index") + 1) & F.col("continued") & label & (F.col("columns") == F.col("b.columns")) & near
    return x.withColumn("opens", (~F.coalesce(goes_on, F.lit(False))).cast("int")).withColumn("chain", (F.sum("opens").over(w.rowsBetween(Window.unboundedPreceding, 0)) - 1).cast("bigint")).drop("b", "opens")


def table_candidates(chained: DataFrame) -> DataFrame:
    """(document, chain, regions, first_page, last_page, label, boundary, confidence): of chains the first label, the boundary all share, else mixed,
    and the least confidence."""
    label = F.min_by("label", F.when(F.col("label").isNotNull(), F.struct("page_index", "region")))
    boundary = F.when(F.count_distinct("boundary") == 1, F.min("boundary")).otherwise("mixed")
    return chained.groupBy("document", "chain").agg(
        F.count("*").alias("regions"), F.min("page_index").cast("bigint").alias("first_page"), F.max("page_index").cast("bigint").alias("last_page"), label.alias("label"), boundary.alias("boundary"), F.min("confidence").alias("confidence")
    )


def continuations(chained: DataFrame) -> DataFrame:
    """Pairs of regions that follow each other in a chain, with the lesser confidence."""
    w = Window.partitionBy("document", "chain").orderBy("page_index", "region")
    after = F.lead(F.struct("region", "page_index", "confidence")).over(w)
    x = chained.withColumn("n", after).where("n is not null")
    return x.select("document", "chain", F.col("region").alias("previous"), F.col("n.region").alias("current"), F.col("page_index").cast("bigint").alias("previous_page"), F.col("n.page_index").cast("bigint").alias("current_page"), F.least("confidence", "n.confidence").alias("confidence"))


def repeated_headers(headers: DataFrame) -> DataFrame:
    """headers (candidate, page_index, texts) with repeated: whether the texts, normalized, are those of the candidate's first region that had some."""
    form = F.transform("texts", lambda t: K.label_form(t))
    w = Window.partitionBy("candidate").orderBy("page_index").rowsBetween(Window.unboundedPreceding, -1)
    x = headers.withColumn("form", F.when(F.size("texts") > 0, form)).withColumn("first", F.first("form", ignorenulls=True).over(w))
    return x.select("candidate", "page_index", F.coalesce(F.col("form") == F.col("first"), F.lit(False)).alias("repeated"))


def nearest_captions(visuals: DataFrame, captions: DataFrame, page: Sequence[str], most: float = 96.0, cell: float = 200.0) -> DataFrame:
    """(page, visual, caption, distance, confidence): of each visual (page, id, box) the caption (page, id, box) at the least distance, the gap down and
    half the gap across, up to `most`; ties go by id. The confidence is 1 - distance / 720, at least 0.7. Both meet through grid cells."""
    reach = lambda low, high, by: F.explode(F.sequence(F.floor((low - by) / cell), F.floor((high + by) / cell)))

    def cells(df: DataFrame, name: str, across: float, down: float) -> DataFrame:
        x = df.select(*page, F.col("id").alias(name), F.col("box").alias(f"{name}_box"), reach(F.col("box.x0"), F.col("box.x1"), across).alias("cx"))
        return x.select("*", reach(F.col(f"{name}_box.y0"), F.col(f"{name}_box.y1"), down).alias("cy"))

    met = cells(visuals, "visual", 2 * most, most).join(cells(captions, "caption", 0.0, 0.0), [*page, "cx", "cy"]).where("visual <> caption")
    a, b = F.col("visual_box"), F.col("caption_box")
    x = met.withColumn("distance", K.gap_down(a, b) + 0.5 * K.gap_across(a, b)).where(F.col("distance") <= most)
    best = x.groupBy(*page, "visual").agg(F.min(F.struct("distance", "caption")).alias("m"))
    return best.select(*page, "visual", "m.caption", F.round("m.distance", 6).alias("distance"), F.round(F.greatest(F.lit(0.7), 1.0 - F.col("m.distance") / 720.0), 6).alias("confidence"))


def relevance_level(score: Column) -> Column:
    return F.when(score >= 0.8, "proposed_necessary").when(score >= 0.4, "proposed_supporting").when(score.isNotNull(), "proposed_not_necessary")
