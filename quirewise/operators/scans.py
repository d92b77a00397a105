"""Scanned evidence: assembling, ordering, grouping and reconciling lines and tokens with boxes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quirewise.functions import geometry as G
from quirewise.functions.contract import matched_form
from quirewise.functions.text import margin_key


#: Items a page or result may have where its pairs are made; more raise an error before any is.
MOST_ITEMS = 512


def bounded(items: DataFrame, by, most: int = MOST_ITEMS) -> DataFrame:
    """items, or an error if a page has more than `most` of them."""
    n = F.count("*").over(Window.partitionBy(*by))
    checked = F.when(n > most, F.raise_error(F.lit("more items on a page than the limit")).cast("boolean")).otherwise(F.lit(True))
    return items.withColumn("_fits", checked).where("_fits").drop("_fits")


def assemble_lines(tokens: DataFrame) -> DataFrame:
    """Lines of tokens: texts joined in order, the box around them, the mean confidence if all have one."""
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("order", "text"))), lambda x: x["text"]), " ")
    confidence = F.when(F.count("confidence") == F.count("*"), F.round(F.avg("confidence"), 6))
    return tokens.groupBy("selection_result_id", "line_order").agg(text.alias("text"), G.union_of(F.col("box")).alias("box"), confidence.alias("confidence"))


def inversions(lines: DataFrame) -> DataFrame:
    """By result: pairs of lines whose given order is against top-then-left order."""
    lines = bounded(lines, ["selection_result_id"])
    a, b = lines.select("selection_result_id", F.col("order").alias("oa"), F.col("box").alias("ba")), lines.select("selection_result_id", F.col("order").alias("ob"), F.col("box").alias("bb"))
    against = (F.col("ba.y0") > F.col("bb.y0")) | ((F.col("ba.y0") == F.col("bb.y0")) & (F.col("ba.x0") > F.col("bb.x0")))
    return a.join(b, "selection_result_id").where(F.col("oa") < F.col("ob")).groupBy("selection_result_id").agg(F.count("*").alias("pairs"), F.sum(against.cast("bigint")).alias("inversions"))


def region_overlaps(blocks: DataFrame, regions: DataFrame, least: float = 0.5) -> DataFrame:
    """Blocks against regions of one result: by block the regions it lies in by at least `least` of its area, and its greatest share."""
    share = F.round(G.intersection(F.col("a"), F.col("b")) / G.area(F.col("a")), 12)
    blocks = bounded(blocks, ["selection_result_id"])
    pairs = blocks.select("selection_result_id", "order", F.col("box").alias("a")).join(regions.select("selection_result_id", F.col("box").alias("b")), "selection_result_id").withColumn("share", share)
    return pairs.groupBy("selection_result_id", "order").agg(F.sum((F.col("share") >= least).cast("bigint")).alias("regions"), F.max("share").alias("share"))


def islands(items: DataFrame, key: str, low: Column, high: Column) -> DataFrame:
    """Connected intervals within a key, exact without iteration: an interval that begins at or after all ends before it opens a new one."""
    spans = items.select(key, low.alias("low"), high.alias("high"))
    w = Window.partitionBy(key).orderBy("low", "high")
    reach = F.max("high").over(w.rowsBetween(Window.unboundedPreceding, -1))
    opened = spans.withColumn("opens", (reach.isNull() | (F.col("low") >= reach)).cast("int")).withColumn("island", F.sum("opens").over(w.rowsBetween(Window.unboundedPreceding, 0)).cast("bigint"))
    return opened.groupBy(key, "island").agg(F.min("low").alias("low"), F.max("high").alias("high"), F.count("*").alias("members"))


def gap_groups(lines: DataFrame, gap: float) -> DataFrame:
    """Lines in groups by vertical gaps between their centres: a gap above `gap` opens a group."""
    centre = (F.col("box.y0") + F.col("box.y1")) / 2
    w = Window.partitionBy("selection_result_id").orderBy("centre", "order")
    placed = lines.withColumn("centre", centre).withColumn("opens", F.coalesce(F.col("centre") - F.lag("centre").over(w) > gap, F.lit(True)).cast("int"))
    return placed.withColumn("group", F.sum("opens").over(w.rowsBetween(Window.unboundedPreceding, 0)).cast("bigint")).groupBy("selection_result_id", "group").agg(F.count("*").alias("lines"), F.min("box.y0").alias("y0"), F.max("box.y1").alias("y1"))


def column_split(lines: DataFrame, least_support: float = 0.25) -> DataFrame:
    """By result the widest gap between lines ordered by x0, if both sides have at least `least_support` of the lines."""
    w = Window.partitionBy("selection_result_id").orderBy("box.x0", "box.x1", "order")
    placed = lines.withColumn("n", F.row_number().over(w)).withColumn("all", F.count("*").over(Window.partitionBy("selection_result_id"))).withColumn("reach", F.max("box.x1").over(w.rowsBetween(Window.unboundedPreceding, -1)))
    cuts = placed.where((F.col("n") - 1 >= least_support * F.col("all")) & (F.col("all") - F.col("n") + 1 >= least_support * F.col("all"))).withColumn("gap", F.col("box.x0") - F.col("reach")).where("gap >= 0")
    return cuts.groupBy("selection_result_id").agg(F.max("gap").alias("gap"))


def running_mean_rows(lines: DataFrame, tolerance: float = 18.0) -> DataFrame:
    """Rows of a table region: lines by centre, a new row where the centre is more than `tolerance` from the row's running mean.

    The fold depends on its order and runs over the lines of one result in the JVM; a result's lines are bounded by the page.
    """
    centre = (F.col("box.y0") + F.col("box.y1")) / 2
    ordered = lines.groupBy("selection_result_id").agg(F.array_sort(F.collect_list(F.struct(centre.alias("c"), F.col("order")))).alias("items"))
    empty = F.expr("named_struct('mean', cast(null as double), 'n', cast(0 as bigint), 'rows', cast(0 as bigint))")
    step = lambda s, x: F.when(
        s["mean"].isNull() | (F.abs(x["c"] - s["mean"]) > tolerance), F.struct(x["c"].alias("mean"), F.lit(1).cast("bigint").alias("n"), (s["rows"] + 1).alias("rows"))
    ).otherwise(F.struct(((s["mean"] * s["n"] + x["c"]) / (s["n"] + 1)).alias("mean"), (s["n"] + 1).alias("n"), s["rows"].alias("rows")))
    return ordered.select("selection_result_id", F.aggregate("items", empty, step, lambda s: s["rows"]).alias("rows"))


def repeated_margins(lines: DataFrame, pages: DataFrame, margin: float = 0.12) -> DataFrame:
    """Margin lines on many pages of a book: keys on at least max(3, a fifth) of its pages with lines."""
    height = F.max("box.y1").over(Window.partitionBy("page_id"))
    placed = lines.withColumn("height", height).where((F.col("box.y1") <= margin * F.col("height")) | (F.col("box.y0") >= (1 - margin) * F.col("height")))
    named = lines.select("page_id").distinct().join(pages.select("page_id", "book"), "page_id").groupBy("book").agg(F.count("*").alias("of"))
    keys = placed.join(pages.select("page_id", "book"), "page_id").withColumn("key", margin_key(F.col("text"))).where("key <> ''")
    counts = keys.groupBy("book", "key").agg(F.countDistinct("page_id").alias("pages"))
    return counts.join(named, "book").where(F.col("pages") >= F.greatest(F.lit(3), F.ceil(F.col("of") * 0.2))).select("book", "key", "pages")


def merged_stream(native: DataFrame, ocr: DataFrame) -> DataFrame:
    """Native lines in order, matched by equal normalized text to OCR lines of the page, then the OCR lines left over.

    native: page_id, ordinal, line; ocr: page_id, order, text. The k-th line of a text on a page matches the k-th OCR line of it,
    so matches are one to one. kind: duplicate, native_only, ocr_only; position counts from 0 on the page.
    """
    same = lambda c: matched_form(F.col(c))
    nth = lambda o: F.row_number().over(Window.partitionBy("page_id", "key").orderBy(o))
    left = native.withColumn("key", same("line")).where("key <> ''").withColumn("k", nth("ordinal")).select("page_id", "key", "k", "ordinal")
    right = ocr.withColumn("key", same("text")).where("key <> ''").withColumn("k", nth("order")).select("page_id", "key", "k", "order")
    both = left.join(right, ["page_id", "key", "k"], "full_outer")
    kind = F.when(F.col("order").isNull(), "native_only").when(F.col("ordinal").isNull(), "ocr_only").otherwise("duplicate")
    w = Window.partitionBy("page_id").orderBy(F.col("ordinal").asc_nulls_last(), F.col("order").asc_nulls_last())
    return both.select("page_id", "key", kind.alias("kind"), (F.row_number().over(w) - 1).cast("bigint").alias("position"))


def admit_boxes(boxes: DataFrame, group: list[str], score: str, box: str, iou: float = 0.8, least: float = 0.5) -> DataFrame:
    """Greedy non-maximum suppression within a group (an image and category): by falling score a box is kept unless it overlaps a kept one.

    Ties go by the box, equal detections count once. The choice depends on its order, so each group is folded as one array in the
    JVM; groups are the detections of one image, which the detector bounds. Null scores and boxes are left out.
    """
    flat = boxes.where((F.col(score) >= least) & F.col(box).isNotNull())
    item = F.struct((-F.col(score)).alias("falling"), F.col(box).alias("box"))
    ordered = flat.groupBy(*group).agg(F.sort_array(F.collect_set(item)).alias("items"))
    none = F.slice("items", 1, 0)
    step = lambda kept, x: F.when(F.exists(kept, lambda k: G.iou(k["box"], x["box"]) >= iou), kept).otherwise(F.concat(kept, F.array(x)))
    kept = ordered.select(*group, F.explode(F.aggregate("items", none, step)).alias("x"))
    return kept.select(*group, (-F.col("x.falling")).alias(score), F.col("x.box").alias(box))
