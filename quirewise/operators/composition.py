"""Composition of transcripts and evidence: claims on blocks, item order, reviews, projections, bindings, locators."""

from __future__ import annotations

import re
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

from quirewise.functions import contract as K
from quirewise.functions import geometry as G

# How structure kinds are transcribed, and in which order kinds stand at one place.
DISPOSITIONS = {"title": "heading", "section": "heading", "subsection": "heading", "appendix": "heading", "bibliography": "heading", "abstract": "prose", "author": "prose", "keywords": "prose", "bibliography_entry": "prose"}
KIND_ORDER = {"page": 0, "heading": 1, "prose": 2, "equation": 3, "table": 4, "figure": 5, "raw": 6}
RELATIONAL = re.compile(r"(?<!\w)([A-Za-zΑ-ω]\s*[=≈≃≤≥≠∝]\s*[^,;:.\n]{1,120})")
DELIMITED = re.compile(r"\$(?!\$)([^$\n]{1,256})\$|\\\((.{1,256}?)\\\)")
SIGNAL = re.compile(r"[=≈≃≤≥≠∝+\-−×÷/^_∑∫√∂∇∞±→←∏⋅·Α-Ͽ]|\\[A-Za-z]{2,}")


def claimed(blocks: DataFrame, claims: DataFrame, key: Sequence[str]) -> DataFrame:
    """blocks (key, text) with who transcribes each: of the claims (key, kind, priority) the one of the least priority, then kind; blocks nobody claims
    are raw items. A block without text is left out for a reason: missing_text_payload (null) or blank_text."""
    first = claims.groupBy(*key).agg(F.min(F.struct("priority", "kind")).alias("c"), F.count("*").alias("claims"))
    x = blocks.join(first, list(key), "left")
    omission = F.when(F.col("text").isNull(), "missing_text_payload").when(F.regexp_replace("text", r"(?U)\s+", "") == "", "blank_text")
    kind = F.when(omission.isNull(), F.coalesce("c.kind", F.lit("raw")))
    return x.select(*key, kind.alias("kind"), omission.alias("omission"), (F.coalesce("claims", F.lit(0)) > 1).alias("contested"))


def item_order(items: DataFrame, document: Sequence[str]) -> DataFrame:
    """items (document, id, kind, page_index, x, y) with their place in the document: by page, what has a position before what has none, then y, x, the
    kind's place, id."""
    rank = F.element_at(F.create_map(*[F.lit(v) for k, n in KIND_ORDER.items() for v in (k, n)]), F.col("kind"))
    order = [F.col("page_index").asc_nulls_last(), F.col("y").isNull(), F.col("y").asc_nulls_last(), F.col("x").asc_nulls_last(), rank.asc_nulls_last(), F.col("id")]
    return items.withColumn("place", (F.row_number().over(Window.partitionBy(*document).orderBy(*order)) - 1).cast("bigint"))


def ordered_blocks(blocks: DataFrame, proposed: DataFrame, page: Sequence[str], otherwise: float = 0.35) -> DataFrame:
    """blocks (page, id, ordinal) with place and confidence: in the proposed order (page, id, position, confidence), blocks it leaves out after the others in
    their own order, at a confidence of 0.35."""
    x = blocks.join(proposed.select(*page, "id", "position", "confidence"), [*page, "id"], "left")
    order = Window.partitionBy(*page).orderBy(F.col("position").asc_nulls_last(), "ordinal", "id")
    return x.select(*page, "id", (F.row_number().over(order) - 1).cast("bigint").alias("place"), F.coalesce("confidence", F.lit(otherwise)).alias("confidence"))


def disposition(kind: Column) -> Column:
    return F.coalesce(F.element_at(F.create_map(*[F.lit(v) for pair in DISPOSITIONS.items() for v in pair]), kind), F.lit("none"))


def transcription_status(items: DataFrame, key: Sequence[str]) -> DataFrame:
    """(key, status): with_uncertainty if any of the key's items (key, omission, warnings, ambiguous) is left out, warned about or ambiguous."""
    unsure = F.col("omission").isNotNull() | (F.coalesce("warnings", F.lit(0)) > 0) | F.coalesce("ambiguous", F.lit(False))
    return items.groupBy(*key).agg(F.when(F.bool_or(unsure), "transcribed_with_uncertainty").otherwise("transcribed").alias("status"))


def layout_review(blocks: DataFrame, regions: DataFrame, page: Sequence[str], least: float = 0.5, coverage: float = 0.9) -> DataFrame:
    """(page, blocks, covered, uncovered, invalid, coverage, reasons): blocks (page, id, box) against regions (page, box). A block is covered if a region
    has at least `least` of its area; the share of the blocks covered is 1 where there are none. Reasons: invalid_block_geometry, no_regions,
    uncovered_blocks, insufficient_coverage."""
    valid = G.kind(F.col("box")) == "valid"
    x = blocks.select(*page, "id", "box", valid.alias("valid"))
    share = F.round(G.intersection(F.col("box"), F.col("r")) / G.area(F.col("box")), 12)
    best = x.where("valid").join(regions.where(G.kind(F.col("box")) == "valid").select(*page, F.col("box").alias("r")), list(page)).groupBy(*page, "id").agg(F.max(share).alias("share"))
    some = regions.groupBy(*page).agg(F.lit(True).alias("some")).distinct()
    y = x.join(best, [*page, "id"], "left").withColumn("covered", F.coalesce(F.col("share") >= least, F.lit(False)))
    n = lambda c: F.sum(c.cast("bigint"))
    z = y.groupBy(*page).agg(F.count("*").alias("blocks"), n(F.col("covered")).alias("covered"), n(F.col("valid") & ~F.col("covered")).alias("uncovered"), n(~F.col("valid")).alias("invalid")).join(some, list(page), "left")
    ratio = F.round(F.col("covered") / F.col("blocks"), 12)
    named = ((F.col("invalid") > 0, "invalid_block_geometry"), (F.col("some").isNull(), "no_regions"), (F.col("uncovered") > 0, "uncovered_blocks"), (ratio < coverage, "insufficient_coverage"))
    reasons = F.filter(F.array(*[F.when(w, F.lit(r)) for w, r in named]), lambda v: v.isNotNull())
    return z.select(*page, "blocks", "covered", "uncovered", "invalid", ratio.alias("coverage"), reasons.alias("reasons"))


def projected_pages(blocks: DataFrame, captions: DataFrame, page: Sequence[str], with_captions: bool = True) -> tuple[DataFrame, DataFrame]:
    """What a page projection keeps of blocks (page, id, kind, text): headings and prose, and captions (page, id, text) if asked for; and the collisions
    (page, id, caption): kept texts equal to a caption in normal form, which mustn't be."""
    kept = blocks.where(F.col("kind").isin("heading", "prose", "raw")).select(*page, "id", "kind", "text")
    form = lambda df, name: df.select(*page, F.col("id").alias(name), K.collision_form(F.col("text")).alias("form"))
    collisions = form(kept, "id").join(form(captions, "caption"), [*page, "form"]).select(*page, "id", "caption")
    if with_captions:
        kept = kept.unionByName(captions.select(*page, "id", F.lit("caption").alias("kind"), "text"))
    return kept, collisions


def cross_bindings(projected: DataFrame, reading: DataFrame, page: Sequence[str]) -> DataFrame:
    """projected blocks (page, id, kind) bound to reading blocks (page, id, evidence): text is available with its evidence, a caption or a block without one
    isn't."""
    x = projected.join(reading.select(*page, "id", "evidence"), [*page, "id"], "left")
    there = (F.col("kind") != "caption") & F.col("evidence").isNotNull()
    return x.select(*page, "id", F.when(there, "available").otherwise("unavailable").alias("binding"), F.when(there, F.col("evidence")).alias("evidence"))


def phrase_tokens(text: Column) -> Column:
    """The runs of letters and digits of a text in matching form, with blanks around each."""
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(K.matched_form(text), r"[^\p{L}\p{N}]+", " ")), F.lit(" "))


def anchor_matches(pages: DataFrame, anchors: DataFrame, key: str) -> DataFrame:
    """(page_id, matched, unmatched): pages (key, page_id, text) against the anchors (key, anchor) of their key, each sorted; a page matches an anchor if the
    anchor's words stand on it one after another. Each text is brought to its form once."""
    p = pages.where("text is not null").select(key, "page_id", phrase_tokens(F.col("text")).alias("words"))
    a = anchors.where("anchor is not null").select(key, "anchor", phrase_tokens(F.col("anchor")).alias("phrase")).where(F.length("phrase") > 2).distinct()
    hit = F.contains("words", "phrase")
    got = lambda when: F.array_sort(F.collect_set(F.when(when, F.col("anchor"))))
    return p.join(a, key).groupBy("page_id").agg(got(hit).alias("matched"), got(~hit).alias("unmatched"))


def claim_candidates(records: DataFrame, matches: DataFrame) -> DataFrame:
    """(page_id, anchor, review): one a matched anchor of a page whose record (page_id, reusable) may be reused; always for manual review."""
    usable = records.where("reusable").select("page_id").distinct()
    return matches.select("page_id", F.explode("matched").alias("anchor")).join(usable, "page_id", "left_semi").select("page_id", "anchor", F.lit("manual_review_required").alias("review"))


def complete_records(layers: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """(id, missing, complete): records (id, layer) with the layers of `wanted` they lack."""
    have = layers.groupBy("id").agg(F.collect_set("layer").alias("have"))
    missing = F.array_except(F.array(*[F.lit(x) for x in wanted]), F.col("have"))
    return have.select("id", missing.alias("missing"), (F.size(missing) == 0).alias("complete"))


def first_occurrences(lists: DataFrame, key: str, order: str, values: str) -> DataFrame:
    """(key, values): the union of a key's lists in order, each value where it stands first."""
    together = F.flatten(F.transform(F.array_sort(F.collect_list(F.struct(order, values))), lambda x: x[values]))
    return lists.where(F.col(values).isNotNull()).groupBy(key).agg(F.array_distinct(together).alias(values))


def inventory_problems(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """(member, problem): members that are missing or extra; an exact inventory has none."""
    x = expected.select("member", F.lit(1).alias("e")).distinct().join(actual.select("member", F.lit(1).alias("a")).distinct(), "member", "full_outer")
    return x.select("member", F.when(F.col("a").isNull(), "missing").when(F.col("e").isNull(), "extra").alias("problem")).where("problem is not null")


FORMULAS = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("stop", T.IntegerType()), T.StructField("method", T.StringType()), T.StructField("confidence", T.DoubleType())]))


@pandas_udf(FORMULAS)
def inline_equations(texts: pd.Series) -> pd.Series:
    """Inline formulas of a text by place: delimited ones with a math sign (0.9), and relations outside them (0.68). Offsets of overlapping
    patterns can't be had from built-in functions."""

    def found(text: str | None) -> list[dict] | None:
        if text is None:
            return None
        out = []
        for m in DELIMITED.finditer(text):
            k = 1 if m.group(1) is not None else 2
            if SIGNAL.search(m.group(k)):
                out.append((*m.span(k), "dollar_delimited" if k == 1 else "latex_parenthesis_delimited", 0.9))
        taken = [x[:2] for x in out]
        for m in RELATIONAL.finditer(text):
            a, b = m.span(1)
            if not any(a < d and b > c for c, d in taken):
                out.append((a, a + len(m.group(1).rstrip()), "relational_inline", 0.68))
        return [dict(zip(("start", "stop", "method", "confidence"), x)) for x in sorted(out)]

    return texts.map(found)


def preflight(selections: DataFrame, page: Sequence[str], dpi: float = 144.0, most_pixels: int = 25_000_000, channels: int = 3) -> DataFrame:
    """(page, selections, pixels, bytes, allowed): what rendering a page's distinct selections (page, box) takes, before anything is rendered."""
    side = lambda a, b: F.ceil((F.col(f"box.{b}") - F.col(f"box.{a}")) * dpi / 72.0)
    x = selections.select(*page, "box").distinct().withColumn("p", (side("x0", "x1") * side("y0", "y1")).cast("bigint"))
    total = F.sum("p").cast("bigint")
    return x.groupBy(*page).agg(F.count("*").alias("selections"), total.alias("pixels"), (total * channels).alias("bytes"), (total <= most_pixels).alias("allowed"))
