"""Transcripts: numbers, headings, sections, hyphens, clean text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quirewise.functions.text import AUTHOR_LINE, BIBLIOGRAPHY_ENTRY, LINE_BREAK_HYPHEN, NUMERIC, basic_clean, folded, front_kind, heading, margin_key, page_number_value, publisher_kind
from quirewise.storage import cut

#: Deepest level of a heading that counts as a level of its own; deeper ones count as this one.
LEVELS = 12


def headings(lines: DataFrame) -> DataFrame:
    """Heading lines: doc_id, ordinal, kind, level, label, title, evidence, confidence."""
    return lines.withColumn("h", heading(F.col("line"))).where("h is not null").select("doc_id", F.col("ordinal").cast("bigint").alias("ordinal"), "h.*")


def section_parents(heads: DataFrame) -> DataFrame:
    """Each heading with the nearest heading before it of a smaller level (parent_ordinal, null at the top).

    The last ordinal of each level is carried down by one window a level, so a document of many headings costs no more than LEVELS values
    a heading.
    """
    w = Window.partitionBy("doc_id").orderBy("ordinal").rowsBetween(Window.unboundedPreceding, -1)
    level = F.least("level", F.lit(LEVELS))
    last = [F.last(F.when(level == k, F.col("ordinal")), ignorenulls=True).over(w) for k in range(1, LEVELS)]
    above = F.greatest(*[F.when(level > k, x) for k, x in enumerate(last, 1)])
    return heads.select("doc_id", "ordinal", "level", above.alias("parent_ordinal"))


def bibliography(lines: DataFrame) -> DataFrame:
    """Lines of a document's bibliography: those after its heading, until an appendix, with the confidence of an entry by its look. Blank lines are none."""
    kind = heading(F.col("line"))["kind"]
    marker = F.when(kind.isin("bibliography", "appendix"), kind)
    # Within a bibliography only an appendix ends it, another bibliography title is an entry.
    w = Window.partitionBy("doc_id").orderBy("ordinal")
    region = F.last(marker, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    inside = (region == "bibliography") & (F.coalesce(marker, F.lit("")) != "appendix") & (basic_clean(F.col("line")) != "")
    looks = F.col("line").rlike(BIBLIOGRAPHY_ENTRY)
    return (
        lines.withColumn("region", inside).where("region")
        .select("doc_id", F.col("ordinal").cast("bigint").alias("ordinal"), basic_clean(F.col("line")).alias("entry"), F.when(looks, 0.9).otherwise(0.65).alias("confidence"))
    )


def front_matter(lines: DataFrame, titles: DataFrame, within: int = 16, most: int = 16) -> DataFrame:
    """(doc_id, kind, ordinal, lines, title, evidence, confidence): title, author, abstract and keywords of documents, at most one of each.

    lines (doc_id, ordinal, line; blank lines count as none), titles (doc_id, title: the metadata's). The title is the first line equal to the
    metadata title, else the first line if it is no heading, front matter or author line. The author line stands among the first `within`
    lines before any front matter or heading. An abstract heading takes the lines after it, `most` with itself, until keywords or a
    heading.
    """
    said = lines.withColumn("f", folded(F.col("line"))).where("f <> ''")
    w = Window.partitionBy("doc_id").orderBy("ordinal")
    x = said.withColumn("n", F.row_number().over(w)).withColumn("front", front_kind(F.col("line"))).withColumn("head", heading(F.col("line")).isNotNull()).withColumn("author", F.col("line").rlike(AUTHOR_LINE))
    x = x.join(titles.select("doc_id", F.nullif(folded(F.col("title")), F.lit("")).alias("wanted")).groupBy("doc_id").agg(F.min("wanted").alias("wanted")), "doc_id", "left")
    equal = F.min(F.when(F.col("f") == F.col("wanted"), F.col("n"))).over(Window.partitionBy("doc_id"))
    plain = F.max(F.when((F.col("n") == 1) & F.col("front").isNull() & ~F.col("head") & ~F.col("author"), 1)).over(Window.partitionBy("doc_id"))
    x = x.withColumn("title_at", F.coalesce(equal, plain)).withColumn("sure", equal.isNotNull())
    free = F.coalesce(F.col("n") != F.col("title_at"), F.lit(True))
    stop = F.max(F.when(free & ~F.col("author") & (F.col("front").isNotNull() | F.col("head")), 1)).over(w.rowsBetween(Window.unboundedPreceding, 0))
    x = x.withColumn("author_here", free & F.col("author") & stop.isNull() & (F.col("n") <= within))
    author_at = F.min(F.when(F.col("author_here"), F.col("n"))).over(Window.partitionBy("doc_id"))
    x = x.withColumn("author_at", author_at)
    left = free & F.coalesce(F.col("n") != F.col("author_at"), F.lit(True))
    x = x.withColumn("free", left).withColumn("abstract_at", F.min(F.when(left & (F.col("front") == "abstract"), F.col("n"))).over(Window.partitionBy("doc_id")))
    x = x.withColumn("keywords_at", F.min(F.when(left & (F.col("front") == "keywords"), F.col("n"))).over(Window.partitionBy("doc_id")))
    after = F.col("n") > F.col("abstract_at")
    bare = F.max(F.when((F.col("n") == F.col("abstract_at")) & (F.col("f") == "abstract"), 1)).over(Window.partitionBy("doc_id"))
    ends = F.max(F.when(after & F.col("free") & ((F.col("front") == "keywords") | F.col("head")), 1)).over(w.rowsBetween(Window.unboundedPreceding, 0))
    rank = F.sum(F.when(after & F.col("free"), 1).otherwise(0)).over(w.rowsBetween(Window.unboundedPreceding, 0))
    x = x.withColumn("in_abstract", (F.col("n") == F.col("abstract_at")) | (after & F.col("free") & (bare == 1) & ends.isNull() & (rank < most)))
    said = F.trim("line")
    row = lambda kind, at, title, evidence, confidence: F.struct(
        F.lit(kind).alias("kind"), F.col("ordinal").cast("bigint").alias("ordinal"), F.lit(1).cast("bigint").alias("lines"), title.alias("title"), evidence.alias("evidence"), confidence.alias("confidence")
    )
    title = row("title", "title_at", basic_clean(F.col("line")), F.when(F.col("sure"), "metadata_and_exact_text").otherwise("first_page_top_text_fallback"), F.when(F.col("sure"), 0.98).otherwise(0.45))
    author = row("author", "author_at", F.regexp_extract(said, AUTHOR_LINE, 1), F.lit("explicit_author_prefix"), F.lit(0.95))
    keywords = row("keywords", "keywords_at", F.trim(F.regexp_replace(said, "^[^:]*:", "")), F.lit("explicit_keywords_prefix"), F.lit(0.98))
    single = [F.when(F.col("n") == F.col("title_at"), title), F.when(F.col("n") == F.col("author_at"), author), F.when((F.col("n") == F.col("keywords_at")) & ~F.col("in_abstract"), keywords)]
    each = x.select("doc_id", F.explode(F.filter(F.array(*single), lambda v: v.isNotNull())).alias("v")).select("doc_id", "v.*")
    abstract = x.where("in_abstract").groupBy("doc_id").agg(F.min("ordinal").cast("bigint").alias("ordinal"), F.count("*").alias("lines")).select(
        "doc_id", F.lit("abstract").alias("kind"), "ordinal", "lines", F.lit("Abstract").alias("title"), F.lit("explicit_abstract_heading").alias("evidence"), F.lit(0.95).alias("confidence")
    )
    return each.unionByName(abstract)


def article_nodes(lines: DataFrame, titles: DataFrame) -> DataFrame:
    """(doc_id, kind, ordinal, level, parent_ordinal, confidence): the structure tree of documents: front matter under its container, sections under
    the sections they belong to, bibliography entries under their bibliography. Ordinal -1 is the document, -2 the front matter's container."""
    front = front_matter(lines, titles)
    heads = headings(lines)
    entries = bibliography(lines)
    consumed = front.select("doc_id", "ordinal")
    own = heads.join(consumed, ["doc_id", "ordinal"], "left_anti").join(entries.select("doc_id", "ordinal"), ["doc_id", "ordinal"], "left_anti")
    placed = section_parents(own).join(own.select("doc_id", "ordinal", "kind", "confidence"), ["doc_id", "ordinal"])
    places = own.where("kind = 'bibliography'").select("doc_id", F.col("ordinal").alias("at"))
    by = F.max("at").alias("parent_ordinal")
    listed = entries.join(consumed, ["doc_id", "ordinal"], "left_anti").join(places, "doc_id").where("at < ordinal").groupBy("doc_id", "ordinal", "confidence").agg(by)
    container = front.groupBy("doc_id").agg(F.min("confidence").alias("confidence"))
    roots = lines.where(basic_clean(F.col("line")) != "").select("doc_id").distinct()
    node = lambda df, kind, ordinal, level, parent, confidence: df.select(
        "doc_id", kind.alias("kind"), ordinal.cast("bigint").alias("ordinal"), level.cast("bigint").alias("level"), parent.cast("bigint").alias("parent_ordinal"), confidence.alias("confidence")
    )
    c, lit = F.col, F.lit
    return (
        node(roots, lit("document"), lit(-1), lit(None), lit(None), lit(1.0))
        .unionByName(node(container, lit("front_matter"), lit(-2), lit(None), lit(-1), c("confidence")))
        .unionByName(node(front, c("kind"), c("ordinal"), lit(None), lit(-2), c("confidence")))
        .unionByName(node(placed, c("kind"), c("ordinal"), c("level"), F.coalesce("parent_ordinal", lit(-1)), c("confidence")))
        .unionByName(node(listed, lit("bibliography_entry"), c("ordinal"), lit(None), c("parent_ordinal"), c("confidence")))
    )


def hyphen_decisions(documents: DataFrame) -> DataFrame:
    """Words broken at a line's end (doc_id, left, right, decision, n): joined if the document has the joined word and not the hyphenated one,
    hyphen kept the other way round, else the break kept."""
    folded = F.lower("text")
    pairs = documents.where("text is not null").withColumn("hit", F.explode(F.regexp_extract_all("text", F.lit(LINE_BREAK_HYPHEN), F.lit(0))))
    part = lambda k: F.lower(F.regexp_extract("hit", LINE_BREAK_HYPHEN, k))
    words = F.concat(F.lit(" "), F.regexp_replace(folded, r"[^\p{L}\p{N}\-]+", " "), F.lit(" "))
    cut = pairs.select("doc_id", words.alias("words"), part(1).alias("left"), part(2).alias("right"))
    joined, kept = F.contains("words", F.concat(F.lit(" "), "left", "right", F.lit(" "))), F.contains("words", F.concat(F.lit(" "), "left", F.lit("-"), "right", F.lit(" ")))
    decision = F.when(joined & ~kept, "join").when(kept & ~joined, "keep_hyphen").otherwise("keep_break")
    return cut.select("doc_id", "left", "right", decision.alias("decision")).groupBy("doc_id", "left", "right", "decision").agg(F.count("*").alias("n"))


def in_margin(box: Column, height: Column, share: float = 0.12) -> Column:
    """Whether a box lies in the top or the bottom margin; a null box doesn't."""
    return F.coalesce((box["y1"] <= height * share) | (box["y0"] >= height * (1.0 - share)), F.lit(False))


def page_number_classes(blocks: DataFrame, tolerance: float = 0.04, least: int = 3) -> DataFrame:
    """Blocks that are a number, with the outcome and the method that decided it; the first that fits.

    blocks: document, page_id, page_index, ordinal, label, text, box, width, height, protected. Typed content and numbers outside the margins are
    no page numbers; the page's own label, where one block has it, is one; so is a run of `least` pages on which page and number both
    rise by one at one side and one horizontal place; the rest is unresolved.
    """
    value = folded(F.col("text"))
    x = blocks.withColumn("value", value).where(F.col("value").rlike(NUMERIC)).withColumn("margin", in_margin(F.col("box"), F.col("height")))
    x = x.withColumn("number", F.when(F.col("value").rlike("^[0-9]{1,9}$"), F.col("value").cast("bigint")).otherwise(page_number_value(F.col("value"))))
    x = x.withColumn("side", F.when(F.col("box.y1") <= F.col("height") / 2.0, "top").otherwise("bottom")).withColumn("place", F.bround((F.col("box.x0") + F.col("box.x1")) / 2.0 / F.col("width") / tolerance).cast("bigint"))
    own = F.col("value") == folded(F.col("label"))
    x = x.withColumn("own", F.coalesce(own, F.lit(False)))
    x = x.withColumn("matches", F.sum(F.col("own").cast("int")).over(Window.partitionBy("page_id", "value")))
    # Runs: page and number have one difference along a run, so they are islands of it; a second number of the same place and page ends one.
    sided = Window.partitionBy("document", "margin", "side", "place").orderBy("page_index", "ordinal")
    goes_on = (F.col("page_index") == F.lag("page_index").over(sided) + 1) & (F.col("number") == F.lag("number").over(sided) + 1)
    x = x.withColumn("opens", (~F.coalesce(goes_on, F.lit(False))).cast("int"))
    x = x.withColumn("run", F.sum("opens").over(sided.rowsBetween(Window.unboundedPreceding, 0)))
    x = x.withColumn("length", F.count("*").over(Window.partitionBy("document", "margin", "side", "place", "run")))
    method = (
        F.when(F.col("protected"), "typed_content").when(~F.col("margin"), "outside_margin").when(F.col("own") & (F.col("matches") == 1), "printed_page_label")
        .when(F.col("length") >= least, "recurring_geometry_sequence").otherwise("insufficient_evidence")
    )
    outcome = F.when(method.isin("typed_content", "outside_margin"), "not_page_number").when(method == "insufficient_evidence", "unresolved").otherwise("page_number")
    return x.select("document", "page_id", "page_index", "ordinal", "value", outcome.alias("outcome"), method.alias("method"))


def margin_keys(blocks: DataFrame, least: int = 3, share: float = 0.2) -> DataFrame:
    """(document, key): margin texts, digits masked, on at least max(least, share) of a document's pages; numbers alone don't count."""
    need = blocks.groupBy("document").agg(F.greatest(F.lit(least), F.ceil(F.countDistinct("page_id") * share)).alias("need"))
    clean = blocks.where(in_margin(F.col("box"), F.col("height"))).withColumn("key", margin_key(F.col("text"))).where((F.col("key") != "") & ~folded(F.col("text")).rlike(NUMERIC))
    return clean.groupBy("document", "key").agg(F.countDistinct("page_id").alias("n")).join(need, "document").where("n >= need").select("document", "key")


def clean_blocks(blocks: DataFrame) -> DataFrame:
    """blocks (see `page_number_classes`) with what becomes of each: excluded as page_number, publisher_front_matter, repeated_margin or
    empty_after_sanitization, the first that fits, or kept (null) with its clean text and its place in the document, counted from 0."""
    blocks = cut(blocks, "blocks")  # read by every test
    numbers = page_number_classes(blocks).where("outcome = 'page_number'").select("page_id", "ordinal", F.lit(True).alias("is_number"))
    keys = margin_keys(blocks).withColumn("is_margin", F.lit(True))
    publisher = publisher_kind(F.col("text"), F.col("page_index") == 0, F.lit(False)).isNotNull()
    x = blocks.withColumn("clean", basic_clean(F.col("text"))).withColumn("key", F.when(in_margin(F.col("box"), F.col("height")), margin_key(F.col("text"))))
    x = x.join(numbers, ["page_id", "ordinal"], "left").join(keys, ["document", "key"], "left")
    reason = F.when(F.col("is_number"), "page_number").when(publisher, "publisher_front_matter").when(F.col("is_margin"), "repeated_margin").when(F.col("clean") == "", "empty_after_sanitization")
    x = x.withColumn("reason", reason)
    order = Window.partitionBy("document").orderBy("page_index", "page_id", "ordinal").rowsBetween(Window.unboundedPreceding, -1)
    place = F.when(F.col("reason").isNull(), F.coalesce(F.sum(F.when(F.col("reason").isNull(), 1).otherwise(0)).over(order), F.lit(0))).cast("bigint")
    return x.select("document", "page_id", "page_index", "ordinal", "label", "reason", F.when(F.col("reason").isNull(), F.col("clean")).alias("clean"), place.alias("place"))


def clean_pages(pages: DataFrame, cleaned: DataFrame) -> DataFrame:
    """(page_id, kept, excluded, text): each page's marker and its kept blocks, joined by blank lines. pages: page_id, page_index, label; a page
    without blocks has its marker only."""
    kept = F.array_sort(F.collect_list(F.when(F.col("reason").isNull(), F.struct("ordinal", "clean"))))
    body = cleaned.groupBy("page_id").agg(kept.alias("blocks"), F.count("reason").alias("excluded"))
    label = F.replace(F.coalesce("label", F.lit("none")), F.lit('"'), F.lit("'"))
    marker = F.concat(F.lit("[[PAGE physical="), (F.col("page_index") + 1).cast("string"), F.lit(' printed="'), label, F.lit('"]]'))
    texts = F.coalesce(F.transform("blocks", lambda b: b["clean"]), F.array().cast("array<string>"))
    joined = pages.join(body, "page_id", "left")
    return joined.select("page_id", F.size(texts).cast("bigint").alias("kept"), F.coalesce("excluded", F.lit(0)).alias("excluded"), F.array_join(F.concat(F.array(marker), texts), "\n\n").alias("text"))


def toc_matches(toc: DataFrame, lines: DataFrame) -> DataFrame:
    """Entries of a table of contents whose normalized title is exactly one line of their page: (entry_id, page_id, ordinal)."""
    same = lambda c: F.lower(F.regexp_replace(basic_clean(F.col(c)), r"^[\d.]+\s+", ""))
    hits = toc.withColumn("key", same("title")).where("key <> ''").join(lines.withColumn("key", same("line")).select("book", "page_index", "key", "page_id", "ordinal"), ["book", "page_index", "key"])
    return hits.groupBy("entry_id").agg(F.count("*").alias("n"), F.min("page_id").alias("page_id"), F.min("ordinal").cast("bigint").alias("ordinal")).where("n = 1").select("entry_id", "page_id", "ordinal")
