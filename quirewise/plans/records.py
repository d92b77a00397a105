"""Queries over records: caches, artifacts, materialization, equivalence, replay, state machines, audits."""

from __future__ import annotations

from pyspark.sql import functions as F

from quirewise.operators import records as R
from quirewise.operators.incremental import normal_state
from quirewise.sources import views as V
from quirewise.storage import table


def extraction_work_list(spark, d):
    """Documents to be extracted: a third is cached, every fifth of those is damaged."""
    docs = V.once(table(spark, d, "documents").select("doc_id", "text"), "doc_id").where("text is not null")
    key = R.cache_key(F.col("doc_id"), F.sha2("text", 256), F.lit("native"), F.lit("1"))
    x = docs.select("doc_id", key.alias("key"), F.col("text").alias("content"), F.sha2(F.when(F.col("doc_id") % 5 == 0, F.concat("text", F.lit("x"))).otherwise(F.col("text")), 256).alias("content_sha256"))
    return R.work_list(x.select("doc_id", "key"), x.where("doc_id % 3 = 0"))


def _artifacts(spark, d):
    pages = V.pages(spark, d).where("page_index is not null and book is not null")
    return R.page_artifacts(pages.groupBy(F.col("book").alias("document"), "page_index").agg(F.min("text").alias("text")).withColumn("ordinal", F.lit(0)))


def page_artifacts(spark, d):
    return _artifacts(spark, d).select("document", "page_index", "path", "byte_size", "sha256")


def artifact_bundles(spark, d):
    return R.bundle_ids(_artifacts(spark, d))


def artifact_verification(spark, d):
    """Stored artifacts of which some are gone, cut off, changed or additional."""
    x, n = _artifacts(spark, d), F.col("page_index")
    text = F.when(n % 13 == 2, F.expr("substring(text, 1, length(text) - 1)")).when(n % 13 == 3, F.concat(F.lit("%"), F.expr("substring(text, 2)"))).otherwise(F.col("text"))
    stored = x.where(n % 13 != 1).select("document", F.when(n % 13 == 4, F.concat("path", F.lit("~"))).otherwise(F.col("path")).alias("path"), text.alias("text"))
    return R.artifact_problems(x, stored)


def _records(spark, d):
    """Read-model records: books, pages and toc entries with their content digests."""
    sha = lambda *c: F.sha2(F.concat_ws("|", *[F.coalesce(F.col(x).cast("string"), F.lit("-")) for x in c]), 256)
    pages = V.pages(spark, d).groupBy("page_id").agg(F.min("text").alias("text"))
    toc = table(spark, d, "toc_entries").groupBy("entry_id").agg(F.min("title").alias("title"))
    books = table(spark, d, "books").groupBy("name").agg(F.min("stage").alias("stage"))
    part = lambda df, n, k, c: df.select(F.lit(n).alias("collection"), F.col(k).alias("id"), sha(c).alias("content_sha256"))
    return part(pages, "pages", "page_id", "text").union(part(toc, "toc", "entry_id", "title")).union(part(books, "books", "name", "stage"))


def materialization_outcomes(spark, d):
    """A projection against a target that has most of it, some of it with another content: by collection and in all."""
    x = _records(spark, d)
    some = F.pmod(F.conv(F.substring("content_sha256", 1, 4), 16, 10).cast("int"), F.lit(10))
    target = x.where(some != 0).withColumn("content_sha256", F.when(some == 1, F.lit("0" * 64)).otherwise(F.col("content_sha256")))
    counts = R.materialized(target, x).rollup("collection").agg(*[F.sum((F.col("outcome") == o).cast("bigint")).alias(o) for o in ("created", "unchanged", "conflict")])
    return counts.select(F.coalesce("collection", F.lit("total")).alias("collection"), "created", "unchanged", "conflict")


def layer_counts(spark, d):
    return _records(spark, d).groupBy("collection").agg(F.count("*").alias("records"), F.countDistinct("content_sha256").alias("contents"))


def completion_gate(spark, d):
    """Runs whose publication count is that of the sequences in their range: complete, short or over."""
    runs = table(spark, d, "selection_inventories").where("run_number is not null and first_sequence is not null and last_sequence is not null").select("run_number", "first_sequence", "last_sequence", "publication_count").distinct()
    seqs = table(spark, d, "chunks").where("sequence is not null").select("sequence").distinct()
    # Counts up to a sequence, so a range is a difference of two: no range meets all rows.
    from pyspark.sql import Window

    block = F.shiftright("sequence", 16)
    sizes = seqs.groupBy(block.alias("block")).agg(F.count("*").alias("n"))
    before = sizes.select("block", (F.sum("n").over(Window.partitionBy(F.lit(0)).orderBy("block")) - F.col("n")).alias("before"))
    ranked = seqs.withColumn("block", block).withColumn("r", F.row_number().over(Window.partitionBy("block").orderBy("sequence"))).join(before, "block").select(F.col("sequence").alias("at"), (F.col("before") + F.col("r")).alias("rank"))
    ends = runs.select("run_number", "publication_count", F.explode(F.array(F.struct(F.lit("a").alias("end"), (F.col("first_sequence") - 1).alias("at")), F.struct(F.lit("b").alias("end"), F.col("last_sequence").alias("at")))).alias("e")).select("run_number", "publication_count", "e.end", "e.at")
    marks = ranked.select("at", "rank", F.lit(None).cast("bigint").alias("run_number"), F.lit(None).cast("bigint").alias("publication_count"), F.lit(None).cast("string").alias("end")).unionByName(
        ends.select("at", F.lit(None).cast("bigint").alias("rank"), "run_number", "publication_count", "end")
    )
    part = F.shiftright("at", 16)
    inside = F.max("rank").over(Window.partitionBy("part").orderBy("at", F.col("rank").isNull()).rowsBetween(Window.unboundedPreceding, 0))
    upto = marks.withColumn("part", part).withColumn("upto", inside).where("run_number is not null")
    # Where the block has no sequence before the mark, all of the blocks before it count.
    both = sizes.unionByName(upto.select(F.col("part").alias("block"), F.lit(0).cast("bigint").alias("n")).distinct()).groupBy("block").agg(F.sum("n").alias("n"))
    whole = Window.partitionBy(F.lit(0)).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)  # one row a block
    earlier = both.select(F.col("block").alias("part"), F.coalesce(F.sum("n").over(whole), F.lit(0)).alias("earlier"))
    y = upto.join(earlier, "part").withColumn("upto", F.coalesce("upto", "earlier"))
    found = y.groupBy("run_number", "publication_count").agg((F.max(F.when(F.col("end") == "b", F.col("upto"))) - F.max(F.when(F.col("end") == "a", F.col("upto")))).alias("found"))
    found = found.withColumn("found", F.greatest(F.lit(0), "found"))
    state = F.when(F.col("found") == F.col("publication_count"), "complete").when(F.col("found") < F.col("publication_count"), "short").otherwise("over")
    return found.select("run_number", "publication_count", F.col("found").cast("bigint").alias("found"), state.alias("state"))


def book_model_mismatches(spark, d):
    """What books state against what their rows give: fields that differ."""
    stated = table(spark, d, "books").groupBy(F.col("name").alias("book")).agg(F.max("pages").alias("pages"), F.max("chunks").alias("chunks"), F.min("source").alias("source"))
    pages = table(spark, d, "pdf").groupBy("book").agg((F.max("page_index") + 1).cast("bigint").alias("pages"), F.min("source").alias("source"))
    found = pages.join(table(spark, d, "chunks").groupBy("book").agg(F.countDistinct("chunk_number").alias("chunks")), "book", "left")
    x = R.mismatched_fields(stated, found, "book", ["pages", "chunks", "source"])
    return x.select("book", F.array_join("mismatches", ",").alias("mismatches"))


def chunk_replay(spark, d):
    """The state of chunks at the last committed sequence."""
    runs = table(spark, d, "selection_inventories").where(normal_state("outcome") == "committed")
    head = runs.agg(F.max("last_sequence")).first()[0]
    x = table(spark, d, "chunks").where("book is not null and chunk_number is not null").select("sequence", "book", "chunk_number", normal_state("detection_state").alias("detection"), normal_state("equation_state").alias("equation"))
    return R.replayed(x, ["book", "chunk_number"], "sequence", head)


#: The states of a recognition and where each may go.
WORKFLOW = {"pending": ("running", "not_requested"), "running": ("done", "failed", "pending"), "failed": ("pending", "running"), "not_requested": ("pending",), "done": ()}


def recognition_transitions(spark, d):
    x = table(spark, d, "chunks").where("sequence is not null and book is not null and chunk_number is not null").groupBy("sequence").agg(F.min(F.struct("book", "chunk_number", F.coalesce(normal_state("equation_state"), F.lit("")).alias("state"))).alias("r")).select("sequence", "r.*")
    return R.transitions(x, ["book", "chunk_number"], "sequence", "state", WORKFLOW, ["pending", "not_requested"]).groupBy("before", "after", "verdict").agg(F.count("*").alias("rows"))


def order_edge_findings(spark, d):
    """Edges between table-of-contents entries that follow each other, some turned round, doubled or led astray."""
    from pyspark.sql import Window

    toc = table(spark, d, "toc_entries").where("entry_id is not null").groupBy("entry_id").agg(F.min("book").alias("book"))
    w = Window.partitionBy("book").orderBy("entry_id")
    x = toc.select("entry_id", F.lead("entry_id").over(w).alias("next"), F.lead("entry_id", 2).over(w).alias("later"), F.row_number().over(w).alias("n"))
    edges = x.where("next is not null").select(F.col("entry_id").alias("a"), F.col("next").alias("b"))
    more = x.where("later is not null and n % 5 = 1").select(F.col("later"), F.col("entry_id")).union(x.where("next is not null and n % 7 = 2").select("entry_id", "next"))
    more = more.union(x.where("n % 11 = 3").select("entry_id", "entry_id")).union(x.where("n % 13 = 4").select("entry_id", F.concat("entry_id", F.lit("?"))))
    return R.edge_findings(toc.select(F.col("entry_id").alias("id")), edges.union(more))


def limitation_scope(spark, d):
    """Reasons as limitations of the equations that have them, applied to the pages of a book."""
    once = V.once(table(spark, d, "equation_index").select("record_id", "book", "reasons"), "record_id")
    limits = once.select(F.explode("reasons").alias("limitation"), "record_id").groupBy("limitation").agg(F.collect_list("record_id").alias("affected"))
    x = R.applicable(limits, once.select(F.col("book").alias("owner"), F.col("record_id").alias("id")))
    return x.select("limitation", "owner", F.size("ids").cast("bigint").alias("ids"), F.element_at("ids", 1).alias("first_id"))


def producer_findings(spark, d):
    """Scanned pages as producers, results as the items that use them."""
    pages = V.pages(spark, d).where("extraction_method = 'ocr'").select(F.col("page_id").alias("producer"))
    items = V.once(table(spark, d, "ocr_results").select("selection_result_id", "page_id"), "selection_result_id").where("page_id is not null").select(F.col("selection_result_id").alias("item"), F.col("page_id").alias("producer"))
    return R.producer_audit(pages, items)


def _ledger(spark, d):
    """Line items as steps of an order: each consumes the part of the one before and outputs its own; some consume what isn't there yet."""
    x = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("trace"), F.col("l_linenumber").alias("step"), F.col("l_partkey").alias("part")).distinct()
    ids = lambda n: F.concat_ws("#", "trace", n.cast("string"))
    out = x.select("trace", "step", F.lit("outputs").alias("kind"), ids(F.col("step")).alias("id"))
    used = x.select("trace", "step", F.lit("consumes").alias("kind"), ids(F.when(F.col("part") % 10 == 0, F.col("step") + 1).otherwise(F.col("step") - 1)).alias("id"))
    again = x.where("part % 17 = 0 and step > 1").select("trace", "step", F.lit("outputs").alias("kind"), ids(F.col("step") - 1).alias("id"))
    return R.ledger_audit(x.select("trace", ids(F.lit(0)).alias("id")).distinct(), out.union(used).union(again))


def derivation_finals(spark, d):
    return _ledger(spark, d)[0]


def derivation_problems(spark, d):
    return _ledger(spark, d)[1]


QUERIES = {f.__name__: f for f in (
    extraction_work_list, page_artifacts, artifact_bundles, artifact_verification, materialization_outcomes, layer_counts, completion_gate, book_model_mismatches, chunk_replay, recognition_transitions, order_edge_findings, limitation_scope,
    producer_findings, derivation_finals, derivation_problems)}

ART = """p AS (SELECT book AS document, page_index, min(text) AS t FROM pdf WHERE page_index IS NOT NULL AND book IS NOT NULL GROUP BY ALL HAVING min(text) IS NOT NULL),
      a AS (SELECT document, page_index, 'pages/page-' || lpad((page_index + 1)::VARCHAR, 5, '0') || '.txt' AS path, '# Page ' || (page_index + 1) || chr(10) || chr(10) || t AS text FROM p),
      m AS (SELECT *, octet_length(encode(text))::BIGINT AS byte_size, sha256(text) AS sha256 FROM a)"""
RECS = """recs AS (SELECT 'pages' AS collection, page_id AS id, sha256(coalesce(min(text), '-')) AS sha FROM pdf GROUP BY page_id UNION ALL SELECT 'toc', entry_id, sha256(coalesce(min(title), '-')) FROM toc_entries GROUP BY entry_id
      UNION ALL SELECT 'books', name, sha256(coalesce(min(stage), '-')) FROM books GROUP BY name)"""
_ST = lambda c: rf"lower(regexp_replace({c}, '^\s+|\s+$', '', 'g'))"
LEDGER = """x AS (SELECT DISTINCT l_orderkey AS trace, l_linenumber AS step, l_partkey AS part FROM lineitem), roots AS (SELECT DISTINCT trace, trace || '#0' AS id FROM x),
      outs AS (SELECT trace, step::BIGINT AS pos, trace || '#' || step AS id FROM x UNION ALL SELECT trace, step, trace || '#' || (step - 1) FROM x WHERE part % 17 = 0 AND step > 1),
      made AS (SELECT trace, id, 0 AS pos FROM roots UNION ALL SELECT trace, id, pos FROM outs), used AS (SELECT trace, step::BIGINT AS step, trace || '#' || CASE WHEN part % 10 = 0 THEN step + 1 ELSE step - 1 END AS id FROM x),
      f AS (SELECT trace, id, min(pos) AS pos, count(*) AS n FROM made GROUP BY ALL)"""

SQL = {
    "extraction_work_list": """WITH x AS (SELECT doc_id, min(text) AS text FROM documents WHERE doc_id IS NOT NULL GROUP BY doc_id HAVING min(text) IS NOT NULL)
      SELECT doc_id, 'extraction-cache:sha256:' || sha256('["' || doc_id || '","' || sha256(text) || '","native","1"]') AS key FROM x WHERE NOT (doc_id % 3 = 0 AND doc_id % 5 <> 0)""",
    "page_artifacts": f"WITH {ART} SELECT document, page_index, path, byte_size, sha256 FROM m",
    "artifact_bundles": f"WITH {ART} SELECT document, count(*) AS members, 'artifact-bundle:sha256:' || sha256(string_agg(path || ':' || sha256 || ':' || byte_size, chr(10) ORDER BY path)) AS bundle_id FROM m GROUP BY document",
    "artifact_verification": f"""WITH {ART} SELECT document, path, CASE page_index % 13 WHEN 1 THEN 'missing' WHEN 2 THEN 'byte_size' WHEN 3 THEN 'sha256' WHEN 4 THEN 'missing' END AS problem FROM m WHERE page_index % 13 IN (1, 2, 3, 4)
      UNION ALL SELECT document, path || '~', 'unexpected' FROM m WHERE page_index % 13 = 4""",
    "materialization_outcomes": f"""WITH {RECS}, o AS (SELECT collection, ('0x' || sha[1:4])::INT % 10 AS s FROM recs)
      SELECT coalesce(collection, 'total') AS collection, count(*) FILTER (WHERE s = 0) AS created, count(*) FILTER (WHERE s > 1) AS unchanged, count(*) FILTER (WHERE s = 1) AS conflict FROM o GROUP BY ROLLUP (collection)""",
    "layer_counts": f"WITH {RECS} SELECT collection, count(*) AS records, count(DISTINCT sha) AS contents FROM recs GROUP BY collection",
    "completion_gate": """WITH r AS (SELECT DISTINCT run_number, first_sequence, last_sequence, publication_count FROM selection_inventories WHERE run_number IS NOT NULL AND first_sequence IS NOT NULL AND last_sequence IS NOT NULL),
      f AS (SELECT run_number, publication_count, (SELECT count(DISTINCT sequence) FROM chunks c WHERE c.sequence BETWEEN r.first_sequence AND r.last_sequence) AS found FROM r)
      SELECT run_number, publication_count, found, CASE WHEN found = publication_count THEN 'complete' WHEN found < publication_count THEN 'short' ELSE 'over' END AS state FROM f""",
    "book_model_mismatches": """WITH s AS (SELECT name AS book, max(pages) AS pages, max(chunks) AS chunks, min(source) AS source FROM books GROUP BY name), p AS (SELECT book, max(page_index)::BIGINT + 1 AS pages, min(source) AS source FROM pdf GROUP BY book),
      c AS (SELECT book, count(DISTINCT chunk_number) AS chunks FROM chunks GROUP BY book), f AS (SELECT p.*, c.chunks FROM p LEFT JOIN c USING (book))
      SELECT coalesce(s.book, f.book) AS book, CASE WHEN s.book IS NULL THEN 'missing_left' WHEN f.book IS NULL THEN 'missing_right' ELSE concat_ws(',', CASE WHEN s.pages IS DISTINCT FROM f.pages THEN 'pages' END, CASE WHEN s.chunks IS DISTINCT FROM f.chunks THEN 'chunks' END,
      CASE WHEN s.source IS DISTINCT FROM f.source THEN 'source' END) END AS mismatches FROM s FULL JOIN f ON s.book = f.book""",
    "chunk_replay": f"""WITH h AS (SELECT max(last_sequence) AS head FROM selection_inventories WHERE {_ST("outcome")} = 'committed'), x AS (SELECT sequence, book, chunk_number, {_ST("detection_state")} AS detection, {_ST("equation_state")} AS equation FROM chunks
        WHERE sequence <= (SELECT head FROM h) AND book IS NOT NULL AND chunk_number IS NOT NULL)
      SELECT * FROM x QUALIFY row_number() OVER (PARTITION BY book, chunk_number ORDER BY sequence DESC, detection NULLS FIRST, equation NULLS FIRST) = 1""",
    "recognition_transitions": f"""WITH x AS (SELECT sequence, min({{'book': book, 'c': chunk_number, 's': coalesce({_ST("equation_state")}, '')}}) AS r FROM chunks WHERE sequence IS NOT NULL AND book IS NOT NULL AND chunk_number IS NOT NULL GROUP BY sequence),
      y AS (SELECT lag(r.s) OVER (PARTITION BY r.book, r.c ORDER BY sequence) AS "before", r.s AS "after" FROM x)
      SELECT "before", "after", CASE WHEN "before" IS NULL THEN CASE WHEN "after" IN ('pending', 'not_requested') THEN 'start' ELSE 'refused' END WHEN "before" = "after" THEN 'stay'
      WHEN "before" || '>' || "after" IN ('pending>running', 'pending>not_requested', 'running>done', 'running>failed', 'running>pending', 'failed>pending', 'failed>running', 'not_requested>pending') THEN 'fired' ELSE 'refused' END AS verdict, count(*) AS rows FROM y GROUP BY ALL""",
    "order_edge_findings": """WITH RECURSIVE t AS (SELECT entry_id, min(book) AS book FROM toc_entries WHERE entry_id IS NOT NULL GROUP BY entry_id),
      x AS (SELECT entry_id, lead(entry_id) OVER w AS nxt, lead(entry_id, 2) OVER w AS later, row_number() OVER w AS n FROM t WINDOW w AS (PARTITION BY book ORDER BY entry_id)),
      e AS (SELECT entry_id AS a, nxt AS b FROM x WHERE nxt IS NOT NULL UNION ALL SELECT later, entry_id FROM x WHERE later IS NOT NULL AND n % 5 = 1 UNION ALL SELECT entry_id, nxt FROM x WHERE nxt IS NOT NULL AND n % 7 = 2
        UNION ALL SELECT entry_id, entry_id FROM x WHERE n % 11 = 3 UNION ALL SELECT entry_id, entry_id || '?' FROM x WHERE n % 13 = 4),
      g AS (SELECT DISTINCT a, b FROM e WHERE a <> b AND NOT ends_with(b, '?')), r AS (SELECT a, b FROM g UNION SELECT r.a, g.b FROM r JOIN g ON r.b = g.a), c AS (SELECT a AS id FROM r WHERE a = b),
      fwd AS (SELECT id FROM c UNION SELECT r.b FROM r JOIN c ON r.a = c.id), bwd AS (SELECT id FROM c UNION SELECT r.a FROM r JOIN c ON r.b = c.id)
      SELECT DISTINCT a, b, 'unknown' AS finding FROM e WHERE ends_with(b, '?') UNION ALL SELECT DISTINCT a, b, 'self' FROM e WHERE a = b UNION ALL SELECT a, b, 'duplicate' FROM e GROUP BY a, b HAVING count(*) > 1
      UNION ALL SELECT a, b, 'cyclic' FROM g WHERE a IN (SELECT id FROM fwd) AND b IN (SELECT id FROM bwd)""",
    "limitation_scope": """WITH o AS (SELECT record_id, min({'b': book, 'r': reasons}) AS x FROM equation_index WHERE record_id IS NOT NULL GROUP BY record_id), e AS (SELECT DISTINCT record_id, x.b AS owner, unnest(x.r) AS limitation FROM o)
      SELECT limitation, owner, count(*) AS ids, min(record_id) AS first_id FROM e GROUP BY ALL""",
    "producer_findings": f"""WITH {V.SQL_OCR}, p AS (SELECT DISTINCT page_id FROM pdf WHERE extraction_method = 'ocr'), u AS (SELECT page_id, count(*) AS n FROM ocr WHERE page_id IS NOT NULL GROUP BY page_id)
      SELECT coalesce(p.page_id, u.page_id) AS producer, CASE WHEN p.page_id IS NULL THEN 'unknown' WHEN n IS NULL THEN 'unused' ELSE 'used_again' END AS problem FROM p FULL JOIN u ON p.page_id = u.page_id WHERE p.page_id IS NULL OR n IS NULL OR n > 1""",
    "derivation_finals": f"WITH {LEDGER} SELECT trace, id FROM f WHERE (trace, id) NOT IN (SELECT (trace, id) FROM used)",
    "derivation_problems": f"""WITH {LEDGER} SELECT DISTINCT u.trace, u.step, 'unknown_input' AS problem FROM used u LEFT JOIN f ON f.trace = u.trace AND f.id = u.id WHERE f.pos IS NULL OR f.pos >= u.step
      UNION SELECT DISTINCT m.trace, m.pos, 'repeated_output' FROM made m JOIN f ON f.trace = m.trace AND f.id = m.id AND n > 1 WHERE m.pos > f.pos""",
}
