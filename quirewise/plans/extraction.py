"""Extraction queries: texts as files, a swapped policy, responses of models, lineage of detections, groups of drawings."""

from __future__ import annotations

from pyspark.sql import functions as F

from quirewise.base import Consensus, Inventory, Pipeline, Projector
from quirewise.functions import contract as K
from quirewise.functions.identity import stable_id
from quirewise.operators import layout as L
from quirewise.plans.detections import DET, _detections
from quirewise.plans.equations import ASSEMBLED, _assembled
from quirewise.plans.pagelayout import ITEMS, _items
from quirewise.operators import equations as E
from quirewise.sources import extractors as X
from quirewise.sources import views as V
from quirewise.storage import table


def _extracted(spark, d):
    docs = V.once(table(spark, d, "documents").select("doc_id", "text"), "doc_id").where("text is not null")
    # A form feed before each paragraph that begins so.
    paged = F.regexp_replace("text", r"\n\n(?=The |In |Die )", "\f")
    return X.extracted(docs.select(F.col("doc_id").cast("string").alias("source"), F.encode(paged, "UTF-8").alias("content")), X.PlainText())


def extracted_pages(spark, d):
    return X.page_evidence(_extracted(spark, d)).groupBy("source").agg(F.sum("blocks").alias("blocks"), F.sum("chars").alias("chars"))


def extraction_projection(spark, d):
    """The nested extraction of a book as flat collections with stable ids: documents, pages, blocks; one row a record."""
    pages = V.once(V.pages(spark, d).where("book is not null").select("page_id", "book", "page_index", "text"), "page_id")
    lines = F.transform(F.split("text", "\n", -1), lambda t, i: F.struct(i.alias("ordinal"), t.alias("text")))
    nested = pages.groupBy("book").agg(F.collect_list(F.struct("page_id", "page_index", lines.alias("blocks"))).alias("pages"))
    page = nested.select("book", F.explode("pages").alias("p"))
    block = page.select("book", "p.page_id", F.explode("p.blocks").alias("b"))
    return (
        nested.select(F.lit("documents").alias("collection"), stable_id("document", F.col("book")).alias("id"))
        .union(page.select(F.lit("pages"), stable_id("page", F.col("book"), F.col("p.page_id"))))
        .union(block.select(F.lit("blocks"), stable_id("block", F.col("book"), F.col("page_id"), F.col("b.ordinal"))))
    )


def rater_consensus(spark, d):
    """The consensus policy as a swappable aggregate, over the votes of raters."""
    votes = table(spark, d, "toxicity_labels").where("doc_id is not null").select("doc_id", "rater", F.col("abusive").alias("value")).distinct()
    return Consensus(("doc_id",))(rows=votes)


class _Named(Projector):
    contract, needs, gives = "named-documents", ("rows",), ("id", "kind")

    def act(self, *, rows):
        return rows.where("doc_id is not null").select(F.col("doc_id").cast("string").alias("id"), F.coalesce("kind", F.lit("")).alias("kind")).distinct()


def pipeline_inventory(spark, d):
    """A pipeline of a projector and an inventory."""
    return Pipeline(_Named(), Inventory("id", lambda rows: F.col("kind")))(rows=table(spark, d, "documents"))


def model_responses(spark, d):
    """Answers of a model: a candidate order if the JSON is strict and whole, else a limitation."""
    x = _items(spark, d).select("id", F.substring("id", -1, 1).alias("c"))
    text = F.when(F.col("c").isin("0", "1"), F.concat(F.lit('{"order": ["'), "id", F.lit('"], "order": []}'))).when(F.col("c") == "2", F.lit('{"order": [')).when(F.col("c") == "3", F.lit('{"answer": 1}')).otherwise(F.concat(F.lit('{"order": ["'), "id", F.lit('"]}')))
    y = x.select("id", text.alias("t")).withColumn("status", K.json_status()(F.col("t"))).withColumn("order", F.from_json("t", "order array<string>")["order"])
    limitation = F.when(F.col("status") != "ok", F.col("status")).when(F.col("order").isNull(), "no_order")
    return y.select("id", limitation.alias("limitation"), F.when(limitation.isNull(), F.array_join("order", ",")).alias("candidate"))


def detection_lineage(spark, d):
    """Detections with their page's source, and those whose page or category isn't there."""
    pages = V.pages(spark, d).where("book is not null and page_index is not null").select("book", F.floor(F.col("page_index") / 4).alias("page_index"), "source").groupBy("book", "page_index").agg(F.min("source").alias("source"), F.lit(True).alias("there")).where("page_index % 5 > 0")
    categories = spark.createDataFrame([("primary", 1), ("auxiliary", 2)], "label string, category bigint")
    x = _detections(spark, d).select("id", "book", "page_index", "label").join(pages, ["book", "page_index"], "left").join(categories, "label", "left")
    finding = F.when(F.col("there").isNull(), "unknown_image").when(F.col("category").isNull(), "unknown_category").otherwise("resolved")
    return x.select("id", finding.alias("finding"), F.when(finding == "resolved", F.col("source")).alias("source"), F.when(finding == "resolved", F.col("category")).alias("category"))


def drawing_groups(spark, d):
    """Drawings of at least 4 points and 64 square points whose boxes lie within 24 points, directly or through others."""
    b = F.col("box")
    w, h = b["x1"] - b["x0"], b["y1"] - b["y0"]
    x = _items(spark, d).where((F.least(w, h) >= 4) & (w * h >= 64))
    return L.components(x.select("id"), L.near_boxes(x, ["book", "page_index"], 24.0)).groupBy("component").agg(F.count("*").alias("drawings"))


def recognition_plan(spark, d):
    """Equations to be recognized, in batches of 16 of a book by id: those that are eligible and have no proposal yet."""
    from pyspark.sql import Window

    books = V.once(table(spark, d, "equation_index").select("record_id", "book"), "record_id")
    x = _assembled(spark, d).where((F.size(E.ineligibility(F.col("kind"), F.col("rejected"), F.col("detector"))) == 0) & F.col("latex_proposal").isNull()).select("record_id").join(books, "record_id")
    n = F.row_number().over(Window.partitionBy("book").orderBy("record_id")) - 1
    return x.select("record_id", "book", F.floor(n / 16).alias("batch"))


def canary_summary(spark, d):
    """Stages of equations by book: seen, displayed, eligible, proposed, and the total."""
    books = V.once(table(spark, d, "equation_index").select("record_id", "book"), "record_id")
    x = _assembled(spark, d).join(books, "record_id")
    n = lambda c: F.sum(F.coalesce(c, F.lit(False)).cast("bigint"))
    eligible = F.size(E.ineligibility(F.col("kind"), F.col("rejected"), F.col("detector"))) == 0
    y = x.rollup("book").agg(F.count("*").alias("seen"), n(F.col("kind") == "display").alias("displayed"), n(eligible).alias("eligible"), n(F.col("latex_proposal").isNotNull()).alias("proposed"), F.grouping("book").alias("g"))
    return y.select(F.when(F.col("g") == 1, "total").otherwise(F.col("book")).alias("book"), "seen", "displayed", "eligible", "proposed")


QUERIES = {f.__name__: f for f in (extracted_pages, extraction_projection, rater_consensus, pipeline_inventory, model_responses, detection_lineage, drawing_groups, recognition_plan, canary_summary)}

SQL = {
    "extracted_pages": """WITH x AS (SELECT doc_id, min(text) AS t FROM documents WHERE doc_id IS NOT NULL GROUP BY doc_id HAVING min(text) IS NOT NULL),
      b AS (SELECT doc_id, unnest(string_split(t, chr(10) || chr(10))) AS b FROM x)
      SELECT doc_id::VARCHAR AS source, count(*) FILTER (WHERE regexp_matches(b, '[^\\s\\p{Z}\\x1c-\\x1f\\x85]')) AS blocks, coalesce(sum(length(b)) FILTER (WHERE regexp_matches(b, '[^\\s\\p{Z}\\x1c-\\x1f\\x85]')), 0)::BIGINT AS chars FROM b GROUP BY doc_id""",
    "extraction_projection": """WITH p AS (SELECT page_id, min({'b': book, 'i': page_index, 't': text}) AS z FROM pdf WHERE book IS NOT NULL AND page_id IS NOT NULL GROUP BY page_id),
      l AS (SELECT z.b AS b, page_id, generate_subscripts(string_split(z.t, chr(10)), 1) - 1 AS i FROM p WHERE z.t IS NOT NULL)
      SELECT DISTINCT 'documents' AS collection, 'document:sha256:' || sha256('["' || z.b || '"]') AS id FROM p UNION ALL SELECT 'pages', 'page:sha256:' || sha256('["' || z.b || '","' || page_id || '"]') FROM p
      UNION ALL SELECT 'blocks', 'block:sha256:' || sha256('["' || b || '","' || page_id || '","' || i || '"]') FROM l""",
    "rater_consensus": """SELECT doc_id, CASE WHEN count(abusive) < 2 THEN 'too_few' WHEN count(DISTINCT abusive) > 1 THEN 'no_consensus' ELSE 'admitted' END AS status, CASE WHEN count(abusive) >= 2 AND count(DISTINCT abusive) = 1 THEN min(abusive) END AS value
      FROM (SELECT DISTINCT doc_id, rater, abusive FROM toxicity_labels WHERE doc_id IS NOT NULL) GROUP BY doc_id""",
    "pipeline_inventory": """WITH r AS (SELECT DISTINCT doc_id::VARCHAR AS id, sha256(coalesce(kind, '')) AS content, substr(sha256(doc_id::VARCHAR), 1, 4) AS part FROM documents WHERE doc_id IS NOT NULL),
      p AS (SELECT part, count(*) AS n, sha256(string_agg(id, chr(10) ORDER BY id)) AS ids, sha256(string_agg(id || chr(9) || content, chr(10) ORDER BY id || chr(9) || content)) AS pairs FROM r GROUP BY part),
      q AS (SELECT part[1:2] AS part, sum(n) AS n, sha256(string_agg(ids, chr(10) ORDER BY part)) AS ids, sha256(string_agg(pairs, chr(10) ORDER BY part)) AS pairs FROM p GROUP BY part[1:2])
      SELECT sum(n)::BIGINT AS rows, sha256(string_agg(ids, chr(10) ORDER BY part)) AS ids_sha256, sha256(string_agg(pairs, chr(10) ORDER BY part)) AS content_sha256 FROM q""",
    "model_responses": f"""WITH {ITEMS} SELECT id, CASE WHEN right(id, 1) IN ('0', '1') THEN 'duplicate_key' WHEN right(id, 1) = '2' THEN 'malformed' WHEN right(id, 1) = '3' THEN 'no_order' END AS limitation, CASE WHEN right(id, 1) NOT IN ('0', '1', '2', '3') THEN id END AS candidate FROM items""",
    "detection_lineage": f"""WITH {DET}, p AS (SELECT book, page_index, min(source) AS source FROM (SELECT book, floor(page_index / 4)::BIGINT AS page_index, source FROM pdf WHERE book IS NOT NULL AND page_index IS NOT NULL) WHERE page_index % 5 > 0 GROUP BY book, page_index),
      x AS (SELECT id, CASE WHEN p.book IS NULL THEN 'unknown_image' WHEN label NOT IN ('primary', 'auxiliary') THEN 'unknown_category' ELSE 'resolved' END AS finding, source, CASE label WHEN 'primary' THEN 1 WHEN 'auxiliary' THEN 2 END AS category
        FROM det LEFT JOIN p ON p.book = det.book AND p.page_index = det.page_index)
      SELECT id, finding, CASE WHEN finding = 'resolved' THEN source END AS source, CASE WHEN finding = 'resolved' THEN category END AS category FROM x""",
    "drawing_groups": f"""WITH RECURSIVE {ITEMS}, n AS (SELECT * FROM items WHERE least(x1 - x0, y1 - y0) >= 4 AND (x1 - x0) * (y1 - y0) >= 64),
      e AS (SELECT a.id AS a, b.id AS b FROM n a JOIN n b ON a.book = b.book AND a.page_index = b.page_index AND a.id <> b.id AND a.x0 <= b.x1 + 24 AND b.x0 <= a.x1 + 24 AND a.y0 <= b.y1 + 24 AND b.y0 <= a.y1 + 24),
      r AS (SELECT id, id AS other FROM n UNION SELECT r.id, e.b FROM r JOIN e ON e.a = r.other) SELECT component, count(*) AS drawings FROM (SELECT id, min(other) AS component FROM r GROUP BY id) GROUP BY component""",
    "recognition_plan": f"""{ASSEMBLED} SELECT record_id, book, (row_number() OVER (PARTITION BY book ORDER BY record_id) - 1) // 16 AS batch FROM b WHERE kind = 'display' AND NOT rejected AND detector = 'proposed' AND latex_proposal IS NULL""",
    "canary_summary": f"""{ASSEMBLED} SELECT CASE WHEN grouping(book) = 1 THEN 'total' ELSE book END AS book, count(*) AS seen, count(*) FILTER (WHERE kind = 'display') AS displayed, count(*) FILTER (WHERE kind = 'display' AND NOT rejected AND detector = 'proposed') AS eligible,
      count(latex_proposal) AS proposed FROM b GROUP BY ROLLUP (book)""",
}
