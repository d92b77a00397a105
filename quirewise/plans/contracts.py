"""Queries over contract functions."""

from __future__ import annotations

import unicodedata

from pyspark.sql import functions as F

from quirewise.functions import contract as K
from quirewise.sources import views as V
from quirewise.storage import table


def canonical_json(spark, d):
    x = table(spark, d, "toc_entries").select("entry_id", "title", "level", "page_index", "book").distinct()
    return x.select("entry_id", F.sha2(K.canonical_object(title=F.col("title"), level=F.col("level"), page_index=F.col("page_index"), book=F.col("book")), 256).alias("sha256"))


def strict_json(spark, d):
    """Objects of order keys, some broken on purpose."""
    k = F.col("o_orderkey").cast("string")
    text = (
        F.when(F.col("o_orderkey") % 7 == 1, F.concat(F.lit('{"a":'), k, F.lit(',"b":1,"a":2}'))).when(F.col("o_orderkey") % 7 == 2, F.concat(F.lit('{"a":['), k, F.lit(",NaN]}")))
        .when(F.col("o_orderkey") % 7 == 3, F.concat(F.lit('{"a":'), k, F.lit(",}"))).when(F.col("o_orderkey") % 7 == 4, F.concat(F.repeat(F.lit("["), 65), k, F.repeat(F.lit("]"), 65)))
        .otherwise(F.concat(F.lit('{"a":'), k, F.lit(',"b":"[[{\\"x"}')))
    )
    return table(spark, d, "orders").select("o_orderkey", K.json_status()(text).alias("status"))


def language_tags(spark, d):
    """Tags made of a page's language and its number, well formed or not."""
    n = F.col("page_index")
    tag = (
        F.when(n % 9 == 0, F.upper("lang")).when(n % 9 == 1, F.concat("lang", F.lit("-LATN-"), F.lit("de"))).when(n % 9 == 2, F.concat("lang", F.lit("-419-1994"))).when(n % 9 == 3, F.concat("lang", F.lit("_DE")))
        .when(n % 9 == 4, F.concat("lang", F.lit("-rozaj-Rozaj"))).when(n % 9 == 5, F.concat("lang", F.lit("-u-CO-phonebk-x-Private"))).when(n % 9 == 6, F.lit("X-abc")).when(n % 9 == 7, F.concat("lang", F.lit("-u-co-u-nu"))).otherwise(F.concat("lang", F.lit("-yue-hant-HK")))
    )
    x = table(spark, d, "pdf").select("page_id", "lang", "page_index").distinct()
    return x.select("page_id", K.language_tag(tag).alias("tag"))


def digest_checks(spark, d):
    """Digests of documents, every seventh one false, every eleventh one in capitals."""
    x = V.once(table(spark, d, "documents").select("doc_id", "text"), "doc_id").where("text is not null")
    right = F.sha2(F.when(F.col("doc_id") % 7 == 0, F.concat("text", F.lit("x"))).otherwise(F.col("text")), 256)
    given = F.when(F.col("doc_id") % 11 == 0, F.upper(right)).otherwise(right)
    return x.select("doc_id", K.is_digest(given).alias("canonical"), (given == F.sha2("text", 256)).alias("verified"))


def media_type_heads(spark, d):
    head = F.element_at(F.array(*[F.lit(h) for h in ("89504E470D0A1A0A", "FFD8FFE0", "255044462D312E37", "524946460000000057454250", "5249464600000000", "474946")]), (F.col("doc_id") % 6 + 1).cast("int"))
    x = table(spark, d, "documents").where("doc_id is not null").select("doc_id").distinct()
    return x.select("doc_id", K.media_type(F.concat(F.unhex(head), F.encode(F.lit(" body"), "UTF-8"))).alias("media_type"))


def normal_forms(spark, d):
    x = V.once(table(spark, d, "equation_index").select("record_id", "sanitized_native_text"), "record_id").where("sanitized_native_text is not null")
    c = F.col("sanitized_native_text")
    return x.select("record_id", F.sha2(K.matched_form(c), 256).alias("matched"), F.sha2(K.label_form(c), 256).alias("label"), F.sha2(K.collision_form(c), 256).alias("collision"))


def affine_boxes(spark, d):
    """Line boxes of pages rendered at 144 dpi and turned by quarters, in points."""
    q, s = F.col("order") % 4, F.lit(0.5)
    pick = lambda *v: F.element_at(F.array(*[F.lit(float(x)) for x in v]), (q + 1).cast("int"))
    matrix = [pick(1, 0, -1, 0) * s, pick(0, 1, 0, -1) * s, pick(0, -1, 0, 1) * s, pick(1, 0, -1, 0) * s, pick(0, 792, 612, 0), pick(0, 0, 792, 612)]
    x = V.ocr_lines(spark, d).select("selection_result_id", F.col("order").cast("bigint").alias("order"), K.mapped_box(F.col("box"), matrix).alias("b"))
    return x.select("selection_result_id", "order", *[F.round(f"b.{c}", 6).alias(c) for c in ("x0", "y0", "x1", "y1")])


def box_relations(spark, d):
    """Neighbouring tokens of a result: how their boxes lie."""
    from pyspark.sql import Window

    w = Window.partitionBy("selection_result_id").orderBy("order")
    x = V.ocr_tokens(spark, d).withColumn("other", F.lead("box").over(w)).where("other is not null")
    a, b = F.col("box"), F.col("other")
    return x.select("selection_result_id", F.col("order").cast("bigint").alias("order"), K.contains(a, b).alias("contains"), K.meet_across(a, b).alias("across"), K.meet_down(a, b).alias("down"), K.gap_across(a, b).alias("gap_x"), K.gap_down(a, b).alias("gap_y"))


def run_stamps(spark, d):
    x = table(spark, d, "selection_inventories").select("run_number", "started_at", "finished_at").distinct()
    return x.select("run_number", K.stamp(F.col("started_at")).alias("started"), K.stamp(F.col("finished_at")).alias("finished"))


def metadata_pairs(spark, d):
    """The columns of books as metadata: sorted pairs, and one looked up."""
    x = table(spark, d, "books").groupBy("name").agg(F.min(F.struct("source", "stage", "state")).alias("r"))
    made = F.create_map(F.lit("state"), F.col("r.state"), F.lit("source"), F.col("r.source"), F.lit("stage"), F.col("r.stage"))
    pairs = F.array_join(F.transform(K.metadata(made), lambda e: F.concat(e["key"], F.lit("="), F.coalesce(e["value"], F.lit("")))), ";")
    return x.select("name", pairs.alias("pairs"), F.element_at(made, F.lit("stage")).alias("stage"))


QUERIES = {f.__name__: f for f in (canonical_json, strict_json, language_tags, digest_checks, media_type_heads, normal_forms, affine_boxes, box_relations, run_stamps, metadata_pairs)}


def _compatible(text: str) -> str:
    """NFKC of the characters in use, in SQL."""
    one_from, one_to, out = "", "", f"nfc_normalize({text})"
    for code in [*range(0xA0, 0x2500), *range(0x3000, 0x3001), *range(0xFB00, 0xFB07), *range(0xFF01, 0xFF5F)]:
        c = chr(code)
        k = unicodedata.normalize("NFKC", c)
        if k == c or unicodedata.category(c) in ("Cn", "Lo", "Mn") or unicodedata.normalize("NFC", c) != c and len(k) == 1 and unicodedata.normalize("NFC", c) == k:
            continue
        if len(k) == 1:
            one_from, one_to = one_from + c, one_to + k
        elif code < 0x2100 or 0xFB00 <= code or code in (0x2103, 0x2109, 0x2116, 0x2122):
            out = f"replace({out}, '{c}', '{k}')"
    return f"nfc_normalize(translate({out}, '{one_from}', '{one_to.replace(chr(39), chr(39) * 2)}'))"


_WS = r"'[\s\p{Z}\x1c-\x1f\x85]+'"
_collapsed = lambda x: f"trim(regexp_replace({x}, {_WS}, ' ', 'g'), ' ')"
_G = r"(?i)^([A-Za-z]{2,3}(?:-[A-Za-z]{3}){0,3}|[A-Za-z]{4,8})(?:-([A-Za-z]{4}))?(?:-([A-Za-z]{2}|[0-9]{3}))?((?:-(?:[A-Za-z0-9]{5,8}|[0-9][A-Za-z0-9]{3}))*)((?:-[a-wy-z0-9](?:-[A-Za-z0-9]{2,8})+)*)((?:-x(?:-[A-Za-z0-9]{1,8})+)?)$"
_g = lambda k: f"regexp_extract(t, '{_G}', {k})"

SQL = {
    "canonical_json": "SELECT entry_id, sha256(to_json({'book': book, 'level': level, 'page_index': page_index, 'title': title})) AS sha256 FROM (SELECT DISTINCT entry_id, title, level, page_index, book FROM toc_entries)",
    "strict_json": "SELECT o_orderkey, CASE o_orderkey % 7 WHEN 1 THEN 'duplicate_key' WHEN 2 THEN 'not_finite' WHEN 3 THEN 'malformed' WHEN 4 THEN 'too_deep' ELSE 'ok' END AS status FROM orders",
    "language_tags": f"""WITH x AS (SELECT DISTINCT page_id, lang, page_index FROM pdf), y AS (SELECT page_id, CASE page_index % 9 WHEN 0 THEN upper(lang) WHEN 1 THEN lang || '-LATN-de' WHEN 2 THEN lang || '-419-1994' WHEN 3 THEN lang || '_DE' WHEN 4 THEN lang || '-rozaj-Rozaj'
      WHEN 5 THEN lang || '-u-CO-phonebk-x-Private' WHEN 6 THEN 'X-abc' WHEN 7 THEN lang || '-u-co-u-nu' ELSE lang || '-yue-hant-HK' END AS t FROM x)
      SELECT page_id, CASE WHEN regexp_matches(t, '(?i)^x(-[a-z0-9]{{1,8}})+$') THEN lower(t) WHEN regexp_matches(t, '{_G}') AND len(list_distinct(string_split(lower({_g(4)}), '-'))) = len(string_split(lower({_g(4)}), '-'))
      AND len(list_distinct(regexp_extract_all(lower({_g(5)}) || '-', '-([a-z0-9])-', 1))) = len(regexp_extract_all(lower({_g(5)}) || '-', '-([a-z0-9])-', 1)) THEN lower({_g(1)}) || CASE WHEN {_g(2)} = '' THEN '' ELSE '-' || upper({_g(2)}[1]) || lower({_g(2)}[2:]) END
      || CASE WHEN {_g(3)} = '' THEN '' ELSE '-' || upper({_g(3)}) END || lower({_g(4)}) || lower({_g(5)}) || lower({_g(6)}) END AS tag FROM y""",
    "digest_checks": """WITH x AS (SELECT doc_id, min(text) AS text FROM documents WHERE doc_id IS NOT NULL GROUP BY doc_id HAVING min(text) IS NOT NULL)
      SELECT doc_id, NOT (doc_id % 11 = 0 AND regexp_matches(sha256(CASE WHEN doc_id % 7 = 0 THEN text || 'x' ELSE text END), '[a-f]')) AS canonical, doc_id % 7 <> 0 AND NOT (doc_id % 11 = 0 AND regexp_matches(sha256(text), '[a-f]')) AS verified FROM x""",
    "media_type_heads": "SELECT DISTINCT doc_id, CASE doc_id % 6 WHEN 0 THEN 'image/png' WHEN 1 THEN 'image/jpeg' WHEN 2 THEN 'application/pdf' WHEN 3 THEN 'image/webp' END AS media_type FROM documents WHERE doc_id IS NOT NULL",
    "normal_forms": f"""WITH x AS (SELECT record_id, min(sanitized_native_text) AS t FROM equation_index WHERE record_id IS NOT NULL GROUP BY record_id HAVING min(sanitized_native_text) IS NOT NULL)
      SELECT record_id, sha256({_collapsed(f"replace(lower({_compatible('t')}), 'ß', 'ss')")}) AS matched, sha256({_collapsed("replace(lower(t), 'ß', 'ss')")}) AS label, sha256({_collapsed("nfc_normalize(t)")}) AS collision FROM x""",
    "affine_boxes": f"""WITH {V.SQL_LINES}, m AS (SELECT selection_result_id, "order"::BIGINT AS "order", box, [1.0, 0, -1, 0][o] / 2 AS a, [0.0, 1, 0, -1][o] / 2 AS b, [0.0, -1, 0, 1][o] / 2 AS c, [1.0, 0, -1, 0][o] / 2 AS d, [0.0, 792, 612, 0][o] AS e, [0.0, 0, 792, 612][o] AS f
        FROM (SELECT *, "order" % 4 + 1 AS o FROM lines)),
      p AS (SELECT selection_result_id, "order", [a * box.x0 + c * box.y0 + e, a * box.x1 + c * box.y0 + e, a * box.x0 + c * box.y1 + e, a * box.x1 + c * box.y1 + e] AS xs, [b * box.x0 + d * box.y0 + f, b * box.x1 + d * box.y0 + f, b * box.x0 + d * box.y1 + f, b * box.x1 + d * box.y1 + f] AS ys FROM m)
      SELECT selection_result_id, "order", round(list_min(xs)::DOUBLE, 6) AS x0, round(list_min(ys)::DOUBLE, 6) AS y0, round(list_max(xs)::DOUBLE, 6) AS x1, round(list_max(ys)::DOUBLE, 6) AS y1 FROM p""",
    "box_relations": f"""WITH {V.SQL_TOKENS}, n AS (SELECT selection_result_id, "order"::BIGINT AS "order", box AS a, lead(box) OVER (PARTITION BY selection_result_id ORDER BY "order") AS b FROM tokens)
      SELECT selection_result_id, "order", a.x0 <= b.x0 AND a.y0 <= b.y0 AND a.x1 >= b.x1 AND a.y1 >= b.y1 AS contains, a.x0 < b.x1 AND b.x0 < a.x1 AS across, a.y0 < b.y1 AND b.y0 < a.y1 AS down,
      greatest(0.0, b.x0 - a.x1, a.x0 - b.x1)::DOUBLE AS gap_x, greatest(0.0, b.y0 - a.y1, a.y0 - b.y1)::DOUBLE AS gap_y FROM n WHERE b IS NOT NULL""",
    "run_stamps": "SELECT DISTINCT run_number, strftime(started_at, '%Y-%m-%dT%H:%M:%S.%f+00:00') AS started, strftime(finished_at, '%Y-%m-%dT%H:%M:%S.%f+00:00') AS finished FROM selection_inventories",
    "metadata_pairs": "SELECT name, 'source=' || coalesce(r.source, '') || ';stage=' || coalesce(r.stage, '') || ';state=' || coalesce(r.state, '') AS pairs, r.stage AS stage FROM (SELECT name, min({'source': source, 'stage': stage, 'state': state}) AS r FROM books GROUP BY name)",
}
