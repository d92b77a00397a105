"""Equation queries over the index table; page geometry in points, 612 wide."""

from __future__ import annotations

from pyspark.sql import functions as F

from quirewise.operators import equations as E
from quirewise.sources import views as V
from quirewise.storage import table


def _once(spark, d):
    return V.once(table(spark, d, "equation_index"), "record_id")


def equation_display(spark, d):
    """Display evidence of native texts."""
    x = E.display_evidence(_once(spark, d), "sanitized_native_text", "source_bounding_box", 612.0)
    return x.where("display is not null").select("record_id", "display.*")


def _assembled(spark, d):
    records = _once(spark, d).where("raw_fragments is not null").select("record_id", "raw_fragments", "source_bounding_box", "latex_proposal", F.col("latex_proposal").alias("mathml"), "preceding_context_text", F.lit(None).cast("string").alias("following"))
    return E.assemblies(records, "raw_fragments", "source_bounding_box", 612.0)


def equation_assemblies(spark, d):
    return _assembled(spark, d).select("record_id", "text", "controls", "kind", "label", "detector", F.array_join("prefilter", ",").alias("prefilter"), "rejected")


def equation_eligibility(spark, d):
    reasons = E.ineligibility(F.col("kind"), F.col("rejected"), F.col("detector"))
    return _assembled(spark, d).select("record_id", F.array_join(reasons, ",").alias("reasons"), E.disposition(reasons, F.col("rejected")).alias("disposition"))


def equation_index_scores(spark, d):
    x = E.index_records(_assembled(spark, d), "latex_proposal", "mathml", "preceding_context_text", "following")
    return x.select("record_id", "completeness", "tier", F.array_join("reasons", ",").alias("reasons"))


def equation_retrieval_text(spark, d):
    x = E.index_records(_assembled(spark, d), "latex_proposal", "mathml", "preceding_context_text", "following")
    return x.select("record_id", F.sha2("retrieval_text", 256).alias("text_sha256"), F.length("retrieval_text").cast("bigint").alias("chars"))


def equation_latex(spark, d):
    return _once(spark, d).where("latex_proposal is not null").select("record_id", E.latex_wellformed(F.col("latex_proposal")).alias("wellformed"))


QUERIES = {f.__name__: f for f in (equation_display, equation_assemblies, equation_eligibility, equation_index_scores, equation_retrieval_text, equation_latex)}

_L = r"(\(\s*[A-Za-z]?[0-9]+(?:\.[0-9]+)*[A-Za-z]?\s*\)|\[\s*[A-Za-z]?[0-9]+(?:\.[0-9]+)*[A-Za-z]?\s*\])\s*$"
EQ = "eq AS (SELECT DISTINCT ON (record_id) * FROM equation_index)"


def _n(pattern: str) -> str:
    return f"len(regexp_extract_all(e, '{pattern}'))"


def _display(source: str, text: str) -> str:
    return rf"""d0 AS (SELECT *, regexp_replace({text}, '^[\s\p{{Z}}]+|[\s\p{{Z}}]+$', '', 'g') AS s FROM {source}),
      d1 AS (SELECT *, regexp_extract(s, '{_L}', 1) AS lab, regexp_replace(regexp_replace(s, '{_L}', ''), '[\s\p{{Z}}]+$', '') AS e FROM d0),
      d2 AS (SELECT *, {_n("[=≈≃≤≥≠∝]")} AS relations, {_n("[+\\-−×÷/^_∑∫√∂∇∞±→←∏⋅·]")} AS operators, {_n("[∑∫√∂∇∞∏]")} AS strong, {_n("[Α-Ͽ]")} AS greek, {_n("\\\\[A-Za-z]{2,}")} AS commands,
        len(list_filter(regexp_extract_all(e, '[\p{{L}}\p{{N}}_]+'), lambda x: regexp_matches(x, '^[A-Za-zΑ-ω]$'))) AS variables, len(list_filter(regexp_split_to_array(e, '[\s\p{{Z}}]+'), lambda x: x <> '')) AS words FROM d1),
      d3 AS (SELECT *, round(least(0.99::DOUBLE, 0.55::DOUBLE + CASE WHEN relations > 0 THEN 0.12::DOUBLE ELSE 0 END + CASE WHEN strong + commands + greek > 0 THEN 0.12::DOUBLE ELSE 0 END + CASE WHEN lab <> '' THEN 0.12::DOUBLE ELSE 0 END
        + CASE WHEN abs((source_bounding_box.x0 + source_bounding_box.x1) / 2 - 306) <= 612 * 0.2 AND (source_bounding_box.x1 - source_bounding_box.x0) / 612 <= 0.85 THEN 0.08::DOUBLE ELSE 0 END), 6) AS confidence,
        s <> '' AND len(string_split(s, chr(10))) <= 3 AND NOT regexp_matches(s, '\$[^$\n]{{1,256}}\$|\\\(.{{1,256}}?\\\)') AND words <= 24 AND NOT (words > 6 AND lab = '' AND strong = 0 AND commands = 0)
        AND ((relations > 0 AND variables + commands > 0) OR strong > 0 OR commands > 0 OR (operators > 0 AND variables >= 2)) AS shown FROM d2)"""


ASSEMBLED = rf"""WITH {EQ}, j AS (SELECT *, array_to_string(list_filter(list_transform(raw_fragments, lambda x: regexp_replace(x, '^[\s\p{{Z}}]+|[\s\p{{Z}}]+$', '', 'g')), lambda x: x <> ''), ' ') AS joined FROM eq WHERE raw_fragments IS NOT NULL),
      t AS (SELECT *, len(regexp_extract_all(joined, '\p{{Cc}}')) AS controls, regexp_replace(regexp_replace(regexp_replace(regexp_replace(joined, '[\n\r\t]', ' ', 'g'), '\p{{Cc}}', chr(65533), 'g'), '[\s\p{{Z}}]+', ' ', 'g'), '^ | $', '', 'g') AS text FROM j),
      {_display("t", "text")}, a AS (SELECT *, CASE WHEN shown THEN 'display' ELSE 'inline' END AS kind, CASE WHEN shown THEN nullif(lab, '') END AS label, CASE WHEN shown AND confidence >= 0.75 THEN 'proposed' ELSE 'ambiguous' END AS detector,
        regexp_matches(text, '(?i)\bI\s*=\s*O\b') AS io, regexp_matches(text, '(?:[0-9]+\s*=\s*[0-9]+\s*[,;]\s*){{2,}}[0-9]+') OR (contains(text, 'to M') AND len(regexp_extract_all(text, '=2')) >= 2) AS coord FROM d3),
      b AS (SELECT *, io OR coord AS rejected, list_filter([CASE WHEN controls > 0 THEN 'control_characters_sanitized' END, CASE WHEN io THEN 'io_typographic_false_positive' END, CASE WHEN coord THEN 'coordinate_tuple_false_positive' END,
        CASE WHEN NOT shown THEN 'inline_context_only' END, CASE WHEN NOT shown AND (length(text) > 80 OR len(string_split(text, ' ')) > 12) THEN 'prose_relation' END], lambda x: x IS NOT NULL) AS prefilter FROM a)"""
_WELL = r"""(latex_proposal <> '' AND length(latex_proposal) <= 16384 AND len(regexp_extract_all(latex_proposal, '\\begin\{')) = len(regexp_extract_all(latex_proposal, '\\end\{'))
      AND len(regexp_extract_all(latex_proposal, '\{')) = len(regexp_extract_all(latex_proposal, '\}'))
      AND coalesce(list_min(list_transform(range(1, length(latex_proposal) + 1), lambda i: len(regexp_extract_all(latex_proposal[1:i], '\{')) - len(regexp_extract_all(latex_proposal[1:i], '\}')))), 0) >= 0)"""
_MISMATCH = " OR ".join(f"(contains(text, '{a}') AND NOT contains(latex_proposal, '{b}'))" for a, b in E.SIGNALS)
_REPEATED = " OR ".join(f"(length(latex_proposal) - length(replace(latex_proposal, '{t}', ''))) / {len(t)} > {n}" for t, n in E.REPEATS)
SCORED = ASSEMBLED + rf""", c AS (SELECT *, CASE WHEN latex_proposal IS NULL THEN []::VARCHAR[] ELSE list_filter([CASE WHEN NOT {_WELL} THEN 'latex_structure_suspect' END, CASE WHEN length(latex_proposal) > 2048 THEN 'latex_output_excessive' END,
        CASE WHEN length(regexp_replace(text, '[\s\p{{Z}}]+', '', 'g')) < 7 THEN 'native_evidence_too_short' END, CASE WHEN regexp_matches(lower(text), '^(where|for|with|and) ') THEN 'native_prose_prefix' END,
        CASE WHEN regexp_matches(latex_proposal, '{E.PROSE_IN_LATEX}') OR len(list_filter(regexp_extract_all(latex_proposal, '{E.LATEX_WORD}', 1), lambda w: lower(w) NOT IN ('cell', 'shift', 'spin', 'reference'))) > 0 THEN 'latex_prose_suspect' END,
        CASE WHEN {_MISMATCH} THEN 'latex_native_signal_mismatch' END, CASE WHEN {_REPEATED} THEN 'latex_repetition_suspect' END], lambda x: x IS NOT NULL) END AS against FROM b),
      f AS (SELECT *, latex_proposal IS NOT NULL AND len(against) = 0 AS indexable FROM c),
      g AS (SELECT *, round(least(1.0::DOUBLE, CASE WHEN shown THEN 0.35::DOUBLE ELSE 0 END + CASE WHEN length(replace(text, ' ', '')) >= 7 THEN 0.05::DOUBLE ELSE 0 END + CASE WHEN regexp_matches(text, '[=≈≃≤≥≠∝∑∫√∂∇∞±→←∏⋅·^_]|\\[A-Za-z]+') THEN 0.1::DOUBLE ELSE 0 END
        + CASE WHEN label IS NOT NULL THEN 0.1::DOUBLE ELSE 0 END + CASE WHEN controls = 0 THEN 0.05::DOUBLE ELSE 0 END + CASE WHEN detector = 'proposed' THEN 0.1::DOUBLE ELSE 0 END + CASE WHEN latex_proposal IS NOT NULL THEN 0.2::DOUBLE ELSE 0 END
        + CASE WHEN indexable THEN 0.15::DOUBLE ELSE 0 END), 6) AS complete FROM f),
      h AS (SELECT *, shown AND detector = 'proposed' AND complete >= 0.75 AND indexable AS prime FROM g),
      r AS (SELECT record_id, text, latex_proposal, preceding_context_text, complete, CASE WHEN rejected THEN 'rejected' WHEN NOT shown THEN 'auxiliary' WHEN prime THEN 'primary' ELSE 'auxiliary' END AS level,
        array_to_string(list_concat(prefilter, CASE WHEN detector <> 'proposed' THEN ['detector_ambiguity_retained_as_auxiliary'] ELSE []::VARCHAR[] END, against, CASE WHEN latex_proposal IS NULL THEN ['recognition_not_proposed'] ELSE []::VARCHAR[] END,
        CASE WHEN NOT rejected AND shown AND NOT prime THEN ['insufficient_completeness_for_primary_index'] ELSE []::VARCHAR[] END), ',') AS why FROM h)"""
_TEXT = r"""'Equation retrieval tier: ' || level || CASE WHEN coalesce(preceding_context_text, '') <> '' THEN chr(10) || chr(10) || 'Preceding context:' || chr(10) || regexp_replace(preceding_context_text, '^[\s\p{Z}]+|[\s\p{Z}]+$', '', 'g') ELSE '' END
      || chr(10) || chr(10) || 'Sanitized native PDF equation text:' || chr(10) || text || CASE WHEN latex_proposal IS NOT NULL THEN chr(10) || chr(10) || 'Unaccepted LaTeX proposal:' || chr(10) || latex_proposal ELSE '' END"""

SQL = {
    "equation_display": f"""WITH {EQ}, {_display("eq", "sanitized_native_text")} SELECT record_id, relations, operators, strong, variables, commands, greek, words, nullif(lab, '') AS label, confidence,
      CASE WHEN confidence >= 0.75 THEN 'proposed' ELSE 'ambiguous' END AS status FROM d3 WHERE shown""",
    "equation_assemblies": f"{ASSEMBLED} SELECT record_id, text, controls, kind, label, detector, array_to_string(prefilter, ',') AS prefilter, rejected FROM b",
    "equation_eligibility": f"""{ASSEMBLED}, r AS (SELECT record_id, rejected, array_to_string(list_filter([CASE WHEN kind <> 'display' THEN 'assembly_kind_not_display' END, CASE WHEN rejected THEN 'assembly_rejected' END,
      CASE WHEN detector <> 'proposed' THEN 'detector_evidence_not_proposed' END], lambda x: x IS NOT NULL), ',') AS reasons FROM b)
      SELECT record_id, reasons, CASE WHEN rejected THEN 'retained_rejected_equation_evidence' WHEN reasons <> '' THEN 'retained_auxiliary_equation_evidence' ELSE 'selected_primary_equation_evidence' END AS disposition FROM r""",
    "equation_index_scores": f"{SCORED} SELECT record_id, complete AS completeness, level AS tier, why AS reasons FROM r",
    "equation_retrieval_text": f"{SCORED} SELECT record_id, sha256({_TEXT}) AS text_sha256, length({_TEXT}) AS chars FROM r",
    "equation_latex": f"WITH {EQ} SELECT record_id, {_WELL} AS wellformed FROM eq WHERE latex_proposal IS NOT NULL",
}
