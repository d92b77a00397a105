"""Equations: display evidence of texts, assemblies, eligibility, completeness and index text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Characters and patterns of the contract, its weights and limits.
RELATIONS = "=≈≃≤≥≠∝"
OPERATORS = "+\\-−×÷/\\^_∑∫√∂∇∞±→←∏⋅·"
STRONG = "∑∫√∂∇∞∏"
MATH_SIGNAL = r"[=≈≃≤≥≠∝∑∫√∂∇∞±→←∏⋅·\^_]|\\[A-Za-z]+"
TRAILING_LABEL = r"(\(\s*[A-Za-z]?[0-9]+(?:\.[0-9]+)*[A-Za-z]?\s*\)|\[\s*[A-Za-z]?[0-9]+(?:\.[0-9]+)*[A-Za-z]?\s*\])\s*$"
DELIMITED = r"\$[^$\n]{1,256}\$|\\\(.{1,256}?\\\)"
COORDINATES = r"(?:[0-9]+\s*=\s*[0-9]+\s*[,;]\s*){2,}[0-9]+"
IO = r"(?i)\bI\s*=\s*O\b"
PROSE_IN_LATEX = r"\\mathrm\{[^}]*[A-Za-z]{4,}(?:~|\\ )[A-Za-z]{3,}"
LATEX_WORD = r"\\mathrm\{[^}]*?([A-Za-z]{4,})"
LATEX_WORDS_ALLOWED = ("cell", "shift", "spin", "reference")
SIGNALS = (("=", "="), ("∫", "\\int"), ("∑", "\\sum"), ("√", "\\sqrt"), ("∂", "\\partial"))
REPEATS = (("\\qquad", 20), ("\\mathrm{~}", 12), ("\\ldots", 12))
PROPOSED = 0.75


def _strip(text: Column) -> Column:
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def _count(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern)).cast("bigint")


def _chosen(*named: tuple[Column, str]) -> Column:
    """The names whose condition holds, in order."""
    return F.filter(F.array(*[F.when(when, F.lit(name)) for when, name in named]), lambda x: x.isNotNull())


def sanitized(text: Column) -> Column:
    """Control characters to a space (line breaks, tabs) or a replacement mark, white space collapsed."""
    spaced = F.regexp_replace(F.regexp_replace(text, r"[\n\r\t]", " "), r"\p{Cc}", "�")
    return _strip(F.regexp_replace(spaced, r"(?U)\s+", " "))


def control_count(text: Column) -> Column:
    return _count(text, r"\p{Cc}")


def display_evidence(texts: DataFrame, text: str, box: str, page_width: float) -> DataFrame:
    """texts with display (counts and confidence), null where a text isn't one displayed expression.

    A displayed expression has at most 24 words and three lines, no delimited inline formula, and math enough: a relation with a variable or
    command, a strong sign, a command, or an operator between two variables; beyond six words it needs a label, a strong sign or a
    command. The confidence starts at 0.55 and grows by 0.12 for a relation, for strong signs, commands or Greek, and for a label, and by
    0.08 for a centred narrow box. A null text or box gives none, or no centring.
    """
    stripped = _strip(F.col(text))
    label = F.regexp_extract(stripped, TRAILING_LABEL, 1)
    expression = F.when(label == "", stripped).otherwise(F.regexp_replace(F.regexp_replace(stripped, TRAILING_LABEL, ""), r"(?U)\s+$", ""))
    x = texts.withColumn("_s", stripped).withColumn("_label", label).withColumn("_e", expression)
    e = F.col("_e")
    words = F.filter(F.split(e, r"(?U)\s+"), lambda w: w != "")
    letters = F.filter(F.regexp_extract_all(e, F.lit(r"[\p{L}\p{N}_]+"), F.lit(0)), lambda w: w.rlike("^[A-Za-zΑ-ω]$"))
    counts = {
        "relations": _count(e, f"[{RELATIONS}]"), "operators": _count(e, f"[{OPERATORS}]"), "strong": _count(e, f"[{STRONG}]"), "variables": F.size(letters).cast("bigint"),
        "commands": _count(e, r"\\[A-Za-z]{2,}"), "greek": _count(e, "[Α-Ͽ]"), "words": F.size(words).cast("bigint"),
    }
    for k, v in counts.items():
        x = x.withColumn(f"_{k}", v)
    c = {k: F.col(f"_{k}") for k in counts}
    width = F.coalesce((F.col(f"{box}.x1") - F.col(f"{box}.x0")) / page_width, F.lit(1.0))
    centred = F.coalesce(F.abs((F.col(f"{box}.x0") + F.col(f"{box}.x1")) / 2 - page_width / 2) <= page_width * 0.2, F.lit(False)) & (width <= 0.85)
    supported = ((c["relations"] > 0) & ((c["variables"] > 0) | (c["commands"] > 0))) | (c["strong"] > 0) | (c["commands"] > 0) | ((c["operators"] > 0) & (c["variables"] >= 2))
    prose = (c["words"] > 6) & (F.col("_label") == "") & (c["strong"] == 0) & (c["commands"] == 0)
    shaped = (F.col("_s") != "") & (F.size(F.split("_s", "\n")) <= 3) & ~F.col("_s").rlike(DELIMITED) & (c["words"] <= 24)
    bonus = lambda when, by: F.when(when, F.lit(by)).otherwise(0.0)
    confidence = F.least(
        F.lit(0.99), F.lit(0.55) + bonus(c["relations"] > 0, 0.12) + bonus((c["strong"] > 0) | (c["commands"] > 0) | (c["greek"] > 0), 0.12) + bonus(F.col("_label") != "", 0.12) + bonus(centred, 0.08)
    )
    found = F.struct(*[v.alias(k) for k, v in c.items()], F.nullif("_label", F.lit("")).alias("label"), F.round(confidence, 6).alias("confidence"), F.when(confidence >= PROPOSED, "proposed").otherwise("ambiguous").alias("status"))
    return x.withColumn("display", F.when(shaped & supported & ~prose, found)).drop("_s", "_label", "_e", *[f"_{k}" for k in counts])


def assemblies(records: DataFrame, fragments: str, box: str, page_width: float) -> DataFrame:
    """records with the assembly of their fragments: text, controls, kind, labels, detector status, reasons, whether it is rejected."""
    joined = F.array_join(F.filter(F.transform(fragments, lambda x: _strip(x)), lambda x: x != ""), " ")
    x = records.withColumn("controls", control_count(joined)).withColumn("text", sanitized(joined))
    x = display_evidence(x, "text", box, page_width)
    t, inline = F.col("text"), F.col("display").isNull()
    io = t.rlike(IO)
    coordinates = t.rlike(COORDINATES) | (F.contains(t, F.lit("to M")) & (_count(t, "=2") >= 2))
    reasons = _chosen(
        (F.col("controls") > 0, "control_characters_sanitized"), (io, "io_typographic_false_positive"), (coordinates, "coordinate_tuple_false_positive"),
        (inline, "inline_context_only"), (inline & ((F.length(t) > 80) | (F.size(F.split(t, " ")) > 12)), "prose_relation"),
    )
    return x.select(
        "*", F.when(inline, "inline").otherwise("display").alias("kind"), F.col("display.label").alias("label"), F.coalesce("display.status", F.lit("ambiguous")).alias("detector"), reasons.alias("prefilter"), (io | coordinates).alias("rejected")
    )


def ineligibility(kind: Column, rejected: Column, detector: Column) -> Column:
    """Why an assembly isn't primary evidence; eligible if empty."""
    return _chosen((kind != "display", "assembly_kind_not_display"), (rejected, "assembly_rejected"), (detector != "proposed", "detector_evidence_not_proposed"))


def disposition(reasons: Column, rejected: Column) -> Column:
    return F.when(rejected, "retained_rejected_equation_evidence").when(F.size(reasons) > 0, "retained_auxiliary_equation_evidence").otherwise("selected_primary_equation_evidence")


def latex_wellformed(latex: Column) -> Column:
    """Not empty, at most 16,384 characters, braces that never close before they open and all close, as many environments begun as ended."""
    step = lambda s, c: F.struct((s.d + F.when(c == "{", 1).otherwise(-1)).alias("d"), (s.ok & (s.d + F.when(c == "{", 1).otherwise(-1) >= 0)).alias("ok"))
    depth = F.aggregate(F.filter(F.split(latex, ""), lambda c: c.isin("{", "}")), F.struct(F.lit(0).alias("d"), F.lit(True).alias("ok")), step, lambda s: s.ok & (s.d == 0))
    return (latex != "") & (F.length(latex) <= 16_384) & depth & (F.regexp_count(latex, F.lit(r"\\begin\{")) == F.regexp_count(latex, F.lit(r"\\end\{")))


def proposal_reasons(native: Column, latex: Column, mathml: Column) -> Column:
    """What speaks against indexing a proposal; none if there is no proposal."""
    words = F.regexp_extract_all(latex, F.lit(LATEX_WORD), F.lit(1))
    mismatch = F.lit(False)
    for sign, command in SIGNALS:
        mismatch = mismatch | (F.contains(native, F.lit(sign)) & ~F.contains(latex, F.lit(command)))
    repeated = F.lit(False)
    for token, limit in REPEATS:
        repeated = repeated | ((F.length(latex) - F.length(F.replace(latex, F.lit(token), F.lit("")))) / len(token) > limit)
    reasons = _chosen(
        (~latex_wellformed(latex), "latex_structure_suspect"), (F.length(latex) > 2_048, "latex_output_excessive"), (mathml.isNull(), "mathml_proposal_unavailable"),
        (F.length(F.regexp_replace(native, r"(?U)\s+", "")) < 7, "native_evidence_too_short"), (F.lower(native).rlike("^(where|for|with|and) "), "native_prose_prefix"),
        (latex.rlike(PROSE_IN_LATEX) | F.exists(words, lambda w: ~F.lower(w).isin(*LATEX_WORDS_ALLOWED)), "latex_prose_suspect"),
        (mismatch, "latex_native_signal_mismatch"), (repeated, "latex_repetition_suspect"),
    )
    return F.when(latex.isNull(), F.array().cast("array<string>")).otherwise(reasons)


def index_records(assembled: DataFrame, latex: str, mathml: str, before: str, after: str) -> DataFrame:
    """assembled (see `assemblies`) with completeness, tier, reasons and retrieval_text.

    Completeness sums what is there: display 0.35, seven characters 0.05, a math sign 0.1, a label 0.1, no control characters 0.05, a detector
    that proposes 0.1, a proposal 0.2 and an indexable one 0.15. Primary is a display from 0.75 whose detector and proposal stand.
    """
    native = F.col("text")
    x = assembled.withColumn("_against", proposal_reasons(native, F.col(latex), F.col(mathml)))
    there, stands = F.col(latex).isNotNull(), F.col("detector") == "proposed"
    indexable = there & (F.size("_against") == 0)
    display = F.col("kind") == "display"
    part = lambda when, by: F.when(when, F.lit(by)).otherwise(0.0)
    score = (
        part(display, 0.35) + part(F.length(F.replace(native, F.lit(" "), F.lit(""))) >= 7, 0.05) + part(native.rlike(MATH_SIGNAL), 0.1) + part(F.col("label").isNotNull(), 0.1)
        + part(F.col("controls") == 0, 0.05) + part(stands, 0.1) + part(there, 0.2) + part(indexable, 0.15)
    )
    x = x.withColumn("completeness", F.round(F.least(F.lit(1.0), score), 6))
    primary = display & stands & (F.col("completeness") >= PROPOSED) & indexable
    tier = F.when(F.col("rejected"), "rejected").when(~display, "auxiliary").when(primary, "primary").otherwise("auxiliary")
    more = _chosen((~stands, "detector_ambiguity_retained_as_auxiliary"))
    late = _chosen((~there, "recognition_not_proposed"), (~F.col("rejected") & display & ~primary, "insufficient_completeness_for_primary_index"))
    x = x.withColumn("tier", tier).withColumn("reasons", F.concat("prefilter", more, "_against", late)).drop("_against")
    section = lambda title, c: F.when(F.coalesce(F.col(c), F.lit("")) != "", F.concat(F.lit(f"{title}:\n"), _strip(F.col(c))))
    retrieval = F.concat_ws(
        "\n\n", F.concat(F.lit("Equation retrieval tier: "), "tier"), section("Preceding context", before), F.concat(F.lit("Sanitized native PDF equation text:\n"), native),
        F.when(there, F.concat(F.lit("Unaccepted LaTeX proposal:\n"), latex)), section("Following context", after),
    )
    return x.withColumn("retrieval_text", retrieval)
