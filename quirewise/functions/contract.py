"""Contract functions: strict JSON, language tags, digests, media types, normal forms, affine maps, relations of boxes."""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import StringType

# The forms of a language tag, and the bytes media types begin with.
TAG = (
    r"^([A-Za-z]{2,3}(?:-[A-Za-z]{3}){0,3}|[A-Za-z]{4,8})(?:-([A-Za-z]{4}))?(?:-([A-Za-z]{2}|[0-9]{3}))?((?:-(?:[A-Za-z0-9]{5,8}|[0-9][A-Za-z0-9]{3}))*)"
    r"((?:-[A-WY-Za-wy-z0-9](?:-[A-Za-z0-9]{2,8})+)*)((?:-[xX](?:-[A-Za-z0-9]{1,8})+)?)$"
)
PRIVATE_TAG = r"^[xX](?:-[A-Za-z0-9]{1,8})+$"
MEDIA_TYPES = (("89504E470D0A1A0A", "image/png"), ("FFD8FF", "image/jpeg"), ("255044462D", "application/pdf"))


def canonical_object(**fields: Column) -> Column:
    """A JSON object with sorted keys, without blanks, nulls kept; for strings, integers, booleans and nested arrays of them."""
    return F.to_json(F.struct(*[fields[k].alias(k) for k in sorted(fields)]), {"ignoreNullFields": "false"})


def json_status(deepest: int = 64, longest: int = 1_000_000) -> Column:
    """A function of a text column: ok, too_long, too_deep, duplicate_key, not_finite or malformed. No built-in function tells duplicate keys."""

    def pairs(items: list) -> dict:
        out = dict(items)
        if len(out) != len(items):
            raise KeyError("duplicate_key")
        return out

    def constant(name: str):
        raise KeyError("not_finite")

    def depth(text: str) -> int:
        most = level = 0
        quoted = escaped = False
        for c in text:
            if quoted:
                quoted, escaped = (c != '"' or escaped), c == "\\" and not escaped
            elif c == '"':
                quoted = True
            elif c in "[{":
                level += 1
                most = max(most, level)
            elif c in "]}":
                level -= 1
        return most

    def status(text: str | None) -> str | None:
        if text is None:
            return None
        if len(text) > longest:
            return "too_long"
        if depth(text) > deepest:
            return "too_deep"
        try:
            json.loads(text, object_pairs_hook=pairs, parse_constant=constant)
        except KeyError as e:
            return str(e.args[0])
        except ValueError:
            return "malformed"
        return "ok"

    return pandas_udf(lambda s: s.map(status, na_action="ignore").astype(object).where(s.notna(), None), StringType())


def language_tag(value: Column) -> Column:
    """A language tag in canonical case: language lower, Script titled, REGION upper, the rest lower. Null if it isn't well formed, or repeats a variant
    or an extension."""
    part = lambda k: F.regexp_extract(value, TAG, k)
    lead = lambda x: F.when(x == "", "").otherwise(F.concat(F.lit("-"), x))
    variants = F.filter(F.split(F.lower(part(4)), "-"), lambda v: v != "")
    singles = F.regexp_extract_all(F.lower(part(5)), F.lit("-([a-z0-9])(?=-)"), F.lit(1))
    unique = (F.size(F.array_distinct(variants)) == F.size(variants)) & (F.size(F.array_distinct(singles)) == F.size(singles))
    script = F.concat(F.upper(F.substring(part(2), 1, 1)), F.lower(F.substring(part(2), 2, 3)))
    canonical = F.concat(F.lower(part(1)), lead(script), lead(F.upper(part(3))), F.lower(part(4)), F.lower(part(5)), F.lower(part(6)))
    return F.when(value.rlike(PRIVATE_TAG), F.lower(value)).when(value.rlike(TAG) & unique, canonical)


def is_digest(value: Column) -> Column:
    """Whether a text is a SHA-256 digest in lower hexadecimal digits."""
    return F.coalesce(value.rlike("^[0-9a-f]{64}$"), F.lit(False))


def media_type(content: Column) -> Column:
    """The media type by the first bytes; null for others."""
    head = F.hex(F.substring(content, 1, 12))
    out = None
    for start, name in MEDIA_TYPES:
        out = (F if out is None else out).when(head.startswith(start), name)
    return out.when(head.startswith("52494646") & (F.substring(head, 17, 8) == "57454250"), "image/webp")


def _normal(form: str, fold: bool):
    def one(text: str) -> str:
        x = text if text.isascii() else unicodedata.normalize(form, text)
        return " ".join((x.casefold() if fold else x).split())

    return pandas_udf(lambda s: s.map(one, na_action="ignore").astype(object).where(s.notna(), None), StringType())


def matched_form(text: Column) -> Column:
    """NFKC, without case, white space collapsed: for matching native and scanned lines, and titles."""
    return _normal("NFKC", True)(text)


def label_form(text: Column) -> Column:
    """Without case, white space collapsed: for labels of tables. Stays in the JVM."""
    return F.replace(F.lower(F.regexp_replace(F.regexp_replace(text, r"(?U)\s+", " "), "^ | $", "")), F.lit("ß"), F.lit("ss"))


def collision_form(text: Column) -> Column:
    """NFC, case kept, white space collapsed: for captions that collide with text."""
    return _normal("NFC", False)(text)


def mapped_box(box: Column, matrix: Sequence[Column]) -> Column:
    """The box around the four mapped corners, by x' = a*x + c*y + e, y' = b*x + d*y + f with the matrix (a, b, c, d, e, f)."""
    a, b, c, d, e, f = matrix
    corners = [(box[x], box[y]) for x in ("x0", "x1") for y in ("y0", "y1")]
    xs, ys = [a * x + c * y + e for x, y in corners], [b * x + d * y + f for x, y in corners]
    return F.struct(F.least(*xs).alias("x0"), F.least(*ys).alias("y0"), F.greatest(*xs).alias("x1"), F.greatest(*ys).alias("y1"))


def contains(outer: Column, inner: Column) -> Column:
    return (outer["x0"] <= inner["x0"]) & (outer["y0"] <= inner["y0"]) & (outer["x1"] >= inner["x1"]) & (outer["y1"] >= inner["y1"])


def meet_across(a: Column, b: Column) -> Column:
    """Whether two boxes share some x."""
    return (a["x0"] < b["x1"]) & (b["x0"] < a["x1"])


def meet_down(a: Column, b: Column) -> Column:
    """Whether two boxes share some y."""
    return (a["y0"] < b["y1"]) & (b["y0"] < a["y1"])


def gap_across(a: Column, b: Column) -> Column:
    return F.greatest(F.lit(0.0), b["x0"] - a["x1"], a["x0"] - b["x1"])


def gap_down(a: Column, b: Column) -> Column:
    return F.greatest(F.lit(0.0), b["y0"] - a["y1"], a["y0"] - b["y1"])


def stamp(time: Column) -> Column:
    """A UTC time as an ISO 8601 text with microseconds."""
    return F.date_format(time, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")


def metadata(entries: Column) -> Column:
    """A map as its (key, value) pairs in order of the key."""
    return F.array_sort(F.map_entries(entries))
