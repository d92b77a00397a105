"""Expressions over boxes struct<x0,y0,x1,y1>."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def box(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    return F.struct(x0.alias("x0"), y0.alias("y0"), x1.alias("x1"), y1.alias("y1"))


def area(b: Column) -> Column:
    return (b["x1"] - b["x0"]) * (b["y1"] - b["y0"])


def intersection(a: Column, b: Column) -> Column:
    """The common area of two boxes, 0 if they don't meet."""
    return F.greatest(F.lit(0.0), F.least(a["x1"], b["x1"]) - F.greatest(a["x0"], b["x0"])) * F.greatest(F.lit(0.0), F.least(a["y1"], b["y1"]) - F.greatest(a["y0"], b["y0"]))


def iou(a: Column, b: Column) -> Column:
    common = intersection(a, b)
    return common / (area(a) + area(b) - common)


def overlap(a: Column, b: Column) -> Column:
    """Common area by the smaller area."""
    return intersection(a, b) / F.least(area(a), area(b))


def padded(b: Column, by: float, width: Column, height: Column) -> Column:
    """A box grown on all sides and kept within the page."""
    return box(F.greatest(F.lit(0.0), b["x0"] - by), F.greatest(F.lit(0.0), b["y0"] - by), F.least(width, b["x1"] + by), F.least(height, b["y1"] + by))


def union_of(b: Column) -> Column:
    """Aggregate: the box around all boxes."""
    return F.struct(F.min(b["x0"]).alias("x0"), F.min(b["y0"]).alias("y0"), F.max(b["x1"]).alias("x1"), F.max(b["y1"]).alias("y1"))


def kind(b: Column) -> Column:
    """malformed, non_finite, negative_coordinate, unordered, non_positive_area or valid: the first that fits."""
    all_of = [b["x0"], b["y0"], b["x1"], b["y1"]]
    any_of = lambda test: F.exists(F.array(*all_of), test)
    return (
        F.when(b.isNull() | any_of(lambda v: v.isNull()), "malformed")
        .when(any_of(lambda v: F.isnan(v) | (F.abs(v) == F.lit(float("inf")))), "non_finite")
        .when(any_of(lambda v: v < 0), "negative_coordinate")
        .when((b["x1"] < b["x0"]) | (b["y1"] < b["y0"]), "unordered")
        .when(area(b) <= 0, "non_positive_area")
        .otherwise("valid")
    )


def to_points(b: Column, dpi: float = 144.0) -> Column:
    """Pixels of a page rendered at dpi, in points."""
    return box(*(v * 72.0 / dpi for v in (b["x0"], b["y0"], b["x1"], b["y1"])))
