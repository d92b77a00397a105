"""Splitting oversized items at natural boundaries, by pointer doubling.

Every possible start of a piece is joined to the start of its successor, the farthest one that the limits allow; squaring that
table again and again gives all pieces of all items in a number of rounds that is the logarithm of the pieces of the longest item.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quirewise.storage import cut


def split_items(lengths: DataFrame, boundaries: DataFrame, limit: int = 24, least: int = 8, overlap: int = 2) -> DataFrame:
    """Pieces (item, first, last) of every item longer than limit, positions counted from 1.

    lengths: (item, length), boundaries: (item, at): a piece may end naturally at position `at`. A piece begins at position 1
    or repeats the last `overlap` positions of the one before. If the rest from a start fits the limit, it is the last
    piece; otherwise the piece ends at the furthest boundary that gives it least to limit positions, or after limit ones.
    Items with a null length and boundaries outside an item are ignored, repeated rows count once; an empty table gives no pieces.
    """
    if not overlap < least <= limit:
        raise ValueError("overlap < least <= limit must hold, so that every piece goes forward")
    long = lengths.where(F.col("item").isNotNull() & (F.col("length") > limit)).groupBy("item").agg(F.max("length").cast("bigint").alias("length"))
    starts = long.select("item", "length", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("length"))).alias("first"))
    natural = (
        boundaries.where("item is not null and at is not null")
        .select("item", F.explode(F.sequence(F.col("at").cast("bigint") - (limit - 1), F.col("at").cast("bigint") - (least - 1))).alias("first"), F.col("at").cast("bigint").alias("at"))
        .where("first >= 1")
        .groupBy("item", "first")
        .agg(F.max("at").alias("at"))
    )
    # A start whose rest is longer than the limit has limit positions after it, so a natural end in reach lies within the item.
    last = F.when(F.col("length") - F.col("first") < limit, F.col("length")).otherwise(F.coalesce("at", F.col("first") + (limit - 1)))
    pieces = cut(starts.join(natural, ["item", "first"], "left").select("item", "length", "first", last.alias("last")), "pieces")
    jump = pieces.where("last < length").select("item", "first", (F.col("last") - (overlap - 1)).alias("next"))
    reached = long.select("item", F.lit(1).cast("bigint").alias("first"))
    longest = long.agg(F.max("length")).first()[0] or 0
    for k in range(max(1, (longest // (least - overlap) + 1).bit_length())):
        # Written each round: joined on unwritten, its plan would double every round.
        reached = cut(reached.union(reached.join(jump, ["item", "first"]).select("item", F.col("next").alias("first"))), f"reached{k}")
        onward = jump.select("item", F.col("first").alias("next"), F.col("next").alias("beyond"))
        jump = cut(jump.join(onward, ["item", "next"]).select("item", "first", F.col("beyond").alias("next")), f"jump{k}")
    return pieces.join(reached, ["item", "first"], "left_semi").select("item", "first", "last")
