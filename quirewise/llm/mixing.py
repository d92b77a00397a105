"""Mixing sources to target weights: hash-random order, distributed prefix sums of tokens, exact cuts, capped repeats."""

from __future__ import annotations

import base64
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quirewise.storage import cut

#: The vocabulary file of a public tokenizer (ranks of byte sequences); a parameter of token_counts.
TOKENIZER = "byte_bpe_50k.tiktoken"


def source_name(column: str = "source"):
    """A source without regard to case, outer blanks and underscores for hyphens; null is ''."""
    return F.coalesce(F.translate(F.lower(F.trim(column)), "_", "-"), F.lit(""))


def token_counts(documents: DataFrame, path: str | None = None, folder: str = "/opt/tokenizers") -> DataFrame:
    """(doc_id, source, tokens) of documents, by a public byte-level tokenizer; null texts have 0 tokens, rows without doc_id are left out."""
    path = path or f"{folder}/{TOKENIZER}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import public_tokenizers
        import tiktoken

        ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in open(path, "rb"))}
        encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        for batch in batches:
            n = [len(encoding.encode_ordinary(t)) if t else 0 for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("source"), pa.array(n, pa.int64())], ["doc_id", "source", "tokens"])

    named = documents.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), source_name().alias("source"), "text")
    return named.mapInArrow(run, "doc_id long, source string, tokens long")


def mixture(sizes: DataFrame, targets: DataFrame, seed: int = 0, total: int | None = None, each: int = 50_000) -> DataFrame:
    """(doc_id, source, tokens, uses): how often each document is used so that sources have their target shares of all tokens.

    sizes: doc_id, source, tokens; targets: source, target_share, max_repeats. The total is the largest for which no source needs more
    than max_repeats uses of its tokens, or `total` tokens: then a source that hasn't enough gives all it may, and falls short. A source without
    tokens can't contribute, and the others keep their proportions. A source's budget is met by whole epochs and then by its documents in
    hash-random order up to the budget: prefix sums run within ranges of hashes of about `each` documents and over the sums of the ranges, so
    no source is ordered in one task, however large it is. A document at the cut is used once more if that brings the source nearer to its
    budget, so a source misses its budget by half its longest document at most. Repeated rows count once; null sources, shares and
    repeats take no part.
    """
    docs = cut(sizes.where("tokens > 0").groupBy("doc_id", "source").agg(F.max("tokens").alias("tokens")).withColumn("at", F.xxhash64("doc_id", F.lit(seed))), "sizes")
    goals = targets.where("source is not null and target_share > 0 and max_repeats > 0").groupBy(source_name().alias("source")).agg(F.max("target_share").alias("share"), F.max("max_repeats").alias("most"))
    sources = docs.groupBy("source").agg(F.sum("tokens").alias("have"), F.count("*").alias("documents")).join(goals, "source")
    whole = Window.partitionBy(F.lit(0))  # one row a target source
    largest = F.min(F.col("have") * F.col("most") / F.col("share")).over(whole) if total is None else F.lit(float(total)) / F.sum("share").over(whole)
    budget = cut(
        sources.withColumn("total", largest).select(
            "source", F.least(F.floor(F.col("total") * F.col("share")), F.col("have") * F.col("most")).cast("bigint").alias("budget"), "have", "most",
            F.greatest(F.lit(1), F.ceil(F.col("documents") / each)).cast("bigint").alias("ranges"),
        ), "budgets",
    )
    placed = docs.join(budget, "source").withColumn("range", F.least(F.floor((F.col("at") / 2.0**64 + 0.5) * F.col("ranges")), F.col("ranges") - 1).cast("bigint"))
    sums = placed.groupBy("source", "range").agg(F.sum("tokens").alias("n"))
    before = sums.withColumn("before", F.coalesce(F.sum("n").over(Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).select("source", "range", "before")
    own = F.sum("tokens").over(Window.partitionBy("source", "range").orderBy("at", "doc_id"))
    upto = placed.join(before, ["source", "range"]).withColumn("upto", own + F.col("before"))
    rest = F.col("budget") % F.col("have")
    # Nearer with this document than without it: at least half of it lies within the rest.
    extra = (F.col("upto") * 2 - F.col("tokens") <= rest * 2).cast("int")
    uses = F.least(F.floor(F.col("budget") / F.col("have")).cast("int") + extra, F.col("most"))
    return upto.select("doc_id", "source", "tokens", uses.alias("uses")).where("uses > 0")


def mixture_report(sizes: DataFrame, targets: DataFrame, seed: int = 0, total: int | None = None) -> DataFrame:
    """One row a target source: documents used, tokens with repeats, target share, share reached, most uses."""
    chosen = mixture(sizes, targets, seed, total).groupBy("source").agg(F.count("*").alias("documents"), F.sum(F.col("tokens") * F.col("uses")).alias("tokens"), F.max("uses").alias("most_uses"))
    goals = targets.where("source is not null").groupBy(source_name().alias("source")).agg(F.max("target_share").alias("target_share"))
    out = goals.join(chosen, "source", "left").fillna(0, ["documents", "tokens", "most_uses"])
    return out.withColumn("reached_share", F.col("tokens") / F.sum("tokens").over(Window.partitionBy(F.lit(0))))
