"""Records of read models: work lists, artifacts, materialization, equivalence, reconciliation, replay, state machines, audits of links."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quirewise.functions.identity import stable_id
from quirewise.storage import cut


def cache_key(*parts: Column) -> Column:
    """The content-addressed key of an extraction: source, content digest, extractor, version, configuration digest, contract."""
    return stable_id("extraction-cache", *parts)


def work_list(wanted: DataFrame, cached: DataFrame) -> DataFrame:
    """wanted (key, ...) that the cache (key, content, content_sha256) doesn't hold with a content of its digest; a damaged entry counts as missing.
    The first complete writer of a key is the one that counts: the least content of those that are whole."""
    whole = cached.where(F.sha2("content", 256) == F.col("content_sha256")).select("key").distinct()
    return wanted.join(whole, "key", "left_anti")


def page_artifacts(blocks: DataFrame) -> DataFrame:
    """(document, page_index, path, text, byte_size, sha256): one text artifact a page: a header and its blocks (document, page_index, ordinal, text) in
    order, joined by blank lines. Null texts are left out."""
    parts = F.transform(F.array_sort(F.collect_list(F.struct("ordinal", "text"))), lambda x: x["text"])
    header = F.concat(F.lit("# Page "), (F.col("page_index") + 1).cast("string"))
    x = blocks.where("text is not null").groupBy("document", "page_index").agg(parts.alias("parts"))
    x = x.select("document", "page_index", F.format_string("pages/page-%05d.txt", F.col("page_index") + 1).alias("path"), F.array_join(F.concat(F.array(header), "parts"), "\n\n").alias("text"))
    return x.select("*", F.octet_length("text").cast("bigint").alias("byte_size"), F.sha2("text", 256).alias("sha256"))


def bundle_ids(artifacts: DataFrame) -> DataFrame:
    """(document, members, bundle_id): the identity of a document's artifacts by their paths and digests in order."""
    members = F.array_join(F.array_sort(F.collect_list(F.concat_ws(":", "path", "sha256", F.col("byte_size").cast("string")))), "\n")
    return artifacts.groupBy("document").agg(F.count("*").alias("members"), F.concat(F.lit("artifact-bundle:sha256:"), F.sha2(members, 256)).alias("bundle_id"))


def artifact_problems(manifest: DataFrame, stored: DataFrame) -> DataFrame:
    """(document, path, problem) of members (document, path, sha256, byte_size) against what is stored (document, path, text): missing, unexpected,
    byte_size or sha256; members that fit have no row."""
    m = manifest.select("document", "path", F.col("sha256").alias("want"), F.col("byte_size").alias("size"), F.lit(True).alias("m"))
    x = m.join(stored.select("document", "path", "text", F.lit(True).alias("s")), ["document", "path"], "full_outer")
    problem = F.when(F.col("s").isNull(), "missing").when(F.col("m").isNull(), "unexpected").when(F.octet_length("text") != F.col("size"), "byte_size").when(F.sha2("text", 256) != F.col("want"), "sha256")
    return x.select("document", "path", problem.alias("problem")).where("problem is not null")


def materialized(target: DataFrame, projection: DataFrame) -> DataFrame:
    """Records (collection, id, content_sha256) of a projection against a target: created, unchanged or conflict, one row a record."""
    there = target.select("collection", "id", F.col("content_sha256").alias("there")).distinct()
    outcome = F.when(F.col("there").isNull(), "created").when(F.col("there") == F.col("content_sha256"), "unchanged").otherwise("conflict")
    return projection.distinct().join(there, ["collection", "id"], "left").select("collection", "id", outcome.alias("outcome"))


def mismatched_fields(left: DataFrame, right: DataFrame, key: str, fields: Sequence[str]) -> DataFrame:
    """(key, mismatches): the fields in which two models of one key differ, nulls equal to each other; `missing_left` or `missing_right` where a
    model lacks it. Keys that agree have an empty list."""
    a = left.select(key, *[F.col(f).alias(f"a_{f}") for f in fields], F.lit(True).alias("_a"))
    b = right.select(key, *[F.col(f).alias(f"b_{f}") for f in fields], F.lit(True).alias("_b"))
    x = a.join(b, key, "full_outer")
    differ = F.filter(F.array(*[F.when(~F.col(f"a_{f}").eqNullSafe(F.col(f"b_{f}")), F.lit(f)) for f in fields]), lambda v: v.isNotNull())
    out = F.when(F.col("_a").isNull(), F.array(F.lit("missing_left"))).when(F.col("_b").isNull(), F.array(F.lit("missing_right"))).otherwise(differ)
    return x.select(key, out.alias("mismatches"))


def replayed(records: DataFrame, key: Sequence[str], sequence: str, head: int | None = None) -> DataFrame:
    """The read model of a journal up to `head`: by key the record of the highest sequence; redelivered records count once, with their least content.
    Replaying again, or a longer prefix over a shorter one, gives the same rows."""
    x = records.where(F.col(sequence).isNotNull())
    x = x if head is None else x.where(F.col(sequence) <= head)
    others = [c for c in records.columns if c not in key and c != sequence]
    latest = x.groupBy(*key).agg(F.min(F.struct((-F.col(sequence)).alias("at"), *others)).alias("r"))
    return latest.select(*key, (-F.col("r.at")).alias(sequence), *[F.col(f"r.`{c}`").alias(c) for c in others])


def transitions(states: DataFrame, key: Sequence[str], order: str, state: str, allowed: dict[str, Sequence[str]], initial: Sequence[str]) -> DataFrame:
    """Each change of state with its verdict: by key the states in order; `start`, `stay`, `fired` (an allowed transition) or `refused`."""
    w = Window.partitionBy(*key).orderBy(order)
    x = states.withColumn("before", F.lag(state).over(w))
    ways = [f"{a}>{b}" for a, bs in allowed.items() for b in bs]
    verdict = (
        F.when(F.col("before").isNull(), F.when(F.col(state).isin(*initial), "start").otherwise("refused")).when(F.col("before") == F.col(state), "stay")
        .when(F.concat_ws(">", "before", F.col(state)).isin(*ways), "fired").otherwise("refused")
    )
    return x.select(*key, order, "before", F.col(state).alias("after"), verdict.alias("verdict"))


def edge_findings(nodes: DataFrame, edges: DataFrame, most_rounds: int = 64) -> DataFrame:
    """(a, b, finding) of order edges (a before b) over nodes (id): unknown, self, duplicate (once a pair) or cyclic, each that holds.

    Cycles: nodes without an edge into them are taken off again and again, with their edges; what is left after no node comes off holds the cycles,
    and what lies behind them; nodes without an edge out of them come off the same way. Each round writes what is left.
    """
    known = nodes.select("id").distinct()
    counted = edges.groupBy("a", "b").agg(F.count("*").alias("n"))
    unknown = counted.join(known.withColumnRenamed("id", "a"), "a", "left_anti").unionByName(counted.join(known.withColumnRenamed("id", "b"), "b", "left_anti")).select("a", "b").distinct()
    left = counted.where("a <> b").select("a", "b").join(unknown, ["a", "b"], "left_anti")
    left = cut(left, "edges")
    size = left.count()
    for k in range(most_rounds):
        if not size:
            break
        inner = left.join(left.select(F.col("b").alias("a")).distinct(), "a", "left_semi")
        left = cut(inner.join(inner.select(F.col("a").alias("b")).distinct(), "b", "left_semi").select("a", "b"), f"edges{k}")
        now = left.count()
        if now == size:
            break
        size = now
    else:
        raise RuntimeError("the order is deeper than the limit")
    tag = lambda df, name: df.select("a", "b", F.lit(name).alias("finding"))
    return tag(unknown, "unknown").unionByName(tag(counted.where("a = b"), "self")).unionByName(tag(counted.where("n > 1"), "duplicate")).unionByName(tag(left, "cyclic"))


def applicable(limitations: DataFrame, scope: DataFrame) -> DataFrame:
    """(limitation, owner, ids): limitations (limitation, affected: array) that apply to an owner (owner, id): those whose affected ids meet the owner's,
    with the ids they have in common, sorted."""
    each = limitations.select("limitation", F.explode(F.array_distinct("affected")).alias("id"))
    return each.join(scope.select("owner", "id").distinct(), "id").groupBy("limitation", "owner").agg(F.array_sort(F.collect_set("id")).alias("ids"))


def producer_audit(producers: DataFrame, items: DataFrame) -> DataFrame:
    """(producer, problem): producers (producer) that no item (item, producer) uses, or more than one, and those items name that aren't there."""
    used = items.groupBy("producer").agg(F.count("*").alias("n"))
    x = producers.select("producer", F.lit(True).alias("there")).distinct().join(used, "producer", "full_outer")
    problem = F.when(F.col("there").isNull(), "unknown").when(F.col("n").isNull(), "unused").when(F.col("n") > 1, "used_again")
    return x.select("producer", problem.alias("problem")).where("problem is not null")


def ledger_audit(roots: DataFrame, steps: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(trace, id) that are left at the end of traces, and (trace, step, problem) of steps. roots: trace, id; steps: trace, step, kind (consumes or
    outputs), id. A step may only consume what is a root or the output of a step before it (unknown_input), and outputs must be new (repeated_output).
    """
    made = roots.select("trace", "id", F.lit(0).cast("bigint").alias("at")).unionByName(steps.where("kind = 'outputs'").select("trace", "id", F.col("step").cast("bigint").alias("at")))
    first = made.groupBy("trace", "id").agg(F.min("at").alias("at"), F.count("*").alias("n"))
    used = steps.where("kind = 'consumes'").select("trace", F.col("step").cast("bigint").alias("step"), "id")
    unknown = used.join(first, ["trace", "id"], "left").where("at is null or at >= step").select("trace", "step", F.lit("unknown_input").alias("problem"))
    again = made.join(first.where("n > 1").select("trace", "id", F.col("at").alias("first")), ["trace", "id"]).where("at > first").select("trace", F.col("at").alias("step"), F.lit("repeated_output").alias("problem"))
    left = first.select("trace", "id").join(used.select("trace", "id"), ["trace", "id"], "left_anti")
    return left, unknown.unionByName(again).distinct()
