"""Processing only new or changed records.

Two parts: `pending_keys` finds what no committed run has taken in, and `IncrementalFolder` runs batches whose output and
watermark become visible in one step.

Method: the highest sequence at the start of a run is fixed as its upper limit; everything above it waits for the next run.
The watermark is the highest sequence up to which every row has been taken in. Sequences have gaps that may be filled late, so
`IncrementalFolder` also records what it has taken in above the watermark (and below the first sequence it saw): a row that arrives
late is taken in by the next run, wherever it lies. `pending_keys` has no state of its own: it derives the watermark from the
ranges of the committed runs, and compares only keys with a row above it.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quirewise.storage import commit_exclusively, cut

#: A sequence is a signed 64-bit number; a dyadic block of level k holds 2**k of them.
LEVELS = 62


def normal_state(column: str) -> Column:
    """A state without regard to letter case and outer blanks."""
    return F.lower(F.regexp_replace(F.col(column), r"(?U)^\s+|\s+$", ""))


def dyadic_pieces(first: str, last: str) -> Column:
    """The dyadic blocks that make up the range of two bigint columns: at each level at most one at either end."""
    block = "array<struct<level:int,block:bigint>>"
    lo, hi = f"(shiftright({first} - 1, k) + 1)", f"shiftright({last} + 1, k)"
    return F.expr(f"""flatten(transform(sequence(0, {LEVELS}), k -> concat(
        if({lo} < {hi} and {lo} & 1 = 1, array(named_struct('level', k, 'block', {lo})), cast(array() as {block})),
        if({lo} < {hi} and {hi} & 1 = 1, array(named_struct('level', k, 'block', {hi} - 1)), cast(array() as {block})))))""")


def latest_covering_start(rows: DataFrame, runs: DataFrame) -> DataFrame:
    """rows (sequence, ...) with covered_until: the latest started_at of a run over the row's sequence, null without one.

    runs has first_sequence, last_sequence, started_at. Each range becomes its dyadic blocks, pre-aggregated to the latest
    start a block; a row looks its block up at the levels in use. No range is compared with all rows, however wide it is.
    """
    blocks = (
        runs.where("first_sequence is not null and last_sequence is not null and started_at is not null")
        .select(F.explode(dyadic_pieces("first_sequence", "last_sequence")).alias("at"), "started_at")
        .groupBy("at.level", "at.block")
        .agg(F.max("started_at").alias("until"))
    )
    levels = sorted(r.level for r in blocks.select("level").distinct().collect())  # at most LEVELS + 1 numbers
    if not levels:
        return rows.withColumn("covered_until", F.lit(None).cast("timestamp"))
    at = F.explode(F.array(*[F.struct(F.lit(k).alias("level"), F.expr(f"shiftright(sequence, {k})").alias("block")) for k in levels]))
    until = (
        rows.select("sequence", at.alias("at"))
        .select("sequence", "at.level", "at.block")
        .join(blocks, ["level", "block"])
        .groupBy("sequence")
        .agg(F.max("until").alias("covered_until"))
    )
    return rows.join(until, "sequence", "left")


def pending_keys(
    rows: DataFrame,
    runs: DataFrame,
    key: Sequence[str],
    content: dict[str, Column],
    limit: int | None = None,
) -> DataFrame:
    """Keys of which no committed run has taken in the present state, one row a key.

    rows has sequence, arrived_at, the key and what `content` reads; redelivered rows (same sequence) count once, with their
    earliest arrival. A row is taken in if a run with outcome `committed` covers its sequence and it had arrived when the run
    started. A key is pending if none of its rows is taken in, or if its highest row differs from its highest taken-in
    row in a content column. Nulls are equal to each other; rows without sequence or key are left out; a row without
    arrival time counts as never taken in. `limit` fixes the highest sequence to look at (default: the highest there is,
    read once at the start, so rows that arrive meanwhile wait for the next run). An empty table of runs leaves every key pending.
    """
    key = list(key)
    given = rows.where(F.col("sequence").isNotNull() & F.expr(" and ".join(f"`{k}` is not null" for k in key)))
    top = limit if limit is not None else given.agg(F.max("sequence")).first()[0]
    if top is None:
        return given.select(*key).limit(0)
    names = [f"_c{i}" for i in range(len(content))]
    once = (
        given.where(F.col("sequence") <= F.lit(top))
        .select("sequence", "arrived_at", *key, *[c.alias(n) for n, c in zip(names, content.values())])
        .groupBy("sequence")
        .agg(F.min("arrived_at").alias("arrived_at"), F.min(F.struct(*key, *names)).alias("row"))
    )
    committed = runs.where(normal_state("outcome") == "committed").select(
        F.col("first_sequence").cast("bigint"), F.col("last_sequence").cast("bigint"), "started_at"
    )
    covered = latest_covering_start(once, committed).withColumn("taken", F.coalesce(F.col("arrived_at") <= F.col("covered_until"), F.lit(False)))
    seen = cut(covered.select("sequence", "taken", "row", *[F.col(f"row.{k}").alias(k) for k in key]), "taken")
    # The watermark lies below the lowest row that isn't taken in: keys whose rows all lie at or below it are as they were taken in.
    first_open = seen.where(~F.col("taken")).agg(F.min("sequence")).first()[0]
    if first_open is None:
        return given.select(*key).limit(0)
    above = seen.where(F.col("sequence") >= F.lit(first_open)).select(*key).distinct()
    return (
        seen.join(above, key, "left_semi")
        .groupBy(*key)
        .agg(F.max_by("row", "sequence").alias("now"), F.max_by("row", F.when(F.col("taken"), F.col("sequence"))).alias("then"), F.max("taken").alias("any_taken"))
        .where(~F.col("any_taken") | ~F.expr(" and ".join(f"now.{n} <=> then.{n}" for n in names) or "true"))
        .select(*key)
    )


class IncrementalFolder:
    """Runs over a growing table, whose outputs and watermarks are committed together.

    A run writes the sequences it takes in and its rows into a trial folder of its own, then a manifest that names that folder and the watermark, and
    last gives the manifest its name `commit-N.json`. That name is taken exclusively, by one step that fails if it is there: it is the commit. A
    trial folder no manifest names is invisible, so a failure at any point repeats or skips nothing, and of two runs that race for one
    number the second fails and leaves the first as it is. No run deletes what isn't its own; `vacuum` removes old trials.
    A sequence counts as one row: redelivered, it isn't taken in again; a row without sequence never is. Between the first
    sequence and the watermark all are taken in; beyond them, taken sequences are recorded one by one.
    """

    def __init__(self, spark: SparkSession, folder: str, sequence: str = "sequence"):
        self.spark, self.folder, self.sequence = spark, folder.rstrip("/"), sequence
        self.path = spark._jvm.org.apache.hadoop.fs.Path
        self.fs = self.path(self.folder).getFileSystem(spark._jsc.hadoopConfiguration())
        self.fs.mkdirs(self.path(self.folder))

    def _path(self, name: str):
        return self.path(f"{self.folder}/{name}")

    def _names(self) -> list[str]:
        return [s.getPath().getName() for s in self.fs.listStatus(self._path(""))]

    def committed(self) -> list[dict]:
        """The manifests of all committed runs, in order."""
        names = sorted((n for n in self._names() if n.startswith("commit-")), key=lambda n: int(n[7:-5]))
        if not names:
            return []
        rows = self.spark.read.text([f"{self.folder}/{n}" for n in names]).collect()
        return sorted((json.loads(r.value) for r in rows), key=lambda m: m["run"])

    def watermark(self) -> int | None:
        """The highest sequence up to which, from the first one on, all have been taken in."""
        last = self.committed()[-1:]
        return last[0]["watermark"] if last else None

    def _tables(self, part: str) -> list[str]:
        return [f"{self.folder}/{m['trial']}/{part}" for m in self.committed()]

    def taken(self) -> DataFrame:
        """The sequences of all committed runs."""
        return self.spark.read.parquet(*self._tables("taken"))

    def results(self) -> DataFrame:
        """The rows of all committed runs."""
        return self.spark.read.parquet(*self._tables("data"))

    def run(self, source: DataFrame, step: Callable[[DataFrame], DataFrame]) -> dict | None:
        """Process what no run has taken in, at or below the highest sequence at the start; None if there is nothing."""
        name, before = self.sequence, self.committed()
        start, low = (before[-1]["from"], before[-1]["watermark"]) if before else (None, None)
        high = source.agg(F.max(name)).first()[0]
        if high is None:
            return None
        new = source.where(F.col(name) <= F.lit(high)).select(name).distinct()
        beyond = None
        if before:
            outside = (F.col(name) < F.lit(start)) | (F.col(name) > F.lit(low))
            beyond = self.taken().where(outside)
            new = new.where(outside).join(beyond, name, "left_anti")
        trial = f"trial-{uuid.uuid4().hex}"
        try:
            # Written first: rows that arrive meanwhile are in neither the record nor the batch.
            new.write.parquet(f"{self.folder}/{trial}/taken")
            new = self.spark.read.parquet(f"{self.folder}/{trial}/taken")
            lowest = new.agg(F.min(name)).first()[0]
            if lowest is None:
                self.fs.delete(self._path(trial), True)
                return None
            step(source.join(new, name, "left_semi")).write.parquet(f"{self.folder}/{trial}/data")
            start = lowest if start is None else start
            known = new if beyond is None else new.union(beyond)
            reached = self._filled(known, start - 1 if low is None else low)
            manifest = {"run": len(before) + 1, "above": low, "watermark": reached, "from": start, "trial": trial}
            self._commit(manifest)
        except BaseException:
            self.fs.delete(self._path(trial), True)
            raise
        return {k: manifest[k] for k in ("run", "above", "watermark")}

    def _commit(self, manifest: dict) -> None:
        trial, number = manifest["trial"], manifest["run"]
        if not commit_exclusively(self.spark, f"{self.folder}/{trial}/manifest.json", f"{self.folder}/commit-{number}.json", json.dumps(manifest)):
            raise RuntimeError(f"another run has committed number {number}; nothing of this one is visible")

    def vacuum(self, older_than_seconds: float = 86_400.0) -> int:
        """Delete trial folders that no manifest names and that haven't changed for so long; how many there were."""
        kept, now, n = {m["trial"] for m in self.committed()}, time.time() * 1000, 0
        for s in self.fs.listStatus(self._path("")):
            name = s.getPath().getName()
            if name.startswith("trial-") and name not in kept and now - s.getModificationTime() >= older_than_seconds * 1000:
                n += bool(self.fs.delete(s.getPath(), True))
        return n

    def _filled(self, known: DataFrame, low: int) -> int:
        """The highest sequence up to which all above low are known."""
        s = known.select(F.col(self.sequence).cast("bigint").alias("s")).where(F.col("s") > F.lit(low)).distinct()
        if not s.where(F.col("s") == F.lit(low + 1)).limit(1).count():
            return low
        return s.join(s.select((F.col("s") - 1).alias("s")), "s", "left_anti").agg(F.min("s")).first()[0]
