"""Processing state as snapshots: registered books, their chunks, and events, saved only upon the snapshot they were read from."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quirewise.storage import commit_exclusively, hadoop_path


class StateStore:
    """Snapshots of a state table and an append-only log of events.

    `save` names the snapshot it was made from; if another one has been saved since, it fails and nothing of it is visible. Registered keys and
    `fixed` columns never change; an event counts once by its id, however often it is sent. A snapshot is written whole, then named in one
    exclusive step.
    """

    def __init__(self, spark: SparkSession, folder: str, key: str, fixed: tuple[str, ...] = ()):
        self.spark, self.folder, self.key, self.fixed = spark, folder.rstrip("/"), key, fixed
        path, self.fs = hadoop_path(spark, self.folder)
        self.fs.mkdirs(path)

    def _names(self) -> list[int]:
        path, _ = hadoop_path(self.spark, self.folder)
        return sorted(int(n[9:-5]) for n in (s.getPath().getName() for s in self.fs.listStatus(path)) if n.startswith("snapshot-"))

    def snapshot(self) -> int:
        """The number of the last snapshot; 0 if there is none."""
        return (self._names() or [0])[-1]

    def _manifest(self, number: int) -> dict:
        return json.loads(self.spark.read.text(f"{self.folder}/snapshot-{number}.json").first().value)

    def load(self, number: int | None = None) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{self._manifest(self.snapshot() if number is None else number)['trial']}/state")

    def events(self) -> DataFrame:
        """All events, each once: of an id sent again the row of the first snapshot."""
        parts = [(n, m["trial"]) for n in self._names() for m in [self._manifest(n)] if m["events"]]
        each = [self.spark.read.parquet(f"{self.folder}/{t}/events").withColumn("snapshot", F.lit(n)) for n, t in parts]
        out = each[0]
        for x in each[1:]:
            out = out.unionByName(x)
        others = [c for c in out.columns if c != "event_id"]
        return out.groupBy("event_id").agg(F.min(F.struct("snapshot", *[c for c in others if c != "snapshot"])).alias("r")).select("event_id", "r.*")

    def save(self, state: DataFrame, upon: int, events: DataFrame | None = None) -> int:
        """The number of the new snapshot. state: all rows; events (event_id, ...) of this transition."""
        if upon != self.snapshot():
            raise RuntimeError(f"snapshot {self.snapshot()} has been saved since {upon}")
        if state.groupBy(self.key).count().where("count > 1").limit(1).count():
            raise ValueError(f"{self.key} must be unique")
        if upon:
            was = self.load(upon).select(self.key, *[F.col(c).alias(f"_{c}") for c in self.fixed])
            now = state.select(self.key, *self.fixed, F.lit(True).alias("_there"))
            changed = " or ".join(["_there is null", *[f"not (`{c}` <=> `_{c}`)" for c in self.fixed]])
            if was.join(now, self.key, "left").where(changed).limit(1).count():
                raise ValueError("what is registered can't change")
        trial = f"trial-{uuid.uuid4().hex}"
        state.write.parquet(f"{self.folder}/{trial}/state")
        if events is not None:
            events.write.parquet(f"{self.folder}/{trial}/events")
        manifest = {"snapshot": upon + 1, "trial": trial, "events": events is not None}
        if not commit_exclusively(self.spark, f"{self.folder}/{trial}/manifest.json", f"{self.folder}/snapshot-{upon + 1}.json", json.dumps(manifest)):
            raise RuntimeError(f"snapshot {upon + 1} has been saved by another")
        return upon + 1
