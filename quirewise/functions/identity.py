"""Content-addressed identities."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def canonical_json(*parts: Column) -> Column:
    """A JSON array of strings without blanks; nulls stay null."""
    return F.to_json(F.array(*[p.cast("string") for p in parts]), {"ignoreNullFields": "false"})


def stable_id(namespace: str, *parts: Column) -> Column:
    """namespace:sha256: and the digest of the canonical JSON of the parts."""
    return F.concat(F.lit(f"{namespace}:sha256:"), F.sha2(canonical_json(*parts), 256))


def digest_of(ids: Column) -> Column:
    """Aggregate: the digest of sorted ids. For bounded groups; `operators.inventory` has the one for unbounded collections."""
    return F.sha2(F.array_join(F.array_sort(F.collect_list(ids)), "\n"), 256)
