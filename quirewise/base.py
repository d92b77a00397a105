"""Extension points: typed steps from DataFrame to DataFrame, and pipelines of them.

A step names its contract and version, and its configuration is part of its identity, so results of other settings are told apart. Subclass one of
them and give `act`; `Pipeline` runs steps in order. Extractors, recognizers, detectors and reconcilers are projectors; stores are materializers.
"""

from __future__ import annotations

import hashlib
import json
from abc import ABC, abstractmethod
from collections.abc import Callable, Mapping
from dataclasses import asdict, dataclass, is_dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quirewise.operators.corpus import inventory


def _digest(namespace: str, *parts: object) -> str:
    text = json.dumps(parts, sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False)
    return f"{namespace}:sha256:{hashlib.sha256(text.encode()).hexdigest()}"


class Action(ABC):
    """A request (DataFrames by name) to a result. `contract` and `version` name it; `configuration` is a frozen dataclass or None."""

    contract: str
    version: str = "1"
    needs: tuple[str, ...] = ()
    gives: tuple[str, ...] = ()

    def __init__(self, configuration: object = None):
        if configuration is not None and not is_dataclass(configuration):
            raise TypeError("a configuration is a dataclass")
        self.configuration = configuration

    @property
    def identity(self) -> str:
        return _digest("action", self.contract, self.version, asdict(self.configuration) if self.configuration else None)

    def __call__(self, **inputs: DataFrame) -> DataFrame:
        """Checks what comes in and what goes out by name; columns that are missing raise an error before anything runs."""
        missing = [n for n in self.needs if n not in inputs]
        if missing:
            raise ValueError(f"{self.contract} needs {', '.join(missing)}")
        out = self.act(**inputs)
        lacking = [c for c in self.gives if c not in out.columns]
        if lacking:
            raise ValueError(f"{self.contract} lacks {', '.join(lacking)}")
        return out

    @abstractmethod
    def act(self, **inputs: DataFrame) -> DataFrame: ...


class Projector(Action):
    """A pure step: rows to rows, no effects."""


class Materializer(Action):
    """A step with an effect: brings rows to a target once for an idempotency key, and gives evidence of it: collection, created, unchanged, conflict."""

    gives = ("collection", "created", "unchanged", "conflict")

    def __init__(self, authority: str, configuration: object = None):
        super().__init__(configuration)
        if not authority:
            raise ValueError("an effect needs an authority")
        self.authority = authority

    def key(self, target: str) -> str:
        return _digest("materialization", self.identity, self.authority, target)


class Inventory(Action):
    """An observer: one row of counts and digests of a collection."""

    contract, needs, gives = "inventory", ("rows",), ("rows", "ids_sha256", "content_sha256")

    def __init__(self, key: str, content: Callable[[DataFrame], Column]):
        super().__init__()
        self.id_column, self.content = key, content

    def act(self, *, rows: DataFrame) -> DataFrame:
        return inventory(rows, self.id_column, self.content(rows))


class Aggregate(Action):
    """A policy that decides by group: subclass it with `decide`, aggregate columns over the rows of a group."""

    needs = ("rows",)

    def __init__(self, by: tuple[str, ...], configuration: object = None):
        super().__init__(configuration)
        self.by = by

    @abstractmethod
    def decide(self) -> Mapping[str, Column]: ...

    def act(self, *, rows: DataFrame) -> DataFrame:
        return rows.groupBy(*self.by).agg(*[c.alias(n) for n, c in self.decide().items()])


@dataclass(frozen=True)
class ConsensusPolicy:
    least: int = 2


class Consensus(Aggregate):
    """status and value of votes (value): too_few below the policy's least, no_consensus for several values, else admitted."""

    contract, gives = "consensus", ("status", "value")

    def __init__(self, by: tuple[str, ...], configuration: ConsensusPolicy = ConsensusPolicy()):
        super().__init__(by, configuration)

    def decide(self) -> Mapping[str, Column]:
        n, values = F.count("value"), F.count_distinct("value")
        status = F.when(n < self.configuration.least, "too_few").when(values > 1, "no_consensus").otherwise("admitted")
        return {"status": status, "value": F.when((n >= self.configuration.least) & (values == 1), F.min("value"))}


class Pipeline(Action):
    """Steps in a fixed order; each takes the result of the one before under the name it needs first, and the pipeline's other inputs by their names."""

    contract = "pipeline"

    def __init__(self, *steps: Action):
        super().__init__()
        if not steps:
            raise ValueError("a pipeline has steps")
        self.steps, self.needs = steps, steps[0].needs

    @property
    def identity(self) -> str:
        return _digest("pipeline", *[s.identity for s in self.steps])

    def act(self, **inputs: DataFrame) -> DataFrame:
        out = self.steps[0](**{k: inputs[k] for k in self.steps[0].needs})
        for step in self.steps[1:]:
            out = step(**{step.needs[0]: out}, **{k: inputs[k] for k in step.needs[1:]})
        return out
