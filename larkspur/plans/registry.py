from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Runner = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    run: Runner
    oracle: str | None


REGISTRY: dict[str, Query] = {}


def query(name: str, oracle: str | None) -> Callable[[Runner], Runner]:
    """Register a query under its operator name, with its SQL where one exists."""

    def add(run: Runner) -> Runner:
        if name in REGISTRY:
            raise ValueError(f"query {name} is registered twice")
        REGISTRY[name] = Query(run, oracle)
        return run

    return add
