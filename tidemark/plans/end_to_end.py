"""One domain from raw rows to answers: ingest, enforce, index, ask."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from tidemark.plans import assistant, medallion
from tidemark.sources.lakehouse import Lakehouse


@dataclass(frozen=True)
class RunReport:
    ingested: int
    published: dict[str, int]
    indexed: int
    answers: DataFrame


def run(lake: Lakehouse, raw: DataFrame, questions: DataFrame, salt: str | None = None) -> RunReport:
    """Run the whole chain for one profile."""
    ingested = medallion.ingest(lake, raw, salt)
    published = medallion.enforce(lake, salt)
    indexed = assistant.build_index(lake)
    return RunReport(ingested, published, indexed, assistant.ask(lake, questions))
