"""A registered query: how Spark builds it, what it shows, and the SQL that checks it."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from catalog.base_sql import shown
from catalog.present import present
from tradewind.sources.bindings import Canonical


@dataclass(frozen=True)
class Query:
    build: Callable[[Canonical], DataFrame]
    columns: str
    body: str | None = None

    def run(self, spark: SparkSession, folder: str) -> DataFrame:
        return present(self.build(Canonical(spark, folder)), self.columns)

    @property
    def sql(self) -> str | None:
        return None if self.body is None else shown(self.columns, self.body)
