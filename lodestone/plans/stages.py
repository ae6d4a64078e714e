"""The stage runner: stages hand versioned tables to each other, run from a chosen one on, and are skipped when nothing changed."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

Stage = Callable[[SparkSession, DataFrame], DataFrame]


@dataclass
class Plan:
    """Named stages in order. Each reads the table of the one before and writes its own, so a stage can be run again alone."""

    folder: str
    stages: list[tuple[str, Stage]]
    optional: set[str] = field(default_factory=set)

    def chosen(self, start: str | None = None, only: str | None = None, everything: bool = False) -> list[str]:
        """`only` one stage; or from `start` on; optional stages need `everything` or a start at or after them."""
        names = [n for n, _ in self.stages]
        if only:
            return [n for n in names if n == only]
        if start is None:
            return [n for n in names if everything or n not in self.optional]
        return names[names.index(start) :]

    def table(self, name: str) -> str:
        return f"{self.folder}/{name}"

    def run(self, spark: SparkSession, source: DataFrame, start: str | None = None, only: str | None = None, everything: bool = False, dry_run: bool = False) -> list[str]:
        todo = self.chosen(start, only, everything)
        if dry_run:
            return todo
        names = [n for n, _ in self.stages]
        for name, stage in self.stages:
            if name in todo:
                k = names.index(name)
                before = source if k == 0 else spark.read.parquet(self.table(names[k - 1]))
                stage(spark, before).write.mode("overwrite").parquet(self.table(name))
        return todo
