"""Totals of the current rows, kept up to date from signed changes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.streaming.state import Runs


@dataclass
class Totals(Runs):
    """SUM and COUNT by group, maintained batch by batch.

    A batch is the signed change of the current rows (``_sign`` 1 for a row that became current, -1 for one
    that no longer is, e.g. of a closed version): it is scanned once and its sums per group become a run; a
    batch that comes again overwrites its own run, so nothing is counted twice.  Runs are merged by level like the history's,
    and reading adds them up: as many rows per group as there are runs, whatever the number of rows behind them.
    Sums should be integers or decimals, which retract exactly.  Groups without rows disappear; NULL
    measures add nothing, and a NULL group is a group."""

    by: Mapping[str, Column]
    sums: Mapping[str, Column]

    def _summed(self, rows: DataFrame, value) -> DataFrame:
        return rows.groupBy(*self.by).agg(*(F.sum(value(c)).alias(c) for c in [*self.sums, "row_count"]))

    def apply(self, delta: DataFrame, batch_id: int) -> None:
        self._merge(batch_id)
        rows = delta.select(*(c.alias(k) for k, c in self.by.items()), *(c.alias(k) for k, c in self.sums.items()),
                            F.lit(1).alias("row_count"), "_sign")
        kinds = {f.name: f.dataType for f in rows.schema.fields}
        groups = self._summed(rows, lambda c: F.coalesce(F.col(c), F.lit(0).cast(kinds[c])) * F.col("_sign").cast("int"))
        wide = [F.col(c).cast("decimal(38,4)" if kinds[c].typeName() == "decimal" else "long").alias(c) for c in [*self.sums, "row_count"]]
        groups.select(*self.by, *wide).write.mode("overwrite").parquet(self._path((batch_id, batch_id)))

    def _combine(self, live: Sequence[tuple[int, int]], span: tuple[int, int]) -> None:
        self._all(live).write.mode("overwrite").parquet(self._path(span))

    def _all(self, spans: Sequence[tuple[int, int]]) -> DataFrame:
        stored = self.spark.read.parquet(*(self._path(s) for s in spans))
        return self._summed(stored, F.col).select(*stored.columns[:len(self.by)], *(
            F.col(c).cast(stored.schema[c].dataType).alias(c) for c in [*self.sums, "row_count"]))

    def read(self) -> DataFrame:
        """One row per group with its sums and ``row_count``."""
        return self._all(self.runs()).where(F.col("row_count") > 0)


__all__ = ["Totals"]
