"""A ledger of finished steps, so that a run that failed goes on where it stopped."""

from __future__ import annotations

import hashlib
import inspect
import sys
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import SparkSession

from touchline.sources.load import LoadResult, load_table
from touchline.sources.store import Store

#: The name of the ledger's table, which lies beside the staging tables.
LEDGER = "refresh_ledger"
SCHEMA = "step string, fingerprint string, version string, chunks bigint, row_count bigint"
#: Parts of the library whose code decides what a step writes.
RECIPE = ("functions", "operators", "plans", "sources", "constants")


def recipe() -> str:
    """A digest of the code of the library's steps: another code is another recipe."""
    prefixes = tuple(f"touchline.{part}" for part in RECIPE)
    modules = [m for name, m in sorted(sys.modules.items()) if name.startswith(prefixes)]
    return digest(*[inspect.getsource(module) for module in modules])


def digest(*parts: object) -> str:
    """One text for all that a step depends on; each part counts by its whole content."""
    code = hashlib.sha256()
    for part in parts:
        text = repr(part).encode()
        code.update(len(text).to_bytes(8, "little") + text)
    return code.hexdigest()


@dataclass(frozen=True)
class Ledger:
    """The last finished run of each step, as one row by step in a table of ``store``.

    A row tells the fingerprint of what the step depended on, and the version of the table
    that it wrote. A step is done if it depends on the same things as then and its table has
    not been changed since. Each step's row is a load of its own, so steps that run side by
    side write at once, and a step that is repeated has one row.
    """

    spark: SparkSession
    store: Store

    def open(self) -> dict[str, tuple]:
        """The rows by step: as many as there are steps. The table is made if there is none,
        before steps write to it side by side."""
        if not self.store.exists(self.spark, LEDGER):
            self.record("start", "", "", LoadResult("start", True, 0, 0))
        rows = self.store.files(self.spark, LEDGER).select(*[x.split()[0] for x in SCHEMA.split(", ")])
        return {row["step"]: tuple(row) for row in rows.collect()}

    def record(self, step: str, fingerprint: str, version: str, result: LoadResult) -> None:
        row = (step, fingerprint, version, result.chunks, result.rows)
        df = self.spark.createDataFrame([row], SCHEMA).coalesce(1)
        load_table(df, LEDGER, self.store, "append", load_id=f"step-{step}")

    def run(
        self,
        known: dict[str, tuple],
        step: str,
        fingerprint: str,
        store: Store,
        action: Callable[[], LoadResult],
    ) -> tuple[LoadResult, str]:
        """What the step reports and its table's version; it only runs if it isn't done.

        ``known`` are the rows that ``open`` found, and ``store`` is where the step writes its
        table, which has the step's name.
        """
        if step in known:
            _, told, version, chunks, rows = known[step]
            if told == fingerprint and version and store.version(self.spark, step) == version:
                return LoadResult(step, True, chunks, rows), version
        result = action()
        version = store.version(self.spark, step)
        if result.success:
            self.record(step, fingerprint, version, result)
        return result, version
