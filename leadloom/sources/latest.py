"""A table of latest statuses that is kept up to date batch by batch.

Each batch of status rows adds one small folder with the rows of the latest date per key of that batch
(`latest_rows`). The folders together hold everything that matters: a reader takes the latest date over
all of them, ties add up, and late rows lose against newer ones. Reports read this table in place of
the history. `merge` folds the folders into one of a new generation.

    path/generation=7/base/            merged rows
    path/generation=7/batch=42/        rows of one batch, replaced when the batch is given again
    path/generation=7/_merged/42       batches that the base holds
    path/generation=7/_READY           written last: the generation with the highest number is read

A batch given twice counts once, before and after a merge. One writer at a time is assumed. A merge
that breaks off leaves the old generation in use, and the next merge replaces what it left.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from leadloom.operators.latest import latest_rows
from leadloom.sources import files

_SCHEMA = (
    "order_id string, transaction_id string, partner_id string, status_dt timestamp, "
    "id_status int, n long"
)
_GENERATION = re.compile(r"generation=(\d+)")


@dataclass(frozen=True)
class LatestStatus:
    """The maintained table below `path`."""

    spark: SparkSession
    path: str

    def _generation(self) -> int:
        """The highest generation that is complete; -1 before the first batch."""
        numbers = [
            int(found[1])
            for name in files.children(self.spark, self.path)
            if (found := _GENERATION.fullmatch(name))
            and files.exists(self.spark, f"{self.path}/{name}/_READY")
        ]
        return max(numbers, default=-1)

    def _folder(self, number: int) -> str:
        return f"{self.path}/generation={number}"

    def batches(self) -> set[str]:
        """Ids of all batches that the table holds."""
        folder = self._folder(self._generation())
        open_ = {
            name.removeprefix("batch=")
            for name in files.children(self.spark, folder)
            if name.startswith("batch=") and files.exists(self.spark, f"{folder}/{name}/_SUCCESS")
        }
        return open_ | set(files.children(self.spark, f"{folder}/_merged"))

    def add(self, batch_id: str, rows: DataFrame) -> None:
        """Take in the status rows of a batch; one that is held already changes nothing."""
        if not re.fullmatch(r"[A-Za-z0-9-]+", batch_id):
            raise ValueError("a batch id consists of letters, digits and hyphens")
        if batch_id in self.batches():
            return
        number = self._generation()
        if number < 0:
            number = 0
            files.mark(self.spark, f"{self._folder(0)}/_READY")
        target = f"{self._folder(number)}/batch={batch_id}"
        latest_rows(rows).write.mode("overwrite").parquet(target)

    def read(self) -> DataFrame:
        """The rows of all folders, in the form of a history with counts, for the reports.

        Keys that several batches changed occur several times; the reports take the latest date.
        """
        folder = self._folder(self._generation())
        parts = [
            f"{folder}/{name}"
            for name in files.children(self.spark, folder)
            if not name.startswith("_") and files.exists(self.spark, f"{folder}/{name}/_SUCCESS")
        ]
        if not parts:
            return self.spark.createDataFrame([], _SCHEMA)
        # The parts lie in folders of different names: no folder name becomes a column.
        return self.spark.read.schema(_SCHEMA).option("recursiveFileLookup", "true").parquet(*parts)

    def merge(self) -> None:
        """Fold all folders into the base of a new generation and remove the old one."""
        number = self._generation()
        if number < 0:
            return
        held, new = self.batches(), self._folder(number + 1)
        files.remove(self.spark, new)
        latest_rows(self.read()).write.parquet(f"{new}/base")
        for batch_id in held:
            files.mark(self.spark, f"{new}/_merged/{batch_id}")
        files.mark(self.spark, f"{new}/_READY")
        files.remove(self.spark, self._folder(number))
