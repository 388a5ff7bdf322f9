"""Tables written batch by batch, where a batch becomes visible as a whole or not at all.

    root/<table>/batch=<id>/     rows of one batch
    root/_commits/<id>           empty; written last, it makes all rows of the batch visible
    root/job_log/                START and END, or START and ERROR, of every run

Readers see committed batches only. A run that fails takes its rows back and logs the error; one that
was cut off leaves rows that nobody sees and that the next run of the batch, or `recover`, removes.
A committed batch given again changes nothing. One writer at a time is assumed.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from leadloom.operators.replies import job_audit
from leadloom.schemas import schema
from leadloom.sources import files

_JOB = "proc_name string, status string, error string, at timestamp"


@dataclass(frozen=True)
class BatchStore:
    """Batches of tables below `root`."""

    spark: SparkSession
    root: str

    def committed(self) -> list[str]:
        """Ids of the batches that are visible."""
        return files.children(self.spark, f"{self.root}/_commits")

    def read(self, table: str, columns: StructType | None = None) -> DataFrame:
        """Rows of all committed batches; the schema is that of the engine table unless given."""
        columns = columns or schema(table)
        if not files.exists(self.spark, f"{self.root}/{table}"):
            return self.spark.createDataFrame([], columns)
        fields = StructType([*columns.fields, StructField("batch", StringType())])
        rows = self.spark.read.schema(fields).parquet(f"{self.root}/{table}")
        return rows.where(F.col("batch").isin(self.committed())).drop("batch")

    def run(
        self,
        batch_id: str,
        name: str,
        outputs: Callable[[], Mapping[str, DataFrame]],
        now: Callable[[], datetime],
    ) -> bool:
        """Write and commit what `outputs` returns; False if the batch is committed already.

        `name` stands in the job log. An error is logged, the batch is taken back, and the error is
        raised again.
        """
        if not re.fullmatch(r"[A-Za-z0-9-]+", batch_id):
            raise ValueError("a batch id consists of letters, digits and hyphens")
        if files.exists(self.spark, f"{self.root}/_commits/{batch_id}"):
            return False
        self._log(name, "START", None, now())
        try:
            for table, rows in outputs().items():
                self.write(batch_id, table, rows)
            files.mark(self.spark, f"{self.root}/_commits/{batch_id}")
        except Exception as error:
            self.give_up(batch_id)
            self._log(name, "ERROR", str(error), now())
            raise
        self._log(name, "END", None, now())
        return True

    def write(self, batch_id: str, table: str, rows: DataFrame) -> None:
        """Write one table of a batch that is not committed yet."""
        rows.write.mode("overwrite").parquet(f"{self.root}/{table}/batch={batch_id}")

    def give_up(self, batch_id: str) -> None:
        """Remove all rows of a batch that is not committed."""
        if batch_id in self.committed():
            raise ValueError("a committed batch is not given up")
        for table in files.children(self.spark, self.root):
            files.remove(self.spark, f"{self.root}/{table}/batch={batch_id}")

    def recover(self) -> list[str]:
        """Remove what runs that were cut off have left; returns the ids of their batches."""
        committed, lost = set(self.committed()), set()
        for table in files.children(self.spark, self.root):
            for folder in files.children(self.spark, f"{self.root}/{table}"):
                batch_id = folder.removeprefix("batch=")
                if folder != batch_id and batch_id not in committed:
                    files.remove(self.spark, f"{self.root}/{table}/{folder}")
                    lost.add(batch_id)
        return sorted(lost)

    def job_log(self) -> DataFrame:
        """START, END and ERROR rows of all runs."""
        if not files.exists(self.spark, f"{self.root}/job_log"):
            return self.spark.createDataFrame([], schema("job_log"))
        return self.spark.read.schema(schema("job_log")).parquet(f"{self.root}/job_log")

    def _log(self, name: str, status: str, error: str | None, at: datetime) -> None:
        row = self.spark.createDataFrame([(name, status, error, at)], _JOB)
        job_audit(row).coalesce(1).write.mode("append").parquet(f"{self.root}/job_log")
