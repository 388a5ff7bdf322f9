"""What several operators of this package need: reading tables, text batches, fold numbers."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# A batch of rows handed to Python is bounded by rows and, where Spark knows the setting, by bytes,
# so that a run of very long texts does not fill a worker's memory.
_BATCH = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(32 << 20),
    "spark.sql.execution.pythonUDF.arrow.enabled": "true",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, read where it lies."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> SparkSession:
    """Bound the batches that go to Python; the settings stay with the session."""
    for key, value in _BATCH.items():
        spark.conf.set(key, value)
    return spark


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, under the names this package uses (target=source).

    Extra columns of the input, also such as have a name used here, never reach an operator.
    """
    return df.select(*[F.col(f"`{source}`").alias(target) for target, source in columns.items()])


def fold(ids: Column, n: int) -> Column:
    """crc32 of the id as text, modulo n; a missing id counts as the empty text."""
    return F.crc32(F.coalesce(ids.cast("string"), F.lit("")).cast("binary")) % n


def text_of(value: object) -> str:
    """A text from a batch: missing values are empty."""
    return value if isinstance(value, str) else ""


def rows_of(frames: Iterator[pd.DataFrame], most_chars: int = 8_000_000) -> Iterator[pd.DataFrame]:
    """The frames cut so that each holds at most about `most_chars` characters in `text`.

    One text is never cut; a longer one makes a frame of its own.
    """
    for frame in frames:
        lengths = frame["text"].str.len().fillna(0).to_numpy()
        start, held = 0, 0
        for k, n in enumerate(lengths):
            if k > start and held + n > most_chars:
                yield frame.iloc[start:k]
                start, held = k, 0
            held += n
        if len(frame) > start:
            yield frame.iloc[start:]
