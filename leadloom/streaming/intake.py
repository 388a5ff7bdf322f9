"""Continuous intake: each micro-batch goes through the same `ingest` as a static batch."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from leadloom.plans.ingest import IntakeOptions, Masters, commit_intake
from leadloom.sources.batches import BatchStore

def start_intake(
    requests: DataFrame,
    masters: Callable[[], Masters],
    state: str,
    checkpoint: str,
    options: IntakeOptions = IntakeOptions(),
    now: Callable[[], datetime] = lambda: datetime.now(timezone.utc),
    **trigger: object,
) -> StreamingQuery:
    """Start the intake of a stream of requests (`request_id, arrival_seq, arrival_ts, body`).

    `state` is a shared folder; `masters` is called per batch, so that changed masters take
    effect. Results of batch n are in `<state>/<table>/batch=n`.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        run_batch(batch, batch_id, masters(), state, now(), options)

    writer = requests.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    return writer.trigger(**trigger).start() if trigger else writer.start()


def run_batch(
    batch: DataFrame,
    batch_id: int,
    masters: Masters,
    state: str,
    as_of: datetime,
    options: IntakeOptions = IntakeOptions(),
) -> None:
    """Ingest one batch and commit its results; a batch that is committed already is skipped."""
    batches = BatchStore(batch.sparkSession, state)
    commit_intake(batches, str(batch_id), batch, masters, lambda: as_of, options)
