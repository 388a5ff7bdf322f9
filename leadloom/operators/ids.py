"""Dense running numbers without a global sort."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leadloom.constants import TRANSACTION_FORMAT

# A 64-bit order value is read as four digits of 16 bits. A window never holds more than the
# 2^16 rows that share all but the last digit, whatever the distribution of the values.
_DIGIT_BITS = 16
_LEVELS = 3


def running_numbers(
    df: DataFrame,
    order_col: str,
    counts: dict[str, Column],
    within: Sequence[str] = (),
) -> DataFrame:
    """Add, per entry of `counts`, the running count of rows that satisfy its condition.

    Rows are counted in the order of `order_col`, a unique whole number, from 1 and without gaps,
    separately per value of `within`. Rows that do not satisfy a condition get NULL. Rows
    are shuffled once, by bucket of the order value; the buckets before a row are added up
    on the much smaller table of bucket counts.
    """
    within = list(within)
    order = F.col(order_col).cast("long")
    flagged = df.withColumns(
        {
            "bucket_1": F.shiftright(order, _DIGIT_BITS),
            **{f"{name}_hit": F.when(cond, 1).otherwise(0) for name, cond in counts.items()},
        }
    )
    hits = [f"{name}_hit" for name in counts]
    offsets = _bucket_offsets(flagged, within, hits)
    in_bucket = (
        Window.partitionBy(*within, "bucket_1")
        .orderBy(order_col)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    counted = flagged.withColumns({f"{h}_run": F.sum(h).over(in_bucket) for h in hits})
    same_group = [F.col(f"offset_{c}").eqNullSafe(F.col(c)) for c in within]
    located = counted.join(
        offsets, [F.col("bucket_1") == F.col("offset_bucket"), *same_group], "left"
    )
    numbers = {
        name: F.when(F.col(f"{name}_hit") == 1, F.col(f"{name}_hit_run") + F.col(f"{name}_hit_before"))
        for name in counts
    }
    return located.select(*df.columns, *[n.cast("long").alias(c) for c, n in numbers.items()])


def _bucket_offsets(flagged: DataFrame, within: list[str], hits: list[str]) -> DataFrame:
    """Hits before each bucket, added up digit by digit.

    The count table of each level has one row per bucket of that level; a running sum covers the
    buckets with one upper bucket in common, the sum before that one comes from the level above.
    """
    counts = [flagged.groupBy(*within, "bucket_1").agg(*[F.sum(h).alias(h) for h in hits])]
    for level in range(2, _LEVELS + 1):
        upper = F.shiftright(f"bucket_{level - 1}", _DIGIT_BITS).alias(f"bucket_{level}")
        counts[-1] = counts[-1].select("*", upper)
        counts.append(
            counts[-1].groupBy(*within, f"bucket_{level}").agg(*[F.sum(h).alias(h) for h in hits])
        )
    offsets = _renamed(
        _summed_before(counts[-1], within, f"bucket_{_LEVELS}", hits), within, _LEVELS, hits
    )
    for level in range(_LEVELS - 1, 0, -1):
        lower = _summed_before(
            counts[level - 1], [*within, f"bucket_{level + 1}"], f"bucket_{level}", hits
        )
        same = [F.col(f"offset_{c}").eqNullSafe(F.col(c)) for c in within]
        joined = lower.join(
            offsets, [F.col(f"bucket_{level + 1}") == F.col("offset_bucket"), *same]
        )
        total = {f"{h}_sum": F.col(f"{h}_sum") + F.col(f"{h}_before") for h in hits}
        offsets = _renamed(joined.withColumns(total), within, level, hits)
    return offsets


def _summed_before(
    counts: DataFrame, group: list[str], bucket: str, hits: list[str]
) -> DataFrame:
    before = (
        Window.partitionBy(*(group or [F.lit(0)]))
        .orderBy(bucket)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return counts.withColumns(
        {f"{h}_sum": F.coalesce(F.sum(h).over(before), F.lit(0)) for h in hits}
    )


def _renamed(sums: DataFrame, within: list[str], level: int, hits: list[str]) -> DataFrame:
    return sums.select(
        *[F.col(c).alias(f"offset_{c}") for c in within],
        F.col(f"bucket_{level}").alias("offset_bucket"),
        *[F.col(f"{h}_sum").alias(f"{h}_before") for h in hits],
    )


def allocate_ids(
    df: DataFrame,
    order_col: str = "arrival_seq",
    accepted: Column | None = None,
    acq_start: int = 1,
    transaction_start: int = 1,
) -> DataFrame:
    """Add `acq_id` for every row and `transaction_id` for accepted rows, in arrival order.

    The caller passes the next free values; one writer at a time is assumed.
    """
    accepted = F.lit(True) if accepted is None else accepted
    numbered = running_numbers(
        df, order_col, {"acq_number": F.lit(True), "transaction_number": accepted}
    )
    return (
        numbered.withColumn("acq_id", F.col("acq_number") + (acq_start - 1))
        .withColumn(
            "transaction_id",
            F.when(
                F.col("transaction_number").isNotNull(),
                F.format_string(
                    TRANSACTION_FORMAT, F.col("transaction_number") + (transaction_start - 1)
                ),
            ),
        )
        .drop("acq_number", "transaction_number")
    )
