"""The latest status of every transaction as counts, from one shuffle of the history.

A history row matters to a report only by its key (order, transaction, partner), date and status.
Rows are counted per key and date with one count per status, in every task before the shuffle; of
these counts the one with the latest date is the maximum of a (date, counts) pair per key, again taken
in every task first. So ties keep their multiplicity, the history is scanned and shuffled once, and a
key or a day that holds a third of all rows is a few rows by the time it is shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadloom.functions.joins import lookup
from leadloom.functions.text import key

NAMES = ("order_id", "transaction_id", "partner_id")
KEYS = ("order_key", "transaction_key", "partner_key")
# Statuses are a code list; a report over more of them is an error, not a shorter report.
MOST_STATUSES = 512


def _weight(rows: DataFrame) -> Column:
    """How many history rows a row stands for: those of a compacted table carry a count."""
    return F.col("n") if "n" in rows.columns else F.lit(1).cast("long")


def _keyed(rows: DataFrame) -> DataFrame:
    keyed = rows.select(
        *[key(name).alias(k) for name, k in zip(NAMES, KEYS, strict=True)],
        "status_dt",
        "id_status",
        _weight(rows).alias("n"),
    )
    return keyed.dropna(subset=[*KEYS, "status_dt"])


def latest_counts(
    history: DataFrame, statuses: Sequence[int], of: DataFrame | None = None
) -> DataFrame:
    """(order_key, transaction_key, partner_key, status_dt, counts) of the latest date per key.

    `counts` has, per entry of `statuses`, the number of history rows with that status on that date.
    Rows without a part of the key or a date belong to nobody. With `of` (rows with the three names)
    only the histories of its keys are read on.
    """
    rows = _keyed(history)
    if of is not None:
        wanted = of.select(*[key(name).alias(k) for name, k in zip(NAMES, KEYS, strict=True)])
        rows = rows.join(wanted.dropna(), list(KEYS), "left_semi")
    return _newest(
        rows,
        [
            F.sum(F.when(F.col("id_status") == s, F.col("n")).otherwise(0)).cast("long")
            for s in statuses
        ],
    )


def latest_rows(history: DataFrame) -> DataFrame:
    """The history of the latest date per key, equal rows as one with their number `n`.

    Its columns are those of a history that reports need (the names hold the comparable form), so
    the result can take the place of the history it was made from, alone or together with newer rows.
    """
    keyed = _keyed(history)
    found = keyed.select("id_status").distinct().limit(MOST_STATUSES + 1).collect()
    if 0 < len(found) <= MOST_STATUSES:
        rows = _of_statuses(keyed, [r["id_status"] for r in found])
    else:
        rows = _of_any_status(keyed)
    return rows.select(
        *[F.col(k).alias(name) for name, k in zip(NAMES, KEYS, strict=True)],
        "status_dt",
        "id_status",
        "n",
    )


def _of_statuses(keyed: DataFrame, statuses: Sequence[int | None]) -> DataFrame:
    """Latest rows by one count per status (NULL where a date has none): no join of the counts."""
    ids = [F.lit(s).cast("int") for s in statuses]
    newest = _newest(
        keyed, [F.sum(F.when(F.col("id_status").eqNullSafe(s), F.col("n"))) for s in ids]
    )
    pairs = F.arrays_zip(F.array(*ids).alias("id_status"), F.col("counts").alias("n"))
    return newest.select(*KEYS, "status_dt", F.inline(pairs)).where("n is not null")


def _of_any_status(keyed: DataFrame) -> DataFrame:
    """Latest rows of any number of statuses."""
    counted = keyed.groupBy(*KEYS, "status_dt", "id_status").agg(F.sum("n").alias("n"))
    newest = counted.groupBy(*KEYS).agg(F.max("status_dt").alias("newest"))
    return counted.join(lookup(newest, *KEYS), list(KEYS)).where("status_dt = newest")


def _newest(keyed: DataFrame, counts: Sequence[Column]) -> DataFrame:
    """(keys, status_dt, counts) of the latest date per key; `counts` are aggregates of a date."""
    per_date = keyed.groupBy(*KEYS, "status_dt").agg(F.array(*counts).alias("counts"))
    newest = per_date.groupBy(*KEYS).agg(F.max(F.struct("status_dt", "counts")).alias("newest"))
    return newest.select(*KEYS, "newest.status_dt", "newest.counts")


def status_ids(status_master: DataFrame) -> list[int]:
    """The statuses of the master, in order."""
    found = status_master.select("id_status").dropna().distinct().limit(MOST_STATUSES + 1).collect()
    if len(found) > MOST_STATUSES:
        raise ValueError(f"more than {MOST_STATUSES} statuses")
    return sorted(r["id_status"] for r in found)
