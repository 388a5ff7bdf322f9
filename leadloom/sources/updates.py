"""Updates of stored tables that rewrite only the days they touch.

The days of the changed keys are found by a semi-join that reads only key columns. These days are read
whole, changed, and written to a staging folder inside the table (hidden from readers by its leading
underscore). Then the staged files of each day replace the stored ones: they are moved, not written again.
A day that lost all rows is removed. Files of all other days stay as they are.

A staged update is either complete (`_READY` is written last) or worthless. `recover` applies complete
ones that broke off, which is the same as applying them once, and removes the others. One writer at a
time is assumed; a reader may meet days of both versions while an update is being applied.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadloom.functions.text import key
from leadloom.sources import files
from leadloom.sources.tables import DAY_OF, read_days, stored_day, with_day

_STAGED = "_staged"


def affected_days(stored: DataFrame, changed: DataFrame, *names: str) -> list[date | None]:
    """The days of stored rows (with `day`) whose text keys `names` occur in `changed`.

    A row without one of the keys matches nothing. One value per day reaches the driver.
    """
    keys = [f"{name}_key" for name in names]
    wanted = changed.select(*[key(n).alias(k) for n, k in zip(names, keys, strict=True)]).dropna()
    narrow = stored.select("day", *[key(n).alias(k) for n, k in zip(names, keys, strict=True)])
    days = narrow.join(wanted, keys, "left_semi").select("day").distinct()
    return [r["day"] for r in days.collect()]


def of_days(stored: DataFrame, days: list[date | None]) -> DataFrame:
    """The stored rows (with `day`) of some days; other days' files are not opened."""
    known = [d for d in days if d is not None]
    some = F.col("day").isin(known) if known else F.lit(False)
    return stored.where(some | F.col("day").isNull() if None in days else some)


def stage(rows: DataFrame, path: str, table: str, days: list[date | None]) -> str:
    """Write the new rows of `days` to a staging folder of the table; returns the folder.

    Rows that changed to a day outside `days` are an error: the rest of that day is not at hand.
    """
    spark = rows.sparkSession
    folder = f"{path}/{_STAGED}/{uuid.uuid4().hex}"
    with_day(rows, table).write.partitionBy("day").parquet(f"{folder}/rows")
    held = {n for n in files.children(spark, f"{folder}/rows") if n.startswith("day=")}
    asked = {stored_day(d) for d in days}
    if not held <= asked:
        files.remove(spark, folder)
        raise ValueError("an update must not move rows to other days")
    for name in asked - held:
        files.mark(spark, f"{folder}/_emptied/{name}")
    files.mark(spark, f"{folder}/_READY")
    return folder


def apply(spark: SparkSession, path: str, table: str, folder: str) -> None:
    """Let the staged days replace the stored ones. Doing it again changes nothing.

    Moved files carry the name of their staging folder, so that a second run tells them from those
    they replace; each file is moved by itself, after the old ones of its day are gone.
    """
    mark = f"{folder.rsplit('/', 1)[-1]}-"
    for day in files.children(spark, f"{folder}/rows"):
        if not day.startswith("day="):
            continue
        for name in files.children(spark, f"{path}/{day}"):
            if not name.startswith(mark):
                files.remove(spark, f"{path}/{day}/{name}")
        for name in files.children(spark, f"{folder}/rows/{day}"):
            files.move(spark, f"{folder}/rows/{day}/{name}", f"{path}/{day}/{mark}{name}")
    for name in files.children(spark, f"{folder}/_emptied"):
        files.remove(spark, f"{path}/{name}")
    files.remove(spark, folder)


def recover(spark: SparkSession, path: str, table: str) -> int:
    """Finish staged updates that broke off; returns how many were applied."""
    applied = 0
    for name in files.children(spark, f"{path}/{_STAGED}"):
        folder = f"{path}/{_STAGED}/{name}"
        if files.exists(spark, f"{folder}/_READY"):
            apply(spark, path, table, folder)
            applied += 1
        else:
            files.remove(spark, folder)
    return applied


def update_days(
    spark: SparkSession,
    path: str,
    table: str,
    changed: DataFrame,
    names: tuple[str, ...],
    change: Callable[[DataFrame], DataFrame],
) -> list[date | None]:
    """Change the rows of the days in which keys of `changed` occur; returns these days.

    `change` gets all rows of these days and returns their new version.
    """
    if table not in DAY_OF:
        raise ValueError(f"{table} is not kept by day")
    recover(spark, path, table)
    stored = read_days(spark, path, table)
    days = affected_days(stored, changed, *names)
    if days:
        part = of_days(stored, days).drop("day")
        apply(spark, path, table, stage(change(part), path, table, days))
    return days
