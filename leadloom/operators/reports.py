"""Dashboard reports over leads and their latest status."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime, time, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leadloom.constants import RECAP_COLUMNS, SOURCE_DATA
from leadloom.functions.joins import lookup
from leadloom.functions.text import key
from leadloom.operators.latest import KEYS, NAMES, latest_counts, status_ids
from leadloom.sources.tables import read_table


@dataclass(frozen=True)
class ReportFilter:
    """Filters of both reports; `ALL` and 0 mean no filter."""

    start: datetime
    end: datetime
    partner: str = "ALL"
    product: str = "ALL"
    status: int = 0
    branch: int = 0

    def days(self) -> tuple[date, date]:
        """First and last day of the orders: a start with a time of day excludes that day."""
        first = self.start.date()
        if self.start.time() > time():
            first += timedelta(days=1)
        return first, self.end.date()


def stored_leads(spark: SparkSession, path: str, report: ReportFilter) -> DataFrame:
    """The stored leads of the days of the filter; other days' directories are not opened."""
    return read_table(spark, path, "leads", *report.days())


def detail_report(
    leads: DataFrame,
    partners: DataFrame,
    status_log: DataFrame,
    status_master: DataFrame,
    offices: DataFrame,
    report: ReportFilter,
) -> DataFrame:
    """One row per lead and latest status row, ordered by partner, order and status.

    The status filter is on the status of the lead, the shown status is that of the history.
    Leads whose partner or status is unknown are left out. `status_log` is the history or a table of
    latest statuses with counts.
    """
    ids = status_ids(status_master)
    rows = _with_latest(_selected(leads, report), status_log, ids, report)
    # A status that the latest date has several times gives as many rows.
    repeated = F.flatten(
        F.transform(
            F.arrays_zip(F.array(*[F.lit(i) for i in ids]).alias("id"), F.col("counts").alias("n")),
            lambda x: F.array_repeat(x["id"], x["n"].cast("int")),
        )
    )
    rows = rows.withColumn("latest_id_status", F.explode(repeated))
    agents = partners.select(
        key("id_partner").alias("agent_key"), F.col("name").alias("name_agent")
    )
    statuses = status_master.select(
        F.col("id_status").alias("latest_id_status"), F.col("status").alias("status_desc")
    )
    rows = (
        rows.join(agents, F.col("partner_key") == F.col("agent_key"))
        .join(statuses, "latest_id_status")
        .select(
            F.col("partner_id").alias("id_agent"),
            "order_id",
            "name_agent",
            F.col("full_name").alias("nama_calon_peminjaman"),
            "status_desc",
            "agrmnt_no",
            "po_no",
            F.date_format("po_date", "yyyy-MM-dd HH:mm:ss").alias("po_date"),
            "po_tenor",
            "office_code",
            "instalment_amt",
            F.col("latest_id_status").alias("id_status"),
        )
    )
    return (
        _in_branch(rows, offices, report)
        .drop("office_code")
        .orderBy("id_agent", "order_id", "id_status")
    )


def status_recap(
    leads: DataFrame,
    status_log: DataFrame,
    status_master: DataFrame,
    offices: DataFrame,
    report: ReportFilter,
) -> DataFrame:
    """Ten counts in one row, one per status; leads with an unknown partner count too."""
    rows = _with_latest(_selected(leads, report), status_log, list(RECAP_COLUMNS), report)
    if report.branch != 0:
        rows = _in_branch(rows.select("office_code", "counts"), offices, report)
    none = F.lit(0).cast("long")
    counts = rows.agg(
        *[
            F.coalesce(F.sum(F.get("counts", F.lit(i))), none).alias(c)
            for i, c in enumerate(RECAP_COLUMNS.values())
        ]
    )
    # Statuses that the master lacks count nothing, those it has twice count twice.
    times = status_master.agg(
        *[F.count_if(F.col("id_status") == k).alias(f"times_{k}") for k in RECAP_COLUMNS]
    )
    return counts.select(
        *[
            (F.col(c) * times.select(f"times_{k}").scalar()).alias(c)
            for k, c in RECAP_COLUMNS.items()
        ]
    )


def _selected(leads: DataFrame, report: ReportFilter) -> DataFrame:
    """Leads that pass the filters on their own columns.

    Orders count by day, so the day range becomes a plain range of timestamps, which reaches
    the Parquet scan.
    """
    first, last = (datetime.combine(day, time()) for day in report.days())
    after_last = last + timedelta(days=1)
    rows = leads.filter(
        (F.col("order_dt") >= F.lit(first).cast("timestamp"))
        & (F.col("order_dt") < F.lit(after_last).cast("timestamp"))
        & (key("source_data") == SOURCE_DATA.lower())
    )
    if report.partner != "ALL":
        rows = rows.filter(_of_partner(report))
    if report.product != "ALL":
        rows = rows.filter(
            F.lower(F.trim("product_type_desc")) == report.product.rstrip().lower()
        )
    if report.status != 0:
        rows = rows.filter(F.col("id_status") == report.status)
    return rows


def _of_partner(report: ReportFilter) -> Column:
    return key("partner_id") == report.partner.rstrip().lower()


def _with_latest(
    leads: DataFrame, status_log: DataFrame, statuses: list[int], report: ReportFilter
) -> DataFrame:
    """Leads joined to the counts of their latest history rows; adds `partner_key` and `counts`.

    For a report over one partner, product or status the history is cut to the leads asked for
    before it is counted. Without such a filter nearly all histories are wanted.
    """
    if report.partner != "ALL":
        status_log = status_log.filter(_of_partner(report))
    narrow = report.partner != "ALL" or report.product != "ALL" or report.status != 0
    latest = latest_counts(status_log, statuses, of=leads if narrow else None)
    keyed = leads.withColumns({k: key(name) for name, k in zip(NAMES, KEYS, strict=True)})
    return keyed.join(latest.drop("status_dt"), list(KEYS))


def _in_branch(rows: DataFrame, offices: DataFrame, report: ReportFilter) -> DataFrame:
    """Add `ref_office_id` (0 when the office is unknown) and apply the branch filter."""
    known = offices.groupBy(key("office_code").alias("office_key")).agg(
        F.min("ref_office_id").alias("ref_office_id")
    )
    rows = rows.join(lookup(known, "office_key"), key("office_code") == F.col("office_key"), "left").withColumn(
        "ref_office_id", F.coalesce("ref_office_id", F.lit(0))
    )
    if report.branch != 0:
        rows = rows.filter(F.col("ref_office_id") == report.branch)
    return rows.drop("office_key")
