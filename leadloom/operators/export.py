"""Metadata-defined exports and configuration rows."""

from __future__ import annotations

import re
from collections.abc import Collection

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadloom.constants import TRANSFER_CONFIG
from leadloom.functions.text import key

# Functions and words a stored expression may use besides columns of leads and partners.
ALLOWED_WORDS = frozenset(
    """
    acq part and or not is null in like between case when then else end cast as
    string int bigint double date timestamp true false
    coalesce nullif concat substring upper lower trim ltrim rtrim length replace lpad
    date_format abs round
    """.split()
)

_LITERAL = re.compile(r"'(?:[^']|'')*'")
_WORD = re.compile(r"[A-Za-z_][A-Za-z0-9_]*")
_FORBIDDEN = re.compile(r";|--|/\*|`|\"")


def export_items(catalogue: DataFrame, api: str | None = None) -> DataFrame:
    """Exported columns: a stored expression, or the question code itself, and its name."""
    if api is not None:
        catalogue = catalogue.filter(key("questiongroup_name") == api.rstrip().lower())
    return catalogue.select(
        "questiongroup_name",
        "sequence",
        F.when(key("answer_type") == "expression", F.col("lov"))
        .otherwise(F.col("question_code"))
        .alias("item"),
        F.col("question_api").alias("name"),
    )


def export_column_list(catalogue: DataFrame, api: str | None = None) -> DataFrame:
    """The projection of each export as one text, items in sequence order.

    A group is the column list of one export, so it is as small as a projection can be.
    """
    item = F.concat("item", F.lit(" AS ["), F.col("name"), F.lit("]"))
    ordered = F.array_sort(F.collect_list(F.struct("sequence", "name", item.alias("text"))))
    return (
        export_items(catalogue, api)
        .groupBy("questiongroup_name")
        .agg(F.array_join(F.transform(ordered, lambda i: i["text"]), ", ").alias("column_list"))
    )


def export_projection(
    leads: DataFrame,
    partners: DataFrame,
    catalogue: DataFrame,
    api: str,
    transaction_ids: DataFrame | None = None,
) -> DataFrame:
    """Leads joined to their partner, projected as the catalogue says.

    Expressions may name columns of leads (`acq`) and partners (`part`) and the allowed words;
    anything else is refused. `transaction_ids` restricts the export.
    """
    if transaction_ids is not None:
        wanted = transaction_ids.select(key("transaction_id").alias("wanted_key")).distinct()
        leads = leads.join(wanted, key("transaction_id") == F.col("wanted_key"), "left_semi")
    allowed = ALLOWED_WORDS | {c.lower() for c in (*leads.columns, *partners.columns)}
    # One row per exported column: the list of columns of one projection.
    items = sorted(export_items(catalogue, api).collect(), key=lambda r: (r.sequence, r.name))
    named = [(_checked(i["item"], allowed), i["name"]) for i in items]
    joined = leads.alias("acq").join(
        partners.alias("part"), key("part.id_partner") == key("acq.partner_id"), "left"
    )
    return joined.select(*[F.expr(item).alias(name) for item, name in named])


def _checked(expression: str, allowed: Collection[str]) -> str:
    code = _LITERAL.sub("", expression)
    unknown = sorted({w for w in _WORD.findall(code) if w.lower() not in allowed})
    if unknown or _FORBIDDEN.search(code):
        raise ValueError(f"export expression not allowed: {expression!r} {unknown}")
    return expression


def config_row(
    parameters: DataFrame, columns: dict[str, str] | None = None
) -> DataFrame:
    """Named key/value rows as one row; a missing key gives NULL."""
    columns = TRANSFER_CONFIG if columns is None else columns
    names = {name.lower(): column for name, column in columns.items()}
    wanted = parameters.withColumn("name_key", key("parameter_name")).filter(
        F.col("name_key").isin(list(names))
    )
    return wanted.agg(
        *[
            F.max(F.when(F.col("name_key") == name, F.col("parameter_value"))).alias(column)
            for name, column in names.items()
        ]
    )
