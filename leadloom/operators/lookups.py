"""Master lookups as the catalogue stores them.

The list of values of an EXPRESSION question may hold one scalar lookup of a fixed form:

    SELECT [TOP 1] <column> FROM <table> WHERE <column> = @<FIELD> [AND <column> = '<text>' ...]

Only this form is read, with the known masters, their columns and the address fields as names. It
becomes a `LookupSpec`, so that stored text never runs; anything else is refused.
"""

from __future__ import annotations

import re
from collections.abc import Collection, Sequence

from pyspark.sql import DataFrame

from leadloom.constants import ADDRESS_COLUMNS
from leadloom.functions.text import key
from leadloom.operators.enrich import LookupSpec, address_lookups

_NAME = r"[A-Za-z_][A-Za-z0-9_]*"
_CONDITION = rf"{_NAME}\s*=\s*(?:@{_NAME}|'[^'\\]*')"
_LOOKUP = re.compile(
    rf"\s*SELECT\s+(?:TOP\s+1\s+)?({_NAME})\s+FROM\s+({_NAME})"
    rf"\s+WHERE\s+({_CONDITION}(?:\s+AND\s+{_CONDITION})*)\s*",
    re.IGNORECASE,
)
_PART = re.compile(rf"({_NAME})\s*=\s*(?:@({_NAME})|'([^'\\]*)')")


def read_lookup(
    output: str,
    expression: str,
    tables: dict[str, DataFrame],
    fields: Collection[str] = ADDRESS_COLUMNS,
) -> LookupSpec:
    """The spec of one stored lookup; names are read without regard to case."""
    found = _LOOKUP.fullmatch(expression)
    if found is None:
        raise ValueError(f"not a stored lookup: {expression!r}")
    table = _known(found[2], tables, "master", expression)
    columns = tables[table].columns
    value = _known(found[1], columns, "column", expression)
    keys, texts = [], []
    for column, field, text in _PART.findall(found[3]):
        column = _known(column, columns, "column", expression)
        if field:
            keys.append((column, _known(field, fields, "field", expression)))
        else:
            # As all texts are compared: case and trailing blanks do not matter.
            texts.append(f"lower(rtrim(CAST(`{column}` AS STRING))) = '{text.rstrip(' ').lower()}'")
    if not keys:
        raise ValueError(f"a stored lookup names no field: {expression!r}")
    return LookupSpec(output, table, tuple(keys), value, " and ".join(texts) or None)


def catalogue_lookups(
    catalogue: DataFrame,
    api: str,
    tables: dict[str, DataFrame],
    fallback: Sequence[LookupSpec] | None = None,
) -> list[LookupSpec]:
    """One spec per field: the stored lookup of the API's question, else that of `fallback`.

    The default fallback is `address_lookups()`. The rows read are the EXPRESSION questions of one
    API. A question stored twice with different lookups is refused; empty texts count as none.
    """
    rows = catalogue.filter(
        (key("questiongroup_name") == api.rstrip().lower()) & (key("answer_type") == "expression")
    )
    stored: dict[str, LookupSpec] = {}
    for row in rows.select("question_code", "lov").distinct().collect():
        if row.question_code is None or not (row.lov or "").strip():
            continue
        output = row.question_code.rstrip().lower()
        spec = read_lookup(output, row.lov, tables)
        if stored.setdefault(output, spec) != spec:
            raise ValueError(f"two stored lookups for {output!r}")
    rest = address_lookups() if fallback is None else fallback
    own = [s for s in rest if s.output not in stored]
    return sorted(stored.values(), key=lambda s: s.output) + own


def _known(name: str, names: Collection[str], kind: str, expression: str) -> str:
    for known in names:
        if known.lower() == name.lower():
            return known
    raise ValueError(f"unknown {kind} {name!r} in a stored lookup: {expression!r}")
