"""JSON bodies as arrays of members, kept inside the request row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadloom.functions.text import key

# First letters of the SQL type of a JSON value -> kind of member.
_KINDS = {
    "STR": "string",
    "BIG": "int",
    "DEC": "real",
    "DOU": "real",
    "BOO": "boolean",
    "VOI": "null",
    "OBJ": "object",
    "ARR": "array",
}


def add_members(frame: DataFrame) -> DataFrame:
    """Add `members`: those of the JSON object `body`: `element_id, name, string_value, value_type`.

    Member order and repeated names are kept, a JSON null has the text `null`. A body that is
    not a JSON object gives NULL. No row leaves its partition: the array stays in the row.
    Of a name repeated inside a nested value the last one counts; that takes the setting of
    `session.tune`. In a session without it such a body is read as texts, whose kinds are guessed.

    Lambdas are interpreted, and structs or casts of variants inside them cost most of a body's time.
    So the fields are arrays of their own, each a column that is computed once, and put together at
    the end; where all values are texts the plain reading has them.
    """
    typed, plain, kinds = F.col("_typed"), F.col("_plain"), F.col("_kinds")
    all_texts = F.size(F.array_except(kinds, F.array(F.lit("string")))) == 0
    texts = F.when(all_texts, F.map_values(plain)).otherwise(
        F.transform(F.map_values(typed), lambda v: F.coalesce(v.cast("string"), F.lit("null")))
    )
    # Without the setting the typed reading refuses a repeated name inside a nested value.
    found = F.when(typed.isNotNull(), _members(F.map_keys(typed), F.col("_texts"), kinds)).otherwise(
        F.transform(F.map_entries(plain), _plain_member)
    )
    return (
        frame.withColumns(
            {
                "_typed": F.from_json("body", "map<string,variant>"),
                "_plain": F.from_json("body", "map<string,string>"),
            }
        )
        .withColumn("_kinds", F.transform(F.map_values(typed), _kind))
        .withColumn("_texts", texts)
        .withColumn("members", found)
        .drop("_typed", "_plain", "_kinds", "_texts")
    )


def keys_of(found: Column) -> Column:
    """Comparable names of all members, in order."""
    return F.transform(found["name"], key)


def first_text(found: Column, keys: Column, name: str) -> Column:
    """Text of the first member of that name, in any case; `keys` are the `keys_of` the members."""
    place = F.array_position(keys, name.lower())
    return F.get(found["string_value"], (place - 1).cast("int"))


def _kind(value: Column) -> Column:
    kinds = F.create_map(*[F.lit(part) for pair in _KINDS.items() for part in pair])
    sql_type = F.substring(F.schema_of_variant(value), 1, 3)
    return F.coalesce(F.try_element_at(kinds, sql_type), F.lit("string"))


def _members(names: Column, texts: Column, kinds: Column) -> Column:
    return F.arrays_zip(
        numbers_of(names).alias("element_id"),
        names.alias("name"),
        texts.alias("string_value"),
        kinds.alias("value_type"),
    )


def numbers_of(items: Column) -> Column:
    """1, 2, ... for every element of an array that is not NULL."""
    return F.slice(F.sequence(F.lit(1), F.greatest(F.size(items), F.lit(1))), F.lit(1), F.size(items))


def _plain_member(entry: Column, index: Column) -> Column:
    kind = (
        F.when(entry["value"].isNull(), "null")
        .when(entry["value"].startswith("{"), "object")
        .otherwise("string")
    )
    return F.struct(
        (index + 1).alias("element_id"),
        entry["key"].alias("name"),
        F.coalesce(entry["value"], F.lit("null")).alias("string_value"),
        kind.alias("value_type"),
    )
