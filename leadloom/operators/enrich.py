"""Address enrichment: master lookups, partner vocabulary and sub zip codes."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadloom.constants import ADDRESS_COLUMNS, ADDRESS_MAPPING
from leadloom.functions.joins import lookup
from leadloom.functions.text import flag, key


# Sub zip code of a request -> prefix and suffix of its address columns.
SUB_ZIP_ADDRESSES = {"survey_sub_zip_code": ("survey_", ""), "legal_sub_zip_code": ("", "")}


@dataclass(frozen=True)
class LookupSpec:
    """One master lookup: `value` of the row of `table` whose `keys` equal request columns.

    `keys` maps a table column to a request column; `where` is a filter on the table. Several
    matches give the least value.
    """

    output: str
    table: str
    keys: tuple[tuple[str, str], ...]
    value: str
    where: str | None = None


def address_lookups() -> list[LookupSpec]:
    """Default specs: each address field must fit the fields above it in the address."""
    specs = []
    for prefix in ("survey_", ""):
        field = {name: prefix + name for name in ("province", "city", "sub_district", "village")}
        zip_field = prefix + "city_id"
        zip_keys = (
            ("city", field["city"]),
            ("kecamatan", field["sub_district"]),
            ("kelurahan", field["village"]),
            ("zipcode", zip_field),
        )
        specs.append(
            LookupSpec(
                field["province"],
                "districts",
                (("name", field["province"]),),
                "name",
                "type = 'PRV' and is_active = '1'",
            )
        )
        for depth, output in enumerate(
            (field["city"], field["sub_district"], field["village"], zip_field), start=1
        ):
            keys = zip_keys[:depth]
            specs.append(
                LookupSpec(output, "zipcodes", keys, keys[-1][0], "is_active = '1'")
            )
    return specs


def master_lookup(
    requests: DataFrame,
    tables: dict[str, DataFrame],
    specs: Sequence[LookupSpec] | None = None,
    only_when: Column | None = None,
) -> DataFrame:
    """Add `<output>_found` (text) per spec, NULL where the masters have no such value.

    All lookups go through one join: each request that needs them (`only_when`) gives one narrow
    row per spec, the masters one row per distinct key. The wide request is joined once, by its
    `request_id`, and never multiplied. A lookup with a missing key finds nothing.
    """
    specs = list(specs if specs is not None else address_lookups())
    if not specs:
        return requests
    found = found_in_masters(requests, tables, specs, only_when)
    return requests.join(found, "request_id", "left")


def found_in_masters(
    requests: DataFrame,
    tables: dict[str, DataFrame],
    specs: Sequence[LookupSpec],
    only_when: Column | None = None,
) -> DataFrame:
    """`request_id, <output>_found …` of the requests for which the masters have a value."""
    needed = F.lit(True) if only_when is None else flag(only_when)
    # Specs that read the same columns of the same rows share one master.
    sources = list(dict.fromkeys(_source(s) for s in specs))
    keys = [f"key_{i}" for i in range(max(len(s.keys) for s in specs))]
    masters = None
    for number, (name, where, columns, value) in enumerate(sources):
        table = tables[name].filter(where) if where else tables[name]
        rows = table.select(
            F.lit(str(number)).alias("source"),
            *_padded(keys, columns),
            F.col(value).cast("string").alias("value"),
        ).dropna(subset=keys)
        masters = rows if masters is None else masters.unionAll(rows)
    masters = masters.groupBy("source", *keys).agg(F.min("value").alias("value"))
    asked = F.array(
        *[
            F.struct(
                F.lit(s.output).alias("output"),
                F.lit(str(sources.index(_source(s)))).alias("source"),
                *_padded(keys, [column for _, column in s.keys]),
            )
            for s in specs
        ]
    )
    return (
        requests.filter(needed)
        .select("request_id", F.inline(asked))
        .dropna(subset=keys)
        .join(lookup(masters, "source", *keys), ["source", *keys])
        .groupBy("request_id")
        .agg(
            *[
                F.max(F.when(F.col("output") == s.output, F.col("value"))).alias(
                    f"{s.output}_found"
                )
                for s in specs
            ]
        )
    )


def _source(spec: LookupSpec) -> tuple[str, str | None, tuple[str, ...], str]:
    return spec.table, spec.where, tuple(column for column, _ in spec.keys), spec.value


def _padded(names: Sequence[str], columns: Sequence[str]) -> list[Column]:
    """The key columns, and empty texts up to the number of names."""
    values = [key(c) for c in columns] + [F.lit("")] * (len(names) - len(columns))
    return [value.alias(name) for name, value in zip(names, values)]


def map_codes(requests: DataFrame, code_map: DataFrame, only_when: Column) -> DataFrame:
    """Add `<field>_mapped` for the ten address fields and `is_ambiguous`.

    The fields are translated from the vocabulary of the partner, per (partner, field). A value
    without mapping becomes NULL; a value with two mappings makes the request ambiguous. The ten
    fields go through one join as ten narrow rows, for the requests that need it only; requests
    that do not need it keep their own values.
    """
    needed = flag(only_when)
    joined = requests.join(mapped_codes(requests, code_map, needed), "request_id", "left")
    return joined.withColumns(
        {
            **{
                f"{field}_mapped": F.when(needed, F.col(f"{field}_mapped")).otherwise(F.col(field))
                for field in ADDRESS_COLUMNS
            },
            "is_ambiguous": flag(F.col("is_ambiguous")),
        }
    )


def mapped_codes(requests: DataFrame, code_map: DataFrame, needed: Column) -> DataFrame:
    """`request_id, <field>_mapped …, is_ambiguous` of the requests with a mapped field."""
    mappings = (
        code_map.select(
            key("partner_id").alias("partner_key"),
            key("field_mapping").alias("mapping_key"),
            key("descr_partner").alias("value_key"),
            "descr_internal",
        )
        .dropna(subset=["partner_key", "mapping_key", "value_key"])
        .groupBy("partner_key", "mapping_key", "value_key")
        .agg(F.min("descr_internal").alias("internal"), F.count("*").alias("matches"))
    )
    fields = F.array(
        *[
            F.struct(
                F.lit(field).alias("field"),
                F.lit(mapping.lower()).alias("mapping_key"),
                key(field).alias("value_key"),
            )
            for field, mapping in ADDRESS_MAPPING.items()
        ]
    )
    asked = requests.filter(needed).select(
        "request_id", key("partner_id").alias("partner_key"), F.inline(fields)
    )
    return (
        asked.dropna(subset=["value_key", "partner_key"])
        .join(
            lookup(mappings, "partner_key", "mapping_key", "value_key"),
            ["partner_key", "mapping_key", "value_key"],
        )
        .groupBy("request_id")
        .agg(
            *[
                F.max(F.when(F.col("field") == field, F.col("internal"))).alias(f"{field}_mapped")
                for field in ADDRESS_COLUMNS
            ],
            F.max(F.col("matches") > 1).alias("is_ambiguous"),
        )
    )


def active_sub_zips(zipcodes: DataFrame, districts: DataFrame) -> DataFrame:
    """Least sub zip code per address whose zip, district and province are all active."""
    active = districts.filter("is_active = '1'")
    provinces = active.filter("type = 'PRV'").select(F.col("district_id").alias("parent_id"))
    in_province = active.filter("type = 'DIS'").join(provinces, "parent_id", "left_semi")
    return (
        zipcodes.filter("is_active = '1'")
        .join(in_province, "district_id", "left_semi")
        .groupBy(
            key("kelurahan").alias("village_key"),
            key("kecamatan").alias("sub_district_key"),
            key("city").alias("city_key"),
            key("zipcode").alias("zip_key"),
        )
        .agg(F.min("sub_zipcode").alias("sub_zip_code"))
    )


# Key of a sub zip code -> column of an address.
_SUB_ZIP_KEYS = {
    "village_key": "village",
    "sub_district_key": "sub_district",
    "city_key": "city",
    "zip_key": "city_id",
}


def resolve_sub_zips(
    requests: DataFrame, sub_zips: DataFrame, addresses: dict[str, tuple[str, str]]
) -> DataFrame:
    """Add one sub zip code per address, all through one join of narrow rows.

    `addresses` maps an output to the `(prefix, suffix)` of the columns `<prefix>village<suffix>`
    and so on. `sub_zips` comes from `active_sub_zips`.
    """
    found = found_sub_zips(asked_sub_zips(requests, addresses), sub_zips, list(addresses))
    return requests.join(found, "request_id", "left")


def asked_sub_zips(requests: DataFrame, addresses: dict[str, tuple[str, str]]) -> DataFrame:
    """One narrow row per request and whole address; `addresses` as in `resolve_sub_zips`."""
    asked = F.array(
        *[
            F.struct(
                F.lit(output).alias("output"),
                *[key(f"{prefix}{c}{suffix}").alias(k) for k, c in _SUB_ZIP_KEYS.items()],
            )
            for output, (prefix, suffix) in addresses.items()
        ]
    )
    return requests.select("request_id", F.inline(asked)).dropna(subset=list(_SUB_ZIP_KEYS))


def found_sub_zips(asked: DataFrame, sub_zips: DataFrame, outputs: Sequence[str]) -> DataFrame:
    """`request_id` and one column per output, for the requests with a sub zip code."""
    return (
        asked.join(lookup(sub_zips, *_SUB_ZIP_KEYS), list(_SUB_ZIP_KEYS))
        .groupBy("request_id")
        .agg(
            *[
                F.max(F.when(F.col("output") == output, F.col("sub_zip_code"))).alias(output)
                for output in outputs
            ]
        )
    )


def resolve_sub_zip_code(
    requests: DataFrame, zipcodes: DataFrame, districts: DataFrame
) -> DataFrame:
    """Add `survey_sub_zip_code` and `legal_sub_zip_code`."""
    return resolve_sub_zips(requests, active_sub_zips(zipcodes, districts), SUB_ZIP_ADDRESSES)
