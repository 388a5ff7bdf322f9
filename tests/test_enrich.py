"""Master lookups, code mapping, sub zip codes and running numbers."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from leadloom.constants import ADDRESS_COLUMNS, MASTER_CODES
from leadloom.operators import enrich, ids, rules
from tests.conftest import mapping, rows

ADDRESS = ", ".join(f"{c} string" for c in ADDRESS_COLUMNS)
GOOD = ("PROV", "CITY", "SUB", "VIL", "10001") * 2


def requests(spark, *rows_):
    """Requests from (id, partner, flag, ten address values)."""
    return spark.createDataFrame(
        [(r, p, flag, *address) for r, p, flag, address in rows_],
        f"request_id string, partner_id string, flag_master int, {ADDRESS}",
    )


def changed(**values):
    return tuple(values.get(c, v) for c, v in zip(ADDRESS_COLUMNS, GOOD))


@pytest.fixture(scope="module")
def tables(spark):
    return {
        "zipcodes": spark.createDataFrame(
            [
                ("S2", 10, "VIL", "SUB", "CITY", "10001", "1"),
                ("S1", 10, "vil ", "SUB", "CITY", "10001", "1"),
                ("S0", 10, "VIL", "SUB", "CITY", "10001", "0"),
                ("T1", 11, "OFF", "SUB", "CITY", "10001", "1"),
                ("T2", 12, "NOPROV", "SUB", "CITY", "10001", "1"),
                ("T3", 1, "ISPROV", "SUB", "CITY", "10001", "1"),
                ("T4", 13, "OFFPROV", "SUB", "CITY", "10001", "1"),
            ],
            """sub_zipcode string, district_id int, kelurahan string, kecamatan string,
            city string, zipcode string, is_active string""",
        ),
        "districts": spark.createDataFrame(
            [
                (1, None, "PROV", "PRV", "1"),
                (2, None, "OLD", "PRV", "0"),
                (10, 1, "CITY", "DIS", "1"),
                (11, 1, "CITY", "DIS", "0"),
                (12, 99, "CITY", "DIS", "1"),
                (13, 2, "CITY", "DIS", "1"),
            ],
            "district_id int, parent_id int, name string, type string, is_active string",
        ),
    }


def master_codes(df, tables):
    found = enrich.master_lookup(df, tables, only_when=F.col("flag_master") == 1)
    return mapping(rules.check_masters(found), "request_id", "master_code")


@pytest.mark.parametrize("field", list(MASTER_CODES))
def test_each_field_has_its_code(spark, tables, field):
    # Only this field is unknown to its own lookup; fields tested later may fail with it.
    df = requests(spark, ("1", "P", 1, changed(**{field: "none"})), ("2", "P", 1, GOOD))
    assert master_codes(df, tables) == {"1": MASTER_CODES[field], "2": None}


def test_lower_code_wins_and_other_kinds_are_not_tested(spark, tables):
    bad = changed(survey_village="none", province="none")
    df = requests(
        spark, ("1", "P", 1, bad), ("2", "P", 0, bad), ("3", "P", 2, bad), ("4", "P", None, bad)
    )
    assert master_codes(df, tables) == {"1": "17", "2": None, "3": None, "4": None}


def test_custom_lookup_returns_the_least_value(spark, tables):
    spec = enrich.LookupSpec("city", "zipcodes", (("city", "city"),), "sub_zipcode")
    df = requests(spark, ("1", "P", 1, GOOD))
    assert enrich.master_lookup(df, tables, [spec]).first().city_found == "S0"


def test_code_mapping(spark):
    code_map = spark.createDataFrame(
        [
            ("P", "PROVINCE", "prov", "Inner province"),
            ("P", "CITY", "CITY", "Inner city"),
            ("P", "VILLAGE", "VIL", "one"),
            ("P", "VILLAGE", "vil ", "two"),
            ("Q", "PROVINCE", "PROV", "of another partner"),
            (None, "CITY", "CITY", "of nobody"),
        ],
        "partner_id string, field_mapping string, descr_partner string, descr_internal string",
    )
    df = requests(
        spark,
        ("mapped", "P", 2, changed(survey_village="x", village=None)),
        ("ambiguous", "P", 2, GOOD),
        ("other", "Q", 2, changed(province="none")),
        ("plain", "P", 1, GOOD),
        ("nobody", None, 2, GOOD),
    )
    mapped = enrich.map_codes(df, code_map, F.col("flag_master") == 2)
    found = mapping(
        mapped,
        "request_id",
        "is_ambiguous",
        "survey_province_mapped",
        "survey_city_mapped",
        "province_mapped",
        "village_mapped",
    )
    assert found.pop("ambiguous")[0] is True
    assert found == {
        "mapped": (False, "Inner province", "Inner city", "Inner province", None),
        "other": (False, "of another partner", None, None, None),
        "plain": (False, "PROV", "CITY", "PROV", "VIL"),
        "nobody": (False, None, None, None, None),
    }


def test_sub_zip_needs_active_zip_district_and_province(spark, tables):
    df = requests(
        spark,
        ("least", "P", 1, GOOD),
        ("district off", "P", 1, changed(village="OFF")),
        ("no province", "P", 1, changed(village="NOPROV")),
        ("not a district", "P", 1, changed(village="ISPROV")),
        ("province off", "P", 1, changed(village="OFFPROV")),
        ("missing", "P", 1, changed(village=None)),
    )
    found = enrich.resolve_sub_zip_code(df, tables["zipcodes"], tables["districts"])
    assert mapping(found, "request_id", "survey_sub_zip_code", "legal_sub_zip_code") == {
        "least": ("S1", "S1"),
        "district off": ("S1", None),
        "no province": ("S1", None),
        "not a district": ("S1", None),
        "province off": ("S1", None),
        "missing": ("S1", None),
    }


@pytest.mark.parametrize("span", [50, 10**6, 2**40, 2**62])
def test_running_numbers_equal_counting_one_by_one(spark, span):
    """Dense, sparse and clustered order values, negative ones too."""
    random.seed(span)
    values = {random.randrange(-span, span) for _ in range(60)} | set(range(span, span + 40))
    data = [(v, f"k{v % 3}" if v % 4 else None, v % 5 == 0) for v in values]
    random.shuffle(data)
    df = spark.createDataFrame(data, "seq long, k string, hit boolean")
    expected, counts = {}, {}
    for seq, k, hit in sorted(data):
        for group in ("all", k):
            n, h = counts.get(group, (0, 0))
            counts[group] = (n + 1, h + hit)
        expected[seq] = (
            counts["all"][0],
            counts["all"][1] if hit else None,
            counts[k][0],
        )
    counted = ids.running_numbers(df, "seq", {"n": F.lit(True), "h": F.col("hit")})
    found = mapping(counted, "seq", "n", "h")
    within = mapping(
        ids.running_numbers(df, "seq", {"n": F.lit(True)}, within=["k"]), "seq", "n"
    )
    assert {s: (*found[s], within[s]) for s in found} == expected


def test_allocated_ids_are_dense_and_wider_than_seven_digits_when_needed(spark):
    df = spark.range(0, 100_000, 1, 7).select(
        (F.col("id") * 3).alias("arrival_seq"), (F.col("id") % 2 == 0).alias("ok")
    )
    out = ids.allocate_ids(df, accepted=F.col("ok"), acq_start=11, transaction_start=9_999_999)
    found = out.orderBy("arrival_seq").collect()
    assert [r.acq_id for r in found] == list(range(11, 100_011))
    numbers = [r.transaction_id for r in found if r.ok]
    assert numbers[:2] == ["MD9999999", "MD10000000"]
    assert numbers == [f"MD{9_999_999 + i:07d}" for i in range(50_000)]
    assert all(r.transaction_id is None for r in found if not r.ok)


def test_no_rows_no_ids(spark):
    df = spark.createDataFrame([], "arrival_seq long")
    assert rows(ids.allocate_ids(df)) == []
