"""Lookups stored in the catalogue: what is read, what is refused, what falls back."""

import pytest

from leadloom.operators import enrich
from leadloom.operators.lookups import catalogue_lookups, read_lookup

ZIPS = "SELECT zipcode FROM zipcodes WHERE city = @CITY"


@pytest.fixture
def tables(spark):
    return {
        "zipcodes": spark.createDataFrame(
            [("C", "1", "1"), ("C", "0", "0"), ("c ", "3", "1"), ("D", None, "1"), (None, "9", "1")],
            "city string, zipcode string, is_active string",
        ),
        "districts": spark.createDataFrame([(7, "North")], "district_id int, name string"),
    }


def catalogue(spark, *rows):
    return spark.createDataFrame(
        list(rows), "questiongroup_name string, question_code string, answer_type string, lov string"
    )


def test_reads_one_form(tables):
    spec = read_lookup(
        "city", " select top 1 ZipCode\nFROM ZIPCODES where City=@city AND is_active = 'Yes ' ", tables
    )
    assert spec == enrich.LookupSpec(
        "city", "zipcodes", (("city", "city"),), "zipcode",
        "lower(rtrim(CAST(`is_active` AS STRING))) = 'yes'",
    )


@pytest.mark.parametrize(
    "stored",
    [
        "upper(city)",
        "SELECT zipcode FROM zipcodes",
        "SELECT zipcode FROM zipcodes WHERE is_active = '1'",
        "SELECT zipcode FROM zipcodes WHERE city = @CITY OR is_active = '1'",
        "SELECT zipcode FROM zipcodes WHERE city = @CITY; DROP TABLE zipcodes",
        "SELECT zipcode FROM zipcodes WHERE city = @CITY -- AND is_active = '1'",
        "SELECT zipcode, city FROM zipcodes WHERE city = @CITY",
        "SELECT max(zipcode) FROM zipcodes WHERE city = @CITY",
        "SELECT zipcode FROM zipcodes WHERE city = (SELECT name FROM districts)",
        "SELECT zipcode FROM zipcodes WHERE city = @CITY AND is_active = 'it''s'",
        "SELECT zipcode FROM zipcodes WHERE city = @CITY AND is_active = '\\'",
        "SELECT zipcode FROM leads WHERE city = @CITY",
        "SELECT zip FROM zipcodes WHERE city = @CITY",
        "SELECT zipcode FROM zipcodes WHERE town = @CITY",
        "SELECT zipcode FROM zipcodes WHERE city = @ID_NO",
        "",
    ],
)
def test_refuses_all_else(tables, stored):
    with pytest.raises(ValueError):
        read_lookup("city", stored, tables)


def test_stored_lookups_come_before_those_in_code(spark, tables):
    rows = catalogue(
        spark,
        ("API ", "CITY", "Expression", ZIPS),
        ("api", "city ", "EXPRESSION", ZIPS),
        ("api", "PROVINCE", "EXPRESSION", "  "),
        ("api", "VILLAGE", "TEXT", "not read"),
        ("other", "ZIP", "EXPRESSION", "not read either"),
        ("api", None, "EXPRESSION", ZIPS),
        (None, "CITY", "EXPRESSION", "nor this"),
    )
    specs = catalogue_lookups(rows, "api", tables)
    assert specs[0] == enrich.LookupSpec("city", "zipcodes", (("city", "city"),), "zipcode")
    assert specs[1:] == [s for s in enrich.address_lookups() if s.output != "city"]
    assert catalogue_lookups(rows, "api", tables, fallback=[]) == specs[:1]
    assert catalogue_lookups(rows.limit(0), "api", tables) == enrich.address_lookups()
    asked = spark.createDataFrame(
        [("1", "C"), ("2", "c"), ("3", "D"), ("4", None), ("5", "X"), ("6", "C")],
        "request_id string, city string",
    )
    found = enrich.master_lookup(asked, tables, specs[:1])
    assert {r.request_id: r.city_found for r in found.collect()} == {
        "1": "0", "2": "0", "3": None, "4": None, "5": None, "6": "0",
    }
    active = catalogue(spark, ("api", "CITY", "EXPRESSION", ZIPS + " AND is_active = '1'"))
    specs = catalogue_lookups(active, "api", tables, fallback=[])
    assert enrich.master_lookup(asked.limit(1), tables, specs).first().city_found == "1"


def test_two_lookups_of_one_field_are_refused(spark, tables):
    rows = catalogue(
        spark,
        ("api", "CITY", "EXPRESSION", ZIPS),
        ("api", "CITY", "EXPRESSION", ZIPS + " AND is_active = '1'"),
    )
    with pytest.raises(ValueError, match="two stored lookups"):
        catalogue_lookups(rows, "api", tables)
