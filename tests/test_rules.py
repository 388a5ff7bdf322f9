"""Value checks, rule order and messages."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from leadloom.functions import checks, text
from leadloom.operators import rules
from tests.conftest import mapping, rows


def outcome(spark, check, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r.failed for r in df.select("i", check(F.col("v")).alias("failed")).orderBy("i").collect()]


def test_id_number(spark):
    good = ["123", "  123 "]
    bad = ["12A4", "1.5", "1,5", "1'5", "-15", "1\\5", "1 5", "", "  ", None, "12\n", "$5"]
    assert outcome(spark, checks.bad_id_number, good) == [False] * len(good)
    assert outcome(spark, checks.bad_id_number, bad) == [True] * len(bad)


def test_date(spark):
    good = ["1990-01-31", "19900131", "01/31/1990", " 1990-01-31 ", "", "  ", None]
    bad = ["1990-02-30", "text", "null", "1990", "31/01/1990"]
    assert outcome(spark, checks.bad_date, good) == [False] * len(good)
    assert outcome(spark, checks.bad_date, bad) == [True] * len(bad)


def test_number(spark):
    good = ["12", "12.5", "-3", "+4", " 5 ", "5.", ".5", "9" * 18, None]
    bad = ["1e3", "9" * 19, "", "  ", "null", "x", ".", "1,000", "9" * 60]
    assert outcome(spark, checks.bad_number, good) == [False] * len(good)
    assert outcome(spark, checks.bad_number, bad) == [True] * len(bad)


def test_length(spark):
    values = ["abc", "abcd", "abc   ", None]
    assert outcome(spark, lambda v: checks.too_long(v, F.lit(3)), values) == [
        False,
        True,
        False,
        False,
    ]
    assert outcome(spark, lambda v: checks.too_long(v, F.lit(None).cast("int")), ["abc"]) == [False]


def test_blank(spark):
    values = [None, "", "  ", "null", "NULL ", "x", " null"]
    assert outcome(spark, text.is_blank, values) == [True, True, True, True, True, False, False]


def answers(spark, *values, **flags):
    """One request whose answers a, b, … have these values and the same rule flags."""
    frame = spark.createDataFrame(
        [
            (
                "r",
                [
                    (i + 1, name.upper(), name, v, *[flags.get(f) for f in _FLAGS])
                    for i, (name, v) in enumerate(zip("abcdef", values))
                ],
            )
        ],
        """request_id string, bound array<struct<row_num: int, question_code: string,
        name: string, string_value: string, is_mandatory: boolean, is_date: boolean,
        is_numeric: boolean, max_length: int>>""",
    )
    return rules.check_answers(frame).first()


_FLAGS = ("is_mandatory", "is_date", "is_numeric", "max_length")


def test_lowest_offending_answer_is_named(spark):
    found = answers(spark, "x", "", " ", is_mandatory=True, is_date=False, is_numeric=False)
    assert (found.blank_param, found.bad_date_param, found.long_param) == ("b", None, None)
    found = answers(spark, "12", "x", "y", is_mandatory=False, is_date=True, is_numeric=True)
    assert (found.bad_date_param, found.bad_number_param) == ("a", "b")
    found = answers(spark, "12", "123", is_mandatory=False, max_length=2)
    assert (found.long_param, found.length_limit) == ("b", 2)


def test_unbound_request_breaks_no_answer_rule(spark):
    frame = spark.createDataFrame(
        [("r", None)],
        """request_id string, bound array<struct<row_num: int, question_code: string,
        name: string, string_value: string, is_mandatory: boolean, is_date: boolean,
        is_numeric: boolean, max_length: int>>""",
    )
    found = rules.check_answers(frame).first()
    assert found.blank_param is None and found.long_param is None


ORDER = ["12", "03", "08", "13", "11", "09", "10", "14"]


@pytest.mark.parametrize("first", range(len(ORDER) + 1))
def test_first_failing_rule_wins(spark, codes, first):
    """All rules from position `first` on fail; the one at that position gives the code."""

    def fails(code):
        return ORDER.index(code) >= first

    frame = spark.range(1).select(
        F.when(F.lit(fails("12")), "m").alias("blank_param"),
        F.lit(fails("03")).alias("is_stored"),
        F.lit(not fails("08")).alias("is_registered"),
        F.lit(fails("13")).alias("is_bad_id_number"),
        F.when(F.lit(fails("11")), "d").alias("bad_date_param"),
        F.when(F.lit(fails("09")), "n").alias("bad_number_param"),
        F.when(F.lit(fails("10")), "l").alias("long_param"),
        F.lit(5).alias("length_limit"),
        F.when(F.lit(fails("14")), "14").alias("master_code"),
    )
    found = rules.first_failure(frame, codes).first()
    expected = ORDER[first] if first < len(ORDER) else "00"
    assert found.response_code == expected
    messages = {
        "12": "m is mandatory",
        "11": "d must be date format",
        "09": "n must be numeric",
        "10": "l must be 5 digits",
        "00": "Success",
    }
    assert found.response_message == messages.get(expected, found.response_message)


def test_code_missing_from_the_master_stays_a_failure(spark, codes):
    frame = spark.createDataFrame(
        [("12", "m", None, None, None, None)],
        """response_code string, blank_param string, bad_date_param string,
        bad_number_param string, long_param string, length_limit int""",
    )
    found = rules.with_message(frame, codes.filter("response_code <> '12'")).first()
    assert (found.response_code, found.response_message) == ("12", None)


def test_partner_of_another_kind_is_not_registered(spark):
    requests = spark.createDataFrame([("P1",), ("p2 ",), ("P3",), (None,)], "partner_id string")
    partners = spark.createDataFrame(
        [("P1", "one", 1, "Main_Dealer"), ("P2", "two", 2, "Other"), (None, "x", 0, "Main_Dealer")],
        "id_partner string, name string, flag_master int, flag_master_partner string",
    )
    assert mapping(
        rules.check_partner(requests, partners), "partner_id", "is_registered", "flag_master"
    ) == {"P1": (True, 1), "p2 ": (False, 2), "P3": (False, None), None: (False, None)}


def test_batch_duplicates_follow_arrival(spark):
    """Against requests handled one after another."""
    data = []
    for seq in range(60):
        order = None if seq % 11 == 0 else f"o{seq % 7}"
        own = ["00", "13", "12", "08"][(seq * 5) % 4]
        data.append((f"r{seq}", seq, order, f"p{seq % 2}", own, seq % 13 == 5))
    expected, accepted = {}, set()
    for request, _, order, partner, own, unreadable in data:
        code = own
        if order is not None and (partner, order) in accepted and own != "12" and not unreadable:
            code = "03"
        if code == "00" and order is not None:
            accepted.add((partner, order))
        expected[request] = code
    frame = spark.createDataFrame(
        data,
        """request_id string, arrival_seq long, order_id string, partner_id string,
        own_code string, is_unreadable boolean""",
    )
    judged = rules.check_batch_duplicates(frame)
    assert mapping(judged, "request_id", "response_code") == expected


def test_stored_duplicates_ignore_case_and_null_keys(spark):
    requests = spark.createDataFrame(
        [("1", "A1", "p1"), ("2", "a1 ", "P1"), ("3", "a1", "p2"), ("4", None, "p1"), ("5", None, None)],
        "request_id string, order_id string, partner_id string",
    )
    leads = spark.createDataFrame(
        [("a1", "p1"), ("a1", "P1"), (None, "p1")], "order_id string, partner_id string"
    )
    assert rows(rules.check_duplicate(requests, leads), "request_id", "is_stored") == [
        ("1", True),
        ("2", True),
        ("3", False),
        ("4", False),
        ("5", False),
    ]
