"""Shredding, binding, widening and routing."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from leadloom.operators import requests
from leadloom.operators.catalogue import question_catalogue, rule_catalogue
from tests.conftest import mapping, rows


def bodies(spark, *texts):
    return spark.createDataFrame(
        [(str(i), i, None, t) for i, t in enumerate(texts)],
        "request_id string, arrival_seq long, arrival_ts timestamp, body string",
    )


def catalogue_of(spark, *questions, active=1):
    """Catalogue of API `api` from (api_name, code) pairs."""
    n = range(len(questions))
    return question_catalogue(
        spark.createDataFrame([(1, "api", active)], "group_h_id int, questiongroup_name string, is_active int"),
        spark.createDataFrame(
            [(1, f"q{i}", questions[i][0], i) for i in n],
            "group_h_id int, question_identifier string, question_api string, sequence int",
        ),
        spark.createDataFrame(
            [(f"Q{i} ", i, "TEXT", None, 0, 1) for i in n],
            """question_identifier string, label_id int, answer_type string, lov string,
            is_mandatory int, is_active int""",
        ),
        spark.createDataFrame(
            [(i, questions[i][1], None, None, None) for i in n],
            """label_id int, question_code string, response_date string, response_numeric string,
            max_length int""",
        ),
    )


def test_members_keep_order_kinds_and_repeats(spark):
    body = '{"b":"x","a":1,"c":1.5,"d":true,"e":null,"f":{"z":1},"g":[1,2],"b":"y","i":""}'
    found = requests.shred_requests(bodies(spark, body)).orderBy("element_id").collect()
    assert [(r.name, r.string_value, r.value_type) for r in found] == [
        ("b", "x", "string"),
        ("a", "1", "int"),
        ("c", "1.5", "real"),
        ("d", "true", "boolean"),
        ("e", "null", "null"),
        ("f", '{"z":1}', "object"),
        ("g", "[1,2]", "array"),
        ("b", "y", "string"),
        ("i", "", "string"),
    ]
    assert [r.element_id for r in found] == list(range(1, 10))


def test_repeated_name_inside_a_nested_value_does_not_lose_the_body(spark):
    found = requests.shred_requests(bodies(spark, '{"o":{"x":1,"x":2},"b":2}'))
    assert rows(found, "name", "value_type") == [("b", "int"), ("o", "object")]


def test_kinds_do_not_depend_on_a_repeated_name_elsewhere(spark):
    body = '{"o":{"x":1,"x":2},"t":"{not an object","r":1.5,"f":true,"n":null,"t":"again"}'
    found = requests.shred_requests(bodies(spark, body)).orderBy("element_id").collect()
    assert [(r.name, r.value_type) for r in found] == [
        ("o", "object"),
        ("t", "string"),
        ("r", "real"),
        ("f", "boolean"),
        ("n", "null"),
        ("t", "string"),
    ]


@pytest.mark.parametrize("body", ['{"a":1', "", None, "[1,2]", '"text"', '{"a":}'])
def test_unreadable_body_keeps_its_request(spark, body):
    frame = requests.with_members(bodies(spark, body))
    assert [(r.request_id, r.members, r.id_name) for r in frame.collect()] == [("0", None, None)]
    assert requests.shred_requests(bodies(spark, body)).count() == 0


def test_empty_object_has_no_members(spark):
    assert requests.with_members(bodies(spark, "{}")).first().members == []


def test_binding_ignores_case_drops_objects_and_unknown_names(spark):
    catalogue = catalogue_of(spark, ("idName", "ID_NAME"), ("who", "WHO"), ("where", "WHERE"))
    batch = bodies(
        spark,
        '{"IDNAME":"API ","WHO ":"me","other":"x","where":{"a":1}}',
        '{"idName":"nope","who":"me"}',
    )
    bound = requests.bind_questions(batch, catalogue)
    assert rows(bound, "request_id", "row_num", "question_code", "name", "string_value") == [
        ("0", 1, "ID_NAME", "idName", "API "),
        ("0", 2, "WHO", "who", "me"),
    ]
    frame = requests.bind(requests.with_members(batch), catalogue)
    assert mapping(frame, "request_id", "registered") == {"0": True, "1": False}


def test_two_questions_with_one_name_bind_twice(spark):
    catalogue = catalogue_of(spark, ("idName", "ID_NAME"), ("who", "A"), ("who", "B"))
    bound = requests.bind_questions(bodies(spark, '{"idName":"api","who":"me"}'), catalogue)
    assert [r[1:] for r in rows(bound, "row_num", "question_code", "string_value")] == [
        ("ID_NAME", "api"),
        ("A", "me"),
        ("B", "me"),
    ]


def test_greatest_value_of_a_code_wins(spark):
    catalogue = catalogue_of(spark, ("idName", "ID_NAME"), ("who", "WHO"), ("also", "who"))
    batch = bodies(
        spark,
        '{"idName":"api","who":"b","who":"c","who":"a"}',
        '{"idName":"api","who":"b","also":"d"}',
        '{"idName":"api","who":"same","who":"same"}',
        "broken",
    )
    wide = requests.pivot_params(
        requests.bind(requests.with_members(batch), catalogue), ("ID_NAME", "WHO", "NONE")
    )
    assert rows(wide) == [
        ("0", "api", "c", None),
        ("1", "api", "d", None),
        ("2", "api", "same", None),
        ("3", None, None, None),
    ]


def test_injected_answer_shares_the_last_row_number(spark):
    catalogue = catalogue_of(spark, ("idName", "ID_NAME"), ("who", "WHO"))
    frame = requests.bind(
        requests.with_members(bodies(spark, '{"idName":"api","who":"me"}')), catalogue
    )
    injected = requests.inject_param(frame, "extra", "EXTRA", F.lit("v"))
    assert rows(requests.bound_rows(injected), "row_num", "question_code")[-1] == (2, "WHO")
    assert (2, "EXTRA") in rows(requests.bound_rows(injected), "row_num", "question_code")
    assert injected.first().members[-1].name == "extra"


def test_filter_on_a_bound_column_gives_the_same_rows(spark):
    catalogue = catalogue_of(spark, ("idName", "ID_NAME"), ("who", "WHO"))
    batch = bodies(spark, '{"idName":"api","who":"b","who":"c"}', '{"idName":"api","who":"a"}')
    wide = requests.pivot_params(
        requests.bind(requests.with_members(batch), catalogue), ("WHO",)
    )
    assert rows(wide.filter("who = 'c'")) == [("0", "c")]


def test_routing_outcomes(spark):
    parameters = spark.createDataFrame(
        [("known", "handler"), ("no_group", "h2")], "parameter_id string, parameter_value string"
    )
    groups = spark.createDataFrame([("KNOWN",), ("no_parameter",)], "questiongroup_name string")
    batch = bodies(
        spark,
        '{"IdName":"Known","orderId":"7"}',
        '{"orderIdDealer":"8","orderId":"9"}',
        '{"idName":""}',
        '{"idName":"null"}',
        '{"idName":null}',
        '{"idName":"no_group"}',
        '{"idName":"no_parameter"}',
        None,
    )
    found = mapping(
        requests.route_requests(batch, parameters, groups),
        "request_id",
        "order_id",
        "handler",
        "response_code",
        "error",
    )
    required = (None, "30", "IDNAME is required")
    unknown = (None, "30", "IDNAME is not registered")
    assert found == {
        "0": ("7", "handler", None, None),
        "1": ("8", *required),
        "2": (None, *required),
        "3": (None, *required),
        "4": (None, *required),
        "5": (None, *unknown),
        "6": (None, *unknown),
        "7": (None, *required),
    }


def test_inactive_questions_are_left_out_only_on_demand(spark):
    questions = (("idName", "ID_NAME"),)
    assert catalogue_of(spark, *questions, active=0).count() == 1
    tables = (
        spark.createDataFrame([(1, "api", 0)], "group_h_id int, questiongroup_name string, is_active int"),
        spark.createDataFrame([(1, "q", "n", 1)], "group_h_id int, question_identifier string, question_api string, sequence int"),
        spark.createDataFrame([("q", 1, "EXPRESSION", "1", 1, 1)], "question_identifier string, label_id int, answer_type string, lov string, is_mandatory int, is_active int"),
        spark.createDataFrame([(1, "C", " ", "Y", 0)], "label_id int, question_code string, response_date string, response_numeric string, max_length int"),
    )
    assert question_catalogue(*tables, active_only=True).count() == 0
    assert rows(rule_catalogue(question_catalogue(*tables), "API")) == [
        ("api", "C", "n", True, False, True, 0, True, "1")
    ]
