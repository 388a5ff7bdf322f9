"""Inquiry, history, transitions, reports, exports, users, replies."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from leadloom.operators import export, replies, reports, status, users
from leadloom.operators.store import conform
from leadloom.plans.admin import add_users_from_bodies
from leadloom.plans.inquiry import inquire
from tests.conftest import mapping, rows
from tests.test_requests import bodies, catalogue_of

AS_OF = datetime(2024, 6, 1)


def day(n):
    return datetime(2024, 1, n)


@pytest.fixture(scope="module")
def leads(spark):
    data = [
        # acq, order, partner, transaction, order date, product, status, office, source, name, po
        (1, "A", "P1", "T1", day(1), " Car ", 2, "X", "Main_Dealer", "One", "PO1"),
        (2, "B", "P1", "T2", datetime(2024, 1, 2, 23), "Car", 10, "none", "Main_Dealer", "Two", None),
        (3, "A", "P2", "T3", day(3), "Bike", 99, None, "Main_Dealer", "Three", None),
        (4, "C", "P9", "T4", day(4), "Car", 1, "X", "Main_Dealer", "Four", None),
        (5, "D", "P1", "T5", None, "Car", 1, "X", "Main_Dealer", "Five", None),
        (6, "E", "P1", "T6", day(5), "Car", 1, "X", "Other", "Six", None),
        (7, "F", "P1", "T7", day(5), "Car", 1, "X", "main_dealer", "Seven", None),
    ]
    df = spark.createDataFrame(
        data,
        """acq_id long, order_id string, partner_id string, transaction_id string,
        order_dt timestamp, product_type_desc string, id_status int, office_code string,
        source_data string, full_name string, po_no string""",
    )
    return conform(df.withColumn("phone_number", F.lit("0" * 40)), "leads")


@pytest.fixture(scope="module")
def history(spark):
    data = [
        ("A", "T1", "P1", 1, 1, day(1)),
        ("A", "T1", "P1", 2, 2, day(2)),
        ("a ", "t1", "p1", 3, 3, day(2)),
        ("A", "T1", "P1", 4, 4, None),
        ("B", "T2", "P1", 1, 11, day(3)),
        ("A", "T3", "P2", 5, 5, day(1)),
        ("C", "T4", "P9", 1, 6, day(1)),
        ("D", "T5", "P1", 1, 7, day(1)),
        ("E", "T6", "P1", 1, 8, day(1)),
        (None, "T7", "P1", 1, 9, day(1)),
    ]
    df = spark.createDataFrame(
        data,
        """order_id string, transaction_id string, partner_id string, sequence int,
        id_status int, status_dt timestamp""",
    )
    return conform(df, "status_log")


@pytest.fixture(scope="module")
def partners(spark):
    return spark.createDataFrame(
        [("P1", "First", 1, "Main_Dealer"), ("P2", "Second", 2, "Main_Dealer"), ("P3", "T", 0, "x")],
        "id_partner string, name string, flag_master int, flag_master_partner string",
    )


@pytest.fixture(scope="module")
def statuses(spark):
    return spark.createDataFrame([(i, f"s{i}") for i in range(1, 11)], "id_status int, status string")


@pytest.fixture(scope="module")
def offices(spark):
    return spark.createDataFrame([(5, "x")], "ref_office_id int, office_code string")


def test_latest_status_keeps_ties_and_drops_unknown(history):
    found = rows(status.latest_status(history), "transaction_id", "sequence")
    assert found == [("T1", 2), ("T2", 1), ("T3", 5), ("T4", 1), ("T5", 1), ("T6", 1), ("t1", 3)]


def whole(**changes):
    return reports.ReportFilter(
        **{"start": datetime(2000, 1, 1), "end": datetime(2030, 1, 1), **changes}
    )


def test_detail_report(leads, partners, history, statuses, offices):
    def detail(**changes):
        out = reports.detail_report(leads, partners, history, statuses, offices, whole(**changes))
        return [(r.order_id, r.id_agent, r.id_status, r.ref_office_id) for r in out.collect()]

    everything = [("A", "P1", 2, 5), ("A", "P1", 3, 5), ("A", "P2", 5, 0)]
    assert detail() == everything  # ties twice; unknown status 11 and partner P9 left out
    assert detail(branch=5) == everything[:2]
    assert detail(partner="p2") == everything[2:]
    assert detail(product="car") == everything[:2]
    assert detail(status=2) == everything[:2]  # status of the lead, not of the history
    assert detail(status=3) == []
    assert detail(start=datetime(2024, 1, 1, 8)) == everything[2:]  # excludes that whole day
    assert detail(start=day(1), end=day(1)) == everything[:2]


def test_recap_counts_unknown_partners(leads, history, statuses, offices):
    found = reports.status_recap(leads, history, statuses, offices, whole()).first().asDict()
    assert found == {
        "received": 0,
        "survey": 1,
        "approveProgress": 1,
        "approved": 0,
        "reject": 1,
        "cancelWise": 1,
        "cancelMss": 0,
        "po": 0,
        "cair": 0,
        "failed": 0,
    }
    end_day = reports.status_recap(leads, history, statuses, offices, whole(end=day(1)))
    assert end_day.first().survey == 1 and end_day.first().reject == 0


def test_inquiry(spark, leads, partners, statuses, codes):
    asked = spark.createDataFrame(
        [
            ("ok", "api", "p1", "a "),
            ("no status", "api", "P2", "A"),
            ("unknown", "api", "P1", "none"),
            ("of another", "api", "P2", "B"),
            ("kind", "api", "P3", "A"),
            ("lead without partner", "api", "P9", "C"),
            ("no order", "api", "P1", None),
            ("no partner", "api", None, "A"),
        ],
        "request_id string, id_name string, partner_id string, order_id string",
    )
    result = status.status_inquiry(asked, leads, partners, statuses, codes)
    assert mapping(result, "request_id", "response_code", "status", "dealer_name", "full_name") == {
        "ok": ("00", "s2", "First", "One"),
        "no status": ("00", None, "Second", "Three"),
        "unknown": ("07", None, None, None),
        "of another": ("07", None, None, None),
        "kind": ("08", None, None, None),
        "lead without partner": ("08", "s1", None, "Four"),
        "no order": ("07", None, None, None),
        "no partner": ("08", None, None, None),
    }
    answered = mapping(status.inquiry_response(result), "request_id", "fullName", "dealerId", "reply")
    assert answered["ok"][:2] == ("One", "p1")
    assert answered["lead without partner"][:2] == ("", "P9")
    assert '"poDate":""' in answered["ok"][2] and '"orderId":"T1"' in answered["ok"][2]
    logged = rows(
        status.log_inquiries(result, AS_OF).filter("partner_id = 'p1'"), "data_inquiry", "message"
    )
    # Details are logged whole; a width cuts each of them.
    phone = "0" * 40
    assert logged == [(f"P1,a ,{phone},s2,,PO1,,,", "Success")]
    cut = status.log_inquiries(result, AS_OF, width=30).filter("partner_id = 'p1'")
    assert rows(cut, "data_inquiry") == [(f"P1,a ,{phone[:30]},s2,,PO1,,,",)]
    strict = status.log_inquiries(result, AS_OF, strict_nulls=True)
    assert {r.data_inquiry for r in strict.collect()} == {None}


def test_transition(spark, leads, history):
    changes = spark.createDataFrame(
        [(1, "t1", "u1"), (2, "T1", "u2"), (3, "T7", "u3"), (4, "none", "u4"), (5, None, "u5")],
        "change_seq long, transaction_id string, id_name string",
    )
    new, appended = status.status_transition(leads, history, changes, AS_OF)
    assert new.columns == leads.columns and new.count() == leads.count()
    assert mapping(new, "transaction_id", "id_status") == {
        "T1": 10, "T2": 10, "T3": 99, "T4": 1, "T5": 1, "T6": 1, "T7": 10
    }
    assert mapping(appended, "usr_crt", "order_id", "partner_id", "sequence", "id_status") == {
        "u1": ("A", "P1", 5, 10),
        "u2": ("A", "P1", 6, 10),
        "u3": ("F", "P1", 2, 10),
    }
    kept = status.status_transition(leads, history, changes, AS_OF, keep_unmatched=True)[1]
    assert mapping(kept, "usr_crt", "order_id", "sequence")["u4"] == (None, None)
    assert kept.count() == 5


def test_export(spark, leads, partners):
    from leadloom.operators.catalogue import question_catalogue

    def catalogue(*items):
        n = range(len(items))
        return question_catalogue(
            spark.createDataFrame([(1, "out", 1)], "group_h_id int, questiongroup_name string, is_active int"),
            spark.createDataFrame(
                [(1, f"q{i}", items[i][0], items[i][3]) for i in n],
                "group_h_id int, question_identifier string, question_api string, sequence int",
            ),
            spark.createDataFrame(
                [(f"q{i}", i, "EXPRESSION" if items[i][2] else "T", items[i][2], 0, items[i][4]) for i in n],
                "question_identifier string, label_id int, answer_type string, lov string, is_mandatory int, is_active int",
            ),
            spark.createDataFrame(
                [(i, items[i][1], None, None, None) for i in n],
                "label_id int, question_code string, response_date string, response_numeric string, max_length int",
            ),
            active_only=True,
        )

    good = catalogue(
        ("second", "C2", "coalesce(PART.name, 'none; --')", 2, 1),
        ("first", "ORDER_ID", None, 1, 1),
        ("hidden", "PO_NO", None, 3, 0),
    )
    one = spark.createDataFrame([("t1",), ("T4",), ("T4",)], "transaction_id string")
    out = export.export_projection(leads, partners, good, "OUT", one)
    assert out.columns == ["first", "second"]
    assert rows(out) == [("A", "First"), ("C", "none; --")]
    assert export.export_projection(leads, partners, good, "out").count() == leads.count()
    assert export.export_column_list(good).first().column_list == (
        "ORDER_ID AS [first], coalesce(PART.name, 'none; --') AS [second]"
    )
    for text in ("java_method('x')", "order_id; drop", "password", "(select 1)", "order_id -- x"):
        with pytest.raises(ValueError, match="not allowed"):
            export.export_projection(leads, partners, catalogue(("a", "B", text, 1, 1)), "out")


def test_config_row(spark):
    parameters = spark.createDataFrame(
        [("sftp_host_marketplace ", "h"), ("other", "x")],
        "parameter_name string, parameter_value string",
    )
    found = export.config_row(parameters).first()
    assert found.sftpHost == "h" and found.sftpPort is None and len(found) == 6


def test_add_users(spark, codes):
    existing = spark.createDataFrame([("Ann",), (None,)], "username string")
    new = spark.createDataFrame(
        [
            ("1", 1, "ann ", "p", 0, 0),
            ("2", 3, "bob", "late", 0, 0),
            ("3", 2, "BOB", "first", 1, 0),
            ("4", 4, "cid", "p", 0, 1),
            ("5", 5, None, "p", 0, 0),
            ("6", 6, None, "q", 0, 0),
        ],
        """request_id string, arrival_seq long, username string, password string, is_staff int,
        is_superuser int""",
    )
    inserted, answered = users.add_users(new, existing, codes, AS_OF)
    codes_30 = codes.where("rtrim(response_code) = '30'").first()["response_message"]
    assert rows(inserted, "username", "password") == [
        ("BOB", "first"), ("cid", "p")
    ]
    assert mapping(answered, "request_id", "response_code", "response_message") == {
        "1": ("28", "User ann  exists"),
        "2": ("28", "User bob exists"),
        "3": ("00", "Success"),
        "4": ("00", "Success"),
        "5": ("30", codes_30),
        "6": ("30", codes_30),
    }


def test_user_bodies(spark, codes):
    catalogue = catalogue_of(
        spark,
        ("addUsername", "ADD_USERNAME"),
        ("addIsStaff", "IS_STAFF"),
        ("addIsSuperUsesr", "IS_SUPERUSER"),
    )
    batch = bodies(
        spark,
        '{"addUsername":"new","addPassword":"x","addIsStaff":1,"addIsSuperUsesr":0}',
        '{"addUsername":"old","addIsStaff":0}',
    )
    existing = spark.createDataFrame([("old",)], "username string")
    result = add_users_from_bodies(
        batch, catalogue, existing, codes, AS_OF, "api", F.lit("encrypted")
    )
    assert rows(result.users, "username", "password", "is_staff", "is_superuser") == [
        ("new", "encrypted", 1, 0)
    ]
    assert rows(result.replies, "reply") == [
        ('{"responseCode":"00","responseMessage":"Success"}',),
        ('{"responseCode":"28","responseMessage":"User old exists"}',),
    ]
    assert rows(result.response_log, "id_name", "response_code") == [("api", "00"), ("api", "28")]


def test_unreadable_inquiries(spark, leads, partners, statuses, codes):
    catalogue = catalogue_of(spark, ("partnerId", "PARTNER_ID"), ("orderId", "ORDER_ID"))
    batch = bodies(spark, "{bad", None, '{"idName":"nobody knows it"}')
    result = inquire(batch, catalogue, leads, partners, statuses, codes, AS_OF)
    assert rows(result.response_log, "response_code") == [("02",), ("30",), ("30",)]


def test_unreadable_user_bodies_add_nobody(spark, codes):
    catalogue = catalogue_of(spark, ("addUsername", "ADD_USERNAME"))
    existing = spark.createDataFrame([("old",)], "username string")
    batch = bodies(spark, "{bad", None, "{}", '{"addUsername":"new"}')
    result = add_users_from_bodies(batch, catalogue, existing, codes, AS_OF, "api")
    assert rows(result.users, "username") == [("new",)]
    assert rows(result.response_log, "response_code") == [("00",), ("30",), ("30",), ("30",)]


def test_job_run(spark):
    found = replies.job_run(spark, "job", day(1), day(2))
    assert rows(found, "proc_name", "err_message") == [("job", "END"), ("job", "START")]
