"""Test tables renamed into the engine's schema.

Each input is one SELECT that Spark and DuckDB read alike, over the given tables and over inputs
named before it; `{name}` stands for either. Spark runs it to feed an operator, and the oracle
SQL of the query starts from the same text, so both sides see the same rows. What the operators
compute is stated separately in `checks.oracles`.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leadloom.operators.store import conform
from leadloom.session import materialise

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

# Members of a lead body: API field name -> question code.
LEAD_API = {
    "idName": "ID_NAME",
    "orderIdDealer": "ORDER_ID",
    "dealerId": "PARTNER_ID",
    "idNo": "ID_NO",
    "fullName": "FULL_NAME",
    "birthPlace": "BIRTH_PLACE",
    "birthDate": "BIRTH_DT",
    "surveyAddr": "SURVEY_ADDR",
    "surveyRT": "SURVEY_RT",
    "surveyRW": "SURVEY_RW",
    "surveyProvince": "SURVEY_PROVINCE",
    "surveyCity": "SURVEY_CITY",
    "surveySubDistrict": "SURVEY_SUB_DISTRICT",
    "surveyVillage": "SURVEY_VILLAGE",
    "surveyZipcode": "SURVEY_CITY_ID",
    "legalAddr": "ADDR",
    "legalRt": "RT",
    "legalRw": "RW",
    "legalProvince": "PROVINCE",
    "legalCity": "CITY",
    "legalSubDistrict": "SUB_DISTRICT",
    "legalVilage": "VILLAGE",
    "legalZipcode": "CITY_ID",
    "mobilePhone": "PHONE_NUMBER",
    "motherName": "MOTHER_MAIDEN_NAME",
}
LEAD_MANDATORY = ("orderIdDealer", "dealerId", "fullName", "motherName")
LEAD_LENGTHS = {"surveyRT": 3, "surveyRW": 3, "legalRt": 3, "legalRw": 3}

# Members of a body about one customer.
CUSTOMER_API = {"idName": "ID_NAME", "custName": "NAME", "segment": "SEGMENT", "nation": "NATION"}

# Exported columns: API field name -> (question code, stored expression or None).
EXPORT_API = {
    "orderNo": ("ORDER_ID", None),
    "dealer": ("DEALER", "coalesce(part.name, 'unknown')"),
    "customer": ("FULL_NAME", None),
    "summary": ("SUMMARY", "concat(acq.order_id, '/', acq.po_no)"),
    "state": ("STATE", "case when acq.id_status = 10 then 'failed' else 'open' end"),
}

# Fields of an API whose masters are looked up as the catalogue says: member, code, stored lookup.
LOOKUP_API = {
    "province": (
        "PROVINCE",
        "SELECT name FROM districts WHERE name = @PROVINCE AND type = 'prv' AND is_active = '1'",
    ),
    "city": ("CITY", "select top 1 sub_zipcode from zipcodes where city = @city"),
    "village": (
        "SURVEY_VILLAGE",
        "SELECT zipcode FROM zipcodes WHERE is_active = '0' AND kelurahan = @SURVEY_VILLAGE "
        "AND kecamatan=@SURVEY_SUB_DISTRICT",
    ),
}


def _values(rows: list[tuple], names: str) -> str:
    def text(value: object) -> str:
        if value is None:
            return "NULL"
        return str(value) if isinstance(value, int) else "'" + value.replace("'", "''") + "'"

    body = ", ".join("(" + ", ".join(text(v) for v in row) + ")" for row in rows)
    return f"SELECT * FROM (VALUES {body}) AS t({names})"


def _catalogue() -> dict[str, str]:
    """The four catalogue tables of the APIs above."""
    groups = [(1, "lead_api", 1), (2, "cust_api", 1), (3, "export_api", 1), (4, "lookup_api", 1)]
    questions, lists, labels = [], [], []

    def ask(group: int, api_name: str, code: str, **rules: object) -> None:
        label_id = len(labels) + 1
        identifier = f"Q{label_id}"
        questions.append((group, identifier, api_name, label_id))
        lists.append(
            (
                identifier,
                label_id,
                "EXPRESSION" if rules.get("lov") else "TEXT",
                rules.get("lov"),
                int(bool(rules.get("mandatory"))),
                int(rules.get("active", 1)),
            )
        )
        labels.append(
            (
                label_id,
                code,
                "Y" if rules.get("date") else None,
                "Y" if rules.get("numeric") else None,
                rules.get("length"),
            )
        )

    for name, code in LEAD_API.items():
        ask(
            1,
            name,
            code,
            mandatory=name in LEAD_MANDATORY,
            date=name == "birthDate",
            numeric=name == "mobilePhone",
            length=LEAD_LENGTHS.get(name),
        )
    for name, code in CUSTOMER_API.items():
        ask(2, name, code)
    for name, (code, lov) in EXPORT_API.items():
        ask(3, name, code, lov=lov)
    ask(3, "hidden", "PO_NO", active=0)
    for name, (code, lov) in LOOKUP_API.items():
        ask(4, name, code, lov=lov)
    return {
        "question_group_h": _values(groups, "group_h_id, questiongroup_name, is_active"),
        "question_group_d": _values(
            questions, "group_h_id, question_identifier, question_api, sequence"
        ),
        "question_list": _values(
            lists, "question_identifier, label_id, answer_type, lov, is_mandatory, is_active"
        ),
        "question_label": _values(
            labels, "label_id, question_code, response_date, response_numeric, max_length"
        ),
    }


_MESSAGES = {
    "00": "Success",
    "02": "Parameter error",
    "03": "Duplicate orderIdDealer",
    "07": "Order is not registered",
    "08": "dealerId is not registered",
    "09": "[Param_IN] must be numeric",
    "10": "[Param_IN] must be [n] digits",
    "11": "[Param_IN] must be date format",
    "12": "[Param_IN] is mandatory",
    "13": "Invalid format idNo",
    "14": "surveyProvince does not exist in master",
    "15": "surveyCity does not exist in master",
    "16": "surveySubDistrict does not exist in master",
    "17": "surveyVillage does not exist in master",
    "18": "surveyZipcode does not exist in master",
    "19": "legalProvince does not exist in master",
    "20": "legalCity does not exist in master",
    "21": "legalSubDistrict does not exist in master",
    "22": "legalVilage does not exist in master",
    "23": "legalZipcode does not exist in master",
    "28": "User [username] exists",
    "30": "System error",
}

_STATUSES = (
    "Received",
    "Survey",
    "In progress",
    "Approved",
    "Rejected",
    "Cancelled by office",
    "Cancelled by survey",
    "Purchase order",
    "Disbursed",
    "Failed",
)


def _prefixed(column: str, fault: str) -> str:
    """Address text of a request: partners of kind 2 use their own vocabulary."""
    return (
        f"CASE WHEN {fault} THEN 'FAULT' "
        f"WHEN o.o_custkey % 3 = 2 THEN 'px-' || coalesce({column}, 'NONE') "
        f"ELSE coalesce({column}, 'NONE') END"
    )


INPUTS: dict[str, str] = {
    "response_codes": _values(list(_MESSAGES.items()), "response_code, response_message"),
    "status_master": _values(
        [(i, s) for i, s in enumerate(_STATUSES, start=1)], "id_status, status"
    ),
    **_catalogue(),
    # --- reports, inquiries and transitions ---
    "leads": """
        SELECT CAST(o_orderkey AS BIGINT) AS acq_id,
            CAST(o_orderkey AS STRING) AS order_id,
            CAST(o_custkey AS STRING) AS partner_id,
            CAST(o_orderkey AS STRING) AS transaction_id,
            'Applicant ' || CAST(o_custkey AS STRING) AS full_name,
            '08' || lpad(CAST(o_custkey AS STRING), 9, '0') AS phone_number,
            o_orderdate AS order_dt,
            CASE WHEN o_orderkey % 3 = 0 THEN '  ' || o_orderpriority || ' '
                ELSE o_orderpriority END AS product_type_desc,
            CAST(1 + o_orderkey % 10 AS INT) AS id_status,
            CAST(o_custkey % 30 AS STRING) AS office_code,
            CASE WHEN o_orderkey % 17 = 3 THEN 'Other' ELSE 'Main_Dealer' END AS source_data,
            'AG' || CAST(o_orderkey AS STRING) AS agrmnt_no,
            CAST(o_orderkey % 900 AS STRING) AS instalment_amt,
            CAST(o_custkey % 70 AS STRING) AS po_dp,
            CASE WHEN o_orderkey % 5 > 0 THEN 'PO' || CAST(o_orderkey AS STRING) END AS po_no,
            CASE WHEN o_orderkey % 5 > 0 THEN o_orderdate END AS po_date,
            CASE WHEN o_orderkey % 5 > 0 THEN '12' END AS po_tenor
        FROM {orders}""",
    "status_log": """
        SELECT CAST(o_orderkey AS STRING) AS order_id,
            CAST(o_orderkey AS STRING) AS transaction_id,
            CAST(o_custkey AS STRING) AS partner_id,
            CAST(l_linenumber AS INT) AS sequence,
            CAST(CASE WHEN l_partkey % 97 = 3 THEN 11 ELSE 1 + l_partkey % 10 END AS INT)
                AS id_status,
            CASE WHEN l_partkey % 89 <> 4 THEN l_shipdate END AS status_dt
        FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey""",
    "partners": """
        SELECT CAST(c_custkey AS STRING) AS id_partner, c_name AS name,
            CAST(c_custkey % 3 AS INT) AS flag_master, c_mktsegment AS flag_master_partner
        FROM {customer}""",
    "offices": """
        SELECT CAST(n_nationkey AS INT) AS ref_office_id,
            CAST(n_nationkey AS STRING) AS office_code
        FROM {nation}""",
    "inquiries": """
        SELECT 'I' || CAST(event_id AS STRING) AS request_id, event_type AS id_name,
            CASE WHEN event_id % 11 = 1 THEN NULL
                WHEN event_id % 5 = 0 THEN CAST(o_custkey AS STRING)
                ELSE CAST(user_id AS STRING) END AS partner_id,
            CASE WHEN event_id % 13 = 2 THEN NULL
                WHEN event_id % 7 = 3 THEN 'none'
                ELSE CAST(event_id AS STRING) END AS order_id
        FROM {events} LEFT JOIN {orders} ON o_orderkey = event_id""",
    "changes": """
        SELECT CAST(event_id AS BIGINT) AS change_seq,
            CASE WHEN event_id % 9 = 0 THEN 'T' ELSE '' END || CAST(event_id % 700 AS STRING)
                AS transaction_id,
            event_type AS id_name
        FROM {events}""",
    # --- lead intake ---
    "address": """
        SELECT s_suppkey AS v, s_name AS village,
            'SUB-' || CAST(s_suppkey % 10 AS STRING) AS sub_district,
            n_name AS city, lpad(CAST(s_suppkey AS STRING), 5, '0') AS zip,
            r_name AS province, s_nationkey AS district
        FROM {supplier} JOIN {nation} ON s_nationkey = n_nationkey
            JOIN {region} ON n_regionkey = r_regionkey""",
    "zipcodes": """
        SELECT 'Z' || lpad(CAST(v AS STRING), 9, '0') AS sub_zipcode,
            CAST(district AS INT) AS district_id, village AS kelurahan,
            sub_district AS kecamatan, city, zip AS zipcode,
            CASE WHEN v % 13 = 0 THEN '0' ELSE '1' END AS is_active
        FROM {address}
        UNION ALL
        SELECT 'Y' || lpad(CAST(v AS STRING), 9, '0'), CAST(district AS INT), village,
            sub_district, city, zip, CASE WHEN v % 4 = 0 THEN '1' ELSE '0' END
        FROM {address}""",
    "districts": """
        SELECT CAST(1000 + r_regionkey AS INT) AS district_id, CAST(NULL AS INT) AS parent_id,
            r_name AS name, 'PRV' AS type,
            CASE WHEN r_regionkey = 4 THEN '0' ELSE '1' END AS is_active
        FROM {region}
        UNION ALL
        SELECT CAST(n_nationkey AS INT), CAST(1000 + n_regionkey AS INT), n_name, 'DIS',
            CASE WHEN n_nationkey % 11 = 10 THEN '0' ELSE '1' END
        FROM {nation}""",
    "lead_partners": """
        SELECT 'P' || CAST(c_custkey AS STRING) AS id_partner, c_name AS name,
            CAST(c_custkey % 3 AS INT) AS flag_master,
            CASE WHEN c_mktsegment = 'MACHINERY' THEN 'Marketplace' ELSE 'Main_Dealer' END
                AS flag_master_partner
        FROM {customer}""",
    "stored_leads": """
        SELECT CAST(c_custkey AS BIGINT) AS acq_id,
            'a' || CAST(c_custkey % 40 AS STRING) AS order_id,
            'P' || CAST(c_custkey AS STRING) AS partner_id,
            'OLD' || CAST(c_custkey AS STRING) AS transaction_id
        FROM {customer}""",
    # The two addresses a customer uses in its requests.
    "customer_address": """
        SELECT c_custkey, province, city, sub_district, village, zip, 1 AS nth
        FROM {customer} JOIN {address} ON v = c_custkey % 120
        UNION ALL
        SELECT c_custkey, province, city, sub_district, village, zip, 2
        FROM {customer} JOIN {address} ON v = (c_custkey + 7) % 120""",
    "code_map": """
        SELECT DISTINCT 'P' || CAST(c_custkey AS STRING) AS partner_id, field_mapping,
            'px-' || value AS descr_partner, value || suffix AS descr_internal
        FROM (
            SELECT c_custkey, 'PROVINCE' AS field_mapping, province AS value, '' AS suffix
            FROM {customer_address}
            UNION ALL
            SELECT c_custkey, 'CITY', city, '' FROM {customer_address}
            UNION ALL
            SELECT c_custkey, 'SUB_DISTRICT', sub_district, '' FROM {customer_address}
            UNION ALL
            SELECT c_custkey, 'VILLAGE', village, '' FROM {customer_address}
            WHERE c_custkey % 17 <> 2
            UNION ALL
            SELECT c_custkey, 'ZIPCODE', zip, '' FROM {customer_address}
            UNION ALL
            SELECT c_custkey, 'PROVINCE', province, '-2' FROM {customer_address}
            WHERE nth = 1 AND c_custkey % 59 = 2
        ) AS m
        WHERE c_custkey % 3 = 2""",
    # One row per order: the 25 lead values with faults by order key, and the state of the body.
    "lead_source": f"""
        SELECT CAST(o.o_orderkey AS BIGINT) AS k,
            'R' || CAST(o.o_orderkey AS STRING) AS request_id,
            o.o_orderdate AS arrival_ts,
            CASE WHEN o.o_orderkey % 67 = 16 THEN 'empty'
                WHEN o.o_orderkey % 59 = 14 THEN 'malformed'
                WHEN o.o_orderkey % 53 = 13 THEN 'incomplete'
                ELSE 'complete' END AS body_state,
            CASE WHEN o.o_orderkey % 61 = 15 THEN 'other_api' ELSE 'lead_api' END AS id_name,
            'A' || CAST(o.o_orderkey % 40 AS STRING) AS order_id,
            CASE WHEN o.o_orderkey % 29 = 5 THEN 'X' ELSE 'P' END
                || CAST(o.o_custkey AS STRING) AS partner_id,
            CASE WHEN o.o_orderkey % 31 = 6 THEN '12A4'
                WHEN o.o_orderkey % 31 = 7 THEN ''
                ELSE lpad(CAST(o.o_custkey AS STRING), 16, '3') END AS id_no,
            CASE WHEN o.o_orderkey % 47 = 11 THEN '  '
                ELSE 'Name ' || CAST(o.o_custkey AS STRING) END AS full_name,
            c.c_mktsegment AS birth_place,
            CASE WHEN o.o_orderkey % 37 = 8 THEN '1990-02-30'
                ELSE CAST(CAST(o.o_orderdate AS DATE) AS STRING) END AS birth_dt,
            'Street ' || CAST(o.o_orderkey % 100 AS STRING) AS survey_addr,
            CASE WHEN o.o_orderkey % 43 = 10 THEN '0012' ELSE '001' END AS survey_rt,
            '002' AS survey_rw,
            {_prefixed('s.province', 'o.o_orderkey % 71 = 17')} AS survey_province,
            {_prefixed('s.city', 'o.o_orderkey % 73 = 18')} AS survey_city,
            {_prefixed('s.sub_district', 'o.o_orderkey % 79 = 19')} AS survey_sub_district,
            {_prefixed('s.village', 'o.o_orderkey % 83 = 20')} AS survey_village,
            {_prefixed('s.zip', 'o.o_orderkey % 89 = 21')} AS survey_city_id,
            'Lane ' || CAST(o.o_custkey % 100 AS STRING) AS addr,
            '003' AS rt,
            '004' AS rw,
            {_prefixed('l.province', 'o.o_orderkey % 97 = 22')} AS province,
            {_prefixed('l.city', 'o.o_orderkey % 101 = 23')} AS city,
            {_prefixed('l.sub_district', 'o.o_orderkey % 103 = 24')} AS sub_district,
            {_prefixed('l.village', 'o.o_orderkey % 107 = 25')} AS village,
            {_prefixed('l.zip', 'o.o_orderkey % 109 = 26')} AS city_id,
            CASE WHEN o.o_orderkey % 41 = 9 THEN '08x' ELSE '0812' END AS phone_number,
            CASE WHEN o.o_orderkey % 47 = 12 THEN NULL ELSE 'Mother' END
                AS mother_maiden_name
        FROM {{orders}} o JOIN {{customer}} c ON c.c_custkey = o.o_custkey
            LEFT JOIN {{address}} s ON s.v = o.o_custkey % 120
            LEFT JOIN {{address}} l ON l.v = (o.o_custkey + 7) % 120""",
    # --- a large catalogue, parameters and users ---
    "part_group_h": """
        SELECT DISTINCT CAST(g AS INT) AS group_h_id,
            'api_' || CAST(g AS STRING) AS questiongroup_name,
            CAST(CASE WHEN g % 7 = 0 THEN 0 ELSE 1 END AS INT) AS is_active
        FROM (SELECT p_partkey - p_partkey % 20 AS g FROM {part}) AS p""",
    "part_group_d": """
        SELECT CAST(p_partkey - p_partkey % 20 AS INT) AS group_h_id,
            'Q' || CAST(p_partkey AS STRING) AS question_identifier,
            'field' || CAST(p_partkey % 20 AS STRING) AS question_api,
            CAST(20 - p_partkey % 20 AS INT) AS sequence
        FROM {part}""",
    "part_list": """
        SELECT 'Q' || CAST(p_partkey AS STRING) AS question_identifier,
            CAST(p_partkey AS INT) AS label_id,
            CASE WHEN p_type = 'ECONOMY' THEN 'EXPRESSION' ELSE 'TEXT' END AS answer_type,
            CASE WHEN p_type = 'ECONOMY' THEN 'upper(' || p_brand || ')' END AS lov,
            CAST(CASE WHEN p_size % 2 = 0 THEN 1 ELSE 0 END AS INT) AS is_mandatory,
            CAST(CASE WHEN p_partkey % 13 = 0 THEN 0 ELSE 1 END AS INT) AS is_active
        FROM {part}""",
    "part_label": """
        SELECT CAST(p_partkey AS INT) AS label_id,
            'CODE' || CAST(p_partkey % 20 AS STRING) AS question_code,
            CASE WHEN p_type = 'SMALL' THEN 'Y' WHEN p_type = 'LARGE' THEN ' ' END
                AS response_date,
            CASE WHEN p_type = 'MEDIUM' THEN 'Y' END AS response_numeric,
            CAST(CASE WHEN p_size > 25 THEN p_size END AS INT) AS max_length
        FROM {part}""",
    "file_parameters": """
        SELECT CASE c_custkey WHEN 3 THEN 'SFTP_PASSWORD_HOST_MARKETPLACE'
                WHEN 5 THEN 'sftp_user_host_marketplace'
                WHEN 7 THEN 'SFTP_PORT_HOST_MARKETPLACE'
                WHEN 9 THEN 'SFTP_HOST_MARKETPLACE '
                WHEN 11 THEN 'PATH_LOG_ERROR_MARKETPLACE'
                ELSE c_name END AS parameter_name,
            c_mktsegment || CAST(c_custkey AS STRING) AS parameter_value
        FROM {customer}""",
    "users": """
        SELECT 'USER' || CAST(c_custkey AS STRING) AS username, c_name AS password,
            0 AS is_staff, 0 AS is_superuser
        FROM {customer}""",
    "new_users": """
        SELECT 'U' || CAST(o_orderkey AS STRING) AS request_id,
            CAST(o_orderkey AS BIGINT) AS arrival_seq,
            CASE WHEN o_orderkey % 50 = 0 THEN NULL
                ELSE 'user' || CAST(o_orderkey - o_orderkey % 3 AS STRING) END AS username,
            o_orderstatus AS password,
            CAST(o_orderkey % 2 AS INT) AS is_staff, 0 AS is_superuser
        FROM {orders}""",
}

_PLACE = re.compile(r"\{(\w+)\}")


# Tables that a deployment has at rest: derived and written once per application.
STORED = (
    "address",
    "zipcodes",
    "districts",
    "lead_partners",
    "code_map",
    "stored_leads",
    "leads",
    "status_log",
)
_written: dict[tuple[str, str, str], DataFrame] = {}


def stored(spark: SparkSession, sf_dir: str, name: str, make: Callable[[], DataFrame]) -> DataFrame:
    """What `make` returns, written as a table the first time it is asked for."""
    place = (spark.sparkContext.applicationId, sf_dir, name)
    if place not in _written:
        _written[place] = materialise(make(), name)
    return _written[place]


def frame(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input as a DataFrame."""
    if name in TABLES:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")

    def derived() -> DataFrame:
        needed = sorted(set(_PLACE.findall(INPUTS[name])))
        return spark.sql(INPUTS[name], **{n: frame(spark, sf_dir, n) for n in needed})

    return stored(spark, sf_dir, name, derived) if name in STORED else derived()


def table(spark: SparkSession, sf_dir: str, name: str, as_table: str | None = None) -> DataFrame:
    """One input with all columns of the engine table it stands for."""
    return conform(frame(spark, sf_dir, name), as_table or name)


def sql_inputs(*names: str) -> str:
    """The same inputs as a WITH clause, without the word WITH."""
    parts: dict[str, str] = {}

    def add(name: str) -> None:
        if name in TABLES or name in parts:
            return
        text = INPUTS[name]
        for needed in sorted(set(_PLACE.findall(text))):
            add(needed)
        parts[name] = _PLACE.sub(r"\1", text)

    for name in names:
        add(name)
    return ", ".join(f"{name} AS ({text})" for name, text in parts.items())


def catalogue(spark: SparkSession, sf_dir: str, active_only: bool = False) -> DataFrame:
    """Catalogue of the three APIs."""
    from leadloom.operators.catalogue import question_catalogue

    return question_catalogue(
        *[
            table(spark, sf_dir, n)
            for n in ("question_group_h", "question_group_d", "question_list", "question_label")
        ],
        active_only=active_only,
    )


def part_catalogue(spark: SparkSession, sf_dir: str, active_only: bool = False) -> DataFrame:
    """A catalogue that grows with `part`: 20 questions per API."""
    from leadloom.operators.catalogue import question_catalogue

    names = {
        "part_group_h": "question_group_h",
        "part_group_d": "question_group_d",
        "part_list": "question_list",
        "part_label": "question_label",
    }
    return question_catalogue(
        *[table(spark, sf_dir, n, t) for n, t in names.items()], active_only=active_only
    )


def lead_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lead batch: one JSON body per order."""

    def bodies() -> DataFrame:
        # The small test file is one task; spread it as a real batch would be, while its rows are
        # narrow: the bodies of the lead source take many times the bytes of an order.
        tasks = spark.sparkContext.defaultParallelism
        orders = frame(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
        source = spark.sql(
            INPUTS["lead_source"],
            orders=orders.repartition(tasks, "o_orderkey"),
            customer=frame(spark, sf_dir, "customer"),
            address=frame(spark, sf_dir, "address"),
        )
        return source.select(
            "request_id",
            F.col("k").alias("arrival_seq"),
            "arrival_ts",
            F.when(F.col("body_state") == "complete", _body(LEAD_API))
            .when(F.col("body_state") == "incomplete", _body(LEAD_API, without="legalRw"))
            .when(F.col("body_state") == "malformed", F.concat(F.lit('{"idName":'), "order_id"))
            .alias("body"),
        )

    return stored(spark, sf_dir, "lead_bodies", bodies)


def customer_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bodies about customers: a NULL, a nested object, an unknown and a repeated member."""
    customer = frame(spark, sf_dir, "customer")
    known = F.to_json(
        F.struct(
            F.lit("cust_api").alias("idName"),
            F.col("c_name").alias("CUSTNAME"),
            F.when(F.col("c_custkey") % 5 > 0, F.col("c_mktsegment")).alias("segment"),
            F.col("c_nationkey").alias("nation"),
            F.struct(F.col("c_custkey").alias("nation")).alias("custName"),
            F.lit(True).alias("unknown"),
        ),
        {"ignoreNullFields": "false"},
    )
    repeated = F.concat(F.rtrim(known, F.lit("}")), F.lit(',"custName":"A repeated"}'))
    return customer.select(
        F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("request_id"),
        F.col("c_custkey").cast("long").alias("arrival_seq"),
        F.lit("2024-01-01").cast("timestamp").alias("arrival_ts"),
        F.when(F.col("c_custkey") % 4 == 0, repeated).otherwise(known).alias("body"),
    )


def event_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bodies from events: the API name is the event type, blank in one of seven."""
    events = frame(spark, sf_dir, "events")
    return events.select(
        F.concat(F.lit("E"), F.col("event_id").cast("string")).alias("request_id"),
        F.col("event_id").cast("long").alias("arrival_seq"),
        F.col("ts").cast("timestamp").alias("arrival_ts"),
        F.to_json(
            F.struct(
                F.when(F.col("event_id") % 7 > 0, F.col("event_type")).otherwise("").alias("idName"),
                F.col("user_id").cast("string").alias("orderIdDealer"),
            )
        ).alias("body"),
    )


def _body(api: dict[str, str], without: str | None = None) -> Column:
    return F.to_json(
        F.struct(*[F.col(code.lower()).alias(n) for n, code in api.items() if n != without]),
        {"ignoreNullFields": "false"},
    )

