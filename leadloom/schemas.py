"""Explicit schemas of every engine table (nothing is inferred)."""

from functools import cache

from pyspark.sql.types import StructType

_AUDIT = "dtm_crt timestamp, usr_crt string, dtm_upd timestamp, usr_upd string"

# Columns shared by `leads` and `lead_requests`, in storage order.
_LEAD = """
    acq_id long, order_id string, partner_id string, id_no string, full_name string,
    birth_place string, birth_dt string, survey_addr string, survey_rt string,
    survey_rw string, survey_province string, survey_city string,
    survey_sub_district string, survey_village string, survey_city_id string,
    addr string, rt string, rw string, province string, city string,
    sub_district string, village string, city_id string, phone_number string,
    mother_maiden_name string, product_type_desc string, soa string,
    survey_sub_zip_code string, source_data string, transaction_id string,
    id_status int, dtm_crt timestamp, usr_crt string, order_dt timestamp,
    legal_sub_zip_code string
"""

_DDL = {
    "requests": "request_id string, arrival_seq long, arrival_ts timestamp, body string",
    "leads": _LEAD
    + """, agrmnt_no string, instalment_amt string, po_dp string, po_no string,
         po_date timestamp, po_tenor string, office_code string""",
    "lead_requests": _LEAD + ", response_code string, message string, dtm_response timestamp",
    "status_log": f"""order_id string, transaction_id string, partner_id string, sequence int,
        id_status int, status_dt timestamp, {_AUDIT}""",
    "inquiry_log": f"""order_id string, partner_id string, response_code string, message string,
        data_inquiry string, dtm_response timestamp, {_AUDIT}""",
    "api_request_log": """id_name string, order_id string, parameter string, request_dt timestamp,
        response_id string, dtm_crt timestamp, usr_crt string""",
    "api_response_log": """id_name string, order_id string, transaction_id string,
        response_code string, response_message string, error_desc string, response_dt timestamp,
        response_id string, dtm_crt timestamp, usr_crt string, parameter string""",
    "job_log": """proc_name string, date_processed timestamp, err_message string, err_line int,
        err_number int""",
    "users": """username string, password string, is_staff int, is_superuser int,
        date_joined timestamp""",
    "response_codes": "response_code string, response_message string",
    "partners": "id_partner string, name string, flag_master int, flag_master_partner string",
    "status_master": "id_status int, status string",
    "code_map": """partner_id string, field_mapping string, descr_partner string,
        descr_internal string""",
    "question_group_h": "group_h_id int, questiongroup_name string, is_active int",
    "question_group_d": """group_h_id int, question_identifier string, question_api string,
        sequence int""",
    "question_list": """question_identifier string, label_id int, answer_type string, lov string,
        is_mandatory int, is_active int""",
    "question_label": """label_id int, question_code string, response_date string,
        response_numeric string, max_length int""",
    "parameters": "parameter_id string, parameter_value string",
    "file_parameters": "parameter_name string, parameter_value string",
    "zipcodes": """sub_zipcode string, district_id int, kelurahan string, kecamatan string,
        city string, zipcode string, is_active string""",
    "districts": "district_id int, parent_id int, name string, type string, is_active string",
    "offices": "ref_office_id int, office_code string",
}

TABLES = tuple(_DDL)


@cache
def schema(table: str) -> StructType:
    """Schema of one engine table."""
    return StructType.fromDDL(_DDL[table])


def columns(table: str) -> list[str]:
    """Column names of one engine table, in storage order."""
    return schema(table).fieldNames()
