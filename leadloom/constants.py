"""Codes, field names and defaults that results depend on."""

# --- fixed values -----------------------------------------------------------

# Question codes of one lead request, in storage order.
LEAD_CODES = (
    "ORDER_ID",
    "PARTNER_ID",
    "ID_NO",
    "FULL_NAME",
    "BIRTH_PLACE",
    "BIRTH_DT",
    "SURVEY_ADDR",
    "SURVEY_RT",
    "SURVEY_RW",
    "SURVEY_PROVINCE",
    "SURVEY_CITY",
    "SURVEY_SUB_DISTRICT",
    "SURVEY_VILLAGE",
    "SURVEY_CITY_ID",
    "ADDR",
    "RT",
    "RW",
    "PROVINCE",
    "CITY",
    "SUB_DISTRICT",
    "VILLAGE",
    "CITY_ID",
    "PHONE_NUMBER",
    "MOTHER_MAIDEN_NAME",
    "ID_NAME",
)

# The ten address fields and the field name each has in the code map.
ADDRESS_MAPPING = {
    "survey_province": "PROVINCE",
    "survey_city": "CITY",
    "survey_sub_district": "SUB_DISTRICT",
    "survey_village": "VILLAGE",
    "survey_city_id": "ZIPCODE",
    "province": "PROVINCE",
    "city": "CITY",
    "sub_district": "SUB_DISTRICT",
    "village": "VILLAGE",
    "city_id": "ZIPCODE",
}

# Response codes.
SUCCESS = "00"
PARAMETER_ERROR = "02"
DUPLICATE_ORDER = "03"
UNKNOWN_ORDER = "07"
UNKNOWN_PARTNER = "08"
NOT_NUMERIC = "09"
TOO_LONG = "10"
NOT_A_DATE = "11"
MANDATORY = "12"
BAD_ID_NUMBER = "13"
USER_EXISTS = "28"
SYSTEM_ERROR = "30"

# Code given when an address field is not in the masters, in test order.
MASTER_CODES = {
    "survey_province": "14",
    "survey_city": "15",
    "survey_sub_district": "16",
    "survey_village": "17",
    "survey_city_id": "18",
    "province": "19",
    "city": "20",
    "sub_district": "21",
    "village": "22",
    "city_id": "23",
}

# Values stamped on every stored lead.
SOURCE_DATA = "Main_Dealer"
PARTNER_KIND = "Main_Dealer"
SOURCE_OF_APPLICATION = "Walk In Dealer"
PRODUCT_TYPE = "Multiguna Barang Motor Konvensional"
MESSAGE_TYPE = "Api Feedback Main Dealer"
TRANSACTION_FORMAT = "MD%07d"
SYSTEM_USER = "System"

# Lead status ids.
STATUS_RECEIVED = 1
STATUS_FAILED = 10

# Recap columns by status id.
RECAP_COLUMNS = {
    1: "received",
    2: "survey",
    3: "approveProgress",
    4: "approved",
    5: "reject",
    6: "cancelWise",
    7: "cancelMss",
    8: "po",
    9: "cair",
    10: "failed",
}

# Parameter names read by the transfer configuration, with their output names.
TRANSFER_CONFIG = {
    "SFTP_PASSWORD_HOST_MARKETPLACE": "sftpPassword",
    "SFTP_USER_HOST_MARKETPLACE": "sftpUsername",
    "SFTP_PORT_HOST_MARKETPLACE": "sftpPort",
    "SFTP_HOST_MARKETPLACE": "sftpHost",
    "PATH_LOG_ERROR_MARKETPLACE": "sftpPathLogError",
    "PATH_LOG_TEMP_FILE_MARKETPLACE": "sftpPathLogTempError",
}

# Detail texts of replies.
NAME_REQUIRED = "IDNAME is required"
NAME_UNREGISTERED = "IDNAME is not registered"
LEAD_NAME_UNREGISTERED = "idName is not registered"
EMPTY_BODY = "Parameter cannot be empty"
PARAMETER_ERROR_PREFIX = "Param Error - "

# --- end of fixed values ----------------------------------------------------

LEAD_COLUMNS = tuple(code.lower() for code in LEAD_CODES)
ADDRESS_COLUMNS = tuple(ADDRESS_MAPPING)

# Accepted date notations; override where partners use others.
DATE_FORMATS = ("yyyy-MM-dd", "yyyyMMdd", "MM/dd/yyyy")
