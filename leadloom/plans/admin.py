"""User administration requests: from JSON bodies to new users, replies and logs."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadloom.constants import SUCCESS
from leadloom.operators import replies, requests, users
from leadloom.session import materialise


@dataclass(frozen=True)
class UserAdmin:
    """Results of one batch; `users` and the log hold the rows to append."""

    users: DataFrame
    replies: DataFrame
    response_log: DataFrame


def add_users_from_bodies(
    batch: DataFrame,
    catalogue: DataFrame,
    existing: DataFrame,
    response_codes: DataFrame,
    as_of: datetime,
    id_name: str,
    password: Column | None = None,
) -> UserAdmin:
    """Add the users asked for; bodies carry no API name, so `id_name` is injected.

    `password` is the encrypted password that replaces the one of the body.
    """
    named = requests.with_members(batch).withColumn("id_name", F.lit(id_name))
    bound = requests.inject_param(
        requests.bind(named, catalogue), "idName", "ID_NAME", F.lit(id_name)
    )
    wide = requests.with_params(bound)
    password = requests.param("PASSWORD") if password is None else password
    asked = materialise(
        wide.select(
            "request_id",
            "arrival_seq",
            "id_name",
            requests.param("ADD_USERNAME").alias("username"),
            password.alias("password"),
            requests.param("IS_STAFF").try_cast("int").alias("is_staff"),
            requests.param("IS_SUPERUSER").try_cast("int").alias("is_superuser"),
        ),
        "users",
    )
    inserted, answered = users.add_users(asked, existing, response_codes, as_of)
    answered = replies.response_envelope(
        answered.select(
            "request_id",
            F.lit(id_name).alias("id_name"),
            F.col("response_code").alias("responseCode"),
            F.col("response_message").alias("responseMessage"),
        ),
        ["responseCode", "responseMessage"],
    )
    logged = answered.withColumns(
        {
            "response_code": F.col("responseCode"),
            "response_message": F.col("responseMessage"),
            "is_success": F.col("responseCode") == SUCCESS,
        }
    )
    return UserAdmin(inserted, answered, replies.log_responses(logged, as_of))
