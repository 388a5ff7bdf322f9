"""User administration."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadloom.constants import SUCCESS, SYSTEM_ERROR, USER_EXISTS
from leadloom.functions.joins import lookup
from leadloom.functions.text import fill, flag, key, spread_key
from leadloom.operators.rules import message_templates
from leadloom.operators.store import conform


def add_users(
    new: DataFrame, users: DataFrame, response_codes: DataFrame, as_of: datetime
) -> tuple[DataFrame, DataFrame]:
    """`(users to append, replies)` for `request_id, arrival_seq, username, password, …`.

    A request without a name (also one of an unreadable body) is a system error and adds nothing. A
    name that exists, or that an earlier request of the batch adds, is refused. The earliest
    request per name is aggregated, so many requests for one name meet in no single task.
    """
    wanted = new.select(key("username").alias("user_key")).dropna().distinct()
    existing = (
        users.select(key("username").alias("user_key"))
        .join(wanted, "user_key", "left_semi")
        .distinct()
        .withColumn("exists", F.lit(True))
    )
    first = (
        new.select(key("username").alias("user_key"), "arrival_seq")
        .dropna()
        .groupBy("user_key")
        .agg(F.min("arrival_seq").alias("first_seq"))
        .join(existing, "user_key", "left")
    )
    refused = flag(F.col("exists") | (F.col("arrival_seq") > F.col("first_seq")))
    judged = (
        new.withColumn("user_key", spread_key("username", "request_id"))
        .join(lookup(first, "user_key"), "user_key", "left")
        .withColumn(
            "response_code",
            F.when(F.col("username").isNull(), SYSTEM_ERROR)
            .when(refused, USER_EXISTS)
            .otherwise(SUCCESS),
        )
        .drop("user_key", "exists", "first_seq")
    )
    inserted = conform(
        judged.filter(F.col("response_code") == SUCCESS).withColumn(
            "date_joined", F.lit(as_of).cast("timestamp")
        ),
        "users",
    )
    replies = judged.join(message_templates(response_codes), "response_code", "left").select(
        "request_id",
        "username",
        "response_code",
        fill(F.col("template"), username=F.col("username")).alias("response_message"),
    )
    return inserted, replies
