"""Requests: shredding, binding to the question catalogue, widening and routing.

A request frame has one row per request. Its members and its bound answers are array columns of
that row, so everything from the JSON text to the wide row is row-local: no explode, no shuffle.
No lambda here reads an array column other than its own: a filter that Spark pushes down through
these projections then costs one more evaluation of the arrays, not one per element.
The long forms (`shred_requests`, `bound_rows`) are the same arrays, one row per element.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadloom.constants import LEAD_CODES, NAME_REQUIRED, NAME_UNREGISTERED, SYSTEM_ERROR
from leadloom.functions.joins import lookup
from leadloom.functions.members import add_members, first_text, keys_of, numbers_of
from leadloom.functions.text import is_blank, key, spread_key
from leadloom.operators.catalogue import answer_rules
from leadloom.session import materialise


def with_members(requests: DataFrame) -> DataFrame:
    """Add `members`, `id_name` and `order_id` to `request_id, …, body`.

    Every request keeps its row; one without a readable JSON object has NULL members.
    """
    keyed = add_members(requests).withColumn("member_keys", keys_of(F.col("members")))

    def first(name: str) -> Column:
        return first_text(F.col("members"), F.col("member_keys"), name)

    return keyed.withColumns(
        {"id_name": first("idName"), "order_id": F.coalesce(first("orderIdDealer"), first("orderId"))}
    ).drop("member_keys")


def shred_requests(requests: DataFrame) -> DataFrame:
    """One row per top-level member of every body."""
    return add_members(requests).select("request_id", F.inline("members"))


def bind(frame: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Add `registered` and the array `bound`: members matched to the questions of the API.

    Nested objects do not bind. `row_num` counts the answers of a request in member order.
    """
    # Written once, the rules have a size that Spark knows before it plans the join: it broadcasts
    # them below its limit and leaves the requests in place. Beyond it, the requests are shuffled,
    # and the hot key, as nearly all may name one API, is split.
    rules = lookup(materialise(answer_rules(catalogue), "rules"), "api_key")
    api = spread_key("id_name", "request_id")
    matched = frame.join(rules, api == F.col("api_key"), "left").drop("api_key")
    asked = F.filter(F.col("members"), lambda m: m["value_type"] != "object")
    found = F.transform(
        F.col("asked")["name"],
        lambda name: F.coalesce(F.try_element_at("questions", key(name)), F.array()),
    )
    # The text of a member once per question of its name.
    texts = F.flatten(
        F.zip_with(
            F.col("asked")["string_value"],
            "found",
            lambda text, questions: F.array_repeat(text, F.size(questions)),
        )
    )
    # Structs are put together from arrays: inside a lambda each would be built field by field.
    answers = F.col("answers")
    own = {"name": answers["question_api"], "string_value": F.col("texts")}
    fields = [own[n] if n in own else answers[n] for n in _ANSWER]
    bound = F.when(
        answers.isNotNull(),
        F.arrays_zip(
            numbers_of(answers).alias("row_num"), *[field.alias(n) for n, field in zip(_ANSWER, fields, strict=True)]
        ),
    )
    return (
        matched.withColumn("registered", F.col("questions").isNotNull())
        .withColumn("asked", asked)
        .withColumn("found", found)
        .withColumns({"answers": F.flatten("found"), "texts": texts})
        .withColumn("bound", bound)
        .drop("questions", "asked", "found", "answers", "texts")
    )


_ANSWER = (
    "question_code",
    "name",
    "string_value",
    "is_mandatory",
    "is_date",
    "is_numeric",
    "max_length",
)


def bind_questions(requests: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Bound answers, one row each: `request_id, row_num, question_code, name, string_value`."""
    return bound_rows(bind(with_members(requests), catalogue))


def bound_rows(frame: DataFrame) -> DataFrame:
    """The array `bound` as rows."""
    return frame.select("request_id", F.inline("bound")).select(
        "request_id", "row_num", "question_code", "name", "string_value"
    )


def with_params(frame: DataFrame) -> DataFrame:
    """Add `params`: question code -> greatest value bound to it in that request."""
    codes, values = F.col("codes"), F.col("bound")["string_value"]
    pairs = F.sort_array(F.arrays_zip(codes.alias("code"), values.alias("value")))
    # Pairs are sorted by code and value: the last pair of a code holds its greatest value.
    marked = F.zip_with(
        pairs,
        F.slice(pairs, 2, F.greatest(F.size(pairs), F.lit(0))),
        lambda pair, following: F.struct(
            pair["code"].alias("code"),
            pair["value"].alias("value"),
            (~following["code"].eqNullSafe(pair["code"])).alias("is_last"),
        ),
    )
    entries = F.transform(
        F.filter(marked, lambda m: m["is_last"]), lambda m: F.struct(m["code"], m["value"])
    )
    # Nearly always every code is bound once, and nothing need be sorted.
    once = F.size(F.array_distinct(codes)) == F.size(codes)
    return (
        frame.withColumn("codes", F.transform(F.col("bound")["question_code"], F.upper))
        .withColumn(
            "params",
            F.when(once, F.map_from_arrays(codes, values)).otherwise(F.map_from_entries(entries)),
        )
        .drop("codes")
    )


def pivot_params(frame: DataFrame, codes: tuple[str, ...] = LEAD_CODES) -> DataFrame:
    """One wide row per request: a column per question code, NULL where nothing is bound."""
    return with_params(frame).select("request_id", *[param(c).alias(c.lower()) for c in codes])


def param(code: str) -> Column:
    """Value of one question code of a request frame with `params`."""
    return F.try_element_at("params", F.lit(code.upper()))


def has_param(code: str) -> Column:
    """Whether the request has an answer, blank or not, to that question."""
    return F.coalesce(F.map_contains_key("params", F.lit(code.upper())), F.lit(False))


def echo_params(frame: DataFrame, fields: dict[str, str]) -> DataFrame:
    """The wide row under API field names; `fields` maps field name to question code."""
    return with_params(frame).select(
        "request_id", *[param(code).alias(name) for name, code in fields.items()]
    )


def inject_param(frame: DataFrame, name: str, code: str, value: Column) -> DataFrame:
    """Add one member and its answer to every bound request.

    The new answer shares the row number of the last one.
    """
    member = F.struct(
        (F.size("members") + 1).cast("int").alias("element_id"),
        F.lit(name).alias("name"),
        value.alias("string_value"),
        F.lit("string").alias("value_type"),
    )
    answer = F.struct(
        F.array_max(F.transform("bound", lambda b: b["row_num"])).alias("row_num"),
        F.lit(code).alias("question_code"),
        F.lit(name).alias("name"),
        value.alias("string_value"),
        F.lit(False).alias("is_mandatory"),
        F.lit(False).alias("is_date"),
        F.lit(False).alias("is_numeric"),
        F.lit(None).cast("int").alias("max_length"),
    )
    return frame.withColumns(
        {
            "members": F.concat("members", F.array(member)),
            "bound": F.concat("bound", F.array(answer)),
        }
    )


def route(frame: DataFrame, parameters: DataFrame, question_group_h: DataFrame) -> DataFrame:
    """Add `handler`, or `response_code` and `error` where the request cannot be routed."""
    handlers = (
        parameters.filter(F.col("parameter_id").isNotNull())
        .groupBy(key("parameter_id").alias("handler_key"))
        .agg(F.max("parameter_value").alias("parameter_value"), F.lit(True).alias("is_parameter"))
    )
    handlers = lookup(handlers, "handler_key")
    groups = question_group_h.select(
        key("questiongroup_name").alias("group_key"), F.lit(True).alias("is_group")
    ).distinct()
    groups = lookup(groups, "group_key")
    known = F.col("is_parameter") & F.col("is_group")
    error = F.when(is_blank("id_name"), NAME_REQUIRED).when(known.isNull(), NAME_UNREGISTERED)
    api = spread_key("id_name", "request_id")
    return (
        frame.join(handlers, api == F.col("handler_key"), "left")
        .join(groups, api == F.col("group_key"), "left")
        .withColumn("error", error)
        .withColumn("response_code", F.when(F.col("error").isNotNull(), SYSTEM_ERROR))
        .withColumn("handler", F.when(F.col("error").isNull(), F.col("parameter_value")))
        .drop("handler_key", "group_key", "is_parameter", "is_group", "parameter_value")
    )


def route_requests(
    requests: DataFrame, parameters: DataFrame, question_group_h: DataFrame
) -> DataFrame:
    """`request_id, id_name, order_id, handler, response_code, error` per request."""
    return route(with_members(requests), parameters, question_group_h).select(
        "request_id", "id_name", "order_id", "handler", "response_code", "error"
    )
