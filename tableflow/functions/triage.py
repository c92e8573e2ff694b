"""Classing logged failures: what went wrong, and whether a retry may help."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tableflow.columns import col
from tableflow.functions.redact import redacted

# The reasons and codes a service uses for conditions that may pass.
TRANSIENT_REASONS = ("rateLimitExceeded", "backendError", "internalError", "jobBackendError", "jobInternalError")
THROTTLE_STATUSES = (429, 503)
TRANSIENT_RPC = (
    "Unavailable",
    "ResourceExhausted",
    "DeadlineExceeded",
    "Aborted",
    "Internal",
    "Unknown",
    "FailedPrecondition",
)

# The advice added to two of the classes.
_ADVICE = {
    "permission_denied": " -- check the grants of the caller",
    "unauthenticated": " -- check the credentials of the caller",
    "table_is_view": " -- a view is read as a query: select * from <view>",
}


def triage_errors(
    df: DataFrame,
    status: str = "status",
    reason: str = "reason",
    message: str = "message",
    context: str = "context",
    secrets: Iterable[str] = (),
) -> DataFrame:
    """Adds ``error_class``, ``transient``, ``throttled`` and ``error_text`` to a failure log.

    A job error has no status: NULL or 0. The first rule that matches decides.
    """
    code = F.coalesce(col(status).cast("int"), F.lit(0))
    why = col(reason)
    rules = [
        (_is(why, "quotaExceeded"), "quota_exceeded"),
        (_is(why, *TRANSIENT_REASONS), "transient_service"),
        (_is(why, "accessDenied") | (code == 403), "permission_denied"),
        (_is(why, "notFound") | (code == 404), "not_found"),
        (code == 401, "unauthenticated"),
        (_is(why, "invalid", "invalidQuery") | (code == 400), "invalid_query"),
        ((code == 429) | code.between(500, 599), "transient_service"),
    ]
    described = _described(code, why, col(message))
    kind = F.col("error_class")
    detail = F.when(kind == "invalid_query", F.coalesce(col(message), described)).otherwise(described)
    return df.withColumn("error_class", _first_match(rules, "other")).withColumns(
        {
            "transient": kind == "transient_service",
            "throttled": code.isin(*THROTTLE_STATUSES) | _is(why, "rateLimitExceeded"),
            "error_text": _text(col(context), F.concat(detail, _advice(kind)), secrets),
        }
    )


def triage_rpc(
    df: DataFrame,
    code: str = "code",
    detail: str = "detail",
    context: str = "context",
    secrets: Iterable[str] = (),
) -> DataFrame:
    """The same four columns for a log of RPC status codes. A NULL detail is an empty one."""
    name, said = col(code), F.coalesce(col(detail), F.lit(""))
    rules = [
        ((name == "InvalidArgument") & F.contains(F.lower(said), F.lit("view")), "table_is_view"),
        (name == "InvalidArgument", "invalid_query"),
        (name == "NotFound", "not_found"),
        (name == "PermissionDenied", "permission_denied"),
        (name == "Unauthenticated", "unauthenticated"),
        (name.isin(*TRANSIENT_RPC), "transient_rpc"),
    ]
    kind = F.col("error_class")
    coded = F.concat(F.coalesce(name, F.lit("")), F.lit(": "), said)
    body = F.when(kind.isin("transient_rpc", "other"), coded).otherwise(F.concat(said, _advice(kind)))
    return df.withColumn("error_class", _first_match(rules, "other")).withColumns(
        {
            "transient": kind == "transient_rpc",
            "throttled": _is(name, "ResourceExhausted"),
            "error_text": _text(col(context), body, secrets),
        }
    )


def count_by_class(triaged: DataFrame) -> DataFrame:
    """Failures, and how many were throttles, per class."""
    return triaged.groupBy("error_class", "transient").agg(
        F.count(F.lit(1)).alias("failures"), F.count_if("throttled").alias("throttles")
    )


def _is(value: Column, *names: str) -> Column:
    return F.coalesce(value.isin(*names), F.lit(False))


def _first_match(rules: list[tuple[Column, str]], default: str) -> Column:
    condition, name = rules[0]
    chain = F.when(condition, F.lit(name))
    for condition, name in rules[1:]:
        chain = chain.when(condition, F.lit(name))
    return chain.otherwise(F.lit(default))


def _described(code: Column, reason: Column, message: Column) -> Column:
    head = F.when(code > 0, F.concat(F.lit("HTTP "), code.cast("string"))).otherwise(F.lit("job error"))
    why = F.coalesce(F.concat(F.lit(" ("), reason, F.lit(")")), F.lit(""))
    said = F.coalesce(F.concat(F.lit(": "), message), F.lit(""))
    return F.concat(head, why, said)


def _advice(kind: Column) -> Column:
    return _lookup(kind, _ADVICE)


def _lookup(value: Column, table: dict[str, str]) -> Column:
    return _first_match([(value == key, text) for key, text in table.items()], "")


def _text(context: Column, body: Column, secrets: Iterable[str]) -> Column:
    return redacted(F.concat(F.coalesce(context, F.lit("")), F.lit(": "), body), secrets)
