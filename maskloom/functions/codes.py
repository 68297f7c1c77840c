"""Status and error codes as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from maskloom import schemas as C

# HTTP status to error code; the rest follows from the class of the status.
CODES = {
    400: "invalid_request", 401: "unauthorized", 402: "quota_exceeded", 403: "forbidden",
    404: "not_found", 409: "conflict", 413: "payload_too_large", 422: "invalid_request",
    429: "rate_limited",
}
# Routes on which some statuses are settled, so asking again never helps.
SETTLED = {"correspondence": [404, 409, 422], "text": [404, 409]}

# Reasons the server gives for a failed upload.
UPLOAD_REASONS = [
    "upload was not completed", "verify uploaded file size", "exceeds the maximum allowed size",
]


def error_code(status: Column) -> Column:
    result = F.when(status >= 500, "internal_error").otherwise("error")
    for value, code in CODES.items():
        result = F.when(status == value, code).otherwise(result)
    return result


def classify_status(status: Column, retry_after: Column, body: Column) -> Column:
    """``struct(code, retryable, retry_after_seconds, detail, request_id)`` of a failed response."""
    parsed = F.from_json(body, C.ERROR_BODY)
    waits = (status == 429) | (status >= 500)
    # Leading whole number, as headers may carry more; negative or wordy values do not count.
    seconds = F.regexp_extract(F.coalesce(retry_after, F.lit("")), r"^\s*\+?([0-9]+)", 1).try_cast("bigint")
    detail = F.coalesce(
        F.nullif(parsed["error"], F.lit("")), F.nullif(F.left(body, F.lit(300)), F.lit("")), F.lit("Unknown error")
    )
    return F.struct(
        error_code(status).alias("code"), waits.alias("retryable"),
        F.when(waits, seconds).alias("retry_after_seconds"),
        detail.alias("detail"), parsed["request_id"].alias("request_id"),
    )


def classify_route_status(route: Column, status: Column) -> Column:
    """``struct(code, retryable, settled)``: the table and text routes override the common rule."""
    settled = F.lit(False)
    for name, statuses in SETTLED.items():
        settled = settled | ((route == name) & status.isin(*statuses))
    retryable = ((status == 429) | (status >= 500)) & ~settled
    return F.struct(error_code(status).alias("code"), retryable.alias("retryable"), settled.alias("settled"))


def resume_plan(job_id: Column, document_id: Column) -> Column:
    """How to go on after a failure that already cost pages; NULL where no job exists yet."""
    has_document = F.coalesce(document_id, F.lit("")) != ""
    return F.when(
        F.coalesce(job_id, F.lit("")) != "",
        F.struct(
            F.when(has_document, "download_redacted").otherwise("get_job_status").alias("tool"),
            F.when(~has_document, job_id).alias("job_id"),
            F.when(has_document, document_id).alias("document_id"),
            F.lit(True).alias("do_not_re_upload"),
        ),
    )


def is_terminal_status(status: Column) -> Column:
    return status.isin(*C.TERMINAL)


def is_terminal(job_status: Column, documents: Column) -> Column:
    """A job is settled when all its documents are; without documents its own status decides."""
    # Of no array the size is NULL or -1, depending on the session.
    none = F.coalesce(F.size(documents), F.lit(0)) <= 0
    return F.when(none, is_terminal_status(job_status)).otherwise(
        F.forall(documents, lambda d: is_terminal_status(d["status"]))
    )


def needs_recommit(status: Column, error_message: Column) -> Column:
    """Failed at the upload, by the server's own words; an unfinished upload is not (it may be running)."""
    reason = F.lower(F.coalesce(error_message, F.lit("")))
    named = F.lit(False)
    for text in UPLOAD_REASONS:
        named = named | reason.contains(text)
    return (status == "error") & named
