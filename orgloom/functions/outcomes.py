"""What came of a fetch, and what kind of failure a reason tells, as ordered conditions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: States after which a request may be made again.
TRANSIENT_STATES = [429, 500, 502, 503, 504]
#: Bytes below which a page is taken to hold nothing.
THIN_PAGE = 500


def fetch_problem(status: Column, content_type: Column, html: Column, thin: int = THIN_PAGE) -> Column:
    """Why an answer can't be used, null if it can: an error state, another type than HTML, or too few UTF-8 bytes."""
    body = F.coalesce(html, F.lit(""))
    return (
        F.when(status >= 400, F.concat(F.lit("status "), status.cast("string")))
        .when(~F.coalesce(F.lower(content_type), F.lit("")).contains("html"), F.concat(F.lit("not html: "), F.coalesce(content_type, F.lit(""))))
        .when(F.octet_length(body) < thin, F.concat(F.lit("content too short: "), F.length(body).cast("string"), F.lit(" bytes")))
    )


def failure_kind(reason: Column) -> Column:
    """``blocked``, ``retryable``, ``thin`` or ``permanent``; the first condition that holds decides, and without a reason it is permanent."""
    low = F.lower(F.coalesce(reason, F.lit("")))
    state = F.regexp_extract(low, r"status (\d+)", 1).try_cast("int")
    return (
        F.when(low.contains("robots") | low.contains("url_guard"), "blocked")
        .when(state == 403, "blocked")
        .when(state.isin(TRANSIENT_STATES), "retryable")
        .when(state.isNotNull(), "permanent")
        .when(low.rlike(r"error|timeout|timed out|connection|dns") & ~low.startswith("blocked"), "retryable")
        .when(low.startswith("blocked"), "blocked")
        .when(low.contains("too short"), "thin")
        .otherwise("permanent")
    )


def may_retry(reason: Column) -> Column:
    return failure_kind(reason) == "retryable"
