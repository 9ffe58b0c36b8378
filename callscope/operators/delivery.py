"""Delivery attempts and ingest answers: verdicts, codes, refused events."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callscope import schemas as S
from callscope.functions.clients import response_code
from callscope.operators.ordered import keep_first

MAX_ATTEMPTS = 2


def with_response(attempts: DataFrame, body: str = "body") -> DataFrame:
    """Add `response`: the parsed answer, NULL when the body is no valid answer.

    `accepted` stays NULL when absent, which is not the same as zero.
    """
    df = attempts.withColumn("__parsed", F.from_json(body, S.RESPONSE_SCHEMA))
    valid = F.col("__parsed").isNotNull() & F.col("__parsed._corrupt_record").isNull()
    kept = F.struct(*[F.col(f"__parsed.{n}") for n in ("accepted", "rejected", "duplicate_count")])
    return df.withColumn("response", F.when(valid, kept)).drop("__parsed")


def batch_verdict(response: str = "response", event_count: str = "event_count") -> Column:
    """`rejected` when events were refused or nothing of a non-empty batch was taken.

    An unreadable answer or an absent count leaves rejections unobservable: accepted.
    """
    refused = F.size(F.coalesce(f"{response}.rejected", F.array().cast(S.REJECTION_SCHEMA))) > 0
    nothing = (F.col(f"{response}.accepted") == 0) & (F.col(event_count) > 0)
    return F.when(F.coalesce(refused | nothing, F.lit(False)), "rejected").otherwise("accepted")


def reasons(response: str = "response") -> Column:
    """Distinct non-empty reasons, sorted and joined by commas; empty without any."""
    named = F.filter(
        F.transform(f"{response}.rejected", lambda r: r["reason"]), lambda r: F.coalesce(r, F.lit("")) != ""
    )
    return F.coalesce(F.array_join(F.array_sort(F.array_distinct(named)), ", "), F.lit(""))


def rejection_message(response: str = "response") -> Column:
    count = F.greatest(F.size(F.coalesce(f"{response}.rejected", F.array().cast(S.REJECTION_SCHEMA))), F.lit(0))
    names = reasons(response)
    detail = F.when(names != "", F.concat(F.lit(" ("), names, F.lit(")"))).otherwise("")
    return F.concat(F.lit("ingest rejected "), count.cast("string"), F.lit(" event(s)"), detail)


def last_attempts(attempts: DataFrame) -> DataFrame:
    """The final attempt of each batch."""
    return keep_first(attempts, ["batch_id"], [F.col("attempt").desc()])


def classify_deliveries(attempts: DataFrame) -> DataFrame:
    """Outcome of each batch from its last attempt.

    2xx goes by the answer; 429 and 5xx, network failures and time-outs may be tried
    again; any other status is final.
    """
    df = with_response(last_attempts(attempts))
    status, failure = F.col("status"), F.col("failure")
    taken = F.coalesce(status.between(200, 299), F.lit(False))
    code = (
        F.when(failure == "cancelled", "ingest_cancelled")
        .when(failure == "timeout", "ingest_timeout")
        .when(failure == "network", "ingest_connection_failed")
        .when(taken, F.lit(None))
        .otherwise(response_code("body", "status"))
    )
    again = (
        F.when(failure.isNotNull(), failure != "cancelled")
        .otherwise(~taken & ((status == 429) | (status >= 500)))
    )
    verdict = F.when(failure.isNull() & taken, batch_verdict()).otherwise("failed")
    return df.select(
        "batch_id",
        F.col("attempt").alias("attempts"),
        "status",
        verdict.alias("verdict"),
        code.alias("code"),
        F.coalesce(again, F.lit(False)).alias("retryable"),
        F.when(verdict == "rejected", rejection_message()).alias("message"),
        "response",
    )


def rejected_by_ingest(deliveries: DataFrame, events: DataFrame | None = None) -> DataFrame:
    """One row per refusal; joined to its event when an event table is given.

    A refusal may come without an event id, and then stays without an event.
    """
    rows = deliveries.select(
        "batch_id", F.explode("response.rejected").alias("r")
    ).select("batch_id", F.col("r.event_id").alias("event_id"), F.col("r.reason").alias("reason"))
    if events is None:
        return rows
    known = events.select("event_id", "kind", "actor_id", "session_id_hint")
    # Refusals without an id match nothing; as one null key they would meet in one task.
    named = rows.filter(F.col("event_id").isNotNull()).join(known, "event_id", "left")
    return named.unionByName(rows.filter(F.col("event_id").isNull()), allowMissingColumns=True)


def reason_totals(deliveries: DataFrame) -> DataFrame:
    """Refused events and affected batches per reason."""
    rows = rejected_by_ingest(deliveries).filter(F.coalesce("reason", F.lit("")) != "")
    return rows.groupBy("reason").agg(
        F.count(F.lit(1)).alias("events"), F.countDistinct("batch_id").alias("batches")
    )
