"""Checks on finished tables; each gives one row per finding or a small verdict row."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callscope.functions.clients import client_family
from callscope.functions.text import may_hold_secret, secret_hits


def session_isolation(sessions: DataFrame, group: list[str]) -> DataFrame:
    """Per group: as many session keys as sessions, and one shared actor."""
    return sessions.groupBy(*group).agg(
        F.count(F.lit(1)).alias("sessions"),
        F.countDistinct("session_key").alias("session_keys"),
        F.countDistinct("actor_id").alias("actors"),
    ).withColumn("isolated", (F.col("sessions") == F.col("session_keys")) & (F.col("actors") == 1))


def foreign_markers(calls: DataFrame, marker: str, owner: str) -> DataFrame:
    """Calls whose text holds a marker (pattern group 1 of `marker`) of another session.

    Markers are taken out of the text and compared by key, so no pair of sessions is
    ever formed. `owner` is the pattern that takes the session's own marker from its key.
    """
    found = F.explode(F.array_distinct(F.regexp_extract_all("input", F.lit(marker), 1)))
    own = F.regexp_extract("session_key", owner, 1)
    return calls.select("server_id", "session_key", "call_id", found.alias("marker")).filter(
        F.col("marker") != own
    )


def unhealthy_sessions(sessions: DataFrame) -> DataFrame:
    """Sessions without calls or with failed ones."""
    return sessions.filter((F.col("event_count") == 0) | (F.col("error_count") > 0))


def family_counts(sessions: DataFrame, aliases: dict[str, str] | None = None) -> DataFrame:
    """Sessions per client family."""
    family = client_family("client_name", aliases).alias("family")
    return sessions.groupBy(family).agg(F.count(F.lit(1)).alias("sessions"))


def family_mismatches(
    sessions: DataFrame, expected: dict[str, int], aliases: dict[str, str] | None = None
) -> DataFrame:
    """Families whose number of sessions is not the expected one."""
    counts = family_counts(sessions, aliases)
    wanted = sessions.sparkSession.createDataFrame(list(expected.items()), "family string, expected bigint")
    both = counts.join(wanted, "family", "full").na.fill(0, ["sessions", "expected"])
    return both.filter(F.col("sessions") != F.col("expected"))


EXPORTED_TEXTS = ["error", "script_source", "result_preview", "metadata.input_preview",
                  "metadata.user_intent", "metadata.agent_thinking"]


def leaked_secrets(events: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Secret rules that still match in exported columns; empty for a clean table.

    All columns are searched in one pass over the table: texts without any literal of a rule
    are left out before the patterns run. Labels are taken out first: a label in the place
    of a password is no password.
    """
    names = columns or EXPORTED_TEXTS
    texts = F.array(*[F.struct(F.lit(n).alias("column"), F.regexp_replace(n, "\\[redacted:[a-z-]+\\]", "\n!").alias("bare")) for n in names])
    rows = events.select("event_id", F.explode(F.filter(texts, lambda t: t["bare"].isNotNull())).alias("t")).select("event_id", "t.column", "t.bare")
    held = rows.filter(may_hold_secret("bare"))
    hits = held.select("event_id", "column", F.explode(secret_hits("bare")).alias("label", "hits"))
    return hits.filter("hits > 0")


def table_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows in one table only, with the side they are on; for stream against batch."""
    columns = sorted(left.columns)
    a, b = left.select(columns), right.select(columns)
    only_left = a.exceptAll(b).withColumn("side", F.lit("left"))
    return only_left.unionByName(b.exceptAll(a).withColumn("side", F.lit("right")))
