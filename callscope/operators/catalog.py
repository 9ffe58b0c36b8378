"""Tool catalogs: telemetry contract of each tool, ownership, served against expected."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callscope.functions.telemetry import FIELDS
from callscope.operators.ordered import keep_first

# The description hints of all generations, newest first.
HINTS = [
    "On every call, pass telemetry.agent_thinking with your reasoning for this specific call. "
    "Pass telemetry.user_intent only on the first tool call after a new user message.",
    "Pass telemetry.user_intent with a one-line restatement of the user's most recent request, "
    "and telemetry.agent_thinking with your reasoning for making this specific call.",
    "Pass telemetry.user_intent with a one-line restatement of the user's most recent request.",
    "Pass telemetry.intent with a one-line user intent for analytics.",
]

TOOL = ["server_id", "tool_name"]


def has_hint(description: str = "description") -> Column:
    text = F.coalesce(F.col(description), F.lit(""))
    found = F.lit(False)
    for hint in HINTS:
        found = found | text.contains(hint)
    return found


def contract_status(schema: str = "input_schema") -> Column:
    """`decorated`: carries the injected telemetry object. `owned`: declares another
    top-level telemetry input. `unextendable`: no JSON object. `undecorated`: the rest."""
    text = F.col(schema)
    is_object = F.coalesce(F.schema_of_variant(F.try_parse_json(text)).startswith("OBJECT"), F.lit(False))
    declared = F.coalesce(
        F.array_contains(F.json_object_keys(F.get_json_object(text, "$.properties")), "telemetry"),
        F.lit(False),
    )
    members = F.json_object_keys(F.get_json_object(text, "$.properties.telemetry.properties"))
    injected = F.coalesce(
        F.size(F.array_except(F.array(*[F.lit(n) for n in FIELDS]), members)) == 0, F.lit(False)
    ) & members.isNotNull()
    return (
        F.when(~is_object, "unextendable")
        .when(declared & injected, "decorated")
        .when(declared, "owned")
        .otherwise("undecorated")
    )


def audit_catalog(catalog: DataFrame) -> DataFrame:
    """Contract status and hint of every catalog row."""
    return catalog.withColumns({"status": contract_status(), "has_hint": has_hint()})


def latest_registrations(catalog: DataFrame) -> DataFrame:
    """The registration in force of each tool: the last one wins, an unreadable schema
    changes nothing about ownership."""
    newest = [F.col("registered_at").desc(), F.col("input_schema").desc()]
    return keep_first(catalog, TOOL, newest)


def owned_tools(catalog: DataFrame) -> DataFrame:
    """(server_id, tool_name) of tools that own their telemetry field now."""
    decisive = audit_catalog(catalog).filter(F.col("status") != "unextendable")
    return latest_registrations(decisive).filter(F.col("status") == "owned").select(*TOOL)


def ownership_history(catalog: DataFrame, seq: str | None = None) -> DataFrame:
    """(server_id, tool_name, registered_at, registered_seq, owned): each registration that decides.

    An unreadable schema changes nothing about ownership. `seq` is a column that orders
    registrations among the rows of a log at the same instant; without one, and among equal
    ones, the larger schema text counts, as in `latest_registrations`.
    """
    number = F.lit(None).cast("long") if seq is None else F.col(seq).cast("long")
    decisive = audit_catalog(catalog).filter(F.col("status") != "unextendable")
    at = [F.col("server_id"), F.col("tool_name"), F.col("registered_at"), number.alias("registered_seq")]
    return decisive.groupBy(*at).agg(F.max_by(F.col("status") == "owned", "input_schema").alias("owned"))


def catalog_coverage(catalog: DataFrame) -> DataFrame:
    """Share of tools in force that carry the telemetry contract, per server."""
    carries = (F.col("status") == "decorated") & F.col("has_hint")
    return audit_catalog(latest_registrations(catalog)).groupBy("server_id").agg(
        F.count(F.lit(1)).alias("tools"),
        F.count_if(carries).alias("covered"),
        F.avg(carries.cast("double")).alias("coverage"),
    )


def catalog_diff(served: DataFrame, expected: DataFrame) -> DataFrame:
    """Tools that are `missing` from or `unexpected` in the served catalog."""
    have, want = served.select(*TOOL).distinct(), expected.select(*TOOL).distinct()
    missing = want.exceptAll(have).withColumn("difference", F.lit("missing"))
    return missing.unionByName(have.exceptAll(want).withColumn("difference", F.lit("unexpected")))
