"""Hash ids, request scoping, time stamps, stateless session ids, header values."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from callscope.functions.text import blank_to_null, col, trim_space

ANONYMOUS_ACTOR = "anonymous"
UNKNOWN_CLIENT = "unknown"
SLUG_CHARS = 48

# Fixed patterns. \z, not $: the latter also accepts a final line break.
WORKFLOW_UUID = (
    "\\A[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[1-8][0-9a-fA-F]{3}-[89abAB][0-9a-fA-F]{3}-[0-9a-fA-F]{12}\\z"
)
SEED_UUID = "\\A[0-9a-f]{8}-[0-9a-f]{4}-[1-5][0-9a-f]{3}-[89ab][0-9a-f]{3}-[0-9a-f]{12}\\z"
SESSION_ID = (
    "\\Amcp_([A-Za-z0-9.-]+)_v_([A-Za-z0-9.-]*)_"
    "([0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12})\\z"
)


def actor_id(seed) -> Column:
    return F.sha2(F.coalesce(blank_to_null(seed), F.lit(ANONYMOUS_ACTOR)), 256)


def event_id(actor, kind, request) -> Column:
    kind = F.lit(kind) if isinstance(kind, str) else kind
    return F.sha2(F.concat(col(actor), F.lit(" "), kind, F.lit(" "), col(request)), 256)


def scoped_request_id(session, request, minted) -> Column:
    """`session#request`; the bare request without a session; `minted` without either."""
    session, request = blank_to_null(session), blank_to_null(request)
    return F.coalesce(F.concat(session, F.lit("#"), request), request, col(minted))


def init_request_id(actor, session) -> Column:
    session = F.coalesce(col(session), F.lit(""))
    return F.concat(col(actor), F.lit(":session_init:"), session)


def rfc3339(ts) -> Column:
    """UTC stamp with the trailing zeros of the fraction dropped.

    Written for a session time zone of UTC, which the entry points check.
    """
    text = F.date_format(col(ts), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return F.concat(F.regexp_replace(text, "\\.?0+\\z", ""), F.lit("Z"))


def parse_rfc3339(text) -> Column:
    return F.to_timestamp(col(text))


def duration_ms(started, finished) -> Column:
    """Whole milliseconds, truncated toward zero; negative when clocks disagree."""
    micros = F.unix_micros(col(finished)) - F.unix_micros(col(started))
    return F.call_function("div", micros, F.lit(1000))


def slug(value, fallback: str) -> Column:
    """Name or version as it appears inside a session id."""
    text = trim_space(F.coalesce(col(value), F.lit("")))
    text = F.regexp_replace(text, "\\A[^A-Za-z0-9.-]+", "")
    text = F.regexp_replace(text, "-?[^A-Za-z0-9.-]+", "-")
    text = F.regexp_replace(F.substring(text, 1, SLUG_CHARS), "\\A-+|-+\\z", "")
    return F.coalesce(blank_to_null(text), F.lit(fallback))


def mint_uuid(*source, random: bool = False) -> Column:
    """A version 4 UUID: random, or a stable one hashed from `source` columns.

    The stable form is the default because random values change when a lost task
    is run again.
    """
    if random:
        return F.uuid()
    digest = F.sha2(F.concat_ws("\u0001", *[col(c).cast("string") for c in source]), 256)
    variant = F.translate(
        F.substring(digest, 17, 1), "0123456789abcdef", "89ab89ab89ab89ab"
    )
    return F.concat(
        F.substring(digest, 1, 8), F.lit("-"), F.substring(digest, 9, 4), F.lit("-4"),
        F.substring(digest, 14, 3), F.lit("-"), variant, F.substring(digest, 18, 3),
        F.lit("-"), F.substring(digest, 21, 12),
    )


def session_id(name, version, seed, minted) -> Column:
    """`mcp_<name>_v_<version>_<uuid>`; an invalid seed gives way to `minted`."""
    wanted = F.lower(trim_space(F.coalesce(col(seed), F.lit(""))))
    unique = F.when(wanted.rlike(SEED_UUID), wanted).otherwise(col(minted))
    return F.concat(
        F.lit("mcp_"), slug(name, UNKNOWN_CLIENT), F.lit("_v_"), slug(version, ""), F.lit("_"), unique
    )


def client_from_session_id(session) -> Column:
    """Client struct carried by a stateless session id; NULL for any other id."""
    text = F.coalesce(col(session), F.lit(""))
    name = F.regexp_extract(text, SESSION_ID, 1)
    client = F.struct(
        name.alias("name"),
        F.regexp_extract(text, SESSION_ID, 2).alias("version"),
        F.lit(None).cast("string").alias("protocol_version"),
        F.lit(None).cast("string").alias("capabilities"),
    )
    return F.when(text.rlike(SESSION_ID) & (name != UNKNOWN_CLIENT), client)


def header(headers, name: str) -> Column:
    """First value of a header, its name compared without case; NULL if absent."""
    found = F.filter(F.map_entries(col(headers)), lambda e: F.lower(e["key"]) == name.lower())
    return F.try_element_at(found, F.lit(1))["value"]


def workflow_run_id(headers, name: str) -> Column:
    value = trim_space(header(headers, name))
    return F.when(value.rlike(WORKFLOW_UUID), value)


def actor_identifier(identifier) -> Column:
    """The identifier verbatim; NULL when empty."""
    return blank_to_null(identifier)
