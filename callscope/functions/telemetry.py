"""Telemetry the agent sends with a call: extraction, precedence, capture policy.

Written as SQL text: each step binds the value it looks at by name, so the steps
stack without repeating each other.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

from callscope.functions.text import sql_clean_text, sql_let, sql_text

FIELDS = ["user_intent", "agent_thinking", "user_frustration"]
LEGACY = {"user_intent": "intent", "agent_thinking": "context", "user_frustration": "frustration_level"}
FRUSTRATION_LEVELS = ["low", "medium", "high"]

_LEVELS = ", ".join(f"'{level}'" for level in FRUSTRATION_LEVELS)


def _struct(values: dict[str, str]) -> str:
    return "struct(" + ", ".join(f"{values[name]} AS {name}" for name in FIELDS) + ")"


NONE = _struct(dict.fromkeys(FIELDS, "CAST(NULL AS STRING)"))


def _type_is(value: str, kind: str) -> str:
    return f"coalesce(startswith(schema_of_variant({value}), '{kind}'), false)"


def _string_member(block: str, name: str) -> str:
    """Member of an object variant, only where it is a JSON string."""
    path = sql_text(f"$.{name}")
    is_string = _type_is(f"try_variant_get({block}, {path}, 'variant')", "STRING")
    return f"CASE WHEN {is_string} THEN try_variant_get({block}, {path}, 'string') END"


def _level(value: str) -> str:
    return f"CASE WHEN {value} IN ({_LEVELS}) THEN {value} END"


def _extract(block: str) -> str:
    """Normalized struct of an object variant; blank values are NULL.

    A current key that is present hides its older spelling even when blank. The
    frustration level is the exception: an invalid value gives way to a valid
    older one.
    """
    values = {
        n: f"nullif(coalesce({_string_member(block, n)}, {_string_member(block, LEGACY[n])}), '')"
        for n in FIELDS[:2]
    }
    levels = [
        sql_let(_string_member(block, name), "level", _level("level"))
        for name in ("user_frustration", "frustration_level")
    ]
    values["user_frustration"] = f"coalesce({levels[0]}, {levels[1]})"
    return _struct(values)


def sql_extract(payload: str, pick: str | None = None) -> str:
    """Telemetry of the top-level `telemetry` block of a JSON object.

    A JSON string holding an object counts as that object; anything else says nothing.
    """
    wanted = f"CASE WHEN contains({payload}, 'telemetry') OR contains({payload}, '\\\\u') THEN {payload} END"
    if pick is None:
        block = f"from_json({wanted}, 'telemetry variant').telemetry"
    else:
        block = f"from_json({wanted}, '{pick} struct<telemetry: variant>').{pick}.telemetry"
    inner = f"CASE WHEN {_type_is('raw', 'STRING')} THEN try_parse_json(try_variant_get(raw, '$', 'string')) END"
    found = f"CASE WHEN {_type_is('block', 'OBJECT')} THEN {_extract('block')} ELSE {NONE} END"
    return sql_let(sql_let(block, "raw", f"coalesce({inner}, raw)"), "block", found)


def extract(payload: str, pick: str | None = None) -> Column:
    return F.expr(sql_extract(payload, pick))


def normalize(name: str) -> Column:
    """Normalize a struct column that carries both spellings of each field."""
    values = {
        n: f"coalesce(nullif({name}.{n}, ''), nullif({name}.{LEGACY[n]}, ''))" for n in FIELDS[:2]
    }
    levels = [_level(f"{name}.{n}") for n in ("user_frustration", "frustration_level")]
    values["user_frustration"] = f"coalesce({levels[0]}, {levels[1]})"
    return F.expr(_struct(values))


def sql_is_empty(name: str) -> str:
    return "(" + " AND ".join(f"coalesce({name}.{n}, '') = ''" for n in FIELDS) + ")"


def sql_first(first: str, second: str) -> str:
    """The first block if any of its fields is set, else the whole second one."""
    chosen = f"CASE WHEN {sql_is_empty('first')} THEN {second} ELSE first END"
    return sql_let(first, "first", chosen)


def sql_field_map(telemetry: str, payload: str, fields: dict[str, str], pick: str | None = None) -> str:
    """Fill missing fields from named top-level string arguments."""
    wanted = {name: fields[name] for name in FIELDS if fields.get(name)}
    if not wanted:
        return telemetry
    members = ", ".join(f"`{key}`: variant" for key in sorted(set(wanted.values())))
    schema = f"struct<{members}>" if pick is None else f"{pick} struct<{members}>"
    args = f"from_json({payload}, {sql_text(schema)})" + ("" if pick is None else f".{pick}")
    values = {}
    for name in FIELDS:
        values[name] = f"nullif(t.{name}, '')"
        if name in wanted:
            given = f"args.`{wanted[name]}`"
            text = f"nullif(try_variant_get({given}, '$', 'string'), '')"
            text = f"CASE WHEN {_type_is(given, 'STRING')} THEN {text} END"
            if name == "user_frustration":
                text = sql_let(text, "level", _level("level"))
            values[name] = f"coalesce({values[name]}, {text})"
    return sql_let(telemetry, "t", sql_let(args, "args", _struct(values)))


def capture(
    payload: str,
    *,
    owned: str,
    context: str | None = None,
    enabled: bool = True,
    fields: dict[str, str] | None = None,
    pick: str | None = None,
) -> Column:
    """Telemetry to export: nothing with capture off, only mapped fields for tools
    that own their `telemetry` argument, else the block of the call or, when that
    says nothing, the one found in its context."""
    if not enabled:
        return F.expr(NONE)
    found = sql_extract(payload, pick)
    if context is not None:
        found = sql_first(found, context)
    found = f"CASE WHEN coalesce({owned}, false) THEN {NONE} ELSE {found} END"
    return F.expr(sql_field_map(found, payload, fields or {}, pick))


def clean(name: str, secrets: bool = True) -> Column:
    """A telemetry struct with its two text fields sanitized and redacted."""
    values = {n: sql_clean_text(f"{name}.{n}", secrets) for n in FIELDS[:2]}
    values["user_frustration"] = _level(f"{name}.user_frustration")
    return F.expr(_struct(values))
