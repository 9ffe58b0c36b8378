"""Client names, capability requests, response codes, outcome of a call."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from callscope import schemas as S
from callscope.functions.text import SPACE, blank_to_null, col, is_blank

DIAGNOSTIC_CODE = "\\A[A-Za-z0-9][A-Za-z0-9_:-]{0,99}\\z"


def client_family(name, aliases: dict[str, str] | None = None) -> Column:
    """`claude_code`, `codex` or `unexpected:<name>`.

    `aliases` gives the family of further exact client names, such as proxies.
    """
    text = F.lower(F.regexp_replace(
        F.coalesce(col(name), F.lit("")), f"\\A[{SPACE}\\uFEFF]+|[{SPACE}\\uFEFF]+\\z", ""
    ))
    out = F.when(text.isin(sorted(aliases or {})), _lookup(text, aliases))
    return (
        out.when(text.rlike("claude[ _-]*code"), "claude_code")
        .when(text.contains("codex"), "codex")
        .otherwise(F.concat(F.lit("unexpected:"), F.coalesce(blank_to_null(text), F.lit("unknown"))))
    )


def _lookup(text: Column, aliases: dict[str, str] | None) -> Column:
    pairs = [F.lit(x) for item in sorted((aliases or {"": ""}).items()) for x in item]
    return F.try_element_at(F.create_map(*pairs), text)


def ok(error, is_tool_error) -> Column:
    return col(error).isNull() & ~F.coalesce(col(is_tool_error), F.lit(False))


def error_text(error, is_tool_error, error_type) -> Column:
    """Classification, else the error itself, else `tool_error`; NULL on success."""
    text = F.coalesce(blank_to_null(error_type), col(error), F.lit("tool_error"))
    return F.when(~ok(error, is_tool_error), text)


def sql_capabilities(name: str) -> str:
    """Client capabilities as JSON; dropped when empty."""
    return (
        f"CASE WHEN NOT {name} RLIKE '^\\\\s*([{{]\\\\s*[}}]|null)?\\\\s*$' THEN {name} END"
    )


def valid_capability(value) -> Column:
    """A capability request is a non-blank text of at most 1000 bytes."""
    fits = F.octet_length(col(value)) <= S.MAX_CAPABILITY_BYTES
    return F.coalesce(fits & ~is_blank(value), F.lit(False))


def response_code(body, status) -> Column:
    """Diagnostic code of a failed delivery, from its body if that holds a valid one."""
    parsed = F.from_json(col(body), "error variant, errorCode variant, _corrupt_record string")

    def string_in(value: Column, path: str) -> Column:
        return F.try_variant_get(value, path, "string")

    def is_type(value: Column, *kinds: str) -> Column:
        found = F.coalesce(F.schema_of_variant(value), F.lit("VOID"))
        return F.regexp(found, F.lit("^(" + "|".join(kinds) + ")"))

    inner = F.try_variant_get(parsed["error"], "$.code", "variant")
    well_formed = (
        parsed["_corrupt_record"].isNull()
        & is_type(parsed["error"], "OBJECT", "VOID")
        & is_type(inner, "STRING", "VOID")
        & is_type(parsed["errorCode"], "STRING", "VOID")
    )
    code = F.coalesce(blank_to_null(string_in(inner, "$")), string_in(parsed["errorCode"], "$"))
    usable = well_formed & code.rlike(DIAGNOSTIC_CODE)
    fallback = F.concat(F.lit("ingest_http_"), col(status).cast("string"))
    return F.when(usable, code).otherwise(fallback)
