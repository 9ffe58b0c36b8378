"""User functions on values and on whole calls, run as Arrow batches.

Both fail closed: what a failing function was given is replaced, never exported.
"""

import json
from collections.abc import Callable

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from callscope import schemas as S
from callscope.functions import payload, telemetry

FINALIZED_SCHEMA = T.StructType([*S.CANDIDATE_SCHEMA.fields, T.StructField("keep", T.BooleanType())])


_ARROW_TYPES = {"string": pa.string(), "bigint": pa.int64(), "boolean": pa.bool_()}


def _arrow_type(kind: T.DataType) -> pa.DataType:
    """Arrow type of a candidate column."""
    if isinstance(kind, T.StructType):
        return pa.struct([pa.field(f.name, _arrow_type(f.dataType)) for f in kind])
    return _ARROW_TYPES[kind.simpleString()]


def redact_error(text, redactor: Callable) -> Column:
    """Run the value redactor on an error text; other results become their JSON."""
    @F.pandas_udf("string")
    def udf(errors: pd.Series) -> pd.Series:
        def one(error):
            if error is None:
                return None
            value = payload.apply_redactor(error, redactor)
            return value if isinstance(value, str) else payload.stringify(value)

        return errors.map(one)

    return udf(text)


def _as_telemetry(value) -> dict | None:
    if not isinstance(value, dict):
        return None
    out = {}
    for name in telemetry.FIELDS:
        given = [value.get(name), value.get(telemetry.LEGACY[name])]
        if any(v is not None and not isinstance(v, str) for v in given):
            return None
        if name == "user_frustration":
            given = [v for v in given if v in telemetry.FRUSTRATION_LEVELS]
        out[name] = next((v for v in given if v), None)
    return out


def redact_telemetry(block, redactor: Callable) -> Column:
    """Run the value redactor on the telemetry of a call; a failure drops it whole."""
    @F.pandas_udf(S.TELEMETRY_SCHEMA)
    def udf(blocks: pd.DataFrame) -> pd.DataFrame:
        def one(row):
            given = {k: v for k, v in row.items() if isinstance(v, str) and v}
            if not given:
                return {}
            try:
                return _as_telemetry(redactor(given)) or {}
            except Exception:
                return {}

        rows = [one(r) for r in blocks.to_dict("records")]
        return pd.DataFrame(rows, columns=telemetry.FIELDS, dtype=object)

    return udf(block)


def _decode(text):
    return None if text is None or text == payload.UNDEFINED else payload.decode(text)


def _run_hook(hook: Callable, row: dict) -> dict:
    """One candidate through the hook, back as column values."""
    block = row["telemetry"]
    candidate = row | {
        "duration_ms": int(row["duration_ms"]),
        "input": _decode(row["input"]),
        "output": _decode(row["output"]),
        "telemetry": {k: v for k, v in block.items() if v} if block else None,
    }
    try:
        seen = hook(dict(candidate))
        if seen is None:
            return row | {"keep": False}
        output = seen.get("output")
        return {
            "kind": S.TOOL_CALL,
            "tool_name": seen.get("tool_name"),
            "status": seen.get("status"),
            "duration_ms": int(seen.get("duration_ms") or 0),
            "session_id": seen.get("session_id"),
            "input": payload.stringify(seen.get("input")),
            "output": None if output is None else payload.stringify(output),
            "error_message": seen.get("error_message"),
            "telemetry": _as_telemetry(seen.get("telemetry")),
            "keep": True,
        }
    except Exception:
        failed = json.dumps(S.REDACTION_FAILED)
        return row | {
            "input": failed, "output": failed, "error_message": S.REDACTION_FAILED,
            "telemetry": None, "keep": True,
        }


def with_event_hook(df: DataFrame, hook: Callable, candidate: str = "candidate") -> DataFrame:
    """Run `hook` on every candidate struct; rows it answers with None are dropped.

    The hook gets a dict with decoded input and output and returns one. If it fails,
    input, output and error become placeholders, also where there was none before.
    """
    finalized = _arrow_type(FINALIZED_SCHEMA)

    @F.arrow_udf(FINALIZED_SCHEMA)
    def udf(rows: pa.Array) -> pa.Array:
        return pa.array([_run_hook(hook, row) for row in rows.to_pylist()], finalized)

    # Nondeterministic keeps the filter from being moved below the hook.
    seen = udf.asNondeterministic()(F.col(candidate))
    return df.withColumn(candidate, seen).filter(F.col(f"{candidate}.keep"))
