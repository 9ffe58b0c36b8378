"""Previews of JSON payloads: cleaned, key-sorted, compact, HTML-escaped text.

Built-in functions do the work on JSON text. Numbers that a round trip could change are put into
marked strings first; a variant then gives the canonical text, with sorted keys and every string in
one form. In that text members are rewritten by their keys, and, where a cheap test finds a
trigger, the string values are taken apart from keys and structure, cleaned each for itself and
joined again. Only what JSON text does not decide well (see `_ODD`, `_UNCLEAR`) crosses into
Python, as Arrow batches, where a short recursion applies the same rules to nested values.
"""

import json
import re
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callscope import schemas as S
from callscope.functions import text as tx
from callscope.functions.text import col

UNDEFINED = "undefined"

# Object keys whose values never leave, lower case without - and _.
SENSITIVE_KEYS = frozenset({
    "password", "passwd", "pwd", "secret", "apikey", "clientsecret",
    "authorization", "accesstoken", "refreshtoken", "databaseurl", "token", "privatekey",
})
_SENSITIVE = "[-_]*(?:" + "|".join("[-_]*".join(name) for name in sorted(SENSITIVE_KEYS)) + ")[-_]*"

# --- native path -----------------------------------------------------------------

# One JSON string. Possessive, so that the matcher needs no stack for long ones.
_STRING = r'"[^"\\]*+(?:\\[\s\S][^"\\]*+)*+"'
_FLAT = rf"(?:{_STRING}|true|false|null|-?[0-9]+)"
_NUMBER = r"(?<![0-9A-Za-z.+-])(-?(?:0|[1-9][0-9]*)(?:[.][0-9]+)?(?:[eE][+-]?[0-9]+)?)(?![0-9A-Za-z.+-])"
# A number that a round trip could change: fraction, exponent, minus zero, many digits.
_FRAGILE_NUMBER = r"[\[:,\s](?:-?(?:[0-9]+[.eE]|[0-9]{18})|-0)"
_ONLY_NUMBER = r"\A\s*-?[0-9]"
# Marks around a number in a string, and after each token while they are placed.
_OPEN, _SHUT = "\ue010", "\ue011"
# Texts for the recursion: lone surrogates and rare control characters, whose escapes differ;
# private-use characters, which are our marks; a letter whose lower case is that of another.
_ODD = "[\ue000-\uf8ff\u212a]"
_ODD_ESCAPE = r"\\u(?:00[01]|[eE]|[fF][0-8]|212[aA]|[dD][89abAB][0-9a-fA-F]{2}(?!\\u[dD][c-fC-F])|(?<!\\u[dD][89abAB][0-9a-fA-F]{2}\\u)[dD][c-fC-F])"
# Keys of these two kinds sort otherwise by UTF-16 than by bytes.
_HIGH, _HIGHER = "[\uf900-\uffff]", r"[\x{10000}-\x{10ffff}]|\\u[dD][89abAB]"

def _key(name: str) -> str:
    """A key's name in quotes. The text before it is looked at last, so that the search goes by the name."""
    return rf'"{name}":(?<=[{{,]"{name}":)'


_QUOTE = '"(?<=[{,]")'
_FILLED = rf'(?!"["{_OPEN}]){_STRING}'
_BLOB = rf'{_key("blob")}{_FILLED}'
# `data` of an image or audio: flat members, then the type, in the same object.
_BETWEEN = rf'(?:,(?!"type":){_STRING}:{_FLAT})*+'
_DATA = rf'{_key("data")}{_FILLED}(?={_BETWEEN},"type":"(?:image|audio)"[,}}])'
# A nested member between `data` and where its type would be, or below a sensitive key.
_UNCLEAR_DATA = rf'{_key("data")}(?!"\[binary removed\]"){_FILLED}{_BETWEEN},(?!"type":){_STRING}:[{{\[]'
_HAS_SENSITIVE = rf'{_QUOTE}(?i:{_SENSITIVE})":'
_UNCLEAR = _HAS_SENSITIVE + r"[{\[]"
_SENSITIVE_MEMBER = rf'{_QUOTE}((?i:{_SENSITIVE}))":(?!null){_FLAT}'


def _sql_replace(text: str, pattern: str, by: str) -> str:
    return f"regexp_replace({text}, {tx.sql_text(pattern)}, {tx.sql_text(by)})"


def _sql_marked(text: str) -> str:
    """Every number of a JSON text as a marked string."""
    tokens = _sql_replace(text, f"({_STRING})|{_NUMBER}", f"$1{_OPEN}$2{_SHUT}")
    bare = f"replace({tokens}, '{_OPEN}{_SHUT}', '')"
    return f"replace(replace({bare}, '{_OPEN}', '\"{_OPEN}'), '{_SHUT}', '{_SHUT}\"')"


def _sql_frame(text: str) -> str:
    """What is left of a JSON text without strings and white space."""
    return _sql_replace(text, rf"{_STRING}|[ \t\r\n]+", "")


def _sql_same_frame(text: str, canonical: str) -> str:
    """Whether a text is the one JSON value of `canonical`.

    A parser stops after the first value; what follows it is in the frame alone. Where neither holds an
    escape, each string of the value keeps its length, so texts of one length differ in order only.
    """
    plain = f"NOT contains({text}, {tx.sql_text(chr(92))}) AND NOT contains({canonical}, {tx.sql_text(chr(92))})"
    return (
        f"CASE WHEN {plain} AND length({text}) = length({canonical}) THEN true"
        f" ELSE length({_sql_frame(text)}) = length({_sql_frame(canonical)}) END"
    )


def _sql_escape_html(text: str) -> str:
    for char, code in (("<", "\\u003c"), (">", "\\u003e"), ("&", "\\u0026"), ("\u2028", "\\u2028"), ("\u2029", "\\u2029")):
        text = f"replace({text}, '{char}', {tx.sql_text(code)})"
    return text


def _with_canonical(df: DataFrame, out: str, value: str, pick: str | None, strip: str | None, marker: str | None, objects: bool) -> DataFrame:
    """Add `out`: canonical JSON of the payload, `undefined` if absent, NULL for the recursion."""
    marked, parsed, whole, valid, member = (f"__{out}_{x}" for x in ("marked", "parsed", "whole", "valid", "member"))
    # Escapes are rare enough to look for them only where there are any.
    escaped = f"(contains({value}, {tx.sql_text(chr(92) + 'u')}) AND {value} RLIKE {tx.sql_text(_ODD_ESCAPE)})"
    odd = [f"{value} RLIKE {tx.sql_text(_ODD)}", escaped, f"({value} RLIKE {tx.sql_text(_HIGH)} AND {value} RLIKE {tx.sql_text(_HIGHER)})"]
    if marker:
        odd.append(f"contains({value}, {tx.sql_text(marker)})")
    fragile = tx.sql_when_any([f"{value} RLIKE {tx.sql_text(p)}" for p in (_FRAGILE_NUMBER, _ONLY_NUMBER)])
    exact = f"CASE WHEN {fragile} THEN {_sql_marked(value)} ELSE {value} END"
    df = df.withColumn(marked, F.expr(f"CASE WHEN NOT {tx.sql_when_any(odd)} THEN {exact} END"))
    df = df.withColumn(parsed, F.expr(f"try_parse_json({marked})")).withColumn(whole, F.expr(f"to_json({parsed})"))
    df = df.withColumn(valid, F.expr(_sql_same_frame(marked, whole)))
    taken = parsed if pick is None else f"try_variant_get({parsed}, {tx.sql_text('$.' + pick)}, 'variant')"
    df = df.withColumn(member, F.expr(f"CASE WHEN {valid} THEN {taken} END"))
    text = whole if pick is None else f"to_json({member})"
    if strip is not None:
        block = f"({strip} AND contains({marked}, '\"telemetry\"') AND startswith(schema_of_variant({member}), 'OBJECT'))"
        order = "(a, b) -> CASE WHEN a.key < b.key THEN -1 WHEN a.key > b.key THEN 1 ELSE 0 END"
        entries = f"map_entries(CASE WHEN {block} THEN try_variant_get({member}, '$', 'map<string,variant>') END)"
        kept = f"array_sort(filter({entries}, e -> e.key != 'telemetry'), {order})"
        text = f"CASE WHEN {block} THEN to_json(map_from_entries({kept})) ELSE {text} END"
    absent = [f"{member} IS NULL", f"is_variant_null({member})"]
    if objects:
        absent.append(f"NOT startswith(schema_of_variant({member}), 'OBJECT')")
    shown = f"CASE WHEN {valid} THEN CASE WHEN {tx.sql_when_any(absent)} THEN '{UNDEFINED}' ELSE {text} END END"
    return df.withColumn(out, F.expr(shown)).drop(marked, parsed, whole, valid, member)


def _sql_members(text: str, secrets: bool) -> str:
    """Binary members and, with `secrets`, those under sensitive keys replaced; NULL if unclear."""
    binary = f"CASE WHEN contains({text}, '\"blob\":') THEN {_sql_replace(text, _BLOB, f'"blob":"{S.BINARY_REMOVED}"')} ELSE {text} END"
    media = f"contains(m, '\"data\":') AND m RLIKE '\"type\":\"(image|audio)\"'"
    data = _sql_replace("m", _DATA, f'"data":"{S.BINARY_REMOVED}"')
    clear = f"CASE WHEN d RLIKE {tx.sql_text(_UNCLEAR_DATA)} THEN NULL ELSE d END"
    out = tx.sql_let(binary, "m", f"CASE WHEN {media} THEN {tx.sql_let(data, 'd', clear)} ELSE m END")
    if not secrets:
        return out
    held = f"k RLIKE {tx.sql_text(_HAS_SENSITIVE)}"
    hidden = _sql_replace("k", _SENSITIVE_MEMBER, f'"$1":"{S.SENSITIVE_FIELD}"')
    return tx.sql_let(out, "k", f"CASE WHEN NOT {held} THEN k WHEN NOT k RLIKE {tx.sql_text(_UNCLEAR)} THEN {hidden} END")


def _sql_clean_token(secrets: bool) -> str:
    """One string value `t` cleaned; without a trigger it stays as it is. `runs`: whether the text holds long runs."""
    odd = ["octet_length(t) >= 64"] + ([tx.sql_may_hold_secret("t")] if secrets else [])
    quoted = tx.sql_let("to_json(struct(clean AS v))", "shown", "substring(shown, 6, length(shown) - 6)")
    clean = tx.sql_let(tx.sql_clean_text("plain", secrets, "runs"), "clean", f"CASE WHEN clean = plain THEN t ELSE {quoted} END")
    decoded = tx.sql_let("try_variant_get(try_parse_json(t), '$', 'string')", "plain", clean)
    return f"CASE WHEN startswith(t, '\"{_OPEN}') OR NOT {tx.sql_when_any(odd)} THEN t ELSE {decoded} END"


def _sql_strings(text: str, secrets: bool) -> str:
    """All string values of a canonical text cleaned, if it holds anything to clean."""
    odd = ["runs", f"contains({text}, ';base64,')"] + ([tx.sql_may_hold_secret(text)] if secrets else [])
    tokens = f"regexp_extract_all({text}, {tx.sql_text(_STRING)}, 0)"
    frame = f"split({_sql_replace(text, _STRING, '"')}, '\"', -1)"
    # A string before a colon is a key and stays.
    values = f"transform(tokens, (t, i) -> CASE WHEN startswith(get(frame, i + 1), ':') THEN t ELSE {_sql_clean_token(secrets)} END)"
    joined = f"array_join(zip_with(frame, {values}, (f, t) -> concat(f, coalesce(t, ''))), '')"
    shown = f"CASE WHEN {tx.sql_when_any(odd)} THEN {tx.sql_let(tokens, 'tokens', tx.sql_let(frame, 'frame', joined))} ELSE {text} END"
    return tx.sql_let(f"{text} RLIKE {tx.sql_text(tx.HOLDS_RUN)}", "runs", shown)


def with_native_preview(
    df: DataFrame, out: str, value: str, *, pick: str | None = None, strip: str | None = None, secrets: bool = True,
    marker: str | None = None, objects: bool = False,
) -> DataFrame:
    """Add `out`: the preview of JSON column `value`, NULL where the recursion has to do the work."""
    canonical, members = f"__{out}_canonical", f"__{out}_members"
    df = _with_canonical(df, canonical, value, pick, strip, marker, objects)
    df = df.withColumn(members, F.expr(_sql_members(canonical, secrets)))
    df = df.withColumn(members, F.expr(_sql_strings(members, secrets)))
    unmarked = f"replace(replace({members}, '\"{_OPEN}', ''), '{_SHUT}\"', '')"
    return df.withColumn(out, F.expr(_sql_escape_html(unmarked))).drop(canonical, members)


def with_recursion_flag(df: DataFrame, out: str, value: str, secrets: bool = True) -> DataFrame:
    """Add whether a payload leaves the native path; for measuring its share."""
    native = f"__{out}_probe"
    df = with_native_preview(df, native, value, secrets=secrets)
    return df.withColumn(out, F.col(value).isNotNull() & F.col(native).isNull()).drop(native)


# --- recursion for the rest ------------------------------------------------------


class Number(str):
    """Number text kept exactly as it was written."""


def _no_constant(name):
    raise ValueError(name)


_SURROGATE = re.compile("[\ud800-\udfff]")
_HTML = {"<": "\\u003c", ">": "\\u003e", "&": "\\u0026", chr(0x2028): "\\u2028", chr(0x2029): "\\u2029"}
_HTML_PATTERN = re.compile("[<>&\u2028\u2029]")
_WHOLE_BASE64 = re.compile(tx.BASE64_WHOLE.replace("\\z", "\\Z"))
_RUN_BASE64 = re.compile(tx.BASE64_RUN)
_RULES = [
    (re.compile(pattern, re.ASCII), before.replace("$1", r"\1") + tx._label(name) + after)
    for name, pattern, before, after in tx.SECRET_RULES
]


_DECODER = json.JSONDecoder(parse_int=Number, parse_float=Number, parse_constant=_no_constant)
_ENCODER = json.JSONEncoder(ensure_ascii=False)


def _key_bytes(item) -> bytes:
    return item[0].encode("utf-8", "replace")


def decode(text: str):
    """JSON value with exact numbers; text that is no JSON stands for itself."""
    try:
        return _DECODER.decode(text)
    except (ValueError, RecursionError):
        return text


def encode(value) -> str:
    if value is None:
        return "null"
    if value is True or value is False:
        return "true" if value else "false"
    if isinstance(value, Number):
        return str(value)
    if isinstance(value, str):
        quoted = _ENCODER.encode(_SURROGATE.sub("\ufffd", value))
        return _HTML_PATTERN.sub(lambda m: _HTML[m.group()], quoted)
    if isinstance(value, dict):
        items = sorted(value.items(), key=_key_bytes)
        return "{" + ",".join(encode(k) + ":" + encode(v) for k, v in items) + "}"
    if isinstance(value, (list, tuple)):
        return "[" + ",".join(map(encode, value)) + "]"
    return json.dumps(value)


def stringify(value) -> str:
    if value is None:
        return UNDEFINED
    try:
        return encode(value)
    except (TypeError, ValueError, RecursionError):
        return S.UNSERIALISABLE


def redact_string(text: str) -> str:
    for pattern, label in _RULES:
        text = pattern.sub(label, text)
    return text


def redact_value(value):
    """Secret rules on every string; values under a sensitive key go whole."""
    if isinstance(value, Number):
        return value
    if isinstance(value, str):
        return redact_string(value)
    if isinstance(value, dict):
        return {
            k: S.SENSITIVE_FIELD
            if v is not None and re.sub("[-_]", "", k).lower() in SENSITIVE_KEYS
            else redact_value(v)
            for k, v in value.items()
        }
    if isinstance(value, list):
        return [redact_value(v) for v in value]
    return value


def without_binaries(value):
    """A decoded value without encoded binaries, whole otherwise."""
    if isinstance(value, Number):
        return value
    if isinstance(value, str):
        return _plain_text(_SURROGATE.sub("\ufffd", value))
    if isinstance(value, list):
        return [without_binaries(item) for item in value]
    if not isinstance(value, dict):
        return value
    binary = {"blob", "data"} if value.get("type") in ("image", "audio") else {"blob"}
    return {
        key: S.BINARY_REMOVED
        if key in binary and entry and isinstance(entry, str) and not isinstance(entry, Number)
        else without_binaries(entry)
        for key, entry in value.items()
    }


def _plain_text(text: str) -> str:
    if text.startswith("data:") and ";base64," in text and len(text.encode()) >= tx.DATA_URI_MIN_BYTES:
        return S.BASE64_REMOVED
    if len(text) < tx.BASE64_MIN_BYTES:  # encoded binaries are ASCII
        return text
    return S.BASE64_REMOVED if _WHOLE_BASE64.match(text) else _RUN_BASE64.sub(S.BASE64_REMOVED, text)


def clean_value(value, secrets: bool = True):
    """Sanitized and redacted copy of one decoded value."""
    cleaned = without_binaries(value)
    return redact_value(cleaned) if secrets else cleaned


def select_payload(text: str, pick: str | None, strip: bool, marker: str | None, objects: bool):
    """Decode a payload: the member `pick` of an object, without its telemetry block
    and without the provenance marker of a capability answer."""
    value = decode(text)
    if pick is not None:
        value = value.get(pick) if isinstance(value, dict) else None
    if not isinstance(value, dict):
        return None if objects else value
    if strip and "telemetry" in value:
        value = {k: v for k, v in value.items() if k != "telemetry"}
    meta = value.get("_meta")
    if marker and isinstance(meta, dict) and marker in meta:
        rest = {k: v for k, v in meta.items() if k != marker}
        value = {k: v for k, v in value.items() if k != "_meta"} | ({"_meta": rest} if rest else {})
    return value


def apply_redactor(value, redactor: Callable | None):
    """User redactor on one value; any failure replaces the value."""
    if redactor is None:
        return value
    try:
        return redactor(value)
    except Exception:
        return S.REDACTION_FAILED


def _slow_preview(pick, secrets: bool, redactor: Callable | None, marker, objects: bool):
    def preview(text: str, strip: bool) -> str:
        try:
            value = clean_value(select_payload(text, pick, strip, marker, objects), secrets)
        except RecursionError:
            return S.UNSERIALISABLE
        return stringify(apply_redactor(value, redactor))

    @F.pandas_udf("string")
    def udf(texts: pd.Series, strips: pd.Series) -> pd.Series:
        return pd.Series(
            [None if t is None else preview(t, bool(s)) for t, s in zip(texts, strips)],
            dtype=object,
        )

    # Keeps filters on other columns from being moved below, which would run it twice.
    return udf.asNondeterministic()


def with_previews(
    df: DataFrame, previews: dict[str, dict], *, secrets: bool = True, redactor: Callable | None = None
) -> DataFrame:
    """Add several previews: column -> what `with_preview` takes for it (`value`, `pick`, `strip`, `drop_marker`, `objects_only`).

    What needs the recursion crosses into Python together, so that rows are handed over once.
    """
    slow = {}
    for out, given in previews.items():
        value, pick, strip, marker = given["value"], given.get("pick"), given.get("strip"), given.get("drop_marker")
        objects = given.get("objects_only", False)
        native, flag = f"__{out}_native", f"__{out}_flag"
        df = df.withColumn(flag, F.lit(False) if strip is None else F.coalesce(strip, F.lit(False)))
        if redactor is None:
            df = with_native_preview(
                df, native, value, pick=pick, strip=None if strip is None else flag, secrets=secrets, marker=marker, objects=objects,
            )
        else:
            df = df.withColumn(native, F.lit(None).cast("string"))
        slow_udf = _slow_preview(pick, secrets, redactor, marker, objects)
        slow[f"__{out}_slow"] = slow_udf(F.when(F.col(native).isNull(), F.col(value)), F.col(flag))
    df = df.withColumns(slow)
    merged = {out: F.coalesce(F.col(f"__{out}_native"), F.col(f"__{out}_slow"), F.lit(UNDEFINED)) for out in previews}
    return df.withColumns(merged).drop(*[f"__{out}_{x}" for out in previews for x in ("native", "slow", "flag")])


def with_preview(
    df: DataFrame,
    out: str,
    value: str,
    *,
    pick: str | None = None,
    strip: Column | None = None,
    secrets: bool = True,
    redactor: Callable | None = None,
    drop_marker: str | None = None,
    objects_only: bool = False,
) -> DataFrame:
    """Add column `out`: the cleaned preview of JSON column `value`, whole.

    `pick` takes one member of the JSON object instead of all of it; `strip` says
    where to leave out the telemetry block; `drop_marker` leaves out one key of the
    object's `_meta`; with `objects_only` any other value counts as absent. Absent
    and JSON null both give `undefined`.
    """
    given = {"value": value, "pick": pick, "strip": strip, "drop_marker": drop_marker, "objects_only": objects_only}
    return with_previews(df, {out: given}, secrets=secrets, redactor=redactor)
