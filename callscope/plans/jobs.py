"""The other whole jobs: payload cleaning, session resolution, ingest."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callscope.functions import ids, payload
from callscope.functions.text import blank_to_null, clean_text, is_truncated, trim_space, truncate_utf8
from callscope.operators.envelopes import dedup_events, rejection_reason


def clean_payloads(
    df: DataFrame,
    *,
    json: list[str] | None = None,
    text: list[str] | None = None,
    secrets: bool = True,
    limit: int | None = None,
) -> DataFrame:
    """Clean columns of any table: no binaries, no secrets, values whole.

    JSON columns become previews; text columns are cleaned as strings. Only with a
    `limit`, the bytes a receiver takes, are values cut, each with a
    `<column>_truncated` flag.
    """
    for name in json or []:
        df = payload.with_preview(df, name, name, secrets=secrets)
    df = df.withColumns({name: clean_text(name, secrets) for name in text or []})
    if limit is None:
        return df
    names = [*(json or []), *(text or [])]
    df = df.withColumns({f"{name}_truncated": is_truncated(name, limit) for name in names})
    return df.withColumns({name: truncate_utf8(name, limit) for name in names})


def _initialize_params(body: str) -> Column:
    """Params JSON of a body that is one message, and of the first match in a batch."""
    one = F.from_json(body, "method variant, params string")
    many = F.from_json(body, "array<struct<method: variant, params: string>>")

    def is_init(message):
        kind = F.schema_of_variant(message["method"])
        return (kind == "STRING") & (F.try_variant_get(message["method"], "$", "string") == "initialize")

    is_batch = F.col(body).rlike("\\A\\s*\\[")
    first = F.try_element_at(F.filter(many, lambda m: F.coalesce(is_init(m), F.lit(False))), F.lit(1))
    single = F.when(F.coalesce(is_init(one), F.lit(False)), F.struct(one["params"].alias("params")))
    return F.when(is_batch, F.when(first.isNotNull(), F.struct(first["params"].alias("params")))).otherwise(single)


def resolve_sessions(
    requests: DataFrame,
    *,
    uid: str = "request_uid",
    seed_header: str = "X-Session-Seed",
    session_header: str = "Mcp-Session-Id",
    random_ids: bool = False,
) -> DataFrame:
    """Session id and client of each stateless HTTP request.

    An initialize (alone or inside a batch) mints an id that carries its client; any
    other request echoes the id in its header or gets one of its own.
    """
    df = requests.withColumn("__init", _initialize_params("body"))
    info = F.from_json("__init.params", "clientInfo struct<name: variant, version: variant>")["clientInfo"]
    df = df.withColumn("__info", info)

    def text(name):
        member = F.col("__info")[name]
        return F.when(F.schema_of_variant(member) == "STRING", F.try_variant_get(member, "$", "string"))

    minted = ids.mint_uuid(uid, random=random_ids)
    started = ids.session_id(text("name"), text("version"), ids.header("headers", seed_header), minted)
    echoed = blank_to_null(trim_space(ids.header("headers", session_header)))
    is_init = F.col("__init").isNotNull()
    df = df.withColumns({
        "is_initialize": is_init,
        "session_id": F.when(is_init, started).otherwise(F.coalesce(echoed, minted)),
    })
    client = F.when(~F.col("is_initialize"), ids.client_from_session_id("session_id"))
    return df.withColumn("client", client).drop("__init", "__info")


def ingest(received: DataFrame, order: list[str]) -> DataFrame:
    """Unpacked envelope events to a clean event table: refused ones out, one row per id."""
    taken = received.filter(rejection_reason().isNull())
    return dedup_events(taken, order)
