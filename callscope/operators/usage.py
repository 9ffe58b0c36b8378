"""Usage tables: tools, failures, latency, unmet demand, intents.

The public documentation names these outputs without defining them; the definitions
here are ours.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from callscope.functions.clients import valid_capability
from callscope.functions.text import is_blank, secret_hits, trim_space
from callscope.operators.sessions import timed_out

HLL_LOG_K = 12
KLL_K = 800
RANK_ERROR = 0.004


def tool_usage(calls: DataFrame, approximate: bool = False, by: tuple[str, ...] = ("tool",)) -> DataFrame:
    """Calls, sessions and actors per tool, or per `by`. Blank sessions do not count as one."""
    session = F.when(F.col("session_key") != "", F.struct("server_id", "session_key"))
    if approximate:
        key = F.when(F.col("session_key") != "", F.xxhash64("server_id", "session_key"))
        sessions, actors = F.approx_count_distinct(key), F.approx_count_distinct("actor_id")
    else:
        sessions, actors = F.countDistinct(session), F.countDistinct("actor_id")
    return calls.groupBy(*by).agg(
        F.count(F.lit(1)).alias("calls"), sessions.alias("sessions"), actors.alias("actors")
    )


def tool_failures(calls: DataFrame) -> DataFrame:
    """Failure rate and time-outs per tool."""
    failed = ~F.col("ok")
    return calls.groupBy("tool").agg(
        F.count(F.lit(1)).alias("calls"),
        F.count_if(failed).alias("failed"),
        F.count_if(failed & timed_out()).alias("timed_out"),
        F.avg(failed.cast("double")).alias("failure_rate"),
    )


def error_breakdown(calls: DataFrame) -> DataFrame:
    """Failed calls per tool and error text."""
    failed = calls.filter(~F.col("ok"))
    return failed.groupBy("tool", "error").agg(F.count(F.lit(1)).alias("failed"))


def tool_latency(calls: DataFrame, quantiles: tuple[float, ...] = (0.5, 0.9, 0.99)) -> DataFrame:
    """Exact latency quantiles per tool: the smallest duration covering each share.

    Durations are counted first, in the map side of one shuffle; the running total
    then walks distinct millisecond values instead of calls.
    """
    counted = calls.groupBy("tool", "duration_ms").agg(F.count(F.lit(1)).alias("n"))
    tool = Window.partitionBy("tool")
    walk = tool.orderBy("duration_ms").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = counted.withColumns({
        "upto": F.sum("n").over(walk),
        "total": F.sum("n").over(tool.orderBy("duration_ms").rowsBetween(
            Window.unboundedPreceding, Window.unboundedFollowing)),
    })
    reach = [
        F.min(F.when(F.col("upto") >= F.col("total") * F.lit(q), F.col("duration_ms")))
        .alias(f"p{round(q * 100)}_ms")
        for q in quantiles
    ]
    return ranked.groupBy("tool").agg(F.sum("n").alias("calls"), *reach, F.max("duration_ms").alias("max_ms"))


def usage_sketches(calls: DataFrame, span_seconds: int = 3600, ts: str = "started") -> DataFrame:
    """One row per tool and span of time: counts, and mergeable sketches of sessions, actors and durations.

    `sessions` and `actors` are HLL sketches of `2^HLL_LOG_K` registers, `durations` a KLL sketch of
    `KLL_K` items: a few kilobytes a row whatever the traffic. Write them once, and `merge_usage`
    answers for any longer span without the calls. Blank sessions do not count; calls
    without a time have a row of their own, without a `span_start`.
    """
    session = F.when(F.col("session_key") != "", F.concat_ws("\x1f", "server_id", "session_key"))
    # Not `window`, which drops rows without a time.
    micros = F.unix_micros(ts)
    start = F.timestamp_micros(micros - F.pmod(micros, F.lit(span_seconds * 1_000_000)))
    return calls.groupBy("tool", start.alias("span_start")).agg(
        F.count(F.lit(1)).alias("calls"),
        F.count_if(~F.col("ok")).alias("failed"),
        F.hll_sketch_agg(session, F.lit(HLL_LOG_K)).alias("sessions"),
        F.hll_sketch_agg("actor_id", F.lit(HLL_LOG_K)).alias("actors"),
        F.kll_sketch_agg_bigint("duration_ms", F.lit(KLL_K)).alias("durations"),
    )


def merge_usage(sketches: DataFrame, *by, quantiles: tuple[float, ...] = (0.5, 0.9, 0.99)) -> DataFrame:
    """Usage per `by` (say, tool and day) out of sketches of shorter spans.

    Calls and failures are exact. Distinct counts have a standard error of 0.83 / 2^(HLL_LOG_K / 2), 1.3 %; the rank
    of a quantile is off by less than `RANK_ERROR` of the calls, 99 times in 100. Quantiles of no durations are NULL.
    """
    merged = sketches.groupBy(*by).agg(
        F.sum("calls").alias("calls"), F.sum("failed").alias("failed"),
        F.hll_sketch_estimate(F.hll_union_agg("sessions")).alias("sessions"),
        F.hll_sketch_estimate(F.hll_union_agg("actors")).alias("actors"),
        F.kll_merge_agg_bigint("durations").alias("durations"),
    )
    some = F.kll_sketch_get_n_bigint("durations") > 0
    return merged.withColumns({
        f"p{round(q * 100)}_ms": F.when(some, F.kll_sketch_get_quantile_bigint("durations", F.lit(q))) for q in quantiles
    })


def unmet_demand(requests: DataFrame, text: str = "capability") -> DataFrame:
    """Valid capability requests by their text, without case and outer space."""
    valid = requests.filter(F.col("capability_request") & valid_capability(text))
    return valid.groupBy(F.lower(trim_space(text)).alias("capability")).agg(
        F.count(F.lit(1)).alias("requests"), F.countDistinct("actor_id").alias("actors")
    )


def invalid_requests(requests: DataFrame, text: str = "capability") -> DataFrame:
    """Capability requests that were answered with an error, and why."""
    why = F.when(F.coalesce(is_blank(text), F.lit(True)), "blank").otherwise("too_long")
    bad = requests.filter(F.col("capability_request") & ~valid_capability(text))
    return bad.groupBy(why.alias("problem")).agg(F.count(F.lit(1)).alias("requests"))


def intent_breakdown(turns: DataFrame) -> DataFrame:
    """Turns, calls and failures per intent and frustration level."""
    stated = turns.filter(F.col("turn_intent").isNotNull())
    return stated.groupBy(
        F.col("turn_intent").alias("intent"),
        F.coalesce("turn_frustration", F.lit("none")).alias("frustration"),
    ).agg(
        F.count(F.lit(1)).alias("turns"),
        F.sum("calls").alias("calls"),
        F.sum("failed").alias("failed"),
    )


def secret_audit(rows: DataFrame, keys: list[str], text: str) -> DataFrame:
    """Secret rule hits in a text column per key and rule."""
    hits = rows.select(*keys, F.explode(secret_hits(text)).alias("label", "hits"))
    return hits.filter("hits > 0").groupBy(*keys, "label").agg(
        F.sum("hits").alias("hits"), F.count(F.lit(1)).alias("texts")
    )
