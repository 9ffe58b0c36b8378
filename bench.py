"""Times the headline queries and prints one JSON line.

Each query runs twice; the second, warm run counts, from building the plan to the
last row. BENCH_SF_DIR and BENCH_CPUS choose the input and the cores.
"""

import json
import os
import sys
import time
from statistics import median

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from callscope.functions.payload import with_recursion_flag  # noqa: E402
from callscope.session import build_session  # noqa: E402
from workload import registry, streams, views  # noqa: E402

HEADLINE = [
    "message_log_events", "message_log_events_sliced", "log_session_rollup", "paired_calls", "ownership_as_of", "clean_documents", "clean_json", "clean_rough_json",
    "secret_audit",
    "stateless_sessions", "session_rollup", "session_traces", "intent_breakdown", "retries",
    "tool_latency", "ingest_report", "deduplicated_events", "delivery_report",
    "correlated_sessions", "runs_in_long_keys", "sketched_usage", "late_redeliveries", "catalog_coverage", "stream_paired_calls",
]

INPUTS = {
    "message_log_events": "events", "clean_documents": "documents", "session_rollup": "events",
    "intent_breakdown": "events", "deduplicated_events": "lineitem", "stream_paired_calls": "events",
}


def shuffled(spark) -> int:
    """Bytes that all tasks so far wrote to shuffles."""
    executors = spark.sparkContext._jsc.sc().statusStore().executorList(True)
    return sum(executors.apply(i).totalShuffleWrite() for i in range(executors.size()))


def micro_batches(spark, sf: str, spans: int = 24) -> dict:
    """Seconds and state rows of the log stream's micro-batches, early and late ones."""
    progress = []
    streams.processed(spark, sf, spans=spans, watched=progress)
    taken = [p for p in progress if p["numInputRows"] > 1][1:]
    half = len(taken) // 2

    def seconds(some):
        return round(median(p["durationMs"]["triggerExecution"] for p in some) / 1000, 2)

    state = [p["stateOperators"][0]["numRowsTotal"] for p in taken]
    return {"batches": len(taken), "early_s": seconds(taken[:half]), "late_s": seconds(taken[half:]), "state_rows": [state[0], state[half], state[-1]]}


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    settings = {
        "spark.ui.enabled": "false",
        "spark.sql.shuffle.partitions": cpus if cpus.isdigit() else "8",
        "spark.driver.memory": "16g",
    }
    spark = build_session("bench", f"local[{cpus}]", **settings)
    spark.sparkContext.setLogLevel("ERROR")
    seconds, megabytes = {}, {}
    for name in HEADLINE:
        for _ in range(2):
            before, started = shuffled(spark), time.perf_counter()
            frame = registry.QUERIES[name](spark, sf)
            frame.write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - started, 3)
            megabytes[name] = round((shuffled(spark) - before) / 1e6, 2)
    rates = {}
    for name, source in INPUTS.items():
        rows = spark.read.parquet(f"{sf}/{source}.parquet").count()
        rates[name] = round(rows / seconds[name])
    flags = with_recursion_flag(views.rough_payloads(spark, sf), "slow", "payload").selectExpr("avg(CAST(slow AS DOUBLE))").first()[0]
    print(json.dumps({
        "metric": "headline queries, warm run", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "rows_per_sec": rates, "shuffle_mb": megabytes, "payloads_in_python": flags,
        "micro_batches": micro_batches(spark, sf), "sf": os.path.basename(sf.rstrip("/")),
        "cpus": cpus, "settings": settings,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
