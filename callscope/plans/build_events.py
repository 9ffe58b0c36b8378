"""Message log (or finished calls) to the canonical event table."""

from pyspark.sql import DataFrame

from callscope.operators.assemble import (
    build_session_events,
    build_tool_calls,
    first_of_each,
    first_sightings,
)
from callscope.operators.pairing import Observed, pair_calls
from callscope.options import BuildOptions


def build_events(
    messages: DataFrame, options: BuildOptions | None = None, owned: DataFrame | None = None
) -> DataFrame:
    """Events of a message log: identities, session starts and tool calls.

    Rows sort into emit order by (server_id, recorded_at, source_seq, emit_pos): the
    identity comes before the session start and that before its call.
    """
    options = options or BuildOptions()
    return events_of(pair_calls(messages, options), options, owned)


def events_of(
    observed: Observed, options: BuildOptions, owned: DataFrame | None = None
) -> DataFrame:
    """Events of finished calls and session starts.

    The payload columns run through the calls branch only; the other branch reads a
    handful of key columns and keeps one row per session and actor in each task before
    it shuffles.
    """
    calls = build_tool_calls(observed.calls, options, owned)
    sightings = observed.sightings
    if sightings is None:
        sightings = first_sightings(observed.calls, observed.starts)
    events = build_session_events(first_of_each(sightings)).unionByName(calls)
    return events.filter("false") if options.disabled else events
