"""Options of the event building jobs."""

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column

from callscope.operators.ordered import HOT_ROWS

HOOKS = "hooks"
MIDDLEWARE = "middleware"


@dataclass(frozen=True)
class BuildOptions:
    """How raw messages become events.

    adapter: how the log was observed. `hooks` logs the latest client of a session
      and no capabilities; `middleware` keeps the first client until the session
      closes, with capabilities, and knows the exact text of non-object arguments.
    capture_telemetry: off exports nothing and strips the block of cached clients.
    telemetry_fields: telemetry field -> top-level argument to read it from.
    redact_secrets: off keeps only the binary removal.
    actor_seed, actor_identifier: columns of the message log, or expressions on it.
    redactor: function on each cleaned value (input, output, error, telemetry).
    event_hook: function on the whole candidate; None drops the call.
    abandon_after: seconds after which a call without any answer counts as
      cancelled; needs `as_of`, the time the log ends.
    preview_bytes, source_bytes: cut input and result previews, and the script source,
      to so many bytes of UTF-8, as a receiver may ask; by default nothing is cut.
    random_ids: mint missing request ids at random instead of from the row.
    hot_rows: rows of one session above which its windows are sliced by time.
    """

    adapter: str = HOOKS
    capture_telemetry: bool = True
    telemetry_fields: dict[str, str] = field(default_factory=dict)
    redact_secrets: bool = True
    actor_seed: Column | None = None
    actor_identifier: Column | None = None
    redactor: Callable | None = None
    event_hook: Callable | None = None
    abandon_after: int | None = None
    as_of: str | None = None
    random_ids: bool = False
    preview_bytes: int | None = None
    source_bytes: int | None = None
    disabled: bool = False
    workflow_header: str = "X-Workflow-Run-Id"
    seed_header: str = "X-Session-Seed"
    session_header: str = "Mcp-Session-Id"
    capability_marker: str = "request-capability"
    hot_rows: int | None = HOT_ROWS

    def __post_init__(self):
        if self.adapter not in (HOOKS, MIDDLEWARE):
            raise ValueError(f"unknown adapter {self.adapter!r}")
        if self.abandon_after is not None and self.as_of is None:
            raise ValueError("abandon_after needs as_of")
