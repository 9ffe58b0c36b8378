"""Small message logs for the tests."""

import json
from datetime import datetime, timedelta, timezone

from callscope.schemas import MESSAGE_SCHEMA

START = datetime(2024, 5, 1, 10, 0, 0, tzinfo=timezone.utc)


class Log:
    """Collects messages one second apart, in order, and makes a DataFrame of them."""

    def __init__(self, server="srv"):
        self.server = server
        self.rows = []

    def add(self, phase, method="tools/call", **values):
        seq = len(self.rows)
        row = dict.fromkeys(MESSAGE_SCHEMA.fieldNames())
        row |= {
            "seq": seq, "ts": START + timedelta(seconds=seq), "server_id": self.server,
            "connection_id": "c1", "transport_session_id": "s1", "process_id": "proc",
            "request_id": "1", "phase": phase, "method": method, "headers": {},
        }
        for name, value in values.items():
            if name == "after_ms":
                row["ts"] = self.rows[-1]["ts"] + timedelta(milliseconds=value)
            else:
                encode = name in ("params", "result") and isinstance(value, dict)
                row[name] = json.dumps(value) if encode else value
        self.rows.append(row)
        return self

    def initialize(self, name="client", version="1.0", **values):
        params = {"clientInfo": {"name": name, "version": version}, "protocolVersion": "2025-06-18"}
        params |= values.pop("extra", {})
        return self.add("end", "initialize", params=params, **values)

    def begin(self, tool="search", arguments=None, **values):
        return self.add("begin", params={"name": tool, "arguments": arguments or {}}, **values)

    def end(self, result=None, **values):
        return self.add("end", result=result if result is not None else {"content": []}, **values)

    def call(self, tool="search", arguments=None, result=None, error=None, **values):
        self.begin(tool, arguments, **values)
        if error is not None:
            return self.add("end", error=error, **values)
        return self.end(result, **values)

    def frame(self, spark):
        return frame_of(spark, [self])


def frame_of(spark, logs):
    names = MESSAGE_SCHEMA.fieldNames()
    rows = [tuple(r[n] for n in names) for log in logs for r in log.rows]
    return spark.createDataFrame(rows, MESSAGE_SCHEMA).coalesce(2)
