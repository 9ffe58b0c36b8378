"""Tool-call event analytics on Spark."""
