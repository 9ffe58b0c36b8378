"""Column expressions: ids, text cleaning, JSON payloads, telemetry, clients."""
