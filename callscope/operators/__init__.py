"""Table operators: pairing, identity, assembly, envelopes, analytics, audits."""
