"""Structured Streaming forms of the operators: watermarked windows,
update-mode rolling aggregates, managed-state processors and sinks."""
