"""Sinks: routed outputs, partitioned log, tables, idempotent publish, landing."""
