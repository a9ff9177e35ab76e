"""Sources and sinks: CSV trees, rate payloads, tables, shared workspace."""
