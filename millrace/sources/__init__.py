"""Sources and sinks: batch tables, incremental streams, JSON ingest, and
fixture views over the driver's test tables."""
