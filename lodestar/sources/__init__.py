"""Sources and sinks: extract files, run-versioned tables, compaction."""
