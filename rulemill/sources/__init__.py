"""Table, file and log sources and sinks."""
