"""Topic, file and table sources and sinks."""
