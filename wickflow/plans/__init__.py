"""Jobs composed of operators, with their sinks."""
