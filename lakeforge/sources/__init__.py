"""Table loading, file sources and sinks."""
