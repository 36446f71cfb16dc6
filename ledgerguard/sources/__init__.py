"""Sources, adapters and sinks."""
