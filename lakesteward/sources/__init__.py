"""Sources, sinks and loading."""
