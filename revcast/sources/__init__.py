"""Sources and sinks, and the role mapping of the driver tables."""
