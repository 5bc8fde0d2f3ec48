"""Sources, sinks and table layout (inventory section 2A)."""
