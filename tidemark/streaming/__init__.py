"""The incremental loads as streams."""
