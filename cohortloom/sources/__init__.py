"""Source schemas, loaders and sinks, and source-shaped views over sample tables."""
