"""Column-level building blocks: text patterns and scalar helpers."""
