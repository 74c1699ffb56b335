"""The three registries and their review reports."""
