"""Code sets, keyword lists and ordered rules, kept as data."""
