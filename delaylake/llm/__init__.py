"""Operators of a training-data pipeline (dedup, archives, joins, tokenizing, quality,
sharding, language, decontamination, URL and toxicity filters).

Nothing else in the library imports this subpackage."""
