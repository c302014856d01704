"""Operators of a training-data pipeline: cleaning, scoring, deduplication,
sharding and packing of text corpora. Nothing else in the library imports
this package."""
