"""Training-data operators: PII surrogates, dedup, mixing, joins, scoring, packing.

Nothing else in the library imports this subpackage; ``registry`` lists its
queries and their SQL for the driver module.
"""
