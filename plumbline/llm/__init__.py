"""Training-data operators: deduplication, mixing, scoring, rules and tokenisation.

Nothing outside this subpackage imports it.
"""
