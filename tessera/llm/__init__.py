"""Training-data operators: tokens, shards, filters, near-duplicate joins and quality scores.

Nothing outside this folder imports it. Each operator has a module of its own with a general
interface; ``queries.py`` derives the contract's digest columns from what the operators return.
"""
