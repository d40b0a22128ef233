"""Operators for training-data pipelines.

Nothing outside this folder imports it.  Each module holds one operator with a general interface over any
DataFrame; ``queries`` applies them to the standard tables and derives the digest columns of each contract.
"""
