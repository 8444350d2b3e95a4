"""Operators for training text: quality, leaks, duplicates, tokens and scores.

Each module holds one operator with an interface of its own; ``queries`` binds
them to the given tables. Nothing outside this folder imports it.
"""
