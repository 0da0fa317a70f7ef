"""Operators for building training corpora, each a Spark job over whole tables.

One module per operator; ``queries`` holds the thin registered queries and their SQL.
"""
