"""Operators for training-data pipelines: documents, pages and conversations.

Each module holds one operator with its own general interface; ``queries``
registers one production query per operator.  Nothing outside this package
imports it.
"""
