"""Operators for preparing training text: counts, quality, toxicity, mixing, token files,
near and exact duplicates, sharding and decontamination.

Rows are documents with `doc_id` and `text`. In every operator a null text has no
words and no bytes, repeated rows are judged one by one unless the operator says
otherwise, an empty table gives an empty table, and extra columns are carried or
ignored, never read. Where an operator adds a column, an input column of that
name gives way to it.
"""
