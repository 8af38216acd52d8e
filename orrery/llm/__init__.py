"""Operators of a training-data pipeline: quality rules, line dedup, PII, WARC, LM
scoring, near-dedup, HTML extraction, decontamination, toxicity and source mixing.

Each module holds one operator with a general interface; ``registry`` has the
registered queries and their DuckDB SQL. Nothing outside this subpackage imports it.
"""
