"""Training-data operators: filters, scoring, scans, deduplication and mixing.

Nothing else in the library imports this subpackage. Every operator takes and
returns DataFrames; its registered query is in :mod:`ledgerline.llm.queries`.
"""
