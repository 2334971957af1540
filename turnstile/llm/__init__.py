"""Operators of a training-data pipeline: chat formatting, decontamination, secret scans, token
counts, HTML extraction, token files, quality rules, near-duplicates, repeated passages, packing.

Nothing outside this subpackage imports it; ``__spark_entry__.py`` adds its queries if it is there.
"""
