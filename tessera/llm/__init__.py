"""Operators of a training-data pipeline: token counts, WARC derivatives,
language identification, similarity join, top-k search, exact dedup, BPE,
repeated-passage removal, HTML extraction and source mixing.

Nothing else in the library imports this package.
"""
